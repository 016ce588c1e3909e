"""Sequence packing as a cutting-stock problem solved by column generation.

The texts are tokenised and cut every ``capacity`` ids, and the remainder once more at its last multiple of
``unit``: few large sizes that fit each other and small ones for the gaps (0.1 % padding where uncut
remainders leave 1 % and more). The pieces' lengths are rounded up to classes of
``width`` ids. A pattern says how many pieces of each class one sequence takes. The linear program "fewest
sequences that cover the histogram of classes" starts with one pattern per class; a knapsack dynamic program
over the dual prices finds the next pattern until none improves. Counts of patterns are rounded down, the few
pieces left are packed best fit decreasing, and the pieces, ranked within their class, take the slots.

The driver sees the class histogram (at most ``capacity / width`` numbers) and the pattern list; pieces stay
in Spark. Ranks come from counts by (class, bucket), so that a class that holds a third of all pieces is
ranked in many tasks.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tokenize import encoder
from .util import arrow_rows, binary_array, materialize, row_slices, string_buffer

CAPACITY, WIDTH, UNIT = 2048, 4, 512
#: Pieces by rank bucket, on average, before a class is ranked in more buckets.
BUCKET_ROWS = 100_000
#: Texts that a worker gets at a time.
TEXT_ROWS = 1000


def token_pieces(docs: DataFrame, path: str, rule: str, end_id: int, capacity: int = CAPACITY, unit: int = UNIT, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): every text's ids and ``end_id``, cut each ``capacity`` ids.

    What is left at the end is cut once more, at its last multiple of ``unit``.

    A null text counts as empty and is one piece with ``end_id`` alone; repeated rows are pieces of their own.
    ``ids`` is little-endian unsigned 32-bit.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(it):
        enc = encoder(path, rule)
        for batch in it:
            buf, offs = string_buffer(batch.column("text"))
            for i, j in row_slices(offs):
                ids, counts = enc.encode(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                ends = np.cumsum(counts + 1)
                full = np.empty(int(ends[-1]), "<u4")
                own = np.ones(len(full), bool)
                own[ends - 1] = False
                full[own], full[ends - 1] = ids, end_id
                n = counts + 1
                whole, rest = n // capacity, n % capacity
                main, tail = rest // unit * unit, rest % unit
                parts = whole + (main > 0) + (tail > 0)
                of = np.repeat(np.arange(len(n)), parts)
                k = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = np.minimum(k, whole[of]) * capacity + np.where(k > whole[of], main[of], 0)
                length = np.where(k < whole[of], capacity, np.where((k == whole[of]) & (main[of] > 0), main[of], tail[of]))
                at = (ends - n)[of] + start
                crc = [zlib.crc32(full[a:b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                cols = [batch.column("doc_id").take(pa.array(of + i)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[of])]
                if keep_ids:
                    cols.append(binary_array(full.view(np.uint8), length * 4))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(cols)])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * keep_ids)


def _best_pattern(price: np.ndarray, size: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of the highest total price that fits into ``room``."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        best[r] = best[r - 1]
        fits = np.searchsorted(size, r, side="right")
        if fits:
            gain = best[r - size[:fits]] + price[:fits]
            k = int(np.argmax(gain))
            if gain[k] > best[r] + 1e-12:
                best[r], pick[r] = gain[k], k
    pattern, r = np.zeros(len(size)), room
    while r > 0:
        if pick[r] < 0:
            r -= 1
        else:
            pattern[pick[r]] += 1
            r -= int(size[pick[r]])
    return float(best[room]), pattern


def column_generation(size: np.ndarray, demand: np.ndarray, room: int, rounds: int = 3000) -> list[tuple[np.ndarray, float]]:
    """The linear program's patterns with their (fractional) counts. ``size`` ascends; each is at most ``room``.

    A revised simplex over one row per class; more than ``rounds`` pivots only leave a slightly worse plan.
    """
    m = len(size)
    first = np.diag((room // size).astype(float))
    basis = [first[k].copy() for k in range(m)]
    inverse = np.diag(1.0 / (room // size))
    # tiny steps apart, so that equal demands don't make the simplex stall
    x = inverse @ (demand * (1 + 1e-9 * np.arange(1, m + 1) / m))
    for _ in range(rounds):
        value, pattern = _best_pattern(inverse.sum(axis=0), size, room)
        if value <= 1 + 1e-7:
            break
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        x -= ratio[out] * step
        x[out] = ratio[out]
        basis[out] = pattern
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
    return [(p, float(max(v, 0))) for p, v in zip(basis, x)]


def patterns_for(size: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Whole counts of patterns that cover ``demand`` exactly: the program's counts rounded down, the rest best fit decreasing."""
    plan: dict[bytes, int] = {}
    left = demand.astype(np.int64).copy()
    for pattern, count in column_generation(size, demand.astype(float), room):
        p = pattern.astype(np.int64)
        used = p > 0
        n = min(int(count + 1e-6), int((left[used] // p[used]).min())) if used.any() else 0
        if n > 0:
            plan[p.tobytes()] = plan.get(p.tobytes(), 0) + n
            left -= n * p
    spare: list[list[np.ndarray]] = [[] for _ in range(room + 1)]  # open sequences by free room
    for k in range(len(size) - 1, -1, -1):
        for _ in range(int(left[k])):
            free = next((r for r in range(int(size[k]), room + 1) if spare[r]), None)
            seq = spare[free].pop() if free is not None else np.zeros(len(size), np.int64)
            seq[k] += 1
            spare[(room if free is None else free) - int(size[k])].append(seq)
    for seqs in spare:
        for seq in seqs:
            plan[seq.tobytes()] = plan.get(seq.tobytes(), 0) + 1
    return [(np.frombuffer(p, np.int64), n) for p, n in plan.items()]


@dataclass
class _Slots:
    """Of one class: the ranks from ``lo`` on go to the sequences from ``seq`` on, ``each`` to a sequence."""
    lo: list[int]
    seq: list[int]
    each: list[int]


def pack(pieces: DataFrame, capacity: int = CAPACITY, width: int = WIDTH) -> DataFrame:
    """``pieces`` (any columns; ``length`` from 1 to ``capacity``) with sequence_id and offset.

    Every piece lies in one sequence; a sequence's pieces are gapless from offset 0 and hold at most
    ``capacity`` ids. Empty input gives no rows. ``pieces`` should be a written table (it is read twice).
    """
    pieces = pieces.withColumn("_class", F.ceil(F.col("length") / width).cast("int"))
    hist = pieces.groupBy("_class").count().collect()  # at most capacity / width rows
    total = sum(r["count"] for r in hist)
    size = np.array(sorted(r["_class"] for r in hist), np.int64)
    demand = np.array([r["count"] for r in sorted(hist, key=lambda r: r["_class"])], np.int64)
    slots: dict[int, _Slots] = {int(s): _Slots([], [], []) for s in size}
    seq, taken = 0, np.zeros(len(size), np.int64)
    for pattern, n in patterns_for(size, demand, capacity // width) if len(size) else []:
        for k in np.flatnonzero(pattern):
            s = slots[int(size[k])]
            s.lo.append(int(taken[k])), s.seq.append(seq), s.each.append(int(pattern[k]))
        taken += pattern * n
        seq += n
    table = {k: (np.array(s.lo), np.array(s.seq), np.array(s.each)) for k, s in slots.items()}

    buckets = max(64, -(-total // BUCKET_ROWS))
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int"))
    before = (pieces.groupBy("_class", "_bucket").count()
              .withColumn("_base", F.sum("count").over(Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
              .select("_class", "_bucket", F.coalesce("_base", F.lit(0)).alias("_base")))
    at = Window.partitionBy("_class", "_bucket")
    ranked = (pieces.withColumn("_rank", F.row_number().over(at.orderBy("doc_id", "start", "ids_crc32")) - 1)
              .join(before, ["_class", "_bucket"]).withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_bucket", "_base"))

    def run(it):
        for batch in it:
            cls, rank = batch.column("_class").to_numpy(), batch.column("_rank").to_numpy()
            out = np.empty(len(cls), np.int64)
            for c in np.unique(cls).tolist():
                lo, first, each = table[c]
                mine = cls == c
                k = np.searchsorted(lo, rank[mine], side="right") - 1
                out[mine] = first[k] + (rank[mine] - lo[k]) // each[k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "sequence_id"])

    from pyspark.sql import types as T
    placed = ranked.mapInArrow(run, T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType())]))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_class", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")).drop("_class", "_rank")


def pack_documents(docs: DataFrame, path: str, rule: str = "word", end_id: int = 1, capacity: int = CAPACITY, width: int = WIDTH,
                   unit: int = UNIT, keep_ids: bool = False) -> DataFrame:
    """Tokenise and pack whole documents: one row per piece (see ``token_pieces`` and ``pack``)."""
    with arrow_rows(docs.sparkSession, TEXT_ROWS):
        pieces = materialize(token_pieces(docs, path, rule, end_id, capacity, unit, keep_ids), "pieces")
    return pack(pieces, capacity, width)
