"""Token-id files: static range asymmetric numeral system (rANS) blocks.

A file set is a folder with two Parquet data sets: ``table`` (one row: scale bits, symbols, frequencies)
and ``blocks`` (one row per block: its place, the documents in it, a binary payload). One frequency table,
from counts over all ids, is shared by all blocks, so each block decodes alone. In a block, ids are dealt
round robin to ``lanes`` interleaved states. Every ``steps`` rounds a checkpoint holds the states, the place
in the word stream and the CRC-32 of the ids up to the next one, so a block can also be decoded in parallel
pieces. The payload ends with the CRC-32 of all before it.

Blocks hold whole documents in ascending order: texts are range-partitioned by doc_id, a partition's
documents are encoded in order, and a document's place is its partition's base plus its place inside.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tokenize import encoder
from .util import binary_array, discard, list_array, materialize, row_slices, string_buffer

MAGIC = b"RNSB"
BLOCK_IDS, LANES, STEPS = 1 << 18, 1024, 128
LOW = np.uint64(1 << 31)
U32 = np.uint64(32)


@dataclass(frozen=True)
class FrequencyTable:
    """Frequencies that sum to ``2**bits``; ``symbols`` ascends."""
    bits: int
    symbols: np.ndarray
    freq: np.ndarray

    @classmethod
    def from_counts(cls, symbols: np.ndarray, counts: np.ndarray) -> FrequencyTable:
        """Scaled counts, at least 1 each; the rounding goes to the most frequent symbols."""
        bits = max(14, int(np.ceil(np.log2(max(len(symbols), 1)))) + 3)
        total = 1 << bits
        order = np.argsort(symbols)
        symbols, counts = symbols[order], counts[order].astype(float)
        freq = np.maximum(1, np.floor(counts * (total - len(counts)) / max(counts.sum(), 1))).astype(np.int64)
        spare = total - int(freq.sum())
        if len(freq):
            freq[np.argmax(freq)] += spare
        return cls(bits, symbols.astype(np.int64), freq)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Frequency and first slot by symbol, symbol by slot."""
        size = int(self.symbols.max()) + 1 if len(self.symbols) else 1
        freq, first = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        freq[self.symbols] = self.freq
        first[self.symbols] = np.cumsum(self.freq) - self.freq
        return freq, first, np.repeat(self.symbols, self.freq).astype(np.uint32)


def encode_block(ids: np.ndarray, bits: int, freq: np.ndarray, first: np.ndarray, lanes: int = LANES, steps: int = STEPS) -> bytes:
    n = len(ids)
    lanes = max(1, min(lanes, n // 128))  # a state costs 8 bytes
    rounds = -(-n // lanes)
    x = np.full(lanes, LOW, np.uint64)
    f_all, c_all = freq[ids], first[ids]
    shift, scale = np.uint64(63 - bits), np.uint64(bits)
    words, marks = [], {}
    for t in range(rounds - 1, -1, -1):
        f, c = f_all[t * lanes:(t + 1) * lanes], c_all[t * lanes:(t + 1) * lanes]
        y = x[:len(f)]
        big = y >= (f << shift)
        words.append((y[big] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        y = np.where(big, y >> U32, y)
        q = y // f
        x[:len(f)] = (q << scale) + (y - q * f) + c
        if t % steps == 0:
            marks[t] = x.copy()
    words.reverse()
    ends = np.cumsum([len(w) for w in words]) if words else np.zeros(0, np.int64)
    stream = np.concatenate(words) if words else np.empty(0, "<u4")
    parts = [struct.pack("<4sIIIII", MAGIC, bits, lanes, steps, n, len(stream))]
    plain = ids.astype("<u4")
    for t in sorted(marks):
        out_at = int(ends[t - 1]) if t else 0
        parts.append(struct.pack("<II", out_at, zlib.crc32(plain[t * lanes:(t + steps) * lanes])))
        parts.append(marks[t].astype("<u8").tobytes())
    parts.append(stream.tobytes())
    body = b"".join(parts)
    return body + struct.pack("<I", zlib.crc32(body))


def decode_block(payload: bytes, freq: np.ndarray, first: np.ndarray, symbol: np.ndarray, only: int | None = None) -> np.ndarray:
    """The ids of a block, or of its part behind checkpoint ``only``. Raises ValueError on any damage."""
    if len(payload) < 28 or zlib.crc32(memoryview(payload)[:-4]) != struct.unpack("<I", payload[-4:])[0]:
        raise ValueError("token block: wrong checksum")
    magic, bits, lanes, steps, n, n_words = struct.unpack_from("<4sIIIII", payload)
    if magic != MAGIC:
        raise ValueError("token block: wrong format")
    rounds = -(-n // lanes) if n else 0
    n_marks = -(-rounds // steps)
    size = 8 + 8 * lanes
    stream = np.frombuffer(payload, "<u4", n_words, 24 + n_marks * size).astype(np.uint64)
    mask, scale = np.uint64((1 << bits) - 1), np.uint64(bits)
    out = np.empty(n, np.uint32)
    for k in range(n_marks) if only is None else [only]:
        at, crc = struct.unpack_from("<II", payload, 24 + k * size)
        x = np.frombuffer(payload, "<u8", lanes, 24 + k * size + 8).astype(np.uint64)
        lo, hi = k * steps * lanes, min((k + 1) * steps * lanes, n)
        for a in range(lo, hi, lanes):
            b = min(a + lanes, n)
            y = x[:b - a]
            slot = y & mask
            s = symbol[slot]
            out[a:b] = s
            y = freq[s] * (y >> scale) + slot - first[s]
            need = np.flatnonzero(y < LOW)
            y[need] = (y[need] << U32) | stream[at:at + len(need)]
            at += len(need)
            x[:b - a] = y
        if zlib.crc32(out[lo:hi].astype("<u4", copy=False)) != crc:
            raise ValueError("token block: wrong ids")
    return out if only is None else out[only * steps * lanes:(only + 1) * steps * lanes]


def ordered_ids(docs: DataFrame, path: str, rule: str, end_id: int) -> DataFrame:
    """(part, at, doc_id, n, ids): documents in ascending doc_id order (nulls first, then by the text's hash) within
    range partitions that ascend with ``part``; ``at`` = ids before the document in its partition.

    A null text has the end id alone; repeated rows are documents of their own.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(it):
        enc, part, at = encoder(path, rule), TaskContext.get().partitionId(), 0
        for batch in it:
            buf, offs = string_buffer(batch.column("text"))
            for i, j in row_slices(offs):
                ids, counts = enc.encode(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                n = counts + 1
                ends = np.cumsum(n)
                full = np.empty(int(ends[-1]), "<u4")
                own = np.ones(len(full), bool)
                own[ends - 1] = False
                full[own], full[ends - 1] = ids, end_id
                if (full < 1 << 16).all():
                    full = full.astype("<u2")
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(j - i, part, np.int32)), pa.array(at + ends - n), batch.column("doc_id").slice(i, j - i), pa.array(n),
                    binary_array(full.view(np.uint8), n * full.itemsize)], ["part", "at", "doc_id", "n", "ids"])
                at += int(ends[-1])

    return (docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text"))
            .sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(run, f"part int, at long, doc_id {kind}, n long, ids binary"))


def _flat_ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch and the number by row; a row's width is its bytes over its count."""
    col, n = batch.column("ids"), batch.column("n").to_numpy()
    if not len(n):
        return np.empty(0, np.int64), n
    offs = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(col.buffers()[2], np.uint8)
    wide = np.diff(offs) // np.maximum(n, 1)
    out = np.empty(int(n.sum()), np.int64)
    of = np.repeat(wide, n)
    for w, kind in ((2, "<u2"), (4, "<u4")):
        rows = np.flatnonzero(wide == w)
        if len(rows) == len(wide):
            return np.frombuffer(raw[offs[0]:offs[-1]].tobytes(), kind).astype(np.int64), n
        if len(rows):
            out[of == w] = np.concatenate([np.frombuffer(raw[offs[r]:offs[r + 1]].tobytes(), kind) for r in rows])
    return out, n


def id_counts(ids: DataFrame) -> DataFrame:
    """(id, count) over all ids; each task sends one row per id that it has seen."""
    def run(it):
        counts = np.zeros(1 << 16, np.int64)
        for batch in it:
            flat, _ = _flat_ids(batch)
            got = np.bincount(flat)
            if len(got) > len(counts):
                counts = np.pad(counts, (0, len(got) - len(counts)))
            counts[:len(got)] += got
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["id", "count"])

    return ids.select("n", "ids").mapInArrow(run, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


def write_token_files(docs: DataFrame, path: str, rule: str, end_id: int, block_ids: int = BLOCK_IDS, lanes: int = LANES, steps: int = STEPS) -> tuple[DataFrame, DataFrame]:
    """Write the file set and return its ``blocks`` and ``table``.

    The vocabulary bounds what the driver sees of the counts. A block closes at ``block_ids`` ids; a longer
    document is a block of its own.
    """
    ids = materialize(ordered_ids(docs, path, rule, end_id), "ids")
    counts = id_counts(ids).collect()
    table = FrequencyTable.from_counts(np.array([r["id"] for r in counts], np.int64), np.array([r["count"] for r in counts], np.int64))
    bits = table.bits

    def run(it):
        freq, first, _ = table.tables()
        # rows of one read are consecutive documents of one partition file after another
        held, size, key = [], 0, None

        def block():
            docs_, n = pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held])
            payload = encode_block(np.concatenate([h[2] for h in held]), bits, freq, first, lanes, steps)
            return pa.RecordBatch.from_arrays([
                pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([int(n.sum())], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), docs_), list_array(n, np.array([len(n)]), pa.int64()),
                pa.array([payload], pa.binary())], ["part", "at", "n_ids", "doc_ids", "lengths", "payload"])

        for batch in it:
            flat, n = _flat_ids(batch)
            ends = np.cumsum(n)
            part, at = batch.column("part").to_numpy(), batch.column("at").to_numpy()
            i = 0
            while i < len(n):
                if held and (part[i] != key[0] or at[i] != key[1] + size):
                    yield block()
                    held, size = [], 0
                if not held:
                    key = (int(part[i]), int(at[i]))
                base = int(ends[i] - n[i])
                j = max(i + 1, int(np.searchsorted(ends, base + block_ids - size, side="right")))
                follows = np.flatnonzero((part[i + 1:j] != part[i]) | (at[i + 1:j] != at[i:j - 1] + n[i:j - 1]))
                j = i + 1 + int(follows[0]) if len(follows) else j
                held.append((batch.column("doc_id").slice(i, j - i), n[i:j], flat[base:ends[j - 1]]))
                size += int(ends[j - 1]) - base
                i = j
                if size >= block_ids:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = ids.mapInArrow(run, f"part int, at long, n_ids long, doc_ids array<{kind}>, lengths array<long>, payload binary")
    written = materialize(blocks, "token-blocks")
    discard(ids)
    spark = docs.sparkSession
    meta = spark.createDataFrame([(bits, table.symbols.tolist(), table.freq.tolist())], "bits int, symbols array<long>, freq array<long>")
    return written, materialize(meta, "token-table")


def read_token_files(blocks: DataFrame, meta: DataFrame, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, decoded from the blocks."""
    row = meta.first()
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    tables = (row["bits"], np.array(row["symbols"], np.int64), np.array(row["freq"], np.int64)) if row else (14, np.empty(0, np.int64), np.empty(0, np.int64))

    def run(it):
        freq, first, symbol = FrequencyTable(*tables).tables()
        for batch in it:
            for k in range(batch.num_rows):
                n = batch.column("lengths")[k].values.to_numpy()
                ids = decode_block(batch.column("payload")[k].as_py(), freq, first, symbol).astype("<u4", copy=False)
                ends = np.cumsum(n)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip((ends - n).tolist(), ends.tolist())]
                cols = [pa.array(np.full(len(n), batch.column("part")[k].as_py(), np.int32)), batch.column("doc_ids")[k].values,
                        pa.array(ends - n + batch.column("at")[k].as_py()), pa.array(n), pa.array(crc, pa.int64())]
                if keep_ids:
                    cols.append(binary_array(ids.view(np.uint8), n * 4))
                yield pa.RecordBatch.from_arrays(cols, ["part", "doc_id", "at", "n_tokens", "ids_crc32", "ids"][:len(cols)])

    # one row per range partition: their number is the session's, not the data's
    base = (blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
            .select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base")))
    docs = blocks.select("part", "at", "doc_ids", "lengths", "payload").mapInArrow(
        run, f"part int, doc_id {kind}, at long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids)
    return docs.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * keep_ids)
