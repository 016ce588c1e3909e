"""Token ids of whole texts by the tokenizers library, one call for each distinct piece of text.

A text is cut where no token can span the cut, equal pieces are encoded once, and the ids are put
together again, so the ids equal those of encoding the whole text. ``CUTS`` has the rule by file:

* ``word``: white space is dropped and splits words, so ASCII white space is a cut.
* ``byte``: a space after a character that is not white space always begins a new pre-token. So does a newline, a
  character after a lone newline, and a change between letters, digits and signs, but for a letter after an
  apostrophe. Only ASCII and the letters of U+00C0 to U+023F count there.

Special tokens that a text spells out get their own ids, as the library gives them by default. None holds white
space, so no cut at white space falls into one; texts that spell one out are cut at spaces only.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np

from . import kernels as K

#: Distinct pieces that a worker remembers; a full memory is emptied, which only costs time.
REMEMBERED = 1_400_000
#: Slots of the hash table (a power of two) and, by rule, ids in a row of the id matrix.
_SLOT_BITS, _ROW = 21, {"word": 6, "byte": 4}
JOINED = 24
#: By byte: a letter, digit or sign of ASCII, the first byte of a letter of U+00C0 to U+023F, or (0) anything else.
_LETTER, _DIGIT, _SIGN, _PAIR = 1, 2, 3, 4
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _LETTER
_KIND[0xC3:0xC9] = _PAIR


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Encodes batches of texts given as UTF-8 bytes and row offsets."""

    def __init__(self, path: str, rule: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.width = _ROW[rule]
        self.rule = {"word": self._word, "byte": self._byte}[rule]
        # pieces that are surely whole beside a mark are encoded JOINED at a time and split at its id
        self.mark, plain = {"word": (" | ", lambda t: "|" not in t), "byte": ("\n", lambda t: t.split() == [t[t[0] == " ":]])}[rule]
        self.plain = lambda t: plain(t) and not any(x in t for x in special)
        self.special = [x.encode() for x in special]
        mark = self.tok.encode(self.mark, add_special_tokens=False).ids
        self.mark_id = mark[0] if len(mark) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self.slot_hash = np.zeros(1 << _SLOT_BITS, np.uint64)
        self.slot_piece = np.full(1 << _SLOT_BITS, -1, np.int32)
        # a piece's ids fill one row or more of the matrix
        self.row, self.rows, self.size = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int32)
        self.ids = np.empty((0, self.width), np.uint16 if self.tok.get_vocab_size() < 1 << 16 else np.uint32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The pieces of the hashes; -1 where unknown."""
        at = (h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        piece = self.slot_piece[at]
        wrong = np.flatnonzero((self.slot_hash[at] != h) & (piece >= 0))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & ((1 << _SLOT_BITS) - 1)
            piece[wrong] = self.slot_piece[at[wrong]]
            wrong = wrong[(self.slot_hash[at[wrong]] != h[wrong]) & (piece[wrong] >= 0)]
        return piece

    def _remember(self, h: np.ndarray, texts: list[str]) -> None:
        """Encode new pieces with distinct hashes."""
        if self.mark_id is not None:
            plain = np.fromiter(map(self.plain, texts), bool, len(texts))
            for some, join in ((plain, JOINED), (~plain, 1)):
                at = np.flatnonzero(some)
                self._encode(h[at], [texts[i] for i in at.tolist()], join)
        else:
            self._encode(h, texts, 1)

    def _encode(self, h: np.ndarray, texts: list[str], join: int) -> None:
        got = [e.ids for e in self.tok.encode_batch_fast([self.mark.join(texts[i:i + join]) for i in range(0, len(texts), join)] if join > 1 else texts,
                                                         add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int32, len(got))
        flat = np.fromiter(chain.from_iterable(got), self.ids.dtype, int(size.sum()))
        if join > 1 and len(got):
            marks = flat == self.mark_id
            ends = np.cumsum(size)
            per = np.add.reduceat(np.append(marks, False), ends - size) if (size > 0).all() else np.zeros(1)
            if marks.sum() != len(texts) - len(got) or (per[:-1] != join - 1).any():
                return self._encode(h, texts, 1)
            bounds = np.union1d(np.flatnonzero(marks), ends - 1)  # last id of a group, or the mark behind a piece
            size = np.diff(np.append(-1, bounds)) - marks[bounds]
            flat = flat[~marks]
        rows = np.maximum(-(-size // self.width), 1).astype(np.int32)
        matrix = np.zeros((int(rows.sum()), self.width), self.ids.dtype)
        first = np.cumsum(rows) - rows
        matrix.ravel()[np.repeat(first.astype(np.int64) * self.width - (np.cumsum(size) - size), size) + np.arange(len(flat))] = flat
        piece = np.arange(len(self.row), len(self.row) + len(h), dtype=np.int32)
        self.row = np.append(self.row, (len(self.ids) + first).astype(np.int32))
        self.rows, self.size = np.append(self.rows, rows), np.append(self.size, size)
        self.ids = np.concatenate([self.ids, matrix])
        at, left = (h >> np.uint64(64 - _SLOT_BITS)).astype(np.int64), np.arange(len(h))
        while len(left):
            _, one = np.unique(at[left], return_index=True)  # one taker for each slot
            one = one[self.slot_piece[at[left[one]]] < 0]
            take = left[one]
            self.slot_hash[at[take]], self.slot_piece[at[take]] = h[take], piece[take]
            left = np.delete(left, one)
            at[left] = np.where(self.slot_piece[at[left]] >= 0, (at[left] + 1) & ((1 << _SLOT_BITS) - 1), at[left])

    @staticmethod
    def _word(buf: np.ndarray, offsets: np.ndarray):
        return K.word_bounds(buf, offsets, K.SPACE)

    def _byte(self, buf: np.ndarray, offsets: np.ndarray):
        n = len(buf)
        first = np.zeros(n + 1, bool)
        if n > 2:
            raw = buf.tobytes()
            before, lead, here = buf[1:-1], buf[:-2], buf[2:]
            solid = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (before < 0xC0) & (lead > 0xC2) & (lead < 0xE0))
            if any(x in raw for x in self.special):
                first[2:n] = (here == 0x20) & solid
            else:
                kind = _KIND[buf]
                pair = np.flatnonzero(kind == _PAIR)
                kind[pair] = _LETTER
                pair = pair[pair < n - 1]
                kind[pair + 1] = _LETTER
                sign = pair[(buf[pair] == 0xC3) & ((buf[pair + 1] == 0x97) | (buf[pair + 1] == 0xB7))]  # the multiplication and division signs
                kind[sign] = kind[sign + 1] = 0
                left, right = kind[1:-1], kind[2:]
                first[2:n] = ((here == 0x20) | (here == 0x0A)) & solid
                first[2:n] |= (left != right) & (left > 0) & (right > 0) & ((before != 0x27) | (right != _LETTER))
                first[3:n] |= first[2:n - 1] & (before[1:] == 0x0A) & (right[1:] > 0)
        first[offsets] = True
        first[n] = False
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], n)
        return starts, ends, np.diff(np.searchsorted(starts, offsets))

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in a row, and the number of ids of each row."""
        starts, ends, counts = self.rule(buf, offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        h = K.span_hashes(buf, starts, ends)
        if len(self.row) > REMEMBERED:
            self._forget()
        piece = self._find(h)
        unknown = np.flatnonzero(piece < 0)
        if len(unknown):
            new, one = np.unique(h[unknown], return_index=True)
            pick = unknown[one]
            raw = buf.tobytes()
            self._remember(new, [raw[a:b].decode() for a, b in zip(starts[pick].tolist(), ends[pick].tolist())])
            piece[unknown] = self._find(h[unknown])
        size, rows = self.size[piece], self.rows[piece]
        row = self.row[piece]
        left = size
        if (rows > 1).any():
            nth = np.arange(int(rows.sum()), dtype=np.int32) - np.repeat(np.cumsum(rows, dtype=np.int32) - rows, rows)
            row, left = np.repeat(row, rows) + nth, np.repeat(size, rows) - nth * self.width
        out = self.ids[row][np.arange(self.width, dtype=np.int32) < left[:, None]]
        bound = np.append(0, np.cumsum(size, dtype=np.int64))[np.append(0, np.cumsum(counts))]
        return out, np.diff(bound)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, rule: str) -> Encoder:
    """The worker process's encoder: it outlives a task, so later tasks find the pieces of earlier ones."""
    if (path, rule) not in _ENCODERS:
        _ENCODERS[path, rule] = Encoder(path, rule)
    return _ENCODERS[path, rule]


def forget_encoders() -> None:
    """Drop what an earlier job left in this worker process; for jobs that don't tokenise."""
    _ENCODERS.clear()
