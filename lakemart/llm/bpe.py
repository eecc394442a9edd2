"""Byte-level BPE, encoded in length-bucketed padded matrices of token ids.

A text is cut by the split pattern; words not seen lately by the worker are
encoded together. Words of similar byte length form a matrix with one word to
a row. Each round looks at the rank of every neighbouring pair, every row
merges its leftmost pair of least rank, the rows close up by one place, and
finished rows leave the matrix. Ranks come from an open-addressing hash table
over pairs of ids, probed for whole columns at a time.

Words beyond ``LONG_BYTES`` are encoded one by one, and a round merges all
places of the least pair at once where that gives the same result as one by
one (no pair with the merged token has a lower rank; see ``Vocabulary.alone``).

Defined cases: null and empty texts have no tokens, special tokens are ordinary
text, repeated rows each give a row, an empty table gives no rows, columns
other than id and text are ignored.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices, texts_of

NONE = np.iinfo(np.int32).max
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Row widths of the matrices; longer words are encoded alone.
WIDTHS = (4, 8, 16, 32, 64, 128, 256)
LONG_BYTES = WIDTHS[-1]
#: Cells of one matrix, and entries of a worker's caches of words.
MATRIX_CELLS = 2_000_000
CACHE_WORDS = 300_000

#: Unicode white space, as the split pattern's engine understands it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACED = re.compile(rf"[{_SPACE}] ")
_BEFORE_SPACE = re.compile(rf"(?<=[^{_SPACE}])(?= )")


class Vocabulary:
    """Token bytes by rank, and the hash table of pairs that merge."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(None, lines))}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        ranks, left, right, merged = self.ranks, [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        left, right, merged = (np.array(x, np.int64) for x in (left, right, merged))
        #: True where every pair that holds the token has a higher rank than the token.
        self.alone = np.ones(len(self.tokens), bool)
        self.alone[left[merged < left]] = False
        self.alone[right[merged < right]] = False
        self._build(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64), merged.astype(np.int32))

    def _build(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(4, int(len(keys) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, EMPTY), np.full(1 << bits, NONE, np.int32)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == EMPTY]
            at, first = np.unique(slot[free], return_index=True)
            self.keys[at], self.values[at] = keys[free[first]], values[free[first]]
            todo = np.setdiff1d(todo, free[first], assume_unique=True)
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _MIX >> self.shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it does not merge or holds padding (-1)."""
        out = np.full(left.shape, NONE, np.int32)
        real = right >= 0
        keys = left[real].astype(np.uint64) << np.uint64(32) | right[real].astype(np.uint64)
        found, slot, todo = np.full(len(keys), NONE, np.int32), self._slot(keys), np.arange(len(keys))
        while len(todo):
            there = self.keys[slot]
            hit = there == keys[todo]
            found[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there != EMPTY)
            todo, slot = todo[on], (slot[on] + 1) & self.mask
        out[real] = found
        return out


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_matrix(vocab: Vocabulary, words: list[bytes], width: int) -> list[np.ndarray]:
    """Ids of words of at most ``width`` bytes, one to a row."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = vocab.bytes[np.frombuffer(b"".join(words), np.uint8)]
    ids = np.full((len(words), width), -1, np.int32)
    ids[np.arange(width) < sizes[:, None]] = flat
    out: list[np.ndarray] = [None] * len(words)  # type: ignore[list-item]
    row = np.arange(len(words))
    pairs = vocab.pair_ranks(ids[:, :-1], ids[:, 1:])
    while len(row):
        at = pairs.argmin(axis=1) if pairs.shape[1] else np.zeros(len(row), np.int64)
        least = pairs[np.arange(len(row)), at] if pairs.shape[1] else np.full(len(row), NONE, np.int32)
        done = least == NONE
        if done.any():
            for r, tokens in zip(row[done].tolist(), ids[done]):
                out[r] = tokens[tokens >= 0]
            row, ids, pairs, at, least = row[~done], ids[~done], pairs[~done], at[~done], least[~done]
            if not len(row):
                break
        n = np.arange(len(row))
        # the merged token stands at ``at``; what follows it moves one place to the left
        take = np.arange(ids.shape[1] - 1)
        ids = np.take_along_axis(ids, take + (take > at[:, None]), axis=1)
        ids[n, at] = least
        take = np.arange(pairs.shape[1] - 1)
        pairs = np.take_along_axis(pairs, take + (take >= at[:, None]), axis=1)
        if pairs.shape[1]:
            ahead = at < pairs.shape[1]
            pairs[n[ahead], at[ahead]] = vocab.pair_ranks(least[ahead], ids[n[ahead], at[ahead] + 1])
            behind = at > 0
            pairs[n[behind], at[behind] - 1] = vocab.pair_ranks(ids[n[behind], at[behind] - 1], least[behind])
    return out


def encode_long(vocab: Vocabulary, word: bytes) -> np.ndarray:
    """Ids of one long word."""
    ids = vocab.bytes[np.frombuffer(word, np.uint8)]
    pairs = vocab.pair_ranks(ids[:-1], ids[1:])
    while len(pairs) and (least := pairs.min()) != NONE:
        at = np.flatnonzero(pairs == least)
        if not vocab.alone[least]:
            at = at[:1]
        elif (touching := np.diff(at) == 1).any():
            # neighbours share a token: of a run, merge the first, third, fifth …
            start = np.concatenate([[True], ~touching])
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))) % 2 == 0]
        ids[at] = least
        ids, pairs = np.delete(ids, at + 1), np.delete(pairs, at)
        at = at - np.arange(len(at))
        ahead = at[at < len(pairs)]
        pairs[ahead] = vocab.pair_ranks(ids[ahead], ids[ahead + 1])
        behind = at[at > 0] - 1
        pairs[behind] = vocab.pair_ranks(ids[behind], ids[behind + 1])
    return ids


def encode_words(vocab: Vocabulary, words: list[bytes]) -> dict[bytes, bytes]:
    """Ids (little-endian 32-bit) of each word."""
    out: dict[bytes, bytes] = {}
    buckets: dict[int, list[bytes]] = {w: [] for w in WIDTHS}
    for word in words:
        rank = vocab.ranks.get(word)
        if rank is not None:
            out[word] = rank.to_bytes(4, "little")
        elif len(word) > LONG_BYTES:
            out[word] = encode_long(vocab, word).astype("<i4").tobytes()
        else:
            buckets[next(w for w in WIDTHS if len(word) <= w)].append(word)
    for width, rows in buckets.items():
        step = MATRIX_CELLS // width
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            for word, ids in zip(part, encode_matrix(vocab, part, width)):
                out[word] = ids.astype("<i4").tobytes()
    return out


class Encoder:
    """Encodes texts; remembers words that came up lately."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        self.vocab, self.pattern = vocab, regex.compile(pattern)
        self.words: dict[bytes, bytes] = {}
        self.first: dict[str, bytes] = {}  # pieces at the start of a text
        self.later: dict[str, bytes] = {}  # pieces that follow a space, which is not written

    def pieces(self, text: str) -> tuple[str, list[str]]:
        """The first piece and the later ones: cuts before a space that follows other text.

        No match of the pattern crosses such a place.
        """
        if _SPACED.search(text):
            cut = _BEFORE_SPACE.split(text)
            return cut[0], [p[1:] for p in cut[1:]]
        head, *rest = text.split(" ")
        if not head and rest:  # the text starts with a space, before which nothing stands
            return " " + rest[0], rest[1:]
        return head, rest

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian 32-bit) of each text."""
        if len(self.later) > CACHE_WORDS or len(self.first) > CACHE_WORDS or len(self.words) > CACHE_WORDS:
            self.words, self.first, self.later = {}, {}, {}
        cut = [self.pieces(t) for t in texts]
        first = {h for h, _ in cut if h not in self.first}
        later = set().union(*(r for _, r in cut)).difference(self.later)
        split = [(self.first, p, [w.encode() for w in self.pattern.findall(p)]) for p in first]
        split += [(self.later, p, [w.encode() for w in self.pattern.findall(" " + p)]) for p in later]
        self.words |= encode_words(self.vocab, list({w for _, _, ws in split for w in ws if w not in self.words}))
        words = self.words
        for cache, piece, ws in split:
            cache[piece] = b"".join([words[w] for w in ws])
        known = self.later
        return [self.first[h] + b"".join([known[p] for p in r]) for h, r in cut]


def _id_lists(rows: list[bytes]) -> pa.Array:
    ends = np.cumsum([0] + [len(r) // 4 for r in rows]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), "<i4")))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary(path), pattern)
        for batch in slices(batches, text_col):
            ids = _id_lists(encoder.encode(texts_of(batch, text_col)))
            yield pa.RecordBatch.from_pydict({id_col: batch.column(id_col), "ids": ids})

    out = T.StructType([docs.schema[id_col], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(id_col, text_col).mapInArrow(run, out)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that the ids stand for in place of the ids' column, ids kept."""
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = vocabulary(path).tokens.__getitem__
        for batch in batches:
            data = [b"".join(map(token, row.values.to_numpy(zero_copy_only=False).tolist())) if row.is_valid else None for row in batch.column(ids_col)]
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in names} | {bytes_col: pa.array(data, pa.binary())})

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(bytes_col, T.BinaryType())]))
