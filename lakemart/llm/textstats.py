"""Counts of a text that quality operators read, in one pass over its bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

SPACES = b"\t\n\x0b\x0c\r "
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_bang", "n_bars", "n_distinct", "n_digits", "n_ended")
#: Words a worker remembers by number; 21 bits each, so that three fit into one key.
WORDS_HELD = 300_000


def repeated(words: np.ndarray) -> int:
    """How many of ``words`` (by number) stand in 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    if words.max() < 1 << 21:
        keys = words[:-2] << 42 | words[1:-1] << 21 | words[2:]
    else:
        pairs = np.unique(words[:-1] << 32 | words[1:], return_inverse=True)[1]
        keys = pairs[:-1] << 32 | words[2:]
    order = keys.argsort(kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    covered = np.zeros(len(words), bool)
    twice = np.concatenate([order[1:][same], order[:-1][same]])
    for k in range(3):
        covered[twice + k] = True
    return int(covered.sum())


class Counter:
    """Counts of one text after another; word numbers are kept between texts."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}

    def counts(self, text: str) -> tuple[int, ...]:
        data = text.encode()
        at = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        words = data.split()
        numbers = self.numbers
        if len(numbers) > WORDS_HELD:
            numbers.clear()
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
        lines = data.split(b"\n")
        seen: set[bytes] = set()
        dup = full = ended = 0
        for line in lines:
            if bare := line.strip():
                full += 1
                ended += bare[-1:] in b".!?"
                if line in seen:
                    dup += 1
                else:
                    seen.add(line)
        chars = int(at.sum() - at[0x80:0xC0].sum()) - int(at[list(SPACES)].sum())
        return (
            len(words), chars, int(at[list(SYMBOLS)].sum()), dup, repeated(ids), full,
            int(at[65:91].sum()), int(at[97:123].sum()), int(at[33]), int(at[124]), len(set(words)), int(at[48:58].sum()), ended,
        )


EMPTY = (0,) * len(COUNTS)


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the ``keep`` columns and a struct ``counts`` for each row; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in slices(batches, text_col):
            rows = [counter.counts(t) if t else EMPTY for t in batch.column(text_col).to_pylist()]
            made = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], list(COUNTS))
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in (id_col, *keep)} | {"counts": made})

    fields = [docs.schema[c] for c in (id_col, *keep)]
    counts = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    return docs.select(id_col, *keep, text_col).mapInArrow(run, T.StructType([*fields, T.StructField("counts", counts)]))


#: Interpretable features: what is counted, over what; ``n_letters`` is upper and lower case together.
RATIOS = {
    "words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "bars_per_word": ("n_bars", "n_words"),
    "bangs_per_word": ("n_bang", "n_words"),
    "digits_per_word": ("n_digits", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "n_letters"),
    "distinct_share": ("n_distinct", "n_words"),
    "ended_line_share": ("n_ended", "n_lines"),
    "words_per_line": ("n_words", "n_lines"),
}


def ratios() -> dict[str, F.Column]:
    """``RATIOS`` over a column ``counts``; 0 where there is nothing to divide by."""

    def count(name: str) -> F.Column:
        return F.col("counts.n_upper") + F.col("counts.n_lower") if name == "n_letters" else F.col(f"counts.{name}")

    def share(over: str, under: str | None) -> F.Column:
        above = count(over).cast("double")
        return above if under is None else F.coalesce(F.try_divide(above, count(under)), F.lit(0.0))

    return {name: share(*parts) for name, parts in RATIOS.items()}


def ratio_arrays(rows: list[tuple[int, ...]]) -> dict[str, np.ndarray]:
    """``RATIOS`` of texts from their ``counts``, as arrays."""
    counts = dict(zip(COUNTS, np.array(rows, float).reshape(-1, len(COUNTS)).T))
    counts["n_letters"] = counts["n_upper"] + counts["n_lower"]

    def share(over: str, under: str | None) -> np.ndarray:
        if under is None:
            return counts[over]
        return np.divide(counts[over], counts[under], out=np.zeros(len(rows)), where=counts[under] > 0)

    return {name: share(*parts) for name, parts in RATIOS.items()}
