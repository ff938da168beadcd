"""Quality rules for texts: sizes, symbols, repeated lines and suffix-array repetition."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstep.llm.common import WordIds, covered, raw_texts, small_batches
from loomstep.schema import free_names

#: Fields of the struct that measure() makes.
FIELDS = (
    "n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long, "
    "covered_words: long, longest_repeat: long, repeats: array<struct<start: long, length: long>>"
)


@dataclass(frozen=True)
class QualityRules:
    """Limits; repeats count as passages from min_repeat words on.

    max_covered: share of words in repeated passages; max_repeat: words of the longest one.
    """

    min_words: int = 50
    max_repeat_words: float = 0.5
    min_repeat: int = 8
    max_covered: float = 0.3
    max_repeat: int = 100


def suffix_array(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of a sequence of integers and, for each place in it, the longest common prefix with the place before.

    Prefix doubling that sorts again only what is still tied. Equal keys must not reach past the end of the
    sequence, that is, its last key must be unique.
    """
    n = len(keys)
    sa = np.argsort(keys, kind="stable")
    put = lambda order: np.concatenate(([True], order[1:] != order[:-1]))
    heads = put(keys[sa])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    levels = [rank]
    tied = np.flatnonzero(~(heads & np.append(heads[1:], True)))
    k = 1
    while len(tied):
        sub = sa[tied]
        key = rank[sub] * (n + 1) + rank[np.minimum(sub + k, n - 1)]
        order = np.argsort(key, kind="stable")
        sa[tied] = sub = sub[order]
        head = put(key[order])
        rank = rank.copy()
        rank[sub] = tied[np.maximum.accumulate(np.where(head, np.arange(len(sub)), 0))]
        levels.append(rank)
        tied = tied[~(head & np.append(head[1:], True))]
        k *= 2
    lcp = np.zeros(n, np.int64)
    at = np.flatnonzero(np.append(False, levels[0][sa[1:]] == levels[0][sa[:-1]]))
    a, b, both = sa[at - 1].copy(), sa[at].copy(), np.zeros(len(at), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        r = levels[level]
        same = (np.maximum(a, b) < n) & (r[np.minimum(a, n - 1)] == r[np.minimum(b, n - 1)])
        step = np.where(same, 1 << level, 0)
        a, b, both = a + step, b + step, both + step
    lcp[at] = both
    return sa, lcp


def longest_repeats(words: np.ndarray) -> np.ndarray:
    """For each place, the length of the longest passage from there that occurs elsewhere in the sequence too.

    That is the value of the deepest longest-common-prefix interval around the place's suffix. Spans of
    these lengths together cover what all maximal repeated passages cover.
    """
    if not len(words):
        return np.zeros(0, np.int64)
    sa, lcp = suffix_array(words)
    best = np.zeros(len(words), np.int64)
    best[sa] = np.maximum(lcp, np.append(lcp[1:], 0))
    return best


def _measure(texts: list[bytes], min_repeat: int) -> list[tuple]:
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    chars, symbols = np.zeros((2, len(texts)), np.int64)
    full = [i for i, t in enumerate(texts) if t]
    if full:
        data = np.frombuffer(b"".join(texts), np.uint8)
        begin = np.cumsum([0, *(len(texts[i]) for i in full[:-1])])
        for out, lut in ((chars, _WORD), (symbols, _SYMBOL)):
            out[full] = np.add.reduceat(lut[data], begin, dtype=np.int64)
    ids = WordIds()
    n = int(sizes.sum()) + len(texts)
    ends = np.cumsum(sizes + 1) - 1
    keys = np.empty(n, np.int64)
    own = np.ones(n, bool)
    own[ends] = False
    keys[own] = ids.of([w for words in split for w in words])
    # A word counts as the same only within its own text, and each text ends in a key of its own.
    keys[own] += np.repeat(np.arange(len(texts)), sizes) * (len(ids) + 1)
    keys[ends] = np.arange(len(texts)) * (len(ids) + 1) + len(ids)
    best = longest_repeats(keys)
    rows = []
    for i, text in enumerate(texts):
        own = best[ends[i] - sizes[i] : ends[i]]
        three = np.flatnonzero(own >= 3)
        repeat = int(covered(three, np.full(len(three), 3), len(own)).sum()) if len(three) else 0
        long = np.flatnonzero(own >= min_repeat)
        spans, inside, longest = [], 0, 0
        if len(long):
            flags = np.concatenate(([0], covered(long, own[long], len(own)).astype(np.int8), [0]))
            edges = np.flatnonzero(np.diff(flags)).tolist()
            spans = [{"start": a, "length": b - a} for a, b in zip(edges[::2], edges[1::2], strict=True)]
            inside, longest = int(flags.sum()), int(own[long].max())
        lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
        rows.append((int(sizes[i]), int(chars[i]), int(symbols[i]), len(lines) - len(set(lines)), repeat, inside, longest, spans))
    return rows


_BYTES = np.arange(256)
#: 1 for the first byte of each code point that isn't white space.
_WORD = (((_BYTES & 0xC0) != 0x80) & (_BYTES != 32) & ~((_BYTES >= 9) & (_BYTES <= 13))).astype(np.uint8)
_SYMBOL = np.isin(_BYTES, list(b"#*$%&|<>")).astype(np.uint8)


def measure(docs: DataFrame, *, text_col: str = "text", rules: QualityRules = QualityRules(), out: str = "quality") -> DataFrame:
    """docs with a struct of FIELDS about each whole text; all other columns, repeated rows included, stay.

    Null and empty texts have zeros. Lengths of repeats are in words; repeats holds the merged spans
    (first word, number of words) of passages of rules.min_repeat words or more that occur twice in the text.
    A column named like out is replaced, an empty table gives no rows.
    """
    [held] = free_names(docs, "text")
    least = rules.min_repeat
    names = [f.split(":")[0] for f in FIELDS.split(", ")][:8]
    kinds = [pa.int64()] * 7 + [pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))]

    def run(batches):
        for batch in small_batches(batches):
            columns = list(zip(*_measure(raw_texts(batch.column(batch.num_columns - 1)), least), strict=True)) or [[]] * 8
            made = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=[*keep, out])

    keep = [c for c in docs.columns if c != out]
    kept = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").alias(held))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(run, f"{schema}, `{out}` struct<{FIELDS}>")


def base_failed(q: str = "quality", rules: QualityRules = QualityRules()) -> Column:
    few = F.col(f"{q}.n_words") < rules.min_words
    return few | (F.col(f"{q}.n_repeat_words") > F.lit(rules.max_repeat_words) * F.col(f"{q}.n_words"))


def accepted(q: str = "quality", rules: QualityRules = QualityRules()) -> Column:
    """Whether a measured text passes the base rules and the limits on repeated passages."""
    share = F.col(f"{q}.covered_words") <= F.lit(rules.max_covered) * F.col(f"{q}.n_words")
    return ~base_failed(q, rules) & share & (F.col(f"{q}.longest_repeat") <= rules.max_repeat)
