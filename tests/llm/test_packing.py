"""Packing: ids against the tokenizer itself, plans against a fit one by one, gapless sequences."""

import random
import zlib

import numpy as np
import pytest

from loomstep.llm import packing
from loomstep.llm.registry import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")
TEXTS = [
    "The quick, brown fox. It's 12.5% of THE ÉTÉ!", "", None, "a<|endoftext|>b <|EndOfText|> x.", "é́ Ω, ΑΣ. word.,x ..,", "İstanbul. don't, we've.",
    "\x85 wide\tspace\n\n", "zz " * 9000, "x" * 300, "naïve. é, 日本語, 12, a1. b2,",
]


def test_ids_are_the_tokenizers(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PATH)
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    got: dict = {}
    for r in packing.tokenize_pieces(docs, PATH, with_ids=True).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(TEXTS):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        parts = sorted(got[i], key=lambda r: r["piece"])
        assert [x for r in parts for x in r["ids"]] == ids
        assert [r["start"] for r in parts] == list(range(0, len(ids), 4096))
        assert all(r["ids_crc32"] == zlib.crc32(np.asarray(r["ids"], "<u4").tobytes()) for r in parts)


def test_words_are_encoded_as_by_the_tokenizer():
    from tokenizers import Tokenizer

    tok, r, words = Tokenizer.from_file(PATH), random.Random(4), set()
    for _ in range(4000):
        words.update("".join(r.choice("abzéßñ'sştrevmd.,<|>&0123½²ªµAÉİŉſǆ́\x85\xa0·") for _ in range(r.randint(1, 9))).encode().lower().split())
    with open(PATH, encoding="utf-8") as f:
        known = packing.WordIds(f.read(), most=1000)
    words = sorted(words)
    for i in range(0, len(words), 500):
        known.learn(set(words[i : i + 500]).difference(known.of))
        for w in words[i : i + 500]:
            assert known.of[w] == np.asarray(tok.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes(), w
        known.shrink()


def best_fit(lengths, capacity):
    gaps = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= x]
        if fits:
            gaps[min(fits, key=lambda i: gaps[i])] -= x
        else:
            gaps.append(capacity - x)
    return len(gaps)


@pytest.mark.parametrize("seed", range(12))
def test_plan_against_best_fit(seed):
    r = random.Random(seed)
    lengths = [min(60, int(r.expovariate(1 / r.choice([5, 20, 40]))) + 1) for _ in range(r.randint(0, 400))]
    counts = {x: lengths.count(x) for x in set(lengths)}
    bins = packing.plan_bins(counts, 60)
    assert all(sum(size * k for size, _, k, _ in b.slots) <= 60 for b in bins)
    assert {x: sum(b.n * k for b in bins for size, _, k, _ in b.slots if size == x) for x in counts} == counts
    assert sum(b.n for b in bins) <= best_fit(lengths, 60)


def test_sequences_have_no_gaps(spark):
    r = random.Random(3)
    rows = [(i % 40, 0, 0, r.choice([1, 1, 1, 700, 2000, 4096, r.randint(1, 4096)]), 5) for i in range(300)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    runs = [sorted(map(tuple, packing.pack(p).collect())) for p in (pieces, pieces.repartition(3))]
    assert runs[0] == runs[1] and len(runs[0]) == 300
    by: dict = {}
    for row in runs[0]:
        by.setdefault(row[5], []).append((row[6], row[3]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(pieces.limit(0)).count() == 0
