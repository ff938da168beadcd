"""Alignment of two tokenizers against whole encodings and ranges of bytes compared one by one."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstep.llm import alignment, registry
from loomstep.llm.registry import tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
DOC = "doc_id long, text string"
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "  two  blanks ", "a\nb\n c \n\n d", "tab\tand space", "▁", "a▁b c", "x ▁ y", "<|endoftext|> is <0x41> <s></s> text",
    "don't we'll I'M", "１２３ ﬁ ½", "日本語のテキスト です", "🙂👍🏽 emoji ok", "é é", " line", "\x00nul \x7f", "w" * 300 + " " + "ab" * 100 + " end",
    "same same same same", "1234567 12 3 4,567.89", "-- ++ == !!", "​ zero ﻿ bom", " " * 9 + "x" + " " * 9,
]


@pytest.fixture(scope="module")
def tokens():
    with open(tokenizer_path(A), encoding="utf-8") as f, open(tokenizer_path(B), "rb") as g:
        return alignment.Tokens(f.read(), g.read())


def brute(tokens, text):
    """(a ids, b ids, groups, links) from the encodings of the whole text."""
    if not text:
        return [], [], [], []
    a = tokens.a_model.encode(" " + text, add_special_tokens=False).ids
    b = tokens.b_model.encode(text)
    parts = [[tokens.a_bytes[i] for i in a], [tokens.b_bytes[i] for i in b]]
    if not b"".join(parts[0]) == b"".join(parts[1]) == (" " + text).encode():
        return [], [], [], []
    spans = []
    for p in parts:
        ends = np.cumsum([len(x) for x in p]).tolist()
        spans.append(list(zip([0, *ends[:-1]], ends)))
    links = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups, low = [], 0
    for cut in cuts:
        groups.append(tuple([ids[i] for i, (s, e) in enumerate(sp) if low <= s and e <= cut] for ids, sp in zip((a, b), spans)))
        low = cut
    return a, b, groups, [(a[i], b[j]) for i, j in links]


def texts(n=150, seed=3):
    r = random.Random(seed)
    alphabet = [*"abcdeABC   \n\t.,'!-_0123456789", "é", "ß", "ñ", "日", "🙂", "▁", "  ", " the", " and", "ing", " ", "̀"]
    return ODD + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 80))) for _ in range(n)] + [" ".join(r.choice(["the", "cat", "Katze", "running", "x1"]) for _ in range(r.randint(1, 400))) for _ in range(10)]


def shown(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


@pytest.mark.parametrize("lane", [1, 3, 64])
def test_align(tokens, monkeypatch, lane):
    monkeypatch.setattr(alignment, "LANE", lane)
    given = texts()
    got = alignment.align(tokens, given)
    for i, text in enumerate(given):
        a, b, groups, links = brute(tokens, text)
        assert (got.n_a[i], got.n_b[i], got.n_groups[i], got.n_links[i]) == (len(a), len(b), len(groups), len(links)), repr(text)
        assert got.groups[i].decode() == shown(groups), repr(text)
        at = slice(got.pairs_at[i], got.pairs_at[i + 1])
        assert dict(zip(got.pairs[at].tolist(), got.times[at].tolist())) == Counter(x << 15 | y for x, y in links)
    assert sum(got.n_a > 0) > 80
    empty = alignment.align(tokens, [])
    assert len(empty.n_a) == 0 and empty.groups == []


def test_words_join_to_the_text():
    for text in texts(400, 5):
        if text:
            assert " ".join(alignment.words_of(text)) == text


@pytest.mark.parametrize("frequent", [0, 7, 1 << 18])
def test_scores(spark, tokens, frequent):
    """Counts are by document, whichever of them are broadcast; rows that repeat count as often."""
    given = texts(40) + ["the cat", "the cat"]
    df = spark.createDataFrame([(None if i == 3 else i % 60, t, "clash") for i, t in enumerate(given)], DOC + ", pairs string").repartition(3)
    done = alignment.score_links(alignment.align_documents(df, tokenizer_path(A), tokenizer_path(B)), frequent=frequent)
    want, per_doc = Counter(), [brute(tokens, t) for t in given]
    for *_, links in per_doc:
        want.update(set(links))
    most = defaultdict(int)
    for (a, _), n in want.items():
        most[a] = max(most[a], n)
    rows = [
        (None if i == 3 else i % 60, len(a), len(b), len(g), len(k), sum(want[x] == most[x[0]] for x in k), sum(want[x] for x in k), hashlib.sha256(shown(g).encode()).hexdigest() if a else "")
        for i, (a, b, g, k) in enumerate(per_doc)
    ]
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted((tuple(r[c] for c in names) for r in done.collect()), key=str) == sorted(rows, key=str)
    assert alignment.score_links(alignment.align_documents(df.limit(0), tokenizer_path(A), tokenizer_path(B))).count() == 0


def test_query(spark, tokens):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in registry.op12_token_alignment(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy(F.length("text")).limit(25).collect()
    for d in docs:
        a, b, groups, links = brute(tokens, d["text"])
        r = got[d["doc_id"]]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (len(a), len(b), len(groups), len(links))
        assert r["groups_sha256"] == hashlib.sha256(shown(groups).encode()).hexdigest()
