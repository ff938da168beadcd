"""The class-based language model against brute force, as a distribution, and by held-out perplexity."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loomstep.llm import brown, registry

DOC = "doc_id long, text string"


def corpus(n=120, seed=1):
    """Sentences of a small grammar, so that classes tell what comes next."""
    r = random.Random(seed)
    kinds = [[f"{p}{i}" for i in range(12)] for p in ("det", "noun", "verb", "adv")]
    texts = [" ".join(r.choice(kinds[j % 4]) for j in range(r.randint(0, 60))) for _ in range(n)]
    return [*texts, None, "", " \n", "DET1 Noun2\x0bVERB3", "unseen-é word", "x" * 200 + " noun1 " + "y" * 70]


def out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def split(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [""]


def brute(model, docs, train):
    """The rows' scores by the definition, from the model's classes alone: all counts are taken again."""
    counts, k = Counter(w for t in train for w in split(t)), len(model.table)
    rank = {w.decode(): i for i, w in enumerate(model.frequent)}
    n, v = sum(counts.values()), len(counts)
    kind = lambda w: rank[w] if rank.get(w, model.own) < model.own else model.own + zlib.crc32(w.encode()[-3:]) % brown.ENDINGS
    cls = lambda w: int(model.classes[kind(w)])
    after, size, single = np.zeros((k, k)), np.zeros(k), np.zeros(k)
    for t in train:
        for a, b in zip(["", *split(t)], split(t), strict=False):
            after[cls(a), cls(b)] += 1
            size[cls(b)] += 1
    for w, c in counts.items():
        single[cls(w)] += c == 1
    share = (size + 1) / (size.sum() + k)

    def word(before, w):
        a, b = cls(before), cls(w)
        p = (after[a, b] + k * share[b]) / (after[a].sum() + k)
        return p * (counts[w] or single[b] + 1) / (size[b] + single[b] + 1)

    rows = []
    for i, t in docs:
        ws = split(t)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        rows.append((i, len(ws), sum(counts[w] > 0 for w in ws), base, sum(math.log10(word(a, b)) for a, b in zip(["", *ws], ws, strict=False))))
    known = {w: cls(w) for w in counts}
    for before in ("", "noun1", "unseen"):  # all known words, and an unknown one of each class, have the whole probability
        ends = sum((after[cls(before), c] + k * share[c]) / (after[cls(before)].sum() + k) * (single[c] + 1) / (size[c] + single[c] + 1) for c in range(k))
        assert sum(word(before, w) for w in known) + ends == pytest.approx(1)
    return rows


@pytest.mark.parametrize(("frequent", "own"), [(1 << 18, 1 << 14), (20, 9), (0, 0)])
def test_scores(spark, frequent, own):
    given = [(None if i == 5 else i % 100, t) for i, t in enumerate(corpus())]
    train = [t for i, t in given if not out(i)]
    df = spark.createDataFrame([(*r, "clash") for r in given], DOC + ", words string").repartition(3)
    model = brown.fit(df.where(~brown.held_out(df["doc_id"])), n_classes=6, rounds=2, own_types=own, frequent=frequent)
    assert model.n_tokens == sum(len(split(t)) for t in train) and len(model.frequent) <= frequent
    got = sorted((tuple(r) for r in brown.score(df, model).collect()), key=str)
    for g, w in zip(got, sorted(brute(model, given, train), key=str), strict=True):
        assert g[:3] == w[:3] and g[3:] == (pytest.approx(w[3]), pytest.approx(w[4]))


def test_exchange_raises_the_likelihood(spark):
    """Words of the grammar's four kinds come to lie in classes of their own but for a few, and held-out texts become less surprising."""
    given = list(enumerate(corpus(400)[:400]))
    df = spark.createDataFrame(given, DOC)
    train = df.where(~brown.held_out(df["doc_id"]))
    first, model = (brown.fit(train, n_classes=8, rounds=n) for n in (0, 4))
    assert brown.likelihood(model.table) > brown.likelihood(first.table) and model.table.sum() == first.table.sum() == model.n_tokens
    of = {w.decode(): model.classes[i] for i, w in enumerate(model.frequent)}
    kinds = Counter((of[f"{p}{i}"], p) for p in ("det", "noun", "verb", "adv") for i in range(12))
    assert sum(max(n for (c, _), n in kinds.items() if c == own) for own in {c for c, _ in kinds}) >= 44  # of 48
    scores = [r for r in brown.score(df, model).collect() if out(r["doc_id"])]
    assert sum(r["score"] for r in scores) > 0.8 * sum(r["base_score"] for r in scores)


def test_exchange_by_hand():
    """One move at a time, as the likelihood of the whole table has it."""
    r = np.random.default_rng(4)
    pairs = r.integers(0, 5, (9, 9))
    classes = np.arange(9) % 3

    def table(classes):
        t = np.zeros((3, 3))
        np.add.at(t, (classes[:, None], classes[None, :]), pairs)
        return t

    # Counts before and after must agree, as they do in texts.
    pairs += pairs.T
    order = list(range(9))
    want = classes.copy()
    for k in order:
        options = [brown.likelihood(table(np.where(np.arange(9) == k, c, want))) for c in range(3)]
        if max(options) > options[want[k]] + 1e-9:
            want[k] = int(np.argmax(options))

    def vectors():
        for k in order:
            left, right, now = np.zeros(3), np.zeros(3), dict(moved)
            for j in range(9):
                if j != k:
                    left[now.get(j, classes[j])] += pairs[j, k]
                    right[now.get(j, classes[j])] += pairs[k, j]
            yield k, int(classes[k]), left, right, float(pairs[k, k])

    moved = []
    for found in brown.exchange(vectors(), table(classes)):
        moved.append(found)
    assert [c for _, c in moved] == want.tolist()


def test_odd_tables(spark):
    empty = spark.createDataFrame([], DOC)
    df = spark.createDataFrame([(1, "a b"), (2, None)], DOC)
    model = brown.fit(empty, n_classes=3)
    assert model.n_tokens == 0 and [(r["n_known"], r["base_score"]) for r in brown.score(df, model).collect()] == [(0, 0.0)] * 2
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in brown.score(df, model).collect())
    assert brown.score(empty, brown.fit(df, n_classes=3)).count() == 0


def test_query(spark):
    rows = registry.op11_class_lm(spark, "/root/testdata/sf0.001").collect()
    assert all(r["held_out"] == out(r["doc_id"]) for r in rows)
    assert {r["train_tokens"] for r in rows} == {sum(r["n_tokens"] for r in rows if not r["held_out"])}
    assert all(r["n_known"] == r["n_tokens"] for r in rows if not r["held_out"])
    own = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in own) > sum(r["base_score"] for r in own)
