"""Reply trees: ranks, ties, odd links, and that branches which aren't chosen are never enumerated."""

import random

from loomstep.llm import chats

SCHEMA = "tree long, node long, parent long, score double"


def brute(rows, best):
    trees = {}
    for t, n, p, s in rows:
        if t is not None and n is not None:
            trees.setdefault(t, {})[n] = (p, s or 0.0)
    out = []
    for t, nodes in trees.items():
        inner = {p for p, _ in nodes.values()}
        found = []
        for leaf in set(nodes) - inner:
            path = [leaf]
            while nodes[path[-1]][0] in nodes and len(path) <= len(nodes):
                path.append(nodes[path[-1]][0])
            if len(path) <= len(nodes):
                found.append((sum(nodes[n][1] for n in path), leaf, path[::-1]))
        found.sort(key=lambda x: (-x[0], x[1]))
        out += [(t, leaf, n, d, s) for s, leaf, path in found[:best] for d, n in enumerate(path)]
    return sorted(out)


def test_paths(spark):
    r = random.Random(6)
    rows = []
    for t in range(12):
        for n in range(r.randint(1, 40)):
            rows.append((t, n, r.choice([None, n - 1, r.randint(0, max(n - 1, 0)), 99]) if n else None, r.choice([None, 0.0, 1.0, 0.5])))
    rows += [(50, 1, 2, 1.0), (50, 2, 1, 1.0), (50, 3, 2, 1.0), (51, 7, None, None), (None, 1, None, 1.0), (52, None, 1, 1.0), (53, 4, 4, 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for best in (None, 1, 3):
        assert sorted(tuple(x) for x in chats.paths(df, best=best).collect()) == brute(rows, best)
    assert chats.paths(df.limit(0), best=1).count() == 0


def test_bushy_trees_are_ranked_first(spark, monkeypatch):
    """A chain of 64 with 300 leaves at its end: with one branch kept, no table has the 19,500 rows of all branches."""
    rows = [(0, i, i - 1 if i else None, 0.0) for i in range(64)] + [(0, 1000 + i, 63, float(i % 7)) for i in range(300)]
    sizes, plain = [], chats.materialize
    monkeypatch.setattr(chats, "materialize", lambda df, name="part": (sizes.append(df.count()), plain(df, name))[1])
    got = chats.paths(spark.createDataFrame(rows, SCHEMA), best=1).collect()
    assert len(got) == 65 and {x["leaf"] for x in got} == {1006} and {x["score"] for x in got} == {6.0}
    assert max(sizes) <= 364
