"""Densities and uncertainties of homonyms against all pairs."""

import random
from itertools import combinations

import pytest

from grovespark.model import BIT, NODES, SYNONYMS
from grovespark.operators import homonyms, tree
from grovespark.storage import settle


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    nodes = [("u000", None, "life", "no rank", [], 0, 0)]
    for i in range(1, 140):
        nodes.append((f"u{i:03}", rng.choice(nodes[: 1 + i // 3])[0], rng.choice(["A", "B", "C", "uncultured x", f"N{i}", None]), rng.choice(["species", "no rank", "genus"]), [], BIT["hidden"] if rng.random() < 0.1 else 0, 0))
    synonyms = [(f"u{rng.randint(1, 139):03}", rng.choice(["A", "B", "D"]), "synonym") for _ in range(25)]
    parent, name, rank, hidden = ({n[0]: n[k] for n in nodes} for k in (1, 2, 3, 5))
    kids = {n[1] for n in nodes}

    def path(u):
        return (path(parent[u]) if parent[u] else []) + [u]

    paths = {u: path(u) for u in parent}
    size = {u: sum(u in p for p in paths.values()) for u in paths}
    tip = {u: (u not in kids and not (name[u] or "").startswith("uncultured")) if rank[u] == "no rank" else rank[u] == "species" for u in parent}
    bears = {}
    for u, n in name.items():
        if not hidden[u] and n is not None:
            bears.setdefault(n, {})[u] = 1
    for u, n, _ in synonyms:
        if not hidden[u] and name[u] is not None and name[u] != n:
            bears.setdefault(n, {}).setdefault(u, 0)
    records = []
    for n, own in bears.items():
        for x, y in combinations(sorted(own), 2):
            p, q = paths[x], paths[y]
            c = sum(1 for _ in range(min(len(p), len(q))) if p[: _ + 1] == q[: _ + 1])
            if c < min(len(p), len(q)) and own[x] + own[y]:
                small, large = sorted((p[c], q[c]), key=lambda u: (size[u], u))
                records.append((n, p[c - 1], small, size[small], size[p[c - 1]], own[x] * own[y], int(tip[x] and tip[y])))
    df = spark.createDataFrame(nodes, NODES)
    pathed = settle(tree.with_children(tree.with_path(df)))
    counts = settle(tree.subtree_counts(pathed))
    parted = settle(homonyms.partings(pathed, spark.createDataFrame(synonyms, SYNONYMS), counts))
    width = -(-140 // 20)
    want = [(b, b * width, sum(r[5] for r in records if (r[3] - 1) // width == b), sum((r[3] - 1) // width == b for r in records), sum(r[6] for r in records if (r[3] - 1) // width == b)) for b in range(20)]
    got = homonyms.density(parted, counts, buckets=20, shown=20).orderBy("bucket").collect()
    assert [tuple(r)[:5] for r in got] == want
    assert all((r["sample"] is None) == (r["pairs"] == 0) for r in got)

    tips = [r for r in records if r[6]]
    first = {(r[3], r[4]): sum((-q[3], q[4]) < (-r[3], r[4]) for q in tips) + sum((q[4], -q[3]) < (r[4], -r[3]) for q in tips) for r in tips}
    wanted = {}
    for n, m, c, low, high, _, _ in tips:
        wanted[n, c, m] = wanted.get((n, c, m), 0) + 1
    rows = homonyms.uncertainty(parted).collect()
    assert {(r["name"], r["loser"], r["mrca"]): r["pairs"] for r in rows} == wanted and tips
    assert all(r["doubt"] == first[r["low"], r["high"]] for r in rows) and [r["doubt"] for r in rows] == sorted(r["doubt"] for r in rows)


def test_types_against_all_pairs(spark):
    rng = random.Random(5)
    nodes = [("u000", None, "life", "no rank", [], 0, 0)]
    for i in range(1, 120):
        nodes.append((f"u{i:03}", rng.choice(nodes[: 1 + i // 2])[0], rng.choice(["A", "B", "C", "uncultured x", f"N{i}", None]), "species", [], BIT["hidden"] if rng.random() < 0.1 else 0, 0))
    synonyms = [(f"u{rng.randint(1, 119):03}", rng.choice(["A", "B", "D"]), "synonym") for _ in range(30)]
    parent, name, hidden = ({n[0]: n[k] for n in nodes} for k in (1, 2, 5))
    divisions = {"u000", "u001", "u002", "u003", "u005"}

    def path(u):
        return (path(parent[u]) if parent[u] else []) + [u]

    paths = {u: path(u) for u in parent}
    size = {u: sum(u in p for p in paths.values()) for u in paths}
    division = {u: [x for x in p if x in divisions][-1] for u, p in paths.items()}
    bears = {}
    for u, n in [*name.items(), *((u, n) for u, n, _ in synonyms)]:
        if n is not None and not hidden[u] and not n.startswith("uncultured"):
            bears.setdefault(n, set()).add(u)
    want = {}
    for n, own in bears.items():
        for x, y in combinations(sorted(own), 2):
            p, q = paths[x], paths[y]
            c = sum(p[: i + 1] == q[: i + 1] for i in range(min(len(p), len(q))))
            inner = c == min(len(p), len(q))
            both = 0 if inner else size[p[c]] + size[q[c]]
            mains = (name[x] == n) + (name[y] == n)
            dx, dy = paths[division[x]], paths[division[y]]
            kind = (
                "siblings" if parent[x] == parent[y] else "synonyms" if mains == 0 else "divisions" if dx != dy[: len(dx)] and dy != dx[: len(dy)] else "nested" if inner
                else "lineage" if p[c] == x or q[c] == y else "internal" if size[x] > 2 or size[y] > 2 else "tip-synonym" if mains == 1 else "tip-duplicate" if both < 8 else "tip-suspect" if both < 30 else "tip-true"
            )
            key = (n, p[c - 1], kind)
            want[key] = want.get(key, 0) + 1
    pathed = settle(tree.with_children(tree.with_path(spark.createDataFrame(nodes, NODES))))
    got = homonyms.types(pathed, spark.createDataFrame(synonyms, SYNONYMS), settle(tree.subtree_counts(pathed)), spark.createDataFrame([(u,) for u in divisions], "uid string"), suspect=8, true=30)
    assert {tuple(r)[:3]: r["n"] for r in got.collect()} == want
    assert {k for _, _, k in want} >= {"siblings", "synonyms", "divisions", "nested", "lineage", "internal", "tip-synonym", "tip-duplicate"}
