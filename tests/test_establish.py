"""Established names against requests applied one after the other."""

import random

import pytest

from grovespark.model import ALIASES, BIT, NODES, SYNONYMS, Taxonomy
from grovespark.operators import establish


def one_by_one(nodes, synonyms, requests):
    nodes = {u: [p, n, f] for u, p, n, _, _, f, _ in nodes}
    names = {(n, u) for u, (_, n, f) in nodes.items() if n} | {(n, u) for u, n, _ in synonyms}
    names = {(n, u) for n, u in names if not nodes[u][2]}

    def bearers(n):
        return {u for m, u in names if m == n}

    def below(u, tops):
        u = nodes[u][0]
        while u:
            if u in tops:
                return True
            u = nodes[u][0]
        return False

    out = {}
    for pos, name, _, parent, ancestor, division, id_, _ in sorted(requests, key=lambda r: r[0]):
        if name is None:
            out[pos] = ("nameless", None)
            continue
        found = at = under = None
        for c in (parent, ancestor, division):
            if c is None:
                continue
            b = bearers(c)
            place = next(iter(b)) if len(b) == 1 else c if not b and c in nodes else None
            if at is None and place:
                at, under = place, c
            hits = [u for u in bearers(name) if below(u, b)]
            if len(hits) == 1 and found is None:
                found = hits[0]
        if id_ in nodes:
            out[pos] = ("conflict", None) if found not in (None, id_) else ("found", id_)
        elif id_ is None and found:
            out[pos] = ("found", found)
        else:
            u = id_ or f"established-{pos}"
            nodes[u] = [at, name, BIT["incertae_sedis"] if at and under != parent else 0]
            names.add((name, u))
            out[pos] = ("created", u)
    return out, {u: (p, n, f) for u, (p, n, f) in nodes.items()}


@pytest.mark.parametrize("seed", [3])
def test_rounds_are_as_one_after_the_other(spark, seed):
    rng = random.Random(seed)
    nodes = [("u0", None, "life", "no rank", [], 0, 0)]
    for i in range(1, 30):
        nodes.append((f"u{i}", rng.choice(nodes)[0], rng.choice(["A", "B", "C", f"N{i}", None]), "genus", [], BIT["merged"] if rng.random() < 0.1 else 0, 0))
    synonyms = [(f"u{rng.randint(1, 29)}", rng.choice(["A", "D"]), "synonym") for _ in range(6)]

    def some(p=0.6):
        return rng.choice(["A", "B", "D", "life", "N3", "N7", "X1", "X2", "X5", "nowhere", "u4", "new-1"]) if rng.random() < p else None

    requests = [(i, rng.choice(["A", f"N{rng.randint(1, 9)}", None if i % 9 == 0 else "X1", *(f"X{k}" for k in range(2, 12))]), rng.choice(["species", None]), some(), some(0.4), some(0.4), rng.choice([None] * 6 + ["u3", "u5", "new-1"]), rng.choice([None, {"prefix": "x", "id": "1"}])) for i in range(36)]
    requests += [(40, None, None, "life", None, None, None, None), (41, "Q", None, "life", None, None, None, None), (42, "Q", None, None, "life", None, "u5", None)]
    tax = Taxonomy(spark.createDataFrame(nodes, NODES), spark.createDataFrame(synonyms, SYNONYMS), spark.createDataFrame([], ALIASES), "t")
    got = establish.establish(tax, spark.createDataFrame(requests, establish.REQUEST))
    want, tree = one_by_one(nodes, synonyms, requests)
    assert {r["pos"]: (r["outcome"], r["uid"]) for r in got.outcomes.collect()} == want
    assert {r["uid"]: (r["parent_uid"], r["name"], r["proper_flags"]) for r in got.tax.nodes.collect()} == tree
    assert {o for o, _ in want.values()} == {"found", "created", "conflict", "nameless"}


def test_no_requests(spark):
    tax = Taxonomy(spark.createDataFrame([("u0", None, "life", "no rank", [], 0, 0)], NODES), spark.createDataFrame([], SYNONYMS), spark.createDataFrame([], ALIASES), "t")
    got = establish.establish(tax, spark.createDataFrame([], establish.REQUEST))
    assert got.outcomes.isEmpty() and got.tax.nodes.count() == 1
