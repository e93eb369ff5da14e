"""Alignment by groups of candidates against the same heuristics over all pairs, on forests full of homonyms."""

import random

import pytest
from pyspark.sql import functions as F

from grovespark.model import ALIASES, NODES, SYNONYMS, Taxonomy
from grovespark.operators import align, tree
from grovespark.storage import settle


def forest(spark, rng, prefix, n, divisions):
    """A forest with few names, three divisions, shared ids and synonyms."""
    nodes = [(f"{prefix}0", None, "life", "no rank", [], 0, 0)] + [(d, f"{prefix}0", d, "phylum", [], 0, 0) for d in divisions]
    open_, synonyms = [x[0] for x in nodes[1:]], []
    for i in range(1, n):
        uid = f"{prefix}{i}"
        inner = rng.random() < 0.3
        ids = [{"prefix": "x", "id": str(rng.randint(0, 2 * n))} for _ in range(rng.choice([0, 0, 1, 2]))]
        name = rng.choice(["Aus", "Bus", "Cus"]) if inner else f"{rng.choice(['Aus', 'Bus'])} {rng.choice(['ruba', 'rubus', 'minor', 'major'])}"
        nodes.append((uid, rng.choice(open_), name, rng.choice(["genus", "family", "no rank"]) if inner else "species", ids, 0, 0))
        if inner:
            open_.append(uid)
        if rng.random() < 0.15:
            synonyms.append((uid, rng.choice(["Bus minor", "Cus", "Dus albus"]), "synonym"))
    return Taxonomy(spark.createDataFrame(nodes, NODES), spark.createDataFrame(synonyms, SYNONYMS), spark.createDataFrame([], ALIASES), prefix)


def by_pairs(src, tgt, divisions):
    """The plain form: every pair of a name is scored."""
    sp, tp = settle(tree.with_children(tree.with_path(src.nodes))), settle(tree.with_children(tree.with_path(tgt.nodes)))
    pairs = settle(align.candidates(src, tgt).select("src", "tgt"))
    si, ti = settle(align.described(sp, tgt, divisions, "s")), settle(align.described(tp, src, divisions, "t"))
    ctx = {"src_idspace": src.idspace, "tgt_idspace": tgt.idspace, "overlap": False}
    first = settle(align.eliminate(align.scored(pairs, si, ti, ctx)))
    low = settle(align.quasi_tips(sp, first))
    above = settle(sp.join(low.select(F.col("src").alias("uid")), "uid", "left_semi").select(F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("src")).distinct())
    again = pairs.join(above, "src", "left_semi")
    ctx["overlap"] = settle(align.overlaps(sp, tp, low, again))
    scores = settle(align.scored(again, si, ti, ctx))
    return first.join(above, "src", "left_anti").union(align.eliminate(scores)), align.scored(pairs, si, ti, ctx | {"overlap": False}).join(above, "src", "left_anti").union(scores)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_decide_as_pairs_do(spark, seed):
    rng = random.Random(seed)
    src, tgt = forest(spark, rng, "s", 90, ["Plantae", "Animalia"]), forest(spark, rng, "t", 120, ["Plantae", "Animalia", "Fungi"])
    both = spark.createDataFrame([(d, ["life", d]) for d in ("Plantae", "Animalia", "Fungi")], "uid string, path array<string>")
    keep = ("src", "tgt", "value", "reason", "n_first", "n_left")
    got = {r["src"]: r for r in align.align(src, tgt, divisions=both).collect()}
    decided, all_scores = by_pairs(src, tgt, both)
    want = {r["src"]: r for r in decided.collect()}
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert [got[k][c] for c in keep] == [r[c] for c in keep]
        assert [(x["heuristic"], x["score"], x["before"], x["after"], x["loser"] is None) for x in got[k]["rounds"]] == [(x["heuristic"], x["score"], x["before"], x["after"], x["loser"] is None) for x in r["rounds"]]
    # Whoever is named as a loser lost that round in the plain form.
    scores = {(r["src"], r["low"]): r for r in all_scores.collect()}
    for k, r in got.items():
        for x in r["rounds"]:
            if x["loser"]:
                i = [label for label, _ in align.CRITERIA].index(x["heuristic"])
                assert scores[k, x["loser"]][f"s{i}"] < x["score"] or x["score"] < 0
    assert len({r["reason"] for r in want.values()}) >= 6, {r["reason"] for r in want.values()}


def test_choices_and_evidence(spark):
    rng = random.Random(4)
    src, tgt = forest(spark, rng, "s", 40, ["Plantae"]), forest(spark, rng, "t", 50, ["Plantae"])
    answers = settle(align.align(src, tgt))
    rows = {r["src"]: r for r in answers.collect()}
    made = align.choices(answers).collect()
    assert {r["src"] for r in made} == {k for k, r in rows.items() if any(x["before"] > 1 and x["after"] == 1 for x in r["rounds"])} and made
    assert all(r["winner"] == rows[r["src"]]["tgt"] and r["loser"] not in (None, r["winner"]) for r in made)
    told = align.evidence(answers, src.nodes.select("uid", "name"), spark.createDataFrame([("life",)], "name string")).collect()
    assert {r["src"] for r in told} == {k for k, r in rows.items() if r["n_first"] > 1 or r["value"] < 0 or k == "s0"}
    for k in {r["src"] for r in told}:
        assert [r["heuristic"] for r in sorted((r for r in told if r["src"] == k), key=lambda r: r["nth"])] == [x["heuristic"] for x in rows[k]["rounds"]]
