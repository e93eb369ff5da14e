"""Golden merges: all cases are one forest, with names made distinct by the case's number."""

import re

from pyspark.sql import functions as F

from grovespark.model import BIT, FORMER_CONTAINER, taxonomy
from grovespark.operators import align, merge, tree
from grovespark.sources import newick
from grovespark.storage import settle

CASES = [
    ("(a,b)c", "(b,e)c", "(a,b,e)c"),
    ("((a,b)x,(c,d)y)z", "(a,b,c,d)z", "((a,b)x,(c,d)y)z"),
    ("(a,b,c,d)z", "((a,b)ab,c,d)z", "((a,b)ab,c,d)z"),
    ("(a,b,c,d)z", "((a,b)x,(c,d)y)z", "((a,b)x,(c,d)y)z"),
    ("((a,b)x,(c,d,e)y)z", "(a,b,c,d)z", "((a,b)x,(c,d,e)y)z"),
    ("((a,b)x,(c,d)y)z", "(a,b,c,d,e)z", "(e,(a,b)x,(c,d)y)z"),
    ("(a,b,c,d)z", "((a,b)x,(c,d,e)y)z", "((a,b)x,(c,d,e)y)z"),
    ("(a,b,c,d,e)z", "((a,b)x,(c,d)y)z", "(a,b,c,d,e)z"),
    ("(((a)b)c)d", "(((a)w)c)d", "(((a)b)c)d"),
]


def numbered(text, i):
    return re.sub(r"([a-z]+)", rf"\g<1>{i}", text)


def forest(spark, texts, idspace):
    nodes = newick.read(spark.createDataFrame([(f"{idspace}{i}", numbered(t, i)) for i, t in enumerate(texts)], "tree_id string, newick string"))
    return taxonomy(settle(nodes), idspace=idspace)


def by_name(source, target):
    """Names are unique here, so equal names are the alignment."""
    t = target.nodes.select(F.col("uid").alias("tgt"), "name")
    return settle(source.nodes.join(t, "name").select(F.col("uid").alias("src"), "tgt", F.lit(3).alias("value")))


def edges(nodes):
    by = {r["uid"]: r for r in nodes.collect()}
    return {(r["name"], by[r["parent_uid"]]["name"] if r["parent_uid"] else None) for r in by.values() if not r["proper_flags"] & FORMER_CONTAINER}


def test_golden_merges(spark):
    target, source = forest(spark, [c[0] for c in CASES], "t"), forest(spark, [c[1] for c in CASES], "s")
    got = merge.merge(source, target, by_name(source, target))
    want = forest(spark, [c[2] for c in CASES], "w")
    assert edges(got.union.nodes) == edges(want.nodes)
    dead = {(r["name"], r["proper_flags"]) for r in got.union.nodes.where(F.col("proper_flags") != 0).collect()}
    assert dead == {("x7", BIT["merged"]), ("y7", BIT["merged"]), ("w8", BIT["merged"])}
    names = {r["uid"]: r["name"] for f in (source.nodes, got.union.nodes) for r in f.collect()}
    rows = [[names.get(v, v) for v in r] for r in got.conflicts.collect()]
    # The only inconsistent node has no placed pair under one clade below the sink.
    assert [r[0] for r in rows] == [names[r["src"]] for r in got.fates.where("fate = 'reject/inconsistent'").collect()]
    assert {r["problem"]: r["n"] for r in tree.integrity(got.union).collect()} == {"missing parent": 0, "repeated id": 0, "no path to a root": 0, "synonym without node": 0}


def test_align_by_name_and_lineage(spark):
    target = forest(spark, ["((a,b)x,(c,d)y)z"], "t")
    source = forest(spark, ["((a,b)x,(c,d)y)z"], "s")
    names = {r["uid"]: r["name"] for r in target.nodes.union(source.nodes).collect()}
    got = align.align(source, target).where("value > 0").collect()
    assert len(got) == 7 and all(names[r["src"]] == names[r["tgt"]] for r in got)


def test_newick_round_trip(spark):
    text = "((a,'b c')x,(d,'it''s')'y (1)')z;"
    nodes = newick.read(spark.createDataFrame([("1", text)], "tree_id string, newick string"))
    assert newick.write(nodes).first()["newick"] == text


def test_conflict_rows_name_both_witnesses(spark):
    target, source = forest(spark, ["(((a,b)x,(c,d)y)z,w)u"], "t"), forest(spark, ["(((a,c,new)p,(b,d)q)z,w)u"], "s")
    got = merge.merge(source, target, by_name(source, target))
    names = {r["uid"]: r["name"] for f in (source.nodes, got.union.nodes) for r in f.collect()}
    rows = {tuple(names.get(v, v) for v in r) for r in got.conflicts.collect()}
    # p and q hold children of both x and y; what p adds goes unplaced under their common clade.
    assert rows == {
        ("p0", "a0", "a0", "x0", "x0", "c0", "c0", "y0", "y0", "z0", "z0", 1, 2, True),
        ("q0", "b0", "b0", "x0", "x0", "d0", "d0", "y0", "y0", "z0", "z0", 1, 2, True),
    }
