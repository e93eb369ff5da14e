"""Divisions: the skeleton in a union, divisions of sources by name, and alignment in them."""

from grovespark.model import ALIASES, NODES, SYNONYMS, Taxonomy
from grovespark.operators import align, divisions


def tax(spark, idspace, rows, synonyms=()):
    nodes = [(u, p, n, r, [], 0, 0) for u, p, n, r in rows]
    return Taxonomy(spark.createDataFrame(nodes, NODES), spark.createDataFrame(list(synonyms), SYNONYMS), spark.createDataFrame([], ALIASES), idspace)


SKELETON = [("1", None, "life"), ("2", "1", "Plantae"), ("3", "1", "Animalia"), ("4", "3", "Insecta"), ("5", "1", "Viruses"), ("6", "1", None)]


def test_homonyms_in_two_divisions_are_kept_apart(spark):
    nodes = spark.createDataFrame(SKELETON, "uid string, parent_uid string, name string")
    target = tax(spark, "t", [("t1", None, "life", "no rank"), ("t2", "t1", "Plantae", "kingdom"), ("t3", "t1", "Animalia", "kingdom"), ("t4", "t3", "Insecta", "class"), ("ta", "t2", "Aus", "genus"), ("tb", "t3", "Bus", "genus"), ("tc", "t4", "Cus", "genus"), ("td", "t4", "Dus", "genus"), ("tD", "t3", "Dus", "genus")])
    images = spark.createDataFrame([("1", "t1"), ("2", "t2"), ("3", "t3"), ("4", "t4"), ("5", "gone")], "src string, tgt string")
    # Metazoa is Animalia by a synonym; there are two Insecta of one depth, so none is a division; the genus Plantae is none.
    source = tax(spark, "s", [("s1", None, "life", "no rank"), ("s2", "s1", "Plantae", None), ("s3", "s1", "Metazoa", "kingdom"), ("s5", "s1", "Viruses", "no rank"), ("sp", "s1", "Plantae", "genus"), ("i1", "s3", "Insecta", "class"), ("i2", "s3", "Insecta", "class"), ("sa", "s3", "Aus", "genus"), ("sA", "s2", "Aus", "genus"), ("sb", "s2", "Bus", "genus"), ("sd", "s3", "Dus", "genus")], [("s3", "Animalia", "synonym")])
    skel = divisions.skeleton(nodes, images)
    assert {r["name"]: r["path"] for r in skel.nodes.collect()}["Insecta"] == ["1", "3", "4"] and skel.nodes.count() == 5
    got = {r["src"]: (r["tgt"], r["value"], r["reason"]) for r in align.align(source, target, skeleton=skel).collect()}
    assert {k: got[k] for k in ("s1", "s2", "s3")} == {"s1": ("t1", 3, divisions.BY_DIVISION), "s2": ("t2", 3, divisions.BY_DIVISION), "s3": ("t3", 3, divisions.BY_DIVISION)}
    assert got["sa"] == (None, -3, "rejected") and got["sb"] == (None, -3, "rejected") and got["sA"][:2] == ("ta", 3)
    assert got["sd"][0] == "tD" and "s5" not in got and got["i1"][2] != divisions.BY_DIVISION


def test_a_skeleton_in_a_union_that_has_nodes(spark):
    nodes = spark.createDataFrame(SKELETON[:4], "uid string, parent_uid string, name string")
    union = tax(spark, "u", [("u1", None, "life", "no rank"), ("u3", "u1", "Animalia", "kingdom"), ("ua", "u3", "Aus", "genus")])
    out, skel = divisions.set_skeleton(union, nodes)
    rows = {r["name"]: r for r in out.nodes.where("name IS NOT NULL").collect()}
    images = {r["src"]: r["tgt"] for r in skel.images.collect()}
    assert images["1"] == "u1" and images["3"] == "u3" and images["2"] == rows["Plantae"]["uid"]
    assert rows["Plantae"]["parent_uid"] == "u1" and rows["Insecta"]["parent_uid"] == "u3" and rows["Aus"]["parent_uid"] == "u3"
    assert all(not r["source_ids"] for r in rows.values())


def test_divisions_by_hand(spark):
    nodes = spark.createDataFrame([("1", "life"), ("2", "Plantae"), ("3", "Plantae"), ("4", "Fungi")], "uid string, name string")
    images = spark.createDataFrame([("1", "a")], "src string, tgt string")
    asked = spark.createDataFrame([("x", "Fungi"), ("x", "Fungi"), ("a", "Fungi"), ("a", "life"), ("b", "Plantae"), ("c", None), ("d", "Fungi"), ("d", "life")], "uid string, name string")
    out, problems = divisions.set_division(images, nodes, asked)
    assert {tuple(r) for r in out.collect()} == {("1", "a"), ("4", "x")}
    assert {tuple(r) for r in problems.collect()} == {("a", "Fungi", "conflict"), ("a", "life", "conflict"), ("b", "Plantae", "unrecognized"), ("c", None, "unrecognized"), ("d", "Fungi", "conflict"), ("d", "life", "conflict")}
