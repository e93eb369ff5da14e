"""Nested study trees."""

import json

from grovespark.sources import studies


def doc(nodes, edges, root, otus, **more):
    by = {}
    for i, (a, b) in enumerate(edges):
        by.setdefault(a, {})[f"e{i}"] = {"@source": a, "@target": b}
    tree = {"nodeById": nodes, "edgeBySourceId": by, "^ot:rootNodeId": root} | more
    return json.dumps({"nexml": {"otusById": {"g": {"otuById": otus}}, "treesById": {"ts": {"treeById": {"t": tree}}}}})


def test_trees_of_several_documents(spark):
    nodes = {"r": {"@root": True}, "i": {}, "a": {"@otu": "o1"}, "b": {"@otu": "o2", "^ot:isTaxonExemplar": False}, "c": {"@otu": "o3", "^ot:isTaxonExemplar": True}, "d": {}, "lost": {"@otu": "o1"}}
    otus = {"o1": {"^ot:originalLabel": "A a", "^ot:ottId": 11}, "o2": {"^ot:originalLabel": "A a", "^ot:ottId": 12}, "o3": {"^ot:originalLabel": None, "^ot:ottId": 13}}
    texts = [
        ("s1", doc(nodes, [("r", "i"), ("r", "d"), ("i", "a"), ("i", "b"), ("i", "c")], "r", otus, **{"^ot:inGroupClade": "i", "^ot:specifiedRoot": "i"})),
        ("s2", doc({"r": {}}, [], "", {})), ("s3", doc({"x": {"@otu": "none"}}, [], "x", {}, **{"^ot:inGroupClade": ""})), ("s4", doc({"x": {}}, [], "gone", {})), ("s5", "{oops"), ("s6", None), ("s7", "{}"),
        ("s8", doc({"x": {}, "y": {"@otu": "o1"}}, [("x", "y"), ("y", "x")], "x", otus)),
    ]
    got = studies.read(spark.createDataFrame(texts, "study string, json string"))
    rows = {(r["uid"], r["parent_uid"], r["name"], tuple((q["prefix"], q["id"]) for q in r["source_ids"])) for r in got.nodes.collect()}
    assert rows == {
        ("s1/t/r", None, None, ()), ("s1/t/i", "s1/t/r", None, ()), ("s1/t/d", "s1/t/r", None, ()), ("s1/t/a", "s1/t/i", "A a", (("ott", "11"),)), ("s1/t/b", "s1/t/i", "A a", ()), ("s1/t/c", "s1/t/i", None, (("ott", "13"),)),
        ("s3/t/x", None, None, ()), ("s8/t/x", None, None, ()), ("s8/t/y", "s8/t/x", "A a", (("ott", "11"),)),
    }
    assert {tuple(r) for r in got.trees.collect()} == {("s1", "t", "s1/t/r", "s1/t/i"), ("s3", "t", "s3/t/x", None), ("s8", "t", "s8/t/x", None)}
    assert {tuple(r) for r in got.problems.collect()} == {
        ("s1", "t", "d", "tip without OTU"), ("s1", "t", "c", "tip without label"), ("s1", "t", None, "specified root is not the root"), ("s2", "t", None, "no root"), ("s3", "t", "x", "OTU not found"),
        ("s4", "t", None, "root not found"), ("s5", None, None, "no JSON"), ("s6", None, None, "no JSON"),
    }


def test_no_document(spark):
    got = studies.read(spark.createDataFrame([], "study string, json string"))
    assert got.nodes.count() == got.trees.count() == got.problems.count() == 0
