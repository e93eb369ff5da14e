"""Dumps of one object a line: what counts as a taxon, which node an id stands for, and what is set aside."""

import json

from grovespark.model import NODES
from grovespark.sources import dumps


def claim(value):
    return {"mainsnak": {"datavalue": {"value": value}}}


def test_scan(spark):
    taxon, none = claim({"entity-type": "item", "numeric-id": 16521}), {"mainsnak": {"snaktype": "somevalue"}}

    def line(id_, claims, **more):
        return json.dumps({"type": "item", "id": id_, "claims": claims, **more}, separators=(",", ":")) + ","

    lines = [
        "[", line("Q1", {"P31": [none, taxon, taxon], "P685": [claim("7"), claim("8"), none], "P830": [claim("E1")]}, sitelinks={"enwiki": {"title": 'A "b"'}}),
        line("Q2", {"P31": [claim({"numeric-id": 5})], "P1": [taxon], "P685": [claim("7")]}), line("Q3", {"P1": [taxon], "P685": [claim("7")]}), line("Q4", {"P31": [taxon], "P846": [claim("7")], "P850": [claim("x")]}),
        line("Q5", {"P31": [taxon], "P685": [claim("9")]})[:-3], line("Q6", {"P31": [taxon]}), '{"type":"property","id":"P1"}', "", None, "]",
    ]

    def node(uid, *ids):
        return (uid, None, uid, "no rank", [{"prefix": p, "id": i} for p, i in ids], 0, 0)

    nodes = [node("a", ("ncbi", "7"), ("silva", "S")), node("b", ("ncbi", "7")), node("c", ("ncbi", "8"), ("silva", "T"), ("worms", "x")), node("d", ("worms", "x")), node("e")]
    got = dumps.scan(spark.createDataFrame([(x,) for x in lines], "line string"), spark.createDataFrame(nodes, NODES), ["enwiki", "de-wiki"])
    assert sorted(tuple(r) for r in got.links.collect()) == [("b", "Q1", "E1", 'A "b"', None), ("c", "Q1", "E1", 'A "b"', None), ("c", "Q4", None, None, None)]
    assert {json.loads(r["line"].rstrip(","))["id"] if r["problem"] != "no JSON" else "cut": r["problem"] for r in got.problems.collect()} == {"Q3": "no class", "cut": "no JSON"}
