"""Many pairs of trees in one plan."""

import json

import pytest

from grovespark.operators import conflict

TREES = {
    "a": {"top": None, "ab": "top", "cd": "top", "1": "ab", "2": "ab", "3": "cd", "4": "cd"},
    "b": {"r": None, "top": "r", "bcd": "top", "cd": "bcd", "1": "top", "2": "bcd", "3": "cd", "4": "cd", "other": "r"},
    "c": {"top": None, "5": "top", "6": "top"},
}


def told(spark, pairs, ingroup=()):
    rows = [(t, u, p, f"name of {u}", u if u.isdigit() else None, (t, u) in ingroup) for t, own in TREES.items() for u, p in own.items()]
    trees = spark.createDataFrame(rows, "tree string, uid string, parent_uid string, name string, key string, ingroup boolean")
    got = conflict.compare_pairs(spark.createDataFrame(pairs, "pair int, first string, second string"), trees).collect()
    for r in got:
        assert json.loads(r["info"])["witness_name"] == f"name of {json.loads(r['info'])['witness']}"
    return {(r["pair"], r["uid"], r["flipped"], json.loads(r["info"])["status"], json.loads(r["info"])["witness"]) for r in got}


def test_pairs_both_ways(spark):
    got = told(spark, [(1, "a", "b"), (2, "b", "a"), (3, "a", "c"), (4, "a", "a")])
    inner = {r for r in got if not r[1].isdigit()}
    # The larger tree is told of below the common clade of its mapped tips; trees without a common tip have nothing to tell.
    assert inner == {
        (1, "top", False, "supported_by", "top"), (1, "cd", False, "supported_by", "cd"), (1, "ab", False, "conflicts_with", "bcd"),
        (2, "top", True, "supported_by", "top"), (2, "cd", True, "supported_by", "cd"), (2, "bcd", True, "conflicts_with", "ab"),
        (4, "top", False, "supported_by", "top"), (4, "ab", False, "supported_by", "ab"), (4, "cd", False, "supported_by", "cd"),
    }
    assert {r for r in got if r[1].isdigit()} == {(p, t, p == 2, "supported_by", t) for p in (1, 2, 4) for t in "1234"}


@pytest.mark.parametrize("pairs", [[(1, "a", "b")]])
def test_only_the_ingroup_is_told(spark, pairs):
    assert {r[1] for r in told(spark, pairs, {("a", "cd")})} == {"cd", "3", "4"}
