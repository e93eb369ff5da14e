"""Deep trees and long chains of aliases."""

from grovespark.operators import tree


def test_paths_of_a_deep_tree(spark):
    n = 1000
    rows = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(n)] + [(f"c{i}", f"c{(i + 1) % 7}") for i in range(7)] + [("d", "c0"), ("e", "d"), ("m", "missing"), ("o", "m"), ("s", "s")]
    got = {r["uid"]: r for r in tree.with_path(spark.createDataFrame(rows, "uid string, parent_uid string")).collect()}
    assert len(got) == len(rows)
    assert all(got[f"n{i}"]["depth"] == i + 1 for i in range(n))
    assert got[f"n{n - 1}"]["path"] == [f"n{i}" for i in range(n)]
    assert {u for u, r in got.items() if r["path"] is None} == {u for u, _ in rows[n:]}


def test_long_chains_of_aliases(spark):
    n = 1000
    rows = [(f"a{i}", f"a{i + 1}") for i in range(n)] + [(f"c{i}", f"c{(i + 1) % 8}") for i in range(8)] + [("d", "c0"), ("s", "s"), ("t", "s")]
    got = {r["id"]: r["replacement"] for r in tree.resolve_aliases(spark.createDataFrame(rows, "id string, replacement string")).collect()}
    assert got == {f"a{i}": f"a{n}" for i in range(n)} | {"t": "s"}


def test_grafts_of_many_sources(spark):
    from grovespark.model import NODES
    from grovespark.operators import lookups

    # A line of 150 nodes, each of a source of its own; below its end one of the first source, one of the last and one of none.
    line = [(f"n{i}", f"n{i - 1}" if i else None, "x", "no rank", [{"prefix": f"s{i:03}", "id": "1"}], 0, 0) for i in range(150)]
    ends = [(u, "n149", "x", "no rank", ids, 0, 0) for u, ids in (("a", [{"prefix": "s000", "id": "2"}]), ("b", [{"prefix": "s149", "id": "2"}]), ("c", []))]
    got = lookups.grafts(tree.with_path(spark.createDataFrame(line + ends, NODES))).collect()
    want = {f"n{i}": "resolution" for i in range(2, 150)} | {"n1": "graft", "a": "resolution", "c": "graft"}
    assert {r["uid"]: r["kind"] for r in got} == want
