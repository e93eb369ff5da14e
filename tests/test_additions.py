"""Addition documents against a plain sequential version, in a batch and as a stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from grovespark.model import ALIASES, NODES, SYNONYMS, Taxonomy
from grovespark.operators import additions, tree
from grovespark.streaming import additions as stream

BASE = [("1", None, "life"), ("2", "1", "plants"), ("3", "1", "animals"), ("4", "2", "rosa"), ("5", "3", "rosa"), ("6", "3", "felis"), ("7", "3", "felis")]


def base(spark):
    nodes = [(u, p, n, "no rank", [{"prefix": "src", "id": u}], 0, 0) for u, p, n in BASE]
    tax = Taxonomy(spark.createDataFrame(nodes, NODES), spark.createDataFrame([("6", "cat", "synonym")], SYNONYMS), spark.createDataFrame([("60", "6")], ALIASES))
    return tax, spark.createDataFrame([("2",), ("3",)], "uid string")


def one_by_one(docs):
    """Plain: (doc, pos, tag, outcome, target) of rows applied one after another."""
    parent = {u: p for u, p, _ in BASE}
    names = [(n, u) for u, _, n in BASE] + [("cat", "6")]
    first = {u: f"src:{u}" for u in parent}
    ids, out = {u: u for u in parent} | {"60": "6"}, []

    def division(u):
        while u is not None and u not in ("2", "3"):
            u = parent.get(u)
        return u

    for d in sorted(docs, key=lambda d: (len(d["id"]), d["id"])):
        tags = {}
        for pos, t in enumerate(d["taxa"]):
            def say(outcome, target=None):
                out.append((d["id"], pos, t.get("tag"), outcome, target))

            lack = next((f"missing {w}" for k, w in (("tag", "tag"), ("name", "name"), ("ott_id", "id")) if t.get(k) is None), None)
            if lack or (t.get("parent") is None and t.get("parent_tag") is None):
                say(lack or "no parent")
                continue
            if t.get("parent") is not None:
                up = None if t["parent"] == "root" else ids.get(t["parent"], "?")
            else:
                up = tags.get(t["parent_tag"], "?") or "?"
            if up == "?":
                say("parent not found")
                continue
            target, outcome = ids.get(t["ott_id"]), "matched"
            if target is None:
                own = sorted({u for n, u in names if n == t["name"] and division(u) == division(up)}, key=lambda u: (len(u), u))
                source = (t.get("sources") or [{"source": ""}])[0]["source"]
                target = next((u for u in own if first[u] == source), own[0] if own else None)
            if target is None and d.get("user_agent") == additions.ORIGINAL:
                outcome = "deprecated"
            elif target is None:
                target, outcome = t["ott_id"], "added"
                parent[target], first[target] = up, f"{d['id']}:{target}"
                names.append((t["name"], target))
            if target is not None:
                ids.setdefault(t["ott_id"], target)
            tags[t["tag"]] = target
            say(outcome, target)
    return sorted(out, key=repr)


def made_up(rng, n):
    docs = []
    for i in range(n):
        taxa = []
        for j in range(rng.randint(0, 6)):
            t = {"tag": f"t{rng.randint(0, 3)}", "ott_id": str(rng.choice([100 + i * 10 + j, rng.randint(1, 7), 100 + rng.randint(0, n) * 10])), "name": rng.choice(["rosa", "felis", "cat", "x", "y", "z"])}
            t |= rng.choice([{"parent": str(rng.choice([1, 2, 3, 60, "root", 100 + rng.randint(0, n) * 10 + rng.randint(0, 2)]))}, {"parent_tag": f"t{rng.randint(0, 3)}"}, {"parent": "3"}, {"parent": "2"}])
            if rng.random() < 0.05:
                t[rng.choice(["tag", "name", "ott_id"])] = None
            if rng.random() < 0.4:
                t["sources"] = [{"source": f"src:{rng.randint(4, 7)}"}]
            taxa.append(t)
        docs.append({"id": f"additions-{i}", "user_agent": additions.ORIGINAL if rng.random() < 0.2 else "other", "taxa": taxa})
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "j string").select(F.from_json("j", additions.DOCUMENT).alias("d")).select("d.*")


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_are_applied_as_if_one_after_another(spark, seed):
    docs = made_up(random.Random(seed), 25)
    tax, divisions = base(spark)
    after, outcomes = additions.add(tax, frame(spark, docs + docs[:3]), divisions)
    got = sorted((tuple(r) for r in outcomes.collect()), key=repr)
    assert got == one_by_one(docs)
    assert {r["problem"]: r["n"] for r in tree.integrity(after).collect()}["repeated id"] == 0


def test_no_documents(spark):
    tax, divisions = base(spark)
    after, outcomes = additions.add(tax, frame(spark, []), divisions)
    assert outcomes.count() == 0 and after.nodes.count() == len(BASE)


def test_stream_out_of_order_and_restarted(spark, tmp_path):
    docs = [
        {"id": "additions-1", "user_agent": "a", "taxa": [{"tag": "a", "ott_id": 100, "name": "n1", "parent": 2}, {"tag": "b", "ott_id": 101, "name": "n2", "parent_tag": "a"}]},
        {"id": "additions-2", "user_agent": "a", "taxa": [{"tag": "c", "ott_id": 102, "name": "n3", "parent": 101}, {"tag": "d", "ott_id": 103, "name": "n4", "parent_tag": "c"}, {"tag": "e", "ott_id": 104, "name": "n1", "parent": 101}]},
    ]
    tax, divisions = base(spark)
    have, (source, folder, log) = additions.known(tax, divisions), (str(tmp_path / x) for x in ("in", "state", "log"))

    def run():
        stream.add_documents(stream.read_documents(spark, source), have, folder, log).awaitTermination()

    (tmp_path / "in").mkdir()
    (tmp_path / "in/second.json").write_text(json.dumps(docs[1]))
    run()
    assert stream.state(spark, folder, "waiting").count() == 3 and stream.state(spark, folder, "outcomes").count() == 0
    (tmp_path / "in/first.json").write_text(json.dumps(docs[0]) + "\n")
    (tmp_path / "in/again.json").write_text(json.dumps(docs[1]))
    run()
    run()  # nothing new
    # As after a failure: the last batch's number is taken back and it runs again.
    (tmp_path / "log/commits/1").unlink()
    (tmp_path / "log/commits/.1.crc").unlink(missing_ok=True)
    run()
    got = sorted((tuple(r) for r in stream.state(spark, folder, "outcomes").collect()), key=repr)
    texts = json.loads(json.dumps(docs), parse_int=str)
    assert got == one_by_one(texts) and stream.state(spark, folder, "waiting").count() == 0
    assert sorted(r["uid"] for r in stream.state(spark, folder, "created").collect()) == ["100", "101", "102", "103"]


def test_the_plan_of_waiting_rows_grows_with_the_rounds(spark):
    """A chain of documents, each under the one before and with a row by tag, waits whole for its first parent."""
    def plan(n: int) -> int:
        docs = [{"id": f"additions-{i}", "user_agent": "a", "taxa": [{"tag": "a", "ott_id": str(100 + i), "name": f"n{i}", "parent": str(99 + i)}, {"tag": "b", "ott_id": str(200 + i), "name": "m", "parent_tag": "a"}]} for i in range(1, n + 1)]
        tax, divisions = base(spark)
        a = additions.apply(additions.log_rows(frame(spark, docs)), additions.known(tax, divisions), wait=True)
        assert a.outcomes.count() == 0 and a.waiting.count() == 2 * n
        return a.waiting._jdf.queryExecution().analyzed().treeString().count("\n")

    assert plan(6) < 3 * plan(3)


def test_a_tag_has_the_division_of_a_node_that_was_found_by_name(spark):
    """The row below a tag looks for its name in the division of the tag's node, whose id no row mentions."""
    docs = [{"id": "additions-1", "user_agent": "a", "taxa": [{"tag": "a", "ott_id": "100", "name": "felis", "parent": "3"}, {"tag": "b", "ott_id": "101", "name": "rosa", "parent_tag": "a"}]}]
    tax, divisions = base(spark)
    got = sorted((tuple(r) for r in additions.add(tax, frame(spark, docs), divisions)[1].collect()), key=repr)
    assert got == one_by_one(docs) and got[1][3:] == ("matched", "5")


def test_rows_to_which_none_refers_are_looked_at_once(spark, monkeypatch):
    """A chain of documents, each with rows that only it has a use for."""
    docs = [{"id": f"additions-{i}", "user_agent": "a", "taxa": [{"tag": "a", "ott_id": str(100 + i), "name": f"n{i}", "parent": str(99 + i) if i else "2"}, *({"tag": f"l{j}", "ott_id": str(1000 + 100 * i + j), "name": f"leaf {j % 7}", "parent_tag": "a"} for j in range(20))]} for i in range(4)]
    looked, real = [], additions.Pile.add

    def add(pile, part):
        out = real(pile, part)
        if "ready" in out.columns and "outcome" not in out.columns:
            looked.append(out.count())
        return out

    monkeypatch.setattr(additions.Pile, "add", add)
    tax, divisions = base(spark)
    got = sorted((tuple(r) for r in additions.add(tax, frame(spark, docs), divisions)[1].collect()), key=repr)
    assert got == one_by_one(docs) and looked == [4, 3, 2, 1, 80]
