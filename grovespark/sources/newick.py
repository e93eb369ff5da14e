"""Bracket text to node rows and back: a table of trees in, a table of nodes out, in parallel across trees."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.functions import codecs

TOKEN = re.compile(r"\s*([(),;]|'(?:[^']|'')*'|:[^(),;]*|\[[^\]]*\]|[^\s(),:;'\[][^(),:;\[]*)")
#: Labels that carry an id.
ID_LABEL = re.compile(r"^(?:(.*?)[_ ]?ott(\d+)|(mrcaott\d+ott\d+))$")


def rows(text: str) -> Iterator[tuple[int, int | None, str | None, str]]:
    """(number, parent's number, name, rank) of the nodes of one tree, in postorder."""
    stack: list[list] = [[]]
    out: list[list] = []

    def finish(children: list[int], label: str | None) -> int:
        rank, name = "no rank", label
        if name is not None and "=" in name:
            rank, name = name.split("=", 1)
            rank = rank.lower()
        out.append([len(out), None, name, rank])
        for c in children:
            out[c][1] = len(out) - 1
        return len(out) - 1

    kids: list[int] | None = None
    label: str | None = None
    open_node = False
    for m in TOKEN.finditer(text):
        t = m[1]
        if t == "(":
            stack.append([])
            kids, label, open_node = None, None, True
        elif t in ",);":
            if open_node or kids is not None or label is not None:
                stack[-1].append(finish(kids or [], label))
            kids, label, open_node = None, None, t == ","
            if t == ")":
                kids = stack.pop()
            elif t == ";":
                break
        elif t[0] in ":[":
            continue
        else:
            label = t[1:-1].replace("''", "'") if t[0] == "'" else t.strip().replace("_", " ")
    if kids is not None or label is not None:
        finish(kids or [], label)
    yield from map(tuple, out)


def read(trees: DataFrame) -> DataFrame:
    """(tree_id, uid, parent_uid, name, rank) of ``trees`` (tree_id, newick) (S-8)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: tuple[list, ...] = ([], [], [], [], [])
            for tree, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for n, parent, name, rank in rows(text or ""):
                    m = ID_LABEL.match(name) if name else None
                    uid = (m[3] or m[2]) if m else f"{tree}:{n}"
                    for c, v in zip(cols, (tree, (uid, n), parent, (m[1] if m else name) or None, rank), strict=True):
                        c.append(v)
            ids = {(t, n): u for t, (u, n) in zip(cols[0], cols[1], strict=True)}
            up = [None if p is None else ids[t, p] for t, p in zip(cols[0], cols[2], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (cols[0], [u for u, _ in cols[1]], up, cols[3], cols[4])], ["tree_id", "uid", "parent_uid", "name", "rank"])

    return trees.select(F.col("tree_id").cast("string").alias("tree_id"), "newick").mapInArrow(run, "tree_id string, uid string, parent_uid string, name string, rank string")


def write(nodes: DataFrame) -> DataFrame:
    """(tree_id, newick) of ``nodes`` (tree_id, uid, parent_uid, name): children by uid, labels quoted as needed (S-9)."""

    def run(own: pd.DataFrame) -> pd.DataFrame:
        kids: dict = {}
        for u, p, label in zip(own["uid"], own["parent_uid"], own["label"], strict=True):
            kids.setdefault(p if isinstance(p, str) else None, []).append((u, label))
        text: dict = {}
        stack = [(u, label, False) for u, label in kids.get(None, [])]
        while stack:
            u, label, done = stack.pop()
            below = sorted(kids.get(u, []))
            if done or not below:
                text[u] = (f"({','.join(text[c] for c, _ in below)})" if below else "") + (label or "")
            else:
                stack.append((u, label, True))
                stack += [(c, x, False) for c, x in below]
        return pd.DataFrame({"tree_id": own["tree_id"].iloc[:1], "newick": [",".join(text[u] for u, _ in sorted(kids.get(None, []))) + ";"]})

    labelled = nodes.select("tree_id", "uid", "parent_uid", codecs.newick_quote(F.coalesce("name", F.lit(""))).alias("label"))
    return labelled.groupBy("tree_id").applyInPandas(run, "tree_id string, newick string")
