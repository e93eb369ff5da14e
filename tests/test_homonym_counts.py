"""Counts of homonym pairs against all pairs of a random forest."""

import random
from collections import Counter, defaultdict
from itertools import combinations

from grovespark.model import taxonomy
from grovespark.operators import reports, tree


def test_kinds_and_report(spark):
    rng = random.Random(8)
    up = {i: None if i < 3 else rng.choice([rng.randrange(i), rng.randrange(max(0, i - 6), i)]) for i in range(150)}
    name = {i: rng.choice([None, "a", "b", "b", "b", f"x{i}"]) for i in up}
    tax = taxonomy(spark.createDataFrame([(str(i), None if p is None else str(p), name[i]) for i, p in up.items()], "uid string, parent_uid string, name string"))
    pathed = tree.with_children(tree.with_path(tax.nodes))

    def line(i):
        return [] if i is None else [*line(up[i]), i]

    size = Counter(x for i in up for x in line(i))
    kinds, met, groups = Counter(), defaultdict(lambda: [0, 0]), defaultdict(set)
    for a, b in combinations([i for i in up if name[i]], 2):
        if name[a] != name[b]:
            continue
        pa, pb = line(a), line(b)
        ga, gb = (p[-3] if len(p) > 2 else None for p in (pa, pb))
        kind = "other"
        if up[a] == up[b]:
            kind = "sibling"
        elif a == up[b] or b == up[a]:
            kind = "parent/child"
        elif ga is not None and ga == up[b] or gb is not None and gb == up[a]:
            kind = "aunt/niece"
        elif ga is not None and ga == gb:
            kind = "cousin"
        kinds[name[a], kind] += 1
        if kind in ("sibling", "cousin"):
            groups[name[a], kind, up[a] if kind == "sibling" else ga] |= {a, b}
        common = [x for x, y in zip(pa, pb) if x == y]
        if common and a not in pb and b not in pa:
            at = met[name[a], str(common[-1])]
            at[0] += 1
            at[1] += size[a] + size[b]
    assert {k for _, k in kinds} == {"sibling", "parent/child", "aunt/niece", "cousin", "other"}
    assert {(r["name"], r["kind"]): r["n"] for r in reports.homonym_kinds(pathed).collect()} == dict(kinds)
    assert {(r["name"], r["mrca"]): [r["n"], r["sizes"]] for r in reports.homonym_report(pathed, tree.subtree_counts(pathed)).collect()} == dict(met)
    # All nodes of the name under a grandparent are in its group, those that are siblings as well.
    got = {(r["name"], r["kind"], None if r["clade"] is None else int(r["clade"])): (r["n_nodes"], r["first"], r["last"]) for r in reports.homonym_groups(pathed).collect()}
    assert got == {k: (len(v), min(map(str, v)), max(map(str, v))) for k, v in groups.items()}
