"""Centroid clustering, license scans and periodic runs against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from grovespark.llm import licences, lloyd, periodic


def plain_lloyd(vectors, k, rounds, dims, scale, seed):
    kept = [(i, [int(np.floor(float(np.float64(c)) * scale)) for c in v]) for i, v in vectors if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [list(x) for _, x in order[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        own = [near(x)[1] for _, x in kept]
        for c in range(len(centres)):
            members = [x for (_, x), o in zip(kept, own, strict=True) if o == c]
            if members:
                centres[c] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    return sorted((repr(i), near(x)[1], near(x)[0]) for i, x in kept), centres


@pytest.mark.parametrize("blocks", [1, 3])
def test_lloyd_against_a_plain_version(spark, monkeypatch, blocks):
    monkeypatch.setattr(lloyd, "CHUNK", 7)
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(c) for c in rng.normal(0, 1, 5)]) for i in range(60)]
    rows += rows[:9] * 3 + [(3, [0.5] * 5), (None, [0.25] * 5), (70, None), (71, [1.0] * 4), (72, [None, 1.0, 1.0, 1.0, 1.0]), (73, [float("nan")] * 5), (74, [float("inf")] * 5), (75, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, cluster string")
    out, centres = lloyd.cluster(df, k=6, rounds=3, dims=5, scale=16, seed=2, blocks=blocks)
    want, plain = plain_lloyd(rows, 6, 3, 5, 16, 2)
    assert sorted((repr(r["vec_id"]), r["cluster"], r["distance"]) for r in out.collect()) == want
    assert centres.tolist() == plain


def test_lloyd_with_few_or_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>"
    out, centres = lloyd.cluster(spark.createDataFrame([], schema), k=3, rounds=2, dims=2)
    assert out.count() == 0 and len(centres) == 0
    out, centres = lloyd.cluster(spark.createDataFrame([(1, [1.0, -0.5]), (2, [1.0, -0.5]), (3, [1e30, 0.0])], schema), k=3, rounds=2, dims=2)
    # Equal vectors: the smaller number takes both, the empty cluster stays; a component out of range takes no part.
    assert sorted(map(tuple, out.collect())) == [(1, 0, 0), (2, 0, 0)] and centres.tolist() == [[256, -128]] * 2


def plain_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for p, label in licences.BASE.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


@pytest.mark.parametrize("piece", [5, 16, 1 << 20])
def test_licence_places_against_a_plain_version(spark, monkeypatch, piece):
    rng, vocabulary = random.Random(3), ["cc", "by", "General", "public", "LICENSE", "all rights", "reserved", "x", "é", "ı", "cc-by", "mit license", "\0", "_"]
    monkeypatch.setattr(licences, "PIECE", piece)
    texts = [None, "", " ", "cc by", "all rights reserved all rights reserved"] + ["".join(rng.choice(vocabulary) + rng.choice([" ", "-", "", "\n", "."]) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    scanner = licences.Scanner(licences.BASE, licences.NOTICES, licences.TAGS)
    for t in texts:
        assert scanner.scan((t or "").encode())[:5] == plain_places(t)


def test_licence_rows(spark):
    long = "Word " * 300_000 + "All rights reserved"
    rows = [(1, None, "a"), (2, "", "b"), (2, "MIT License", "c"), (2, "MIT License", "c"), (None, long, "d"), (3, "# SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\nfoo", "e"), (4, "a walk by the cc mit rights", "f")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, labels string")
    got = sorted(map(tuple, licences.scan(df).collect()), key=repr)
    assert got == sorted([
        (1, 0, 0, None, None, "", "", 0.0), (2, 0, 0, None, None, "", "", 0.0), (2, 2, 0, None, None, "", "mit", 0.2), (2, 2, 0, None, None, "", "mit", 0.2),
        (None, 300_003, 1, 300_000, 300_000, "reserved", "reserved", 1.0), (3, 14, 0, None, None, "", "apache-2.0,mit", 0.25), (4, 7, 0, None, None, "", "", 0.0),
    ], key=repr)
    assert licences.scan(df.limit(0)).count() == 0


@pytest.mark.parametrize("line, labels, weight", [
    ("mit", {"mit"}, 0.2), ("mit or gpl-2.0-only", {"mit"}, 0.2), ("mit and gpl-2.0-only or apache-2.0", {"apache-2.0"}, 0.25), ("mit and (gpl-2.0-only or apache-2.0)", {"mit", "apache-2.0"}, 0.25),
    ("gpl-2.0-only with classpath-exception-2.0 and mit", {"gpl-2.0-only-with-classpath-exception-2.0", "mit"}, 0.65), ("mit or", {"mit"}, 0.2), ("((mit)", {"mit"}, 0.2), ("mit) or x", {"mit"}, 0.2),
    ("gpl-3.0+ this file", {"gpl-3.0+"}, 0.75), ("(mit) with x", {"mit"}, 0.2), ("licenseref-own", {"licenseref-own"}, 1.0), ("gpl-2.0 with", {"gpl-2.0"}, 0.75), ("(gpl-3.0 or (mit and", {"mit"}, 0.2),
])
def test_licence_expressions(line, labels, weight):
    assert licences.evaluate(line) == (weight, labels)


def test_licence_expressions_that_are_none():
    assert [licences.evaluate(x) for x in ("", "or mit", "unheard-of or mit", ")", "()")] == [None] * 5


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((a, q, n) for (a, n), q in found.items())


def plain_periodic(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for a, q, m in runs for i in range(a + q, a + m)}
    top = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *((top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4), digest("".join(f"{a},{m},{q}\n" for a, q, m in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def repetitive(rng, n):
    k, words = rng.choice([1, 2, 2, 3, 30]), []
    while len(words) < n:
        unit = [f"w{rng.randrange(k)}" for _ in range(rng.randint(1, 9))]
        words += unit * rng.randint(1, 8) + unit[: rng.randint(0, len(unit))] if rng.random() < 0.5 else unit[:1]
    return words[:n]


@pytest.mark.parametrize("width", [8, 40, periodic.TILE])
def test_fragments_stitch_to_the_runs_of_a_plain_version(spark, monkeypatch, width):
    rng = random.Random(width)
    texts = [repetitive(rng, rng.randint(0, 90)) for _ in range(800)]
    made = periodic.fragments([np.array([int(w[1:]) for w in t], np.int64) for t in texts], width)
    rows = [(i, p, a, b) for i, f in enumerate(made) for p, a, b in f]
    got = periodic.stitched(spark.createDataFrame(rows, "row bigint, period int, start bigint, finish bigint")).collect()
    assert sorted((r["row"], r["start"], r["period"], r["length"]) for r in got) == sorted((i, *r) for i, t in enumerate(texts) for r in plain_runs(t))


def test_periodic_rows_against_a_plain_version(spark):
    rng = random.Random(1)
    texts = [None, "", " \n", "a", "é é é é é é", "x y " * 9, "a " * 3000, " ".join(f"w{i % 611}" for i in range(9000))] + [rng.choice([" ", "\n", "\t "]).join(repetitive(rng, rng.randint(0, 120))) for _ in range(150)]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(5, "a a a a a a", "z")] * 3 + [(None, "b " * 40, "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, period string")
    got = periodic.summarise(*periodic.detect(df, periodic.plant)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((plain_periodic(i, t) for i, t, _ in rows), key=repr)
    assert periodic.summarise(*periodic.detect(df.limit(0), periodic.plant)).count() == 0


def test_periodic_query_on_the_given_documents(spark):
    d = "/root/testdata/sf0.001"
    want = sorted((plain_periodic(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").collect()), key=repr)
    assert sorted(map(tuple, periodic.query(spark, d).collect()), key=repr) == want
