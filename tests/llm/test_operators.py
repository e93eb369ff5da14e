"""Each operator against a plain version on small tables with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import re
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from grovespark.llm import ann, bpe, common, components, jaccard_join, langid, line_dedup, mixing, quality, toxicity, url_filters, warc

WORD = re.compile("[^\x20\x09-\x0d]+")
BASE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    None, "", " \n\t ", "a b", "A b", "a b c", BASE, BASE.upper(), BASE + " x", BASE.replace("w30 ", "y "), BASE.replace("w30 ", "z ").replace("w5 ", "q "),
    "one\n two \nthree\n\nTWO", "x y z " * 40, "é à ü " * 30, "w" * 5000, " ".join(str(i % 997) for i in range(30000)), BASE, BASE + "\n" + BASE,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "s" if i % 3 else None, "extra") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, h1 string").cache()


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def shingles(t, k):
    w = words(t)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_jaccard_join(spark, docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.link(docs, 4, 85).collect()}
    sets = [shingles(t, 4) for t in TEXTS]
    top = list(range(len(TEXTS)))
    for a, b in combinations(range(len(TEXTS)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            low, high = sorted((top[a], top[b]))
            top = [low if x == high else x for x in top]
    assert got == {i: (len(sets[i]), top[i]) for i in range(len(TEXTS))}


def test_jaccard_join_of_repeated_and_null_ids(spark):
    """Against brute force over rows: rows of one id are linked, and a component is called by its smallest id."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, c), (4, c), (None, a), (5, None), (5, c + " z"), (6, ""), (0, "q r")]
    sets = [shingles(t, 4) for _, t in rows]
    top = [i for i, _ in rows]
    for _ in rows:
        for i, j in combinations([k for k in range(len(rows)) if sets[k] and rows[k][0] is not None], 2):
            if rows[i][0] == rows[j][0] or 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                top[i] = top[j] = min(top[i], top[j])
    got = sorted([tuple(r) for r in jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()], key=str)
    assert got == sorted([(rows[k][0], len(sets[k]), top[k]) for k in range(len(rows))], key=str)


def test_jaccard_join_of_a_large_group(spark):
    """A third of all rows are near copies of one text, a third equal ones: brute force over the distinct texts."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(80)]
    near = [" ".join([*base[: (p := int(rng.integers(80)))], f"n{k}", *base[p:]]) for k in range(60)]
    rows = list(enumerate([*near, *[" ".join(base[::-1])] * 60, *(" ".join(rng.choice(base, 40)) for _ in range(60))]))
    sets = [shingles(t, 4) for _, t in rows]
    top = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            low, high = sorted((top[i], top[j]))
            top = [low if x == high else x for x in top]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert got == dict(enumerate(top))


def test_spread_join(spark):
    work = common.Workspace(spark, "t")
    left = work.save(spark.createDataFrame([(None if i % 3 == 0 else i % 50, i) for i in range(300)], "k long, i long"), "left")
    right = spark.createDataFrame([(None, "n"), *((k, f"v{k}") for k in range(40)), (1, "again")], "k long, v string")
    value = {None: ["n"], **{k: [f"v{k}"] for k in range(40)}}
    value[1] = ["v1", "again"]
    rows = [(r["k"], r["i"]) for r in left.collect()]
    for by in ([], ["i"]):
        assert sorted(map(tuple, common.spread_join(left, right, ["k"], by=by).select("k", "i", "v").collect()), key=str) == sorted(((k, i, v) for k, i in rows for v in value.get(k, [])), key=str)
        assert sorted(map(tuple, common.spread_join(left, right, ["k"], "left", by=by).select("k", "i", "v").collect()), key=str) == sorted(((k, i, v) for k, i in rows for v in value.get(k, [None])), key=str)
        assert sorted(map(tuple, common.spread_join(left, right, ["k"], "left_semi", by=by).select("k", "i").collect()), key=str) == sorted(((k, i) for k, i in rows if k in value), key=str)


def test_case_folding_tells_all_else_apart(spark):
    texts = ["Ab", "ab", "É", "é", "Ã©", "ã©", "×", "ÿ", "ß", "ẞ", "İ", "i", "Σ", "ς", "K", "k", "ﾀ", "😀", "Ａ", "ａ", "µ", "Μ"]
    got = dict(map(tuple, spark.createDataFrame([(t,) for t in texts], "t string").select("t", common.folded(F.col("t"))).collect()))
    for x, y in combinations(texts, 2):
        assert (got[x] == got[y]) == (words(x) == words(y)), (x, y)


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.link(spark.createDataFrame([], "doc_id long, text string"), 4, 85).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long"), common.Workspace(spark, "t")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_line_dedup(spark):
    rows = [(i, f"Common line\nown {i}\n COMMON LINE\n\n", i) for i in range(12)] + [(12, None, 0), (13, "rare", 0), (13, "rare", 0), (None, "Common Line", 0)]
    for names in ("at", "gone", "h1", "keys", "row", "id", "n", "own_id", "n_lines", "batch"):
        got = line_dedup.dedup_lines(spark.createDataFrame(rows, f"doc_id long, text string, {names} long"), 1, 10, 3)
        assert set(got.columns) == {"doc_id", "text", names, "n_lines", "n_dropped"}
    got = Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect())
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert got.pop((None, "", 1, 1)) == 1 and got[13, "rare", 1, 0] == 2 and len(got) == 14
    assert set(got) == {(i, f"own {i}\n\n", 5, 2) for i in range(12)} | {(12, "", 1, 0), (13, "rare", 1, 0)}


def test_quality(spark, docs):
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    for i, t in enumerate(TEXTS):
        w = WORD.findall(t or "")
        seen = {}
        for j in range(len(w) - 7):
            seen.setdefault(tuple(w[j : j + 8]), []).append(j)
        repeated = {p for js in seen.values() if len(js) > 1 for j in js for p in range(j, j + 8)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(repeated), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(repeated) > 30 * len(w))
        assert r["h1"] == "extra"


def test_quality_rejects_a_bad_host(spark):
    good = " ".join(f"g{i}" for i in range(30))
    rows = [(i, "short", "bad") for i in range(200)] + [(900, good, "bad")] + [(1000 + i, good + f" {i}", f"h{i % 9}") for i in range(300)]
    kept = {r["doc_id"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("kept").collect()}
    assert kept == {1000 + i for i in range(300)}


def test_url_filters(spark):
    urls = [None, "", "no-scheme", "http://a.b.com/en/x", "https://EXAMPLE.com/en/7?q", "http://xexample.com/en/7", "http://example.net/de/81#x", "http://x.net/de/", "http://x.net/dex", "ftp://m.casino-win.org/fr", "http://casinos.org/", "http://x.com", "http://x.org/es/", "http://x.org/es/"]
    got = [(r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), url_filters.rules(spark)).orderBy("page_id").collect()]
    assert [g[2:] for g in got] == [(None, "allow")] * 3 + [("com/en/", "block"), ("example.com/en/7", "allow"), ("com/en/", "block"), ("example.net/de/8", "block"), ("net/de/", "allow"), (None, "allow"), (None, "block"), (None, "allow"), (None, "allow"), ("org/es/", "block"), ("org/es/", "block")]
    assert got[4][:2] == ("example.com", "/en/7") and got[0][:2] == ("", "")


def test_url_patterns():
    def hit(pattern, url):
        rule = url_filters.pattern_rule(pattern)
        assert not (fits := re.search(rule[5], url)) or set(rule[6]) <= set(re.split("[^A-Za-z0-9]+", url))
        return bool(fits)

    assert hit("||ads.com^", "x.ads.com/") and hit("||ads.com^", "ads.com") and not hit("||ads.com^", "ads.com.de/") and not hit("||ads.com^", "bads.com/")
    assert hit("|m.*.org/fr/*.html|", "m.a.org/fr/12.html") and not hit("|m.*.org/fr/*.html|", "www.m.a.org/fr/12.html") and not hit("|m.*.org/fr/*.html|", "m.a.org/fr/12.html/")
    assert hit("/banner/", "a.b/x/banner/1") and hit("ban*er", "a.b/bananer") and url_filters.pattern_rule("ban*er/x")[6] == []
    assert url_filters.pattern_rule("|blog.*.net/es/")[6] == ["blog", "net", "es"]


def test_warc_names_and_damage(spark):
    """Revisits name records; a file that is cut off or damaged gives what is whole; rows that repeat id and payload stay."""
    rows = [(1, "u", "same"), (2, "u", "same"), (None, "u", "same"), (None, None, "alone"), (None, None, "alone"), (9, "u", "é" * 40_000), (9, "u", "é" * 40_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    work = common.Workspace(spark, "t")
    warc.write_archives(pages, path := work.path("w"), 0)
    texts = [r["content"] for r in spark.read.format("binaryFile").load(path).collect()]
    heads = [f for t in texts for f, _ in warc.parse(bytes(t))]
    names = {f["warc-record-id"] for f in heads}
    assert all(f["warc-refers-to"] in names for f in heads if "warc-refers-to" in f)
    got = sorted([tuple(r) for r in warc.round_trip(pages, 0).select("page_id", "payload_bytes", "record_type", "refers_to").collect()], key=str)
    assert got == sorted([(1, 4, "revisit", 2), (2, 4, "response", None), (None, 4, "revisit", 2), (None, 5, "response", None), (None, 5, "response", None), (9, 80_000, "response", None), (9, 80_000, "response", None)], key=str)
    whole = b"".join(r + b"\r\n\r\n" for i in (1, 2, 3) for r in warc.records(i, "u", f"text {i}", None, 1000))
    for data, want in ((whole[:-40], [True, True, False]), (whole.replace(b"Content-Length", b"Content-Wrong", 1), [False, True, True]), (b"junk", [False]), (b"", [])):
        assert [block is not None for _, block in warc.parse(data)] == want


def brute_mix(rows, levels, share, epochs, seed, weight):
    """Budgets by handing out money bit by bit, then whole documents in order."""
    total = sum(r["n_tokens"] for r in rows)

    def split(nodes, money, depth):
        supply = {}
        for r in nodes:
            supply[r[levels[depth]]] = supply.get(r[levels[depth]], 0) + r["n_tokens"] * epochs
        given, open_ = dict.fromkeys(supply, 0.0), set(supply)
        while open_:
            w = sum(weight(levels[depth], k) for k in open_)
            fair = (money - sum(given[k] for k in supply if k not in open_)) / w
            full = {k for k in open_ if supply[k] <= fair * weight(levels[depth], k)}
            for k in full or open_:
                given[k] = supply[k] if full else fair * weight(levels[depth], k)
            open_ -= full or open_
        out = []
        for k in supply:
            own = [r for r in nodes if r[levels[depth]] == k]
            out += split(own, given[k], depth + 1) if depth + 1 < len(levels) else [(own, int(given[k] + 1e-6))]
        return out

    chosen = []
    for leaf, allowed in split(rows, total * share, 0):
        order = sorted(((e, hashlib.md5(f"{seed}:{e}:{r['doc_id']}".encode()).hexdigest(), r) for e in range(1, epochs + 1) for r in leaf), key=lambda x: x[:2])
        n = 0
        for e, _, r in order:
            n += r["n_tokens"]
            if n > allowed:
                break
            chosen.append((r["doc_id"], e))
    return sorted(chosen)


def test_mixing_against_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = [{"doc_id": i, "domain": str(rng.choice(["a", "b"], p=[0.9, 0.1])), "lang": str(rng.choice(["en", "de", "fr"], p=[0.7, 0.2, 0.1])), "source": f"s{min(int(rng.exponential(2)), 5)}", "n_tokens": int(rng.integers(1, 50))} for i in range(600)]
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, domain string, lang string, source string, n_tokens long")
    own = {"lang": F.when(F.col("lang") == "de", 3.0).otherwise(1.0)}
    for share, epochs in ((0.5, 2), (0.9, 1), (0.3, 3)):
        got = sorted((r["doc_id"], r["epoch"]) for r in mixing.mix(docs, share, epochs, 4, weight=own).collect())
        want = brute_mix(rows, mixing.LEVELS, share, epochs, 4, lambda level, k: 3.0 if (level, k) == ("lang", "de") else 1.0)
        assert got == want, (share, epochs, len(got), len(want))


def test_mixing_of_one_id(spark):
    docs = spark.createDataFrame([(None, "d", "en", "s", 10)] * 300, "doc_id long, domain string, lang string, source string, n_tokens long")
    assert mixing.mix(docs, 0.5, 1).count() == 150


def test_windows_and_grams_of_a_long_text():
    """A text that is cut for work has the windows and n-grams of the whole."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    text = " ".join(["é" * int(n) if n % 7 == 0 else "w" * int(n) for n in rng.integers(1, 20, 260_000)])
    whole = toxicity._piece(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    _, first, length = toxicity.windows(whole[1])
    words_of = lambda piece, f, n: tuple(piece[0][0][piece[0][1][f : f + n]].tolist())
    got = [words_of(t[1:], f, n) for t in toxicity.tokens(pa.array([text])) for f, n in zip(t[5][1], t[5][2], strict=True)]
    assert len(text.encode()) > 4 * toxicity.W.PIECE and got == [words_of(whole, f, n) for f, n in zip(first, length, strict=True)]
    data = np.frombuffer(text.encode(), np.uint8)
    want = [np.bincount(h[fits], minlength=1 << langid.BITS) for h, fits in langid.grams(data, np.array([0, len(data)]))]
    cut = [np.zeros(1 << langid.BITS, np.int64) for _ in want]
    for _, _, part, offsets, stop in langid._rows(pa.array([text])):
        for c, (h, fits) in zip(cut, langid.grams(part, offsets, stop), strict=True):
            c += np.bincount(h[fits], minlength=1 << langid.BITS)
    assert all((c == w).all() for c, w in zip(cut, want, strict=True))


def test_warc(spark):
    big = "é" * 50_000
    rows = [(1, None, None), (2, "u", None), (3, "u", "x"), (4, "u\r\nx", "x"), (5, "u", big), (6, "u", big), (7, "u", big + "WARC/1.1\r\n\r\n"), (8, None, "0\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for least in (0, 2):
        got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages, least).collect()}
        for i, _, html in rows:
            data = (html or "").encode()
            top = max(j for j, _, h in rows if (h or "") == (html or "")) if len(data) >= least else i
            assert got[i] == (len(data), warc.base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if top == i else "revisit", None if top == i else top)
    assert warc.round_trip(pages.where("false"), 0).count() == 0


def test_warc_incomplete_segments():
    parts = [{"segment": 1, "total": None, "digest": "d", "block": warc.HEAD}, {"segment": 3, "total": 9, "digest": "d", "block": b"0\r\n\r\n"}]
    import pyarrow as pa

    out = next(warc._reassemble([pa.RecordBatch.from_pylist([{"page_id": 1, "times": 1, "parts": parts}])])).to_pylist()
    assert out == [{"page_id": 1, "times": 1, "digest": "d", "payload": None, "status": "incomplete"}]


def test_mixing_budgets(spark):
    rows = [(i, "d", "en" if i < 60 else "de", f"s{i % 2}", 10) for i in range(80)] + [(80, "d", None, "s0", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, n_tokens long")
    got = mixing.mix(docs, 0.5, 1, 1, weight={"lang": F.when(F.col("lang") == "en", 1.0).otherwise(1.0)}).where("n_tokens > 0").groupBy("lang", "source").agg(F.sum("n_tokens").alias("n")).collect()
    # 400 tokens: de can use its 200, en gets what is left; each is split among its two sources.
    assert {(r["lang"], r["source"]): r["n"] for r in got} == {("de", "s0"): 100, ("de", "s1"): 100, ("en", "s0"): 100, ("en", "s1"): 100}
    assert mixing.mix(docs.where("false"), 0.5).count() == 0


def test_bpe(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    extra = spark.createDataFrame([(100, "a<|endoftext|>b  c \n it's"), (101, " \xa0 \xa0\tt  "), (102, "日本 😀")], "doc_id long, text string")
    every = docs.select("doc_id", "text").union(extra)
    encoded = bpe.encode(every, path, lexicon_size=50)
    for r in bpe.decode(encoded, path, out="back").collect():
        assert r["ids"] == t.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["back"] == (r["text"] or "")


def test_language_id(spark):
    rng = np.random.default_rng(1)
    voices = {"en": ["the", "thing", "wh", "er"], "de": ["sch", "ung", "keit", "der"], "fr": ["eau", "é", "le", "oi"], "es": ["ción", "ll", "ñ", "os"], "xx": ["qq", "zz", "kk", "jj"]}
    rows = [(k, " ".join("".join(rng.choice(v, 2)) for _ in range(30)), c) for k, (c, v) in enumerate((c, v) for c, v in voices.items() for _ in range(40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs.where("doc_id % 2 = 0"))
    got = langid.predict(docs, model)
    assert got.where("lang = lang_pred").count() == len(rows)
    odd = langid.predict(spark.createDataFrame([(1, None), (2, ""), (3, "12 $")], "doc_id long, text string"), model).collect()
    assert [(r["lang_pred"], r["score"]) for r in odd] == [("und", 0.0)] * 3
    assert langid.fit(docs.where("false")) is None


def test_toxicity_finds_a_word_in_a_long_text():
    rng = np.random.default_rng(2)
    clean = [" ".join(f"{rng.choice(['ab', 'cd', 'ef'])}{rng.integers(60)}" for _ in range(rng.integers(5, 200))) for _ in range(300)]
    y = np.array([i % 3 == 0 for i in range(300)], np.float32)
    texts = [t + " vile scum " + t[:20] if l else t for t, l in zip(clean, y, strict=True)]
    net = toxicity.train(texts, y, epochs=5)
    import pyarrow as pa

    score = toxicity.scores(net, pa.array(["", None, " ".join(clean[:40]), " ".join(clean[:20]) + " vile scum " + " ".join(clean[20:40])]))
    assert score[0] == score[1] and score[2] < 0.5 < score[3]


def test_network_gradients():
    rng = np.random.default_rng(3)
    import pyarrow as pa

    _, (h, which), _, grams, ends, _ = next(toxicity.tokens(pa.array(["aa bb cc dd aa ee"])))
    net = toxicity.Network(h, rng.normal(size=len(h)), rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    args = (h, which, grams, ends, np.array([0, 2]), np.array([6, 3]), np.array([1.0, 0.0]))
    g, _ = net.gradients(*args)
    for name, place in (("uf", (1, 2)), ("wb", (0, 1)), ("att", (3,)), ("out", (2,)), ("word", (0, 1))):
        old, step = net.p[name][place], 1e-3
        net.p[name][place] = old + step
        up = net.gradients(*args)[1]
        net.p[name][place] = old - step
        down = net.gradients(*args)[1]
        net.p[name][place] = old
        assert abs((up - down) / (2 * step) - g[name][place]) < 2e-3, name


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 8)).astype(np.float32)
    x[300:] = x[300]  # a third of equal vectors
    rows = [(i, [float(v) for v in x[i]]) for i in range(400)] + [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [1.0]), (404, [None] * 8)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, 20, parts=4).collect()
    hits, by = 0, {}
    for r in got:
        by.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    d = x.astype(float)
    assert sorted(by) == list(range(0, 400, 20))
    for q, found in by.items():
        s = d @ d[q]
        s[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(400), -s))[:20].tolist()) & set(found.values()))
        assert sorted(found) == list(range(1, 21))
    assert hits >= 0.9 * 20 * len(by)
    assert ann.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0
