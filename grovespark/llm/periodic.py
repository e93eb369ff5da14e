"""Periodic runs of words: octaves of periods, overlapping tiles, and fragments stitched by document and period.

A run of period q that is at least 4 q words long has a block [b, b + s), b a multiple of s, that equals [b + q, b + q + s),
for the power of two s with s <= q < 2 s. So each octave s of periods explodes a document into tiles that overlap by 4 s
words, and a tile is solved by itself: its blocks are compared with the shifts of the octave by the names of windows
of s words (doubled from octave to octave), neighbouring blocks with one shift are put together, and their ends move on by the Z-values
at both boundaries: how many words before the first and behind the last block still equal those q words on. The
fragments of all tiles are shuffled by document and period and stitched where they touch; an interval that a smaller period
explains as well goes. Names only pick candidates: every fragment is compared word by word.

Texts without a fragment are finished where they are read. The others' words are written once, so only texts with
repetitions are shuffled again, to leave out what their runs repeat.

Defined cases: null, empty and wordless texts have no word, no run and the digest of nothing; every row is judged by
itself, so repeated rows and null ids are results of their own (a null id is never rewritten by ``plant``); texts of any length
are cut into tiles, none is dropped; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.llm.common import Workspace, rebatch, table
from grovespark.llm.words import U, mix

LEAST, POWER = 6, 4
#: Words of a tile for periods up to an eighth of it; larger octaves s have tiles of 8 s words.
TILE = 1 << 15
FRAGMENTS = "array<struct<period:int,start:bigint,finish:bigint>>"
RESULT = "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
NOTHING = hashlib.sha256(b"").hexdigest()
Rewrite = Callable[[int | None, int], np.ndarray | None]


def plant(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place, for the documents that the contract makes periodic; else null."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def tiles(n: int, width: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(first octave, last octave, first block, end of blocks, end of words) of the tiles of a text of ``n`` words."""
    top = 1
    while 2 * top * POWER <= n:
        top *= 2
    small = min(top, 1 << max(0, (width // 8).bit_length() - 1))
    for low, high, wide in [(1, small, width), *((s, s, 8 * s) for s in (small << i for i in range(1, 64)) if s <= top)]:
        wide = max(wide // high, 1) * high
        if n < max(LEAST, POWER * low):
            return
        step = n if n <= wide + 4 * high else wide
        for at in range(0, n, step):
            yield low, high, at, min(at + step, n), min(at + step + 4 * high, n)


def _factors(most: int) -> np.ndarray:
    """The smallest prime factor of every number up to ``most``."""
    f = np.arange(most + 1)
    for p in range(2, int(most**0.5) + 1):
        if f[p] == p:
            own = f[p * p :: p]
            own[own == np.arange(p * p, most + 1, p)] = p
    return f


def solve(words: list[np.ndarray], low: list[int], high: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(tile, period, start, finish): the stretches whose words equal those one period on, for each tile's octaves.

    All tiles of a call are laid out in one array, the ones with the largest octaves first and each filled up to a
    multiple of its largest one with names that occur nowhere else, so that blocks of every octave are rows of a reshaped array.
    """
    order = sorted(range(len(words)), key=lambda i: -high[i])
    sizes = [-(-(len(words[i]) + 1) // high[i]) * high[i] for i in order]
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    flat = -1 - np.arange(starts[-1], dtype=np.int64)
    for i, at in zip(order, starts, strict=False):
        flat[at : at + len(words[i])] = words[i]
    tops, lows = np.array([high[i] for i in order]), np.array([low[i] for i in order])
    name, s = mix(flat.astype(U)), 1
    factors = _factors(2 * int(tops.max(initial=1)))
    while len(tops) and s <= tops[0]:
        live = int(starts[np.searchsorted(-tops, -s, "right")])
        name = name[:live]
        grid = name.reshape(-1, s)
        rows, cols = [], []
        for r in range(0, len(grid) - 1, max(1, (1 << 20) // s)):
            a, b = np.nonzero(grid[r + 1 : r + 1 + max(1, (1 << 20) // s)] == grid[r : min(r + max(1, (1 << 20) // s), len(grid) - 1), :1])
            rows.append(a + r)
            cols.append(b)
        k, q = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (rows, cols))
        at, q = k * s, q + s
        # A block whose shift is a multiple of a period of it and of what it is compared with belongs to the smaller one.
        keep, rest = lows[np.searchsorted(starts, at, "right") - 1] <= s, q.copy()
        while (rest > 1).any():
            f = factors[rest]
            d = q // f
            smaller = np.ones(len(q), bool)
            for o in (np.zeros_like(q), np.minimum(s, q - d), q - d):
                smaller &= name[at + o] == name[at + o + d]
            keep &= ~(smaller & (rest > 1))
            rest = np.where(rest > 1, rest // f, 1)
        k, q = k[keep], q[keep]
        by = np.lexsort((k, q))
        k, q = k[by], q[by]
        first = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (k[1:] != k[:-1] + 1)]) if len(k) else np.zeros(0, np.int64)
        last = np.r_[first[1:], len(k)] - 1 if len(k) else first
        for a, b in zip(first, last, strict=True):
            p, x, y = int(q[a]), int(k[a]) * s, int(k[b] + 1) * s
            t = int(np.searchsorted(starts, x, "right")) - 1
            begin, end = int(starts[t]), int(starts[t]) + len(words[order[t]])
            lo, hi = max(begin, x - s), min(end - p, y + s)
            # Z-values at the boundaries, and a comparison of all words between them.
            gaps = np.flatnonzero(flat[lo:hi] != flat[lo + p : hi + p]) + lo
            edges = np.r_[lo - 1, gaps, hi]
            for u, v in zip(edges[:-1] + 1, edges[1:], strict=True):
                if u < y and v > x and v > u:
                    yield order[t], p, int(u) - begin, int(v) - begin
        s *= 2
        if s <= tops[0]:
            name = name[: int(starts[np.searchsorted(-tops, -s, "right")])]
            on = np.concatenate([name[s // 2 :], mix(np.arange(s // 2, dtype=U) + U(1 << 63))])[: len(name)]
            name = mix(name * U(0x9E3779B97F4A7C15) + on + U(s))


def fragments(texts: list[np.ndarray], width: int = TILE) -> list[list[tuple[int, int, int]]]:
    """The fragments (period, start, finish) of every text, given as numbers of words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    held: list[tuple[int, int, int, bool, np.ndarray, int, int]] = []

    def flush() -> None:
        found = solve([h[4] for h in held], [h[5] for h in held], [h[6] for h in held])
        for i, p, a, b in found:
            text, at, n, whole, *_ = held[i]
            # What lies whole within a text that is one tile must be long enough; else other tiles may go on.
            if not whole or b - a + p >= max(LEAST, POWER * p):
                out[text].append((p, at + a, at + b))
        held.clear()

    n = 0
    for i, w in enumerate(texts):
        for low, high, at, _, finish in tiles(len(w), width):
            start = max(0, at - high)
            held.append((i, start, len(w), start == 0 and finish == len(w), w[start:finish], low, high))
            n += finish - start
            if n >= 1 << 19:
                flush()
                n = 0
    flush()
    return out


def _read(rewrite: Rewrite | None):
    """Each text's number of words and fragments, and its words if it has any; else its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rebatch(batches, 2):
            ids, found, numbers, texts = defaultdict(count().__next__), b.column(1).to_pylist(), [], []
            for t, doc_id in zip(b.column(2), found, strict=True):
                words = t.as_buffer().to_pybytes().split() if t.is_valid else []
                own = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
                at = rewrite(doc_id, len(words)) if rewrite else None
                if at is not None:
                    own, words = own[at], [words[i] for i in at.tolist()]
                numbers.append(own)
                texts.append(b" ".join(words))
            made = fragments(numbers)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(found, pa.int64()), pa.array([[{"period": p, "start": x, "finish": y} for p, x, y in f] for f in made], pa.list_(pa.struct([("period", pa.int32()), ("start", pa.int64()), ("finish", pa.int64())]))),
                pa.array([t if f else None for t, f in zip(texts, made, strict=True)], pa.binary()),
                pa.array([None if f else hashlib.sha256(t).hexdigest() for t, f in zip(texts, made, strict=True)], pa.string()),
            ], ["row", "doc_id", "fragments", "words", "plain"])

    return run


def stitched(found: DataFrame, keys: tuple[str, ...] = ("row",)) -> DataFrame:
    """(keys, period, start, length): fragments (keys, period, start, finish) that touch become runs.

    Intervals that a smaller period has as well, and those that are too short, go.
    """
    w = Window.partitionBy(*keys, "period").orderBy("start", "finish")
    reach = F.max("finish").over(w.rowsBetween(Window.unboundedPreceding, -1))
    parts = found.withColumn("fresh", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1))).withColumn("nth", F.sum("fresh").over(w))
    whole = parts.groupBy(*keys, "period", "nth").agg(F.min("start").alias("start"), (F.max("finish") - F.min("start") + F.col("period")).alias("length"))
    long = whole.where((F.col("length") >= LEAST) & (F.col("length") >= POWER * F.col("period")))
    return long.groupBy(*keys, "start", "length").agg(F.min("period").cast("bigint").alias("period"))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of the words that no run repeats."""
    for b in batches:
        out = []
        for t, runs in zip(b.column(1), b.column(2), strict=True):
            words = t.as_buffer().to_pybytes().split(b" ")
            edge = np.zeros(len(words) + 1, np.int64)
            for r in runs.as_py() or []:
                edge[r["start"] + r["period"]] += 1
                edge[r["start"] + r["length"]] -= 1
            kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
            out.append(hashlib.sha256(b" ".join([words[i] for i in kept])).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["row", "collapsed_sha256"])


def detect(docs: DataFrame, rewrite: Rewrite | None = None) -> tuple[DataFrame, DataFrame, Workspace]:
    """((row, doc_id, words, plain), (row, start, length, period), their workspace) of ``docs`` (doc_id, text)."""
    work = Workspace(docs.sparkSession, "periodic")
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = work.save(keyed.mapInArrow(_read(rewrite), f"row bigint, doc_id bigint, fragments {FRAGMENTS}, words binary, plain string"), "read", compression="zstd")
    found = read.where("size(fragments) > 0").select("row", F.explode("fragments").alias("f")).select("row", "f.*")
    return read.drop("fragments"), work.save(stitched(found), "runs"), work


def summarise(read: DataFrame, runs: DataFrame, work: Workspace) -> DataFrame:
    """RESULT for every row."""
    run = F.struct("start", "period", "length")
    first = F.max(F.struct("length", (-F.col("start")).alias("a"), (-F.col("period")).alias("b")))
    by_doc = runs.groupBy("row").agg(F.sort_array(F.collect_list(run)).alias("runs"), first.alias("top"))
    by_doc = work.save(by_doc, "by-row")
    bare = read.where("words IS NOT NULL")
    kept = bare.select("row", "words").join(by_doc.select("row", "runs"), "row", "left").select("row", "words", "runs").mapInArrow(_collapse, "row bigint, collapsed_sha256 string")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    told = by_doc.select("row", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.a")).alias("start"), F.col("top.length").alias("length"), (-F.col("top.b")).alias("period"), F.sha2(lines, 256).alias("runs_sha256"))
    some = bare.select("row", "doc_id").join(kept, "row").join(told, "row", "left")
    none = read.where("words IS NULL").select("row", "doc_id", F.col("plain").alias("collapsed_sha256")).withColumns({c: F.lit(None).cast(t) for c, t in told.dtypes if c != "row"})
    out = some.unionByName(none)
    return out.select("doc_id", F.coalesce("n_runs", F.lit(0)).cast("long").alias("n_runs"), "start", "length", "period", F.expr("CAST(1000 * length DIV period AS BIGINT)").alias("exponent_milli"), F.coalesce("runs_sha256", F.lit(NOTHING)).alias("runs_sha256"), "collapsed_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise(*detect(table(spark, sf_dir, "documents").select("doc_id", "text"), plant))
