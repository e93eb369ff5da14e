"""Approximate nearest neighbours by inner product, with learned partitions.

On a bounded sample (``sample_rows`` vectors by hash) a neighbour graph is built and cut into balanced parts: parts
start as balanced cells around sample vectors and are refined by moving vertices to the part that most of their
neighbours are in, as far as that part has room. A small classifier (one hidden layer, trained in numpy on the
neighbours' parts) then learns which parts a vector's neighbours are in. Every row of the table goes to its most
probable part; a query goes to the most probable parts until, on the sample, the wanted share of true neighbours is
found, and is reranked there by exact inner products in double precision.

A part is dealt out in blocks of at most ``BLOCK`` candidates and ``BLOCK`` queries, so a part with many equal vectors
is many tasks; a block gives each query its best k, and these are merged.

Defined cases: vectors that are null, of another length than most (ties: the shorter), zero, or hold null or non-finite
components take no part; ties go to the smaller vec_id; fewer than k candidates give all; repeated vec_ids are rows of
their own, and a query never meets rows with its own id; a null vec_id takes no part; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.llm.common import Workspace, table

BLOCK = 4096
NEIGHBOURS = 16


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    d = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    d = d.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).where(F.exists("v", lambda x: x != 0))
    length = d.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    return d.where(F.size("v") == (length["n"] if length else 0))


def nearest(queries: np.ndarray, pool: np.ndarray, k: int, skip_self: bool = False) -> np.ndarray:
    """Indices of the k best of ``pool`` for each query, in blocks."""
    out = []
    for i in range(0, len(queries), 512):
        s = queries[i : i + 512] @ pool.T
        if skip_self:
            s[np.arange(len(s)), i + np.arange(len(s))] = -np.inf
        kk = min(k, s.shape[1] - skip_self)
        out.append(np.argpartition(-s, kk - 1, axis=1)[:, :kk])
    return np.concatenate(out)


def cut_graph(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 15) -> np.ndarray:
    """A part for each vertex: balanced to within a twentieth, with few neighbours in other parts."""
    n = len(x)
    room = int(np.ceil(n / parts * 1.05))
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    centres = unit[rng.choice(n, parts, replace=False)]
    part = np.zeros(n, np.int64)
    for _ in range(8):  # balanced cells: the surest vertices choose first
        s = unit @ centres.T
        choice = np.argsort(-s, axis=1)
        left = np.full(parts, room)
        for v in np.argsort(-(s.max(axis=1) - s.mean(axis=1))):
            for p in choice[v]:
                if left[p]:
                    part[v] = p
                    left[p] -= 1
                    break
        centres = np.stack([unit[part == p].mean(axis=0) if (part == p).any() else unit[rng.integers(n)] for p in range(parts)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    back = [[] for _ in range(n)]
    for v, row in enumerate(graph):
        for u in row:
            back[u].append(v)
    sizes = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        moved = 0
        for v in rng.permutation(n):
            votes = np.bincount(part[np.concatenate([graph[v], back[v]]).astype(np.int64)], minlength=parts).astype(float)
            votes[(sizes >= room) & (np.arange(parts) != part[v])] = -1
            p = int(votes.argmax())
            if votes[p] > votes[part[v]]:
                sizes[part[v]] -= 1
                sizes[p] += 1
                part[v] = p
                moved += 1
        if not moved:
            break
    return part


class Router:
    """The classifier: vectors to the logarithm of each part's probability."""

    def __init__(self, x: np.ndarray, target: np.ndarray, hidden: int, rng: np.random.Generator, epochs: int = 40):
        d, parts = x.shape[1], target.shape[1]
        self.scale = 1.0 / max(float(x.std()), 1e-12)
        p = [rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, (hidden, parts)), np.zeros(parts), rng.normal(0, d**-0.5, (d, parts))]
        m, s, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        self.p = p
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), 256):
                own = order[i : i + 256]
                z, y = x[own] * self.scale, target[own]
                h = np.maximum(z @ p[0] + p[1], 0)
                o = h @ p[2] + p[3] + z @ p[4]
                o = np.exp(o - o.max(axis=1, keepdims=True))
                d_o = (o / o.sum(axis=1, keepdims=True) - y) / len(own)
                d_h = (d_o @ p[2].T) * (h > 0)
                step += 1
                for j, g in enumerate((z.T @ d_h, d_h.sum(axis=0), h.T @ d_o, d_o.sum(axis=0), z.T @ d_o)):
                    m[j] += 0.1 * (g - m[j])
                    s[j] += 0.01 * (g * g - s[j])
                    p[j] -= 0.003 * (m[j] / (1 - 0.9**step)) / (np.sqrt(s[j] / (1 - 0.99**step)) + 1e-8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        z, p = x * self.scale, self.p
        return np.maximum(z @ p[0] + p[1], 0) @ p[2] + p[3] + z @ p[4]


def fit(sample: np.ndarray, parts: int, k: int, recall: float, seed: int = 3) -> tuple[Router, int]:
    """(router, parts to search): what is searched is set on a tenth of the sample that the router hasn't seen."""
    rng = np.random.default_rng(seed)
    x = sample[rng.permutation(len(sample))]
    held = max(1, len(x) // 10) if len(x) > 50 else 0
    own, test = x[held:], x[:held]
    parts = max(1, min(parts, len(own) // 8))
    kk = min(NEIGHBOURS, max(1, len(own) - 1))
    graph = nearest(own, own, kk, skip_self=True) if len(own) > 1 else np.zeros((len(own), 0), np.int64)
    part = cut_graph(own, graph, parts, rng)
    target = np.zeros((len(own), parts))
    for v in range(len(own)):  # a vector's own part and those of its neighbours
        target[v] = np.bincount(part[np.append(graph[v], v)], minlength=parts)
    router = Router(own, target / np.maximum(target.sum(axis=1, keepdims=True), 1), 64, rng)
    if not held or parts == 1:
        return router, parts
    home = router.scores(own).argmax(axis=1)
    true = home[nearest(test, own, min(k, len(own)))]
    rank = np.argsort(np.argsort(-router.scores(test), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(rank, true, axis=1).ravel())
    return router, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1


def _route(router, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = router.value
        for b in batches:
            x = np.stack(b.column(1).to_numpy(zero_copy_only=False)) if b.num_rows else np.zeros((0, r.p[0].shape[0]))
            order = np.argsort(-r.scores(x), axis=1, kind="stable")[:, :most].astype(np.int32) if b.num_rows else np.zeros((0, most), np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * order.shape[1], pa.int32()), pa.array(order.ravel(), pa.int32()))], ["vec_id", "v", "parts"])

    return run


def _search(k: int):
    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            q, c, ids = np.stack(left["v"]), np.stack(right["v"]), right["vec_id"].to_numpy()
            for i in range(0, len(q), 256):
                s = q[i : i + 256] @ c.T
                own = left["vec_id"].to_numpy()[i : i + 256]
                s[own[:, None] == ids[None, :]] = -np.inf
                edge = np.partition(s, s.shape[1] - k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -1e308)
                # All that may be among the best, ties and rounding of the block product included; then exactly.
                row, col = np.nonzero((s >= (edge - 1e-9 * (1 + np.abs(edge)))[:, None]) & (s > -np.inf))
                exact = (q[i + row] * c[col]).sum(axis=1)
                order = np.lexsort((ids[col], -exact, row))
                row, col, exact = row[order], col[order], exact[order]
                nth = np.arange(len(row)) - np.searchsorted(row, row)
                best = nth < k
                out.append(pd.DataFrame({"query_id": own[row[best]], "vec_id": ids[col[best]], "score": exact[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    return run


def search(vectors: DataFrame, is_query, k: int = 20, recall: float = 0.93, sample_rows: int = 8192, parts: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that ``is_query`` (a column over vec_id) marks."""
    spark = vectors.sparkSession
    work = Workspace(spark, "ann")
    rows = work.save(usable(vectors), "vectors")
    n = rows.count()
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    if n < 2:
        return spark.createDataFrame([], empty)
    # Parts of about a block of rows, but with at least 64 sample rows each: beyond that parts grow, and are dealt in blocks.
    parts = parts or int(min(sample_rows // 64, max(4, n // BLOCK)))
    share = min(1.0, 1.1 * sample_rows / n + 100 / n)
    sample = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(23)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(sample_rows).toPandas().sort_values("vec_id")
    router, probes = fit(np.stack(sample["v"]), parts, k, recall)
    shared = spark.sparkContext.broadcast(router)
    routed = "vec_id bigint, v array<double>, parts array<int>"
    homes = work.save(rows.mapInArrow(_route(shared, 1), routed).select("vec_id", "v", F.element_at("parts", 1).alias("part")), "homes")
    asked = work.save(rows.where(is_query).mapInArrow(_route(shared, probes), routed).select("vec_id", "v", F.explode("parts").alias("part")), "asked")
    # How many blocks each part needs on either side: a row for each part.
    blocks = homes.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("c")).join(asked.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("q")), "part")
    blocks = work.save(blocks, "blocks")
    spread = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.col("n_blocks")).cast("int")
    left = asked.join(F.broadcast(blocks), "part").withColumn("n_blocks", F.col("q")).withColumn("qb", spread).withColumn("cb", F.explode(F.sequence(F.lit(0), F.col("c") - 1))).select("part", "qb", "cb", "vec_id", "v")
    right = homes.join(F.broadcast(blocks), "part").withColumn("n_blocks", F.col("c")).withColumn("cb", spread).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("q") - 1))).select("part", "qb", "cb", "vec_id", "v")
    keys = ["part", "qb", "cb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_search(k), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
