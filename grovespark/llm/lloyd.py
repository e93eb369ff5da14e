"""Lloyd's centroid clustering sharded by dimension, in exact integers.

Vectors are quantised, packed into chunks of ``CHUNK`` rows and cut into column blocks; a chunk's block is a row of a
written table. In a round, a task holds one block's columns of a chunk and the same columns of the centroids (nothing
else) and computes the chunk's exact partial distances; these are added by chunk over its blocks, and the argmin of the sums assigns the
rows. The assignments go back to the blocks by chunk, and every block sums its own columns by cluster and so makes its
own slice of the new centroids: what meets are blocks x clusters sums. Nothing that grows with the rows reaches the driver or a
broadcast: the centroids, clusters x dimensions integers, do.

Defined cases: vectors of another length than ``dims``, null, or with null or non-finite components take no part, nor do
those with a component of ``LARGEST`` or more in size after scaling (their distances would not fit into a long); ties
go to the smaller cluster number; repeated vec_ids are rows of their own, and start centroids in the order of their
components; a null vec_id is clustered too and starts a centroid only after all others; with fewer vectors than
clusters there are as many clusters as vectors; extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.llm.common import Workspace, table

#: Rows of a chunk: with k clusters its partial distances take 8 * CHUNK * k bytes.
CHUNK = 512
#: Scaled components stay below this, so that 2^8 squares of differences stay below 2^62.
LARGEST = 1 << 26
PACKED = "chunk bigint, block int, n int, x binary"
RESULT = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def quantised(vectors: DataFrame, dims: int, scale: int, column: str = "embedding") -> DataFrame:
    """(vec_id, x array<bigint>): floor(scale * component) of the vectors that take part."""
    d = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).where(F.col("v").isNotNull() & (F.size("v") == dims))
    # Not a number counts as greater than any number here.
    d = d.where(F.forall("v", lambda c: F.coalesce(F.abs(c) < LARGEST / scale, F.lit(False))))
    return d.select("vec_id", F.transform("v", lambda c: F.floor(c * float(scale))).alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``seed:vec_id``."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(order.asc_nulls_last(), "x").limit(k).select("x").collect()
    return np.array([r["x"] for r in first], np.int64)


def cuts(dims: int, blocks: int) -> list[tuple[int, int]]:
    """The columns of each block."""
    at = np.linspace(0, dims, min(blocks, dims) + 1).astype(int)
    return list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


def _pack(spans: list[tuple[int, int]]):
    """Chunks of rows, cut into column blocks; block -1 holds the ids and which of them are null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 36
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                part = b.slice(at, CHUNK)
                ids = part.column(0)
                x = part.column(1).flatten().to_numpy().reshape(part.num_rows, -1)
                own = np.stack([ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)])
                values = [own.tobytes(), *(np.ascontiguousarray(x[:, i:j]).tobytes() for i, j in spans)]
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk] * len(values), pa.int64()), "block": pa.array(range(-1, len(spans)), pa.int32()), "n": pa.array([part.num_rows] * len(values), pa.int32()), "x": pa.array(values, pa.binary())})
                chunk += 1

    return run


def _partial(slices: list):
    """(chunk, part): exact squared distances of a chunk's rows to all centroids within one block's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, block, n, x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                c = slices[block].value
                v = np.frombuffer(x, np.int64).reshape(n, -1)
                part = np.empty((n, len(c)), np.int64)
                for i, centre in enumerate(c):
                    d = v - centre
                    np.einsum("ij,ij->i", d, d, out=part[:, i])
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int64()), "n": pa.array([n], pa.int32()), "part": pa.array([part.tobytes()], pa.binary())})

    return run


def _argmin(t: pa.Table) -> pa.Table:
    """Adds the partial distances of one chunk, a row for each block, and assigns its rows."""
    n = t.column("n")[0].as_py()
    total = reduce(np.add, (np.frombuffer(p.as_py(), np.int64) for p in t.column("part"))).reshape(n, -1)
    best = total.argmin(axis=1)
    return pa.table({"chunk": t.column("chunk")[:1], "near": pa.array([best.astype(np.int32).tobytes()], pa.binary()), "dist": pa.array([total[np.arange(n), best].tobytes()], pa.binary())})


def assign(shards: DataFrame, centroids: np.ndarray, spans: list[tuple[int, int]]) -> DataFrame:
    """(chunk, near, dist): the nearest centroid of every row of a chunk, and its squared distance."""
    context = shards.sparkSession.sparkContext
    slices = [context.broadcast(centroids[:, i:j]) for i, j in spans]
    parts = shards.where("block >= 0").select("chunk", "block", "n", "x").mapInArrow(_partial(slices), "chunk bigint, n int, part binary")
    return parts.groupBy("chunk").applyInArrow(_argmin, "chunk bigint, near binary, dist binary")


def _sums(k: int):
    """(block, cluster, n, s): a block's columns summed by cluster, over all that the task reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for block, n, x, near in zip(*(c.to_pylist() for c in b.columns), strict=True):
                v, own = np.frombuffer(x, np.int64).reshape(n, -1), np.frombuffer(near, np.int32)
                s, c = held.setdefault(block, (np.zeros((k, v.shape[1]), np.int64), np.zeros(k, np.int64)))
                np.add.at(s, own, v)
                c += np.bincount(own, minlength=k)
        for block, (s, c) in held.items():
            some = np.flatnonzero(c)
            yield pa.RecordBatch.from_pydict({"block": pa.array([block] * len(some), pa.int32()), "cluster": pa.array(some.astype(np.int32)), "n": pa.array(c[some]), "s": pa.array(list(s[some]), pa.list_(pa.int64()))})

    return run


def update(shards: DataFrame, near: DataFrame, centroids: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """New centroids: each block adds its own columns by cluster; empty clusters stay where they are."""
    k = len(centroids)
    joined = shards.where("block >= 0").join(near.select("chunk", "near"), "chunk").select("block", "n", "x", "near")
    sums = joined.mapInArrow(_sums(k), "block int, cluster int, n bigint, s array<bigint>").select("block", "cluster", "n", F.posexplode("s").alias("at", "v"))
    out = centroids.copy()
    # A row for each cluster and dimension.
    for r in sums.groupBy("block", "cluster", "at").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        out[r["cluster"], spans[r["block"]][0] + r["at"]] = r["v"] // r["n"]
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for n, ids, near, dist in zip(*(c.to_pylist() for c in b.columns), strict=True):
            own = np.frombuffer(ids, np.int64).reshape(2, n)
            yield pa.RecordBatch.from_pydict({"vec_id": pa.array(own[0], mask=own[1] > 0), "cluster": pa.array(np.frombuffer(near, np.int32)), "distance": pa.array(np.frombuffer(dist, np.int64))})


def cluster(vectors: DataFrame, k: int, rounds: int, dims: int, scale: int = 256, seed: int = 2, blocks: int = 4, column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), centroids) after ``rounds`` rounds; the rows are a written table."""
    spark = vectors.sparkSession
    work = Workspace(spark, "lloyd")
    rows, spans = quantised(vectors, dims, scale, column), cuts(dims, blocks)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), centroids
    shards = work.save(rows.mapInArrow(_pack(spans), PACKED), "shards", partition_by="block").select("chunk", "block", "n", "x")
    for _ in range(rounds):
        near = work.save(assign(shards, centroids, spans), "near")
        centroids = update(shards, near, centroids, spans)
        work.drop(near)
    near = work.save(assign(shards, centroids, spans), "near")
    ids = shards.where("block = -1").select("chunk", "n", F.col("x").alias("ids"))
    out = work.save(ids.join(near, "chunk").select("n", "ids", "near", "dist").mapInArrow(_rows, "vec_id bigint, cluster int, distance bigint"), "rows")
    return out, centroids


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, seed=2)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    digests = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s"))
    both = sums.crossJoin(F.broadcast(sums.agg(F.sum("s").alias("all")))).select("cluster", F.col("s").try_cast("long").alias("cluster_inertia"), F.col("all").try_cast("long").alias("inertia"))
    # A row for each cluster.
    return rows.join(F.broadcast(both.join(digests, "cluster")), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


_ROUND = """
d{i} AS MATERIALIZED (SELECT v.r, c.cluster, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept v CROSS JOIN c{i} c),
a{i} AS MATERIALIZED (SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM d{i} GROUP BY r),
m{i} AS (SELECT a.cluster, u.pos, CAST(floor(CAST(sum(v.x[u.pos]) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM a{i} a JOIN kept v USING (r) CROSS JOIN (SELECT unnest(range(1, 65)) AS pos) u GROUP BY a.cluster, u.pos),
c{j} AS MATERIALIZED (SELECT c.cluster, coalesce(n.x, c.x) AS x FROM c{i} c LEFT JOIN (SELECT cluster, list(m ORDER BY pos) AS x FROM m{i} GROUP BY cluster) n USING (cluster)),"""

ORACLE = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64
),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS INTEGER) AS cluster, x FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, x FROM kept ORDER BY h NULLS LAST, x LIMIT 40)),
{"".join(_ROUND.format(i=i, j=i + 1) for i in range(6))}
t AS (SELECT cluster, sum(distance) AS s FROM a5 GROUP BY cluster)
SELECT k.vec_id, a.cluster, CAST(a.distance AS BIGINT) AS distance, CAST(t.s AS BIGINT) AS cluster_inertia, CAST((SELECT sum(s) FROM t) AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a5 a JOIN kept k USING (r) JOIN t USING (cluster) JOIN c5 c USING (cluster)
"""
