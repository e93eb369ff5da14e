"""Near-duplicate documents: Jaccard self-join of word shingles with adaptive multi-match prefixes.

Every document is the set of its distinct k-word shingles, held as 64-bit hashes. All sets are ordered by one global
order, the estimated number of documents that hold a shingle (a fixed-size table of counters over all documents) and
then the hash. A document that needs ``o`` shared shingles with any partner gets the first ``size - o + l`` of its
set as prefix, where ``l`` is chosen per document: each longer prefix costs more index entries, but a pair then counts
only if it shares ``min(l, l')`` prefix shingles, so documents whose prefixes hit popular shingles lengthen them and
ask for more shared ones. Pairs that share enough are verified on the whole sets.

Equal sets are one representative, with a key of its own (a document's id may be repeated or stand for several texts).
A group of n near copies never makes its n * n pairs: star-shaped
candidates (each prefix shingle links its documents to the ones of the highest priority) are verified first, and again
a few times between the components that they make, with other priorities; then the exact round only joins
documents that are not yet in one component, which loses no component.

Defined cases: null, empty and all-space texts have size 0, link with nothing and are their own component; fewer
than k words make one shingle of the whole sequence; rows of a repeated doc_id are one document each, and texts that
share an id share a component; a null doc_id is never linked and has a null component; other columns are ignored.

Hot keys: a shingle, a group of equal sets or a document that links many others is dealt to many tasks (``spread_join``).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovespark.llm.common import Workspace, rebatch, spread_join
from grovespark.llm.components import components
from grovespark.llm.words import U, mix, shingle_rows

#: Counters of the table of shingle counts: its size, and so what is broadcast, is fixed.
SKETCH_BITS = 20
CHUNK, FAN_IN = 1 << 14, 32
#: The longest extension that a prefix may get.
MOST_MATCHES = 4
#: Rounds between components, the exact one included, and the documents that each shingle picks in the others.
STAR_ROUNDS, HUBS = 2, 12
#: What two documents with equal sets have in common.
SAME = ("n_shingles", "fp1", "fp2")


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> U(64 - SKETCH_BITS)).astype(np.int64)


def _count(hashes):
    """Counts, in the fixed table, what ``hashes`` gives of each batch (arrays of hashes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, n = np.zeros(1 << SKETCH_BITS, np.int64), [], 0

        def flush() -> None:
            nonlocal n
            if held:
                counts[:] += np.bincount(_bucket(np.concatenate(held)), minlength=len(counts))
                held.clear()
                n = 0

        for b in batches:
            for h in hashes(b):
                held.append(h)
                n += len(h)
                if n > 1 << 20:
                    flush()
        flush()
        task = uuid.uuid4().hex
        for i in range(0, len(counts), CHUNK):
            yield pa.RecordBatch.from_arrays([pa.array([i // CHUNK], pa.int32()), pa.array([task], pa.string()), pa.array([zlib.compress(counts[i : i + CHUNK].tobytes(), 1)], pa.binary())], ["chunk", "task", "data"])

    return run


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(CHUNK, np.int64)
    for data in rows["data"]:
        total += np.frombuffer(zlib.decompress(data), np.int64)
    return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "task": rows["task"].iloc[:1], "data": [zlib.compress(total.tobytes(), 1)]})


def counters(df: DataFrame, hashes, work: Workspace) -> np.ndarray:
    """How many hashes fall on each counter, over all rows: ``2 ** SKETCH_BITS`` counters, whatever the input's size.

    The counters of the tasks are added up in a tree whose nodes take about ``FAN_IN`` tables each.
    """
    schema, chunks = "chunk int, task string, data binary", (1 << SKETCH_BITS) // CHUNK
    rows = work.save(df.mapInArrow(_count(hashes), schema), "counts")
    while (tables := rows.count() / chunks) > FAN_IN:
        slot = F.pmod(F.xxhash64("task"), F.lit(int(np.ceil(tables / FAN_IN))))
        rows = work.save(rows.groupBy("chunk", slot.alias("slot")).applyInPandas(lambda key, x: _add(x), schema), "counts")
    out = np.zeros(1 << SKETCH_BITS, np.int32)
    for r in rows.groupBy("chunk").applyInPandas(_add, schema).toLocalIterator():
        own = np.frombuffer(zlib.decompress(r["data"]), np.int64)
        out[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.minimum(own, 2**31 - 1)
    return out


def choose(size: int, need: int, frequency: np.ndarray, background: float) -> int:
    """The number of shared prefix shingles to ask for, by estimated candidates.

    ``frequency``: of the shingles in global order. A prefix that asks for l matches reads ``sum(df)`` entries and, if
    matches fall evenly, leaves ``sum(df) / l`` pairs to verify, each as costly as ``size`` / 8 entries.
    """
    best, cost = 1, np.inf
    own = np.maximum(frequency - background, 0.0)
    for l in range(1, MOST_MATCHES + 1):
        p = size - need + l
        if p > size:
            break
        entries = p + own[:p].sum()
        now = entries + own[:p].sum() / l**2 * size / 8
        if now < cost * 0.95:
            best, cost = l, now
    return best


def fingerprint(h: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of hashes."""
    if not len(h):
        return 0, 0
    with np.errstate(over="ignore"):
        return int(np.add.reduce(h).astype(np.int64)), int(np.bitwise_xor.reduce(mix(h + U(0x5851F42D4C957F2D))).astype(np.int64))


def _prefixes(k: int, percent: int, sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sketch.value
        background = float(np.median(table))
        for b in rebatch(batches, 1):
            order_of, sizes, prints, matches, prefixes = [], [], [], [], []
            for r, _, h in shingle_rows(b.column(1), k):
                n = len(h)
                order_of.append(r)
                sizes.append(n)
                prints.append(fingerprint(h))
                if not n:
                    matches.append(0)
                    prefixes.append([])
                    continue
                df = table[_bucket(h)]
                order = np.lexsort((h, df))
                need = -(-percent * n // 100)
                l = choose(n, need, df[order[: n - need + MOST_MATCHES]].astype(float), background)
                matches.append(l)
                prefixes.append(h[order[: n - need + l]].view(np.int64))
            flat = np.concatenate([np.asarray(p, np.int64) for p in prefixes]) if prefixes else np.zeros(0, np.int64)
            at = np.cumsum([0, *map(len, prefixes)])
            fp1, fp2 = zip(*prints, strict=True) if prints else ((), ())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(order_of, pa.int32())), pa.array(sizes, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), pa.array(matches, pa.int32()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int64()))], ["doc_id", "n_shingles", "fp1", "fp2", "matches", "prefix"])

    return run


def _print_hashes(b: pa.RecordBatch) -> list[np.ndarray]:
    return [b.column(0).to_numpy().view(U)]


def _sets(k: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rebatch(batches, 0):
            found = []
            for _, _, h in shingle_rows(b.column(0), k):
                if len(h):
                    fp = fingerprint(h)
                    if wanted.value[_bucket(np.array([fp[1]], np.int64).view(U))[0]]:
                        found.append((fp, h.view(np.int64)))
            nth = np.cumsum([0, *(len(h) for _, h in found)])
            flat = np.concatenate([h for _, h in found]) if found else np.zeros(0, np.int64)
            sizes, fp1, fp2 = [len(h) for _, h in found], [f[0] for f, _ in found], [f[1] for f, _ in found]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(fp1, pa.int64()), pa.array(fp2, pa.int64()), pa.ListArray.from_arrays(pa.array(nth, pa.int32()), pa.array(flat, pa.int64()))], [*SAME, "shingles"])

    return run


def _whole_sets(docs: DataFrame, ids: DataFrame, reps: DataFrame, k: int, work: Workspace) -> DataFrame:
    """(rep, shingles) of the representatives in ``ids`` (rep); texts are not shuffled.

    A table of counters of their fingerprints, of fixed size, keeps most other documents' sets from being sent; the join
    does the rest. Of equal sets one is kept, before any shuffle too.
    """
    keys = work.save(reps.select("rep", *SAME).join(ids, "rep", "left_semi"), "keys")
    wanted = docs.sparkSession.sparkContext.broadcast(counters(keys.select("fp2"), _print_hashes, work) > 0)
    sets = docs.select("text").mapInArrow(_sets(k, wanted), "n_shingles bigint, fp1 bigint, fp2 bigint, shingles array<bigint>")
    one = sets.groupBy(*SAME).agg(F.first("shingles").alias("shingles"))
    return work.save(one.join(keys, list(SAME)).select("rep", "shingles"), "sets")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of a written table whose whole sets are similar enough."""
    rest = [c for c in pairs.columns if c not in ("a", "b")]
    joined = spread_join(pairs, sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), ["a"])
    joined = spread_join(joined, sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), ["b"], counts=pairs.groupBy("b").agg(F.count("*").alias("n")), by=["a"])
    both = F.size(F.array_intersect("sa", "sb"))
    return joined.select("a", "b", *rest, "sa", "sb", both.alias("both")).where(100 * F.col("both") >= percent * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b", *rest)


def link(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (columns doc_id, text).

    Two documents link if 100 * |A & B| >= ``percent`` * |A | B| for their sets of ``k``-word shingles.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = spark.sparkContext.broadcast(counters(docs.select("text"), lambda b: (h for _, _, h in shingle_rows(b.column(0), k)), work))
    per_doc = work.save(docs.mapInArrow(_prefixes(k, percent, sketch), "doc_id bigint, n_shingles bigint, fp1 bigint, fp2 bigint, matches int, prefix array<bigint>"), "prefixes")

    full = per_doc.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = full.groupBy(*SAME).agg(F.min("doc_id").alias("low"), F.count("*").alias("n_docs"), F.first("matches").alias("matches"), F.first("prefix").alias("prefix"))
    reps = work.save(reps.withColumn("rep", F.monotonically_increasing_id()), "representatives")
    slim = work.save(per_doc.drop("matches", "prefix"), "documents")
    work.drop(per_doc)
    entries = work.save(reps.select("rep", F.col("n_shingles").alias("n"), "matches", F.posexplode("prefix").alias("pos", "token")), "entries")
    tokens = work.save(entries.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "tokens")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    shared = held = work.save(spread_join(entries, tokens.select("token"), ["token"], "left_semi", counts=tokens, total=total), "shared")
    work.drop(entries)
    work.settle()

    # A pair that shares s prefix shingles shares at most s and what follows the prefix in one of the two sets.
    rest = f"({percent} * n + 99) div 100 - matches"
    shared = shared.withColumn("rest", F.expr(rest))
    enough = f"100 * least(n, n_o) >= {percent} * greatest(n, n_o) AND s + greatest(rest, rest_o) >= ({percent} * (n + n_o) + {99 + percent}) div {100 + percent}"

    # Stars: in two orders of priority, each prefix shingle links its documents to the one of the highest priority.
    # The few documents that lead a group lead it in most of its shingles, so a document meets a handful of them.
    hub = ["rep", "n", "rest"]
    ranks = [F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("h"), *hub)).alias(f"hub{turn}") for turn in range(2)]
    hubs = shared.groupBy("token").agg(*ranks).select("token", F.explode(F.array_distinct(F.array(*(F.struct(*(f"hub{t}.{x}" for x in hub)) for t in range(2))))).alias("o"))
    hubs = work.save(hubs.select("token", F.col("o.rep").alias("a"), F.col("o.n").alias("n_o"), F.col("o.rest").alias("rest_o")), "hubs")
    met = spread_join(shared, hubs, ["token"], counts=tokens, total=total).where("rep <> a").groupBy("a", F.col("rep").alias("b")).agg(F.count("*").alias("s"), *(F.first(x).alias(x) for x in ("n", "rest", "n_o", "rest_o")))
    pairs = work.save(met.where(enough).select("a", "b"), "pairs")
    sets = _whole_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), reps, k, work)
    # Texts that share an id are linked through it.
    members = slim.where("n_shingles > 0 AND doc_id IS NOT NULL")
    several = members.groupBy("doc_id").agg(*(x for c in SAME for x in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}")))).where(" OR ".join(f"low_{c} <> high_{c}" for c in SAME))
    several = members.join(several, "doc_id", "left_semi").distinct().join(reps.select("rep", *SAME), list(SAME)).select("doc_id", "rep")
    by_id = several.join(several.groupBy("doc_id").agg(F.min("rep").alias("a")), "doc_id").where("rep <> a").select("a", F.col("rep").alias("b"))
    stars = work.save(_verified(pairs, sets, percent).union(by_id), "links")
    work.drop(hubs, pairs, sets)
    work.settle()
    labels = work.save(components(stars, work), "components")

    # What is left: prefix shingles that hold more than one component, and the sets of their documents.
    def apart(own: DataFrame) -> DataFrame:
        several = own.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("token")
        return work.save(spread_join(own, several, ["token"], "left_semi", counts=tokens, total=total), "apart")

    labelled = work.save(shared.join(labels, shared["rep"] == labels["node"], "left").withColumn("c", F.coalesce("component", "rep")).drop("node", "component"), "labelled")
    work.drop(held)
    # Against a partner of at least its size a document needs a shorter prefix; a shared shingle's places bound what can be shared.
    need = f"({percent} * (n + n_o) + {99 + percent}) div {100 + percent}"
    labelled_short = labelled.withColumn("short", F.expr(f"pos < n - ({2 * percent} * n + {99 + percent}) div {100 + percent} + matches"))
    own = apart(labelled_short)
    work.drop(labelled)
    work.settle()
    mine = ["rep", "n", "matches", "c", "pos", "short"]
    side = reps.select("rep", "prefix", F.expr(f"({percent} * n_shingles + 99) div 100 - matches").alias("rest"))

    checked: list[DataFrame] = []

    def between(own: DataFrame, other: DataFrame, asked: bool) -> DataFrame:
        """Verified links of documents of ``own`` with those of ``other`` in other components: pairs of components. No pair is verified twice."""
        met = spread_join(own.select("token", *mine), other.select("token", *(F.col(x).alias(f"{x}_o") for x in mine)), ["token"], counts=tokens, total=total).where(
            f"c <> c_o AND {'rep < rep_o' if asked else 'rep <> rep_o'} AND 100 * least(n, n_o) >= {percent} * greatest(n, n_o) AND (short OR n > n_o) AND (short_o OR n_o > n) AND least(pos, pos_o) + least(n - pos, n_o - pos_o) >= {need}"
        )
        counted = met.groupBy(F.col("rep").alias("a"), F.col("rep_o").alias("b"), F.col("c").alias("c_a"), F.col("c_o").alias("c_b"), "n", "n_o").agg(F.count("*").alias("s"), F.first(F.least("matches", "matches_o")).alias("ask"), F.min("pos").alias("pos"), F.min("pos_o").alias("pos_o"))
        # Nothing before the first shared shingle is shared, in either set.
        counted = counted.where(f"least(n - pos, n_o - pos_o) >= {need}" + (" AND s >= ask" if asked else ""))
        # Then by all that the whole prefixes share.
        counted = counted.join(side.select(F.col("rep").alias("a"), F.col("prefix").alias("pa"), F.col("rest").alias("ra")), "a").join(side.select(F.col("rep").alias("b"), F.col("prefix").alias("pb"), F.col("rest").alias("rb")), "b")
        counted = counted.where(f"size(array_intersect(pa, pb)) + greatest(ra, rb) >= {need}").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.expr("IF(a < b, c_a, c_b) AS c_a"), F.expr("IF(a < b, c_b, c_a) AS c_b"))
        counted = counted if asked else counted.distinct()
        for done in checked:
            counted = counted.join(done.select("a", "b"), ["a", "b"], "left_anti")
        counted = work.save(counted, "candidates")
        checked.append(counted)
        work.settle()
        sets = _whole_sets(docs, counted.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), reps, k, work)
        found = _verified(counted, sets, percent)
        out = work.save(found.select(F.least("c_a", "c_b").alias("a"), F.greatest("c_a", "c_b").alias("b")).distinct(), "joined")
        work.drop(sets)
        work.settle()
        return out

    # Stars again, between components: each shingle of many documents picks a few of them at random for the others, so that
    # large components meet often and a large group of near copies comes together without its pairs. Then exactly, all
    # pairs of different components in a prefix shingle, those of few documents included.
    for turn in range(1, STAR_ROUNDS + 1):
        exact = turn == STAR_ROUNDS
        if exact:
            joined = between(own, own, True)
        else:
            ranks = [F.min(F.struct(F.xxhash64("rep", "token", F.lit(HUBS * turn + t)).alias("h"), *mine)).alias(f"hub{t}") for t in range(HUBS)]
            hubs = own.groupBy("token").agg(*ranks, F.count("*").alias("held")).where(F.col("held") > 2 * HUBS).select("token", F.explode(F.array_distinct(F.array(*(F.struct(*(f"hub{t}.{x}" for x in mine)) for t in range(HUBS))))).alias("o"))
            hubs = work.save(hubs.select("token", "o.*"), "hubs")
            joined = between(own, hubs, False)
            work.drop(hubs)
        if joined.isEmpty():
            continue
        top = work.save(components(joined, work).select(F.col("node").alias("was"), F.col("component").alias("to")), "top")
        everyone = labels.union(joined.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("component")))
        merged = everyone.join(top, F.col("component") == F.col("was"), "left").groupBy("node").agg(F.min(F.coalesce("to", "component")).alias("component"))
        merged = work.save(merged, "components")
        work.drop(labels)
        labels = merged
        if not exact:
            moved = apart(work.save(own.join(top, F.col("c") == F.col("was"), "left").withColumn("c", F.coalesce("to", "c")).drop("was", "to"), "labelled"))
            work.drop(own)
            own = moved
    merged = labels
    work.drop(own, *checked)
    work.settle()

    # A component is called by the smallest id in it.
    named = work.save(reps.join(merged, reps["rep"] == merged["node"], "left").select(*SAME, "low", "n_docs", F.coalesce("component", "rep").alias("c")), "named")
    least = work.save(named.groupBy("c").agg(F.min("low").alias("component_id"), F.count("*").alias("n")), "least")
    member = work.save(spread_join(named, least.select("c", "component_id"), ["c"], counts=least.select("c", "n")).select(*SAME, "n_docs", "component_id"), "members")
    work.drop(named, least, labels, reps)
    empty = slim.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    joined = spread_join(members, member.drop("n_docs"), list(SAME), counts=member.select(*SAME, F.col("n_docs").alias("n")))
    return joined.select("doc_id", "n_shingles", "component_id").union(empty)


def query(spark, sf_dir: str) -> DataFrame:
    return link(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4, percent=85)
