"""Language ID by hierarchical discrimination: the family first, then one-versus-one linear SVMs inside the family.

Features are relative frequencies of hashed byte 2-, 3- and 4-grams of the whole text (A-Z lower-cased, everything but
letters and non-ASCII characters a space). A linear classifier scores a text as the mean of its n-grams' weights, so a
batch is scored with gathers and sums over its byte buffer. All classifiers are trained here, on a bounded sample of
labelled rows (at most ``per_language`` a language, and its share of ``MOST_ROWS``: those with the smallest hashes of id
and text); features of the sample, of fixed width, are what the driver gets.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without any labelled row all are ``und``;
repeated rows keep a row each; very long texts are worked on in pieces; languages outside the family table are families
of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovespark.llm.common import crc, rebatch, table
from grovespark.llm.words import PIECE, buffers, pieces

#: Families of some languages; fixed values.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca"),
    "slavic": ("ru", "pl", "cs", "sk", "uk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk"),
}
BITS = 13
MOST_ROWS = 4000
ORDERS = (2, 3, 4)
_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def grams(data: np.ndarray, offsets: np.ndarray, stop: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: the bucket of the n-gram at every byte (before ``stop``), and where one fits into its text (a mask)."""
    b = _FOLD[data]
    for n in ORDERS:
        h = np.zeros(len(b), np.uint32)
        for t in range(n):
            h[: len(b) - t] = h[: len(b) - t] * np.uint32(0x01000193) ^ b[t:]
        h = (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        fits = np.ones(len(b), bool)
        for t in range(1, n):
            cut = offsets[1:] - t
            fits[cut[(cut >= 0)]] = False
        if stop is not None:
            fits[stop:] = False
        yield h.astype(np.int64), fits


def _rows(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int | None]]:
    """(first row, end, bytes, offsets, stop) of pieces; a very long text comes in several pieces of one row, each with
    the bytes after ``stop`` that its last n-grams reach into."""
    data, offsets = buffers(col)
    for i, j in pieces(offsets):
        own = offsets[i : j + 1]
        if j == i + 1 and own[1] - own[0] > 4 * PIECE:
            for at in range(int(own[0]), int(own[1]), PIECE):
                end = min(at + PIECE + max(ORDERS) - 1, int(own[1]))
                yield i, j, data[at:end], np.array([0, end - at]), PIECE if end < own[1] else None
        else:
            yield i, j, data[own[0] : own[-1]], own - own[0], None


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in rebatch(batches, 2):
        for k in range(0, b.num_rows, 64):
            part = b.slice(k, 64)
            x = np.zeros((part.num_rows, 1 << BITS), np.float32)
            for i, j, data, offsets, stop in _rows(part.column(2)):
                for h, fits in grams(data, offsets, stop):
                    for r in range(i, j):
                        own = slice(offsets[r - i], offsets[r - i + 1])
                        x[r] += np.bincount(h[own][fits[own]], minlength=1 << BITS)
            x /= np.maximum(x.sum(axis=1, keepdims=True), 1)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())], ["lang", "h", "x"])


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM (squared hinge loss, accelerated gradient steps) for labels -1 and 1."""
    n = len(y)
    weight = np.where(y > 0, n / (2 * max(1, (y > 0).sum())), n / (2 * max(1, (y < 0).sum())))
    w, b = np.zeros(x.shape[1]), 0.0
    pw, pb = w.copy(), b
    rate = 1.0 / (1.0 / c + 2 * (weight * (np.einsum('ij,ij->i', x, x) + 1)).mean() * 1.0)
    for t in range(1, steps + 1):
        m = t / (t + 3)
        vw, vb = w + m * (w - pw), b + m * (b - pb)
        slack = np.maximum(0.0, 1 - y * (x @ vw + vb)) * weight
        g = -2 * (slack * y) / n
        pw, pb = w, b
        w, b = vw - rate * (vw / c + x.T @ g), vb - rate * g.sum()
    return w, b


class Model:
    """Families, languages and the columns of one weight table: first the families against the rest, then the pairs."""

    def __init__(self, x: np.ndarray, lang: list[str], families: dict[str, tuple[str, ...]]):
        self.languages = sorted(set(lang))
        known = {code: name for name, codes in families.items() for code in codes}
        self.family_of = {code: known.get(code, code) for code in self.languages}
        self.families = sorted(set(self.family_of.values()))
        self.pairs = [p for f in self.families for p in combinations([c for c in self.languages if self.family_of[c] == f], 2)]
        scale = 1.0 / (x.std(axis=0) + 3e-4)  # rarer n-grams count for more
        z = x * scale.astype(np.float32)
        norm = np.float32(np.sqrt(np.einsum('ij,ij->i', z, z).mean()) or 1.0)
        z /= norm
        own, fam = np.array(lang), np.array([self.family_of[c] for c in lang])
        columns = []
        for f in self.families if len(self.families) > 1 else []:
            columns.append(svm(z, np.where(fam == f, 1.0, -1.0)))
        for a, b in self.pairs:
            both = (own == a) | (own == b)
            columns.append(svm(z[both], np.where(own[both] == a, 1.0, -1.0)))
        self.weights = (np.stack([w * scale / norm for w, _ in columns], axis=1) if columns else np.zeros((x.shape[1], 0))).astype(np.float32)
        self.bias = np.array([b for _, b in columns])

    def decide(self, margins: np.ndarray) -> tuple[str, float]:
        k = len(self.families) if len(self.families) > 1 else 0
        f = self.families[int(np.argmax(margins[:k]))] if k else self.families[0]
        sure = 1 / (1 + np.exp(-2.0 * margins[:k].max())) if k else 1.0
        votes = {c: [0, 0.0] for c in self.languages if self.family_of[c] == f}
        for (a, b), m in zip(self.pairs, margins[k:], strict=True):
            if a in votes:
                win, lose = (a, b) if m >= 0 else (b, a)
                votes[win][0] += 1
                votes[win][1] += abs(m)
                votes[lose][1] -= abs(m)
        best = min(votes, key=lambda c: (-votes[c][0], -votes[c][1], c))
        own = [abs(m) for p, m in zip(self.pairs, margins[k:], strict=True) if best in p]
        return best, float(sure * (1 / (1 + np.exp(-2.0 * min(own))) if own else 1.0))


def fit(labelled: DataFrame, per_language: int = 300, families: dict[str, tuple[str, ...]] = FAMILIES) -> Model | None:
    """A model from ``labelled`` (doc_id, text, lang); None without a labelled row. Rows of equal id and text count once."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("lang", F.xxhash64(F.lit(11), "doc_id", "text").alias("h"), "text")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = min(per_language, max(1, MOST_ROWS // len(counts)))
    part = F.create_map(*[F.lit(v) for c, n in counts.items() for v in (c, min(1.0, 1.2 * share / n + 10 / n))])
    # A few more rows than wanted, by hash; of their features the first of each language.
    near = rows.where(F.pmod("h", F.lit(1 << 30)) / float(1 << 30) < F.element_at(part, F.col("lang")))
    some = near.mapInArrow(_features, "lang string, h bigint, x binary").groupBy("lang", "h").agg(F.first("x").alias("x"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h"))
    got = sorted(some.withColumn("rank", rank).where(F.col("rank") <= share).select("lang", "h", "x").collect(), key=lambda r: (r["lang"], r["h"]))
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in got]).astype(np.float32)
    return Model(x, [r["lang"] for r in got], families)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (text) with ``lang_pred`` and ``score`` (columns of these names are replaced)."""
    spark = docs.sparkSession
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")))
    shared, names, at = spark.sparkContext.broadcast(model), docs.columns, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in rebatch(batches, at):
            col = b.column(at)
            total, count = np.zeros((len(col), m.weights.shape[1])), np.zeros(len(col))
            letters = np.zeros(len(col), bool)
            for i, j, data, offsets, stop in _rows(col):
                filled = np.flatnonzero(np.diff(offsets))
                if not len(filled):
                    continue
                starts = offsets[:-1][filled]
                for h, fits in grams(data, offsets, stop):
                    own = m.weights[h]
                    own[~fits] = 0
                    total[i + filled] += np.add.reduceat(own, starts, axis=0)
                    count[i + filled] += np.add.reduceat(fits.astype(np.int64), starts)
                letters[i + filled] |= np.logical_or.reduceat(_ASCII_LETTER[data], starts)
            for r in np.flatnonzero(~letters):
                text = col[r].as_py()
                letters[r] = text is not None and any(c.isalpha() for c in text)
            margins = total / np.maximum(count, 1)[:, None] + m.bias
            found = [m.decide(margins[r]) if letters[r] else ("und", 0.0) for r in range(len(col))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([f for f, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], [*names, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))


def held_out(doc_id: Column) -> Column:
    return crc(doc_id) % 3 == 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~F.coalesce(held_out(F.col("doc_id")), F.lit(False))))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
