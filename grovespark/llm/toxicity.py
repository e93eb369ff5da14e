"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Each word is a vector of a word part (a learnt embedding of known words, and how much more often the word occurs in
toxic training rows) and a character part (the mean of learnt embeddings of its byte trigrams). Windows of ``WINDOW``
words, each overlapping the last by half, run through a forward and a backward gated recurrent layer; attention pools
the states; a logistic unit scores the window. A text's score is that of its worst window, over the whole text.

Training uses at most ``most_rows`` labelled rows of at most ``most_chars`` characters (by hash of id and text, of each label its
share): a documented bound, as is the model's size. A row teaches its currently worst window (labels are of whole texts).

Defined cases: null, empty and all-space texts score as one window without words; without labelled rows every score is
0; repeated rows keep a row each; a text has the same windows however long it is and however it is cut for work.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.llm import words as W
from grovespark.llm.common import Workspace, crc, rebatch, table

WINDOW, STRIDE = 32, 16
HIDDEN, EMBED, CHARS, CHAR_BITS = 8, 6, 6, 12
U = np.uint64


def _char_buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of the byte trigram that starts at each byte (A-Z as a-z, spaces as one)."""
    b = W._LOWER[data].astype(np.uint32)
    b[W._IS_SPACE[data]] = 0
    pad = np.concatenate([b, np.zeros(2, np.uint32)])
    h = (pad[:-2] * np.uint32(0x01000193) ^ pad[1:-1]) * np.uint32(0x01000193) ^ np.where(pad[1:-1] == 0, 0, pad[2:])
    return ((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - CHAR_BITS)).astype(np.int64)


def tokens(col: pa.Array) -> Iterator[tuple]:
    """Bounded pieces: (first row, (distinct word hashes, which one each word is), word offsets of rows, trigram buckets, their
    offsets by distinct word, windows). A very long text comes in several pieces that begin where one of its windows does."""
    data, offsets = W.buffers(col)
    for i, j in W.pieces(offsets):
        if j == i + 1 and offsets[j] - offsets[i] > 4 * W.PIECE:
            for part in _long(data[offsets[i] : offsets[j]]):
                yield i, *part
        else:
            own = _piece(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            yield i, *own, windows(own[1])


def _long(data: np.ndarray) -> Iterator[tuple]:
    """The pieces of one long text: each but the last gives its whole windows, and the next begins at the word that follows in step."""
    at, size = 0, W.PIECE
    while at < len(data):
        stop = min(len(data), at + size)
        if stop < len(data):  # to the end of the word
            gap = np.flatnonzero(W._IS_SPACE[data[stop : stop + W.PIECE]])
            stop = min(stop + (int(gap[0]) if len(gap) else W.PIECE), len(data))
        last = stop >= len(data)
        if not last and not W._IS_SPACE[data[stop]]:
            size += W.PIECE
            continue
        own = _piece(data[at:stop], np.array([0, stop - at]))
        n = int(own[1][-1])
        whole = (n - WINDOW) // STRIDE + 1
        if last:
            if at == 0 or n > WINDOW - STRIDE:
                yield *own, windows(own[1])
            return
        if whole < 1:  # too few words for one step: a larger piece
            size += W.PIECE
            continue
        first = np.arange(whole) * STRIDE
        yield *own, (np.zeros(whole, np.int64), first, np.full(whole, WINDOW))
        starts, _ = W.spans(data[at:stop], np.zeros(1, np.int64))
        at, size = at + int(starts[whole * STRIDE]) if whole * STRIDE < n else stop, W.PIECE


def _piece(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends = W.spans(data, offsets[:-1])
    h = W._hash_piece(data, starts)
    # Equal words are worked on once: the first of each, and which one every word is.
    distinct, first, which = np.unique(h, return_index=True, return_inverse=True)
    lengths = ends[first] - starts[first]
    flat = np.repeat(starts[first] - np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64), lengths) + np.arange(lengths.sum()) if len(first) else np.zeros(0, np.int64)
    return (distinct, which), np.searchsorted(starts, offsets), _char_buckets(data)[flat], np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def windows(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and length of the windows of rows with word offsets ``at``."""
    n = np.diff(at)
    each = np.where(n > 0, np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1), 0)
    row = np.repeat(np.arange(len(n)), each)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    first = at[:-1][row] + nth * STRIDE
    return row, first, np.minimum(WINDOW, at[1:][row] - first)


def _gate(x: np.ndarray) -> np.ndarray:
    """A sigmoid of three straight pieces."""
    x *= 0.25
    x += 0.5
    return np.clip(x, 0, 1, out=x)


def _gathered(n: int, to: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``n`` rows of sums: the values that go to each row."""
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(to):
        order = np.argsort(to, kind="stable")
        own = to[order]
        begin = np.flatnonzero(np.diff(own, prepend=-1))
        out[own[begin]] = np.add.reduceat(values[order], begin, axis=0)
    return out


class Network:
    """The parameters, forward scores and gradients."""

    def __init__(self, known: np.ndarray, lift: np.ndarray, rng: np.random.Generator):
        def r(*s: int) -> np.ndarray:
            return rng.normal(0, 0.3, s).astype(np.float32)

        self.known, self.lift = known, lift.astype(np.float32)
        d = EMBED + CHARS + 1
        self.p = {"word": r(len(known) + 1, EMBED) * 0.1, "char": r(1 << CHAR_BITS, CHARS) * 0.1, "out": r(2 * HIDDEN), "out_b": np.full(1, -2, np.float32), "att": r(2 * HIDDEN)}
        for s in "fb":
            self.p |= {f"w{s}": r(d, 3 * HIDDEN), f"u{s}": r(HIDDEN, 3 * HIDDEN), f"b{s}": np.zeros(3 * HIDDEN, np.float32)}
            self.p[f"w{s}"][-1, 2 * HIDDEN :] += 0.5

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Index of each known word; the last index for the others."""
        i = np.searchsorted(self.known, h)
        i[i >= len(self.known)] = 0
        return np.where(self.known[i] == h, i, len(self.known)) if len(self.known) else np.zeros(len(h), np.int64)

    def inputs(self, h: np.ndarray, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Vectors of distinct words."""
        i = self.ids(h)
        x = np.empty((len(h), EMBED + CHARS + 1), np.float32)
        x[:, :EMBED] = self.p["word"][i]
        x[:, EMBED:-1] = np.add.reduceat(self.p["char"][grams], at[:-1], axis=0) / np.diff(at)[:, None] if len(h) else 0
        x[:, -1] = np.append(self.lift, 0)[i]
        return x

    def states(self, x: dict[str, np.ndarray], which: np.ndarray, first: np.ndarray, length: np.ndarray, keep: bool = False):
        """States of both directions, (window, step, 2 * HIDDEN); ``x``: projected distinct words by direction."""
        n, steps = len(first), int(length.max(initial=1))
        out, saved = np.zeros((n, steps, 2 * HIDDEN), np.float32), {}
        for k, s in enumerate("fb"):
            h, u, u2 = np.zeros((n, HIDDEN), np.float32), self.p[f"u{s}"][:, : 2 * HIDDEN], self.p[f"u{s}"][:, 2 * HIDDEN :]
            for t in range(steps) if s == "f" else range(steps - 1, -1, -1):
                on = length > t
                pos = np.where(on, first + t, first)
                a = x[s][which[pos]]
                g = _gate(a[:, : 2 * HIDDEN] + h @ u)
                z, q = g[:, :HIDDEN], g[:, HIDDEN:]
                c = np.clip(a[:, 2 * HIDDEN :] + (q * h) @ u2, -1, 1)
                new = h + z * (c - h)
                if not on.all():
                    new *= on[:, None]  # the forward layer ends there, the backward one has not begun
                if keep:
                    saved[s, t] = (pos, on, h, z.copy(), q.copy(), c)
                h = new
                out[:, t, k * HIDDEN : (k + 1) * HIDDEN] = h
        return out, saved

    def pool(self, states: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Attention over the steps, and the logit."""
        e = states @ self.p["att"]
        e[np.arange(states.shape[1])[None, :] >= length[:, None]] = -30
        e = np.exp(4 * (e - e.max(axis=1, keepdims=True)))
        e /= e.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", e, states)
        return e, pooled @ self.p["out"] + self.p["out_b"][0]

    def logits(self, h: np.ndarray, which: np.ndarray, grams: np.ndarray, at: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        v = self.inputs(h, grams, at)
        x = {s: v @ self.p[f"w{s}"] + self.p[f"b{s}"] for s in "fb"}
        out = np.empty(len(first), np.float32)
        for i in range(0, len(first), 4096):
            own = slice(i, i + 4096)
            out[own] = self.pool(self.states(x, which, first[own], length[own])[0], length[own])[1]
        return out

    def gradients(self, h, which, grams, at, first, length, y) -> tuple[dict[str, np.ndarray], float]:
        p, v = self.p, self.inputs(h, grams, at)
        x = {s: v @ p[f"w{s}"] + p[f"b{s}"] for s in "fb"}
        states, saved = self.states(x, which, first, length, keep=True)
        e, logit = self.pool(states, length)
        prob = 1 / (1 + np.exp(-logit))
        d = (prob - y) / len(y)
        g = {k: np.zeros_like(a) for k, a in p.items()}
        pooled = np.einsum("nt,nth->nh", e, states)
        g["out"], g["out_b"][0] = pooled.T @ d, d.sum()
        dp = d[:, None] * p["out"]
        ds = e[:, :, None] * dp[:, None, :]
        de = np.einsum("nh,nth->nt", dp, states)
        de = 4 * e * (de - (e * de).sum(axis=1, keepdims=True))
        g["att"] = np.einsum("nt,nth->h", de, states)
        ds += de[:, :, None] * p["att"]
        dv = np.zeros_like(v)
        for k, s in enumerate("fb"):
            u, dh, to, sent = p[f"u{s}"], np.zeros((len(y), HIDDEN), np.float32), [], []
            for t in range(states.shape[1] - 1, -1, -1) if s == "f" else range(states.shape[1]):
                pos, on, before, z, q, c = saved[s, t]
                dh = (dh + ds[:, t, k * HIDDEN : (k + 1) * HIDDEN]) * on[:, None]
                dc = dh * z * (np.abs(c) < 1)
                dz = dh * (c - before) * ((z > 0) & (z < 1)) * 0.25
                back = dc @ u[:, 2 * HIDDEN :].T
                dq = back * before * ((q > 0) & (q < 1)) * 0.25
                da = np.concatenate([dz, dq, dc], axis=1)
                g[f"u{s}"][:, : 2 * HIDDEN] += before.T @ da[:, : 2 * HIDDEN]
                g[f"u{s}"][:, 2 * HIDDEN :] += (q * before).T @ dc
                to.append(which[pos])
                sent.append(da)
                dh = dh * (1 - z) + back * q + da[:, : 2 * HIDDEN] @ u[:, : 2 * HIDDEN].T
            dx = _gathered(len(v), np.concatenate(to), np.concatenate(sent))
            g[f"w{s}"], g[f"b{s}"] = v.T @ dx, dx.sum(axis=0)
            dv += dx @ p[f"w{s}"].T
        g["word"] = _gathered(len(p["word"]), self.ids(h), dv[:, :EMBED])
        g["char"] = _gathered(len(p["char"]), grams, np.repeat(dv[:, EMBED:-1] / np.diff(at)[:, None], np.diff(at), axis=0))
        return g, float(-np.mean(y * np.log(prob + 1e-9) + (1 - y) * np.log(1 - prob + 1e-9)))


def train(texts: list[str], y: np.ndarray, epochs: int = 5, seed: int = 7, batch: int = 128) -> Network:
    """A network from whole texts with labels 0 and 1."""
    rng = np.random.default_rng(seed)
    y = np.asarray(y, np.float32)
    rows = []
    for text in texts:
        _, (h, which), at, grams, ends, _ = next(tokens(pa.array([text or ""], pa.string())))
        rows.append((h, which, at, grams, ends))
    # How many toxic and other rows hold each word, and how much more of the toxic ones, with a half added to both.
    words, at = np.unique(np.concatenate([np.zeros(0, U), *(r[0] for r in rows)]), return_inverse=True)
    label = np.repeat(y, [len(r[0]) for r in rows]) if rows else np.zeros(0)
    ones, every = np.bincount(at, label, len(words)), np.bincount(at, minlength=len(words))
    rate = max(float(y.mean()), 1e-3) if len(y) else 0.5
    lift = np.log((ones + 2 * rate) / (every + 2)) - np.log(rate)
    keep = every >= 3
    net = Network(words[keep], np.clip(lift[keep], -2, 3), rng)
    state = {k: (np.zeros_like(a), np.zeros_like(a)) for k, a in net.p.items()}
    cut = [windows(r[2]) for r in rows]
    lifts = np.append(net.lift, 0)
    for r in range(len(rows)):  # the first choice of a row's worst window: by its words alone
        h, which, _, _, _ = rows[r]
        own = np.concatenate([[0], np.cumsum(np.maximum(lifts[net.ids(h)], 0)[which])]) if len(h) else np.zeros(1)
        _, first, length = cut[r]
        rows[r] += (int(np.argmax(own[first + length] - own[first])) if len(first) else -1,)
    step = 0
    usable = np.array([i for i in range(len(rows)) if rows[i][5] >= 0])
    for epoch in range(epochs):
        if epoch >= 2:
            for i in usable.tolist():
                if len(cut[i][1]) > 1:
                    h, which, _, grams, ends, _ = rows[i]
                    rows[i] = (*rows[i][:5], int(np.argmax(net.logits(h, which, grams, ends, cut[i][1], cut[i][2]))))
        order = rng.permutation(usable)
        for k in range(0, len(order), batch):
            step += 1
            own = order[k : k + batch]
            g, _ = net.gradients(*_joined([rows[i] for i in own], [cut[i] for i in own]), y[own])
            for name, a in net.p.items():
                m, s = state[name]
                m += 0.1 * (g[name] - m)
                s += 0.01 * (g[name] ** 2 - s)
                a -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    return net


def _joined(rows: list[tuple], cut: list[tuple]) -> tuple[np.ndarray, ...]:
    """The chosen window of each row, as one table of distinct words."""
    h, which, grams, ends, first, length = [], [], [], [0], [], []
    words, places = 0, 0
    for (hs, ws, _, gs, es, best), (_, firsts, lengths) in zip(rows, cut, strict=True):
        own, of = np.unique(ws[firsts[best] : firsts[best] + lengths[best]], return_inverse=True)
        h.append(hs[own])
        which.append(of + words)
        for w in own:
            grams.append(gs[es[w] : es[w + 1]])
            ends.append(ends[-1] + es[w + 1] - es[w])
        first.append(places)
        length.append(lengths[best])
        words += len(own)
        places += len(of)
    return np.concatenate(h), np.concatenate(which), np.concatenate(grams), np.array(ends), np.array(first), np.array(length)


def scores(net: Network, col: pa.Array) -> np.ndarray:
    """The score of every whole text."""
    nothing = float(net.p["out_b"][0])
    worst = np.full(len(col), -np.inf)
    for i, (h, which), _, grams, ends, (row, first, length) in tokens(col):
        if len(row):
            np.maximum.at(worst, i + row, net.logits(h, which, grams, ends, first, length))
    worst[np.isinf(worst)] = nothing
    return 1 / (1 + np.exp(-worst))


def trial(texts: list[str], y: np.ndarray, seed: int) -> tuple[Network, float]:
    """A network from four fifths of the rows, and its loss on the rest: every fifth row of each label, in the order given.

    With fewer than five rows of each label there is no rest; the loss is then that of all rows.
    """
    rest = np.zeros(len(y), bool)
    for label in np.unique(y):
        rest[np.flatnonzero(y == label)[4::5]] = True
    net = train([t for t, r in zip(texts, rest, strict=True) if not r], y[~rest], seed=seed)
    asked = rest if rest.any() else ~rest
    p = np.clip(scores(net, pa.array([t for t, r in zip(texts, asked, strict=True) if r], pa.string())), 1e-9, 1 - 1e-9)
    return net, float(-np.mean(y[asked] * np.log(p) + (1 - y[asked]) * np.log(1 - p)))


def sample(labelled: DataFrame, most_rows: int = 3000, most_chars: int = 20_000, labels: DataFrame | None = None) -> tuple[list[str], np.ndarray]:
    """Texts and labels to fit on: see ``fit``. What is joined, counted and written are hashes; of the texts only the chosen ones leave their place."""
    hashed = labelled.where(F.length("text") <= most_chars).withColumn("h", F.xxhash64(F.lit(5), "doc_id", "text"))
    keys = hashed.select("doc_id", "h", *(["label"] if labels is None else []))
    keys = (keys if labels is None else keys.join(labels.where(F.col("label").isNotNull()).select("doc_id", "label"), "doc_id")).where(F.col("label").isNotNull())
    work = Workspace(labelled.sparkSession, "toxicity")
    rows = work.save(keys.select("label", "h"), "keys")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    if not n:
        return [], np.zeros(0, np.float32)
    share = F.create_map(*[F.lit(v) for label, c in counts.items() for v in (label, min(1.0, 1.1 * most_rows / n + 50 / c))])
    near = rows.where(F.pmod("h", F.lit(1 << 30)) / float(1 << 30) < F.element_at(share, F.col("label"))).distinct()
    taken, chosen = dict.fromkeys(counts, 0), []
    for r in sorted(near.collect(), key=lambda r: (r["h"] % (1 << 30), r["h"], r["label"])):
        if taken[r["label"]] < max(1, most_rows * counts[r["label"]] // n):
            taken[r["label"]] += 1
            chosen.append(r)
    work.drop(rows)
    wanted = labelled.sparkSession.createDataFrame([(h,) for h in sorted({r["h"] for r in chosen})], "h long")
    # At most ``most_rows`` and a few texts, each of at most ``most_chars``; equal hashes are equal texts.
    texts = {r["h"]: r["text"] for r in hashed.select("h", "text").join(F.broadcast(wanted), "h").groupBy("h").agg(F.first("text").alias("text")).collect()}
    return [texts[r["h"]] for r in chosen], np.array([r["label"] for r in chosen], np.float32)


def fit(labelled: DataFrame, most_rows: int = 3000, most_chars: int = 20_000, trials: int = 3, seed: int = 0, labels: DataFrame | None = None) -> Network | None:
    """A network from ``labelled`` (doc_id, text, label), bounded by ``most_rows`` and ``most_chars``; None without rows.

    With ``labels`` (doc_id, label), ``labelled`` (doc_id, text) are documents without labels, joined to them by doc_id; texts
    then need no shuffle. The rows are those with the smallest hashes of id and text, of each label its share of ``most_rows``: neither the
    layout of the files nor many copies of one text matter. Equal rows count once. Of ``trials`` networks, each trained in a task of its own from
    another seed, the one with the least loss on rows that it was not trained on is kept; rows outside ``labelled`` choose nothing.
    """
    texts, y = sample(labelled, most_rows, most_chars, labels)
    if not texts:
        return None
    spark = labelled.sparkSession
    shared = spark.sparkContext.broadcast((texts, y))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for own in b.column(0).to_pylist():
                net, loss = trial(*shared.value, own)
                yield pa.RecordBatch.from_pydict({"seed": [own], "loss": [loss], "net": [pickle.dumps(net)]})

    # A network is as large as the words of the sample; the driver sees one for each trial.
    nets = spark.range(seed, seed + trials, 1, trials).mapInArrow(run, "seed bigint, loss double, net binary").collect()
    return pickle.loads(min(nets, key=lambda r: (r["loss"], r["seed"]))["net"])


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` (text) with ``score``, 0 to 1 (a column of that name is replaced)."""
    spark = docs.sparkSession
    if net is None:
        return docs.withColumn("score", F.lit(0.0))
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != "score"))
    shared, at = spark.sparkContext.broadcast(net), docs.columns.index("text")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rebatch(batches, at):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores(shared.value, b.column(at)), pa.float64())], [*names, "score"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))


def held_out(doc_id: Column) -> Column:
    return crc(doc_id) % 5 == 0


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents scored; one without an id is neither learned from nor held out."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    train_ids = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))
    out = score(docs, fit(docs, labels=train_ids))
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
