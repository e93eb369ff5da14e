"""Byte-level BPE encoding and decoding through a lexicon automaton.

The frequent words of the corpus (counted over all documents; at most ``lexicon_size``, the bound that the driver gets) are merged once and
compiled with their ids into a minimal acyclic transducer, which every worker memory-maps. Words that it doesn't hold
are merged exactly by rank. The tokenizer file comes from the driver, so executors need no copy of it.

Defined cases: a null text encodes as an empty one, to no ids; special tokens in a text become their ids, as the file's
added tokens say; ids out of the vocabulary decode to nothing; invalid UTF-8 decodes with replacement characters;
repeated rows and ids keep a row each; very long texts are cut between words while they are worked on.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.llm.common import Workspace, rebatch, table
from grovespark.llm.transducer import Transducer, compile_words

#: The byte-level pre-tokenizer's pattern; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEXICON_SIZE = 65_536
#: Bytes of text that are worked on at once, and characters of a text beyond which it is cut into blocks.
GROUP, LONG = 8 << 20, 1 << 20
#: Words of up to so many bytes are merged together; a rank above all ranks.
WIDE, NEVER = 40, 2**31 - 1
#: Marks that end a chunk of letters as a word of their own.
MARKS = b".,;:!?)"
#: A space after white space and before white space or the end: such texts are not cut at spaces.
INNER_SPACE = "[{0}] (?:[{0}]|\\z)".format("\\x{9}-\\x{d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}")


def byte_names() -> dict[int, str]:
    """The printable character that stands for each byte: itself where printable in Latin-1, else from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def take_ragged(flat: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given rows of a table of lists (all values, and the offsets of the lists), as such a table."""
    lengths = at[rows + 1] - at[rows]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return flat[np.arange(ends[-1]) + np.repeat(at[rows] - ends[:-1], lengths)], ends


def views(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large_string column."""
    _, at, data = col.buffers()
    at = np.frombuffer(at, np.int64, len(col) + 1, col.offset * 8) if len(col) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(1, np.uint8)), at


def strings(values) -> pa.Array:
    return pa.array(values, pa.large_string())


def cut_chunks(chunks: pa.Array, lead: str, pattern) -> tuple[list[pa.Array], np.ndarray, np.ndarray]:
    """The words of distinct chunks without inner spaces: (word columns, and for each chunk places in them as a table of lists).

    Chunks of letters, and letters with one mark at the end, need no regular expression.
    """
    data, at = views(chunks)
    filled = at[1:] > at[:-1]
    letters = pc.utf8_is_alpha(chunks).to_numpy(zero_copy_only=False) & filled
    body = pc.utf8_slice_codeunits(chunks, 0, -1)
    marked = ~letters & filled & np.isin(data[np.maximum(at[1:] - 1, 0)], np.frombuffer(MARKS, np.uint8)) & pc.utf8_is_alpha(body).to_numpy(zero_copy_only=False)
    other = np.flatnonzero(~letters & ~marked)
    found = [pattern.findall(lead + c) for c in chunks.take(pa.array(other)).to_pylist()]
    words = [chunks.filter(pa.array(letters)), body.filter(pa.array(marked))]
    words = [pc.binary_join_element_wise(pa.scalar(lead, pa.large_string()), w, pa.scalar("", pa.large_string())) if lead else w for w in words]
    last = pc.utf8_slice_codeunits(chunks.filter(pa.array(marked)), -1)
    words += [last, strings([w for ws in found for w in ws])]
    each = np.ones(len(chunks), np.int64)
    each[marked] = 2
    each[other] = [len(ws) for ws in found]
    to = np.concatenate([[0], np.cumsum(each)])
    places = np.empty(to[-1], np.int64)
    n, m = int(letters.sum()), int(marked.sum())
    places[to[:-1][letters]] = np.arange(n)
    places[to[:-1][marked]] = n + np.arange(m)
    places[to[:-1][marked] + 1] = n + m + np.arange(m)
    k = each[other]
    places[np.repeat(to[:-1][other] - (np.cumsum(k) - k), k) + np.arange(k.sum())] = n + 2 * m + np.arange(k.sum())
    return words, places, to


def split_texts(texts: pa.Array, pattern) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, words of all texts as places in them, offsets of the texts) of texts that may be cut at spaces."""
    parts = pc.split_pattern(texts, " ")
    start = parts.offsets.to_numpy().astype(np.int64)
    start, coded = start - start[0], parts.flatten().dictionary_encode()
    chunk, heads = coded.indices.to_numpy().astype(np.int64), start[:-1]
    first, of = np.unique(chunk[heads], return_inverse=True)
    columns, places, to = cut_chunks(coded.dictionary, " ", pattern)
    more, places2, to2 = cut_chunks(coded.dictionary.take(pa.array(first)), "", pattern)
    places = np.concatenate([places, places2 + sum(map(len, columns))])
    chunk[heads] = len(to) - 1 + of
    to = np.concatenate([to, to[-1] + to2[1:]])
    words = pa.concat_arrays([*columns, *more]).dictionary_encode()
    flat, ends = take_ragged(words.indices.to_numpy().astype(np.int64)[places], to, chunk)
    return words.dictionary, flat, ends[start]


def table_of(data: np.ndarray, at: np.ndarray, rows: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``wide`` bytes of words as rows of a table, and which of its places are inside a word."""
    inside = np.arange(wide) < (at[rows + 1] - at[rows])[:, None]
    return np.where(inside, data[np.minimum(at[rows][:, None] + np.arange(wide), len(data) - 1)], 0), inside


class Codec:
    """Encodes and decodes with one vocabulary; ``lexicon``: a compiled transducer of frequent words."""

    def __init__(self, spec: bytes, lexicon: bytes | None = None):
        data = json.loads(spec)
        names = byte_names()
        bytes_of = {c: b for b, c in names.items()}
        vocab: dict[str, int] = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(bytes_of[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.tables = {"written": pa.array([b"%d," % i for i in range(size)], pa.large_binary()), "decoded": pa.array(self.bytes, pa.large_binary())}
        self.first = [vocab[names[b]] for b in range(256)]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, m in enumerate(data["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges.setdefault(vocab[a] << 32 | vocab[b], (rank, vocab[a + b]))
        self._index_merges()
        self.split_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.pattern = regex.compile(PATTERN)
        self.lexicon = Transducer(lexicon) if lexicon else None

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word by rank: the lowest-ranked neighbours merge first, leftmost of equals."""
        ids, merges = [self.first[b] for b in word], self.merges
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(m[0], i, pair) for i in range(len(ids) - 1) if (m := merges.get(pair := ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= len(ids) or ids[i] << 32 | ids[j] != pair:
                continue  # one side has merged since
            ids[i], ids[j], after[i] = merges[pair][1], -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < len(ids) and (m := merges.get(own := ids[left] << 32 | ids[right])) is not None:
                    heapq.heappush(heap, (m[0], left, own))
        return [i for i in ids if i >= 0]

    def _index_merges(self) -> None:
        """The merges as a hash table of arrays: pair, rank, and the merged id by rank."""
        pairs = np.array(list(self.merges), np.int64)
        ranks = np.array([r for r, _ in self.merges.values()], np.int64)
        self.merged = np.zeros(int(ranks.max(initial=-1)) + 1, np.int32)
        self.merged[ranks] = [i for _, i in self.merges.values()]
        bits = max(4, int(np.ceil(np.log2(len(pairs) * 4 + 1))))
        self.shift, mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_pair, self.slot_rank = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NEVER, np.int32)
        for pair, rank, slot in zip(pairs.tolist(), ranks.tolist(), self._slots(pairs).tolist(), strict=True):
            while self.slot_pair[slot] >= 0:
                slot = (slot + 1) & mask
            self.slot_pair[slot], self.slot_rank[slot] = pair, rank

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; NEVER where it doesn't merge or one side is missing (-1)."""
        pairs = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot, out = self._slots(pairs), np.full(len(pairs), NEVER, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        slot = slot[todo]
        while len(todo):
            found = self.slot_pair[slot]
            hit = found == pairs[todo]
            out[todo[hit]] = self.slot_rank[slot[hit]]
            on = ~hit & (found >= 0)
            todo, slot = todo[on], (slot[on] + 1) & (len(self.slot_pair) - 1)
        return out

    def merge_many(self, data: np.ndarray, at: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``merge`` of many words at once: each round merges the lowest pair of every word that has one.

        The words are ``rows`` of (``data``, ``at``). Gives (rows, numbers of ids, ids) as words are done.
        """
        lengths = at[rows + 1] - at[rows]
        for low, high in ((0, 8), (8, 16), (16, WIDE)):
            own = rows[(lengths > low) & (lengths <= high)]
            if not len(own):
                continue
            raw, inside = table_of(data, at, own, high + 1)
            ids = np.where(inside, np.array(self.first, np.int32)[raw], -1)
            ranks = self._ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(own), high)
            cols = np.arange(high + 1)
            while len(own):
                best = ranks.argmin(axis=1)
                rank = ranks[np.arange(len(own)), best]
                going = rank < NEVER
                done = ids[~going]
                yield own[~going], (done >= 0).sum(axis=1), done[done >= 0]
                own, ids, ranks, best, rank = own[going], ids[going], ranks[going], best[going], rank[going]
                if not len(own):
                    break
                each = np.arange(len(own))
                ids[each, best] = self.merged[rank]
                step = np.minimum(cols + (cols > best[:, None]), high)
                ids = np.take_along_axis(ids, step, axis=1)
                ids[:, -1] = -1
                ranks = np.take_along_axis(ranks, np.minimum(step[:, :-1], high - 1), axis=1)
                ranks[:, -1] = NEVER
                ranks[each, best] = self._ranks(ids[each, best], ids[each, best + 1])
                before = np.flatnonzero(best > 0)
                ranks[before, best[before] - 1] = self._ranks(ids[before, best[before] - 1], ids[before, best[before]])
        for r in rows[lengths > WIDE].tolist():
            ids = self.merge(data[at[r] : at[r + 1]].tobytes())
            yield np.array([r]), np.array([len(ids)]), np.array(ids, np.int32)

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words, as a table of lists: from the lexicon, or merged."""
        data, at = views(words)
        done = []
        todo = np.arange(len(words))
        if self.lexicon:
            index = self.lexicon.find(data, at)
            hit = np.flatnonzero(index >= 0)
            flat, ends = take_ragged(self.lexicon.ids, self.lexicon.offsets.astype(np.int64), index[hit])
            done.append((hit, np.diff(ends), flat))
            todo = np.flatnonzero(index < 0)
        done += self.merge_many(data, at, todo)
        each = np.zeros(len(words), np.int64)
        for rows, n, _ in done:
            each[rows] = n
        ends = np.concatenate([[0], np.cumsum(each)])
        out = np.empty(ends[-1], np.int32)
        for rows, n, flat in done:
            out[np.arange(len(flat)) + np.repeat(ends[rows] - (np.cumsum(n) - n), n)] = flat
        return out, ends

    @staticmethod
    def _blocks(text: str) -> Iterator[str]:
        """Pieces of a very long text, cut before a single space between other characters."""
        at, n = 0, len(text)
        while n - at > LONG:
            cut = at + LONG
            while True:
                cut = text.find(" ", cut)
                if cut < 0 or cut + 1 >= n or not (text[cut - 1].isspace() or text[cut + 1].isspace()):
                    break
                cut += 1
            if cut < 0 or cut + 1 >= n:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def blocks(self, col: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The texts (null: empty) with long ones in blocks, and the offsets of the texts among the blocks."""
        col = col.cast(pa.large_string()).fill_null("")
        sizes = np.diff(views(col)[1])
        if not (sizes > LONG).any():
            return col, np.arange(len(col) + 1)
        out = [[t] if n <= LONG or any(s in t for s in self.special) else list(self._blocks(t)) for t, n in zip(col.to_pylist(), sizes, strict=True)]
        return strings([b for bs in out for b in bs]), np.concatenate([[0], np.cumsum([len(bs) for bs in out])])

    def words_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct words as a table of lists, and the words of each text as a table of lists of places in it."""
        odd = pc.match_substring_regex(texts, INNER_SPACE).to_numpy(zero_copy_only=False)
        for s in self.special:
            odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        words, flat, ends = split_texts(texts.filter(pa.array(~odd)), self.pattern)
        ids, at = self.ids_of(words)
        if not odd.any():
            return ids, at, flat, ends
        # Texts with inner spaces or special tokens: cut whole; a special token is a word of its id.
        cut = [[(p, self.pattern.findall(p)) for p in (self.split_special.split(t) if self.split_special else [t])] for t in texts.filter(pa.array(odd)).to_pylist()]
        coded = strings([w for ps in cut for p, ws in ps if p not in self.special for w in ws]).dictionary_encode()
        more, more_at = self.ids_of(coded.dictionary)
        place = {s: len(at) - 1 + len(more_at) - 1 + i for i, s in enumerate(self.special)}
        ids = np.concatenate([ids, more, np.array(list(self.special.values()), np.int32)])
        own, took, lists = coded.indices.to_numpy().astype(np.int64) + len(at) - 1, 0, []
        for ps in cut:
            one = []
            for p, ws in ps:
                if p in self.special:
                    one.append([place[p]])
                else:
                    one.append(own[took : took + len(ws)])
                    took += len(ws)
            lists.append(np.concatenate([np.zeros(0, np.int64), *one]).astype(np.int64))
        at = np.concatenate([at, at[-1] + more_at[1:]])
        at = np.concatenate([at, at[-1] + 1 + np.arange(len(self.special))])
        # Both kinds of texts back in their order.
        each = np.empty(len(texts), np.int64)
        each[~odd], each[odd] = np.diff(ends), [len(x) for x in lists]
        to = np.concatenate([[0], np.cumsum(each)])
        out = np.empty(to[-1], np.int64)
        where = np.repeat(odd, each)
        out[~where], out[where] = flat, np.concatenate([np.zeros(0, np.int64), *lists])
        return ids, at, out, to

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each text, as a table of lists."""
        texts, of = self.blocks(col)
        ids, at, words, ends = self.words_of(texts)
        flat, to = take_ragged(ids, at, words)
        return flat, to[ends][of]

    def forms(self, col: pa.Array) -> tuple[np.ndarray, dict[str, tuple[np.ndarray, np.ndarray]]]:
        """The number of ids of each text, and its ids written out and decoded: (bytes, offsets of the texts)."""
        texts, of = self.blocks(col)
        ids, at, words, ends = self.words_of(texts)
        count, out = np.concatenate([[0], np.cumsum(np.diff(at)[words])])[ends][of], {}
        for name, table in self.tables.items():
            # Each distinct word once, from the vocabulary's entries of its ids; then the words of the texts.
            own = table.take(pa.array(ids))
            _, bounds = views(own)
            word = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds[at])), own.buffers()[2]])
            data, bounds = views(word.take(pa.array(words)))
            out[name] = data, bounds[ends][of]
        return np.diff(count), out

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def _codec(spec, lexicon) -> Codec:
    """One codec for each vocabulary and lexicon in a worker, kept from task to task."""
    key = hashlib.sha1(spec + (lexicon or b"")).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(spec, lexicon)
    return _codecs[key]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pattern = regex.compile(PATTERN)
    for b in rebatch(batches, 0, GROUP):
        words, flat, _ = split_texts(b.column(0).cast(pa.large_string()).fill_null(""), pattern)
        n = np.bincount(flat, minlength=len(words))
        for i in range(0, len(n), 1 << 16):
            yield pa.RecordBatch.from_arrays([words.slice(i, 1 << 16).cast(pa.string()), pa.array(n[i : i + (1 << 16)], pa.int64())], ["word", "n"])


def frequent_words(docs: DataFrame, size: int = LEXICON_SIZE) -> list[str]:
    """At most ``size`` frequent words, counted over all documents: those above the least step of the count (a sixteenth
    of a power of two) that no more than ``size`` words exceed, so the driver gets no other word.

    Words that occur once are left out, and if the highest step alone holds more than ``size`` words, all are: the
    lexicon saves work and changes no id.
    """
    work = Workspace(docs.sparkSession, "words")
    counts = work.save(docs.select("text").mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1").withColumn("step", F.floor(16 * F.log2("n")).cast("int")), "counts")
    steps = {r["step"]: r["words"] for r in counts.groupBy("step").agg(F.count("*").alias("words")).collect()}  # at most 1,024 rows
    taken, least = 0, None
    for step in sorted(steps, reverse=True):
        taken += steps[step]
        if taken > size:
            break
        least = step
    found = [] if least is None else [r["word"] for r in counts.where(F.col("step") >= least).select("word").collect()]
    work.drop(counts)
    return sorted(found)


def compile_lexicon(spec: bytes, words: Sequence[str]) -> bytes:
    raw = strings(sorted({w for w in words if 0 < len(w.encode()) <= 64}))
    ids, at = Codec(spec).ids_of(raw)
    return compile_words([w.encode() for w in raw.to_pylist()], [ids[i:j].tolist() for i, j in zip(at, at[1:], strict=False)])


def prepare(docs: DataFrame, tokenizer_path: str, lexicon_size: int = LEXICON_SIZE):
    """(broadcast tokenizer file, broadcast lexicon) for ``docs``: both of bounded size."""
    spark = docs.sparkSession
    spec = Path(tokenizer_path).read_bytes()
    lexicon = compile_lexicon(spec, frequent_words(docs, lexicon_size)) if lexicon_size else b""
    return spark.sparkContext.broadcast(spec), spark.sparkContext.broadcast(lexicon)


def encode(docs: DataFrame, tokenizer_path: str, lexicon_size: int = LEXICON_SIZE, column: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` as an array column."""
    spec, lexicon = prepare(docs, tokenizer_path, lexicon_size)
    rest, at = [f for f in docs.schema.fields if f.name != column], docs.columns.index("text")
    kept = [i for i, n in enumerate(docs.columns) if n != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value, lexicon.value)
        for b in rebatch(batches, at, GROUP):
            flat, ends = codec.encode(b.column(at))
            col = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), col], [*(f.name for f in rest), column])

    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    return docs.mapInArrow(run, StructType([*rest, StructField(column, ArrayType(IntegerType()))]))


def decode(encoded: DataFrame, tokenizer_path: str, column: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with ``column`` decoded into ``out``."""
    spec = encoded.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_bytes())

    @F.pandas_udf("string")
    def run(ids):
        codec = _codec(spec.value, b"")
        return ids.map(lambda x: None if x is None else codec.decode(np.asarray([i for i in x if 0 <= i < len(codec.bytes)], np.int32)))

    return encoded.withColumn(out, run(column))


def digests(docs: DataFrame, tokenizer_path: str, lexicon_size: int = LEXICON_SIZE) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, and its ids decoded again."""
    docs = docs.select("doc_id", "text")
    spec, lexicon = prepare(docs, tokenizer_path, lexicon_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value, lexicon.value)
        for b in rebatch(batches, 1, GROUP):
            n, forms = codec.forms(b.column(1))
            (ids, at), (back, to) = ((memoryview(data), ends.tolist()) for data, ends in forms.values())
            # A comma follows each id but the last; what is decoded is made valid as a decoder does it.
            own = [hashlib.sha256(ids[i : max(i, j - 1)]).hexdigest() for i, j in zip(at, at[1:], strict=False)]
            text = [hashlib.sha256(bytes(back[i:j]).decode("utf-8", "replace").encode()).hexdigest() for i, j in zip(to, to[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"), public_tokenizers.path("byte_bpe_50k.json"))
