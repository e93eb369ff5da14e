"""License scans: an Aho-Corasick automaton over words finds notice phrases and identifier tags, and a shunting-yard
parser evaluates the and/or/with expressions that tags name.

A text is read as a stream of words with one space between and around them, in pieces of bounded size (the automaton
keeps its state from piece to piece), so a phrase is found wherever its words stand one after another. Where the stream
has a tag, the line that follows it in the raw text is parsed: operands are licence identifiers, ``with`` binds before
``and``, ``and`` before ``or``. An expression ends where no operator joins the next word, and a trailing operator is
dropped. The value of a licence is its restriction between 0 (none) and 1 (all rights reserved): ``or`` takes the least
restrictive side and its labels, ``and`` the most restrictive and the labels of both, and an exception after ``with`` lifts
a tenth. A document's score is the highest restriction of all that it states; 0 if it states none.

Defined cases: null and empty texts have no word, empty labels and score 0; texts of any length are read whole; every
row is judged by itself, so repeated rows and null ids are results of their own; an empty table gives no row; extra
columns are ignored; identifiers that are in no known family and no ``licenseref-`` end an expression before them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from grovespark.llm.common import table

#: The phrases that count as places, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notice phrases.
NOTICES = {
    "mit license": "mit", "permission is hereby granted free of charge": "mit", "apache license": "apache", "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd", "mozilla public license": "mpl", "eclipse public license": "epl",
    "lesser general public license": "lgpl", "library general public license": "lgpl", "affero general public license": "agpl",
    "creative commons attribution": "cc-by", "cc by sa": "cc-by-sa", "cc by nd": "cc-by-nd", "cc by nc": "cc-by-nc",
    "dedicated to the public domain": "public-domain", "released into the public domain": "public-domain", "no rights reserved": "public-domain",
}
#: Tags that an expression follows, as words and as they stand in a text.
TAGS = {"spdx license identifier": "spdx-license-identifier", "license expression": "license-expression"}
#: Restriction by family; a licence takes that of the longest family that its identifier begins with.
RESTRICTION = {
    "public-domain": 0.0, "cc0": 0.0, "unlicense": 0.0, "0bsd": 0.0, "mit": 0.2, "isc": 0.2, "bsd": 0.2, "zlib": 0.2, "apache": 0.25, "cc-by": 0.25,
    "cc-by-sa": 0.6, "mpl": 0.5, "epl": 0.5, "lgpl": 0.5, "gpl": 0.75, "agpl": 0.8, "cc-by-nd": 0.85, "cc-by-nc": 0.9, "licenseref-": 1.0, "reserved": 1.0,
}
BINDS = {"or": 1, "and": 2, "with": 3}
RESULT = "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
PIECE = 1 << 20

_SOLID = bytes(c for c in range(256) if c >= 0x80 or chr(c).isalnum())
_WORDS = bytes((c + 32 if 65 <= c <= 90 else c) if c in _SOLID else 32 for c in range(256))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_TOKEN = re.compile(r"[()]|[a-z0-9.+:-]*[a-z0-9+]")
Value = tuple[float, frozenset[str]]


def restriction(label: str) -> float | None:
    """By the longest known family that the identifier begins with; null for an unknown one."""
    own = [f for f in RESTRICTION if label == f or label.startswith(f if f.endswith("-") else f"{f}-")]
    return RESTRICTION[max(own, key=len)] if own else None


def apply(op: str, left: Value, right: Value) -> Value:
    if op == "or":
        return min(left, right, key=lambda v: v[0])
    if op == "and":
        return max(left[0], right[0]), left[1] | right[1]
    return max(0.0, round(left[0] - 0.1, 6)), frozenset(f"{a}-with-{b}" for a in left[1] for b in right[1])


def evaluate(line: str) -> Value | None:
    """The value of the longest expression that the (lower-case) ``line`` begins with; null if it begins with none."""
    values: list[Value] = []
    ops: list[str] = []

    def reduce_to(least: int) -> None:
        while ops and ops[-1] != "(" and BINDS[ops[-1]] >= least:
            op, right = ops.pop(), values.pop()
            values.append(apply(op, values.pop(), right))

    operand, at = True, 0  # whether an operand may come next
    while m := _TOKEN.match(line, at + len(line[at:]) - len(line[at:].lstrip(" \t"))):
        token = m[0]
        if operand:
            if token == "(" and not (ops and ops[-1] == "with"):
                ops.append(token)
            elif token in BINDS or token in "()":
                break
            else:
                exception = bool(ops) and ops[-1] == "with"
                weight = 0.0 if exception else restriction(token)
                if weight is None:
                    break
                values.append((weight, frozenset([token])))
                operand = False
        elif token in BINDS:
            if token == "with" and line[at - 1 : at] == ")":
                break  # an exception belongs to a licence, not to an expression
            reduce_to(BINDS[token])
            ops.append(token)
            operand = True
        elif token == ")" and "(" in ops:
            reduce_to(0)
            ops.pop()
        else:
            break
        at = m.end()
    if operand:  # what waits for an operand goes
        while ops and (ops[-1] == "(" or len(values) <= sum(o != "(" for o in ops)):
            ops.pop()
    while ops:
        reduce_to(0)
        if ops:
            ops.pop()
    return values[-1] if values else None


class Scanner:
    """Phrases to (kind, label, number of words); kinds are base, notice and tag."""

    def __init__(self, base: Mapping[str, str], notices: Mapping[str, str], tags: Mapping[str, str]):
        import ahocorasick

        found: dict[str, list[tuple[str, str]]] = {}
        for kind, phrases in (("base", base), ("notice", notices), ("tag", tags)):
            for phrase, label in phrases.items():
                found.setdefault(phrase, []).append((kind, label))
        self.words, self.raw, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton(), tags
        for phrase, what in found.items():
            self.words.add_word(f" {phrase} ", (len(phrase.split(" ")), what))
        for tag in tags.values():
            self.raw.add_word(tag, tag)
        self.words.make_automaton()
        if tags:
            self.raw.make_automaton()

    def places(self, text: bytes) -> tuple[int, list[tuple[int, str, str]]]:
        """(number of words, (first word, kind, label) of every phrase)."""
        out, n, at = [], 0, 0
        search = self.words.iter(" ")
        for _ in search:
            pass
        before = 1  # characters of the stream so far
        while at < len(text):
            part = text[at : at + PIECE].translate(_WORDS)
            if at + PIECE < len(text):  # cut behind a separator; a longer word stands alone
                cut = part.rfind(b" ") + 1
                while not cut:
                    more = text[at + len(part) : at + len(part) + PIECE].translate(_WORDS)
                    cut = len(part) + more.find(b" ") + 1 if b" " in more else (len(part) + len(more) if not more or at + len(part) + len(more) >= len(text) else 0)
                    part += more
                part = part[:cut]
            at += len(part)
            words = part.split()
            stream = b" ".join(words) + b" " if words else b""
            done, counted = n, 0
            search.set(stream.decode("latin-1"), False)
            for end, (size, what) in search:
                end = end - before + 1
                done += stream.count(b" ", counted, end)
                counted = end
                out += [(done - size, kind, label) for kind, label in what]
            n += len(words)
            before += len(stream)
        return n, out

    def expressions(self, text: bytes) -> list[Value]:
        """The values of the expressions behind the tags."""
        low, out = text.translate(_LOWER).decode("latin-1"), []
        for end, _ in self.raw.iter(low):
            m = re.compile(r"[ \t\"']*[:=]?[ \t\"']*").match(low, end + 1)
            stop = re.compile(r"\n|\*/|-->|$").search(low, m.end()).start()
            if (v := evaluate(low[m.end() : stop])) is not None:
                out.append(v)
        return out

    def scan(self, text: bytes) -> tuple:
        """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one text."""
        n, found = self.places(text)
        starts = [w for w, kind, _ in found if kind == "base"]
        base = {label for _, kind, label in found if kind == "base"}
        stated = {label: restriction(label) or 0.0 for _, kind, label in found if kind != "tag"}
        labels, score = set(stated), max(stated.values(), default=0.0)
        if any(kind == "tag" for _, kind, _ in found):
            for weight, own in self.expressions(text):
                labels |= own
                score = max(score, weight)
        return n, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def scan(docs: DataFrame, base: Mapping[str, str] = BASE, notices: Mapping[str, str] = NOTICES, tags: Mapping[str, str] = TAGS) -> DataFrame:
    """RESULT for every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices, tags)
        names = [f.split(" ")[0] for f in RESULT.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
        for b in batches:
            rows = [scanner.scan(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in b.column(1)]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds[1:], strict=True))], names)

    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
