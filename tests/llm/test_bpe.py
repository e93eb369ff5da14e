"""The encoder and its digests against the tokenizers library."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from grovespark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "a", "a<|endoftext|>b  c \n it's", "<|endoftext|>", " \xa0 \xa0\tt  ", "日本 😀", "word, word. word! Word) it's don't 12 a1b2", "a  b", " a\n \n b ",
    "é" * 300, "ab cd " * 400_000 + " z  ", "k" * 3_000 + " y", "<|endoftext|>" + "x y " * 300_000, "word",
]


@pytest.mark.parametrize("size", [0, 3, 1000])
def test_digests(spark, size):
    library = Tokenizer.from_file(PATH)
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, "a", "y"), (None, "b", "z")]
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(spark.createDataFrame(rows, "doc_id long, text string, ids string"), PATH, size).collect()), key=str)
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(empty, PATH).count() == 0 and bpe.encode(empty, PATH).count() == 0


def test_the_lexicon_holds_the_most_frequent_words(spark):
    docs = spark.createDataFrame([("a b c",), ("b c",), ("c",), (None,)], "text string").union(spark.createDataFrame([(" ".join(f"w{i}" for i in range(50)),)] * 4, "text string"))
    found = set(bpe.frequent_words(docs, 1000))
    assert {" c", "w"} <= found and " b" not in found  # " b" occurs once
    assert len(bpe.frequent_words(docs, 10)) <= 10
