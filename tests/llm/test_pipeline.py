"""Stages of the corpus pipeline on tables with repeated rows, null ids and ids that several texts share."""

from collections import Counter

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{i}" for i in range(60)]
BASE = " ".join(WORDS)
NEAR = BASE + " x"
OTHER = " ".join(f"o{i}" for i in range(60))
THIRD = " ".join(f"t{i}" for i in range(60))
FOURTH = " ".join(f"f{i}" for i in range(60))


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a0", len(t)) for i, t in texts], SCHEMA)


def test_one_row_of_each_group_of_near_duplicates_stays(spark):
    rows = [(5, BASE)] * 4 + [(7, NEAR), (None, NEAR), (None, BASE)] + [(None, OTHER)] * 3 + [(9, THIRD), (9, FOURTH), (9, THIRD)] + [(11, "")] * 2 + [(12, ""), (None, "")]
    got = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, table(spark, rows), "").collect())
    assert got == Counter([(5, BASE), (None, OTHER), (9, THIRD), (9, FOURTH), (11, ""), (12, ""), (None, "")])


def test_mixing_keeps_the_rows_that_it_chose(spark):
    for ids in ([None] * 10, [3] * 10, [None] * 5 + [3] * 5):
        out = corpus_pipeline.mix_sources(spark, table(spark, [(i, "a b c d e f g h i j") for i in ids]), "")
        assert out.columns == corpus_pipeline.COLUMNS and out.count() == 9
