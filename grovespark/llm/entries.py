"""The queries of this subpackage and their SQL, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from grovespark.llm import ann, bpe, jaccard_join, langid, licences, line_dedup, lloyd, mixing, periodic, quality, toxicity, url_filters, warc

QUERIES = {
    "op1_url_filters": url_filters.query,
    "op2_jaccard_join": jaccard_join.query,
    "op3_line_dedup": line_dedup.query,
    "op4_ann": ann.query,
    "op5_quality": quality.query,
    "op6_toxicity": toxicity.query,
    "op7_warc": warc.query,
    "op8_mixing": mixing.query,
    "op9_bpe": bpe.query,
    "op10_langid": langid.query,
    "op11_lloyd": lloyd.query,
    "op12_licences": licences.query,
    "op13_periodic_runs": periodic.query,
}

ORACLES = {
    "op1_url_filters": url_filters.ORACLE,
    "op3_line_dedup": line_dedup.ORACLE,
    "op5_quality": quality.ORACLE,
    "op11_lloyd": lloyd.ORACLE,
}
