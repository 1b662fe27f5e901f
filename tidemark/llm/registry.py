"""The queries of this package by name, and the SQL that gives the same rows."""

from __future__ import annotations

from . import ann, fingerprints, lm, mixing, ngram_join, packing, quality, secrets, suffix_dedup, urlfilter

QUERIES = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_lm_score": lm.op2_lm_score,
    "op3_ann": ann.op3_ann,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_fingerprint": fingerprints.op5_fingerprint,
    "op6_url_filter": urlfilter.op6_url_filter,
    "op7_pack": packing.op7_pack,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_mix": mixing.op9_mix,
    "op10_quality": quality.op10_quality,
}
ORACLES: dict[str, str] = {
    "op1_secret_scan": secrets.oracle(),
    "op4_ngram_join": ngram_join.SQL,
    "op6_url_filter": urlfilter.OP6_SQL,
}
