"""The queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from gleaner.llm import bpe, centroids, licenses, linededup, media, phrases, quality, shards, simhash, toxicity, urlfilter, weakrules, winnow

QUERIES = {
    "op1_simhash_near_dedup": simhash.op1_simhash_near_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_sharding": shards.op3_sharding,
    "op4_line_dedup": linededup.op4_line_dedup,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_bpe": bpe.op6_bpe,
    "op7_media_columns": media.op7_media_columns,
    "op8_url_filters": urlfilter.op8_url_filters,
    "op9_benchmark_decontamination": winnow.op9_benchmark_decontamination,
    "op10_quality_classifier": quality.op10_quality_classifier,
    "op11_quality_rules": weakrules.op11_quality_rules,
    "op12_centroid_clustering": centroids.op12_centroid_clustering,
    "op13_phrase_collocations": phrases.op13_phrase_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op5_license_scan": licenses.OP5_SQL,
    "op8_url_filters": urlfilter.OP8_SQL,
    "op4_line_dedup": linededup.OP4_SQL,
    "op9_benchmark_decontamination": winnow.OP9_SQL,
    "op11_quality_rules": weakrules.OP11_SQL,
    "op12_centroid_clustering": centroids.OP12_SQL,
    "op13_phrase_collocations": phrases.OP13_SQL,
}
