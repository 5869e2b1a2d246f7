"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from helixframe.llm import decontaminate, divergence, hamming, html, jaccard, packing, pii, quality, secrets, sharding, tokenfile, warc

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_jaccard": jaccard.op2_jaccard,
    "op3_html": html.op3_html,
    "op4_warc": warc.op4_warc,
    "op5_secret_scan": secrets.op5_secret_scan,
    "op6_pii": pii.op6_pii,
    "op7_token_file": tokenfile.op7_token_file,
    "op8_quality_rules": quality.op8_quality_rules,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_sharding": sharding.op10_sharding,
    "op11_nearest_neighbours": hamming.op11_nearest_neighbours,
    "op12_source_divergence": divergence.op12_source_divergence,
}
ORACLES = {"op2_jaccard": jaccard.OP2_SQL, "op4_warc": warc.OP4_SQL, "op5_secret_scan": secrets.OP5_SQL, "op10_sharding": sharding.OP10_SQL, "op12_source_divergence": divergence.OP12_SQL}
