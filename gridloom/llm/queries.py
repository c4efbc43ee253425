"""The corpus operators' queries, and SQL where SQL can express them."""

from __future__ import annotations

from . import bpe, collocations, divergence, embed_dedup, html_crf, license_rules, packing, quality_cnn, simhash, suffix_dedup, topk, toxicity, url_rules

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_url_filters": url_rules.op4_url_filters,
    "op5_packing": packing.op5_packing,
    "op6_embed_dedup": embed_dedup.op6_embed_dedup,
    "op7_html": html_crf.op7_html,
    "op8_simhash": simhash.op8_simhash,
    "op9_license_scans": license_rules.op9_license_scans,
    "op10_topk": topk.op10_topk,
    "op11_quality": quality_cnn.op11_quality,
    "op12_divergence": divergence.op12_divergence,
    "op13_collocations": collocations.op13_collocations,
}

ORACLES = {
    "op9_license_scans": license_rules.ORACLE,
    "op12_divergence": divergence.ORACLE,
    "op13_collocations": collocations.ORACLE,
    "op10_topk": """WITH v AS (SELECT row_number() OVER () AS pos, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (SELECT q.pos, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.pos <> c.pos AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY pos ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
}
