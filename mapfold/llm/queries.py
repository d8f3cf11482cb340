"""Registry of the training-data queries: one per operator, and their SQL where
SQL can express them."""

from __future__ import annotations

from mapfold.llm import chat, decontam, divergence, exact_dedup, packing, pii, sharding, sigtree, spelling, spotsigs, toxicity, urlrules, warc

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_packing": packing.op2_packing,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_chat": chat.op4_chat,
    "op5_decontamination": decontam.op5_decontamination,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_sharding": sharding.op7_sharding,
    "op8_jaccard_join": sigtree.op8_jaccard_join,
    "op9_warc": warc.op9_warc,
    "op10_url_filters": urlrules.op10_url_filters,
    "op11_spotsigs": spotsigs.op11_spotsigs,
    "op12_divergence": divergence.op12_divergence,
    "op13_spelling": spelling.op13_spelling,
}

_EXACT_DEDUP = r"""with t as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents
), g as (
  select body, min(doc_id) as keep_id, count(*) as group_size from t group by body
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t.body) as text_sha256 from t join g on t.body = g.body"""

ORACLE = {"op3_exact_dedup": _EXACT_DEDUP, **chat.ORACLE, **urlrules.ORACLE, **spotsigs.ORACLE, **divergence.ORACLE}
