"""Registry of the package's queries and of the SQL that expresses them."""

from __future__ import annotations

from millrace.llm import binpack, divergence, mixing, ngram_join, omh, secrets, substrings, syncmers, topk, toxicity, urls, wavelet, whitening
from millrace.llm.common import importable_on_workers

_QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_mix": mixing.op2_mix,
    "op3_secrets": secrets.op3_secrets,
    "op4_topk": topk.op4_topk,
    "op5_substrings": substrings.op5_substrings,
    "op6_url_filter": urls.op6_url_filter,
    "op7_syncmers": syncmers.op7_syncmers,
    "op8_near_dedup": omh.op8_near_dedup,
    "op9_wavelet": wavelet.op9_wavelet,
    "op10_pack": binpack.op10_pack,
    "op11_whiten": whitening.op11_whiten,
    "op12_divergence": divergence.op12_divergence,
    "op13_ngram_join": ngram_join.op13_ngram_join,
}

QUERIES = {name: importable_on_workers(query) for name, query in _QUERIES.items()}

ORACLES = {
    "op2_mix": mixing.ORACLE,
    "op4_topk": topk.ORACLE,
    "op6_url_filter": urls.ORACLE,
    "op12_divergence": divergence.ORACLE,
}
