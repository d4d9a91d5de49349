"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from tessera.llm.byte_bpe import op5_byte_bpe
from tessera.llm.decontaminate import op3_decontamination
from tessera.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from tessera.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from tessera.llm.near_dedup import op7_near_dedup
from tessera.llm.packing import op11_packing
from tessera.llm.pii import op6_pii
from tessera.llm.quality import op8_quality
from tessera.llm.secret_scan import op4_secret_scan
from tessera.llm.sharding import op10_sharding
from tessera.llm.toxicity import op2_toxicity
from tessera.llm.url_filter import OP1_SQL, op1_url_filter
from tessera.llm.vector_codes import OP12_SQL, op12_vector_codes

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_secret_scan": op4_secret_scan,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_pii": op6_pii,
    "op7_near_dedup": op7_near_dedup,
    "op8_quality": op8_quality,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_sharding": op10_sharding,
    "op11_packing": op11_packing,
    "op12_vector_codes": op12_vector_codes,
    "op13_hard_negatives": op13_hard_negatives,
}

# the others are tested against brute force or held-out rows (tests/llm)
ORACLE_SQL = {
    "op1_url_filter": OP1_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op12_vector_codes": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
