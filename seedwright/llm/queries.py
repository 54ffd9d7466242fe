"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seedwright.llm.anchor_dedup import op8_anchor_dedup
from seedwright.llm.cgk_decontam import op9_cgk_decontam
from seedwright.llm.chunk_pieces import op13_chunk_pieces
from seedwright.llm.hilbert_pack import op7_hilbert_pack
from seedwright.llm.license_digest import op10_license_digest, op10_sql
from seedwright.llm.minmax_dedup import op2_minmax_dedup
from seedwright.llm.ordinal_quality import op5_ordinal_quality
from seedwright.llm.periodic_runs import op11_periodic_runs
from seedwright.llm.pii_spans import op4_pii_spans
from seedwright.llm.quality_rules import op6_quality_rules, op6_sql
from seedwright.llm.target_resampling import op12_sql, op12_target_resampling
from seedwright.llm.token_files import op1_token_files
from seedwright.llm.toxic_lexicon import op3_toxic_lexicon

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_minmax_dedup": op2_minmax_dedup,
    "op3_toxic_lexicon": op3_toxic_lexicon,
    "op4_pii_spans": op4_pii_spans,
    "op5_ordinal_quality": op5_ordinal_quality,
    "op6_quality_rules": op6_quality_rules,
    "op7_hilbert_pack": op7_hilbert_pack,
    "op8_anchor_dedup": op8_anchor_dedup,
    "op9_cgk_decontam": op9_cgk_decontam,
    "op10_license_digest": op10_license_digest,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_target_resampling": op12_target_resampling,
    "op13_chunk_pieces": op13_chunk_pieces,
}

ORACLE: dict[str, str] = {
    "op6_quality_rules": op6_sql(),
    "op10_license_digest": op10_sql(),
    "op12_target_resampling": op12_sql(),
}
