"""Queries of this subpackage and the SQL some of them are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cargolens.llm.byte_pairs import op13_bpe
from cargolens.llm.language import op4_language_id
from cargolens.llm.licenses import op5_license_scan, scan_sql
from cargolens.llm.near_duplicates import op7_minhash_dedup
from cargolens.llm.neighbours import op8_nearest_neighbours
from cargolens.llm.packing import op1_best_fit_packing
from cargolens.llm.quality import OP3_SQL, op3_quality_rules
from cargolens.llm.sentencepieces import op6_sentencepiece
from cargolens.llm.sharding import op10_sharding
from cargolens.llm.spelling import op12_spelling_variants
from cargolens.llm.substrings import op9_substring_dedup
from cargolens.llm.suffixes import op2_suffix_dedup
from cargolens.llm.whitening import op11_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_id": op4_language_id,
    "op5_license_scan": op5_license_scan,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_sharding": op10_sharding,
    "op11_whitening": op11_whitening,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_bpe": op13_bpe,
}

SQL: dict[str, str] = {"op3_quality_rules": OP3_SQL, "op5_license_scan": scan_sql()}
