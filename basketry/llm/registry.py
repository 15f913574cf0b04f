"""Named queries of the subpackage and their DuckDB SQL.

A query without SQL is tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from basketry.llm.chat import OP5_SQL, op5
from basketry.llm.collocations import OP13_SQL, op13
from basketry.llm.decontaminate import OP10_SQL, op10
from basketry.llm.langid import op1
from basketry.llm.licenses import OP2_SQL, op2
from basketry.llm.lines import OP11_SQL, op11
from basketry.llm.manifest import OP12_SQL, op12
from basketry.llm.mixing import op4
from basketry.llm.neighbours import OP3_SQL, op3
from basketry.llm.neardup import OP9_SQL, op9
from basketry.llm.quality import op8
from basketry.llm.suffix_tree import op6
from basketry.llm.suffixes import OP7_SQL, op7

QUERIES = {
    "op1_language_id": op1,
    "op2_license_scans": op2,
    "op3_embedding_near_dedup": op3,
    "op4_source_mixing": op4,
    "op5_chat_formatting": op5,
    "op6_lm_scoring": op6,
    "op7_suffix_dedup": op7,
    "op8_quality_classifier": op8,
    "op9_ngram_jaccard_join": op9,
    "op10_benchmark_decontamination": op10,
    "op11_line_dedup": op11,
    "op12_merkle_manifest": op12,
    "op13_phrase_collocations": op13,
}

ORACLE_SQL = {
    "op2_license_scans": OP2_SQL,
    "op3_embedding_near_dedup": OP3_SQL,
    "op5_chat_formatting": OP5_SQL,
    "op7_suffix_dedup": OP7_SQL,
    "op9_ngram_jaccard_join": OP9_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
    "op11_line_dedup": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_phrase_collocations": OP13_SQL,
}
