"""The registered queries of this package, and their SQL for the oracle."""

from __future__ import annotations

from tidemark.llm.bpe import op9_byte_bpe
from tidemark.llm.fim import op12_piece_table
from tidemark.llm.fingerprint import op8_one_permutation
from tidemark.llm.langid import language_pages, op1_language_id
from tidemark.llm.lattice import op10_lattice_near_dedup
from tidemark.llm.licenses import op11_template_containment
from tidemark.llm.lines import op6_fuzzy_lines
from tidemark.llm.lm import op2_backoff_automaton
from tidemark.llm.mixing import op4_temperature_mixing
from tidemark.llm.ngram_join import op3_combination_prefixes
from tidemark.llm.oracle import ORACLE
from tidemark.llm.resample import op13_line_resampling
from tidemark.llm.secrets import op5_ownership_secrets
from tidemark.llm.sharding import op7_sampled_shards

__all__ = ["ORACLE", "QUERIES"]

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_backoff_automaton": op2_backoff_automaton,
    "op3_combination_prefixes": op3_combination_prefixes,
    "op4_temperature_mixing": op4_temperature_mixing,
    "op5_ownership_secrets": op5_ownership_secrets,
    "op6_fuzzy_lines": op6_fuzzy_lines,
    "op7_sampled_shards": op7_sampled_shards,
    "op8_one_permutation": op8_one_permutation,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_lattice_near_dedup": op10_lattice_near_dedup,
    "op11_template_containment": op11_template_containment,
    "op12_piece_table": op12_piece_table,
    "op13_line_resampling": op13_line_resampling,
    "language_pages": language_pages,
}
