"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm.alignment import op12_token_alignment
from ebbtide.llm.chat import OP9_SQL, op9_maximal_conversations
from ebbtide.llm.decontamination import op3_bm25_decontamination
from ebbtide.llm.grammar import op7_repair_token_files
from ebbtide.llm.jaccard import op6_ngram_jaccard_join
from ebbtide.llm.language_model import op4_backoff_automaton
from ebbtide.llm.packing import op10_best_fit_packing
from ebbtide.llm.phrases import OP13_SQL, op13_phrase_collocations
from ebbtide.llm.quality import op5_random_indexing_quality
from ebbtide.llm.repeats import op11_repeated_spans
from ebbtide.llm.sharding import op8_contiguous_shards
from ebbtide.llm.token_counts import op1_trie_token_counts
from ebbtide.llm.vectors import op2_subspace_near_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_trie_token_counts": op1_trie_token_counts,
    "op2_subspace_near_vectors": op2_subspace_near_vectors,
    "op3_bm25_decontamination": op3_bm25_decontamination,
    "op4_backoff_automaton": op4_backoff_automaton,
    "op5_random_indexing_quality": op5_random_indexing_quality,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_repair_token_files": op7_repair_token_files,
    "op8_contiguous_shards": op8_contiguous_shards,
    "op9_maximal_conversations": op9_maximal_conversations,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_repeated_spans": op11_repeated_spans,
    "op12_token_alignment": op12_token_alignment,
    "op13_phrase_collocations": op13_phrase_collocations,
}

SQL: dict[str, str] = {"op9_maximal_conversations": OP9_SQL, "op13_phrase_collocations": OP13_SQL}
