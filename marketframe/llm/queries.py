"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from marketframe.llm.bpe_automaton import op11_bpe_automaton
from marketframe.llm.collocations import OP13_SQL, op13_collocations
from marketframe.llm.decontaminate import OP8_SQL, op8_decontamination
from marketframe.llm.embeddings import op4_near_vectors
from marketframe.llm.language import op3_language
from marketframe.llm.licenses import OP7_SQL, op7_licenses
from marketframe.llm.lm_scores import op5_lm_scores
from marketframe.llm.near_duplicates import op10_near_duplicates
from marketframe.llm.packing import op1_packing
from marketframe.llm.prefix_trie import OP12_SQL, op12_prefix_trie
from marketframe.llm.quality import op6_quality
from marketframe.llm.token_counts import op9_token_counts
from marketframe.llm.token_files import op2_token_files

QUERIES = {
    "op1_packing": op1_packing,
    "op2_token_files": op2_token_files,
    "op3_language": op3_language,
    "op4_near_vectors": op4_near_vectors,
    "op5_lm_scores": op5_lm_scores,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_bpe_automaton": op11_bpe_automaton,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_collocations": op13_collocations,
}

#: DuckDB SQL over the given tables, where SQL can express the operator.
ORACLE: dict[str, str] = {
    "op7_licenses": OP7_SQL,
    "op8_decontamination": OP8_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
