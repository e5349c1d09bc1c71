"""Registered queries of the corpus operators, and their SQL where it exists."""

from __future__ import annotations

from strata.llm.ann import op8_ann
from strata.llm.bpe import op10_bpe
from strata.llm.embed_dedup import op1_embedding_dedup
from strata.llm.html_extract import op12_html_extract
from strata.llm.lexical_search import OP11_SQL, op11_lexical_search
from strata.llm.mixing import OP2_SQL, op2_mixing
from strata.llm.periodic_runs import op13_periodic_runs
from strata.llm.pii import OP9_SQL, op9_pii
from strata.llm.sharding import op5_sharding
from strata.llm.simhash import op6_simhash
from strata.llm.substring_dedup import op7_substring_dedup
from strata.llm.suffix_dedup import op4_suffix_dedup
from strata.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_sharding": op5_sharding,
    "op6_simhash": op6_simhash,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_ann": op8_ann,
    "op9_pii": op9_pii,
    "op10_bpe": op10_bpe,
    "op11_lexical_search": op11_lexical_search,
    "op12_html_extract": op12_html_extract,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {"op2_mixing": OP2_SQL, "op9_pii": OP9_SQL, "op11_lexical_search": OP11_SQL}
