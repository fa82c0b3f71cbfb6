"""The queries of this package and, where SQL can say the same, that SQL."""

from __future__ import annotations

from gridspark.llm.bit_sliced import OP13_SQL, op13_exact_top_k
from gridspark.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from gridspark.llm.graph_search import op5_nearest_neighbours
from gridspark.llm.language_id import op8_language_id
from gridspark.llm.lexical_search import OP12_SQL, op12_lexical_search
from gridspark.llm.near_dedup import OP10_SQL, op10_near_dedup
from gridspark.llm.packing import op6_packing
from gridspark.llm.pieces import op2_sampled_pieces
from gridspark.llm.pii import op9_pii
from gridspark.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from gridspark.llm.quality import op3_quality_classifier
from gridspark.llm.substring_dedup import OP7_SQL, op7_substring_dedup
from gridspark.llm.url_filter import OP4_SQL, op4_url_filter

REPORTS = {
    "op1_exact_dedup": (op1_exact_dedup, OP1_SQL),
    "op2_sampled_pieces": (op2_sampled_pieces, None),
    "op3_quality_classifier": (op3_quality_classifier, None),
    "op4_url_filter": (op4_url_filter, OP4_SQL),
    "op5_nearest_neighbours": (op5_nearest_neighbours, None),
    "op6_packing": (op6_packing, None),
    "op7_substring_dedup": (op7_substring_dedup, OP7_SQL),
    "op8_language_id": (op8_language_id, None),
    "op9_pii": (op9_pii, None),
    "op10_near_dedup": (op10_near_dedup, OP10_SQL),
    "op11_prefix_trie": (op11_prefix_trie, OP11_SQL),
    "op12_lexical_search": (op12_lexical_search, OP12_SQL),
    "op13_exact_top_k": (op13_exact_top_k, OP13_SQL),
}
