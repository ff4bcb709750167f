"""The queries of this subpackage, and the pipeline's, with their SQL."""

from __future__ import annotations

import corpus_pipeline
from auditlens.llm.bpe import op7_pair_index_bpe
from auditlens.llm.chat import OP2_SQL, op2_tool_calls
from auditlens.llm.exact_dedup import OP6_SQL, op6_exact_dedup
from auditlens.llm.imatch import op9_imatch
from auditlens.llm.importance import op12_importance_resampling
from auditlens.llm.language import op5_compression_language
from auditlens.llm.mixing import op13_entropy_mixing
from auditlens.llm.near_dedup import op1_dart_minhash
from auditlens.llm.packing import op10_best_fit
from auditlens.llm.sharding import op4_ring_shards
from auditlens.llm.spelling import op11_frequency_trie
from auditlens.llm.suffix_dedup import op3_prefix_doubling
from auditlens.llm.training_order import op8_training_order

QUERIES = {
    "op1_dart_minhash": op1_dart_minhash,
    "op2_tool_calls": op2_tool_calls,
    "op3_prefix_doubling": op3_prefix_doubling,
    "op4_ring_shards": op4_ring_shards,
    "op5_compression_language": op5_compression_language,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_pair_index_bpe": op7_pair_index_bpe,
    "op8_training_order": op8_training_order,
    "op9_imatch": op9_imatch,
    "op10_best_fit": op10_best_fit,
    "op11_frequency_trie": op11_frequency_trie,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_entropy_mixing": op13_entropy_mixing,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {"op2_tool_calls": OP2_SQL, "op6_exact_dedup": OP6_SQL}
