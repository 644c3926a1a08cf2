"""Registered queries of the training-data operators."""

from __future__ import annotations

from .chat import op10_chat_windows
from .embedding_dedup import op6_embedding_near_dedup
from .jaccard_join import op1_ngram_jaccard_join
from .licenses import op9_license_signatures
from .mixing import op5_soft_membership_mixing
from .neighbours import op7_block_matrix_neighbours
from .oracles import ORACLES
from .packing import op3_bounded_space_packing
from .sharding import op2_hypergeometric_sharding
from .suffix_dedup import op8_radix_suffix_dedup
from .toxicity import op4_string_kernel_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_hypergeometric_sharding,
        op3_bounded_space_packing,
        op4_string_kernel_toxicity,
        op5_soft_membership_mixing,
        op6_embedding_near_dedup,
        op7_block_matrix_neighbours,
        op8_radix_suffix_dedup,
        op9_license_signatures,
        op10_chat_windows,
    )
}

__all__ = ["ORACLES", "QUERIES"]
