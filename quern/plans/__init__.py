"""The five analyses, composed of the operators."""
from quern.plans.analyses import (
    PostingClusters,
    TextClusters,
    cluster_postings,
    cluster_texts,
    recommend_scores,
    top_k_common_words,
    word_count,
)

__all__ = [
    "PostingClusters",
    "TextClusters",
    "cluster_postings",
    "cluster_texts",
    "recommend_scores",
    "top_k_common_words",
    "word_count",
]
