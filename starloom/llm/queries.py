"""All queries of this subpackage."""

from starloom.llm import (  # noqa: F401
    bpe_query,
    chat_query,
    decontaminate_query,
    divergence_query,
    language_query,
    masked_lm_query,
    mixing_query,
    ngram_join_query,
    prefix_trie_query,
    sketch_query,
    surrogates_query,
    toxicity_query,
    warc_query,
)
from starloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
