"""All registered queries of this subpackage, and their SQL."""

from . import (  # noqa: F401
    alignment,
    chat_perspectives,
    chunk_dedup,
    context_tree,
    decontaminate,
    line_rules,
    line_templates,
    ngram_join,
    packing,
    pu_quality,
    tree_bpe,
    warc,
    whitening,
)
import corpus_pipeline

from .common import QUERIES, SQL

QUERIES["pipeline"] = corpus_pipeline.run

__all__ = ["QUERIES", "SQL"]
