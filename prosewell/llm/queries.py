"""The registered queries of the operators in this folder, and the SQL each must equal where SQL can."""

from __future__ import annotations

from prosewell.llm import (  # noqa: F401
    alignment_queries,
    chat_queries,
    copy_queries,
    merge_queries,
    mixing_queries,
    piece_queries,
    quality_queries,
    run_queries,
    token_queries,
    toxicity_queries,
    url_queries,
    vector_queries,
)
