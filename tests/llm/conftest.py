"""The operators' queries are registered when their module is imported."""

import corpus_pipeline  # noqa: F401
import prosewell.llm.queries  # noqa: F401
