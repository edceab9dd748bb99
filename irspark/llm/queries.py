"""All queries of the subpackage."""

from irspark.llm import query_alignment, query_audit, query_dedup, query_language, query_layout, query_quality, query_search, query_tokens, query_web  # noqa: F401
from irspark.llm.registry import QUERIES, SQL  # noqa: F401
