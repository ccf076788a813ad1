"""All queries of the reference operators by name, and the SQL that says the same."""

from __future__ import annotations

from spanforge.plans import applicability_queries, assertion_queries, check_queries, context_queries, document_queries, economics_queries, evaluation_queries, grid_queries, mutation_queries, reading_queries, record_queries, scalar_queries, span_queries, structure_queries, terms_queries  # noqa: F401  they register their queries
from spanforge.plans.base import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


FLAGSHIP = QUERIES["candidate_chunk_contributions"]
