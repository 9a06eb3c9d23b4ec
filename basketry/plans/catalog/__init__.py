"""Named queries over the star-schema tables, each with the SQL that must give the same rows."""

from basketry.plans.catalog import daily, delivery, ingest, jobs, returns, signals, similarity, stock, stores  # noqa: F401
from basketry.plans.catalog.registry import oracle_sql, queries  # noqa: F401
