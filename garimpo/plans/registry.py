"""All named queries of the core and the SQL each is compared with."""

from __future__ import annotations

from garimpo.plans import catalog, extras, health, io, problems, problems_sql, quality, relational, scalars, serving, streams, texts, warehouse  # noqa: F401


def queries() -> dict:
    return problems.QUERIES | catalog.QUERIES


def oracle_sql() -> dict[str, str]:
    return problems_sql.ORACLES | catalog.ORACLES
