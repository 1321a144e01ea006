"""Registered queries over the test tables, each with SQL that says the same."""

from importlib import import_module

MODULES = (
    "window_queries",
    "summary_queries",
    "join_queries",
    "cleaning_queries",
    "scalar_queries",
    "source_queries",
    "roster_queries",
    "model_queries",
    "job_queries",
)


def registered() -> tuple[dict, dict]:
    """All queries by name, and the SQL of those that have one."""
    for module in MODULES:
        import_module(f"panelworks.checks.{module}")
    from panelworks.checks.book import ORACLE, QUERIES

    return dict(QUERIES), dict(ORACLE)
