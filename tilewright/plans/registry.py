"""The library's registered queries and their SQL."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _counts(sql: str) -> str:
    """``count_if`` as a count, which is a 64-bit number in DuckDB too."""
    while (at := sql.find("count_if(")) >= 0:
        depth, end = 1, at + len("count_if(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = f"{sql[:at]}count(CASE WHEN {sql[at + 9 : end - 1]} THEN 1 END){sql[end:]}"
    return sql


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = _counts(sql)
        return f

    return register
