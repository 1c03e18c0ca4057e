"""Run registered queries next to their SQL and report differences."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as registry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _kind(value):
    if isinstance(value, bool):
        return "bool"
    return type(value).__name__


def normalised(rows: list[dict]) -> list[tuple]:
    """Rows as tuples in column-name order, sorted, with the kinds of values made explicit."""
    def cell(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return ("null", "")
        return (_kind(value), repr(value))
    return sorted(tuple((name, *cell(row[name])) for name in sorted(row)) for row in rows)


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """None when the query and its SQL agree, otherwise what differs first."""
    got = normalised([row.asDict() for row in registry.queries()[name](spark, sf_dir).collect()])
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return None if got else "no rows"
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = normalised([dict(zip(names, row)) for row in cursor.fetchall()])
    if len(got) != len(expected):
        return f"{len(got)} rows, expected {len(expected)}"
    for mine, theirs in zip(got, expected):
        if mine != theirs:
            cells = [(a, b) for a, b in zip(mine, theirs) if a != b]
            return f"got / expected: {cells[:4]}"
    return None


if __name__ == "__main__":
    from matchlens.session import local_session

    folder = sys.argv[1]
    session = local_session("8")
    session.sparkContext.setLogLevel("ERROR")
    database = connect(folder)
    for query in sys.argv[2:] or registry.queries():
        started = time.time()
        try:
            verdict = difference(session, database, query, folder)
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"== {query}: {verdict or 'ok'} [{time.time() - started:.1f}s]", flush=True)
