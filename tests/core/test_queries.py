"""Every query of the engine against DuckDB on the smallest tables."""

import duckdb
import pytest

from tidemark.plans import registry

TABLES = "customer part orders lineitem events"


def rows(found, order):
    def plain(v):
        return round(v, 9) if isinstance(v, float) else str(v) if hasattr(v, "isoformat") else v

    return sorted((tuple(plain(r[k]) for k in order) for r in found), key=str)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = rows([r.asDict() for r in df.collect()], columns)
    if name not in registry.ORACLE_SQL:
        assert got
        return
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    assert got == rows([dict(zip(names, r)) for r in cur.fetchall()], columns)


def test_entry_without_the_training_operators(monkeypatch):
    import importlib.util

    import __spark_entry__ as entry

    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n in ("tidemark.llm", "corpus_pipeline") else real(n, *a))
    assert set(entry.queries()) == set(registry.QUERIES) and set(entry.oracle_sql()) == set(registry.ORACLE_SQL)
