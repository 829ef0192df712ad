"""Every query of the engine against its SQL, and those without any for rows."""

import pytest

from archivelens.queries import catalogue

from .conftest import canonical_rows

QUERIES = catalogue()
#: May be empty on the smallest archive.
SPARSE = {"pii_sin"}


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql is not None])
def test_equals_oracle(name, spark, sf, duck):
    run, sql = QUERIES[name]
    ours, theirs = run(spark, sf).toPandas(), duck.execute(sql).df()
    assert canonical_rows(ours) == canonical_rows(theirs)
    assert len(ours) or name in SPARSE


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql is None and n not in ("canonicalize", "archive_pipeline", "dup_content_ratio")])
def test_has_rows(name, spark, sf):
    assert QUERIES[name][0](spark, sf).limit(1).count() == 1


def test_entry(spark):
    import __spark_entry__ as e

    assert {r["dimension"] for r in e.entry(spark).collect()} == {"tier", "status", "funder"}
    assert set(e.oracle_sql()) <= set(e.queries())
