"""Every query with a SQL counterpart gives the rows DuckDB gives."""

import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def canonical(rows):
    return sorted(repr(tuple(None if isinstance(v, float) and v != v else v for _, v in sorted(r.items()))) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(name, spark, duck, small):
    left = QUERIES[name](spark, small).toArrow()
    right = duck.sql(ORACLES[name]).to_arrow_table()
    assert sorted(left.column_names) == sorted(right.column_names)
    assert canonical(left.to_pylist()) == canonical(right.to_pylist())
    assert left.num_rows > 0 or right.num_rows == 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
