"""Each registered query with a SQL twin gives the twin's rows."""

import pytest

import __spark_entry__ as entry
from graphloom.plans import queries as graph


def rounded(v):
    return round(v, 9) if isinstance(v, float) else v


def same_rows(df, con, sql):
    columns = sorted(df.columns)
    got = sorted((tuple(rounded(r[c]) for c in columns) for r in df.collect()), key=repr)
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    expected = sorted((tuple(rounded(r[names.index(c)]) for c in columns) for r in answer.fetchall()), key=repr)
    assert list(map(repr, got)) == list(map(repr, expected))


@pytest.mark.parametrize("name", sorted(graph.ORACLE))
def test_twin(spark, data, duck, name):
    same_rows(graph.QUERIES[name](spark, data), duck, graph.ORACLE[name])


def test_contract(spark, data):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(graph.QUERIES) == set(graph.ORACLE)
    assert entry.entry(spark).count() == 5
