"""Every registered query against its SQL twin."""

import math

import pytest

from caselog.plans import catalog


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return None if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_a_twin():
    assert set(catalog.SQL) == set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(name, spark, duck, folder):
    df = catalog.QUERIES[name](spark, folder)
    ours = _rows(df.columns, df.collect())
    cursor = duck.execute(catalog.SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert ours == _rows(columns, cursor.fetchall())
