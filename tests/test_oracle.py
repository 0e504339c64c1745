"""Every registered query against its SQL on the smallest tables, values and all."""

import pandas as pd
import pytest

import __spark_entry__ as entry_module
from passagework.plans.oracle import ORACLE
from passagework.plans.registry import QUERIES

WITHOUT_SQL: set[str] = set()


def canonical(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]

    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return None
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted((tuple(cell(v) for v in row) for row in df.itertuples(index=False)), key=str)


def test_every_query_has_a_check():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, duck, name):
    found = QUERIES[name](spark, sf).toPandas()
    wanted = duck.execute(ORACLE[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert len(found) > 0
    assert canonical(found) == canonical(wanted)


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).columns == ["page_id", "url", "chunk_pos", "content", "n_tokens"]
    assert entry_module.entry(spark).count() > 0
