"""Every registered query of the reference's operators against its SQL twin, at the smallest scale."""

import duckdb
import pandas as pd
import pytest

from framewright.plans import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in registry.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def normal(df: pd.DataFrame) -> list:
    def cell(x):
        if x is None or (not isinstance(x, (list, tuple)) and pd.isna(x)):
            return "null"
        return repr(round(float(x), 6) + 0.0) if isinstance(x, float) else str(x)

    columns = sorted(df.columns)
    return [columns, sorted([cell(x) for x in row] for row in df[columns].itertuples(index=False))]


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, FOLDER).toPandas()
    if name in registry.ORACLES:
        assert normal(got) == normal(duck.execute(registry.ORACLES[name]).df())
    else:
        assert len(got)
