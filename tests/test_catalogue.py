"""Every registered query of the engine against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from scorelane.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def plain(frame, columns):
    frame = frame[columns].copy()
    for c in columns:
        if pd.api.types.is_bool_dtype(frame[c]):
            frame[c] = frame[c].map(lambda v: "" if v is None or v is pd.NA else str(bool(v)))
        elif pd.api.types.is_numeric_dtype(frame[c]):
            frame[c] = frame[c].astype(float).round(6).astype(str)
        elif str(frame[c].dtype).startswith("datetime"):
            frame[c] = frame[c].astype("datetime64[us]").astype(str)
        else:
            frame[c] = frame[c].map(lambda v: "" if v is None or v is pd.NA or v != v else str(v))
    return sorted(map(tuple, frame.values.tolist()))


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    got = catalogue.queries()[name](spark, FOLDER).toPandas()
    sql = catalogue.oracles().get(name)
    if sql is None:
        assert len(got)
        return
    want = con.execute(sql).fetch_df()
    assert sorted(want.columns) == sorted(got.columns)
    assert plain(got, sorted(want.columns)) == plain(want, sorted(want.columns))


def test_flagship(spark):
    assert catalogue.flagship(spark, FOLDER).count() > 0


def test_pages_are_shuffled_as_numbers(spark):
    from scorelane.plans import catalogue

    plan = catalogue._match_pages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "mapholder" in plan[: plan.index("Exchange")] and "mapholder" not in below
