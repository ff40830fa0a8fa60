"""Every reference query against its SQL on the smallest tables."""

import glob
import os
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from splatframe.operators.clouds import OptionError, import_options
from splatframe.plans.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df[sorted(df.columns)].astype(str).itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    assert rows(QUERIES[name](spark, DATA).toPandas()) == rows(db.execute(ORACLE_SQL[name]).df())


@pytest.mark.parametrize("options", [{"shDegree": v} for v in ("4", "-1", "abc", "1.5")] + [{"opacityThreshold": v} for v in ("1.5", "-0.1", "nope", "nan")] + [{"scaleMultiplier": v} for v in ("0", "-2", "inf", "")])
def test_bad_options(options):
    with pytest.raises(OptionError):
        import_options(options)


def test_good_options():
    assert import_options({"shDegree": "2", "opacityThreshold": "0.5", "scaleMultiplier": "1e1", "x": "y"}) == {"shDegree": 2, "opacityThreshold": 0.5, "scaleMultiplier": 10.0}
