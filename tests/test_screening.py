"""Every screening query against its SQL in DuckDB on the smallest data folder."""

import math
import os

import duckdb
import pandas as pd
import pytest

from screenlake import queries as screening

SF = os.environ.get("SCREENLAKE_SF", "/root/testdata/sf0.001")
SQL = screening.oracle_sql()


def rows(df: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if isinstance(v, (list, tuple)) or hasattr(v, "tolist") and getattr(v, "ndim", 0):
            return "[" + ",".join(plain(x) for x in v) + "]"
        if pd.isna(v):
            return "-"
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        try:
            f = float(v)
        except (TypeError, ValueError):
            return str(v)
        return f"{0.0 if abs(f) < 1e-12 else f:.7g}" if math.isfinite(f) else str(f)

    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(screening.queries()))
def test_query(spark, duck, name):
    got = screening.queries()[name](spark, SF).toPandas()
    if name in SQL:
        want = duck.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    else:  # test_clusters_and_files.py, test_fit_and_quantiles.py and test_reads_kept.py hold these against plain Python
        assert name in ("butina_clusters", "cluster_reps", "cluster_medoids", "top_k_peaks", "glm_iterative", "final_picks_of_clusters") and len(got)
