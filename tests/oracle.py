"""Compare a registered query with its SQL."""

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    df = df[sorted(df.columns)]

    def plain(v):
        if isinstance(v, (list, np.ndarray)):
            return [plain(x) for x in v]
        if v is None or (pd.api.types.is_scalar(v) and pd.isna(v)):
            return None
        v = v.item() if hasattr(v, "item") else v
        # a column of whole numbers with nulls is one of floats in pandas
        return (int(v) if v.is_integer() else round(v, 9)) if isinstance(v, float) else v

    return sorted(repr([plain(v) for v in r]) for r in df.itertuples(index=False, name=None))


def compare(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got, want = query(spark, sf_dir).toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
