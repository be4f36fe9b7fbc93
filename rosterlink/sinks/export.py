"""File exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rosterlink.sources.written import delete


def manifest(tables: dict[str, DataFrame], run_id: str, exported_at: str) -> DataFrame:
    """``(entity, n, run_id, exported_at)``; empty tables count 0."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("entity"), "n", F.lit(run_id).alias("run_id"), F.lit(exported_at).alias("exported_at"))
        out = row if out is None else out.unionByName(row)
    return out


def export(tables: dict[str, DataFrame], path: str, run_id: str, exported_at: str, form: str = "json") -> DataFrame:
    """Write each table that has rows under ``path`` and the manifest beside them; returns the manifest.

    Rows are counted while they are written, so every table is worked out once; a folder that got no rows goes again.
    """
    rows = []
    for name, df in tables.items():
        n = counted_write(df, f"{path}/{name}", form)
        rows.append((name, n, run_id, exported_at))
        if not n:
            delete(df.sparkSession, f"{path}/{name}")
    out = next(iter(tables.values())).sparkSession.createDataFrame(rows, "entity string, n bigint, run_id string, exported_at string")
    out.write.mode("overwrite").json(f"{path}/manifest")
    return out


def counted_write(df: DataFrame, path: str, form: str = "json") -> int:
    """Write a table and return the number of its rows, as the one pass that writes them has counted it."""
    seen = Observation()
    df.observe(seen, F.count("*").alias("n")).write.mode("overwrite").format(form).save(path)
    return seen.get["n"]


def write_seeds(seeds: DataFrame, path: str) -> None:
    """Seeds sorted by key."""
    seeds.orderBy("key").write.mode("overwrite").json(path)
