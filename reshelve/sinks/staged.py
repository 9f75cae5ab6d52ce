"""Write staged tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def stage(tables: dict[str, DataFrame], path: str) -> None:
    """Overwrite each table as Parquet under ``<path>/<table>``."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a report; CSV reports carry a header."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
