"""Access to the driver's parquet tables and result presentation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column, so results computed with different
    summation orders compare equal."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(field.name), places).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)
