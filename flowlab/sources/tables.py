"""Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T


def load(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def load_many(spark: SparkSession, paths: Sequence[str], merge_schema: bool = False) -> DataFrame:
    """Part files as one table; `merge_schema` also takes columns that only some have."""
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*paths)


def save(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a table that has fewer splits than the cluster has cores, such as a single
    file with one row group. A table of many splits comes back as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def unique_names(df: DataFrame) -> DataFrame:
    """Rename columns so that none needs quoting and none differ only by case. Read such
    a table with spark.sql.caseSensitive=true."""
    taken: set[str] = set()
    names = []
    for c in df.columns:
        name = base = "".join(ch if ch.isalnum() else "_" for ch in c)
        i = 2
        while name.lower() in taken:
            name, i = f"{base}_{i}", i + 1
        taken.add(name.lower())
        names.append(name)
    return df.toDF(*names)
