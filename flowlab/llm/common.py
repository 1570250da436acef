"""What several of these operators need: words, shared tables, row digests, dense ranks."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from flowlab.functions.columns import col

# The white space between words, in Java and in Python.
SPACES = r"[\x20\x09-\x0D]+"


@functools.cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="flowlab-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; on one machine without one, a folder of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _own_folder(spark.sparkContext.applicationId)


def stored(df: DataFrame) -> DataFrame:
    """`df` computed once, as a table in the shared folder: it outlives its executors, and
    its size is known to the planner, which broadcasts it only below Spark's own limit."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str) -> Column:
    """A text column, null as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words between white space, as an array."""
    return F.array_remove(F.split(text, SPACES), "")


def _hashable(frame_type: T.DataType, c: Column) -> Column:
    """Maps, also inside of other values, as sorted arrays: they have no hash of their own."""
    if isinstance(frame_type, T.MapType):
        entry = lambda e: F.struct(
            _hashable(frame_type.keyType, e["key"]).alias("key"), _hashable(frame_type.valueType, e["value"]).alias("value"))
        return F.to_json(F.array_sort(F.transform(F.map_entries(c), lambda e: F.to_json(entry(e)))))
    if isinstance(frame_type, T.ArrayType) and _has_map(frame_type):
        return F.transform(c, lambda e: _hashable(frame_type.elementType, e))
    if isinstance(frame_type, T.StructType) and _has_map(frame_type):
        return F.when(c.isNotNull(), F.struct(*[
            _hashable(f.dataType, c.getField(f.name)).alias(f"f{i}") for i, f in enumerate(frame_type.fields)]))
    return c


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def row_digest(docs: DataFrame) -> Column:
    """`digest` of all columns of a row, maps by their entries whatever their order."""
    return digest(*[_hashable(f.dataType, col(f.name)) for f in docs.schema.fields])


def digest(*columns: Column) -> Column:
    """128 bits of the columns' values as a struct of two longs; nulls count as values."""
    marks = [F.when(c.isNull(), 1).otherwise(0) for c in columns]
    return F.struct(
        F.xxhash64(F.lit(1), *columns, *marks).alias("a"),
        F.xxhash64(F.lit(2), *columns, *marks).alias("b"),
    )


def offsets(counts: DataFrame, keys: Sequence[str], bucket: str, amount: str) -> DataFrame:
    """`counts` with `before`: the sum of `amount` over all smaller buckets of the same keys.

    Buckets are summed in two levels (1,024 to a run), so that neither window holds more
    than about the square root of them."""
    run = F.floor(F.col(bucket) / 1024)
    part = counts.withColumn("_run", run)
    within = Window.partitionBy(*keys, "_run").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (part.groupBy(*keys, "_run").agg(F.sum(amount).alias("_sum"))
            .withColumn("_above", F.coalesce(F.sum("_sum").over(above), F.lit(0))).drop("_sum"))
    return (part.withColumn("_within", F.coalesce(F.sum(amount).over(within), F.lit(0)))
            .join(runs, [*keys, "_run"])
            .withColumn("before", F.col("_within") + F.col("_above"))
            .drop("_run", "_within", "_above"))


def whole_rows(docs: DataFrame) -> Column:
    """All columns of a row in one struct, safe from names that an operator adds."""
    return F.struct(*[col(c) for c in docs.columns])
