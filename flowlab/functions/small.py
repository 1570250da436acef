"""Results that are expected to be small, with the size checked."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows and bytes up to which a result is held on the driver and broadcast.
MAX_LOCAL_ROWS = 20_000
MAX_LOCAL_BYTES = 16 << 20


@dataclass(frozen=True)
class Settled:
    """A result computed once: `table` is None when it was too big for the driver."""

    df: DataFrame
    table: pa.Table | None

    def peak(self, column: str):
        """Largest value of a column, without a job when the rows are local."""
        if self.table is None:
            return self.df.agg(F.max(column)).head()[0]
        values = [v for v in self.table[column].to_pylist() if v is not None]
        return max(values, default=None)


def use_checkpoints(spark: SparkSession) -> bool:
    """Point the context at the shared checkpoint folder, if the cluster names one."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return True
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        context.setCheckpointDir(folder)
    return bool(folder)


def settle(df: DataFrame, max_rows: int | None = None) -> Settled:
    """Up to `max_rows` rows and MAX_LOCAL_BYTES come back as a broadcast local table; a
    bigger result is left to be joined by a shuffle, where adaptive execution splits hot
    keys. It is checkpointed if the cluster names a folder for that, else computed again."""
    max_rows = MAX_LOCAL_ROWS if max_rows is None else max_rows
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows <= max_rows and table.nbytes <= MAX_LOCAL_BYTES:
        return Settled(F.broadcast(df.sparkSession.createDataFrame(table)), table)
    return Settled(df.checkpoint() if use_checkpoints(df.sparkSession) else df, None)


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A driver-side result (p features, k classes, ...) as a DataFrame."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    columns = list(zip(*rows)) if rows else [()] * len(arrow)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=fields)
