"""Column expressions used by more than one operator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Numeric strings accepted by coercion, as in pandas' to_numeric.
NUMERIC_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?)\s*$"


def col(name: str) -> Column:
    """A column by its literal name, also when it holds spaces or dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def missing(c: Column, dtype: str) -> Column:
    """True for null, and for NaN in a floating-point column."""
    if dtype in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def number(name: str, dtype: str = "double") -> Column:
    """A column as double, with NaN read as null."""
    c = col(name).cast("double")
    return F.when(~F.isnan(c), c) if dtype in ("double", "float") else c


def key_hash(key_cols: Sequence[str], seed: int) -> Column:
    """Keyed order of the rows: the same on every run and after every retry."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in key_cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def _exact(c: Column, kind: T.DataType) -> Column:
    """The value in a form that JSON holds without loss, whatever the time zone."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return c.cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _exact(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_exact(c.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return F.transform(F.map_entries(c), lambda x: _exact(x, entry))
    return c


def row_text(df: DataFrame) -> Column:
    """The whole row as text: equal for equal rows only, on every run and in any time zone."""
    fields = [_exact(col(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(df.schema.fields)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def row_hash(df: DataFrame, seed: int) -> Column:
    """Like key_hash, over the content of the whole row."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), row_text(df)))


def ratio(a: Column, b: Column) -> Column:
    """a / b, with 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
