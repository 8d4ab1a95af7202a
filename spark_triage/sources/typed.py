"""Reading a stage's output again under its declared schema, without losing what does not fit."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Typed(NamedTuple):
    """``rows``: every row, in the declared types, NULL where a cell does not fit. ``rejects``: (key, column, reason,
    value), one row per such cell. ``drift``: (column, change, declared, found), what the file's columns lack (missing),
    have too many (extra) or hold as another type (type)."""

    rows: DataFrame
    rejects: DataFrame
    drift: DataFrame


def _drift(spark: SparkSession, found: T.StructType, declared: T.StructType, types: bool) -> DataFrame:
    name = lambda s, c: s[c].dataType.simpleString() if c in s.fieldNames() else None
    rows = [(c, "missing", name(declared, c), None) for c in declared.fieldNames() if c not in found.fieldNames()]
    rows += [(c, "extra", None, name(found, c)) for c in found.fieldNames() if c not in declared.fieldNames()]
    rows += [(c, "type", name(declared, c), name(found, c)) for c in declared.fieldNames()
             if types and c in found.fieldNames() and name(declared, c) != name(found, c)]
    return spark.createDataFrame(rows, "column string, change string, declared string, found string")


def _reason(raw: Column, value: Column, field: T.StructField) -> Column:
    """Why a cell is rejected; NULL if it is not."""
    some = raw.isNotNull()
    reason = F.when(some & value.isNull(), F.lit(f"not a {field.dataType.simpleString()}"))
    return reason if field.nullable else reason.when(~some, F.lit("empty"))


def fit(df: DataFrame, schema: T.StructType, key: str, types: bool = True) -> Typed:
    """``df`` under ``schema``; columns are matched by name, in any order, and cells cast where that loses nothing."""
    raw = {f.name: F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType) for f in schema}
    value = {f.name: raw[f.name] if f.name not in df.columns else raw[f.name].try_cast(f.dataType) for f in schema}
    bad = F.array_compact(F.array(*[
        F.when(reason.isNotNull(), F.struct(F.lit(f.name).alias("column"), reason.alias("reason"), raw[f.name].cast("string").alias("value")))
        for f in schema if f.name in df.columns for reason in [_reason(raw[f.name], value[f.name], f)]]))
    rows = df.select(*[value[f.name].alias(f.name) for f in schema])
    rejects = df.select(raw[key].cast("string").alias("key"), F.explode(bad).alias("b")).select("key", "b.*")
    return Typed(rows, rejects, _drift(df.sparkSession, df.schema, schema, types))


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, key: str, multi_line: bool = True) -> Typed:
    """A CSV folder with headers. All cells are read as text first, so one that does not fit costs neither its row nor the
    scan; files whose headers differ from the first are refused by the reader. Empty unquoted cells are NULL."""
    names = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(path).columns
    every = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(every).csv(path, header=True, multiLine=multi_line, escape='"', enforceSchema=False)
    return fit(raw, schema, key, types=False)


def read_typed(spark: SparkSession, path: str, schema: T.StructType, key: str) -> Typed:
    """A Parquet folder, whatever types its columns have by now."""
    return fit(spark.read.parquet(path), schema, key)


def require_typed(typed: Typed) -> DataFrame:
    """The rows, if every declared column is there and every cell fits; else an error that names the first misfits."""
    lost = typed.drift.filter("change <> 'extra'").limit(5).collect()
    bad = typed.rejects.limit(5).collect()
    if lost or bad:
        raise ValueError(f"columns {[tuple(r) for r in lost]}, cells {[tuple(r) for r in bad]}")
    return typed.rows
