"""JSON documents and JSON lines."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_json(spark: SparkSession, path: str, document: Mapping) -> None:
    """One small document: sorted keys, two blanks of indent, UTF-8, a final line end. Folders are made, on whatever store the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray((json.dumps(document, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode()))
    finally:
        out.close()


def _sorted_fields(column, kind: T.DataType):  # noqa: ANN001, ANN202
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(column.isNotNull(), F.struct(*[_sorted_fields(column[f.name], f.dataType).alias(f.name) for f in fields]))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _sorted_fields(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.map_from_entries(F.array_sort(F.transform(F.map_entries(column), lambda e: F.struct(e["key"].alias("key"), _sorted_fields(e["value"], kind.valueType).alias("value")))))
    return column


def write_jsonl(df: DataFrame, path: str, order_by: Sequence[str | Column] | None = None, leave_out: Sequence[str] = ()) -> None:
    """Part files of JSON lines with fields, and the keys of maps, in alphabetical order at every level; nulls are written.

    Rows come in the given order, part by part; columns in ``leave_out`` may serve for it and are not written.
    """
    if order_by:
        df = df.orderBy(*order_by)
    fields = sorted((f for f in df.schema.fields if f.name not in leave_out), key=lambda f: f.name)
    df.select(*[_sorted_fields(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields]).write.mode("overwrite").json(path, ignoreNullFields=False)
