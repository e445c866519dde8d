"""Readers of landed documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


#: Column with the whole text of a document that is no JSON or has a field of another type.
DAMAGED = "_damaged"


def read_lines(
    spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType, damaged: bool = False
) -> DataFrame:
    """Line-delimited JSON, gzip by file name; a gzip file is read by one task.

    With ``damaged`` the column of that name holds the text of documents that do not fit the schema, else null.
    Fields that fit are still filled in, the others are null.
    """
    if not damaged:
        return spark.read.schema(schema).json(paths)
    marked = T.StructType([*schema.fields, T.StructField(DAMAGED, T.StringType())])
    return spark.read.schema(marked).option("columnNameOfCorruptRecord", DAMAGED).json(paths)


def read_documents(spark: SparkSession, paths: Sequence[str] | str, schema: T.StructType) -> DataFrame:
    """Files that hold one indented document or one array of records each."""
    return spark.read.schema(schema).option("multiLine", "true").json(paths)


def read_csv_files(spark: SparkSession, groups: Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV files with a header from several folders, united by name."""
    parts = [spark.read.schema(schema).option("header", "true").csv(g) for g in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
