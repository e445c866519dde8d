"""Profiles and data checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecraft.functions.numeric import percent, round_to


def _is_number(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def _long_form(df: DataFrame, cells: dict[str, list]) -> DataFrame:
    """Aggregate once, then turn the one wide row into a row per column."""
    wide = df.agg(*[c for group in cells.values() for c in group])
    names = list(cells)
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("column_name"),
                *[F.col(x).alias(x.split("|")[1]) for x in wide.columns if x.startswith(f"{n}|")],
            )
            for n in names
        ]
    )
    return wide.select(F.inline(rows))


def profile(df: DataFrame) -> DataFrame:
    """Type, smallest, largest, rows, mean, deviation and missing share of every column; one pass."""
    cells = {}
    for f in df.schema.fields:
        c = F.col(f.name)
        number = c.cast("double") if _is_number(f) else F.lit(None).cast("double")
        cells[f.name] = [
            F.lit(f.dataType.simpleString()).alias(f"{f.name}|column_type"),
            F.min(c).cast("string").alias(f"{f.name}|smallest"),
            F.max(c).cast("string").alias(f"{f.name}|largest"),
            F.count(F.lit(1)).alias(f"{f.name}|row_count"),
            round_to(F.avg(number), 4).alias(f"{f.name}|mean"),
            round_to(F.stddev_samp(number), 4).alias(f"{f.name}|deviation"),
            round_to(percent(F.count_if(c.isNull()), F.count(F.lit(1))), 2).alias(f"{f.name}|null_pct"),
        ]
    return _long_form(df, cells)


#: Size of the sketches: distinct counts within 3 % (two deviations of 1.04 / sqrt(2^12)), quartile ranks within 1.5 %.
HLL_BITS = 12
KLL_K = 400
DISTINCT_ERROR = 0.033
RANK_ERROR = 0.015


def sketches(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows, missing values and mergeable sketches of every other column, per key; one pass.

    ``distinct`` and ``ranks`` are binary and may be stored, for instance by date; ``ranks`` is null for what is no
    number. Columns without values have no sketches.
    """
    fields = [f for f in df.schema.fields if f.name not in keys]
    cells = {}
    for f in fields:
        c = F.col(f.name)
        text = c if isinstance(f.dataType, (T.StringType, T.LongType, T.IntegerType)) else c.cast("string")
        number = c.cast("double") if _is_number(f) else F.lit(None).cast("double")
        cells[f.name] = F.struct(
            F.lit(f.name).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(c.isNull()).alias("missing"),
            F.hll_sketch_agg(text, HLL_BITS).alias("distinct"),
            (F.kll_sketch_agg_double(number, KLL_K) if _is_number(f) else F.lit(None).cast("binary")).alias("ranks"),
        )
    wide = df.groupBy(*keys).agg(*[cell.alias(f"_{i}") for i, cell in enumerate(cells.values())])
    return wide.select(*keys, F.inline(F.array(*[f"_{i}" for i in range(len(cells))])))


def merged(stored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sketches of fewer keys out of stored ones; the data below them is not read again."""
    return stored.groupBy(*keys, "column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("missing").alias("missing"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.when(F.count("ranks") > 0, F.kll_merge_agg_double("ranks", KLL_K)).alias("ranks"),
    )


def estimates(sketched: DataFrame) -> DataFrame:
    """Approximate distinct count and quartiles out of sketches."""
    quartiles = [
        F.when(F.col("ranks").isNotNull() & (F.col("row_count") > F.col("missing")), F.kll_sketch_get_quantile_double("ranks", F.lit(q))).alias(label)
        for label, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    ]
    kept = [c for c in sketched.columns if c not in ("distinct", "ranks")]
    return sketched.select(*kept, F.hll_sketch_estimate("distinct").alias("approx_distinct"), *quartiles)


def profile_sketches(df: DataFrame) -> DataFrame:
    """Approximate distinct count and quartiles of every column; one pass with bounded sketches."""
    return estimates(sketches(df))


def describe(df: DataFrame) -> DataFrame:
    """Column names, types and nullability; read from the schema, no data is touched."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, column_type string, nullable boolean"
    )


def null_counts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Missing and present values per required column."""
    cells = {
        c: [
            F.count_if(F.col(c).isNull()).alias(f"{c}|missing"),
            F.count(F.col(c)).alias(f"{c}|present"),
        ]
        for c in required
    }
    return _long_form(df, cells)


def not_descending(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which the given columns, all known, are not ordered from largest to smallest."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    ordered = reduce(
        lambda a, b: a & b, [F.col(a) >= F.col(b) for a, b in zip(columns, columns[1:])]
    )
    return df.filter(known & ~ordered)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def load_batches(tables: Mapping[str, DataFrame], load_ts: str = "load_ts") -> DataFrame:
    """First and last load time, rows and number of distinct loads per dataset."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(load_ts).alias("first_load"),
            F.max(load_ts).alias("last_load"),
            F.count_distinct(load_ts).alias("loads"),
        ).select(F.lit(name).alias("dataset"), "row_count", "first_load", "last_load", "loads")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
