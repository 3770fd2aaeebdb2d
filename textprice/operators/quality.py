"""Projection, filter and data-quality operators."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.DoubleType, T.FloatType)


def drop_then_dropna(df: DataFrame, drop_cols=("dt", "symbol", "adj_close")) -> DataFrame:
    """B1+B2 (training preparation): drop columns first, then rows with any null left."""
    return df.drop(*drop_cols).na.drop("any")


def dropna_all(df: DataFrame) -> DataFrame:
    """B2 (notebook): drop rows with a null in any column."""
    return df.na.drop("any")


def column_selector(cols) -> SQLTransformer:
    """Persistable column-subset stage."""
    return SQLTransformer(statement="SELECT " + ", ".join(f"`{c}`" for c in cols) + " FROM __THIS__")


def align_columns(df: DataFrame, columns) -> DataFrame:
    """Select ``columns`` [(name, type)] in order; missing ones are typed nulls, extras dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(c).cast(t) if c in have else F.lit(None).cast(t)).alias(c)
                       for c, t in columns])


def filter_symbol(df: DataFrame, symbol: str) -> DataFrame:
    """Equality filter on the symbol (pushed to the scan when the column is stored)."""
    return df.filter(F.col("symbol") == F.lit(symbol))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Remove whole-row duplicates (hash aggregate with map-side pre-aggregation)."""
    return df.dropDuplicates()


def dup_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and duplicates in one grouped pass (no count-distinct expand)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.sum("_n").cast("long").alias("n_rows"),
                 F.count(F.lit(1)).cast("long").alias("n_distinct"),
                 F.sum(F.col("_n") - 1).cast("long").alias("n_duplicates"))


def parse_date(df: DataFrame, col: str, out: str = "date_value") -> DataFrame:
    """Text -> DATE; unparsable text gives null (ANSI-safe ``try_to_date``)."""
    return df.withColumn(out, F.try_to_date(F.col(col), "yyyy-MM-dd"))


def quality_report(df: DataFrame) -> DataFrame:
    """Per column rows / nulls / NaN in ONE aggregate, returned in long form."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for f in df.schema.fields:
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"n__{f.name}"))
        if isinstance(f.dataType, _NUMERIC):
            aggs.append(F.count_if(F.isnan(f.name)).alias(f"x__{f.name}"))
        else:
            aggs.append(F.lit(0).cast("long").alias(f"x__{f.name}"))
    wide = df.agg(*aggs)
    n = len(df.columns)
    stack = ", ".join(f"'{c}', `n__{c}`, `x__{c}`" for c in df.columns)
    return wide.selectExpr(f"stack({n}, {stack}) as (col_name, n_null, n_nan)", "_rows") \
        .select("col_name", F.col("_rows").cast("long").alias("n_rows"),
                F.lit(n).cast("long").alias("n_cols"),
                F.col("n_null").cast("long").alias("n_null"), F.col("n_nan").cast("long").alias("n_nan"))


def schema_profile(df: DataFrame) -> DataFrame:
    """(column, type, non-null count) from the schema plus one aggregate."""
    wide = df.agg(*[F.count(F.col(c)).alias(f"nn__{c}") for c in df.columns])
    stack = ", ".join(f"{i}, '{c}', '{t}', `nn__{c}`" for i, (c, t) in enumerate(df.dtypes))
    return wide.selectExpr(f"stack({len(df.columns)}, {stack}) as (position, col_name, data_type, non_null)") \
        .select(F.col("position").cast("int").alias("position"), "col_name", "data_type",
                F.col("non_null").cast("long").alias("non_null"))
