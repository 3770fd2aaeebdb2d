"""Feature operators: scaling, assembling, splits."""

from __future__ import annotations

from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def assemble(cols, out: str, handle_invalid: str = "error") -> VectorAssembler:
    """Numeric columns (or vectors) -> one vector; nulls raise by default."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=handle_invalid)


def minmax_scaler(col: str, out: str) -> MinMaxScaler:
    """Spark ML min-max to [0, 1]; a constant column maps to 0.5, no clipping."""
    return MinMaxScaler(inputCol=col, outputCol=out)


def minmax_scale_columns(df: DataFrame, cols, out_prefix: str = "mm_") -> DataFrame:
    """G2 as a fitted ML stage, unpacked to one column per input."""
    vec = assemble(cols, "_raw").transform(df)
    model = minmax_scaler("_raw", "_scaled").fit(vec)
    scaled = model.transform(vec).withColumn("_arr", vector_to_array("_scaled"))
    return scaled.select(*df.columns, *[F.col("_arr")[i].alias(f"{out_prefix}{c}") for i, c in enumerate(cols)])


def standard_scale(df: DataFrame, cols, out_prefix: str = "z_") -> DataFrame:
    """(x - mean) / population std over the whole frame; std 0 -> x - mean.

    The statistics are one aggregate row (a bounded summary, like a fitted scaler's model),
    brought to the driver once and applied as literals — no join, no shuffle of the rows."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    out = df
    for c in cols:
        m, s = row[f"m_{c}"], row[f"s_{c}"]
        scale = s if s not in (None, 0.0) else 1.0
        out = out.withColumn(f"{out_prefix}{c}", (F.col(c) - F.lit(m)) / F.lit(scale))
    return out


def group_minmax(df: DataFrame, cols, by: str, constant_value: float = 0.0) -> DataFrame:
    """Per-group min-max in place (notebook semantics: a constant column maps to 0).  For daily
    series: the window of a group holds a row per day."""
    w = Window.partitionBy(by)
    out = {}
    for c in cols:
        lo, hi = F.min(c).over(w), F.max(c).over(w)
        out[c] = F.when(hi == lo, F.col(c) - lo + F.lit(constant_value)).otherwise(F.try_divide(F.col(c) - lo, hi - lo))
    return df.withColumns(out)


def group_standardize(df: DataFrame, cols, by: str) -> DataFrame:
    """Per-group standard score in place, population std; std 0 -> x - mean.  For daily series."""
    w = Window.partitionBy(by)
    out = {}
    for c in cols:
        s = F.stddev_pop(c).over(w)
        out[c] = (F.col(c) - F.avg(c).over(w)) / F.when(s == 0, F.lit(1.0)).otherwise(s)
    return df.withColumns(out)


def hash_split(df: DataFrame, id_col: str = "doc_id", seed: int = 42, test_share_hex: str = "3333",
               out: str = "part") -> DataFrame:
    """Stable 80/20 split from the md5 of 'seed:id' (same rows under any partitioning;
    ``randomSplit`` is not).  '3333' of 'ffff' is 20 %."""
    h = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), 1, 4)
    return df.withColumn(out, F.when(h < F.lit(test_share_hex), F.lit("test")).otherwise(F.lit("train")))


def fold_column(df: DataFrame, id_col: str = "doc_id", k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Stable fold numbers for cross-validation."""
    return df.withColumn(out, F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(k)).cast("int"))
