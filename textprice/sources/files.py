"""File sources and sinks.

Columns with blanks in the reference's files (``Stock Name``, ``Adj Close``) are mapped to
snake_case when read and restored when written.  Writes replace their target with
``mode("overwrite")`` (no shell deletes).  Paths are expected on shared storage (the
session's checkpoint folder or a table location), never a machine-local temp folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import REFERENCE_POST_SCHEMA, REFERENCE_TO_SNAKE, SNAKE_TO_REFERENCE

CSV_OPTIONS = {"header": "true", "escape": '"', "mode": "PERMISSIVE",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def to_reference_names(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(SNAKE_TO_REFERENCE.get(c, c)) for c in df.columns])


def to_snake_names(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(REFERENCE_TO_SNAKE.get(c, c)) for c in df.columns])


def write_csv(df: DataFrame, path: str, reference_names: bool = True) -> str:
    """A10: CSV with header; dates as text, arrays joined with a blank first."""
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            out = out.withColumn(f.name, F.array_join(F.col(f.name), " "))
        elif isinstance(f.dataType, T.DateType):
            out = out.withColumn(f.name, F.col(f.name).cast("string"))
    if reference_names:
        out = to_reference_names(out)
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def read_posts_csv(spark: SparkSession, path: str, with_id: bool = True, multi_line: bool = False) -> DataFrame:
    """A1: CSV with header and the declared joined-post schema; dates parsed once here.  Files are
    split over tasks unless ``multi_line`` says that quoted values hold line ends."""
    fields = ([T.StructField("_id", T.LongType(), True)] if with_id else []) + list(REFERENCE_POST_SCHEMA.fields)
    raw = spark.read.schema(T.StructType(fields)).options(**CSV_OPTIONS).csv(path, multiLine=multi_line)
    return to_snake_names(raw).withColumn("dt", F.try_to_date(F.col("dt"), "yyyy-MM-dd"))


def read_csv_inferred(spark: SparkSession, path: str, multi_line: bool = False, sampling: float = 1.0) -> DataFrame:
    """A2: CSV with inferred types, from one extra pass over a ``sampling`` share of the rows."""
    return to_snake_names(spark.read.options(**CSV_OPTIONS).csv(path, inferSchema=True, samplingRatio=sampling,
                                                                multiLine=multi_line))


def write_parquet(df: DataFrame, path: str, partition_by=()) -> str:
    """Parquet, replacing the target; optionally partitioned (e.g. by day for pruning)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A3: Parquet (column pruning, filter pushdown and partition pruning are built in)."""
    return spark.read.parquet(path)


def encode_json(df: DataFrame, drop=("doc_id",), out: str = "value") -> DataFrame:
    """One JSON object per record, id field removed; dates as text."""
    cols = [F.col(c).cast("string").alias(c) if isinstance(df.schema[c].dataType, T.DateType) else F.col(c)
            for c in df.columns if c not in drop]
    return df.select(*[c for c in df.columns if c in drop], F.to_json(F.struct(*cols)).alias(out))


def decode_json(df: DataFrame, schema: T.StructType, col: str = "value",
                corrupt: str | None = None) -> DataFrame:
    """JSON text -> typed columns with a DECLARED schema (never inferred per message).
    With ``corrupt`` the malformed text is kept in that column for a dead-letter sink."""
    if corrupt:
        schema = T.StructType(schema.fields + [T.StructField(corrupt, T.StringType(), True)])
        parsed = F.from_json(F.col(col).cast("string"), schema,
                             {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    else:
        parsed = F.from_json(F.col(col).cast("string"), schema)
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, parsed.alias("_m")).select(*keep, "_m.*")
