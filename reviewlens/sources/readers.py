"""Scans, format dispatch and stage sinks (S-01..S-08, P-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlens.operators.clean import canonicalize

# CSV options that round-trip quotes, embedded newlines and edge whitespace.
CSV_WRITE = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_READ = dict(CSV_WRITE, multiLine="true")


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread a scan that yields fewer tasks than the cluster has cores.

    A single gzip file or a one-row-group parquet file is one task; the text
    work after it is CPU-heavy, so hash-partition on the row key (reusable by
    later joins on that key).  Scans of a large table already have many
    splits and pass through untouched: no shuffle is added at scale.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # noqa: BLE001  (no RDD view, e.g. a Connect session): leave the scan as it is
        return df
    return df.repartition(target, key) if key and key in df.columns else df.repartition(target)


def _fmt_of(path: str) -> str | None:
    p = path.lower().rstrip("/")
    if p.endswith(".jsonl.gz") or p.endswith(".gz") or p.endswith(".jsonl"):
        return "jsonl"
    if p.endswith(".json"):
        return "json"
    if p.endswith(".csv"):
        return "csv"
    if p.endswith(".parquet"):
        return "parquet"
    return None


def _json_schema(spark: SparkSession, path: str, multi_line: bool, sampling: float) -> T.StructType:
    """Inferred schema without the corrupt-record column (extra keys pass through)."""
    s = spark.read.options(multiLine=str(multi_line).lower(), samplingRatio=str(sampling)).json(path).schema
    return T.StructType([f for f in s.fields if f.name != "_corrupt_record"])


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False,
              mode: str = "DROPMALFORMED", sampling: float = 1.0) -> DataFrame:
    """S-01 / S-02 / S-05: JSON lines (gzip by suffix) or JSON documents; blank and malformed lines dropped."""
    schema = schema or _json_schema(spark, path, multi_line, sampling)
    return spark.read.schema(schema).options(mode=mode, multiLine=str(multi_line).lower()).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S-03: CSV with header, quoted fields and embedded newlines."""
    r = spark.read.options(**CSV_READ)
    return (r.schema(schema) if schema else r.option("inferSchema", "true")).csv(path)


def read_reviews(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None,
                 text_column: str = "review_text", rating_column: str = "rating", key: str | None = None,
                 max_rows: int | None = None) -> DataFrame:
    """S-04 + P-01: dispatch on format (or suffix), canonicalise columns, spread the scan.

    Unknown suffix: JSON lines first, CSV when that yields no row.
    ``max_rows`` (S-06) is a plain ``limit``: Spark rows have no file order.
    """
    fmt = fmt or _fmt_of(path)
    if fmt == "jsonl":
        df = read_json(spark, path, schema)
    elif fmt == "json":
        df = read_json(spark, path, schema, multi_line=True)
    elif fmt == "csv":
        df = read_csv(spark, path, schema)
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        df = read_json(spark, path, schema) if _has_json_rows(spark, path) else read_csv(spark, path, schema)
    df = canonicalize(df, text_column, rating_column)
    if max_rows is not None:
        df = df.limit(max_rows)
    return spread(df, key)


def _has_json_rows(spark: SparkSession, path: str) -> bool:
    try:
        s = _json_schema(spark, path, False, 1.0)
    except Exception:  # noqa: BLE001
        return False
    if not s.fields:
        return False
    return not spark.read.schema(s).option("mode", "DROPMALFORMED").json(path).isEmpty()


def corrupt_count(spark: SparkSession, path: str) -> int:
    """PERMISSIVE companion of S-05: how many non-blank lines fail to parse as objects."""
    s = spark.read.json(path).schema
    if "_corrupt_record" not in s.fieldNames():
        return 0
    # Spark refuses a query that reads only the corrupt-record column of a raw file: parse once, cached.
    parsed = spark.read.schema(s).json(path).cache()
    try:
        return parsed.where(F.col("_corrupt_record").isNotNull()).count()
    finally:
        parsed.unpersist()


# S-07 / S-08 ---------------------------------------------------------------------------
def write_stage(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Stage sink: overwrite a Parquet (or CSV) stage folder."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.options(**CSV_WRITE).csv(path)
    else:
        w.parquet(path)


def read_stage(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    return read_csv(spark, path, schema) if fmt == "csv" else spark.read.parquet(path)
