"""Deterministic views over the given tables (FIXTURES.md V1..V5).

Each view is a pure DataFrame plan over the parquet tables, so its work grows
with them; the SQL oracle builds the same views in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


# Row key of each table: used to spread an under-split scan.
KEYS = {"documents": "doc_id", "labels": "doc_id", "pages": "page_id", "events": "event_id",
        "embeddings": "vec_id", "conversations": "conv_id", "benchmark": "item_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from reviewlens.sources.readers import spread
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), KEYS.get(name))


def shared_value(key: str, id_col="doc_id") -> Column:
    """Pseudo-random value in [0,1) from md5('K:'||id) (first 24 bits)."""
    h = F.md5(F.concat(F.lit(f"{key}:"), F.col(id_col).cast("string")))
    return F.conv(F.substring(h, 1, 6), 16, 10).cast("bigint") / F.lit(16777216.0)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: raw reviews with null / blank texts and dirty ratings."""
    d = table(spark, sf_dir, "documents")
    m8 = F.col("doc_id") % 8
    return d.select(
        "doc_id",
        F.when(F.col("doc_id") % 23 == 0, F.lit(None).cast("string"))
         .when(F.col("doc_id") % 29 == 0, F.lit("   "))
         .otherwise(F.col("text")).alias("review_text"),
        F.when(m8 == 0, F.lit(None).cast("double"))
         .when(m8 == 6, F.lit(4.5))
         .when(m8 == 7, F.lit(0.0))
         .otherwise(m8.cast("double")).alias("rating"),
        "lang", "source")


def labelled(spark: SparkSession, sf_dir: str, with_lang: bool = False) -> DataFrame:
    """V2: documents joined to labels; y = 0 toxic, 1 low quality, 2 otherwise."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    y = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2).cast("int")
    cols = [F.col("doc_id"), F.col("text"), y.alias("y")] + ([F.col("lang")] if with_lang else [])
    return d.join(lab, "doc_id").select(*cols)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: predictions with known structure over V2."""
    v = labelled(spark, sf_dir, with_lang=True)
    raw = [shared_value(k) + F.when(F.col("y") == i, 0.5).otherwise(0.0) for i, k in enumerate("abc")]
    v = v.select("doc_id", F.col("y").alias("y_true"), "text", "lang",
                 *[r.alias(f"r{i}") for i, r in enumerate(raw)])
    tot = F.col("r0") + F.col("r1") + F.col("r2")
    v = v.select("doc_id", "y_true", "text", "lang", *[(F.col(f"r{i}") / tot).alias(f"p{i}") for i in range(3)])
    pred = (F.when((F.col("p0") >= F.col("p1")) & (F.col("p0") >= F.col("p2")), 0)
            .when(F.col("p1") >= F.col("p2"), 1).otherwise(2)).cast("int")
    return v.select("doc_id", "y_true", pred.alias("y_pred"), "p0", "p1", "p2", "text", "lang")


def scored_reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: events; prediction = mean value of the event type.

    Per-type means are a group-by (partial aggregation map-side) joined back
    on the type; no window over a type, since one type may hold a third of rows.
    """
    e = table(spark, sf_dir, "events")
    means = e.groupBy("event_type").agg(F.avg("value").alias("y_pred"))
    return e.join(means, "event_type").select("event_id", F.col("value").alias("y_true"), "y_pred")
