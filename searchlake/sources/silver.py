"""Silver documents (S3): parquet tables or the reference's JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SILVER_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("links", T.ArrayType(T.StringType())),
    T.StructField("termFrequencies", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("documentLength", T.IntegerType()),
    T.StructField("processedAt", T.TimestampType()),
    T.StructField("sourceBronzeId", T.StringType()),
])


def read_silver_json(spark: SparkSession, path: str) -> DataFrame:
    """Silver JSON with the explicit schema (inference would turn the term
    map into one struct field per term); multi-line for pretty files."""
    return spark.read.schema(SILVER_SCHEMA).option("multiLine", True).json(path)


def write_silver(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def silver_postings(silver: DataFrame, key: str = "url") -> DataFrame:
    """Silver rows -> postings ``(<key>, doc_len, term, tf)``.

    Mixed-case terms are folded to lower case and their counts summed
    (shuffle by (doc, term) -- partial aggregation first)."""
    ex = silver.select(F.col(key), F.explode("termFrequencies").alias("term", "tf"))
    post = ex.groupBy(key, F.lower("term").alias("term")).agg(F.sum("tf").cast("int").alias("tf"))
    lens = post.groupBy(key).agg(F.sum("tf").cast("int").alias("doc_len"))
    return post.join(lens, key).select(key, "doc_len", "term", "tf")
