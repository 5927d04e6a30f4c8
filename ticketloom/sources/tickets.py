"""Ticket tables: CSV and parquet scans, sinks, and the view over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUMMARY = "Ticket Summary"
INTERACTION = "Interaction content"
TYPES = ("Type 1", "Type 2", "Type 3", "Type 4")

TICKET_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in (SUMMARY, INTERACTION, *TYPES)]
)

# CSV cells read as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_tickets_csv(
    spark: SparkSession, path: str, schema: T.StructType = TICKET_SCHEMA, na_tokens: tuple[str, ...] = NA_TOKENS
) -> DataFrame:
    """Scan quoted, multi-line CSV with a declared schema.

    A multi-line file cannot be split: convert a large drop once with
    :func:`csv_to_parquet` and read the parquet from then on.
    """
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )
    texts = {f.name for f in schema if isinstance(f.dataType, T.StringType)}
    return raw.select(*[
        F.when(F.col(f"`{c}`").isin(*na_tokens), None).otherwise(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`")
        for c in raw.columns
    ])


def write_tickets_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').option("encoding", "UTF-8").csv(path)


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, partitions: int | None = None) -> DataFrame:
    """One-off conversion; the parquet is splittable and carries statistics."""
    df = read_tickets_csv(spark, csv_path)
    (df if partitions is None else df.repartition(partitions)).write.mode("overwrite").parquet(parquet_path)
    return spark.read.schema(TICKET_SCHEMA).parquet(parquet_path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tickets_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and labels in the shape of the ticket CSV, whole texts in both columns."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lead = (
        F.when(F.col("lang") == "en", "RE: ").when(F.col("lang") == "de", "FW : [x] ")
        .when(F.col("lang") == "fr", "").otherwise("null ")
    )
    greeting = F.lit("Dear customer, thank you for contacting us. 12 March 10:30 ")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("id"),
        F.concat(lead, F.col("text")).alias(SUMMARY),
        F.when(F.col("source") == "src3", None)
        .when(F.col("source").isin("src1", "src5", "src9"), F.concat(greeting, F.col("text")))
        .otherwise(F.col("text")).alias(INTERACTION),
        F.col("lang").alias("Type 1"),
        F.when(F.col("quality").isNull(), None).when(F.col("source") == "src7", "")
        .otherwise(F.concat(F.lit("q"), F.col("quality").cast("string"))).alias("Type 2"),
        F.col("source").alias("Type 3"),
        F.concat(F.lit("t"), F.col("toxic").cast("string")).alias("Type 4"),
    )
