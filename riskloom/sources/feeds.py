"""Readers of the exploited-vulnerability and score feeds, batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions import fixed


def read_kev(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One JSON document per file (or per line), one row per entry of `vulnerabilities`."""
    doc = spark.read.schema(f"vulnerabilities array<struct<{fixed.KEV_ITEM_SCHEMA.replace(' string', ':string')}>>")
    return doc.option("multiLine", multi_line).json(path).select(F.inline("vulnerabilities"))


def kev_rows(items: DataFrame) -> DataFrame:
    """Table shape of the feed: `cveId` first, all text, and the day of `dateAdded`."""
    day = F.to_date(F.try_to_timestamp("dateAdded")).alias("day")
    return items.withColumnRenamed("cveID", "cveId").select(
        "cveId", *[c for c in fixed.KEV_FIELDS if c != "cveID"], day
    )


def epss_rows(raw: DataFrame, date: Column) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rows that cannot be read)."""
    typed = raw.select(
        F.col("cve").alias("cveId"),
        F.expr("try_cast(epss AS DOUBLE)").alias("epss"),
        F.expr("try_cast(percentile AS DOUBLE)").alias("percentile"),
        date.alias("date"),
    )
    good = "cveId IS NOT NULL AND epss IS NOT NULL AND percentile IS NOT NULL"
    return typed.where(good), typed.where(f"NOT ({good})")


def read_epss(spark: SparkSession, path: str, date: Column) -> tuple[DataFrame, DataFrame]:
    """Score file: `#` lines and the header skipped; (typed rows, unreadable rows)."""
    raw = (
        spark.read.schema(fixed.EPSS_RAW_SCHEMA).option("comment", "#").option("header", True).csv(path)
    )
    return epss_rows(raw, date)


def kafka_stream(spark: SparkSession, servers: str, topic: str, schema: str) -> DataFrame:
    """JSON events of a topic from its earliest offset (needs the Kafka connector jar)."""
    events = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
    return json_events(events.select(F.col("value").cast("string").alias("value")), schema)


def json_events(values: DataFrame, schema: str) -> DataFrame:
    """Typed events from a text column `value`."""
    return values.select(F.from_json("value", schema).alias("e")).select("e.*")


def file_stream(spark: SparkSession, path: str, schema: str, per_trigger: int = 1000) -> DataFrame:
    """JSON-lines files as a stream, oldest first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(path)
