"""Readers of ingest records and source documents."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions import fixed
from riskloom.functions.text import file_name_part
from riskloom.sources import paths
from riskloom.sources.sinks import balanced


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "ingestionTimestamp": F.try_to_timestamp("ingestionTimestamp", F.lit(fixed.INGEST_STAMP)),
            "ingestionDate": F.expr("try_to_date(ingestionDate, 'yyyy-MM-dd')"),
        }
    )


def read_ingest_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """Ingest records with data, one JSON line each; malformed lines become null rows and
    drop out with the filter."""
    lines = spark.read.schema(fixed.INGEST_SCHEMA).json(path)
    kept = lines.select("*", F.col("_metadata.file_path").alias("source_file")).where("cveDataAvailable")
    return _typed(kept).drop("cveDataAvailable")


def read_ingest_documents(spark: SparkSession, path_glob: str, multi_line: bool = False) -> DataFrame:
    """Many one-record JSON files (plain or .gz) in the ingest shape, permissive."""
    reader = spark.read.schema(fixed.INGEST_SCHEMA).option("mode", "PERMISSIVE")
    return reader.option("multiLine", multi_line).json(path_glob)


def latest_folder(spark: SparkSession, root: str, pattern: str = r"\d{4}-\d{2}-\d{2}") -> str:
    """Path of the newest dated folder below `root`."""
    import re

    dated = [n for n in paths.child_names(spark, root) if re.fullmatch(pattern, n)]
    if not dated:
        raise FileNotFoundError(f"no dated folder below {root}")
    return f"{root.rstrip('/')}/{max(dated)}"


def latest_table(spark: SparkSession, pattern: str, database: str | None = None) -> str:
    """Name of the newest table whose name matches (dates in names sort as text)."""
    tables = spark.sql("SHOW TABLES" + (f" IN {database}" if database else ""))
    name = tables.where(F.col("tableName").rlike(pattern)).agg(F.max("tableName")).first()[0]
    if name is None:
        raise LookupError(f"no table like {pattern}")
    return name


def read_cvelist(spark: SparkSession, root: str, schema: str = fixed.CNA_SCHEMA, multi_line: bool = True) -> DataFrame:
    """Record files in any depth below `root`, a document in each (or on each line); unreadable ones are
    skipped."""
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "CVE-*.json")
        .option("multiLine", multi_line)
        .option("mode", "DROPMALFORMED")
        .json(root)
    )


def metadata_from_filename(df: DataFrame, path: str = "source_file") -> DataFrame:
    """Vendor, product and ingestion time from the raw file name ('' or null when unreadable)."""
    stamp = F.try_to_timestamp(file_name_part(path, 3), F.lit(fixed.FILE_STAMP))
    return df.withColumns(
        {
            "vendor": file_name_part(path, 1),
            "product": file_name_part(path, 2),
            "ingestionTimestamp": stamp,
            "ingestionDate": F.to_date(stamp),
        }
    )


def unreadable_names(df: DataFrame) -> DataFrame:
    """Number of rows whose file name did not match."""
    bad = "vendor = '' OR product = '' OR ingestionTimestamp IS NULL"
    return df.agg(F.expr(f"count_if({bad})").alias("unreadable"))


#: Bytes that an archive of nothing has at most: header, name, comment and empty blocks.
EMPTY_ARCHIVE = 1 << 16


def gunzip_files(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Decompress all `*.gz` text files below `src` to `dst/file=<path below src without .gz>/`;
    returns one row (file, ok) for each. A file that can't be read at all is reported and the others go
    on; lines in front of a fault inside a file are kept. A sound archive without content is `ok` and has no
    folder; a file of no bytes at all is not an archive and not reported.

    Spark's text reader unpacks line by line, so a file of any size takes one task and little memory.
    """
    options = {"pathGlobFilter": "*.gz", "recursiveFileLookup": True, "ignoreCorruptFiles": True}
    root = F.lit(paths.qualified(spark, src).rstrip("/") + "/")

    def name(path: Column) -> Column:
        plain = F.regexp_replace(path, "^file:/+", "file:/")
        below = F.substring(plain, F.length(F.regexp_replace(root, "^file:/+", "file:/")) + 1, F.length(plain))
        return F.regexp_replace(below, r"\.gz$", "").alias("file")

    lines = spark.read.options(**options).text(src).select("value", name(F.col("_metadata.file_path")))
    balanced(lines, "file").write.mode("overwrite").partitionBy("file").text(dst)
    listed = spark.read.format("binaryFile").options(**options).load(src).select(name(F.col("path")))
    made = spark.createDataFrame([(unquote(n.removeprefix("file=")),) for n in paths.child_names(spark, dst) if n.startswith("file=")], "file string")
    silent = listed.join(made, "file", "left_anti").select("file")
    small = spark.read.format("binaryFile").options(**options).load(src).where(F.col("length") <= EMPTY_ARCHIVE)
    empty = small.select(name(F.col("path")), "content").join(silent, "file", "left_semi").mapInArrow(_sound, "file string, ok boolean")
    done = made.withColumn("ok", F.lit(True)).unionByName(empty)
    return listed.join(done, "file", "left").select("file", F.coalesce("ok", F.lit(False)).alias("ok"))


def _sound(batches):
    """(file, ok) of archives without lines: whether they unpack to nothing without a fault."""
    import gzip
    import zlib

    import pyarrow as pa

    def empty(content: bytes) -> bool:
        try:
            return bool(content) and gzip.decompress(content) == b""
        except (OSError, EOFError, zlib.error):
            return False

    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([empty(c.as_py()) for c in batch.column(1)], pa.bool_())], names=["file", "ok"])
