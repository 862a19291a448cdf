"""Readers that never infer a schema, and that keep where a row came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAR_SCHEMA = "ticker string, volume double, open double, close double, high double, low double, window_start bigint, transactions bigint"


class HeaderError(ValueError):
    """A delivered file's header isn't the expected one."""


def csv_bars(spark: SparkSession, paths: list[str] | str, schema: str = BAR_SCHEMA, null: str = "null", check: bool = True) -> DataFrame:
    """Gzip or plain CSV with a header; "" and `null` are null, a malformed value fails the read. Splits by file."""
    want = spark.createDataFrame([], schema).schema
    if check:
        headers = first_lines(spark, paths)
        bad = headers.where(F.col("header") != ",".join(f.name for f in want)).select("path").limit(3).collect()
        if bad:
            raise HeaderError(str([r["path"] for r in bad]))
    df = spark.read.schema(want).option("header", True).option("mode", "FAILFAST").option("nullValue", "").option("enforceSchema", True).csv(paths)
    return df.select(*[F.nullif(F.col(f.name), F.lit(null)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in want])


def first_lines(spark: SparkSession, paths) -> DataFrame:
    """(path, header) of each file: its line at offset 0, read without the rest of the file being kept."""

    def head(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "header": [header_of(bytes(c)) for c in pdf["content"]]})

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(head, "path string, header string")


def header_of(raw: bytes) -> str:
    import gzip
    import io

    stream = gzip.open(io.BytesIO(raw), "rt") if raw[:2] == b"\x1f\x8b" else io.StringIO(raw.decode())
    return stream.readline().rstrip("\r\n")


def parquet(spark: SparkSession, *paths: str, columns: list[str] | None = None, nanos_as_long: bool = False) -> DataFrame:
    """Explicit Parquet paths; columns pruned at the scan. Nanosecond timestamps come as longs if asked for.

    Spark has no reader option for that, and looks at the session's setting when the scan runs: it is set for the session.
    """
    if nanos_as_long:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(*paths)
    return df if columns is None else df.select(*columns)


def json_pages(spark: SparkSession, paths: list[str] | str, row_schema: str, envelope: str = "status string, request_id string") -> DataFrame:
    """Rows of JSON pages with a results list: the row's fields, source_path and row_ordinal (from 0)."""
    schema = f"results array<struct<{row_schema}>>, {envelope}"
    pages = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(paths).withColumn("source_path", F.col("_metadata.file_path"))
    return pages.select("source_path", F.posexplode("results").alias("row_ordinal", "_row")).select("source_path", "row_ordinal", "_row.*")


def verified_files(spark: SparkSession, paths: list[str] | str, expected: DataFrame) -> DataFrame:
    """(path, state) of delivered files against expected (path, sha256): matched, different, orphan or missing."""
    got = spark.read.format("binaryFile").load(paths).select("path", F.sha2("content", 256).alias("_sha"), F.col("length").alias("bytes"))
    both = got.join(expected.select("path", F.col("sha256").alias("_want")), "path", "full")
    state = F.when(F.col("_want").isNull(), "orphan").when(F.col("_sha").isNull(), "missing").when(F.col("_sha") == F.col("_want"), "matched").otherwise("different")
    return both.select("path", "bytes", state.alias("state"))


def pipe_text(spark: SparkSession, path: str, schema: str, footer: str = "File Creation Time") -> DataFrame:
    """Pipe-delimited text whose header line names the columns; empty fields are null.

    Header, footer and empty lines go; a line of another width than the schema's, or a value that isn't of its
    column's type, fails the read.
    """
    want = spark.createDataFrame([], schema).schema
    fields = F.split("value", r"\|", -1)
    aside = (F.col("value") == "|".join(f.name for f in want)) | F.col("value").startswith(footer) | (F.col("value") == "")
    width = F.assert_true(F.size(fields) == len(want), F.concat(F.lit(f"not {len(want)} fields: "), "value"))
    lines = spark.read.text(path).withColumn("value", F.regexp_replace("value", r"\r$", "")).where(F.when(aside, False).otherwise(width.isNull()))
    return lines.select(fields.alias("f")).select(*[F.nullif(F.col("f")[k], F.lit("")).cast(f.dataType).alias(f.name) for k, f in enumerate(want)])


def page_of(df: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """A page of a table in an explicit order."""
    return df.orderBy(*order).offset(offset).limit(limit)


def snapshot_pair(active: DataFrame, inactive: DataFrame) -> DataFrame:
    """Both listings of a session as one table, tagged with requested_active."""
    return active.withColumn("requested_active", F.lit(True)).unionByName(inactive.withColumn("requested_active", F.lit(False)))
