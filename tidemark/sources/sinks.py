"""Writers: immutable, partitioned, atomic over several tables, and skipped when nothing changed."""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contracts import TableContract


class ImmutableError(ValueError):
    """Something else is already written there."""


def content_digest(df: DataFrame) -> str:
    """A digest of a table's rows that doesn't depend on their order or files; repeated rows count.

    The count, and the sums of the four 64-bit words of each row's SHA-256.
    """
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}), 256)
    words = [F.sum(F.conv(F.substring("_h", 1 + 16 * k, 16), 16, 10).cast("decimal(38,0)")).alias(f"s{k}") for k in range(4)]
    got = df.select(row.alias("_h")).agg(F.count("*").alias("n"), *words).first()
    return "-".join([str(got["n"]), *(f"{int(got[f's{k}'] or 0):x}" for k in range(4))])


def place(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = place(spark, path)
    return fs.exists(p)


def write_immutable(df: DataFrame, path: str) -> str:
    """Writes once; a second write of equal rows is a no-op, of other rows an error. Returns the content digest.

    A folder that a writer left unfinished (without _SUCCESS) doesn't count and is written anew.
    """
    spark, digest = df.sparkSession, content_digest(df)
    if exists(spark, f"{path}/_SUCCESS"):
        if content_digest(spark.read.parquet(path)) != digest:
            raise ImmutableError(path)
        return digest
    df.write.option("compression", "zstd").mode("overwrite").parquet(path)
    return digest


def write_contract(df: DataFrame, contract: TableContract, path: str) -> None:
    """Checked, partitioned and sorted as the contract says; only the partitions that df has are replaced."""
    rows = contract.require(contract.project(df))
    keys = list(contract.partition_by)
    if keys:
        rows = rows.repartition(*keys)
    rows = rows.sortWithinPartitions(*keys, *contract.sort_by) if keys or contract.sort_by else rows
    writer = rows.write.option("compression", "zstd").option("partitionOverwriteMode", "dynamic").mode("overwrite")
    (writer.partitionBy(*keys) if keys else writer).parquet(path)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file beside its place and renames it there; an error if the place is taken by another text."""
    (p, fs), (part, _) = place(spark, path), place(spark, f"{path}.{uuid4().hex}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not (not fs.exists(p) and fs.rename(part, p)):
        fs.delete(part, False)
        if get_text(spark, path) != text:
            raise ImmutableError(path)


def get_text(spark: SparkSession, path: str) -> str | None:
    return "\n".join(r["value"] for r in spark.read.text(path).collect()) if exists(spark, path) else None


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions in a pointer folder."""
    p, fs = place(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n) for n in names if n.isdigit())


def point(spark: SparkSession, path: str, text: str) -> None:
    """Adds the next version to a pointer folder. No version is ever removed or changed, so readers see the old or the new one."""
    put_text(spark, f"{path}/{max(versions(spark, path), default=0) + 1:012d}", text)


def pointed(spark: SparkSession, path: str) -> str | None:
    """The text of the highest version in a pointer folder."""
    known = versions(spark, path)
    return get_text(spark, f"{path}/{known[-1]:012d}") if known else None


def publish(tables: dict[str, DataFrame], root: str, release: str) -> None:
    """Writes all tables under a release folder, then adds a version to the one pointer: all become visible together."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.option("compression", "zstd").mode("errorifexists").parquet(f"{root}/{release}/{name}")
    point(spark, f"{root}/CURRENT", json.dumps({"release": release, "tables": sorted(tables)}))


class GateError(ValueError):
    """Checks don't allow a release."""


def publish_checked(tables: dict[str, DataFrame], root: str, release: str, results: DataFrame, accepted: tuple[str, ...] = ()) -> None:
    """publish(), if no rule of results (rule, status) failed and every warning is named in accepted."""
    bad = [r["rule"] for r in results.where("status = 'failed'").select("rule").limit(20).collect()]
    open_ = [r["rule"] for r in results.where(F.col("status") == "warning").select("rule").limit(1000).collect() if r["rule"] not in accepted]
    if bad or open_:
        raise GateError(f"failed: {bad}, warnings: {open_}")
    publish(tables, root, release)


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the published release; an error before anything is published, or for a table outside of it."""
    text = pointed(spark, f"{root}/CURRENT")
    if text is None:
        raise LookupError("nothing is published")
    now = json.loads(text)
    if name not in now["tables"]:
        raise LookupError(f"{name} isn't part of {now['release']}")
    return spark.read.parquet(f"{root}/{now['release']}/{name}")


def reuse_or_build(spark: SparkSession, path: str, source_digest: str, build) -> DataFrame:
    """The table at path if it was built from the same source; built if there is none; an error if the source changed."""
    known = get_text(spark, f"{path}.manifest")
    if known is None:
        build().write.option("compression", "zstd").mode("errorifexists").parquet(path)
        put_text(spark, f"{path}.manifest", source_digest)
    elif known != source_digest:
        raise ImmutableError(f"{path}: its source changed")
    return spark.read.parquet(path)


def request_lines(df: DataFrame, ticker: str, path: str, day: str | None = None) -> None:
    """One ticker, or ticker,day, a line, in order; refuses control characters and separators. A request list is small."""
    bad = F.col(ticker).isNull() | F.col(ticker).rlike(r"[\p{Cntrl},]")
    if not df.where(bad).isEmpty():
        raise ValueError("a ticker holds a control character or a comma")
    line = F.col(ticker) if day is None else F.concat_ws(",", ticker, F.col(day).cast("string"))
    df.select(line.alias("value")).distinct().orderBy("value").coalesce(1).write.mode("errorifexists").text(path)
