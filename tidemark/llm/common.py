"""What the text operators share: words, lineage cuts, bounded labelled samples, Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lineage import checkpoint_dir as checkpoint_dir
from ..lineage import cut as cut

#: Code points that separate words: space and the controls 9 to 13. bytes.split() splits on these.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8, in order; none for null."""
    return text.encode("utf-8", "replace").split() if text else []


def word_hashes(ws: list[bytes]) -> np.ndarray:
    """XXH64 of each word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, ws), np.uint64, len(ws))


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of each 64-bit value (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Spans:
    """Hashes of any run of words in constant time, from one pass of prefix sums modulo 2**64."""

    BASE = np.uint64(0x9E3779B97F4A7C15)
    INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

    def __init__(self, h: np.ndarray):
        n = len(h)
        down = np.full(n + 1, self.INVERSE, np.uint64)
        up = np.full(n + 1, self.BASE, np.uint64)
        down[0] = up[0] = 1
        self.up = np.cumprod(up)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * np.cumprod(down)[:n])])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return mix64((self.sums[start + length] - self.sums[start]) * self.up[start] + np.uint64(1) * np.asarray(length).astype(np.uint64))


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of df has, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, folds: int):
    """crc32 of the id's text modulo the number of folds."""
    return F.pmod(F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")), F.lit(folds))


#: Bytes of text that a sample brings to the driver.
SAMPLE_BYTES = 64_000_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_bytes: int = SAMPLE_BYTES, keep=None) -> DataFrame:
    """(doc_id, text, label) of at most max_rows labelled rows and max_bytes bytes of whole texts.

    Labelled documents are taken in the order of a keyed hash of the id until either bound is met, so every label
    and length has the same chance; the bounds are on what is learned from, never on what is scored. Of several
    texts of one doc_id the one with the least digest counts, of several labels the greater. Labels without a
    document and null texts take no place. Ids and sizes alone are shuffled; the sample's ids are broadcast.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    if keep is not None:
        rows = rows.where(keep)
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = docs.where("text is not null").select("doc_id", F.struct(F.xxhash64("text").alias("digest"), F.octet_length("text").alias("size")).alias("one"))
    found = sizes.join(rows, "doc_id").groupBy("doc_id").agg(F.min("one").alias("one"), F.max("label").alias("label"))
    taken, left = [], max_bytes
    for r in found.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(max_rows).collect():
        left -= r["one"]["size"]
        if left < 0:
            break
        taken.append((r["doc_id"], r["one"]["digest"], r["label"]))
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.sparkSession.createDataFrame(taken, f"doc_id {kind}, digest long, label int")
    texts = docs.select("doc_id", "text").withColumn("digest", F.xxhash64("text")).join(F.broadcast(ids), ["doc_id", "digest"])
    return texts.select("doc_id", "text", "label").dropDuplicates(["doc_id"])


def collect_sample(sample: DataFrame) -> tuple[list[str], np.ndarray]:
    """Texts and labels in a fixed order; empty lists if there is nothing to learn from."""
    t = sample.select("doc_id", "text", "label").toArrow().sort_by("doc_id")
    return t["text"].to_pylist(), np.asarray(t["label"].to_pylist(), np.int8)


def per_batch(df: DataFrame, columns: list[str], schema: str, fn: Callable[..., dict]) -> DataFrame:
    """Maps Arrow batches: fn gets one Python list for each column and returns a dict of columns."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = fn(*(part.column(i).to_pylist() for i in range(len(columns))))
                yield pa.RecordBatch.from_arrays([pa.array(out[n]) if not isinstance(out[n], pa.Array) else out[n] for n in names], names)

    return df.select(*columns).mapInArrow(typed(run, schema), schema)


def slices(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that the decoded part stays small however long the texts are."""
    rows = max(1, int(batch.num_rows * most / max(1, batch.nbytes)))
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


#: Spark names of the types that the operators return, as Arrow types.
ARROW = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


def typed(run, schema: str):
    """Casts what run yields to the declared types."""
    fields = [part.split() for part in schema.split(",")]
    target = pa.schema([(n, ARROW[k]) for n, k in fields])

    def cast(batches):
        for out in run(batches):
            yield pa.RecordBatch.from_arrays([c if c.type == f.type else c.cast(f.type) for c, f in zip(out.columns, target, strict=True)], schema=target)

    return cast
