"""Written intermediate tables, and text batches as numpy arrays inside tasks."""

from __future__ import annotations

from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.ordered import attach
from gridloom.session import scratch_path

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
CHUNK_BYTES = 1 << 20

_LETTER = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64)]


#: Spark's setting that removes the shuffle files of a query when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends there, executors may go.

    Shuffle files of the write go when it has ended; the table stays until ``released``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def released(*tables: DataFrame) -> None:
    """Remove the folders of ``written`` tables that nothing to come reads."""
    for table in tables:
        context = table.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(table))
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def own_names(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, renamed: extra columns of any name cannot clash."""
    return df.select(*[df[f"`{old}`"].alias(new) for old, new in columns.items()])


def told_apart(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc, text) in which a key names one text, and (doc, own, print) of the keys that did not.

    Rows whose key also stands with another text, and rows without key, get a hash of key and text as ``doc``;
    ``own`` is their key and ``print`` the hash of their text. Where there are none, which one pass over keys
    and text hashes tells, nothing changes and the second table is None. Equal rows stay equal.
    """
    seen = F.xxhash64(F.coalesce("text", F.lit("")))
    kinds = texts.groupBy("doc").agg(F.min(seen).alias("low"), F.max(seen).alias("high"))
    several = written(kinds.where("low <> high OR doc IS NULL").select("doc"), "several-texts")
    if several.isEmpty():
        released(several)
        return texts, None
    marked = attach(texts, several.withColumn("__several", F.lit(True)), ["doc"], "left", null_safe=True)
    hashed = F.xxhash64(F.lit("row"), F.coalesce("doc", F.lit(0)), F.col("doc").isNull(), F.coalesce("text", F.lit("")))
    renamed = written(
        marked.where("__several").select(hashed.alias("doc"), F.col("doc").alias("own"), seen.alias("print")).distinct(), "renamed"
    )
    return marked.select(F.when(F.col("__several"), hashed).otherwise(F.col("doc")).alias("doc"), "text"), renamed


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base, modulo 2^64."""
    if len(_POWERS[0]) < n:
        steps = np.full(n + n // 2, _STEP, np.uint64)
        steps[0] = 1
        _POWERS[0] = np.multiply.accumulate(steps)
    return _POWERS[0][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(column: pa.Array):
    """(first row, offsets, bytes) of about ``CHUNK_BYTES`` each; a null counts as empty."""
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    if not len(column):
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        own = offsets[row : stop + 1]
        yield row, own - own[0], data[own[0] : own[-1]]
        row = stop


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a chunk, A-Z lower-cased: hashes, places, words per row."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, lower: bool = True):
        inside = ~SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.stop = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.bounds = np.searchsorted(self.start, offsets)
        if len(self.start):
            letters = _LETTER[LOWER[data] if lower else data]
            letters[~inside] = 0
            first = np.zeros(len(data), np.int64)
            first[self.start] = np.diff(self.start, prepend=0)
            place = np.arange(len(data)) - np.cumsum(first)
            place[~inside] = 0
            table = powers(int((self.stop - self.start).max()) + 1)
            letters *= table[place]
            self.hash = mixed(np.add.reduceat(letters, self.start))
        else:
            self.hash = np.zeros(0, np.uint64)

    def shingles(self, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each word on (also across rows: the caller cuts)."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.zeros(n, np.uint64)
        for j, p in enumerate(powers(k + 1)[1:]):
            out += self.hash[j : n + j] * p
        return mixed(out)
