"""Versioned table snapshots: ``path/version=N`` folders and a manifest.

A writer claims its number by creating a file that must not exist yet, so two writers never share
one. A version exists once its own folder of the manifest is there; a crash before that leaves an
unlisted folder and a spent number. Nothing that is listed is ever written again: retention takes a
version off the list by deleting its manifest folder, then deletes its rows.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = (
    "version int, name string, rows bigint, schema string, content_hash string, "
    "published timestamp"
)
#: A number taken by another writer is tried again with the next one, so often at most.
CLAIMS = 1000


def _manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def _opened(spark: SparkSession, path: str):
    """The file system of a path, and the path on it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    system, target = _opened(spark, path)
    return system.exists(target)


def _delete(spark: SparkSession, path: str) -> None:
    system, target = _opened(spark, path)
    system.delete(target, True)


def _create_new(spark: SparkSession, system, target) -> None:
    """Create a file that must not exist; Hadoop's local file system looks first and creates then, so Java does it there."""
    if system.getScheme() == "file":
        jvm = spark.sparkContext._jvm
        path = jvm.java.io.File(target.toUri().getPath()).toPath()
        jvm.java.nio.file.Files.createFile(path, spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
    else:
        system.create(target, False).close()


def claim_version(spark: SparkSession, path: str) -> int:
    """The next free number, taken by an exclusive create; numbers of dropped versions stay taken."""
    system, claims = _opened(spark, f"{path.rstrip('/')}/_claims")
    taken = [int(f.getPath().getName()) for f in system.listStatus(claims)] if system.exists(claims) else []
    first = max([*taken, latest_version(spark, path) or 0]) + 1
    system.mkdirs(claims)
    for version in range(first, first + CLAIMS):
        _, target = _opened(spark, f"{path.rstrip('/')}/_claims/{version}")
        try:
            _create_new(spark, system, target)
            return version
        except Py4JJavaError:
            if not system.exists(target):
                raise
    raise RuntimeError(f"no free version number from {first} on at {path}")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Published versions, one small row each."""
    if not exists(spark, _manifest_path(path)):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(_manifest_path(path))


def latest_version(spark: SparkSession, path: str) -> int | None:
    return manifest(spark, path).agg(F.max("version")).first()[0]


def content_hash(df: DataFrame) -> DataFrame:
    """(rows, content_hash): independent of row order and partitioning."""
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_hash), F.lit(0)).cast("string").alias("content_hash"),
    )


def publish(df: DataFrame, path: str, name: str) -> int:
    """Write the next version and list it. Returns the version number."""
    spark = df.sparkSession
    version = claim_version(spark, path)
    target = f"{path.rstrip('/')}/version={version}"
    df.write.parquet(target)
    facts = content_hash(spark.read.parquet(target))
    facts.select(
        F.lit(name).alias("name"),
        "rows",
        F.lit(df.schema.json()).alias("schema"),
        "content_hash",
        F.current_timestamp().alias("published"),
    ).write.json(f"{_manifest_path(path)}/version={version}")
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A listed version, the latest by default."""
    known = [r.version for r in manifest(spark, path).select("version").collect()]
    chosen = version if version is not None else max(known, default=None)
    if chosen is None or chosen not in known:
        raise ValueError(f"no published version {chosen} at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/version={chosen}")


def retain(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Drop all but the newest ``keep`` versions, each from the manifest first."""
    listed = manifest(spark, path).select("version").orderBy(F.desc("version")).collect()  # one row per version
    dropped = sorted(row.version for row in listed[max(keep, 0):])
    for version in dropped:
        _delete(spark, f"{_manifest_path(path)}/version={version}")
        _delete(spark, f"{path.rstrip('/')}/version={version}")
    return dropped
