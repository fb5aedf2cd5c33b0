"""Tables kept as folders of Parquet in versions, with one small file that names the current one.

Rows lie in partitions by the first hex characters of the md5 of their key. A new version writes the
partitions it touches to a folder of its own and then a version file that maps every partition to the
folder that holds it. The version file appears by a rename, so a reader sees the old version or the new one,
and a job that dies before leaves only a folder that no version names. Of two writers that started from the
same version the second one fails.

    <path>/versions/<number>.json      key, prefix length, schema, partition -> folder
    <path>/data/<folder>/_prefix=<p>/  Parquet
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

PREFIX = "_prefix"
#: Rows per file at most.
FILE_ROWS = 1_000_000


class VersionConflict(RuntimeError):
    """Another job has written a version since this one was started."""


class Version(NamedTuple):
    path: str
    number: int
    key: str
    prefix_chars: int
    schema: StructType
    folders: dict[str, str]  # one entry per partition: at most 16 ** prefix_chars


def key_prefix(key: Column, chars: int) -> Column:
    """The partition of a key; rows without a key share one."""
    return F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, chars)


# --- files -----------------------------------------------------------------------------

def _file(spark: SparkSession, path: str):
    """The file system of a path, whatever store it is in, and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, at = _file(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _publish(spark: SparkSession, version: Version) -> None:
    """Write the version file under another name, then give it its own."""
    fs, final = _file(spark, f"{version.path}/versions/{version.number}.json")
    _, draft = _file(spark, f"{version.path}/versions/.{version.number}-{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(version._replace(schema=version.schema.jsonValue())._asdict()).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise VersionConflict(f"version {version.number} of {version.path} was written by another job")


# --- versions --------------------------------------------------------------------------

def version_numbers(spark: SparkSession, path: str) -> list[int]:
    names = _names(spark, f"{path}/versions")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def version_of(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """The given version, or the newest; None where there is none yet."""
    path = path.rstrip("/")
    if number is None:
        number = max(version_numbers(spark, path), default=None)
        if number is None:
            return None
    text = spark.read.text(f"{path}/versions/{number}.json", wholetext=True).first()
    if text is None:
        raise FileNotFoundError(f"{path} has no version {number}")
    read = json.loads(text.value)
    return Version(**{**read, "path": path, "schema": StructType.fromJson(read["schema"])})


def read_version(spark: SparkSession, version: Version, prefixes: Iterable[str] | None = None) -> DataFrame:
    """The rows of a version, or of some of its partitions only."""
    wanted = version.folders if prefixes is None else {p: version.folders[p] for p in prefixes if p in version.folders}
    if not wanted:
        return spark.createDataFrame([], version.schema)
    files = [f"{version.path}/data/{folder}/{PREFIX}={p}" for p, folder in sorted(wanted.items())]
    return spark.read.schema(version.schema).parquet(*files)


def _write(rows: DataFrame, base: Version, touched: Iterable[str] | None, kept_rows: DataFrame | None = None) -> Version:
    """Publish the version after ``base`` in which the ``touched`` partitions hold ``rows`` (and ``kept_rows``)."""
    spark, folder = rows.sparkSession, f"{base.number + 1}-{uuid.uuid4().hex[:8]}"
    target = f"{base.path}/data/{folder}"
    placed = lambda df: df.withColumn(PREFIX, key_prefix(F.col(base.key), base.prefix_chars))
    # Rows of a partition come together; adaptive execution gives a large one to several tasks.
    out = placed(rows).hint("rebalance", PREFIX)
    if kept_rows is not None:
        # These lie together already: a task reads files of few partitions and writes as many.
        out = placed(kept_rows.select(rows.columns)).unionByName(out)
    out.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(PREFIX).parquet(target)
    written = {n.removeprefix(f"{PREFIX}="): folder for n in _names(spark, target) if n.startswith(PREFIX)}
    kept = {} if touched is None else {p: f for p, f in base.folders.items() if p not in set(touched)}
    if clash := written.keys() & kept.keys():
        raise ValueError(f"rows of partitions that were not to be touched: {sorted(clash)[:5]}")
    after = base._replace(number=base.number + 1, folders={**kept, **written}, schema=rows.schema)
    _publish(spark, after)
    return after


def create_version(rows: DataFrame, path: str, *, key: str, prefix_chars: int = 2) -> Version:
    """The first version of a table that must not exist yet."""
    if version_numbers(rows.sparkSession, path):
        raise VersionConflict(f"{path} exists")
    return _write(rows, Version(path.rstrip("/"), 0, key, prefix_chars, rows.schema, {}), None)


def replace_partitions(
    rows: DataFrame, base: Version, touched: Iterable[str], *, kept: DataFrame | None = None
) -> Version:
    """A version with the ``touched`` partitions of ``base`` replaced by ``rows``; all others stay where they are.

    ``kept`` are rows that were read from these partitions and go back to them without a shuffle.
    """
    if rows.schema.simpleString() != base.schema.simpleString():
        raise ValueError(f"columns {rows.schema.simpleString()} are not those of {base.path}")
    return _write(rows, base, list(touched), kept)


def touched_prefixes(rows: DataFrame, base: Version) -> list[str]:
    """The partitions that ``rows`` (with the key column) fall into: at most 16 ** prefix_chars."""
    found = rows.select(key_prefix(F.col(base.key), base.prefix_chars).alias("p")).distinct()
    return sorted(r.p for r in found.collect())


def drop_versions(spark: SparkSession, path: str, *, keep: int = 2) -> list[str]:
    """Delete all versions but the newest ``keep``, and the folders that none of these names."""
    if keep < 1:
        raise ValueError("at least the current version is kept")
    path = path.rstrip("/")
    numbers = version_numbers(spark, path)
    named = {f for n in numbers[-keep:] for f in version_of(spark, path, n).folders.values()}
    newest = max(numbers, default=0)
    # Folders of a version that is being written have a higher number.
    gone = [f for f in _names(spark, f"{path}/data") if f not in named and int(f.split("-")[0]) <= newest]
    for n in numbers[:-keep]:
        fs, at = _file(spark, f"{path}/versions/{n}.json")
        fs.delete(at, False)
    for folder in gone:
        fs, at = _file(spark, f"{path}/data/{folder}")
        fs.delete(at, True)
    return gone
