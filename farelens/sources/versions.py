"""Partitioned tables with versions: new partition folders are written beside the old ones, one rename commits them.

A table holds data folders ``version=<id>/<column>=<value>`` and numbered manifests in ``_manifests``; a manifest names
the version of every partition, or several, comma-joined, where rows were added. A write adds one version with the
partitions it replaces or adds to, then a manifest. Until that one file has its name, readers see the table as it was; from then on, as it is now, in all partitions at once. A write
that is cut short anywhere leaves files that no manifest names; it can simply be run again. Of two writers that start
from the same manifest, the second one fails.

A manifest has one line for each partition; this is all that the driver holds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from farelens.session import empty_frame

MANIFESTS = "_manifests"
#: The folder of rows without a partition value, and the characters written as %XX in folder names, besides
#: control characters.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = "\"#%'*/:=?\\{[]^\x7f"


class ConcurrentWriteError(Exception):
    """Another writer has committed since this one read the table."""


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the constructor of its paths."""
    folder = spark._jvm.org.apache.hadoop.fs.Path
    return folder(path).getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, folder = file_system(spark, path)
    if not fs.exists(folder(path)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder(path)))


def _manifest_names(spark: SparkSession, path: str) -> list[str]:
    return [n for n in _children(spark, f"{path}/{MANIFESTS}") if n.endswith(".json")]


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(_manifest_names(spark, path))


def read_manifest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number and content of the newest manifest: version by partition folder; (0, {}) without any."""
    names = _manifest_names(spark, path)
    if not names:
        return 0, {}
    return int(names[-1].split(".")[0]), _content(spark, path, names[-1])


def read_notes(spark: SparkSession, path: str) -> dict[str, str]:
    """What writers noted with each partition folder of the newest manifest."""
    names = _manifest_names(spark, path)
    return {r["folder"]: r["note"] for r in _lines(spark, path, names[-1]) if r["note"]} if names else {}


def _lines(spark: SparkSession, path: str, name: str):
    return spark.read.schema("folder string, version string, note string").json(f"{path}/{MANIFESTS}/{name}").collect()


def _content(spark: SparkSession, path: str, name: str) -> dict[str, str]:
    return {r["folder"]: r["version"] for r in _lines(spark, path, name)}


def folder_name(column: str, value: object) -> str:
    """The partition folder of a value."""
    text = NO_VALUE if value is None or value == "" else str(value)
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 else c for c in text)


def read_versions(spark: SparkSession, path: str, schema: StructType, folders: Iterable[str] | None = None) -> DataFrame:
    """The table, or some of its partition folders, as the newest manifest has them; an absent table is empty."""
    _, manifest = read_manifest(spark, path)
    chosen = manifest if folders is None else {f: manifest[f] for f in folders if f in manifest}
    return read_folders(spark, path, schema, chosen)


def read_folders(spark: SparkSession, path: str, schema: StructType, chosen: dict[str, str]) -> DataFrame:
    """Rows of partition folders in the versions given, also of those that no manifest names yet."""
    if not chosen:
        return empty_frame(spark, schema)
    paths = [f"{path}/version={version}/{folder}" for folder, versions in sorted(chosen.items()) for version in versions.split(",")]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*schema.fieldNames())


def write_version(df: DataFrame, path: str, column: str, rebalance: bool = True) -> tuple[str, list[str]]:
    """Write ``df`` as a new version that no manifest names yet; its id and its partition folders.

    Rows are rebalanced by the partition column, so that not every task writes a file into every folder; AQE splits a
    large folder over many tasks again.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    target = f"{path}/version={version}"
    (df.hint("rebalance", column) if rebalance else df).write.partitionBy(column).parquet(target)
    return version, [n for n in _children(spark, target) if n.startswith(f"{column}=")]


def _write_text(fs, file, text: str) -> None:
    out = fs.create(file)
    out.write(bytearray(text, "utf-8"))
    out.close()


def commit(spark: SparkSession, path: str, number: int, manifest: dict[str, str], notes: dict[str, str] | None = None) -> None:
    """Make ``manifest`` the table's state after manifest ``number``; fails if there is a newer one."""
    fs, folder = file_system(spark, path)
    pending = f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}"
    lines = [json.dumps({"folder": f, "version": v, "note": (notes or {}).get(f)}) for f, v in sorted(manifest.items())]
    _write_text(fs, folder(pending), "".join(line + "\n" for line in lines))
    final = folder(f"{path}/{MANIFESTS}/{number + 1:012d}.json")
    if fs.exists(final) or not fs.rename(folder(pending), final):
        fs.delete(folder(pending), False)
        raise ConcurrentWriteError(f"{path} has been changed since manifest {number}")


def replace_folders(
    df: DataFrame,
    path: str,
    column: str,
    replaced: Iterable[str] | None = None,
    rebalance: bool = True,
    notes: dict[str, str] | None = None,
    added: Iterable[str] = (),
) -> None:
    """Replace partition folders by the rows of ``df``, which may read the table, in one commit.

    ``replaced`` names the folders that ``df`` stands for; those it has no rows of are then gone, and others must not
    occur in it. Without it, the folders that occur in ``df`` are replaced. Folders that are ``added`` to keep the rows
    they have.
    """
    spark = df.sparkSession
    number, manifest = read_manifest(spark, path)
    version, written = write_version(df, path, column, rebalance)
    if replaced is not None and not set(written) <= set(replaced):
        raise ValueError(f"rows of other partitions than those to be replaced: {sorted(set(written) - set(replaced))[:3]}")
    kept = {f: v for f, v in manifest.items() if f not in set(replaced or ()) or f in set(added)}
    new = {f: f"{kept[f]},{version}" if f in set(added) and f in kept else version for f in written}
    # Notes of other folders stay as they are.
    commit(spark, path, number, kept | new, (read_notes(spark, path) if notes else {}) | (notes or {}))


def remove_unreferenced(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete versions that none of the ``keep`` newest manifests names, and the older manifests; the number deleted.

    Not while another writer is at work: its version has no manifest yet.
    """
    names = _manifest_names(spark, path)
    named = {v for name in names[-keep:] for versions in _content(spark, path, name).values() for v in versions.split(",")}
    fs, folder = file_system(spark, path)
    gone = [n for n in _children(spark, path) if n.startswith("version=") and n.removeprefix("version=") not in named]
    for name in names[:-keep]:
        fs.delete(folder(f"{path}/{MANIFESTS}/{name}"), False)
    for name in gone:
        fs.delete(folder(f"{path}/{name}"), True)
    return len(gone)
