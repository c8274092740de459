"""S4, atomic replacement of a lake table by versions.

A version is a folder that is never changed once written. What makes it the table is
its manifest, ``_versions/<number>.json``, written last: to a temporary name, then renamed
to a name that must not exist yet. Readers take the newest manifest that is whole.

A writer that dies at any point before the rename leaves the table as it was, and
folders without a manifest, which ``drop_old_versions`` removes after a grace period. Of two writers that
finish together one gets the next number. No step moves or overwrites data, so
this holds on stores where folders can't be renamed at once.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from custlens.sources.files import _fs_and_path, delete_path

MANIFESTS = "_versions"


class NoVersion(FileNotFoundError):
    pass


class VersionTaken(RuntimeError):
    pass


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs_and_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, at = _fs_and_path(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, at = _fs_and_path(spark, path)
    stream = fs.create(at, False)
    stream.write(bytearray(text.encode()))
    stream.close()


def _claim(spark: SparkSession, temporary: str, path: str) -> bool:
    """Rename the manifest to its number; False if another writer has that number."""
    fs, target = _fs_and_path(spark, path)
    _, source = _fs_and_path(spark, temporary)
    return not fs.exists(target) and bool(fs.rename(source, target))


def versions(spark: SparkSession, path: str) -> dict[int, dict]:
    """The manifests of all whole versions by number."""
    found = {}
    for name in _names(spark, f"{path}/{MANIFESTS}"):
        number, _, kind = name.partition(".")
        if kind == "json" and number.isdigit():
            try:
                found[int(number)] = json.loads(_read_text(spark, f"{path}/{MANIFESTS}/{name}"))
            except ValueError:
                continue
    return found


def publish_version(
    df: DataFrame, path: str, fmt: str = "parquet", note: dict | None = None, after: int | None = None
) -> int:
    """Write ``df`` as the table's next version and return its number.

    ``note`` is kept in the manifest. With ``after`` the version is published only if
    that one (0: none) is still the newest, else ``VersionTaken`` is raised.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"data-{uuid.uuid4().hex}"
    df.write.format(fmt).mode("errorifexists").save(f"{path}/{folder}")
    manifest = {"folder": folder, "format": fmt, "schema": json.loads(df.schema.json()), "written": time.time(), "note": note}
    temporary = f"{path}/{MANIFESTS}/.{folder}.tmp"
    _write_text(spark, temporary, json.dumps(manifest))
    while True:
        newest = max(versions(spark, path), default=0)
        if after is not None and newest != after:
            raise VersionTaken(f"{path} is at version {newest}, not {after}")
        number = newest + 1
        while f"{number}.json" in _names(spark, f"{path}/{MANIFESTS}"):  # a broken one keeps its number
            number += 1
        if _claim(spark, temporary, f"{path}/{MANIFESTS}/{number}.json"):
            return number


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest whole version of the table, or the one of that number."""
    from pyspark.sql.types import StructType

    path = path.rstrip("/")
    found = versions(spark, path)
    number = max(found, default=None) if number is None else number
    if number not in found:
        raise NoVersion(f"{path} has no version {number or ''}".rstrip())
    m = found[number]
    return spark.read.format(m["format"]).schema(StructType.fromJson(m["schema"])).load(f"{path}/{m['folder']}")


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2, grace_seconds: float = 86_400) -> list[str]:
    """Delete all but the newest ``keep`` versions, manifest first, and folders without a
    manifest that nobody wrote to for ``grace_seconds``. Returns the deleted folders."""
    if keep < 1:
        raise ValueError("keep at least one version")
    path = path.rstrip("/")
    found = versions(spark, path)
    old = sorted(found)[:-keep]
    for number in old:
        delete_path(spark, f"{path}/{MANIFESTS}/{number}.json")
    known = {m["folder"] for n, m in found.items() if n not in old}
    gone = [found[n]["folder"] for n in old]
    fs, at = _fs_and_path(spark, path)
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        idle = time.time() - status.getModificationTime() / 1000
        if name.startswith("data-") and name not in known and name not in gone and idle >= grace_seconds:
            gone.append(name)
    for folder in gone:
        delete_path(spark, f"{path}/{folder}")
    return gone
