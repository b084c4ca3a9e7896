"""Atomic replacement of a table: versions in folders of their own, and a numbered manifest that names the current one.

``write_version`` writes the whole table to a new folder and only then creates the next manifest, an
act the file system does for one writer only.  Until then, and for ever if the write fails, readers get the version before.
The folder of an older version stays until ``remove_old_versions``, so a running reader is not disturbed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from loanflow.sources.files import DEFAULT_FORMAT, list_names, read_text, remove, touch_once

MANIFESTS = "_versions"
_DIGITS = 12


def _manifest(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}/{version:0{_DIGITS}d}"


def _folder_of(spark: SparkSession, path: str, version: int) -> str | None:
    """The folder a manifest names; None while its writer has not finished the line (such a version never was)."""
    text = read_text(spark, _manifest(path, version))
    return text.rstrip("\n") if text.endswith("\n") else None


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(version, folder) of every whole version that is still there, the current one last."""
    there = set(list_names(spark, path))
    found = [(int(n), _folder_of(spark, path, int(n))) for n in list_names(spark, f"{path.rstrip('/')}/{MANIFESTS}")]
    return sorted((n, f) for n, f in found if f in there)


def write_version(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> int:
    """Replace the table at ``path`` as a whole, schema included; returns the new version's number.

    Of two writers at the same time both succeed, and the later manifest is the table.
    """
    spark = df.sparkSession
    folder = f"data-{uuid.uuid4().hex}"
    df.write.format(fmt).mode("error").save(f"{path.rstrip('/')}/{folder}")
    version = max((int(n) for n in list_names(spark, f"{path.rstrip('/')}/{MANIFESTS}")), default=0) + 1
    while not touch_once(spark, _manifest(path, version), folder + "\n"):
        version += 1
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """The current version, or the one asked for."""
    known = dict(versions(spark, path))
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"{path} has no version" + ("" if version is None else f" {version}"))
    return spark.read.format(fmt).load(f"{path.rstrip('/')}/{known[max(known) if version is None else version]}")


def remove_old_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all but the last ``keep`` versions and every folder that no manifest names; returns the number of folders deleted.

    Folders of writers that are still at work have no manifest yet: run this while nobody writes.
    """
    stay = {folder for _, folder in versions(spark, path)[-max(1, keep):]}
    gone = [n for n in list_names(spark, path) if n.startswith("data-") and n not in stay]
    for name in gone:
        remove(spark, f"{path.rstrip('/')}/{name}")
    return len(gone)
