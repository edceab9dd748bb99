"""Versioned folder of fitted tables: vocabulary, weights, scores, trees.

A version is a sub-folder with one Parquet table per name and a manifest, which is written last
and appears at once. Readers take the newest version with a manifest, so a fit that was cut off,
or is still being written, is never seen.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFEST = "manifest.json"
_VERSION = re.compile(r"v(\d{8,})-[0-9a-f]{32}")


@dataclass(frozen=True)
class Stored:
    """A complete version: its tables by name and what was noted about them."""

    path: str
    tables: dict[str, DataFrame]
    about: dict


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def versions(spark: SparkSession, folder: str, complete: bool = True) -> list[str]:
    """Names of the versions in a folder, oldest first; a folder that does not exist has none."""
    files, at = _files(spark, folder)
    if not files.exists(at):
        return []
    names = [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory()]
    found = [(int(m[1]), n) for n in names if (m := _VERSION.fullmatch(n))]
    return [n for _, n in sorted(found) if not complete or files.exists(_files(spark, f"{folder}/{n}/{MANIFEST}")[1])]


def save(spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], about: Mapping | None = None) -> str:
    """Write the tables as a new version and return its path; `about` is noted in the manifest.

    Of two fits that are written at the same time both stay, under names of their own.
    """
    if not tables or not all(re.fullmatch(r"[a-z][a-z0-9_]*", name) for name in tables):
        raise ValueError(f"tables need names of small letters, digits and _, got {sorted(tables)}")
    before = versions(spark, folder, complete=False)
    number = int(_VERSION.fullmatch(before[-1])[1]) + 1 if before else 1
    path = f"{folder}/v{number:08d}-{uuid.uuid4().hex}"
    noted = {}
    for name, rows in tables.items():
        rows.write.parquet(f"{path}/{name}")
        count = spark.read.schema(rows.schema).parquet(f"{path}/{name}").count()
        noted[name] = {"schema": rows.schema.jsonValue(), "rows": count}
    files, draft = _files(spark, f"{path}/_{MANIFEST}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps({"tables": noted, "about": dict(about or {})}).encode()))
    out.close()
    if not files.rename(draft, _files(spark, f"{path}/{MANIFEST}")[1]):
        raise OSError(f"no manifest could be written in {path}")
    return path


def load(spark: SparkSession, folder: str, version: str | None = None) -> Stored:
    """The named version, or the newest complete one."""
    known = versions(spark, folder)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no complete version {version or ''} in {folder}")
    path = f"{folder}/{version or known[-1]}"
    manifest = json.loads(spark.read.text(f"{path}/{MANIFEST}", wholetext=True).first()[0])
    tables = {
        name: spark.read.schema(StructType.fromJson(kept["schema"])).parquet(f"{path}/{name}")
        for name, kept in manifest["tables"].items()
    }
    return Stored(path, tables, manifest["about"] | {"rows": {n: k["rows"] for n, k in manifest["tables"].items()}})


def prune(spark: SparkSession, folder: str, keep: int = 2) -> list[str]:
    """Delete complete versions but the `keep` newest, at least one; returns the names of those deleted.

    Versions without a manifest stay, as they may still be being written.
    """
    gone = versions(spark, folder)[: -max(1, keep)]
    for name in gone:
        files, manifest = _files(spark, f"{folder}/{name}/{MANIFEST}")
        # Without its manifest a version is no longer offered to readers.
        files.delete(manifest, False)
        files.delete(_files(spark, f"{folder}/{name}")[1], True)
    return gone
