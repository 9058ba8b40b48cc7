"""Versions of what a batch run leaves for live runs: tables, pipeline models and plain values under one root.

A version's tables and models are written to a folder of its own; its manifest, which names them, comes last and by a rename, so a version is whole or not there.
Manifests are numbered. Where a rename onto a file that exists fails, as on HDFS, two writers never share a number and the later one takes the next; elsewhere (local
folders, most object stores) there must be one writer at a time. Older versions stay readable.
What a broken run has left is never read."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Times that a writer looks for the next number before it gives up.
TRIES = 100


def file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system of a path, and the path for it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all whole versions, ascending; none if the root is not there."""
    fs, folder = file_system(spark, f"{root}/manifests")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit() and n.endswith(".json"))


def save(spark: SparkSession, root: str, tables: Mapping[str, DataFrame] | None = None, models: Mapping[str, PipelineModel] | None = None, values: Mapping[str, Any] | None = None) -> int:
    """Write a new version and return its number. values must be plain JSON; tables may have no rows."""
    place = f"{root}/data/{uuid.uuid4().hex}"
    manifest = {"tables": {}, "models": {}, "values": dict(values or {})}
    json.dumps(manifest["values"])  # fails before anything is written if values aren't plain
    for name, df in (tables or {}).items():
        df.write.parquet(f"{place}/tables/{name}")
        manifest["tables"][name] = {"path": f"{place}/tables/{name}", "schema": df.schema.json()}
    for name, model in (models or {}).items():
        model.write().save(f"{place}/models/{name}")
        manifest["models"][name] = f"{place}/models/{name}"
    return commit(spark, root, manifest)


def commit(spark: SparkSession, root: str, manifest: Mapping[str, Any]) -> int:
    fs, draft = file_system(spark, f"{root}/manifests/_{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    for _ in range(TRIES):
        number = max(versions(spark, root), default=0) + 1
        _, final = file_system(spark, f"{root}/manifests/{number}.json")
        if not fs.exists(final) and fs.rename(draft, final):
            return number
    raise RuntimeError(f"no free version under {root}")


class Artifacts:
    """A version as it was saved; keys that it lacks, as older versions do, give the default asked for."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        have = versions(spark, root)
        if not have or (version is not None and version not in have):
            raise LookupError(f"no version {version or ''} under {root}".replace("  ", " "))
        self.spark, self.version = spark, have[-1] if version is None else version
        self.manifest = json.loads("\n".join(r["value"] for r in spark.read.option("wholetext", True).text(f"{root}/manifests/{self.version}.json").collect()))

    def table(self, name: str, default: DataFrame | None = None) -> DataFrame | None:
        held = self.manifest["tables"].get(name)
        return default if held is None else self.spark.read.schema(StructType.fromJson(json.loads(held["schema"]))).parquet(held["path"])

    def model(self, name: str, default: PipelineModel | None = None) -> PipelineModel | None:
        held = self.manifest["models"].get(name)
        return default if held is None else PipelineModel.load(held)

    def value(self, name: str, default: Any = None) -> Any:
        return self.manifest["values"].get(name, default)
