"""Fitted tables that belong together, saved and loaded as one version."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFEST = "manifest"


def publish(tables: Mapping[str, DataFrame], folder: str, version: int) -> None:
    """Write the tables of a version, then its manifest, which is what makes the version exist.

    Tables go to fresh folders, so a writer that stopped halfway, or a second one of the same version, cannot mix with it;
    the manifest names the folders that count. A version that is there already fails.
    """
    spark = next(iter(tables.values())).sparkSession
    if version in versions(spark, folder):
        raise ValueError(f"version {version} exists")
    names = {}
    for name, df in tables.items():
        names[name] = {"path": f"{folder}/tables/{name}-{version}-{uuid.uuid4().hex}", "schema": df.schema.json()}
        df.write.parquet(names[name]["path"])
    line = json.dumps({"version": version, "tables": names})
    spark.createDataFrame([(version, line)], "version int, line string").coalesce(1).write.mode("append").parquet(
        f"{folder}/{MANIFEST}")


def _manifests(spark: SparkSession, folder: str) -> dict[int, dict]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{MANIFEST}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return {}
    rows = spark.read.schema("version int, line string").parquet(f"{folder}/{MANIFEST}").collect()
    return {r["version"]: json.loads(r["line"]) for r in rows}


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The whole versions, oldest first."""
    return sorted(_manifests(spark, folder))


def load(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of a version, by default the newest whole one. Half-written versions have no manifest and do not count."""
    known = _manifests(spark, folder)
    if not known or (version is not None and version not in known):
        raise ValueError("no such version")
    tables = known[max(known) if version is None else version]["tables"]
    return {name: spark.read.schema(T.StructType.fromJson(json.loads(t["schema"]))).parquet(t["path"])
            for name, t in tables.items()}
