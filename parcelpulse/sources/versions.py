"""A table of months that is reloaded all or nothing.

The rows of each load go to a folder of their own, which no reader looks at. A manifest then
says which load every month is read from; it is written aside and becomes valid by one rename. A
load that dies before the rename leaves the table as it was, and its folder is swept later; there is
no moment at which a reader sees some months of a load and not others. Readers keep the manifest
they began with, and old loads stay until they are swept.

    <path>/loads/load=<id>/<months>=<month>/part-...      rows
    <path>/manifests/<n>.json                             a line per month: month, load
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTH = "year_month"


class _Files:
    """The file system a path is in."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path
        self.fs = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, below: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}" if below else self.path)

    def names(self, below: str) -> list[str]:
        at = self.at(below)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def write(self, below: str, text: str) -> None:
        out = self.fs.create(self.at(below), False)
        out.write(bytearray(text.encode()))
        out.close()

    def rename(self, old: str, new: str) -> bool:
        return not self.fs.exists(self.at(new)) and self.fs.rename(self.at(old), self.at(new))

    def delete(self, below: str) -> None:
        self.fs.delete(self.at(below), True)


def _numbers(files: _Files) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in files.names("manifests") if n.endswith(".json") and not n.startswith(("_", ".")))


def manifest(spark: SparkSession, path: str, number: int | None = None) -> tuple[int, dict[str, str]]:
    """(number, month -> load) of the newest manifest or of the one asked for; (0, {}) where there is none."""
    known = _numbers(_Files(spark, path))
    number = number if number is not None else (known[-1] if known else 0)
    if number not in known:
        return 0, {}
    rows = spark.read.schema("month string, load string").json(f"{path}/manifests/{number:010}.json").where("month is not null").collect()  # months, no rows
    return number, {r.month: r.load for r in rows}


def write_load(df: DataFrame, path: str, months: str = MONTH) -> str:
    """Step one of a load: its rows in a folder that no manifest names yet; returns its id."""
    load = uuid.uuid4().hex
    df.hint("rebalance", months).write.partitionBy(months).parquet(f"{path}/loads/load={load}")
    return load


def commit_load(spark: SparkSession, path: str, load: str, reloaded: Sequence[str] = (), months: str = MONTH) -> int:
    """Step two: the months of the load are read from it from now on, and months in ``reloaded`` without rows are gone.

    The months are the load's folders, so nothing is scanned. Another commit in between makes this one fail.
    """
    files = _Files(spark, path)
    number, named = manifest(spark, path)
    found = [n.split("=", 1)[1] for n in files.names(f"loads/load={load}") if n.startswith(f"{months}=")]
    named = {m: at for m, at in named.items() if m not in set(reloaded)} | dict.fromkeys(found, load)
    lines = "".join(json.dumps({"month": m, "load": at}) + "\n" for m, at in sorted(named.items()))
    aside = f"manifests/_{uuid.uuid4().hex}"
    files.write(aside, lines or "{}\n")
    if not files.rename(aside, f"manifests/{number + 1:010}.json"):
        files.delete(aside)
        raise RuntimeError(f"{path}: another load was committed meanwhile, run this one again")
    return number + 1


def reload_months(df: DataFrame, path: str, reloaded: Sequence[str] = (), months: str = MONTH) -> int:
    """Replace the months of ``df``, and those of ``reloaded`` that have no rows, all at once; returns the manifest's number.

    Other months stay as they are. The same load again gives the same table.
    """
    return commit_load(df.sparkSession, path, write_load(df, path, months), reloaded, months)


def read_months(
    spark: SparkSession, path: str, schema: T.StructType, only: Sequence[str] | None = None, number: int | None = None, months: str = MONTH
) -> DataFrame:
    """The table, or the months in ``only``, by the newest manifest or an older one that has not been swept.

    Only folders of the wanted months are listed. Without any, there are no rows.
    """
    named = manifest(spark, path, number)[1]
    folders = [f"{path}/loads/load={load}/{months}={m}" for m, load in sorted(named.items()) if only is None or m in only]
    if not folders:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    return spark.read.schema(stored).option("basePath", f"{path}/loads").parquet(*folders).select(*[F.col(f.name) for f in schema.fields])


def sweep(spark: SparkSession, path: str, keep: int = 1, months: str = MONTH) -> int:
    """Delete manifests but for the last ``keep``, and the months of loads that none of these names; returns how many folders went.

    Not to be run beside a load: what is written but not yet committed looks like a load that died.
    """
    files, gone = _Files(spark, path), 0
    numbers = _numbers(files)
    used = {(load, m) for n in numbers[-keep:] for m, load in manifest(spark, path, n)[1].items()}
    for n in numbers[:-keep]:
        files.delete(f"manifests/{n:010}.json")
    for name in files.names("manifests"):
        if name.startswith("_"):
            files.delete(f"manifests/{name}")
    for folder in files.names("loads"):
        held = [m for m in files.names(f"loads/{folder}") if m.startswith(f"{months}=")]
        unused = [m for m in held if (folder.split("=", 1)[1], m.split("=", 1)[1]) not in used]
        for m in unused:
            files.delete(f"loads/{folder}/{m}")
        if len(unused) == len(held):
            files.delete(f"loads/{folder}")
        gone += len(unused)
    return gone
