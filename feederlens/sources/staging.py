"""Builds stored whole beside the published one, which they replace in one step.

A build has a folder of its own, with a folder for each table and, once that
is stored, a note of its rows and schema. A build that stopped goes on behind
its last note. Publishing replaces one small file, the name of the current
build, so ``published`` sees all tables of the old build or all of the new one;
the views of the layers then follow it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

CURRENT = "CURRENT"


@dataclass(frozen=True)
class Stored:
    """A stored table, and the rows that were written, counted while writing."""

    layer: str
    name: str
    path: str
    table: DataFrame
    rows: int


def default_root(spark: SparkSession) -> str:
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/builds"


class StagedBuild:
    """The tables of one build. Its name stands for one set of inputs and settings."""

    def __init__(self, spark: SparkSession, build: str, root: str | None = None, fmt: str = "parquet"):
        self.spark, self.build, self.fmt = spark, build, fmt
        self.root = root or default_root(spark)
        self.folder = f"{self.root}/{build}"

    def _note(self, layer: str, name: str) -> str:
        return f"{self.folder}/{layer}/{name}.stored"

    def stored(self, layer: str, name: str) -> Stored | None:
        """The table, if it has been stored whole."""
        found = read_text(self.spark, self._note(layer, name))
        if found is None:
            return None
        note = json.loads(found)
        reader = self.spark.read.format(note["fmt"])
        if note["fmt"] == "parquet":
            reader = reader.schema(StructType.fromJson(note["schema"]))
        path = f"{self.folder}/{layer}/{name}"
        return Stored(layer, name, path, reader.load(path), note["rows"])

    def save(self, layer: str, name: str, make: Callable[[], DataFrame]) -> Stored:
        """Stores what ``make`` gives, or takes what is stored; rows are counted on their way to the files."""
        if before := self.stored(layer, name):
            return before
        df, counted = make(), Observation(f"{layer}.{name}")
        path = f"{self.folder}/{layer}/{name}"
        (
            df.observe(counted, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite").format(self.fmt).save(path)
        )
        note = {"rows": counted.get.get("rows", 0), "fmt": self.fmt, "schema": df.schema.jsonValue()}
        write_text(self.spark, self._note(layer, name), json.dumps(note))
        return self.stored(layer, name)

    def publish(self, tables: Iterable[Stored]) -> None:
        """Makes this the current build."""
        listed = [[t.layer, t.name, self.fmt] for t in tables]
        write_text(self.spark, f"{self.root}/{CURRENT}", json.dumps({"build": self.build, "tables": listed}))
        point_views(self.spark, self.root)


def current(spark: SparkSession, root: str | None = None) -> dict | None:
    """Name and tables of the published build."""
    found = read_text(spark, f"{root or default_root(spark)}/{CURRENT}")
    return None if found is None else json.loads(found)


def published(spark: SparkSession, root: str | None = None) -> dict[str, DataFrame]:
    """All tables of the published build, of that one build whatever is published meanwhile."""
    root = root or default_root(spark)
    now = current(spark, root)
    if now is None:
        raise LookupError(f"nothing is published under {root}")
    build = StagedBuild(spark, now["build"], root)
    return {name: build.stored(layer, name).table for layer, name, _ in now["tables"]}


def point_views(spark: SparkSession, root: str | None = None) -> None:
    """Points the layers' views to the current build; may be repeated after a stop half way."""
    root = root or default_root(spark)
    now = current(spark, root)
    for layer, name, fmt in now["tables"]:
        if spark.catalog.tableExists(f"{layer}.{name}") and spark.catalog.getTable(f"{layer}.{name}").tableType != "VIEW":
            spark.sql(f"DROP TABLE `{layer}`.`{name}`")
        path = f"{root}/{now['build']}/{layer}/{name}"
        spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS SELECT * FROM {fmt}.`{path}`")


def drop_build(spark: SparkSession, build: str, root: str | None = None) -> None:
    """Deletes a build that is not the current one."""
    root = root or default_root(spark)
    now = current(spark, root)
    if now and now["build"] == build:
        raise ValueError(f"{build} is published")
    path, store = _on(spark, f"{root}/{build}")
    store.delete(path, True)


# Small files, wherever the session's file systems keep them ------------------

def _on(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, name: str) -> str | None:
    path, store = _on(spark, name)
    if not store.exists(path):
        return None
    source = store.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_text(spark: SparkSession, name: str, text: str) -> None:
    """Writes a file that is seen whole or not at all."""
    jvm = spark.sparkContext._jvm
    path, store = _on(spark, name)
    part, _ = _on(spark, f"{name}.part")
    out = store.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    overwrite = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(overwrite, 1)
    how[0] = overwrite.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        store.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    context.rename(store.makeQualified(part), store.makeQualified(path), how)
