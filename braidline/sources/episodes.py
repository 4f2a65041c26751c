"""A table of episodes whose every change is one commit.

Rows of a change are written to a folder of their own, then the list of all live
episodes with the folder each one is in, then a commit file that names the list.
Only the commit file makes a change visible, and it appears by one rename that
fails if another writer took the same number first. A job or a driver lost at
any time before leaves the last state as it was; files of a change that was
never committed are never read. Folders are never written twice, so a reader
that began with one commit finds its files to the end.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidline import ordered

EPISODE_KEYS = ["run_id", "source_episode_index"]
FOLDER, INDEX = "folder", "episode_index"
ATTEMPTS = 5


def _rows_seen(seen: Observation) -> int:
    """Observed row count; an input that Spark proved empty while running reports none."""
    try:
        return seen.get["n"]
    except Py4JJavaError:
        return 0


@dataclass(frozen=True)
class Commit:
    number: int
    manifest: str
    schema: T.StructType


class EpisodeTable:
    """Episodes below ``path``, one per value of ``keys``: the run, then the episode of the run."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str] | None = None):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys or EPISODE_KEYS

    # -- commits -----------------------------------------------------------

    def _hadoop(self):
        return self.spark._jvm.org.apache.hadoop.fs

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()

    def _name(self, name: str):
        return self._hadoop().Path(f"{self.path}/{name}")

    def current(self) -> Commit | None:
        """The newest commit, or None for a table that has none yet."""
        folder = self._name("commits")
        fs = folder.getFileSystem(self._conf())
        if not fs.exists(folder):
            return None
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if not numbers:
            return None
        stream = fs.open(self._name(f"commits/{max(numbers):012d}.json"))
        try:
            said = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Commit(max(numbers), said["manifest"], T.StructType.fromJson(said["schema"]))

    def _publish(self, number: int, manifest: str, schema: T.StructType) -> bool:
        """Make a manifest the newest commit; False if the number is taken."""
        jvm, hadoop = self.spark._jvm, self._hadoop()
        staged = self._name(f"staged/{uuid.uuid4().hex}")
        final = self._name(f"commits/{number:012d}.json")
        fs = staged.getFileSystem(self._conf())
        fs.mkdirs(final.getParent())
        out = fs.create(staged, False)
        try:
            text = json.dumps({"manifest": manifest, "schema": json.loads(schema.json())})
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        never = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        never[0] = hadoop.Options.Rename.NONE
        context = hadoop.FileContext.getFileContext(fs.getUri(), self._conf())
        try:
            context.rename(fs.makeQualified(staged), fs.makeQualified(final), never)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception.getClass()):
                raise
            return False

    # -- reading -----------------------------------------------------------

    def manifest(self, commit: Commit | None = None) -> DataFrame | None:
        """keys, folder and dense ``episode_index`` of all live episodes."""
        commit = commit or self.current()
        return None if commit is None else self.spark.read.parquet(f"{self.path}/{commit.manifest}")

    def read(self) -> DataFrame | None:
        """The rows of all live episodes with their ``episode_index``; None without a commit."""
        commit = self.current()
        if commit is None:
            return None
        live = self.manifest(commit)
        # one folder for each change that still holds a live episode
        folders = [r[FOLDER] for r in live.select(FOLDER).distinct().collect()]
        if not folders:
            schema = commit.schema.add(INDEX, "long")
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/data"
        stored = T.StructType([*commit.schema.fields, T.StructField(FOLDER, T.StringType())])
        rows = (
            self.spark.read.schema(stored)
            .option("basePath", base)
            .parquet(*[f"{base}/{FOLDER}={f}" for f in sorted(folders)])
        )
        return rows.join(live, [FOLDER, *self.keys]).select(*commit.schema.names, INDEX)

    # -- changes -----------------------------------------------------------

    def stage(self, rows: DataFrame) -> tuple[str, int]:
        """Write rows to a new folder that no reader sees yet: its name and the number of rows.

        The rebalance brings the rows of an episode together, shares a large
        episode out over several files and packs small ones. The keys are columns
        of the files, sorted, so the number of files follows the rows, not the
        episodes.
        """
        folder, seen = uuid.uuid4().hex, Observation()
        (
            rows.observe(seen, F.count(F.lit(1)).alias("n"))
            .hint("rebalance", *self.keys)
            .sortWithinPartitions(*self.keys)
            .write.parquet(f"{self.path}/data/{FOLDER}={folder}")
        )
        return folder, _rows_seen(seen)

    def _indexed(self, live: DataFrame) -> DataFrame:
        """Live episodes numbered from 0 in each run, without gaps."""
        *run, episode = self.keys
        ranked = ordered.scan(live.select(*self.keys, FOLDER), run, [episode], _n=ordered.RowNumber())
        return ranked.withColumn(INDEX, F.col("_n") - 1).drop("_n")

    def _commit(self, change, schema: T.StructType | None) -> int | None:
        """Apply ``change`` to the newest list of live episodes; again if another writer was first."""
        for _ in range(ATTEMPTS):
            before = self.current()
            number = 0 if before is None else before.number + 1
            live = None if before is None else self.manifest(before).select(*self.keys, FOLDER)
            name = f"manifests/{number:012d}-{uuid.uuid4().hex}"
            self._indexed(change(live)).write.parquet(f"{self.path}/{name}")
            known = before.schema if before is not None and schema is None else schema
            if self._publish(number, name, known):
                return number
        raise RuntimeError(f"{ATTEMPTS} other commits came first")

    def write(self, rows: DataFrame) -> int:
        """Append or replace exactly the episodes in ``rows``; the number of rows. (K2)"""
        fields = {f.name: f for f in rows.schema.fields}
        data = [f for n, f in fields.items() if n not in self.keys]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in [*data, *map(fields.get, self.keys)]])
        folder, n = self.stage(rows)
        if not n:
            return 0
        stored = self.spark.read.schema(schema).parquet(f"{self.path}/data/{FOLDER}={folder}")
        written = stored.select(*self.keys).distinct().withColumn(FOLDER, F.lit(folder))

        def change(live: DataFrame | None) -> DataFrame:
            if live is None:
                return written
            return live.join(written.select(*self.keys), self.keys, "left_anti").unionByName(written)

        self._commit(change, schema)
        return n

    def delete(self, gone: DataFrame) -> None:
        """Take episodes out; later ones of their run move up in ``episode_index``. (K8)

        Only the list of live episodes changes.
        """
        if self.current() is None:
            return
        keys = gone.select(*self.keys).distinct()
        self._commit(lambda live: live.join(keys, self.keys, "left_anti"), None)
