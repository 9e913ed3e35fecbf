"""Offset ledger (STR-2, SNK-6): which messages are stored, as intervals of offsets.

Each stored micro-batch has one folder in the ledger: rows ``topic, partition, first, last, n, first_message, run`` with the runs of
consecutive offsets that it stores. The folder is written before the batch's data and gets the mark ``STORED`` after it, so at any time

- a message is stored if a marked interval holds its offset;
- a folder without the mark whose offsets no marked one holds is a batch that a failure cut off: ``recover`` removes what it
  left, and its messages count as new.

A micro-batch is anti-joined with the marked intervals. Any run, with a new checkpoint or other batch sizes too, therefore stores each
message once. Intervals are exact: offsets between two stored ones are not taken as stored. Folders are
merged, also into longer intervals, when there are more than ``MERGE_AT``; reading a folder and its merged copy gives the same set, so a failure
between writing one and removing the other does no harm. One consumer at a time writes to a ledger.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COORDS = ("topic", "partition", "offset")
SCHEMA = "topic string, partition int, first long, last long, n long, first_message string, run string"
MARK = "STORED"
#: folders of a ledger before they are merged
MERGE_AT = 64


class Ledger:
    """The ledger at ``path``; ``data_paths`` are the tables whose batches it lists (partitioned by topic and first_message)."""

    def __init__(self, spark: SparkSession, path: str, data_paths: Sequence[str] = ()):
        self.spark, self.path, self.data_paths = spark, path.rstrip("/"), [p.rstrip("/") for p in data_paths]
        self._jvm = spark._jvm
        where = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = where.getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------------ folders
    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _with(self, mark: str) -> list[str]:
        found = self._fs.globStatus(self._path(f"{self.path}/*/{mark}"))
        return sorted(f.getPath().getParent().toString() for f in found or [])

    def stored_folders(self) -> list[str]:
        return self._with(MARK)

    def _drop(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)

    def _mark(self, folder: str) -> None:
        self._fs.create(self._path(f"{folder}/{MARK}")).close()

    def _write(self, rows: DataFrame) -> str:
        folder = f"{self.path}/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return folder

    def _read(self, folders: Sequence[str]) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], SCHEMA)

    # ------------------------------------------------------------------ use
    def stored(self) -> DataFrame:
        """The intervals of all stored batches; intervals may repeat."""
        return self._read(self.stored_folders())

    def recover(self) -> int:
        """Remove what batches left that were begun and not finished; how many there were."""
        stored = set(self.stored_folders())
        root = self._path(self.path)
        every = [f.getPath().toString() for f in self._fs.listStatus(root)] if self._fs.exists(root) else []
        unmarked, cut_off = [f for f in every if f not in stored], 0
        for folder in unmarked:
            if self._fs.exists(self._path(f"{folder}/_SUCCESS")):  # else the data was not begun
                rows = self._read([folder])
                firsts = rows.select("topic", "partition", F.col("first").alias("offset"))
                if not self.new_messages(firsts).isEmpty():  # else the rest of a folder that was merged
                    cut_off += 1
                    for row in rows.select("topic", "first_message").distinct().collect():  # a row for each topic
                        for data in self.data_paths:
                            self._drop(f"{data}/topic={row['topic']}/first_message={row['first_message']}")
            self._drop(folder)
        return cut_off

    def new_messages(self, messages: DataFrame) -> DataFrame:
        """The rows of ``messages`` whose offsets no stored interval holds, each message once."""
        coords = messages.select(*COORDS)
        bounds = coords.groupBy("topic", "partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"),
                                                          F.count(F.lit(1)).alias("n"), F.countDistinct("offset").alias("d"))
        near = self.stored().join(bounds, ["topic", "partition"]).filter("last >= lo and first <= hi")
        if not bounds.filter("n > d").isEmpty():
            messages = messages.dropDuplicates(list(COORDS))
            coords = messages.select(*COORDS)
        if near.isEmpty():  # a run that goes on where the last one ended
            return messages
        points = coords.withColumn("until", F.lit(None).cast("long")).unionByName(
            near.select("topic", "partition", F.col("first").alias("offset"), F.col("last").alias("until")))
        before = Window.partitionBy("topic", "partition").orderBy("offset").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        known = points.withColumn("reach", F.max("until").over(before)).filter("until is null and reach >= offset").select(*COORDS)
        return messages.join(known, list(COORDS), "left_anti")

    def intervals(self, messages: DataFrame, run: str) -> DataFrame:
        """``messages`` as intervals of consecutive offsets, named by the least (partition, offset) of their topic."""
        place = Window.partitionBy("topic", "partition").orderBy("offset")
        runs = messages.select(*COORDS).withColumn("island", F.col("offset") - F.row_number().over(place))
        runs = runs.groupBy("topic", "partition", "island").agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.count(F.lit(1)).alias("n"))
        names = messages.groupBy("topic").agg(F.min(F.struct("partition", "offset")).alias("m")).select(
            "topic", F.concat(F.col("m.partition").cast("string"), F.lit("-"), F.col("m.offset").cast("string")).alias("first_message"))
        return runs.join(names, "topic").select("topic", F.col("partition").cast("int").alias("partition"), "first", "last", "n", "first_message", F.lit(run).alias("run"))

    def begin(self, messages: DataFrame, run: str) -> str:
        """Write the intervals of a batch that is about to be stored."""
        return self._write(self.intervals(messages, run))

    def finish(self, folder: str) -> None:
        """The batch of ``begin`` is stored."""
        self._mark(folder)
        folders = self.stored_folders()
        if len(folders) > MERGE_AT:
            self.merge(folders)

    def merge(self, folders: Sequence[str]) -> None:
        """Put the intervals of ``folders`` into one, adjacent ones of a run joined."""
        rows = self._reached(self._read(folders))
        place = Window.partitionBy("topic", "partition", "run").orderBy("first", "last")
        rows = rows.withColumn("part", F.sum(F.when(F.col("first") > F.col("reach") + 1, 1).otherwise(0)).over(place))
        rows = rows.groupBy("topic", "partition", "run", "part").agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.min_by("first_message", "first").alias("first_message"))
        rows = rows.withColumn("n", F.col("last") - F.col("first") + 1)
        self._mark(self._write(rows.select("topic", "partition", "first", "last", "n", "first_message", "run")))
        for folder in folders:
            self._drop(folder)

    @staticmethod
    def _reached(rows: DataFrame) -> DataFrame:
        """Intervals with ``reach``: the last offset that those of the run before it hold."""
        before = Window.partitionBy("topic", "partition", "run").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn("reach", F.coalesce(F.max("last").over(before), F.col("first") - 2))

    def stored_count(self, run: str) -> int:
        """Messages stored under ``run``; intervals that a merged copy repeats count once."""
        rows = self._reached(self.stored().filter(F.col("run") == run))
        return rows.agg(F.sum(F.greatest(F.lit(0), F.col("last") - F.greatest(F.col("reach"), F.col("first") - 1)))).first()[0] or 0
