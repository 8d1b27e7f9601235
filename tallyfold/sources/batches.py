"""Batch-partitioned datasets whose live partitions are named by a versioned list.

A write puts partitions into a folder of its own; they count from the moment a new version of the list names them. So a
batch is replaced, moved to another dataset or dropped by writing a list, all of a change at once, and a run that breaks
before that leaves everything as it was. Folders that no list names are removed by ``vacuum``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tallyfold.operators.sizing import BROADCAST_ROWS
from tallyfold.sources.store import clear_versions, delete_folder, exists, observed, read_current, write_current

_ENTRY = "dataset string, etl_batch_id long, origin string, write string"
_ID = T.StructField("etl_batch_id", T.LongType())
_KEY = ["origin", "write", "etl_batch_id"]
_FOLDER = "batch_folder"


class BatchStore:
    """The datasets below one folder."""

    def __init__(self, spark: SparkSession, root: str, per_folder: int = 1):
        """Each batch of a write has a folder of its own. Where batches are many and small, as many neighbouring ids as
        ``per_folder`` says share one; a store has to be opened with the number that it was begun with."""
        self.spark, self.root, self.per_folder = spark, root, per_folder
        # Column that the files of a write are partitioned by.
        self._part = _FOLDER if per_folder > 1 else "etl_batch_id"

    def _placed(self, entries: DataFrame) -> DataFrame:
        """Entries or rows with the number of the folder that their batch lies in."""
        return entries.withColumn(_FOLDER, F.expr(f"etl_batch_id div {self.per_folder}")) if self.per_folder > 1 else entries

    def live(self) -> DataFrame:
        """(dataset, etl_batch_id, origin, write): the partitions that count; they lie in the folder of their origin."""
        if not exists(self.spark, f"{self.root}/live"):
            return self.spark.createDataFrame([], _ENTRY)
        return read_current(self.spark, f"{self.root}/live")

    def batches(self, dataset: str) -> DataFrame:
        """Ids of the batches that a dataset holds."""
        return self.live().where(F.col("dataset") == dataset).select("etl_batch_id")

    def read(self, dataset: str, ids: DataFrame | None = None) -> DataFrame:
        """Rows of a dataset, or of some of its batches (column ``etl_batch_id``); only their partitions are read.

        A dataset that was written to and holds no batch has no rows; one that was never written to raises.
        """
        entries = self.live().where(F.col("dataset") == dataset).select(*_KEY)
        columns = self._schema(dataset)
        if not columns:
            raise FileNotFoundError(f"{self.root}: {dataset}")
        if ids is not None:
            entries = entries.join(ids.select("etl_batch_id").distinct(), "etl_batch_id")
        origins = {r.origin for r in self.live().where(F.col("dataset") == dataset).select("origin").distinct().toLocalIterator()}
        out = self.spark.createDataFrame([], T.StructType([_ID, *columns.fields]))
        for origin in sorted(origins):
            kinds = [*self._schema(origin).fields, _ID, T.StructField("write", T.StringType())]
            if self.per_folder > 1:
                kinds.append(T.StructField(_FOLDER, T.LongType()))
            rows = self.spark.read.schema(T.StructType(kinds)).parquet(f"{self.root}/data/{origin}")
            named = self._placed(entries.where(F.col("origin") == origin).drop("origin"))
            # A broadcast that is planned, not found at run time, prunes the scan to the partitions named.
            named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
            rows = rows.join(named, named.columns).drop("write", _FOLDER)
            out = out.unionByName(rows, allowMissingColumns=True)
        return out

    def _schema(self, dataset: str) -> T.StructType:
        """Columns that a dataset has had, without the batch id."""
        path = f"{self.root}/columns/{dataset}"
        return read_current(self.spark, path).schema if exists(self.spark, path) else T.StructType([])

    def _remember(self, dataset: str, columns: T.StructType) -> None:
        known = self._schema(dataset)
        more = [f for f in columns.fields if f.name not in (*known.names, "etl_batch_id")]
        if more:
            write_current(self.spark.createDataFrame([], T.StructType([*known.fields, *more])), f"{self.root}/columns/{dataset}")

    def put(self, dataset: str, rows: DataFrame, *, gathered: bool = False) -> tuple[str, int]:
        """Write the batches of ``rows`` without naming them: the name of the write and its number of rows.

        The rebalance hint gathers each batch into few files and splits a large one over tasks. Rows are counted
        behind that shuffle, while they are written. ``gathered`` rows lie by batch already, as those read from a dataset of
        this store or from landed files without a shuffle of their own do: they are written as they come.
        """
        write = uuid.uuid4().hex
        self._remember(dataset, rows.schema)
        rows = self._placed(rows.withColumn("etl_batch_id", F.col("etl_batch_id").cast("long")))
        counted, told = observed(rows if gathered else rows.hint("rebalance", F.col(self._part)))
        counted.write.partitionBy(self._part).parquet(f"{self.root}/data/{dataset}/write={write}")
        return write, told.get["rows"]

    def name(self, dataset: str, write: str, ids: DataFrame | None = None) -> None:
        """Make the batches of a write those of the dataset, in place of earlier ones.

        A batch of ``ids`` (column ``etl_batch_id``) that the write does not have leaves the dataset.
        """
        # Files tell which batches the write has; of their rows only the ids are read, where a folder has several.
        folder = f"{self.root}/data/{dataset}/write={write}"
        fresh = self.spark.read.schema("etl_batch_id long").parquet(folder).select("etl_batch_id").distinct()
        gone = fresh if ids is None else fresh.unionByName(ids.select(F.col("etl_batch_id").cast("long")))
        live = self.live()
        kept = live.join(gone.distinct().withColumn("dataset", F.lit(dataset)), ["dataset", "etl_batch_id"], "left_anti")
        entries = fresh.select(F.lit(dataset).alias("dataset"), "etl_batch_id", F.lit(dataset).alias("origin"), F.lit(write).alias("write"))
        self._swap(kept.select(*live.columns).unionByName(entries))

    def write(self, dataset: str, rows: DataFrame, ids: DataFrame | None = None, *, gathered: bool = False) -> int:
        """Replace batches of a dataset by those of ``rows`` and return the rows written. See ``name`` and ``put``."""
        write, n = self.put(dataset, rows, gathered=gathered)
        self.name(dataset, write, ids)
        return n

    def move(self, moves: DataFrame) -> int:
        """Let batches change their dataset, as (etl_batch_id, dataset, to) says, in one step; how many did.

        No row is read or written. A batch that the new dataset already has is replaced.
        """
        live = self.live()
        moves = moves.select(F.col("etl_batch_id").cast("long").alias("etl_batch_id"), "dataset", "to").distinct()
        moved = live.join(moves, ["dataset", "etl_batch_id"]).select(F.col("to").alias("dataset"), "etl_batch_id", "origin", "write")
        n = moved.count()
        if n:
            for pair in moved.select("dataset", "origin").distinct().collect():  # names of datasets
                self._remember(pair.dataset, self._schema(pair.origin))
            left = live.join(moves, ["dataset", "etl_batch_id"], "left_anti")
            left = left.join(moved.select("dataset", "etl_batch_id"), ["dataset", "etl_batch_id"], "left_anti")
            self._swap(left.select(*live.columns).unionByName(moved))
        return n

    def drop(self, batches: DataFrame) -> int:
        """Let batches, as (etl_batch_id, dataset), count no longer; how many did. Their files go with ``vacuum``."""
        live = self.live()
        batches = batches.select(F.col("etl_batch_id").cast("long").alias("etl_batch_id"), "dataset").distinct()
        n = live.join(batches, ["dataset", "etl_batch_id"], "left_semi").count()
        if n:
            self._swap(live.join(batches, ["dataset", "etl_batch_id"], "left_anti").select(*live.columns))
        return n

    def vacuum(self) -> int:
        """Delete partitions that the list does not name, and older lists; how many partitions went.

        Only for times when nobody writes or reads an older list.
        """
        if not exists(self.spark, f"{self.root}/data"):
            return 0
        shared = self._parted() if self.per_folder > 1 else 0
        if exists(self.spark, f"{self.root}/live"):
            clear_versions(self.spark, f"{self.root}/live")
        named, gone, part = self._placed(self.live().select(*_KEY)), 0, self._part
        for origin in self._origins():
            there = self.spark.read.schema(f"write string, {part} long").parquet(f"{self.root}/data/{origin}")
            there = there.select("write", part).distinct()
            stale = there.join(named.where(F.col("origin") == origin), ["write", part], "left_anti")
            for r in stale.toLocalIterator():
                gone += delete_folder(self.spark, f"{self.root}/data/{origin}/write={r.write}/{part}={r[part]}")
        return shared if self.per_folder > 1 else gone

    def _parted(self) -> int:
        """Write the named batches anew that share a folder with others that the list does not name; how many those are.
        Then no folder has both."""
        live, gone = self._placed(self.live()), 0
        for origin in self._origins():
            there = self.spark.read.schema(f"etl_batch_id long, write string, {_FOLDER} long").parquet(f"{self.root}/data/{origin}")
            named = live.where(F.col("origin") == origin)
            stale = there.distinct().join(named, ["write", "etl_batch_id"], "left_anti")
            gone += stale.count()
            mixed = named.join(stale.select("write", _FOLDER).distinct(), ["write", _FOLDER], "left_semi")
            for r in mixed.select("dataset").distinct().collect():  # names of datasets
                self.write(r.dataset, self.read(r.dataset, mixed.where(F.col("dataset") == r.dataset).select("etl_batch_id")))
        return gone

    def _origins(self) -> list[str]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/data")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(f.getPath().getName() for f in files.listStatus(path))

    def _swap(self, entries: DataFrame) -> None:
        write_current(entries, f"{self.root}/live")
