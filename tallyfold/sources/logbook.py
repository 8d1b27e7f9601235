"""The log as blocks of neighbouring ids. A change rewrites the blocks that it touches and no others.

Ids are given in order of batch and file, so the files of a delivery lie in few blocks, and an id alone tells its block:
events and notes need no look-up. A block never has more rows than ids, however large one delivery is. New files fill the
last block and open further ones. Blocks are the batches of a ``BatchStore``: all of a change counts at once, and a run that
breaks before that leaves the log as it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyfold.operators.log import added_rows, append_notes, apply_log_events, matched_files, updated_rows
from tallyfold.schema import LOG_SCHEMA
from tallyfold.sources.batches import BatchStore
from tallyfold.sources.store import exists, read_current, use_checkpoints, write_current

BLOCK_IDS = 100_000
_LOG = "log"
_BLOCK = "etl_batch_id"  # the store's name for what it replaces as a whole


class LogBook:
    """The log below one folder. One writer at a time; readers keep the state that they began with."""

    def __init__(self, spark: SparkSession, root: str, block_ids: int = BLOCK_IDS):
        """``block_ids`` is the number of ids of a block; a log that is there keeps the number it was begun with.

        Blocks narrower than ``BLOCK_IDS`` share the folders of their files, so that no change opens more than one folder
        for that many ids.
        """
        self.spark, self.root = spark, root
        self._begun = exists(spark, f"{root}/block_ids")
        kept = read_current(spark, f"{root}/block_ids").first().asDict() if self._begun else {
            "block_ids": block_ids, "per_folder": max(1, BLOCK_IDS // block_ids)}
        # A log that does not tell was begun with a folder for each block.
        self.block_ids, per_folder = kept["block_ids"], kept.get("per_folder", 1)
        self.store = BatchStore(spark, root, per_folder)

    def read(self, ids: DataFrame | None = None) -> DataFrame:
        """The log, or its rows with the given ids (column ``id``); then only their blocks are read."""
        if not self._begun:
            raise FileNotFoundError(self.root)
        if ids is None:
            return self.store.read(_LOG).drop(_BLOCK)
        ids = ids.select("id").distinct()
        return self.store.read(_LOG, self._blocks(ids)).drop(_BLOCK).join(ids, "id", "left_semi")

    def replace(self, log: DataFrame) -> int:
        """Make ``log`` the whole log; how many rows it has. ``log`` may come from this log itself."""
        if not self._begun:
            numbers = self.spark.createDataFrame([(self.block_ids, self.store.per_folder)], "block_ids long, per_folder long")
            write_current(numbers, f"{self.root}/block_ids")
            self._begun = True
        return self.store.write(_LOG, log.withColumn(_BLOCK, self._block()), self.store.batches(_LOG))

    def upsert(self, files: DataFrame, now) -> int:
        """Merge ``files`` in as ``upsert_log`` does; how many rows were written. Other blocks give their keys and ids only."""
        if not self._begun:
            self.replace(self.spark.createDataFrame([], LOG_SCHEMA))
        log = self.read()
        known = matched_files(log, files)
        fresh = added_rows(log, known, now).checkpoint()
        ids = known.where(F.col("_id").isNotNull()).select(F.col("_id").alias("id")).unionByName(fresh.select("id"))
        return self._rewrite(ids, lambda rows: updated_rows(rows, known, now).unionByName(fresh))

    def apply(self, events: DataFrame) -> int:
        """Fold events in as ``apply_log_events`` does; how many rows were written. Ids that the log lacks change nothing."""
        return self._with_side(events, apply_log_events)

    def note(self, notes: DataFrame) -> int:
        """Append notes as ``append_notes`` does; how many rows were written."""
        return self._with_side(notes, append_notes)

    def blocks(self) -> DataFrame:
        """(block, write): the blocks of the log and the name of the write that each one is from."""
        return self.store.live().select(F.col(_BLOCK).alias("block"), "write")

    def vacuum(self) -> int:
        """Delete blocks that were replaced; how many went. Only for times when nobody reads an older state."""
        return self.store.vacuum()

    def _block(self) -> Column:
        # Rows without an id share a block of their own.
        return F.coalesce(F.floor((F.col("id") - 1) / F.lit(self.block_ids)), F.lit(-1)).cast("long")

    def _blocks(self, ids: DataFrame) -> DataFrame:
        return ids.select(self._block().alias(_BLOCK)).distinct()

    def _with_side(self, side: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        use_checkpoints(self.spark)
        side = side.checkpoint()
        return self._rewrite(side.select("id"), lambda rows: change(rows, side))

    def _rewrite(self, ids: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        """Replace the blocks of the given ids by what ``change`` makes of their rows."""
        blocks = self._blocks(ids).checkpoint()
        rows = change(self.store.read(_LOG, blocks).drop(_BLOCK))
        return self.store.write(_LOG, rows.withColumn(_BLOCK, self._block()), blocks)
