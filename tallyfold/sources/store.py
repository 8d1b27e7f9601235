"""Where results go: batch-partitioned datasets, whole tables, versioned small tables, verified copies."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see, as named by the cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def use_checkpoints(spark: SparkSession) -> None:
    """Make sure that checkpoints have a folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))



def write_table(rows: DataFrame, path: str, *, fmt: str = "parquet", partition_by=()) -> None:
    """Replace a whole derived table. ``rows`` must not read from ``path``."""
    writer = rows.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


class Buckets:
    """Tables of one run that are bucketed alike, so that joins on their key need no shuffle. Left as a context, their names
    go from the catalog; the files stay."""

    def __init__(self, spark: SparkSession, path: str, key: str, count: int):
        self.spark, self.path, self.key, self.count = spark, path, key, count
        self.names: list[str] = []

    def __enter__(self) -> Buckets:
        return self

    def __exit__(self, *_) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        """Write ``rows`` with one sorted file for each bucket and return the table."""
        table = f"tallyfold_{name}_{uuid.uuid4().hex[:12]}"
        (rows.repartition(self.count, self.key).write.bucketBy(self.count, self.key).sortBy(self.key)
         .option("path", f"{self.path}/{name}").mode("overwrite").saveAsTable(table))
        self.names.append(table)
        return self.spark.table(table)


def replace_batch(rows: DataFrame, path: str, *, partition_by=("etl_batch_id",)) -> int:
    """Write batches so that each one present in ``rows`` replaces its earlier content; others stay. Returns the rows written.

    The rebalance hint gathers each batch into few files; adaptive execution splits a batch that is much
    larger than the others and merges small ones. Rows are counted behind that shuffle, while they are written.
    """
    balanced, told = observed(rows.hint("rebalance", *[F.col(c) for c in partition_by]))
    (balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    return told.get["rows"]


def drop_batches(spark: SparkSession, path: str, ids: DataFrame, *, partition: str = "etl_batch_id") -> int:
    """Remove the partitions of the given batch ids from a dataset; absent ones are skipped.

    Only directory entries change. The ids are streamed, never collected whole.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = 0
    for row in ids.distinct().toLocalIterator():
        target = jvm.org.apache.hadoop.fs.Path(folder, f"{partition}={row[0]}")
        dropped += bool(files.delete(target, True))
    return dropped


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _versions(spark, path):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = files.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS"))
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in done)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """Newest completely written version of a small table such as the log."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/version={versions[-1]}")


def write_current(rows: DataFrame, path: str) -> None:
    """Write a new version beside the old one, so a table can be rewritten from its own content."""
    versions = _versions(rows.sparkSession, path)
    rows.write.mode("overwrite").parquet(f"{path}/version={versions[-1] + 1 if versions else 1}")


def clear_versions(spark: SparkSession, path: str) -> int:
    """Delete all but the newest completely written version of a small table; how many went."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*")
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = _versions(spark, path)
    names = [f.getPath().getName().split("=")[1] for f in files.globStatus(folder) or []]
    # Later ones are being written.
    return sum(delete_folder(spark, f"{path}/version={n}") for n in names if done and int(n) < done[-1])


def delete_folder(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def observed(rows: DataFrame, *, digest: bool = False) -> tuple[DataFrame, Observation]:
    """``rows`` and what the action that runs them will tell: ``rows``, and with ``digest`` a sum over the rows' hashes.

    Counting rides on the write, so nothing is evaluated twice. It has to be the last step before the write: a task that
    runs again in an earlier stage, after an executor is lost, would be counted again.
    """
    told = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    if digest:
        measures.append(row_digest(rows).alias("digest"))
    return rows.observe(told, *measures), told


def row_digest(rows: DataFrame) -> Column:
    """A sum over the hashes of all rows: the same for the same rows in any order."""
    cells = [F.col(f"`{c}`") for c in sorted(rows.columns)]
    return F.coalesce(F.sum(F.xxhash64(*cells).cast("decimal(38,0)")), F.lit(0)).cast("string")


def copy_and_verify(spark: SparkSession, tables: dict[str, DataFrame], to_path: str, *,
                    fmt: str = "parquet") -> DataFrame:
    """Copy each table below ``to_path`` and compare rows and row hashes: one PASS or FAIL row per table.

    The source is evaluated once: it is counted while it is written. The copy is read back.
    """
    out = []
    for name, rows in tables.items():
        counted, told = observed(rows, digest=True)
        write_table(counted, f"{to_path}/{name}", fmt=fmt)
        back = spark.read.format(fmt).schema(rows.schema).load(f"{to_path}/{name}")
        back = back.agg(F.count(F.lit(1)).alias("rows"), row_digest(back).alias("digest")).first()
        same = (told.get["rows"], told.get["digest"]) == (back["rows"], back["digest"])
        out.append((name, told.get["rows"], back["rows"], "PASS" if same else "FAIL"))
    return spark.createDataFrame(out, "table_name string, rows_from long, rows_to long, status string")
