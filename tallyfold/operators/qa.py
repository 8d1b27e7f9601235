"""Control totals, long-format quality sums and comparisons."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tallyfold.schema import QA_COLUMNS, QA_KEYS


def exact_sum(rows: DataFrame, pop: str = "pop") -> Column:
    """Sum of headcounts in the type that they have. Doubles are added as decimals of eight places, so that the sum does
    not depend on the order of the rows."""
    if isinstance(rows.schema[pop].dataType, (T.DoubleType, T.FloatType)):
        return F.sum(F.col(pop).cast("decimal(28,8)")).cast("double")
    return F.sum(pop)


def control_totals(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Rows with a headcount and their rounded total, per batch; with ``ids`` one row for each of them, 0 if it has none."""
    totals = rows.where(F.col("pop").isNotNull()).groupBy("etl_batch_id")
    found = totals.agg(F.count("pop").alias("row_cnt"), F.round(exact_sum(rows), 0).alias("pop_tot"))
    if ids is None:
        return found
    return ids.select("etl_batch_id").distinct().join(found, "etl_batch_id", "left").fillna(0, ["row_cnt", "pop_tot"])


def fates(counts: DataFrame, hop: str, kept: str, **lost: str) -> DataFrame:
    """(etl_batch_id, hop, fate, rows): what became of the rows that a hop had. ``kept`` and the values of ``lost`` name
    counts, the keys of ``lost`` the reasons for which rows go no further."""
    names = {"kept": kept, **lost}
    each = F.explode(F.array(*[F.struct(F.lit(fate).alias("fate"), F.col(c).cast("long").alias("rows")) for fate, c in names.items()]))
    return counts.select("etl_batch_id", F.lit(hop).alias("hop"), each.alias("x")).select("etl_batch_id", "hop", "x.fate", "x.rows")


def unbalanced(found: DataFrame, order: list[str]) -> DataFrame:
    """(etl_batch_id, hop, arrived, sent): hops at which not as many rows arrived as the hop before kept."""
    hops = found.where(F.col("fate") != "header").groupBy("etl_batch_id", "hop").agg(
        F.sum("rows").alias("arrived"), F.sum(F.when(F.col("fate") == "kept", F.col("rows"))).alias("sent"))
    place = F.array_position(F.array(*map(F.lit, order)), F.col("hop"))
    hops = hops.withColumn("place", place)
    before = hops.select("etl_batch_id", (F.col("place") + 1).alias("place"), F.col("sent").alias("expected"))
    both = hops.join(before, ["etl_batch_id", "place"])
    return both.where(F.col("arrived") != F.col("expected")).select("etl_batch_id", "hop", "arrived", F.col("expected").alias("sent"))


def reconcile_hops(log: DataFrame, hops: dict[str, DataFrame]) -> DataFrame:
    """Counts and totals of every hop beside those of the file, with a flag where a hop differs.

    ``hops`` maps a hop name to its control totals; batches absent from a hop count 0.
    """
    out = log.select(F.col("id").alias("etl_batch_id"), F.col("qa_rows_file").alias("rows_file"),
                     F.col("qa_pop_file").alias("pop_file"))
    for hop, totals in hops.items():
        side = totals.select("etl_batch_id", F.col("row_cnt").alias(f"rows_{hop}"), F.col("pop_tot").alias(f"pop_{hop}"))
        out = out.join(side, "etl_batch_id", "left").fillna(0, [f"rows_{hop}", f"pop_{hop}"])
    for hop in hops:
        same = (F.col(f"rows_{hop}") == F.col("rows_file")) & (F.col(f"pop_{hop}") == F.round("pop_file", 0))
        out = out.withColumn(f"{hop}_ok", F.coalesce(same, F.lit(False)))
    return out


def qa_cells(rows: DataFrame, columns=tuple(QA_COLUMNS)) -> DataFrame:
    """Headcount of each batch by file keys and all columns together. ``qa_long`` of cells is that of their rows."""
    return rows.groupBy("etl_batch_id", *QA_KEYS, *columns).agg(F.sum("pop").alias("pop"))


def qa_long(rows: DataFrame, columns=tuple(QA_COLUMNS), pop: str = "pop") -> DataFrame:
    """Headcount by file keys and each value of each column, null values left out.

    Rows are first summed by all columns together, which leaves a small set of cells, and only the cells are
    unpivoted and summed again. A value that is no small whole number raises.
    """
    cells = rows.groupBy(*QA_KEYS, *columns).agg(F.sum("pop").alias("pop"))
    narrow = cells.select(*QA_KEYS, "pop", *[F.col(c).cast("smallint").alias(c) for c in columns])
    long = narrow.unpivot([*QA_KEYS, "pop"], list(columns), "col", "val").where(F.col("val").isNotNull())
    return long.groupBy(*QA_KEYS, "col", "val").agg(F.sum("pop").alias(pop))


def prior_year_keys(reference: DataFrame) -> DataFrame:
    """Shift reference sums one year on; zip geographies also move their geography year."""
    geo_year = F.when(F.col("geo_type") == "zip", (F.col("geo_year").cast("int") + 1).cast("string"))
    return reference.withColumns({
        "year": (F.col("year").cast("int") + 1).cast("string"),
        "geo_year": F.coalesce(geo_year, F.col("geo_year")),
    })


def qa_compare(raw: DataFrame, reference: DataFrame, *, prior: bool = False) -> DataFrame:
    """Raw sums beside reference sums of the same (or, with ``prior``, the previous) year.

    Both are ``qa_long`` frames. Half-way values round to even; a zero reference gives a null share.
    """
    raw = raw.withColumnRenamed("pop", "raw_pop")
    reference = reference.withColumnRenamed("pop", "ref_pop")
    if prior:
        reference = prior_year_keys(reference)
    keys = [c for c in raw.columns if c in reference.columns]
    return _compared(raw.join(reference, keys))


def _compared(joined: DataFrame) -> DataFrame:
    diff = F.bround((F.col("raw_pop") - F.col("ref_pop")).cast("double"), 6)
    joined = joined.withColumn("diff", diff)
    return joined.withColumn("perc", F.bround(F.try_divide("diff", F.col("ref_pop").cast("double")), 4))


COMPARISONS = ("raw_vs_current_year", "raw_vs_previous_year")


def qa_compare_both(raw: DataFrame, reference: DataFrame) -> DataFrame:
    """Both comparisons of ``qa_compare``, told apart by ``comparison``, in one aggregation.

    Raw sums stand in both comparisons, reference sums in the one of their year and in the one of the next.
    """
    keys = [c for c in raw.columns if c != "pop"]
    now, before = COMPARISONS
    shifted = prior_year_keys(reference)
    sides = [raw.select("comparison", *keys, F.col("pop").alias("raw_pop"))
             for raw in [raw.withColumn("comparison", F.explode(F.array(F.lit(now), F.lit(before))))]]
    sides += [rows.select(F.lit(name).alias("comparison"), *keys, F.col("pop").alias("ref_pop"))
              for name, rows in ((now, reference), (before, shifted))]
    tagged = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), sides)
    for key in keys:
        tagged = tagged.where(F.col(key).isNotNull())
    # A key has one sum on each side.
    both = tagged.groupBy("comparison", *keys).agg(F.max("raw_pop").alias("raw_pop"), F.max("ref_pop").alias("ref_pop"))
    return _compared(both.where("raw_pop IS NOT NULL AND ref_pop IS NOT NULL"))


def write_qa_report(raw: DataFrame, reference: DataFrame, path: str, *, fmt: str = "csv") -> None:
    """Both comparisons below ``path``, one folder each."""
    writer = qa_compare_both(raw, reference).write.mode("overwrite").partitionBy("comparison").format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(path)


def resume_points(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows already loaded for each batch of the manifest; 0 when nothing has been."""
    counts = loaded.groupBy("etl_batch_id").agg(F.count("*").alias("rows_loaded"))
    ids = manifest.select(F.col("id").alias("etl_batch_id"))
    return ids.join(counts, "etl_batch_id", "left").fillna(0, ["rows_loaded"])
