"""Frame selection by count windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def window_frames(frames: DataFrame, keys: list[str], index: str, size) -> DataFrame:
    """``frames`` with ``window_id``: position in the clip, in index order, over the window size.

    Gaps in the index open no new window. ``size`` is a number or a column;
    sizes under 1 count as 1.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(index)) - 1
    width = F.greatest(F.coalesce(F.col(size) if isinstance(size, str) else F.lit(size), F.lit(1)), F.lit(1))
    return frames.withColumn("window_id", F.floor(position / width).cast("int"))


def select_frames(frames: DataFrame, keys: list[str], index: str, score: str, size, threshold: float) -> DataFrame:
    """Windowed frames with ``is_window_best`` (the first of equal scores), ``meets_threshold`` and ``keep``.

    NaN scores rank last and never meet the threshold.
    """
    rows = window_frames(frames, keys, index, size)
    order = Window.partitionBy(*keys, "window_id").orderBy(F.isnan(F.col(score).cast("double")), F.desc(score), F.asc(index))
    good = F.coalesce((F.col(score) >= threshold) & ~F.isnan(F.col(score).cast("double")), F.lit(False))
    rows = rows.withColumns({"is_window_best": F.row_number().over(order) == 1, "meets_threshold": good})
    return rows.withColumn("keep", F.col("is_window_best") & F.col("meets_threshold"))


def clip_series(images: DataFrame, key: str, order: str, *values: str) -> DataFrame:
    """Values of each clip in capture order."""
    return images.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, *values))).alias("series"))


def plan_copies(frames: DataFrame, group: str, name: str, order: list, existing: DataFrame | None = None) -> DataFrame:
    """Copies to make: the first of each (group, file name), without those that exist. Every row is kept with its ``action``."""
    first = F.row_number().over(Window.partitionBy(group, name).orderBy(*order)) == 1
    rows = frames.withColumn("_first", first)
    if existing is not None:
        known = existing.select(group, name, F.lit(True).alias("_there")).distinct()
        rows = rows.join(known, [group, name], "left")
    else:
        rows = rows.withColumn("_there", F.lit(None).cast("boolean"))
    return rows.withColumn("action", F.when(F.col("_first") & F.col("_there").isNull(), "copy").otherwise("present")).drop("_first", "_there")


def pending_jobs(jobs: DataFrame, done: DataFrame) -> DataFrame:
    """Extraction jobs without a completion marker; markers know folder and stem, not the suffix."""
    return jobs.join(done.select("out_dir", "clip_stem").distinct(), ["out_dir", "clip_stem"], "left_anti")


def extraction_outcome(jobs: DataFrame) -> DataFrame:
    """One row: jobs by ``state`` (extracted, skipped, failed) and the frames expected of all."""
    n = lambda s: F.count_if(F.col("state") == s).alias(s)
    return jobs.agg(n("extracted"), n("skipped"), n("failed"), F.coalesce(F.sum((F.col("duration") * F.col("fps")).cast("long")), F.lit(0)).alias("expected_frames"))
