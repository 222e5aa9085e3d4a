"""Aggregates of reconstructions: profiles, errors, registration, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallaxis.functions.naming import ratio
from parallaxis.operators.numbering import percentiles


def usable(error: Column) -> Column:
    """Positive and finite (NaN sorts above all numbers in Spark, so it is named)."""
    return (error > 0) & ~F.isnan(error) & (error < float("inf"))


def observations_per_image(images: DataFrame, tracks: DataFrame, image: str, track_image: str) -> DataFrame:
    """``(image, observations)`` of every image, 0 for those without; repeats in a track count."""
    counts = tracks.groupBy(F.col(track_image).alias("_i")).agg(F.count("*").alias("_n"))
    joined = images.select(F.col(image).alias("image")).join(counts, F.col("image") == F.col("_i"), "left")
    return joined.select("image", F.coalesce("_n", F.lit(0)).cast("long").alias("observations"))


def profile(df: DataFrame, value: str) -> DataFrame:
    """One row: min, p05, median, mean, p95, max; zeros for no rows. Percentiles are exact, linear."""
    found = percentiles(df, value, [0.05, 0.5, 0.95]).first()
    p = F.array(*[F.lit(x) for x in (found["p"] if found else (None,) * 3)])
    row = df.agg(F.min(value).alias("min"), F.first(p).alias("p"), F.avg(value).alias("mean"), F.max(value).alias("max"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    least = {x: F.coalesce(F.col(x), F.lit(0).cast(row.schema[x].dataType)) for x in ("min", "max")}
    return row.select(least["min"].alias("min"), zero(F.col("p")[0]).alias("p05"), zero(F.col("p")[1]).alias("median"), zero(F.col("mean")).alias("mean"), zero(F.col("p")[2]).alias("p95"), least["max"].alias("max"))


def error_stats(points: DataFrame, error: str, length: str) -> DataFrame:
    """One row: mean, median, p90, max of positive finite errors, and the observation-weighted mean of all.

    The first four are null where no error is usable; the weighted mean takes
    every error as it is.
    """
    good = F.when(usable(F.col(error)), F.col(error))
    found = percentiles(points.select(good.alias("_e")), "_e", [0.5, 0.9]).first()
    median, p90 = (F.first(F.lit(x).cast("double")) for x in (found["p"] if found else (None, None)))
    return points.agg(F.count(good).alias("usable"), F.avg(good).alias("mean"), median.alias("median"), p90.alias("p90"), F.max(good).alias("max"), ratio(F.sum(F.col(error) * F.col(length)), F.sum(length)).alias("weighted_mean"))


def short_track_fraction(lengths: DataFrame, length: str, most: int = 2) -> DataFrame:
    return lengths.agg(F.coalesce(F.avg((F.col(length) <= most).cast("double")), F.lit(0.0)).alias("short_fraction"))


def mean_lengths(points: DataFrame, length: str, images: int, error: str) -> DataFrame:
    """One row: mean track length, mean observations per image, mean error; 0.0 where empty."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return points.agg(zero(F.avg(length)).alias("mean_track_length"), zero(F.sum(length) / F.lit(images or None)).alias("mean_observations"), zero(F.avg(error)).alias("mean_error"))


def extent(df: DataFrame, axes: list[str], by: list[str] = ()) -> DataFrame:
    """Range of each axis and the length of the diagonal, by group."""
    spans = [(F.max(a) - F.min(a)).alias(f"extent_{a}") for a in axes]
    rows = df.groupBy(*by).agg(*spans)
    return rows.withColumn("diagonal", F.sqrt(sum((F.col(f"extent_{a}") * F.col(f"extent_{a}") for a in axes[1:]), F.col(f"extent_{axes[0]}") * F.col(f"extent_{axes[0]}"))))


def registration(inputs: DataFrame, registered: DataFrame, input_key: Column, registered_key: Column) -> DataFrame:
    """``(key, total, registered, rate)`` of keys on either side, worst first.

    The rate is registered over total, 0.0 for keys without inputs; it may
    exceed 1 as both sides count on their own.
    """
    a = inputs.groupBy(input_key.alias("key")).agg(F.count("*").alias("total"))
    b = registered.groupBy(registered_key.alias("key")).agg(F.count("*").alias("registered"))
    both = a.join(b, "key", "full_outer").select("key", F.coalesce("total", F.lit(0)).cast("long").alias("total"), F.coalesce("registered", F.lit(0)).cast("long").alias("registered"))
    return both.withColumn("rate", ratio(F.col("registered"), F.col("total"))).orderBy("rate", F.desc("total"), "key")


def dead_groups(rates: DataFrame) -> DataFrame:
    return rates.where("total > 0 and registered = 0")


def weak_clips(rates: DataFrame, least_total: int = 10, least_rate: float = 0.5) -> DataFrame:
    return rates.where((F.col("total") >= least_total) & (F.col("rate") < least_rate))


def model_summary(images: DataFrame, points: DataFrame, tracks: DataFrame, model: str = "model") -> DataFrame:
    """Images, points and observations of each model; the primary one has most images, the first on a tie."""
    counts = [d.groupBy(model).agg(F.count("*").alias(n)) for d, n in ((images, "images"), (points, "points"), (tracks, "observations"))]
    rows = counts[0].join(counts[1], model, "full_outer").join(counts[2], model, "full_outer").na.fill(0)
    most = rows.agg(F.max("images").alias("_most"))
    first = rows.join(F.broadcast(most), F.col("images") == F.col("_most")).agg(F.min(model).alias("_primary"))
    return rows.join(F.broadcast(first)).withColumn("is_primary", F.col(model) == F.col("_primary")).drop("_primary")


def primary_model(images: DataFrame, model: str = "model") -> DataFrame:
    """The model of most images, the first by name on a tie."""
    return images.groupBy(model).agg(F.count("*").alias("images")).orderBy(F.desc("images"), model).limit(1)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys on more than one row, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def group_counts(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def verdict(checks: DataFrame) -> DataFrame:
    """One row: whether every check of severity ``fail`` passed, how many failed, how many warnings."""
    failed = (F.col("severity") == "fail") & ~F.col("passed")
    return checks.agg(F.coalesce(F.every(~failed), F.lit(True)).alias("passed"), F.count_if(failed).alias("failures"), F.count_if((F.col("severity") == "warn") & ~F.col("passed")).alias("warnings"))
