"""Referentially consistent subsets of a model, and model validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallaxis.functions.naming import first_examples


def subset_tracks(tracks: DataFrame, keep_images: DataFrame, keep_points: DataFrame, least: int = 2) -> DataFrame:
    """Track elements of kept points in kept images, of points that ``least`` elements are left of.

    The keeps may carry a ``box`` column: then every box is cut at once.
    Elements repeat as in the tracks; ids that don't exist are ignored.
    """
    by = ["box"] if "box" in keep_images.columns else []
    kept = tracks.join(keep_points.distinct(), "point3d_id") if by else tracks.join(keep_points, "point3d_id", "left_semi")
    kept = kept.join(keep_images.select("image_id", *by).distinct(), ["image_id", *by], "left_semi")
    sizes = kept.groupBy("point3d_id", *by).agg(F.count("*").alias("_n")).where(F.col("_n") >= least).drop("_n")
    return kept.join(sizes, ["point3d_id", *by], "left_semi")


def subset_features(features: DataFrame, keep_images: DataFrame, tracks: DataFrame) -> DataFrame:
    """All features of kept images; references to points that are gone become null, positions stay."""
    by = ["box"] if "box" in keep_images.columns else []
    alive = tracks.select(F.col("point3d_id").alias("_p"), *by).distinct()
    rows = features.join(keep_images.select("image_id", *by).distinct(), "image_id")
    on = [rows["point3d_id"] == alive["_p"], *[rows[c] == alive[c] for c in by]]
    joined = rows.join(alive, reduce(lambda a, b: a & b, on), "left")
    return joined.select(*[rows[c] for c in rows.columns if c != "point3d_id"], F.col("_p").alias("point3d_id"))


def subset_model(model: dict[str, DataFrame], keep_images: DataFrame, keep_points: DataFrame, least: int = 2) -> dict[str, DataFrame]:
    """Cameras, images, features, points and tracks of the subset (see the parts)."""
    by = ["box"] if "box" in keep_images.columns else []
    images = model["images"].join(keep_images.select("image_id", *by).distinct(), "image_id")
    tracks = subset_tracks(model["tracks"], keep_images, keep_points, least)
    points = model["points"].join(tracks.select("point3d_id", *by).distinct(), "point3d_id")
    cameras = model["cameras"].join(images.select("camera_id", *by).distinct(), "camera_id")
    return {"cameras": cameras, "images": images, "features": subset_features(model["features"], keep_images, tracks), "points": points, "tracks": tracks}


def missing_cameras(images: DataFrame, cameras: DataFrame) -> DataFrame:
    return images.join(cameras, "camera_id", "left_anti")


def subset_stats(before: dict[str, DataFrame], after: dict[str, DataFrame]) -> DataFrame:
    """Counts of images, points and track elements before and after."""
    rows = [d[t].agg(F.lit(t).alias("table"), F.lit(w).alias("state"), F.count("*").alias("n")) for w, d in (("before", before), ("after", after)) for t in ("images", "points", "tracks")]
    return reduce(DataFrame.unionByName, rows).groupBy("table").agg(*[F.sum(F.when(F.col("state") == w, F.col("n"))).alias(w) for w in ("before", "after")])


def unknown_cameras(images: DataFrame, cameras: DataFrame) -> DataFrame:
    return images.join(cameras, "camera_id", "left_anti")


def unknown_track_images(tracks: DataFrame, images: DataFrame) -> DataFrame:
    return tracks.join(images, "image_id", "left_anti")


def out_of_range(tracks: DataFrame, images: DataFrame) -> DataFrame:
    """Track elements past the end of their image's features."""
    return tracks.join(images.select("image_id", "num_points2d"), "image_id").where("point2d_idx >= num_points2d")


def mismatched(tracks: DataFrame, features: DataFrame) -> DataFrame:
    """Track elements whose feature does not point back."""
    f = features.select("image_id", F.col("point2d_idx").cast("long").alias("point2d_idx"), F.col("point3d_id").alias("_back"), F.lit(True).alias("_is"))
    return tracks.join(f, ["image_id", "point2d_idx"]).where(~F.col("_back").eqNullSafe(F.col("point3d_id")))


def _issue(rows: DataFrame, severity: str, code: str, example) -> DataFrame:
    named = rows.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), example.alias("_example"))
    keys = ["severity", "code"]
    counts = named.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.join(first_examples(named, keys, "_example", "message"), keys, "left").select(*keys, F.coalesce("message", F.lit("")).alias("message"), "n")


def validate(model: dict[str, DataFrame], features: bool = True) -> DataFrame:
    """``(severity, code, message, n)`` of what is wrong with a model.

    The range and back-reference checks run only if all track images are
    known, the latter only with ``features``. Focal lengths at most 0 or above
    ten widths, and tracks of fewer than two elements, are warnings.
    """
    images, cameras, tracks = model["images"], model["cameras"], model["tracks"]
    strangers = unknown_track_images(tracks, images)
    issues = [_issue(unknown_cameras(images, cameras), "error", "unknown_camera_id", F.col("image_id")), _issue(strangers, "error", "track_unknown_image", F.col("point3d_id"))]
    if strangers.isEmpty():
        issues.append(_issue(out_of_range(tracks, images), "error", "track_index_out_of_range", F.col("point3d_id")))
        if features:
            issues.append(_issue(mismatched(tracks, model["features"]), "error", "track_point2d_mismatch", F.col("point3d_id")))
    sizes = model["points"].select("point3d_id").join(tracks.groupBy("point3d_id").agg(F.count("*").alias("n")), "point3d_id", "left")
    issues.append(_issue(sizes.where("coalesce(n, 0) < 2"), "warning", "degenerate_track", F.col("point3d_id")))
    focal = focal_lengths(cameras)
    bad = focal.where((F.col("fx") <= 0) | (F.col("fy") <= 0) | (F.col("fx") > F.col("width") * 10) | (F.col("fy") > F.col("width") * 10))
    issues.append(_issue(bad, "warning", "implausible_intrinsics", F.col("camera_id")))
    return reduce(DataFrame.unionByName, issues)


def focal_lengths(cameras: DataFrame) -> DataFrame:
    """Cameras with named parameters ``named`` (a map), fx, fy, cx and cy."""
    from parallaxis.schema import camera_models

    specs = F.broadcast(camera_models(cameras.sparkSession).select("model_id", "param_names"))
    rows = cameras.join(specs, "model_id").withColumn("named", F.map_from_arrays("param_names", "params"))
    get = lambda k: F.try_element_at("named", F.lit(k))
    return rows.withColumns({"fx": F.coalesce(get("f"), get("fx")), "fy": F.coalesce(get("f"), get("fy")), "cx": get("cx"), "cy": get("cy")}).drop("param_names")
