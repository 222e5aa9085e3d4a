"""The pipeline's data commands as plans over DataFrames, each ending in bounded reports.

Exit codes: 0 fine, 1 failed checks or inputs, 3 nothing to judge.
"""

from __future__ import annotations

import datetime
import os
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallaxis.functions import naming, pose
from parallaxis.functions.sharpness import sharpness
from parallaxis.operators import cluster, clouds, covisibility, frames, projection, spatial, stats, subset
from parallaxis.runtime import cut_lineage
from parallaxis.sources import files, models, ply
from parallaxis.sources.records import FormatError

OK, FAILED, UNVERIFIABLE = 0, 1, 3


def _now() -> str:
    return datetime.datetime.now(datetime.timezone.utc).isoformat()


def camera_poses(images: DataFrame) -> DataFrame:
    """Images with centre (cx, cy, cz) and viewing direction (dx, dy, dz)."""
    q = pose.unit_quaternion(*(F.col(c) for c in ("qw", "qx", "qy", "qz")))
    values = (*pose.camera_center(q, tuple(F.col(c) for c in ("tx", "ty", "tz"))), *pose.view_direction(q))
    return images.withColumns(dict(zip(("cx", "cy", "cz", "dx", "dy", "dz"), values, strict=True)))


def plan_extraction(clips: DataFrame, overrides: DataFrame, fps: float, done: DataFrame | None = None) -> DataFrame:
    """Extraction jobs of ``(path, rel_path, duration)``: folder, stem, rate by override, frames expected, state.

    The completion key is folder and stem, so of clips that differ in suffix
    only, the second counts as done once the first is.
    """
    rows = clips.select("path", "rel_path", "duration", naming.parent(F.col("rel_path")).alias("out_dir"), naming.stem(F.col("rel_path")).alias("clip_stem"))
    rows = naming.resolve_override(rows, overrides.select("path", "declared", "fps"), "out_dir", "fps", fps)
    rows = rows.withColumn("expected_frames", naming.expected_frames(F.col("duration"), F.col("fps")))
    if done is None:
        return rows.withColumn("state", F.lit("pending"))
    marks = done.select("out_dir", "clip_stem", F.lit(True).alias("_m")).distinct()
    return rows.join(marks, ["out_dir", "clip_stem"], "left").withColumn("state", F.when(F.col("_m"), "skipped").otherwise("pending")).drop("_m")


def score_frames(spark: SparkSession, root: str) -> DataFrame:
    """Frames below ``root`` with their sharpness score."""
    listed = files.list_frames(spark, root)
    images = files.read_images(spark, root).withColumn("sharpness_score", sharpness("data", "height", "width", "nChannels"))
    plain = lambda c: F.regexp_replace(c, r"^[a-z0-9]+:/*", "/")
    scored = images.select(plain("path").alias("_k"), "sharpness_score")
    return listed.withColumn("_k", plain("path")).join(scored, "_k").drop("_k")


def select(scored: DataFrame, overrides: DataFrame, window_size: int, threshold: float) -> DataFrame:
    """Scored frames with their window and decision; window sizes by folder override."""
    rows = naming.resolve_override(scored, overrides.select("path", "declared", "window_size"), "relative_dir", "window_size", window_size)
    return frames.select_frames(rows, ["relative_dir", "clip"], "frame_index", "sharpness_score", "window_size", threshold).drop("window_size")


def organize(images: DataFrame, existing: DataFrame | None = None, grouped: bool = True, suspicious: int = 20) -> tuple[DataFrame, DataFrame]:
    """Copy plan and group counts of ``(path, rel_path, kind, width, height)``; unreadable images (null sizes) are left out."""
    named = images.where("width is not null").withColumn("grp", naming.resolution_label(F.col("width"), F.col("height"), F.col("kind"), grouped))
    named = named.withColumn("name", F.element_at(F.split("rel_path", "/"), -1))
    plan = frames.plan_copies(named, "grp", "name", [F.desc("kind"), F.split("rel_path", "/")], existing)
    counts = stats.group_counts(plan, "grp").withColumn("suspicious", F.col("n") < suspicious)
    return plan, counts


def _check(name, severity, passed, detail, remedy=""):
    return (name, severity, bool(passed), detail, remedy)


def _unverifiable(reason: str, out: str | None, more: dict | None = None) -> tuple[int, dict]:
    """Exit code and report of a run that has nothing to judge; the report is written too."""
    report = {"schema_version": 1, "generated_at": _now(), "status": "unverifiable", "exit_code": UNVERIFIABLE, "reason": reason, **(more or {})}
    if out:
        os.makedirs(out, exist_ok=True)
        files.write_json(report, os.path.join(out, "verify_report.json"))
    return UNVERIFIABLE, report


def verify(spark: SparkSession, candidates: list[str], inputs: DataFrame, settings=None, out: str | None = None, database: str | None = None, model_name: str | None = None, **flags) -> tuple[int, dict]:
    """Judge reconstructions against their inputs: exit code and report; files go to ``out``.

    ``inputs`` is ``(rel_path)`` of the images given; ``settings`` are
    ``files.Settings`` or a mapping of the keys of section ``verify``, and
    ``flags`` of those names win over them. The report holds counts, profiles
    and checks only; pairs and rates go to their own files.
    """
    own = files.options("verify", settings, **flags)
    report: dict = {"schema_version": 1, "generated_at": _now(), "checks": []}
    checks = []
    total = inputs.count()
    if not candidates or not total:
        return _unverifiable("no model" if not candidates else "no input images", out)
    names = [os.path.basename(p.rstrip("/")) for p in candidates]
    try:
        model = {k: cut_lineage(v) for k, v in models.read_model(spark, candidates, features=False).items()}
    except (FormatError, PySparkException, Py4JError) as e:
        return _unverifiable(f"the model could not be read: {str(e).splitlines()[0]}", out)
    issues = [r.asDict() for n in names for r in subset.validate({k: v.where(F.col("model") == n) for k, v in model.items()}, features=False).collect()]
    if any(i["severity"] == "error" for i in issues):
        return _unverifiable("the model contradicts itself", out, {"issues": issues})
    summary = stats.model_summary(model["images"], model["points"], model["tracks"])
    report["models"] = [r.asDict() for r in summary.orderBy("model").collect()]
    primary = model_name or next((r["model"] for r in report["models"] if r["is_primary"]), None)
    if primary not in names:
        return _unverifiable(f"no model {primary}", out)
    images, points, tracks = (model[t].where(F.col("model") == primary) for t in ("images", "points", "tracks"))
    in_database = files.database_image_count(database) if database else None
    strays = inputs.where(naming.inventory_group(F.col("rel_path")) == "<ungrouped>")
    n_strays = strays.count()
    report["inventory"] = {"total": total, "database_images": in_database, "per_group": {r["g"]: r["n"] for r in inputs.groupBy(naming.inventory_group(F.col("rel_path")).alias("g")).agg(F.count("*").alias("n")).orderBy("g").collect()}, "stray_files": [r[0] for r in strays.select("rel_path").orderBy("rel_path").limit(50).collect()]}
    if in_database is not None:
        checks.append(_check("database_gap", "warn", in_database >= total, f"{in_database} of {total} images were ingested"))
    checks.append(_check("stray_images", "warn", not n_strays, f"{n_strays} images are outside groups"))
    checks.append(_check("single_model", "fail", len(candidates) == 1, f"{len(candidates)} models"))
    registered = model["images"].agg(F.countDistinct("name")).first()[0]
    rate = registered / total
    checks.append(_check("non_empty", "fail", report["models"] and images.count() > 0, f"{registered} registered"))
    checks.append(_check("registration_rate", "fail", rate >= own["min_registration_rate"], f"{rate:.3f}"))
    if rate >= own["min_registration_rate"]:
        checks.append(_check("registration_rate_warn", "warn", rate >= own["warn_registration_rate"], f"{rate:.3f}"))
    known = model["images"].select("name").distinct()
    by_group = stats.registration(inputs, known, naming.inventory_group(F.col("rel_path")), naming.group_of(F.col("name"), "<ungrouped>"))
    by_clip = stats.registration(inputs, known, naming.clip_key(F.col("rel_path")), naming.clip_key(F.col("name")))
    dead = [r["key"] for r in stats.dead_groups(by_group).limit(5).collect()]
    weak = [r["key"] for r in stats.weak_clips(by_clip).limit(5).collect()]
    checks += [_check("group_coverage", "fail", not dead, ", ".join(dead)), _check("clip_coverage", "warn", not weak, ", ".join(weak))]
    lengths = cut_lineage(points.join(tracks.groupBy("point3d_id").agg(F.count("*").alias("length")), "point3d_id", "left").select("point3d_id", "x", "y", "z", "error", F.coalesce("length", F.lit(0)).alias("length")))
    errors = stats.error_stats(lengths, "error", "length").first().asDict()
    report["reprojection_error"] = errors if errors["usable"] else None
    checks.append(_check("reprojection_error", "warn", errors["usable"] and errors["mean"] <= own["warn_mean_reprojection_error"], "unavailable" if not errors["usable"] else f"mean {errors['mean']:.3f}"))
    report["short_track_fraction"] = stats.short_track_fraction(lengths, "length").first()[0]
    seen = cut_lineage(stats.observations_per_image(images, tracks, "image_id", "image_id"))
    report["observations"] = stats.profile(seen, "observations").first().asDict()
    n_weak = seen.where(F.col("observations") < own["min_observations_per_image"]).count()
    checks.append(_check("weak_images", "warn", not n_weak, f"{n_weak} images with few observations"))
    posed = cut_lineage(camera_poses(images))
    report["extent"] = stats.extent(posed, ["cx", "cy", "cz"]).first().asDict()
    flat = projection.planarity(posed.select(F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("cz").alias("z"))).first()
    report["projection"] = flat.asDict() if flat["planarity"] is not None else None
    threshold = own["min_common_points"]
    report["tracks"] = covisibility.track_guard_stats(tracks, "point3d_id", "image_id", own["max_track_length"]).first().asDict()
    pairs = cut_lineage(covisibility.covisible_pairs(tracks, "point3d_id", "image_id", own["max_track_length"]))
    nodes = images.select(F.col("image_id").alias("image"))
    labels = cut_lineage(covisibility.label_components(covisibility.component_members(pairs, nodes, threshold)))
    sizes = labels.groupBy("component").agg(F.count("*").alias("size"))
    large = sizes.where(F.col("size") >= own["min_component_size"]).count()
    report["components"] = {"count": sizes.count(), "large": large, "largest": [r["size"] for r in sizes.orderBy(F.desc("size")).limit(10).collect()]}
    report["threshold_curve"] = [r.asDict() for r in covisibility.threshold_curve(pairs, nodes, list(own["component_thresholds"])).collect()]
    checks.append(_check("connectivity", "fail", large <= 1, f"{large} separate parts", "capture the boundary between the parts again"))
    misses = covisibility.near_misses(pairs, labels, threshold)
    open_pairs = covisibility.unlinked_components(labels, misses)
    located = posed.join(labels, posed["image_id"] == labels["image"]).select("image", "component", "cx", "cy", "cz", "dx", "dy", "dz")
    spatial_pairs = covisibility.nearest_across(located, own["spatial_neighbors_per_image"], own["max_view_angle_deg"], open_pairs)
    none = F.lit(None).cast("double")
    both = misses.select(F.col("lo").alias("a"), F.col("hi").alias("b"), F.col("component_lo").alias("component_a"), F.col("component_hi").alias("component_b"), F.col("shared").alias("shared_points"), none.alias("distance"), none.alias("view_angle_deg"), F.lit("shared_points").alias("source"))
    both = both.unionByName(spatial_pairs.select(F.col("image").alias("a"), F.col("neighbour").alias("b"), "component_a", "component_b", F.lit(0).cast("long").alias("shared_points"), "distance", "view_angle_deg", F.lit("spatial").alias("source")))
    for c in ("a", "b"):
        both = both.join(images.select(F.col("image_id").alias(c), F.col("name").alias(f"name_{c}")), c)
    matched = files.matched_pairs(spark, database, images) if database else None
    if matched is not None:
        matched = matched.select(F.col("a").alias("name_a"), F.col("b").alias("name_b"))
    both = cut_lineage(covisibility.split_matched(both, matched, "name_a", "name_b"))
    picked = cut_lineage(pick_candidates(both, own["pairs_per_component_pair"], own["max_pair_candidates"]))
    report["candidates"] = {"boundary_pairs": both.count(), "already_matched": both.where("already_matched").count(), "selected": picked.count()}
    judged = spark.createDataFrame(checks, "name STRING, severity STRING, passed BOOLEAN, detail STRING, remediation STRING")
    result = stats.verdict(judged).first()
    report |= {"status": "passed" if result["passed"] else "failed", "warnings": result["warnings"], "checks": [r.asDict() for r in judged.collect()], "issues": issues}
    if out:
        os.makedirs(out, exist_ok=True)
        files.write_json(report, os.path.join(out, "verify_report.json"))
        files.write_csv(by_group, os.path.join(out, "registration_by_group.csv"))
        files.write_csv(both.orderBy("component_a", "component_b", *_strongest()), os.path.join(out, "boundary_candidates.csv"))
        new = picked.select(F.concat_ws(" ", F.least("name_a", "name_b"), F.greatest("name_a", "name_b")).alias("line")).distinct()
        files.write_lines(new, os.path.join(out, "candidate_pairs.txt"))
        for n in names if len(names) > 1 else []:
            files.write_lines(model["images"].where(F.col("model") == n).select("name"), os.path.join(out, f"model_{n}_images.txt"))
    return (OK if result["passed"] else FAILED), report


def _strongest() -> list:
    """Order of candidates of two components: shared points first, the nearest next."""
    return ["source", F.desc_nulls_last("shared_points"), F.asc_nulls_last("distance"), "a", "b"]


def pick_candidates(pairs: DataFrame, per_pair: int, most: int) -> DataFrame:
    """Pairs to match next: those that aren't matched yet, in turns over the components' pairs, ``most`` in all."""
    new = pairs.where("already_matched is null or not already_matched")
    return covisibility.interleave(new, ["component_a", "component_b"], _strongest(), per_pair, most)


def suggest(model: dict[str, DataFrame], method: str = "dbscan", eps: float = 1.0, min_samples: int = 5, k: int = 4, trim: float = 2.0, padding: float = 0.5) -> DataFrame:
    """Boxes proposed by clustering camera centres and letting tracks vote on points."""
    posed = camera_poses(model["images"]).select("image_id", F.col("cx").alias("x"), F.col("cy").alias("y"), F.col("cz").alias("z"))
    labels = cluster.dbscan(posed, eps, min_samples, "image_id") if method == "dbscan" else cluster.kmeans(posed, k, "image_id")
    labels = cut_lineage(labels.select("id", "label"))
    voted = cluster.majority_vote(model["tracks"], labels, "point3d_id", "image_id").withColumnRenamed("point", "point3d_id")
    return cluster.suggest_boxes(posed.join(labels, F.col("image_id") == F.col("id")), model["points"].join(voted, "point3d_id"), trim=trim, padding=padding)


def chunk(model: dict[str, DataFrame], boxes: DataFrame, margin: float | None = None, least: int | None = None, out: str | None = None, settings=None) -> tuple[int, dict]:
    """Cut one model into the boxes' sub-models, all at once; writes each with a manifest, and an index.

    A box without images or points fails alone. Orphans are points in no box
    itself (not grown by the margin). ``margin`` and ``least`` win over the
    settings' section ``chunk``.
    """
    own = files.options("chunk", settings, point_margin=margin, min_points_in_box=least)
    margin, least = own["point_margin"], own["min_points_in_box"]
    cameras = camera_poses(model["images"]).select("image_id", "cx", "cy", "cz")
    picked, held = (cut_lineage(x) for x in spatial.select_for_boxes(model["points"], model["tracks"], cameras, boxes, margin, least))
    n_images = {r["box"]: r["n"] for r in picked.groupBy("box").agg(F.count("*").alias("n")).collect()}
    n_points = {r["box"]: r["n"] for r in held.groupBy("box").agg(F.count("*").alias("n")).collect()}
    parts = subset.subset_model(model, picked.select("box", "image_id"), held, own["min_track_length"])
    index, failed = [], []
    for box in boxes.orderBy("name").collect():
        name = box["name"]
        if not n_images.get(name) or not n_points.get(name):
            failed.append(name)
            continue
        one = {t: d.where(F.col("box") == name) for t, d in parts.items()}
        row = {"name": name, "num_images": n_images[name], "num_points": one["points"].count()}
        if out:
            models.write_model(one, os.path.join(out, name, "sparse"))
            manifest = {"schema_version": 1, "generated_at": _now(), **row, "box": {"name": name, "min": [box[c] for c in spatial.LOW], "max": [box[c] for c in spatial.HIGH]}}
            files.write_json(manifest | {"images": [r[0] for r in one["images"].select("name").orderBy("name").collect()]}, os.path.join(out, name, "manifest.json"))
        index.append(row)
    total = model["images"].count()
    report = {"generated_at": _now(), "chunks": index, "failed": failed, "orphan_points": spatial.in_boxes(model["points"], boxes, how="left_anti").count(), "overlap_factor": sum(r["num_images"] for r in index) / total if total else 0.0}
    if out:
        files.write_json(report, os.path.join(out, "chunks.json"))
    return (FAILED if failed else OK if index else UNVERIFIABLE), report


def merge(spark: SparkSession, root: str, cloud_name: str | None = None, path: str | None = None, margin: float | None = None, crop: bool = True, settings=None) -> tuple[int, dict]:
    """Crop every trained chunk below ``root`` to its box (unless ``crop`` is off) and write one cloud.

    Untrained or unreadable manifests are problems that don't stop the rest;
    an unreadable cloud, or a box that the margin inverts, makes the exit code
    1, but the others are written. The header keeps the first cloud's comments.
    """
    own = files.options("merge", settings, ply_name=cloud_name, crop_margin=margin)
    found, problems = files.load_manifests(root, own["ply_name"])
    chunks, bad, comments = [], [], None
    for row in found:
        try:
            cloud = ply.read_ply(spark, row["cloud"])
            if crop:
                spatial.crop(cloud, row, own["crop_margin"])
            own_comments = ply.read_header(row["cloud"])["comments"]
        except (FormatError, OSError, ValueError) as e:
            bad.append(f"{row['name']}: {e}")
            continue
        chunks.append((row, cloud))
        comments = own_comments if comments is None else comments
    if not chunks:
        return UNVERIFIABLE if not bad else FAILED, {"problems": problems + bad}
    try:
        cloud, counts = clouds.merge_clouds(chunks, own["crop_margin"], crop)
    except ValueError as e:
        return FAILED, {"problems": [*problems, *bad, str(e)]}
    rows = [r.asDict() for r in counts.orderBy("chunk").collect()]
    written = ply.write_ply(cloud, path or os.path.join(root, own["output_name"]), [*comments, "merged"])
    return (FAILED if bad else OK), {"problems": problems + bad, "chunks": rows, "written": written, "before": reduce(lambda a, r: a + r["before"], rows, 0)}
