import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parallaxis.functions import naming, pose, sharpness
from parallaxis.operators import cluster, clouds, frames, projection, spatial, stats, subset
from parallaxis.schema import BOXES

BOX = {"name": "b", "x0": 0.0, "y0": 0.0, "z0": 0.0, "x1": 10.0, "y1": 10.0, "z1": 10.0}


def cloud(spark, xs):
    return spark.createDataFrame([(float(x), 5.0, 5.0) for x in xs], "x FLOAT, y FLOAT, z FLOAT")


def test_containment_is_inclusive_and_nan_is_outside(spark):
    rows = cloud(spark, [0, 10, 10.5, -1, math.nan])
    assert sorted(r.x for r in spatial.crop(rows, BOX).collect()) == [0.0, 10.0]
    assert [spatial.crop(cloud(spark, [5, 10.5, 14]), BOX, m).count() for m in (0, 1, 5)] == [1, 2, 3]
    with pytest.raises(ValueError, match="inverts"):
        spatial.crop(rows, BOX, -6)


def test_many_boxes_use_the_grid_and_agree(spark, monkeypatch):
    rng = np.random.default_rng(0)
    pts = spark.createDataFrame([(k, *map(float, rng.random(3) * 4)) for k in range(200)], "id LONG, x DOUBLE, y DOUBLE, z DOUBLE")
    corners = [(str(k), *map(float, lo), *map(float, lo + rng.random(3))) for k, lo in enumerate(rng.random((30, 3)) * 4)]
    boxes = spark.createDataFrame(corners, BOXES)
    few = {(r.id, r.name) for r in spatial.in_boxes(pts, boxes).collect()}
    anti = {r.id for r in spatial.in_boxes(pts, boxes, how="left_anti").collect()}
    monkeypatch.setattr(spatial, "FEW_BOXES", 3)
    assert {(r.id, r.name) for r in spatial.in_boxes(pts, boxes).collect()} == few
    assert {r.id for r in spatial.in_boxes(pts, boxes, how="left_anti").collect()} == anti


def test_doorway_image_is_selected_at_its_count(spark):
    boxes = spark.createDataFrame([("b", 20.0, 0.0, 0.0, 28.0, 8.0, 8.0)], BOXES)
    points = spark.createDataFrame([(k, 21.0, 1.0, 1.0) for k in range(40)], "point3d_id LONG, x DOUBLE, y DOUBLE, z DOUBLE")
    tracks = spark.createDataFrame([(k, 7) for k in range(12)] + [(0, 7)], "point3d_id LONG, image_id LONG")
    cams = spark.createDataFrame([(7, 1.0, 0.0, 0.0)], "image_id LONG, cx DOUBLE, cy DOUBLE, cz DOUBLE")
    for least, n in ((12, 1), (13, 0)):
        images, held = spatial.select_for_boxes(points, tracks, cams, boxes, 0.0, least)
        assert (images.count(), held.count()) == (n, 40)


def test_strict_union_names_differences(spark):
    a, b = cloud(spark, [1]), cloud(spark, [2])
    assert clouds.union_strict([a, b]).count() == 2
    with pytest.raises(ValueError, match="extra"):
        clouds.union_strict([a, b.withColumn("extra", F.lit(1.0))])
    with pytest.raises(ValueError, match="order"):
        clouds.union_strict([a, b.select("y", "x", "z")])
    one, two = BOX | {"name": "a"}, BOX | {"x0": 20.0, "x1": 30.0}
    merged, counts = clouds.merge_clouds([(one, cloud(spark, [1, 2, 21])), (two, cloud(spark, [21, 22, 1]))])
    assert sorted(r.x for r in merged.collect()) == [1, 2, 21, 22]
    assert {r.chunk: r.removed for r in counts.collect()} == {"a": 1, "b": 1}


def test_windows_by_position_first_best_and_nan(spark):
    rows = spark.createDataFrame([("c", i * 3, s) for i, s in enumerate([5.0, 5.0, 1.0, 1.0, math.nan, 2.0, 9.0, 30.0])], "clip STRING, i INT, s DOUBLE")
    assert rows.count() == 8
    for size, n in ((2, 4), (4, 2), (0, 8)):
        assert frames.window_frames(rows, ["clip"], "i", size).select("window_id").distinct().count() == n
    got = {r.i: (r.is_window_best, r.keep) for r in frames.select_frames(rows, ["clip"], "i", "s", 2, 4.0).collect()}
    assert got[0] == (True, True) and got[3] == (False, False) and got[12] == (False, False) and got[15] == (True, False)


def test_override_is_by_path_part(spark):
    rules = spark.createDataFrame([("room", 0, 2), ("room/detail", 1, None), ("room/", 2, 8), (".", 3, 5)], "path STRING, declared INT, size INT")
    rows = spark.createDataFrame([("room",), ("room2",), ("room/detail/x",), ("room/a",), ("",)], "p STRING")
    got = {r.p: r.size for r in naming.resolve_override(rows, rules, "p", "size", 4).collect()}
    assert got == {"room": 2, "room2": 5, "room/detail/x": 4, "room/a": 2, "": 5}


def test_names(spark):
    rows = spark.createDataFrame([("g/a_1_000123.jpg",), ("x.jpg",), ("g/h/b_1234567.JPG",)], "n STRING")
    n = F.col("n")
    got = rows.select(naming.frame_clip(n), naming.frame_index(n), naming.group_of(n), naming.inventory_group(n), naming.clip_key(n), naming.suffix(n)).collect()
    assert [tuple(r) for r in got] == [("a_1", 123, "g", "g", "g/a_1", ".jpg"), ("", None, "", "<ungrouped>", "<ungrouped>", ".jpg"), ("", None, "g", "<ungrouped>", "g", ".jpg")]


def test_pose(spark):
    h = math.sqrt(0.5)
    row = spark.createDataFrame([(2 * h, 0.0, 2 * h, 0.0, 1.0, 2.0, 3.0)], "w DOUBLE, x DOUBLE, y DOUBLE, z DOUBLE, tx DOUBLE, ty DOUBLE, tz DOUBLE")
    q = pose.unit_quaternion(*(F.col(c) for c in "wxyz"))
    got = row.select(*pose.camera_center(q, tuple(F.col(c) for c in ("tx", "ty", "tz"))), *pose.view_direction(q)).first()
    r = np.array([[0, 0, 1], [0, 1, 0], [-1, 0, 0]])
    assert np.allclose(got, [*(-r.T @ [1, 2, 3]), *r[2]])
    with pytest.raises(Exception, match="quaternion"):
        row.select(*pose.unit_quaternion(*(F.lit(0.0) for _ in range(4)))).collect()


def test_statistics(spark):
    rows = spark.createDataFrame([(0.0, 2), (math.nan, 3), (-1.0, 4), (2.0, 2), (4.0, 5)], "e DOUBLE, n LONG")
    got = stats.error_stats(rows, "e", "n").first()
    assert (got.usable, got["mean"], got["median"], got["max"]) == (2, 3.0, 3.0, 4.0) and math.isnan(got.weighted_mean)
    none = stats.profile(rows.where("n > 99"), "n").first()
    assert tuple(none) == (0, 0.0, 0.0, 0.0, 0.0, 0)
    checks = spark.createDataFrame([("a", "fail", True), ("b", "warn", False)], "name STRING, severity STRING, passed BOOLEAN")
    assert tuple(stats.verdict(checks).first()) == (True, 0, 1)


def test_votes_break_ties_low_and_noise_is_silent(spark):
    tracks = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (3, 1), (3, 2), (3, 2)], "p LONG, i LONG")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, -1)], "id LONG, label INT")
    assert {r.point: r.label for r in cluster.majority_vote(tracks, labels, "p", "i").collect()} == {1: 0, 2: -1, 3: 1}


def test_dbscan_against_brute_force(spark):
    rng = np.random.default_rng(3)
    xyz = np.concatenate([rng.normal(c, 0.1, (30, 3)) for c in (0, 2, 4)] + [rng.random((20, 3)) * 6])
    rows = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(xyz)], "id LONG, x DOUBLE, y DOUBLE, z DOUBLE")
    near = np.linalg.norm(xyz[:, None] - xyz[None], axis=2) <= 0.3
    core = near.sum(1) >= 5
    label = np.full(len(xyz), -1)
    for k in np.flatnonzero(core):
        if label[k] < 0:
            front, number = [k], label.max() + 1
            while front:
                i = front.pop()
                if label[i] < 0:
                    label[i] = number
                    front += [j for j in np.flatnonzero(near[i] & core) if label[j] < 0]
    for k in np.flatnonzero(~core):
        reach = label[near[k] & core]
        label[k] = reach.min() if len(reach) else -1
    got = {r.id: (r.label, r.is_core) for r in cluster.dbscan(rows, 0.3, 5, "id").collect()}
    assert got == {k: (int(label[k]), bool(core[k])) for k in range(len(xyz))}


def test_collinear_points_have_no_projection(spark):
    line = spark.createDataFrame([(float(k), 2.0 * k, 0.0) for k in range(4)], "x DOUBLE, y DOUBLE, z DOUBLE")
    assert projection.project_top_down(line) is None
    flat = spark.createDataFrame([(float(x), float(y), 1.0) for x in range(4) for y in range(3)], "x DOUBLE, y DOUBLE, z DOUBLE")
    assert projection.planarity(flat).first().planarity == 0.0


def model(spark, mismatch=False):
    cameras = spark.createDataFrame([(1, 1, "PINHOLE", 100, 80, [50.0, 50.0, 50.0, 40.0])], "camera_id LONG, model_id INT, model_name STRING, width LONG, height LONG, params ARRAY<DOUBLE>")
    images = spark.createDataFrame([(k, 1.0, 0.0, 0.0, 0.0, float(k), 0.0, 0.0, 1, f"g/i{k}.jpg", 2) for k in (1, 2, 3)], "image_id LONG, qw DOUBLE, qx DOUBLE, qy DOUBLE, qz DOUBLE, tx DOUBLE, ty DOUBLE, tz DOUBLE, camera_id LONG, name STRING, num_points2d LONG")
    features = spark.createDataFrame([(k, i, 1.0, 2.0, 10 if i == 0 else (9 if mismatch and k == 3 else 11)) for k in (1, 2, 3) for i in (0, 1)], "image_id LONG, point2d_idx INT, x DOUBLE, y DOUBLE, point3d_id LONG")
    points = spark.createDataFrame([(p, 0.0, 0.0, 1.0, 1, 2, 3, 0.5, n) for n, p in enumerate((10, 11))], "point3d_id LONG, x DOUBLE, y DOUBLE, z DOUBLE, r SHORT, g SHORT, b SHORT, error DOUBLE, position LONG")
    tracks = spark.createDataFrame([(10 + i, n, k, i) for i in (0, 1) for n, k in enumerate((1, 2, 3))], "point3d_id LONG, pos INT, image_id LONG, point2d_idx LONG")
    return {"cameras": cameras, "images": images, "features": features, "points": points, "tracks": tracks}


def test_validation_codes(spark):
    assert subset.validate(model(spark)).count() == 0
    assert [r.code for r in subset.validate(model(spark, True)).collect()] == ["track_point2d_mismatch"]
    m = model(spark)
    m["tracks"] = m["tracks"].unionByName(spark.createDataFrame([(10, 3, 99, 0)], m["tracks"].schema))
    assert [r.code for r in subset.validate(m).collect()] == ["track_unknown_image"]


def test_subset_stays_consistent(spark):
    m = model(spark)
    images = spark.createDataFrame([(1,), (2,), (77,)], "image_id LONG")
    points = spark.createDataFrame([(10,)], "point3d_id LONG")
    cut = subset.subset_model(m, images, points)
    assert [cut[t].count() for t in ("cameras", "images", "features", "points", "tracks")] == [1, 2, 4, 1, 2]
    assert {(r.point2d_idx, r.point3d_id) for r in cut["features"].collect()} == {(0, 10), (1, None)}
    assert subset.validate(cut).count() == 0


def test_sharpness_orders_images():
    rng = np.random.default_rng(0)
    noisy, flat = rng.integers(0, 255, (20, 20)), np.full((20, 20), 7)
    assert sharpness.laplacian_variance(noisy) > sharpness.laplacian_variance(flat) == 0


def test_percentiles_by_rank_equal_those_of_numpy(spark, monkeypatch):
    from parallaxis.operators import clouds, numbering

    rng = np.random.default_rng(2)
    rows = [(int(k % 3), float(v)) for k, v in enumerate(np.round(rng.normal(size=200), 1))] + [(3, 5.0), (4, None)]
    df = spark.createDataFrame(rows, "g INT, v DOUBLE").repartition(3)
    shares = [0.0, 0.02, 0.5, 0.95, 1.0]
    for few in (1 << 16, 0):
        monkeypatch.setattr(numbering, "FEW_VALUES", few)
        got = {r.g: r.p for r in numbering.percentiles(df, "v", shares, ["g"]).collect()}
        assert set(got) == {0, 1, 2, 3}
        for g in got:
            assert np.allclose(got[g], np.quantile([v for k, v in rows if k == g], shares))
        assert np.allclose(numbering.percentiles(df, "v", shares).first().p, np.quantile([v for _, v in rows if v is not None], shares))
        assert numbering.percentiles(df.limit(0), "v", shares).count() == 0
    ends = {r.k: (r.track_start, r.track_end) for r in clouds.track_offsets(spark.createDataFrame([(k, k % 4) for k in range(50)], "k LONG, n LONG"), "k", "n").collect()}
    assert ends == {k: (sum(j % 4 for j in range(k)), sum(j % 4 for j in range(k + 1))) for k in range(50)}
