"""Boxes and points: containment, range joins, per-box selection, bounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallaxis.operators.numbering import percentiles

LOW, HIGH = ("x0", "y0", "z0"), ("x1", "y1", "z1")
#: Up to so many boxes every row is tested against all of them; more boxes meet points by grid cell.
FEW_BOXES = 1024


def contains(point: tuple[Column, ...], low: tuple[Column, ...], high: tuple[Column, ...]) -> Column:
    """Inside or on a face. Both bounds of every axis are tested, so NaN is never inside."""
    tests = [(p >= a) & (p <= b) for p, a, b in zip(point, low, high, strict=True)]
    return reduce(lambda a, b: a & b, tests)


def expand(boxes: DataFrame, margin: float) -> DataFrame:
    """Boxes grown by ``margin`` on all sides; a negative margin that inverts one raises."""
    if not margin:
        return boxes
    grown = boxes.withColumns({c: F.col(c) - margin for c in LOW} | {c: F.col(c) + margin for c in HIGH})
    if margin > 0:
        return grown
    bad = reduce(lambda a, b: a | b, [F.col(b) < F.col(a) for a, b in zip(LOW, HIGH, strict=True)])
    return grown.withColumn("x0", F.when(bad, F.raise_error(F.concat(F.lit("margin inverts box "), F.col("name"))).cast("double")).otherwise(F.col("x0")))


def with_geometry(boxes: DataFrame) -> DataFrame:
    """Extent, volume and centre of each box."""
    sides = {f"extent_{h[0]}": F.col(h) - F.col(a) for a, h in zip(LOW, HIGH, strict=True)}
    centre = {f"center_{h[0]}": (F.col(a) + F.col(h)) / 2 for a, h in zip(LOW, HIGH, strict=True)}
    volume = reduce(lambda a, b: a * b, sides.values())
    return boxes.withColumns(sides | centre | {"volume": volume})


def in_boxes(points: DataFrame, boxes: DataFrame, axes=("x", "y", "z"), how: str = "inner", cell: float | None = None) -> DataFrame:
    """Points joined to the boxes that hold them (``left_anti``: points in none).

    Few boxes (counted first) are broadcast and tested against every point.
    Beyond ``FEW_BOXES`` boxes and points meet in grid cells of size ``cell``
    (the boxes' mean extent by default), an equi-join that is tested again.
    """
    few = boxes.limit(FEW_BOXES + 1).count() <= FEW_BOXES
    inside = lambda p, b: contains(tuple(p[a].cast("double") for a in axes), tuple(b[c] for c in LOW), tuple(b[c] for c in HIGH))
    if few:
        return points.join(F.broadcast(boxes), inside(points, boxes), how)
    if cell is None:
        sizes = boxes.agg(*[F.avg(F.col(b) - F.col(a)) for a, b in zip(LOW, HIGH, strict=True)]).first()
        cell = max([x for x in sizes if x] or [1.0])
    at = lambda c: F.floor(c.cast("double") / cell)
    spread = boxes
    for k in range(3):
        spread = spread.withColumn(f"_c{k}", F.explode(F.sequence(at(F.col(LOW[k])), at(F.col(HIGH[k])))))
    placed = points.withColumns({f"_p{k}": F.when(~F.isnan(F.col(a).cast("double")) & (F.abs(F.col(a)) < 1e15), at(F.col(a))) for k, a in enumerate(axes)})
    same = [placed[f"_p{k}"] == spread[f"_c{k}"] for k in range(3)]
    out = placed.join(spread, reduce(lambda a, b: a & b, same) & inside(placed, spread), how)
    return out.drop(*[f"_p{k}" for k in range(3)], *[f"_c{k}" for k in range(3)])


def crop(cloud: DataFrame, box: dict, margin: float = 0.0, axes=("x", "y", "z")) -> DataFrame:
    """Rows inside one box grown by ``margin``; values keep their types, the test is in double."""
    low, high = [box[c] - margin for c in LOW], [box[c] + margin for c in HIGH]
    if any(b < a for a, b in zip(low, high, strict=True)):
        raise ValueError(f"margin {margin} inverts box {box.get('name')}")
    return cloud.where(contains(tuple(F.col(a).cast("double") for a in axes), tuple(map(F.lit, low)), tuple(map(F.lit, high))))


def select_for_boxes(points: DataFrame, tracks: DataFrame, cameras: DataFrame, boxes: DataFrame, margin: float = 0.0, least: int = 1) -> tuple[DataFrame, DataFrame]:
    """Images and points of every box in one pass: ``(box, image_id, is_inside, n_in_box)`` and ``(box, point3d_id)``.

    Points use the box grown by ``margin``, camera centres (image_id, cx, cy,
    cz) the box itself. An image belongs to a box if its camera is inside or
    it observes at least ``least`` of the box's points (each counted once).
    """
    held = in_boxes(points, expand(boxes, margin)).select(F.col("name").alias("box"), "point3d_id")
    seen = held.join(tracks.select("point3d_id", "image_id").distinct(), "point3d_id").groupBy("box", "image_id").agg(F.count("*").alias("n_in_box"))
    inside = in_boxes(cameras, boxes, ("cx", "cy", "cz")).select(F.col("name").alias("box"), "image_id").distinct().withColumn("is_inside", F.lit(True))
    both = inside.join(seen, ["box", "image_id"], "full_outer").select("box", "image_id", F.coalesce("is_inside", F.lit(False)).alias("is_inside"), F.coalesce("n_in_box", F.lit(0)).cast("long").alias("n_in_box"))
    return both.where(F.col("is_inside") | (F.col("n_in_box") >= least)), held


def bounds(points: DataFrame, axes: list[str], by: list[str], trim: float = 0.0) -> DataFrame:
    """Box of each group: min and max, or the exact percentiles ``trim`` and 100 - ``trim`` of each axis."""
    if trim:
        rows = None
        for a in axes:
            found = percentiles(points, a, [trim / 100, 1 - trim / 100], by).withColumnRenamed("p", a)
            rows = found if rows is None else rows.join(found, by, "full_outer")
        return rows.select(*by, *[F.col(a)[0].alias(f"{a}_low") for a in axes], *[F.col(a)[1].alias(f"{a}_high") for a in axes])
    return points.groupBy(*by).agg(*[F.min(a).alias(f"{a}_low") for a in axes], *[F.max(a).alias(f"{a}_high") for a in axes])


def box_warnings(counts: DataFrame, most_points: int, most_images: int, least_points: int = 100) -> DataFrame:
    """Boxes beyond the budget: too many points, too few, too many images."""
    kinds = F.array_compact(F.array(F.when(F.col("points") > most_points, F.lit("too_many_points")), F.when(F.col("points") < least_points, F.lit("too_few_points")), F.when(F.col("images") > most_images, F.lit("too_many_images"))))
    return counts.withColumn("warning", F.explode(kinds))


def overlap_factor(box_images: DataFrame, total_images: int) -> DataFrame:
    """One row: images over all boxes, and that over the model's images."""
    return box_images.agg(F.count("*").alias("box_images"), (F.count("*") / F.lit(total_images) if total_images else F.lit(0.0)).alias("overlap_factor"))
