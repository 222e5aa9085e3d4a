"""Exact nearest neighbours of points in space: kd leaves in a task, chunks of space between tasks.

A leaf or chunk is left out only if its box is farther than the k-th
neighbour found. The gap to a box is computed as the distance is, step by
step, so rounding can't put it above the distance of a point inside.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallaxis.functions import pose
from parallaxis.operators.numbering import number_rows

AT = ("cx", "cy", "cz")
#: Points of a leaf at least, places that descend together, nodes that they have open at a time.
LEAF, TOGETHER, OPEN = 24, 1 << 13, 1 << 18
#: Points of a chunk and queries of a task; a component of more points is cut along a space-filling curve.
CHUNK, QUERIES = 1 << 18, 1 << 18


class Tree:
    """A balanced kd tree: level j has 2^j nodes, node i holds the places ``i * m >> j`` to ``(i + 1) * m >> j`` of ``order``."""

    def __init__(self, points: np.ndarray, least: int):
        m, depth = len(points), 0
        while m >> depth + 1 >= least:
            depth += 1
        self.order = np.arange(m)
        for level in range(depth):
            for i in range(1 << level):
                begin, middle, end = i * m >> level, (2 * i + 1) * m >> level + 1, (i + 1) * m >> level
                rows = self.order[begin:end]
                own = points[rows]
                self.order[begin:end] = rows[np.argpartition(own[:, np.argmax(own.max(0) / 2 - own.min(0) / 2)], middle - begin)]
        begin = np.arange((1 << depth) + 1) * m >> depth
        sizes = np.diff(begin)
        held = begin[:-1, None] + np.minimum(np.arange(sizes.max()), sizes[:, None] - 1)
        self.held, self.filled = self.order[held], np.arange(sizes.max()) < sizes[:, None]
        low, high = (f.reduceat(points[self.order], begin[:-1]) for f in (np.minimum, np.maximum))
        self.boxes = [(low, high)]
        while len(low) > 1:
            low, high = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])
            self.boxes.insert(0, (low, high))

    def gap(self, level: int, node: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Distance from each place to the box of its node."""
        low, high = self.boxes[level]
        return _length(*np.maximum(np.maximum(low[node] - at, at - high[node]), 0).T)


def _length(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
    return np.sqrt(x * x + y * y + z * z)


def _descend(tree: Tree, at: np.ndarray, points: np.ndarray, rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances and rows of the ``k`` nearest points of each place.

    The leaf that a place comes to gives a bound; then all nodes within it are
    opened. Where that takes too many at a time, halves of the places go on alone.
    """
    leaf = np.zeros(len(at), np.int64)
    for level in range(1, len(tree.boxes)):
        leaf = 2 * leaf + (tree.gap(level, 2 * leaf, at) > tree.gap(level, 2 * leaf + 1, at))
    measured = lambda q, leaf: np.where(tree.filled[leaf], _length(*(at[q, c, None] - points[tree.held[leaf], c] for c in range(3))), np.nan)
    bound = np.partition(measured(np.arange(len(at)), leaf), k - 1, axis=1)[:, k - 1]
    q, node = np.arange(len(at)), np.zeros(len(at), np.int64)
    for level in range(1, len(tree.boxes)):
        q, node = np.repeat(q, 2), (2 * node[:, None] + np.arange(2)).ravel()
        near = tree.gap(level, node, at[q]) <= bound[q]
        q, node = q[near], node[near]
        if len(q) > OPEN and len(at) > 1:
            half = len(at) // 2
            return tuple(np.concatenate(x) for x in zip(_descend(tree, at[:half], points, rank, k), _descend(tree, at[half:], points, rank, k), strict=True))
    found = []
    for s in range(0, len(q), OPEN // 16):
        own, cells = q[s : s + OPEN // 16], node[s : s + OPEN // 16]
        d = measured(own, cells)
        row, col = np.nonzero(d <= bound[own, None])
        found.append((own[row], d[row, col], tree.held[cells[row], col]))
    q, d, t = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((rank[t], d, q))
    q, d, t = q[order], d[order], t[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return d[keep].reshape(-1, k), t[keep].reshape(-1, k)


def _runs(points: np.ndarray, rank: np.ndarray):
    """``(order, first)``: rows by place and rank, and where in that order the run of each row's place begins."""
    order = np.lexsort((rank, points[:, 2], points[:, 1], points[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (points[order[1:]] != points[order[:-1]]).any(1)
    return order, np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))


def nearest(queries: np.ndarray, targets: np.ndarray, rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances and rows of the ``k`` nearest targets of each query (all, if there are fewer), nearest first, of equal ones the least rank.

    Points are finite. Targets at one place differ by rank only, so ``k`` of
    them stand for all; queries at one place are measured once.
    """
    order, first = _runs(targets, rank)
    kept = order[np.arange(len(order)) - first < k]
    points, k = targets[kept], min(k, len(kept))
    order, first = _runs(queries, np.zeros(len(queries)))
    places = order[np.unique(first)]
    place = np.empty(len(queries), np.int64)
    place[order] = np.searchsorted(np.unique(first), first)
    distance, target = np.empty((len(places), k)), np.empty((len(places), k), np.int64)
    with np.errstate(over="ignore"):
        tree = Tree(points, max(LEAF, k))
        for s in range(0, len(places), TOGETHER):
            part = slice(s, s + TOGETHER)
            distance[part], found = _descend(tree, queries[places[part]], points, rank[kept], k)
            target[part] = kept[found]
    return distance[place], target[place]


def _ranks(column: pa.ChunkedArray) -> np.ndarray:
    """Each value's place in ascending order, nulls last; equal values share one."""
    return pc.rank(column, sort_keys="ascending", null_placement="at_end", tiebreaker="min").to_numpy().astype(np.int64)


def _search(k: int, extra: list[str], names: list[str]):
    def run(queries: pa.Table, targets: pa.Table) -> pa.Table:
        targets = targets.rename_columns([c.removeprefix("n_") for c in targets.column_names])
        at = lambda t: np.stack([t.column(c).to_numpy() for c in AT], 1)
        if not len(queries) or not len(targets):
            q = n = np.zeros(0, np.int64)
            d, nth, last = np.zeros(0), np.zeros(0, np.int32), np.zeros(0)
        else:
            rank = _ranks(targets.column("image"))
            distance, target = nearest(at(queries), at(targets), rank, k)
            width = distance.shape[1]
            q, d, n = np.repeat(np.arange(len(distance)), width), distance.ravel(), target.ravel()
            last = np.repeat(distance[:, -1], width) if width == k else np.full(len(q), np.inf)
            # rows of one image are one query
            code = (_ranks(queries.column("small")) * (len(queries) + 1) + _ranks(queries.column("image")))[q]
            order = np.lexsort((rank[n], d, code))
            nth = np.empty(len(q), np.int32)
            nth[order] = np.arange(len(q)) - np.searchsorted(code[order], code[order]) + 1
            keep = nth <= k
            q, n, d, nth, last = q[keep], n[keep], d[keep], nth[keep], last[keep]
        own, other = queries.take(pa.array(q)), targets.take(pa.array(n))
        found = [own.column("small"), own.column("large"), own.column("image"), other.column("image"), pa.array(d), pa.array(nth), pa.array(last)]
        return pa.table([*found, *(own.column(c) for c in extra), *(other.column(c) for c in extra)], names=names)

    return run


def _curve_place(stats: dict[str, tuple[Column, Column]]) -> Column:
    """Place on the Z-order curve: 20 bits of each coordinate over four deviations to either side."""
    code = F.lit(0).cast("long")
    for bit, (c, (mean, dev)) in enumerate(stats.items()):
        v = (F.greatest(F.least((F.col(c) - mean) / dev, F.lit(4.0)), F.lit(-4.0)) + 4) / 8 * ((1 << 20) - 1)
        v = F.when((dev > 0) & ~F.isnan(v), v).otherwise(0).cast("long")
        for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        code = code.bitwiseOR(F.shiftleft(v, bit))
    return code


def in_chunks(points: DataFrame, sizes: DataFrame) -> DataFrame:
    """``points`` with ``chunk``: their component's places on the curve in runs of up to ``CHUNK``."""
    spread = points.groupBy("component").agg(*[f(c).alias(f"_{n}_{c}") for c in AT for n, f in (("mean", F.avg), ("dev", F.stddev_pop))])
    curve = _curve_place({c: (F.col(f"_mean_{c}"), F.col(f"_dev_{c}")) for c in AT})
    placed = number_rows(points.join(spread, "component").select(*points.columns, curve.alias("_curve")), ["component", "_curve"], "_place")
    begin = placed.groupBy("component").agg(F.min("_place").alias("_begin"))
    placed = placed.join(begin, "component").join(sizes.select("component", F.col("fit").alias("_fit")), "component")
    runs = F.ceil(F.col("_fit") / CHUNK)
    return placed.select(*points.columns, F.floor((F.col("_place") - F.col("_begin")) * runs / F.col("_fit")).cast("int").alias("chunk"))


def search(queries: DataFrame, targets: DataFrame, k: int, extra: list[str]) -> DataFrame:
    """The ``k`` nearest targets of the own (large, chunk) for each (small, image): ``(small, large, q_image, n_image, distance, rank, last, ...)``.

    ``last`` is the distance of the query's own k-th, infinite if there are
    fewer. Queries of a chunk are dealt to tasks by image, the chunk goes to each.
    """
    key = ["large", "chunk", "part"]
    parts = queries.groupBy("large", "chunk").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("_parts"))
    dealt = queries.join(parts, ["large", "chunk"]).select("large", "chunk", F.pmod(F.xxhash64("image"), F.col("_parts")).cast("int").alias("part"), "small", "image", *AT, *extra)
    copies = targets.withColumnRenamed("component", "large").join(parts, ["large", "chunk"]).select("large", "chunk", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"), *[F.col(c).alias(f"n_{c}") for c in ("image", *AT, *extra)])
    copies = copies.withColumnsRenamed({c: f"n_{c}" for c in key})
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    names = ["small", "large", "q_image", "n_image", "distance", "rank", "last", *(f"{p}_{c}" for p in "qn" for c in extra)]
    kinds = [kind(queries, "small"), kind(queries, "large"), kind(queries, "image"), kind(targets, "image"), "double", "int", "double", *(["double"] * 2 * len(extra))]
    return dealt.groupBy(*key).cogroup(copies.groupBy(*[f"n_{c}" for c in key])).applyInArrow(_search(k, extra, names), ", ".join(f"{n} {t}" for n, t in zip(names, kinds, strict=True)))


def gap(cell: Column) -> Column:
    """Distance from the row's point to a cell's box."""
    return pose.norm(*(F.greatest(cell[f"lo_{c}"] - F.col(c), F.col(c) - cell[f"hi_{c}"], F.lit(0.0)) for c in AT))
