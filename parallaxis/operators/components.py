"""Connected components by randomised contraction."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallaxis.runtime import cut_lineage

#: At most so many edges are left to one task, which ends the contraction.
FINISH = 1 << 14


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Component of every vertex that has an edge.

    ``edges`` holds BIGINT end points; direction, repeats and loops don't
    matter, rows with a null end are ignored. Returns ``(id, component)``,
    where ``component`` is the smallest id of the component. Vertices without
    an edge are not returned: they are their own component.

    Each round points every vertex at the neighbour (or itself) of least
    hashed priority and contracts along the pointers. The hash makes the
    expected number of rounds logarithmic for any order of ids. All steps are
    equi-joins with a unique side and combinable aggregates, so a hub vertex
    is pre-aggregated or split by AQE. Once ``FINISH`` edges or fewer are
    left, one task joins them up.
    """
    ends = edges.select(F.col(src).cast("long").alias("u"), F.col(dst).cast("long").alias("v")).where("u is not null and v is not null")
    ends = cut_lineage(ends.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    live, steps = ends.where("u <> v"), []
    while (left := live.count()) > FINISH:
        both = live.unionByName(live.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(steps)), F.col(c)).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        step = cut_lineage(both.groupBy("u").agg(F.least(F.min(rank("v")), F.min(rank("u")))["id"].alias("m")))
        steps.append(step.select(F.col("u").alias("cur"), "m"))
        to = lambda c: step.select(F.col("u").alias(c), F.col("m").alias(f"m{c}"))  # noqa: B023, E731
        moved = live.join(to("u"), "u").join(to("v"), "v").where("mu <> mv")
        live = cut_lineage(moved.select(F.least("mu", "mv").alias("u"), F.greatest("mu", "mv").alias("v")).distinct())
    if left:
        steps.append(cut_lineage(live.coalesce(1).mapInArrow(_join_up, "cur long, m long")))
    vertices = ends.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    labels = vertices.withColumn("cur", F.col("id"))
    for step in steps:
        labels = labels.join(step, "cur", "left").select("id", F.coalesce("m", "cur").alias("cur"))
    smallest = labels.groupBy("cur").agg(F.min("id").alias("component"))
    return labels.join(smallest, "cur").select("id", "component")


def _join_up(batches):
    """(vertex, least vertex of its component) of a bounded number of edges."""
    batches = [b for b in batches if len(b)]
    if not batches:
        return
    u = np.concatenate([b.column("u").to_numpy() for b in batches])
    v = np.concatenate([b.column("v").to_numpy() for b in batches])
    ids, back = np.unique(np.concatenate([u, v]), return_inverse=True)
    u, v = back[: len(u)], back[len(u) :]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[label])], names=["cur", "m"])
