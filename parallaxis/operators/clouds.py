"""Point clouds of declared schema: strict union, crops, running offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parallaxis.operators.numbering import running_sums
from parallaxis.operators.spatial import crop


def schema_differences(a: DataFrame, b: DataFrame) -> list[str]:
    """How the properties of ``b`` differ from those of ``a``, at most five each way, and in order."""
    first, second = ([(f.name, f.dataType.simpleString(), f.metadata.get("ply", "")) for f in d.schema] for d in (a, b))
    if first == second:
        return []
    only = [f"only in the first: {x[0]} {x[1]}" for x in first if x not in second][:5]
    only += [f"only in the second: {x[0]} {x[1]}" for x in second if x not in first][:5]
    return only or ["the properties are in another order"]


def union_strict(clouds: list[DataFrame]) -> DataFrame:
    """UNION ALL of clouds whose properties agree in name, type and order; else ``ValueError``."""
    if not clouds:
        raise ValueError("nothing to join")
    for n, cloud in enumerate(clouds[1:], 1):
        found = schema_differences(clouds[0], cloud)
        if found:
            raise ValueError(f"cloud {n} has other properties: " + "; ".join(found))
    out = clouds[0]
    for cloud in clouds[1:]:
        out = out.union(cloud)
    return out


def merge_clouds(chunks: list[tuple[dict, DataFrame]], margin: float = 0.0, cut: bool = True) -> tuple[DataFrame, DataFrame]:
    """Crop each chunk to its box (unless ``cut`` is off) and join them: the cloud, and ``(chunk, before, after, removed, removed_pct)``."""
    cropped, counts = [], None
    for box, cloud in chunks:
        kept = crop(cloud, box, margin) if cut else cloud
        cropped.append(kept)
        inside = kept.agg(F.lit(box["name"]).alias("chunk"), F.count("*").alias("after"))
        row = cloud.agg(F.lit(box["name"]).alias("chunk"), F.count("*").alias("before")).join(inside, "chunk")
        counts = row if counts is None else counts.unionByName(row)
    counts = counts.withColumn("removed", F.col("before") - F.col("after"))
    return union_strict(cropped), counts.withColumn("removed_pct", F.when(F.col("before") > 0, F.col("removed") * 100 / F.col("before")).otherwise(0.0))


def track_offsets(points: DataFrame, order: str, length: str, by: list[str] = ()) -> DataFrame:
    """Running end and start of each point's track in file order, model by model (writers of one file need them)."""
    if not by:  # one order over all rows
        whole = running_sums(points, [order], {"track_end": length})
        return whole.withColumn("track_start", F.col("track_end") - F.col(length))
    end = F.sum(length).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return points.withColumn("track_end", end).withColumn("track_start", F.col("track_end") - F.col(length))
