"""Global row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parallaxis.runtime import cut_lineage


def number_rows(df: DataFrame, order: list, out: str) -> DataFrame:
    """``df`` with ``out``: 0-based position in the total order ``order``.

    Rows are range-partitioned and sorted; each partition's count shifts the
    numbers of those behind it. The sorted rows are written once, so numbers
    don't change if a partition is computed again.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(placed.withColumn("_at", F.monotonically_increasing_id()))
    part, nth = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.withColumns({"_part": part, "_nth": nth})
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(out, F.col("_before") + F.col("_nth")).drop("_part", "_nth", "_at", "_before")


def running_sums(df: DataFrame, order: list, sums: dict[str, str]) -> DataFrame:
    """``df`` with running sums (the own row included) in the total order ``order``: ``sums`` maps new columns to summed ones.

    Works like ``number_rows``: partitions sum up on their own and are shifted
    by the totals of those before them.
    """
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier = Window.orderBy("_part")
    before = totals.select("_part", *[(F.sum(f"_{n}").over(earlier) - F.col(f"_{n}")).alias(f"_{n}") for n in sums])
    own = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = placed.join(F.broadcast(before), "_part").withColumns({n: F.sum(c).over(own) + F.col(f"_{n}") for n, c in sums.items()})
    return out.drop("_part", "_at", *[f"_{n}" for n in sums])


#: Up to so many distinct values one task takes the percentiles of.
FEW_VALUES = 1 << 16


def percentiles(df: DataFrame, value: str, shares: list[float], by: list[str] = ()) -> DataFrame:
    """Exact percentiles with linear interpolation: ``(*by, p)``, ``p`` an array in the order of ``shares``.

    Nulls don't count; a group without values gives no row. Equal values are
    counted before they meet, the distinct ones get running counts in one
    range-partitioned order, and the two neighbours of each place are picked.
    """
    by = list(by)
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))
    counted = cut_lineage(counted)
    if counted.limit(FEW_VALUES + 1).count() <= FEW_VALUES:
        found = counted.groupBy(*by).agg(F.percentile("_v", F.array(*map(F.lit, shares)), F.col("_n")).alias("p"))
        return found.where("p is not null")
    placed = running_sums(counted, [*by, "_v"], {"_end": "_n"})
    begin = F.col("_end") - F.col("_n")
    if by:
        sizes = placed.groupBy(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(by)]).agg(F.min(begin).alias("_start"), F.sum("_n").alias("_size"))
        met = placed.join(sizes, [F.col(c).eqNullSafe(F.col(f"_by{k}")) for k, c in enumerate(by)])
    else:
        met = placed.withColumns({"_start": F.lit(0), "_size": F.lit(placed.agg(F.max("_end")).first()[0])})
    met = met.select(*by, "_v", (begin - F.col("_start")).alias("_from"), (F.col("_end") - F.col("_start")).alias("_to"), "_size")
    at = [F.lit(q) * (F.col("_size") - 1) for q in shares]
    holds = lambda p: (F.col("_from") <= p) & (p < F.col("_to"))
    ends = [F.struct(F.max(F.when(holds(F.floor(a)), F.col("_v"))).alias("lo"), F.max(F.when(holds(F.ceil(a)), F.col("_v"))).alias("hi"), F.max(a - F.floor(a)).alias("part")) for a in at]
    picked = met.groupBy(*by).agg(F.array(*ends).alias("_e"))
    return picked.select(*by, F.transform("_e", lambda e: e["lo"] + (e["hi"] - e["lo"]) * e["part"]).alias("p"))
