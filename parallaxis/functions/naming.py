"""Names, paths, keys and formats as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A frame's stem: clip name, underscore, six digits.
FRAME = r"^(.+)_([0-9]{6})$"
#: Multiplier of the match database's pair ids.
PAIR_BASE = 2147483647


def stem(path: Column) -> Column:
    """File name without its last suffix (a leading dot is no suffix)."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """Lower-case suffix with its dot, or empty."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]*)$", 1))


def parent(path: Column) -> Column:
    """Path up to the last slash, or empty."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def group_of(name: Column, otherwise: str = "") -> Column:
    """Text before the first slash of a registered name."""
    return F.when(F.instr(name, "/") > 0, F.substring_index(name, "/", 1)).otherwise(otherwise)


def inventory_group(path: Column) -> Column:
    """Group of an input file: its folder if the path has exactly two parts, else ``<ungrouped>``."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) == 2, parts[0]).otherwise("<ungrouped>")


def frame_clip(path: Column) -> Column:
    """Clip of a frame file, empty if the stem has no six-digit index."""
    return F.regexp_extract(stem(path), FRAME, 1)


def frame_index(path: Column) -> Column:
    return F.when(frame_clip(path) != "", F.regexp_extract(stem(path), FRAME, 2).cast("int"))


def clip_key(name: Column) -> Column:
    """``group/clip``, or the group alone for names without a frame index."""
    group = group_of(name, "<ungrouped>")
    return F.when(frame_clip(name) != "", F.concat_ws("/", group, frame_clip(name))).otherwise(group)


def resolution_label(width: Column, height: Column, kind: Column, grouped: bool = True) -> Column:
    """Bucket of an image: ``video_4k`` and the like by the shorter side, ``photos_48mp`` by whole megapixels."""
    if not grouped:
        return kind
    short = F.least(width, height)
    video = F.when(short >= 2100, "4k").when(short >= 1000, "1080p").when(short >= 700, "720p").otherwise(F.concat(width.cast("string"), F.lit("x"), height.cast("string")))
    photo = F.concat(F.floor(width * height / 1e6).cast("string"), F.lit("mp"))
    return F.concat_ws("_", kind, F.when(kind == "video", video).otherwise(photo))


def expected_frames(duration: Column, fps: Column) -> Column:
    return (duration * fps).cast("long")


def pair_ids(pair: Column) -> tuple[Column, Column]:
    """The two image ids that a pair id packs."""
    second = pair % PAIR_BASE
    return ((pair - second) / PAIR_BASE).cast("long"), second


def unordered(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b), F.greatest(a, b)


def ratio(a: Column, b: Column) -> Column:
    """a/b, or 0.0 where b is 0 or null."""
    return F.when(b != 0, a / b).otherwise(0.0)


def fixed(value: Column, digits: int) -> Column:
    """Fixed-point text, empty for null."""
    return F.coalesce(F.format_string(f"%.{digits}f", value), F.lit(""))


def first_examples(rows: DataFrame, by: list[str], value: str, out: str, n: int = 5) -> DataFrame:
    """``(*by, out)``: the first ``n`` distinct values in order, joined, and how many there are beyond them.

    Only ``n`` values a key are ever gathered.
    """
    distinct = rows.select(*by, F.col(value).cast("string").alias("_v")).where("_v is not null").distinct()
    first = distinct.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("_v"))).where(F.col("_r") <= n)
    shown = first.groupBy(*by).agg(F.array_join(F.sort_array(F.collect_list("_v")), ", ").alias("_shown"))
    counts = distinct.groupBy(*by).agg(F.count("*").alias("_n"))
    beyond = F.when(F.col("_n") > n, F.concat(F.lit(" ... of "), F.col("_n").cast("string"))).otherwise("")
    return shown.join(counts, by).select(*by, F.concat("_shown", beyond).alias(out))


def clean_prefix(path: Column) -> Column:
    """Override path as path parts read it: no trailing slash, ``.`` is empty."""
    trimmed = F.regexp_replace(F.regexp_replace(path, r"(^|/)(\./)+", "$1"), r"/+$", "")
    return F.when(trimmed == ".", "").otherwise(trimmed)


def resolve_override(rows: DataFrame, overrides: DataFrame, path_col: str, value_col: str, default) -> DataFrame:
    """``rows`` with ``value_col`` from the deepest override whose path is a leading run of path parts.

    ``overrides`` has (path, declared, <value_col>); of equal depth the first
    declared wins. A longer match without a value gives the default, not the
    shorter override's value. Every leading run of a path is listed and looked
    up by equality, so no row meets all overrides.
    """
    own = Window.partitionBy("path").orderBy("declared")
    table = overrides.select(clean_prefix(F.col("path")).alias("path"), "declared", F.col(value_col).alias("_v"))
    table = table.withColumn("_n", F.row_number().over(own)).where("_n = 1").select(F.col("path").alias("_prefix"), "_v", F.lit(True).alias("_hit"))
    paths = rows.select(F.col(path_col).alias("_p")).distinct()
    parts = F.split(clean_prefix(F.col("_p")), "/")
    runs = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("prefix")))
    listed = paths.select("_p", F.explode(runs).alias("r")).select("_p", "r.depth", F.col("r.prefix").alias("_prefix"))
    best = listed.join(table, "_prefix").groupBy("_p").agg(F.max_by(F.struct("_v"), "depth").alias("b"))
    return rows.join(best, rows[path_col].eqNullSafe(best["_p"]), "left").withColumn(value_col, F.coalesce("b._v", F.lit(default))).drop("_p", "b")
