"""Registered queries of the capture operators over the driver's tables, each beside its DuckDB SQL.

The tables stand in for a capture: an order is a 3-D point, its suppliers are
the images that see it, an event type is a clip of frames, and the leading
numbers of an embedding are a pose.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from parallaxis.functions import naming, pose
from parallaxis.operators import cluster, clouds, components, covisibility, frames, numbering, projection, spatial, stats, subset
from parallaxis.plans import round_trips
from parallaxis.runtime import cut_lineage

_QUERIES: dict = {}
_SQL: dict[str, str] = {}

#: Edge thresholds that split the co-visibility graph of the small tables.
EDGE, CURVE = 34, (30, 32, 34, 36, 38)
BOXES = [("low", 0.0, 900.0, 0.0, 10.0, 20000.0, 0.03), ("mid", 8.0, 10000.0, 0.02, 30.0, 50000.0, 0.06), ("point", 25.0, 0.0, 0.05, 25.0, 1e6, 0.05), ("none", 500.0, 0.0, 0.0, 600.0, 1.0, 1.0)]
OVERRIDES = [("click", 1, 6), ("./purchase/", 2, 3), ("view", 3, None), ("view", 4, 9), ("", 5, 5), ("clic", 6, 2)]
BOX_VALUES = ", ".join(str(b) for b in BOXES)


def query(sql: str | None = None):
    """Register a function as a query, with its SQL."""

    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries():
    return _QUERIES | round_trips.QUERIES


def oracle_sql():
    return _SQL | round_trips.SQL


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rounded(df, *names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


def _pairs(spark, sf_dir, most=None):
    return covisibility.covisible_pairs(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", most)


def _images(spark, sf_dir):
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("image"))


def _labels(spark, sf_dir, t=EDGE):
    return covisibility.label_components(covisibility.component_members(_pairs(spark, sf_dir), _images(spark, sf_dir), t))


def _near_misses(spark, sf_dir):
    """Labels and near misses; the pairs are counted once for both."""
    pairs = cut_lineage(_pairs(spark, sf_dir))
    labels = cut_lineage(covisibility.label_components(covisibility.component_members(pairs, _images(spark, sf_dir), EDGE)))
    return labels, covisibility.near_misses(pairs, labels, EDGE)


def _boxes(spark):
    return spark.createDataFrame(BOXES, "name STRING, x0 DOUBLE, y0 DOUBLE, z0 DOUBLE, x1 DOUBLE, y1 DOUBLE, z1 DOUBLE")


def _measured(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"), F.col("l_discount").alias("z"))


def _poses(spark, sf_dir):
    e = lambda k: F.col("embedding")[k].cast("double")
    return read(spark, sf_dir, "embeddings").select("vec_id", "label", *[e(k).alias(n) for k, n in enumerate(("qw", "qx", "qy", "qz", "tx", "ty", "tz"))])


def _centres(spark, sf_dir):
    rows = _poses(spark, sf_dir)
    q = pose.unit_quaternion(*(F.col(c) for c in ("qw", "qx", "qy", "qz")))
    c = pose.camera_center(q, tuple(F.col(x) for x in ("tx", "ty", "tz")))
    d = pose.view_direction(q)
    return rows.select("vec_id", "label", *[x.alias(n) for x, n in zip((*c, *d), ("cx", "cy", "cz", "dx", "dy", "dz"), strict=True)])


PAIRS = "m as (select distinct l_orderkey as p, l_suppkey as i from lineitem), pairs as (select a.i as lo, b.i as hi, count(*) as shared from m a join m b on a.p = b.p and a.i < b.i group by all)"
REACH = "edges as (select lo as s, hi as d from pairs where shared >= {t} union all select hi, lo from pairs where shared >= {t}), reach(image, other) as (select s_suppkey, s_suppkey from supplier union select r.image, e.d from reach r join edges e on e.s = r.other), roots as (select image, min(other) as root from reach group by image), sizes as (select root, count(*) as size from roots group by root), numbered as (select root, size, row_number() over (order by size desc, root) - 1 as component from sizes), labels as (select image, component, size from roots join numbered using (root))"
GRAPH = f"with recursive {PAIRS}, {REACH.format(t=EDGE)} "
Q = "q as (select vec_id, label, embedding[1]::double as a, embedding[2]::double as b, embedding[3]::double as c, embedding[4]::double as d, embedding[5]::double as tx, embedding[6]::double as ty, embedding[7]::double as tz from embeddings), n as (select *, sqrt(a*a + b*b + c*c + d*d) as s from q), u as (select vec_id, label, a/s as w, b/s as x, c/s as y, d/s as z, tx, ty, tz from n), r as (select *, 1-2*(y*y+z*z) as r00, 2*(x*y-w*z) as r01, 2*(x*z+w*y) as r02, 2*(x*y+w*z) as r10, 1-2*(x*x+z*z) as r11, 2*(y*z-w*x) as r12, 2*(x*z-w*y) as r20, 2*(y*z+w*x) as r21, 1-2*(x*x+y*y) as r22 from u), centres as (select vec_id, label, -(r00*tx+r10*ty+r20*tz) as cx, -(r01*tx+r11*ty+r21*tz) as cy, -(r02*tx+r12*ty+r22*tz) as cz, r20 as dx, r21 as dy, r22 as dz from r)"
MEASURED = "select l_orderkey, l_linenumber, l_suppkey, l_quantity as x, l_extendedprice as y, l_discount as z from lineitem"
BOXED = f"boxes(name, x0, y0, z0, x1, y1, z1) as (values {BOX_VALUES}), pts as ({MEASURED})"
INSIDE = "x >= x0 and x <= x1 and y >= y0 and y <= y1 and z >= z0 and z <= z1"


@query(f"with {PAIRS} select lo, hi, shared from pairs")
def covisible_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query("with m0 as (select distinct l_orderkey as p, l_suppkey as i from lineitem), m as (select * from m0 where p in (select p from m0 group by p having count(*) <= 8)) select a.i as lo, b.i as hi, count(*) as shared from m a join m b on a.p = b.p and a.i < b.i group by all")
def covisible_pairs_capped(spark, sf_dir):
    return _pairs(spark, sf_dir, 8)


@query("select max(n) as longest_track, count(*) filter (n > 8) as skipped_long_tracks from (select count(distinct l_suppkey) as n from lineitem group by l_orderkey)")
def track_guard_stats(spark, sf_dir):
    return covisibility.track_guard_stats(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_suppkey", 8)


@query(GRAPH + "select image, component, size from labels")
def components_at_t(spark, sf_dir):
    return _labels(spark, sf_dir)


@query(GRAPH + "select component, size from labels group by all")
def component_sizes(spark, sf_dir):
    return _labels(spark, sf_dir).groupBy("component").agg(F.count("*").alias("size"))


@query(GRAPH + "select count(*) as components, count(*) filter (size >= 2) as large_components, max(size) as largest from (select distinct component, size from labels)")
def component_summary(spark, sf_dir):
    sizes = _labels(spark, sf_dir).groupBy("component").agg(F.count("*").alias("size"))
    return sizes.agg(F.count("*").alias("components"), F.count_if(F.col("size") >= 2).alias("large_components"), F.max("size").alias("largest"))


@query(f"with recursive {PAIRS}, t(threshold) as (values {', '.join(f'({t})' for t in CURVE)}), reach(threshold, image, other) as (select threshold, s_suppkey, s_suppkey from t, supplier union select r.threshold, r.image, case when e.lo = r.other then e.hi else e.lo end from reach r join pairs e on e.shared >= r.threshold and (e.lo = r.other or e.hi = r.other)), roots as (select threshold, image, min(other) as root from reach group by all) select threshold, count(distinct root) as components from roots group by threshold")
def component_threshold_curve(spark, sf_dir):
    return covisibility.threshold_curve(_pairs(spark, sf_dir), _images(spark, sf_dir), list(CURVE))


@query(GRAPH + f"select lo, hi, a.component as component_lo, b.component as component_hi, shared from pairs join labels a on a.image = lo join labels b on b.image = hi where shared < {EDGE} and a.component <> b.component")
def near_miss_pairs(spark, sf_dir):
    return _near_misses(spark, sf_dir)[1]


@query(GRAPH + f"select a.component as component_a, b.component as component_b from (select distinct component from labels) a join (select distinct component from labels) b on a.component < b.component where not exists (select 1 from pairs join labels x on x.image = lo join labels y on y.image = hi where shared < {EDGE} and x.component = a.component and y.component = b.component)")
def unlinked_components(spark, sf_dir):
    return covisibility.unlinked_components(*_near_misses(spark, sf_dir))


_KNN = f"with {Q}, sizes as (select label, count(*) as n from centres group by label), both_ as (select a.label as component_a, b.label as component_b, case when a.n <= b.n then a.label else b.label end as small, case when a.n <= b.n then b.label else a.label end as large from sizes a join sizes b on a.label < b.label), met as (select component_a, component_b, q.vec_id as image, o.vec_id as neighbour, sqrt((q.cx-o.cx)*(q.cx-o.cx)+(q.cy-o.cy)*(q.cy-o.cy)+(q.cz-o.cz)*(q.cz-o.cz)) as distance, degrees(acos(greatest(least(q.dx*o.dx+q.dy*o.dy+q.dz*o.dz, 1.0), -1.0))) as angle from both_ join centres q on q.label = small join centres o on o.label = large), ranked as (select *, row_number() over (partition by component_a, component_b, image order by distance, neighbour) as rank from met)"


@query(_KNN + " select component_a, component_b, image, neighbour, round(distance, 6) as distance, rank::int as rank from ranked where rank <= 2")
def bridge_knn(spark, sf_dir):
    images = _centres(spark, sf_dir).withColumnsRenamed({"vec_id": "image", "label": "component"})
    return _rounded(covisibility.nearest_across(images, 2), "distance")


@query(_KNN + " select component_a, component_b, image, neighbour, round(distance, 6) as distance, rank::int as rank, round(angle, 4) as view_angle_deg from ranked where rank <= 3 and angle <= 60")
def view_angle_pairs(spark, sf_dir):
    images = _centres(spark, sf_dir).withColumnsRenamed({"vec_id": "image", "label": "component"})
    found = covisibility.nearest_across(images, 3, 60.0)
    return _rounded(_rounded(found, "distance"), "view_angle_deg", digits=4)


@query(_KNN + ", turns as (select *, row_number() over (partition by component_a, component_b order by distance, image, neighbour) as turn from ranked where rank <= 2) select component_a, component_b, image, neighbour, turn::int as turn from turns where turn <= 3 order by turn, component_a, component_b limit 100")
def bridge_candidates_capped(spark, sf_dir):
    images = _centres(spark, sf_dir).withColumnsRenamed({"vec_id": "image", "label": "component"})
    found = covisibility.interleave(covisibility.nearest_across(images, 2), ["component_a", "component_b"], ["distance", "image", "neighbour"], 3, 100)
    return found.select("component_a", "component_b", "image", "neighbour", "turn")


@query(f"with {PAIRS}, ids as (select hi * 2147483647 + lo as pid from pairs where shared >= 30), decoded as (select (pid - pid % 2147483647) // 2147483647 as a, pid % 2147483647 as b from ids) select lo, hi, shared, exists (select 1 from decoded where least(a, b) = lo and greatest(a, b) = hi) as already_matched from pairs where shared >= 25")
def already_matched_split(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    ids = pairs.where("shared >= 30").select((F.col("hi") * naming.PAIR_BASE + F.col("lo")).alias("pid"))
    a, b = naming.pair_ids(F.col("pid"))
    matched = ids.select(a.alias("lo"), b.alias("hi"))
    return covisibility.split_matched(pairs.where("shared >= 25"), matched, "lo", "hi")


@query("select l_orderkey as point, count(*) as length from lineitem group by 1")
def track_lengths(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("point")).agg(F.count("*").alias("length"))


@query("select round(avg(case when n <= 2 then 1.0 else 0.0 end), 9) as short_fraction from (select count(*) as n from lineitem group by l_orderkey)")
def short_track_fraction(spark, sf_dir):
    return _rounded(stats.short_track_fraction(track_lengths(spark, sf_dir), "length"), "short_fraction", digits=9)


@query("with p as (select l_orderkey, count(*) as n, avg(l_discount) as e from lineitem group by 1) select round(avg(n), 6) as mean_track_length, round(sum(n) / (select count(*) from supplier), 6) as mean_observations, round(avg(e), 6) as mean_error from p")
def mean_lengths(spark, sf_dir):
    points = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.avg("l_discount").alias("e"))
    return _rounded(stats.mean_lengths(points, "n", read(spark, sf_dir, "supplier").count(), "e"), "mean_track_length", "mean_observations", "mean_error")


@query("select o_orderkey as image, count(l_orderkey) as observations from orders left join lineitem on l_orderkey = o_orderkey group by 1")
def observations_per_image(spark, sf_dir):
    return stats.observations_per_image(read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


@query("select min(n) as min, round(quantile_cont(n, 0.05), 6) as p05, round(quantile_cont(n, 0.5), 6) as median, round(avg(n), 6) as mean, round(quantile_cont(n, 0.95), 6) as p95, max(n) as max from (select count(l_orderkey) as n from orders left join lineitem on l_orderkey = o_orderkey group by o_orderkey)")
def observation_profile(spark, sf_dir):
    return _rounded(stats.profile(observations_per_image(spark, sf_dir), "observations"), "p05", "median", "mean", "p95")


@query("select count(e) as usable, round(avg(e), 6) as mean, round(quantile_cont(e, 0.5), 6) as median, round(quantile_cont(e, 0.9), 6) as p90, round(max(e), 6) as max, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) as weighted_mean from (select *, case when l_discount > 0 then l_discount end as e from lineitem)")
def error_stats(spark, sf_dir):
    return _rounded(stats.error_stats(read(spark, sf_dir, "lineitem"), "l_discount", "l_quantity"), "mean", "median", "p90", "max", "weighted_mean")


@query("select label, round(max(x) - min(x), 6) as extent_x, round(max(y) - min(y), 6) as extent_y, round(max(z) - min(z), 6) as extent_z, round(sqrt((max(x)-min(x))*(max(x)-min(x)) + (max(y)-min(y))*(max(y)-min(y)) + (max(z)-min(z))*(max(z)-min(z))), 6) as diagonal from (select label, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as z from embeddings) group by label")
def extent_by_group(spark, sf_dir):
    rows = _poses(spark, sf_dir).withColumnsRenamed({"qw": "x", "qx": "y", "qy": "z"}).select("label", "x", "y", "z")
    return _rounded(stats.extent(rows, ["x", "y", "z"], ["label"]), "extent_x", "extent_y", "extent_z", "diagonal")


_RATES = "with a as (select {key} as key, count(*) as total from documents group by 1), b as (select {key} as key, count(*) as registered from documents join (select distinct doc_id from labels) using (doc_id) where lang <> 'fr' group by 1), r as (select coalesce(a.key, b.key) as key, coalesce(total, 0) as total, coalesce(registered, 0) as registered, case when coalesce(total, 0) > 0 then coalesce(registered, 0) / total else 0 end as rate from a full join b on a.key = b.key)"


def _registration(spark, sf_dir, key):
    docs = read(spark, sf_dir, "documents")
    known = docs.join(read(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi").where("lang <> 'fr'")
    return stats.registration(docs, known, key, key)


@query(_RATES.format(key="lang") + " select key, total, registered, round(rate, 9) as rate from r")
def registration_by_group(spark, sf_dir):
    return _rounded(_registration(spark, sf_dir, F.col("lang")), "rate", digits=9)


@query(_RATES.format(key="concat_ws('/', lang, source)") + " select key, total, registered, round(rate, 9) as rate from r")
def registration_by_clip(spark, sf_dir):
    return _rounded(_registration(spark, sf_dir, F.concat_ws("/", "lang", "source")), "rate", digits=9)


@query(_RATES.format(key="concat_ws('/', lang, source)") + " select key, total, registered, total > 0 and registered = 0 as dead, total >= 10 and rate < 0.5 as weak from r where (total > 0 and registered = 0) or (total >= 10 and rate < 0.5)")
def dead_and_weak_groups(spark, sf_dir):
    rates = _registration(spark, sf_dir, F.concat_ws("/", "lang", "source"))
    both = stats.dead_groups(rates).unionByName(stats.weak_clips(rates)).distinct()
    return both.select("key", "total", "registered", ((F.col("total") > 0) & (F.col("registered") == 0)).alias("dead"), ((F.col("total") >= 10) & (F.col("rate") < 0.5)).alias("weak"))


@query("select l_returnflag as model, count(*) as images from lineitem group by 1 order by 2 desc, 1 limit 1")
def primary_model(spark, sf_dir):
    return stats.primary_model(read(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "model"))


@query("with a as (select l_returnflag as model, count(distinct l_suppkey) as images, count(distinct l_orderkey) as points, count(*) as observations from lineitem group by 1) select *, model = (select model from a order by images desc, model limit 1) as is_primary from a")
def model_summary(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "model")
    return stats.model_summary(rows.select("model", "l_suppkey").distinct(), rows.select("model", "l_orderkey").distinct(), rows)


_WINDOW = "w as (select event_id, event_type, value, (row_number() over (partition by event_type order by event_id) - 1) // {size} as window_id from {source}), b as (select *, row_number() over (partition by event_type, window_id order by value desc, event_id) = 1 as is_window_best, value >= 20 as meets_threshold from w)"


@query("with " + _WINDOW.format(size=4, source="events") + " select event_id, event_type, window_id::int as window_id, is_window_best, meets_threshold, is_window_best and meets_threshold as keep from b")
def window_select(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return frames.select_frames(rows, ["event_type"], "event_id", "value", 4, 20.0).drop("value")


@query("with sized as (select *, case event_type when 'click' then 6 when 'purchase' then 3 when 'view' then 4 else 5 end as size from events), " + _WINDOW.format(size="size", source="sized") + " select event_id, event_type, window_id::int as window_id, is_window_best and meets_threshold as keep from b")
def window_select_override(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", "event_type", "value")
    rules = spark.createDataFrame(OVERRIDES, "path STRING, declared INT, size INT")
    sized = naming.resolve_override(rows, rules, "event_type", "size", 4)
    return frames.select_frames(sized, ["event_type"], "event_id", "value", "size", 20.0).select("event_id", "event_type", "window_id", "keep")


@query("with p as (select page_id, split_part(url, '://', 2) as u from pages), s as (select page_id, string_split(regexp_replace(u, '/+$', ''), '/') as parts, u from p) select page_id, case when len(parts) >= 2 and parts[2] = 'en' and parts[1] like 'm.%' then 7 when parts[1] = (select min(split_part(split_part(url, '://', 2), '/', 1)) from pages) then 9 else 4 end as window_size from s")
def override_by_url_prefix(spark, sf_dir):
    rows = read(spark, sf_dir, "pages").select("page_id", F.split_part("url", F.lit("://"), F.lit(2)).alias("rel"))
    hosts = rows.select(F.substring_index("rel", "/", 1).alias("host")).distinct()
    first = hosts.agg(F.min("host").alias("path")).select("path", F.lit(1).alias("declared"), F.lit(9).alias("window_size"))
    mobile = hosts.where(F.col("host").startswith("m.")).select(F.concat("host", F.lit("/en")).alias("path"), F.lit(2).alias("declared"), F.lit(7).alias("window_size"))
    return naming.resolve_override(rows, first.unionByName(mobile), "rel", "window_size", 4).select("page_id", "window_size")


_LABEL = "case when kind = 'video' then 'video_' || case when least(w, h) >= 2100 then '4k' when least(w, h) >= 1000 then '1080p' when least(w, h) >= 700 then '720p' else w || 'x' || h end else 'photos_' || (w * h // 1000000) || 'mp' end"


def _sized_parts(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 80).cast("long").alias("w"), (F.col("p_size") * 60 + F.col("p_partkey") % 7).cast("long").alias("h"), F.when(F.col("p_partkey") % 3 == 0, "photos").otherwise("video").alias("kind"))


@query(f"select bucket, count(*) as n, count(*) < 20 as suspicious from (select {_LABEL} as bucket from (select p_size::bigint * 80 as w, p_size::bigint * 60 + p_partkey % 7 as h, case when p_partkey % 3 = 0 then 'photos' else 'video' end as kind from part)) group by 1")
def resolution_bucket(spark, sf_dir):
    rows = _sized_parts(spark, sf_dir)
    named = rows.withColumn("bucket", naming.resolution_label(F.col("w"), F.col("h"), F.col("kind")))
    return stats.group_counts(named, "bucket").withColumn("suspicious", F.col("n") < 20)


_NAMES = "select event_id, case when event_id % 5 = 0 then event_type || '.JPG' when event_id % 7 = 0 then 'room/' || event_type || '_' || lpad((event_id % 1000000)::varchar, 6, '0') || '.jpg' else event_type || '/a_' || event_type || '_' || lpad((event_id % 1000000)::varchar, 6, '0') || '.jpeg' end as name from events"


@query(f"with n as ({_NAMES}), s as (select *, regexp_replace(regexp_extract(name, '([^/]*)$', 1), '\\.[^.]*$', '') as stem from n) select event_id, regexp_extract(stem, '^(.+)_([0-9]{{6}})$', 1) as clip, try_cast(nullif(regexp_extract(stem, '^(.+)_([0-9]{{6}})$', 2), '') as int) as frame_index, case when contains(name, '/') then split_part(name, '/', 1) else '' end as grp, lower(regexp_extract(name, '(\\.[^./]*)$', 1)) as suffix, case when regexp_extract(stem, '^(.+)_([0-9]{{6}})$', 1) <> '' then case when contains(name, '/') then split_part(name, '/', 1) else '<ungrouped>' end || '/' || regexp_extract(stem, '^(.+)_([0-9]{{6}})$', 1) else case when contains(name, '/') then split_part(name, '/', 1) else '<ungrouped>' end end as clip_key from s")
def frame_name_parse(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    number = F.lpad((F.col("event_id") % 1000000).cast("string"), 6, "0")
    name = F.when(F.col("event_id") % 5 == 0, F.concat("event_type", F.lit(".JPG"))).when(F.col("event_id") % 7 == 0, F.concat(F.lit("room/"), "event_type", F.lit("_"), number, F.lit(".jpg"))).otherwise(F.concat("event_type", F.lit("/a_"), "event_type", F.lit("_"), number, F.lit(".jpeg")))
    rows = e.select("event_id", name.alias("name"))
    n = F.col("name")
    return rows.select("event_id", naming.frame_clip(n).alias("clip"), naming.frame_index(n).alias("frame_index"), naming.group_of(n).alias("grp"), naming.suffix(n).alias("suffix"), naming.clip_key(n).alias("clip_key"))


@query("select case when len(string_split(rel, '/')) = 2 then split_part(rel, '/', 1) else '<ungrouped>' end as grp, count(*) as n from (select case when doc_id % 11 = 0 then 'doc.jpg' when doc_id % 13 = 0 then source || '/' || lang || '/d.jpg' else source || '/d.jpg' end as rel from documents) group by 1")
def input_inventory(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    rel = F.when(F.col("doc_id") % 11 == 0, "doc.jpg").when(F.col("doc_id") % 13 == 0, F.concat("source", F.lit("/"), "lang", F.lit("/d.jpg"))).otherwise(F.concat("source", F.lit("/d.jpg")))
    return stats.group_counts(d.select(naming.inventory_group(rel).alias("grp")), "grp")


@query(f"with {BOXED} select name, l_orderkey, l_linenumber, x, y, z from pts join boxes on {INSIDE}")
def points_in_boxes(spark, sf_dir):
    return spatial.in_boxes(_measured(spark, sf_dir), _boxes(spark)).select("name", "l_orderkey", "l_linenumber", "x", "y", "z")


@query(f"with {BOXED} select l_orderkey, l_linenumber, x, y, z from pts where not exists (select 1 from boxes where {INSIDE})")
def unassigned_points(spark, sf_dir):
    return spatial.in_boxes(_measured(spark, sf_dir), _boxes(spark), how="left_anti").select("l_orderkey", "l_linenumber", "x", "y", "z")


_SELECTION = f"with {BOXED}, p3 as (select l_orderkey as p, avg(x) as x, avg(y) as y, avg(z) as z from pts group by 1), held as (select name as box, p from p3 join boxes on x >= x0 - 2.0 and x <= x1 + 2.0 and y >= y0 - 2.0 and y <= y1 + 2.0 and z >= z0 - 2.0 and z <= z1 + 2.0), seen as (select box, l_suppkey as image_id, count(distinct p) as n_in_box from held join lineitem on l_orderkey = p group by all), cams as (select l_suppkey as image_id, min(l_quantity) as x, min(l_extendedprice) as y, min(l_discount) as z from lineitem group by 1), inside as (select name as box, image_id from cams join boxes on {INSIDE}), picked as (select coalesce(i.box, s.box) as box, coalesce(i.image_id, s.image_id) as image_id, i.box is not null as is_inside, coalesce(n_in_box, 0) as n_in_box from inside i full join seen s on s.box = i.box and s.image_id = i.image_id)"


def _selection(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    points = _measured(spark, sf_dir).groupBy(F.col("l_orderkey").alias("point3d_id")).agg(*[F.avg(a).alias(a) for a in "xyz"])
    tracks = li.select(F.col("l_orderkey").alias("point3d_id"), F.col("l_suppkey").alias("image_id"))
    cams = li.groupBy(F.col("l_suppkey").alias("image_id")).agg(F.min("l_quantity").alias("cx"), F.min("l_extendedprice").alias("cy"), F.min("l_discount").alias("cz"))
    return spatial.select_for_boxes(points, tracks, cams, _boxes(spark), 2.0, 40)


@query(_SELECTION + " select box, image_id, is_inside, n_in_box from picked where is_inside or n_in_box >= 40")
def box_selection(spark, sf_dir):
    return _selection(spark, sf_dir)[0]


@query(_SELECTION + " select count(*) as box_images, round(count(*) / (select count(*) from supplier), 6) as overlap_factor from picked where is_inside or n_in_box >= 40")
def box_overlap(spark, sf_dir):
    return _rounded(spatial.overlap_factor(_selection(spark, sf_dir)[0], read(spark, sf_dir, "supplier").count()), "overlap_factor")


@query("with v(name, x0, y0, z0, x1, y1, z1) as (values " + BOX_VALUES + "), b as (select name, x0::double as x0, y0::double as y0, z0::double as z0, x1::double as x1, y1::double as y1, z1::double as z1 from v) select name, x1 - x0 as extent_x, y1 - y0 as extent_y, round(z1 - z0, 9) as extent_z, round((x1 - x0) * (y1 - y0) * (z1 - z0), 6) as volume, (x0 + x1) / 2 as center_x, (y0 + y1) / 2 as center_y, round((z0 + z1) / 2, 9) as center_z from b")
def box_geometry(spark, sf_dir):
    rows = spatial.with_geometry(_boxes(spark)).drop("x0", "y0", "z0", "x1", "y1", "z1")
    return _rounded(_rounded(rows, "extent_z", "center_z", digits=9), "volume")


_SUBSET = "with t as (select l_orderkey as p, l_suppkey as i, l_linenumber as k from lineitem), kept as (select * from t where i % 3 <> 0 and p % 2 = 0), ok as (select p from kept group by p having count(*) >= 2), live as (select * from kept where p in (select p from ok))"


def _line_model(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    tracks = li.select(F.col("l_orderkey").alias("point3d_id"), F.col("l_suppkey").alias("image_id"), F.col("l_linenumber").alias("point2d_idx"))
    keep_images = read(spark, sf_dir, "supplier").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("image_id"))
    keep_points = read(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("point3d_id"))
    return tracks, keep_images, keep_points


@query(_SUBSET + " select p as point3d_id, count(*) as n from live group by 1")
def subset_points(spark, sf_dir):
    return subset.subset_tracks(*_line_model(spark, sf_dir)).groupBy("point3d_id").agg(F.count("*").alias("n"))


@query(_SUBSET + " select i as image_id, k as point2d_idx, case when p in (select p from live) then p end as point3d_id from t where i % 3 <> 0")
def subset_features_nulled(spark, sf_dir):
    tracks, images, points = _line_model(spark, sf_dir)
    kept = subset.subset_tracks(tracks, images, points)
    return subset.subset_features(tracks.select("image_id", "point2d_idx", "point3d_id"), images, kept)


@query(f"with {Q} select vec_id, round(cx, 6) as cx, round(cy, 6) as cy, round(cz, 6) as cz from centres")
def camera_centers(spark, sf_dir):
    return _rounded(_centres(spark, sf_dir).select("vec_id", "cx", "cy", "cz"), "cx", "cy", "cz")


@query(f"with {Q} select vec_id, round(dx, 6) as dx, round(dy, 6) as dy, round(dz, 6) as dz from centres")
def view_directions(spark, sf_dir):
    return _rounded(_centres(spark, sf_dir).select("vec_id", "dx", "dy", "dz"), "dx", "dy", "dz")


@query("select l_orderkey as point3d_id, l_linenumber as pos from (select l_orderkey + case when l_partkey % 17 = 0 then 100000000 else 0 end as l_orderkey, l_linenumber from lineitem) where l_orderkey not in (select o_orderkey from orders)")
def validate_fk(spark, sf_dir):
    moved = F.col("l_orderkey") + F.when(F.col("l_partkey") % 17 == 0, 100000000).otherwise(0)
    tracks = read(spark, sf_dir, "lineitem").select(moved.alias("image_id"), F.col("l_linenumber").alias("pos"))
    found = subset.unknown_track_images(tracks, read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id")))
    return found.select(F.col("image_id").alias("point3d_id"), "pos")


@query("with o as (select o_orderkey, o_custkey, o_orderkey % 9 as k from orders), t as (select o_custkey as p, o_orderkey as i, k from o), f as (select o_orderkey as i, k, case when o_orderkey % 10 = 0 then null when o_orderkey % 13 = 0 then o_custkey + 1 else o_custkey end as back from o where o_orderkey % 4 <> 1) select p as point3d_id, t.i as image_id, t.k as point2d_idx from t join f on f.i = t.i and f.k = t.k where back is distinct from p")
def validate_bidirectional(spark, sf_dir):
    o = read(spark, sf_dir, "orders").withColumn("k", F.col("o_orderkey") % 9)
    tracks = o.select(F.col("o_custkey").alias("point3d_id"), F.col("o_orderkey").alias("image_id"), F.col("k").alias("point2d_idx"))
    back = F.when(F.col("o_orderkey") % 10 == 0, None).when(F.col("o_orderkey") % 13 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    features = o.where("o_orderkey % 4 <> 1").select(F.col("o_orderkey").alias("image_id"), F.col("k").alias("point2d_idx"), back.alias("point3d_id"))
    return subset.mismatched(tracks, features).select("point3d_id", "image_id", "point2d_idx")


@query("select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having count(*) > 1")
def validate_duplicates(spark, sf_dir):
    return stats.duplicate_keys(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("with v as (select l_orderkey as point, s_nationkey as label, count(*) as n from lineitem join supplier on s_suppkey = l_suppkey where s_nationkey % 5 <> 4 group by all), w as (select point, label, row_number() over (partition by point order by n desc, label) as r from v) select p.point, coalesce(label, -1) as label from (select distinct l_orderkey as point from lineitem) p left join w on w.point = p.point and r = 1")
def majority_vote(spark, sf_dir):
    labels = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_nationkey") % 5 == 4, -1).otherwise(F.col("s_nationkey")).alias("label"))
    return cluster.majority_vote(read(spark, sf_dir, "lineitem"), labels, "l_orderkey", "l_suppkey")


_XYZ = "select vec_id, label, embedding[1]::double as x, embedding[2]::double as y, embedding[3]::double as z from embeddings"


def _xyz(spark, sf_dir):
    return _poses(spark, sf_dir).select("vec_id", "label", F.col("qw").alias("x"), F.col("qx").alias("y"), F.col("qy").alias("z"))


@query(f"select label, " + ", ".join(f"round(quantile_cont({a}, {q}), 6) as {a}_{n}" for a in "xyz" for q, n in ((0.02, "low"), (0.98, "high"))) + f" from ({_XYZ}) group by label")
def trimmed_bounds(spark, sf_dir):
    rows = spatial.bounds(_xyz(spark, sf_dir), ["x", "y", "z"], ["label"], 2.0)
    return _rounded(rows, *[f"{a}_{n}" for a in "xyz" for n in ("low", "high")])


@query(f"with e as ({_XYZ}), cams as (select * from e where vec_id % 3 = 0), c as (select label, " + ", ".join(f"min({a}) as l{a}, max({a}) as h{a}" for a in "xyz") + " from cams group by label), p as (select label, " + ", ".join(f"quantile_cont({a}, 0.05) as l{a}, quantile_cont({a}, 0.95) as h{a}" for a in "xyz") + " from e where vec_id % 3 <> 0 group by label) select printf('room_%02d', c.label) as name, " + ", ".join(f"round(least(c.l{a}, p.l{a}) - 0.25, 6) as {a}0, round(greatest(c.h{a}, p.h{a}) + 0.25, 6) as {a}1" for a in "xyz") + " from c left join p using (label)")
def suggested_boxes(spark, sf_dir):
    rows = _xyz(spark, sf_dir)
    found = cluster.suggest_boxes(rows.where("vec_id % 3 = 0"), rows.where("vec_id % 3 <> 0"), trim=5.0, padding=0.25)
    return _rounded(found, "x0", "y0", "z0", "x1", "y1", "z1")


@query(f"with recursive e as ({_XYZ}), near as (select a.vec_id as a, b.vec_id as b from e a join e b on sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) <= 0.05), core as (select a from near group by a having count(*) >= 10), reach(a, b) as (select a, a from core union select r.a, n.b from reach r join near n on n.a = r.b join core c on c.a = n.b), comp as (select a, min(b) as root from reach group by a), num as (select root, row_number() over (order by root) - 1 as label from (select distinct root from comp)), lab as (select a, label from comp join num using (root)), bord as (select n.b as a, min(label) as label from near n join lab l on l.a = n.a group by n.b) select vec_id as id, coalesce(lab.label, bord.label, -1)::int as label, lab.label is not null as is_core from e left join lab on lab.a = vec_id left join bord on bord.a = vec_id")
def dbscan_labels(spark, sf_dir):
    return cluster.dbscan(_xyz(spark, sf_dir), 0.05, 10, "vec_id")


@query()
def kmeans_partition(spark, sf_dir):
    return cluster.kmeans(_xyz(spark, sf_dir), 4, "vec_id")


@query()
def pca_planarity(spark, sf_dir):
    return projection.planarity(_xyz(spark, sf_dir))


@query(f"select count(*) as n, round(covar_pop(x, y), 9) as cxy, round(covar_pop(x, z), 9) as cxz, round(covar_pop(y, z), 9) as cyz, round(var_pop(x), 9) as cxx, round(var_pop(y), 9) as cyy, round(var_pop(z), 9) as czz from ({_XYZ})")
def pca_covariance(spark, sf_dir):
    n, _, c = projection.covariance(_xyz(spark, sf_dir))
    row = (n, *[round(float(c[i, j]), 9) for i, j in ((0, 1), (0, 2), (1, 2), (0, 0), (1, 1), (2, 2))])
    return spark.createDataFrame([row], "n LONG, cxy DOUBLE, cxz DOUBLE, cyz DOUBLE, cxx DOUBLE, cyy DOUBLE, czz DOUBLE")


def _chunks(spark, sf_dir):
    rows = _xyz(spark, sf_dir)
    box = lambda n, a, b: {"name": n, "x0": a, "y0": -0.2, "z0": -0.2, "x1": b, "y1": 0.2, "z1": 0.2}
    return [(box("a", -0.3, 0.0), rows.where("label < 5")), (box("b", 0.0, 0.3), rows.where("label >= 3"))]


_CROP = f"with e as ({_XYZ}), a as (select * from e where label < 5), b as (select * from e where label >= 3), ca as (select * from a where x >= -0.3 - 0.05 and x <= 0.0 + 0.05 and y >= -0.2 - 0.05 and y <= 0.2 + 0.05 and z >= -0.2 - 0.05 and z <= 0.2 + 0.05), cb as (select * from b where x >= 0.0 - 0.05 and x <= 0.3 + 0.05 and y >= -0.2 - 0.05 and y <= 0.2 + 0.05 and z >= -0.2 - 0.05 and z <= 0.2 + 0.05)"


@query(_CROP + " select * from ca union all select * from cb")
def crop_and_union(spark, sf_dir):
    return clouds.merge_clouds(_chunks(spark, sf_dir), 0.05)[0]


@query(_CROP + ", c as (select 'a' as chunk, (select count(*) from a) as before, (select count(*) from ca) as after union all select 'b', (select count(*) from b), (select count(*) from cb)) select chunk, before, after, before - after as removed, round(case when before > 0 then (before - after) * 100 / before else 0 end, 6) as removed_pct from c")
def crop_counts(spark, sf_dir):
    return _rounded(clouds.merge_clouds(_chunks(spark, sf_dir), 0.05)[1], "removed_pct")


@query("select l_suppkey as component, count(*) as size from lineitem group by 1 order by 2 desc, 1 limit 10")
def group_rank_topk(spark, sf_dir):
    return stats.group_counts(read(spark, sf_dir, "lineitem"), F.col("l_suppkey").alias("component")).withColumnRenamed("n", "size").orderBy(F.desc("size"), "component").limit(10)


@query("with c as (select 'rate' as name, 'fail' as severity, (select count(*) from labels) > 10 as passed union all select 'groups', 'fail', (select count(distinct lang) from documents) > 100 union all select 'weak', 'warn', (select count(*) from documents) < 0) select coalesce(bool_and(not (severity = 'fail' and not passed)), true) as passed, count(*) filter (severity = 'fail' and not passed) as failures, count(*) filter (severity = 'warn' and not passed) as warnings from c")
def check_verdict(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").agg(F.lit("rate").alias("name"), F.lit("fail").alias("severity"), (F.count("*") > 10).alias("passed"))
    docs = read(spark, sf_dir, "documents")
    groups = docs.agg(F.lit("groups").alias("name"), F.lit("fail").alias("severity"), (F.countDistinct("lang") > 100).alias("passed"))
    weak = docs.agg(F.lit("weak").alias("name"), F.lit("warn").alias("severity"), (F.count("*") < 0).alias("passed"))
    return stats.verdict(labels.unionByName(groups).unionByName(weak))


@query("select event_id, event_type, printf('%.4f', value) as score, round(value / nullif(event_id % 3, 0), 6) as r from events")
def report_format(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    r = F.when(F.col("event_id") % 3 == 0, None).otherwise(naming.ratio(F.col("value"), F.col("event_id") % 3))
    return e.select("event_id", "event_type", naming.fixed(F.col("value"), 4).alias("score"), F.round(r, 6).alias("r"))


@query("select event_type, string_agg(event_id::varchar, ',' order by event_id) as series from events group by 1")
def clip_series(spark, sf_dir):
    rows = frames.clip_series(read(spark, sf_dir, "events"), "event_type", "event_id")
    return rows.select("event_type", F.array_join(F.transform("series", lambda s: s["event_id"].cast("string")), ",").alias("series"))


@query("with r as (select event_id, event_type as grp, (event_id % 50)::varchar || '.jpg' as name from events), f as (select *, row_number() over (partition by grp, name order by event_id) = 1 as first from r) select event_id, case when first and name not in ('7.jpg', '8.jpg') then 'copy' else 'present' end as action from f")
def copy_plan(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("grp"), F.concat((F.col("event_id") % 50).cast("string"), F.lit(".jpg")).alias("name"))
    there = rows.where("name in ('7.jpg', '8.jpg')").select("grp", "name").distinct()
    return frames.plan_copies(rows, "grp", "name", ["event_id"], there).select("event_id", "action")


@query("select l_orderkey, l_linenumber, row_number() over (order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 as position from lineitem")
def global_positions(spark, sf_dir):
    return _positions(read(spark, sf_dir, "lineitem"))


def _positions(rows):
    return numbering.number_rows(rows, [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")], "position").select("l_orderkey", "l_linenumber", "position")


@query("with recursive e as (select o_custkey as s, o_orderkey + 1000000000 as d from orders union all select l_orderkey + 1000000000, l_suppkey + 2000000000 from lineitem), b as materialized (select distinct s, d from e union select distinct d, s from e), reach(id, component) using key (id) as (select distinct s, s from b union select n.id, n.component from (select b.d as id, min(r.component) as component from reach r join b on b.s = r.id group by b.d) n join recurring.reach k on k.id = n.id where n.component < k.component) select id, component from reach")
def connected_components(spark, sf_dir):
    return _linked(read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem"))


def _linked(orders, lines):
    a = orders.select(F.col("o_custkey").alias("src"), (F.col("o_orderkey") + 1000000000).alias("dst"))
    b = lines.select((F.col("l_orderkey") + 1000000000).alias("src"), (F.col("l_suppkey") + 2000000000).alias("dst"))
    return components.connected_components(a.unionByName(b))


@query("select o_orderstatus, case when len(k) > 5 then array_to_string(k[1:5], ', ') || ' ... of ' || len(k) else array_to_string(k, ', ') end as examples from (select o_orderstatus, list_sort(list(distinct o_custkey::varchar)) as k from orders group by 1)")
def issue_examples(spark, sf_dir):
    return read(spark, sf_dir, "orders").transform(naming.first_examples, ["o_orderstatus"], "o_custkey", "examples")


@query("select box, warning from (select l_returnflag || l_linestatus as box, count(*) as points, count(distinct l_suppkey) as images from lineitem group by 1), (values ('too_many_points'), ('too_few_points'), ('too_many_images')) w(warning) where case warning when 'too_many_points' then points > 1200 when 'too_few_points' then points < 100 else images > 9 end")
def box_budget(spark, sf_dir):
    counts = read(spark, sf_dir, "lineitem").groupBy(F.concat("l_returnflag", "l_linestatus").alias("box")).agg(F.count("*").alias("points"), F.countDistinct("l_suppkey").alias("images"))
    return spatial.box_warnings(counts, 1200, 9).select("box", "warning")


@query("with c as (select event_id, event_type as folder, case event_type when 'click' then 2.5 when 'view' then 1.0 else 4.0 end as fps, (event_id % 20) / 4 as duration from events) select event_id, fps::double as fps, trunc(duration * fps)::bigint as expected_frames, case when event_id % 10 < 3 then 'skipped' else 'pending' end as state from c")
def extract_plan(spark, sf_dir):
    from parallaxis.plans.commands import plan_extraction

    e = read(spark, sf_dir, "events")
    number = F.col("event_id").cast("string")
    clips = e.select(number.alias("path"), F.concat("event_type", F.lit("/"), number, F.lit(".mp4")).alias("rel_path"), (F.col("event_id") % 20 / 4).alias("duration"))
    rules = spark.createDataFrame([("click", 1, 2.5), ("view", 2, 1.0)], "path STRING, declared INT, fps DOUBLE")
    done = e.where("event_id % 10 < 3").select(F.col("event_type").alias("out_dir"), number.alias("clip_stem"))
    return plan_extraction(clips, rules, 4.0, done).select(F.col("path").cast("long").alias("event_id"), "fps", "expected_frames", "state")


@query("select model, o_orderkey, sum(n) over (partition by model order by o_orderkey rows unbounded preceding)::bigint as track_end from (select o_orderstatus as model, o_orderkey, count(l_orderkey) as n from orders left join lineitem on l_orderkey = o_orderkey group by all)")
def track_offsets(spark, sf_dir):
    return _offsets(spark, sf_dir, read(spark, sf_dir, "orders"))


def _offsets(spark, sf_dir, orders):
    points = orders.select(F.col("o_orderstatus").alias("model"), "o_orderkey")
    lengths = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    rows = points.join(lengths, points["o_orderkey"] == lengths["l_orderkey"], "left").select("model", "o_orderkey", F.coalesce("n", F.lit(0)).alias("n"))
    return clouds.track_offsets(rows, "o_orderkey", "n", ["model"]).select("model", "o_orderkey", "track_end")


@query(_SUBSET + ", s as (select 'images' as \"table\", (select count(*) from supplier) as before, (select count(*) from supplier where s_suppkey % 3 <> 0) as after union all select 'points', (select count(distinct p) from t), (select count(distinct p) from live) union all select 'tracks', (select count(*) from t), (select count(*) from live)) select * from s")
def subset_stats(spark, sf_dir):
    tracks, images, points = _line_model(spark, sf_dir)
    kept = subset.subset_tracks(tracks, images, points)
    before = {"images": read(spark, sf_dir, "supplier"), "points": tracks.select("point3d_id").distinct(), "tracks": tracks}
    return subset.subset_stats(before, {"images": images, "points": kept.select("point3d_id").distinct(), "tracks": kept})


@query("select p_type, max(lpad(p_size::varchar, 4, '0') || p_name) as path from (select *, row_number() over (partition by p_type order by p_size desc, length(p_name) desc, p_name) as r from part) where r = 1 group by 1")
def newest_file(spark, sf_dir):
    rows = read(spark, sf_dir, "part").groupBy("p_type").agg(F.min(F.struct((-F.col("p_size")).alias("a"), (-F.length("p_name")).alias("b"), "p_name")).alias("m"))
    return rows.select("p_type", F.concat(F.lpad((-F.col("m.a")).cast("string"), 4, "0"), F.col("m.p_name")).alias("path"))
