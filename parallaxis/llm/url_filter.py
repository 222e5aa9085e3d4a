"""URL filters: rules on hosts and paths, and link-graph propagation, in DataFrame operations only.

Rules decide the urls that they fit. Elsewhere the host's standing decides:
personalised PageRank carries trust from hosts with allowed pages along the
links between hosts, and distrust from hosts with blocked pages against them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallaxis.runtime import cut_lineage

#: (verdict, host, path): fits the host and its subdomains where the path starts so; the longest wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Share of a host's standing that follows links.
DAMPING = 0.85
#: Propagation ends when what is still under way can change no verdict, or is less than this.
TOLERANCE = 1e-9
#: Rounds of the SQL: what they leave under way is below TOLERANCE.
SQL_ROUNDS = 160
#: A host is blocked if its distrust exceeds its trust and that of a host with half of its pages blocked,
#: by more than MARGIN, which the order of a sum of doubles cannot make up.
LEAST, MARGIN = (1 - DAMPING) / 2, 1e-6
#: Hosts with more than this share of all pages (so no more than 1 / HOT of them) take their verdict by broadcast.
HOT = 0.001

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#\"'\s>]+)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lowered, and path; both empty for a null url or one without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    # the first :// is the one that has none before it
    first = F.regexp_extract(text, r"^[\s\S]*?://([\s\S]*)", 1)
    host = F.regexp_extract(first, r"^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(first, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule, as ``host/path``, and its verdict; nulls where none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:], r[0]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in ordered]
    none = F.lit(None).cast("string")
    name = F.coalesce(*[F.when(f, F.lit(h + p)) for f, (_, h, p) in zip(fits, ordered, strict=True)], none)
    verdict = F.coalesce(*[F.when(f, F.lit(v)) for f, (v, _, _) in zip(fits, ordered, strict=True)], none)
    return name, verdict


def host_links(pages: DataFrame, host_col: str, html_col: str) -> DataFrame:
    """``(src, dst, share)``: links between different hosts, as a share of the links of ``src``."""
    targets = F.array_distinct(F.regexp_extract_all(F.col(html_col).cast("string"), F.lit(LINK), F.lit(1)))
    found = pages.where(F.col(html_col).contains("//")).select(F.col(host_col).alias("src"), F.explode(targets).alias("dst"))
    found = found.select("src", F.translate("dst", UPPER, LOWER).alias("dst")).where("src <> dst and src <> '' and dst <> ''")
    links = found.groupBy("src", "dst").agg(F.count("*").alias("n"))
    totals = links.groupBy("src").agg(F.sum("n").alias("total"))
    return links.join(totals, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share"))


def standing(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """``(host, trust, distrust)`` from ``(host, trusted, blocked)`` shares of pages.

    Trust follows links by the linking host's shares; distrust goes the other
    way, by the shares of each host's incoming links. What a host without
    links would pass on is lost. Each round passes on what the last one
    brought. All later rounds together bring no host more than the sum of the
    last ``change`` times DAMPING / (1 - DAMPING); once no host's verdict
    hangs on that, or it is under ``TOLERANCE``, the rounds end.
    """
    links = cut_lineage(links)
    start = seeds.select("host", F.explode(F.create_map(F.lit("trust"), F.col("trusted"), F.lit("distrust"), F.col("blocked"))).alias("kind", "seed")).where("seed > 0")
    start = cut_lineage(start)
    rank = start.select("host", "kind", (F.col("seed") * (1 - DAMPING)).alias("rank"))
    if not links.isEmpty():
        incoming = links.groupBy("dst").agg(F.sum("share").alias("total"))
        backwards = links.join(incoming, "dst").select(F.col("dst").alias("host"), F.lit("distrust").alias("kind"), F.col("src").alias("to"), (F.col("share") / F.col("total")).alias("share"))
        moves = cut_lineage(links.select(F.col("src").alias("host"), F.lit("trust").alias("kind"), F.col("dst").alias("to"), "share").unionByName(backwards))
        rank = rank.withColumn("change", F.col("rank"))
        while True:
            for _ in range(2):
                passed = moves.join(rank.where("change > 0"), ["host", "kind"]).select(F.col("to").alias("host"), "kind", (F.col("share") * F.col("change") * DAMPING).alias("rank"))
                passed = passed.withColumn("change", F.col("rank"))
                rank = rank.withColumn("change", F.lit(0.0)).unionByName(passed).groupBy("host", "kind").agg(F.sum("rank").alias("rank"), F.sum("change").alias("change"))
            rank = cut_lineage(rank)
            if _settled(rank):
                break
    return _by_kind(rank)


def _by_kind(rank: DataFrame) -> DataFrame:
    value = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)
    return rank.groupBy("host").agg(value("trust"), value("distrust"))


def _settled(rank: DataFrame) -> bool:
    """Whether no later round can change a verdict, or only by less than ``TOLERANCE``."""
    left = {r["kind"]: r["left"] * DAMPING / (1 - DAMPING) for r in rank.groupBy("kind").agg(F.sum("change").alias("left")).collect()}
    trust, distrust = left.get("trust", 0.0), left.get("distrust", 0.0)
    if max(trust, distrust) < TOLERANCE:
        return True
    sure, possible = _blocked(F.col("trust") + trust, F.col("distrust")), _blocked(F.col("trust"), F.col("distrust") + distrust)
    return _by_kind(rank).where(possible & ~sure).isEmpty()


def _blocked(trust: Column, distrust: Column) -> Column:
    return distrust > F.greatest(trust, F.lit(LEAST)) + MARGIN


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    Urls that no rule fits take their host's verdict; the empty host, hosts
    without standing and hosts whose distrust is low are allowed. Repeated
    rows and null ids pass through; a null html has no links; other columns
    are ignored; an empty table gives no rows.

    The hosts that hold much of all pages are few; their verdicts are
    broadcast, and only rows of other hosts are dealt by host.
    """
    rules = tuple(rules)
    host, path = host_and_path(F.col(url_col))
    split = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"), F.col(html_col).cast("string").alias("html"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    named = split.withColumns({"rule": name, "by_rule": verdict})
    seeds = named.where("host <> ''").groupBy("host").agg(F.avg((F.col("by_rule").eqNullSafe("allow")).cast("double")).alias("trusted"), F.avg((F.col("by_rule").eqNullSafe("block")).cast("double")).alias("blocked"), F.count("*").alias("pages"))
    seeds = cut_lineage(seeds)
    found = standing(seeds, host_links(split, "host", "html"))
    bad = cut_lineage(found.where(_blocked(F.col("trust"), F.col("distrust"))).select("host", F.lit("block").alias("by_host")))
    most = (seeds.agg(F.sum("pages")).first()[0] or 0) * HOT
    hot = seeds.where(F.col("pages") > most).join(bad, "host", "left").select("host", F.coalesce("by_host", F.lit("allow")).alias("by_hot"))
    out = named.drop("html").join(F.broadcast(hot), "host", "left").withColumn("verdict", F.coalesce("by_rule", "by_hot", F.when(F.col("host") == "", "allow")))
    # rows that have their verdict meet no host: their keys (no host holds a slash) spread them over all tasks
    key = F.when(F.col("verdict").isNull(), F.col("host")).otherwise(F.concat(F.lit("/"), F.xxhash64("_id", "host", "path").cast("string")))
    out = out.withColumn("_key", key).join(bad.withColumnRenamed("host", "_key"), "_key", "left")
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", "by_host", F.lit("allow")).alias("verdict"))


def oracle_sql(rules=RULES) -> str:
    """The same in DuckDB SQL over ``pages``, all rounds spelled as recursion."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:], r[0]))
    fits = [f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')" for _, h, p in ordered]
    name = " ".join(f"when {f} then '{h}{p}'" for f, (_, h, p) in zip(fits, ordered, strict=True))
    verdict = " ".join(f"when {f} then '{v}'" for f, (v, _, _) in zip(fits, ordered, strict=True))
    link = LINK.removeprefix("(?i)").replace("'", "''")
    return f"""
with recursive u as (select page_id, html, case when contains(url, '://') then url[strpos(url, '://') + 3:] else '' end as rest from pages),
h as (select page_id, html, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') as host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from u),
named as (select *, case {name} end as rule, case {verdict} end as by_rule from h),
found as (select host as src, translate(unnest(list_distinct(regexp_extract_all(html, '{link}', 1, 'i'))), '{UPPER}', '{LOWER}') as dst from named),
n as (select src, dst, count(*) as n from found where src <> dst and src <> '' and dst <> '' group by all),
links as (select src, dst, n / sum(n) over (partition by src) as share from n),
moves as materialized (select src as host, 'trust' as kind, dst as target, share from links union all select dst, 'distrust', src, share / sum(share) over (partition by dst) from links),
seeds as (select host, avg((by_rule is not distinct from 'allow')::int) as trusted, avg((by_rule is not distinct from 'block')::int) as blocked from named where host <> '' group by host),
r(k, host, kind, part) as (
  select 0, host, 'trust', trusted * {1 - DAMPING} from seeds where trusted > 0
  union all select 0, host, 'distrust', blocked * {1 - DAMPING} from seeds where blocked > 0
  union all select k + 1, target, kind, sum(part) from (select r.k, m.target, m.kind, m.share * r.part * {DAMPING} as part from r join moves m on r.host = m.host and r.kind = m.kind where r.k < {SQL_ROUNDS}) group by all),
s as (select host, coalesce(sum(part) filter (kind = 'trust'), 0) as trust, coalesce(sum(part) filter (kind = 'distrust'), 0) as distrust from r group by host),
bad as (select host from s where distrust > greatest(trust, {LEAST}) + {MARGIN})
select page_id, named.host, path, rule, coalesce(by_rule, case when bad.host is not null then 'block' end, 'allow') as verdict from named left join bad on bad.host = named.host
"""
