"""Mixing sources to target weights, in DataFrame operations only.

The words of each source, in a fixed pseudorandom order of its documents, are
packed into blocks of a fixed length. Each source owns as many slots as its
target needs. Every slot is drawn to an output shard at random, which makes
the counts of slots by source and shard a multinomial draw whose totals are
exact, so each source meets its target to the word. A shard's slots are the
running numbers of its counts; they map to blocks through a pseudorandom
permutation of the source's block numbers (swap-or-not rounds, a bijection on
any range), once for each pass over the source, and blocks are joined by
number. A source's last slot may be partial.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parallaxis.llm.common import WORD
from parallaxis.operators.numbering import number_rows, running_sums
from parallaxis.runtime import cut_lineage

#: Words per block, slots that are listed by one row, slots per output shard.
BLOCK, CHUNK, SHARD = 256, 4096, 512
#: Rounds of the permutation, and the prime modulus of its keys.
ROUNDS, PRIME = 12, 2147483647
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, source_col: str = "source", size_col: str = "size") -> DataFrame:
    """One row per source: its number ``s`` (code-point order, null last), size, weight and target.

    Weights repeat 5, 2, 1. Targets share 150% of all sizes by weight; none
    exceeds twice its source, the excess goes to the others by weight until
    none is above. The level at which that holds is found in one pass over
    the sources in the order in which they reach their limit.
    """
    sums = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).alias("source_size"))
    ranked = number_rows(sums, [F.col("source").isNull(), F.asc("source")], "s")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("s") % len(WEIGHTS) + 1).cast("int")).cast("double")
    ranked = ranked.withColumn("weight", weight).withColumn("limit", (F.col("source_size") * MOST).cast("double"))
    ranked = running_sums(ranked.withColumn("fill", F.col("limit") / F.col("weight")), ["fill", "s"], {"full": "limit", "heavy": "weight"})
    every = ranked.agg(F.sum("weight").alias("weight"), F.sum("source_size").alias("size")).first()
    due, weights = float(every["size"] or 0) * SHARE, float(every["weight"] or 0)
    level = F.max((F.lit(due) - (F.col("full") - F.col("limit"))) / (F.lit(weights) - (F.col("heavy") - F.col("weight"))))
    level = ranked.agg(level.alias("level")).first()["level"] or 0.0
    target = F.least(F.col("limit"), F.lit(level) * F.col("weight"))
    return ranked.select("source", F.col("s").cast("long").alias("s"), "source_size", "weight", target.alias("target"))


def _swap(x: Column, r: Column, n: Column) -> Column:
    """One swap-or-not round: x or its mirror image about the round's key, by a bit of the larger."""
    key = ((F.col("s") + 1) * 1000003 + (F.col("pass") + 1) * 7919 + (r + 1) * 104729) * 48271 % PRIME % n
    mirror = F.pmod(key - x, n)
    mixed = (F.greatest(x, mirror) % PRIME * 16807 + (F.col("s") + 1) * 69621 + (F.col("pass") + 1) * 40692 + (r + 1) * 39373) % PRIME
    return F.when(F.floor(mixed * mixed % PRIME / 1024) % 2 == 1, mirror).otherwise(x)


def permute(rows: DataFrame, from_col: str, to_col: str, n: str, backwards: bool = False) -> DataFrame:
    """Permuted number of ``from_col`` within 0..n-1, keyed by columns ``s`` and ``pass``."""
    rounds = F.array(*[F.lit(r).cast("long") for r in range(ROUNDS)[:: -1 if backwards else 1]])
    return rows.withColumn(to_col, F.aggregate(rounds, F.col(from_col).cast("long"), lambda x, r: _swap(x, r, F.col(n))))


def _passes(targets: DataFrame) -> DataFrame:
    """Passes over each source: s, pass, words due, blocks ``n``, the short last block and its slot, slots, output shards."""
    sized = targets.where("source_size > 0").withColumns({"goal": F.floor(F.col("target") + 0.5), "n": F.ceil(F.col("source_size") / BLOCK)})
    goal = sized.agg(F.sum("goal")).first()[0] or 0
    passes = sized.withColumn("shards", F.lit(max(1, -(-goal // (BLOCK * SHARD)))).cast("long"))
    passes = passes.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("goal") / F.col("source_size")))))
    passes = passes.withColumn("words_due", F.least("source_size", F.col("goal") - F.col("pass") * F.col("source_size"))).where("words_due > 0")
    passes = passes.withColumn("short", F.col("source_size") - (F.col("n") - 1) * BLOCK).withColumn("last", F.col("n") - 1)
    passes = permute(passes, "last", "short_at", "n", backwards=True)
    return passes.withColumn("slots", F.least("n", F.ceil((F.col("words_due") + BLOCK - F.col("short")) / BLOCK)))


def draw_counts(passes: DataFrame) -> DataFrame:
    """The draw: ``(s, pass, shard, first, count)``, how many slots each shard has of a pass, and the first one's number."""
    chunks = passes.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK))))
    # a few rows here, but many after the next step: as many tasks as for any exchange, and no broadcast
    parts = int(passes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("chunk") * CHUNK
    drawn = chunks.repartition(parts, "s", "pass", "chunk").withColumn("k", F.explode(F.sequence(first, F.least(first + CHUNK, F.col("slots")) - 1)))
    mixed = (F.col("k") % PRIME * 16807 + (F.col("s") + 1) * 69621 + (F.col("pass") + 1) * 40692 + 977) % PRIME
    shard = (mixed * mixed % PRIME * 48271 + 13) % PRIME % F.col("shards")
    counts = drawn.groupBy("s", "pass", shard.alias("shard")).agg(F.count("*").alias("count"))
    return counts.withColumn("first", F.sum("count").over(Window.partitionBy("s", "pass").orderBy("shard")) - F.col("count"))


def draw_slots(targets: DataFrame) -> DataFrame:
    """All slots of the mix: s, pass, slot, shard, block and ``words``, the words taken from the block's start."""
    passes = cut_lineage(_passes(targets))
    counts = cut_lineage(draw_counts(passes))
    parts = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.repartition(parts, "s", "pass", "shard").join(passes, ["s", "pass"])
    slots = dealt.withColumn("slot", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)))
    start = F.col("slot") * BLOCK - F.when(F.col("slot") > F.col("short_at"), BLOCK - F.col("short")).otherwise(0)
    size = F.when(F.col("slot") == F.col("short_at"), F.col("short")).otherwise(BLOCK)
    slots = slots.withColumn("words", F.least(size, F.col("words_due") - start)).where("words > 0")
    return permute(slots, "slot", "block", "n").select("s", "pass", "slot", "shard", "block", "words")


def place(docs: DataFrame, targets: DataFrame, id_col: str, source_col: str = "source", size_col: str = "size") -> DataFrame:
    """``docs`` with source number and first word position ``at`` in the source (null for sizes of 0).

    Running sums go by groups of hashed id and size: within a group, then over
    the 4096 groups of a source, so no task sees all rows of a hot source or
    all rows without an id.
    """
    own = targets.select(F.col("source").alias("_source"), "s", "source_size", "target")
    rows = docs.join(own, docs[source_col].eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("_g", F.substring(F.md5(F.concat_ws(" ", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(size_col).cast("string"))), 1, 3))
    groups = rows.groupBy("s", "_g").agg(F.sum(size_col).alias("_sum"))
    groups = groups.select("s", "_g", (F.sum("_sum").over(Window.partitionBy("s").orderBy("_g")) - F.col("_sum")).alias("_before"))
    order = Window.partitionBy("s", "_g").orderBy(id_col, size_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_own", F.sum(size_col).over(order) - F.col(size_col)).join(groups, ["s", "_g"])
    at = F.when(F.col(size_col) > 0, F.col("_before") + F.col("_own"))
    return rows.withColumn("at", at).drop("_g", "_own", "_before")


def _overlaps(placed: DataFrame, slots: DataFrame) -> DataFrame:
    """Each stretch of a document that a slot takes: s, at, pass, shard, first word and words, from the document's start."""
    spans = placed.where("size > 0").select("s", "at", "size")
    spans = spans.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / BLOCK), F.floor((F.col("at") + F.col("size") - 1) / BLOCK))))
    joined = spans.join(slots.select("s", "pass", "shard", "block", "words").hint("merge"), ["s", "block"])
    begin, end = F.greatest(F.col("at"), F.col("block") * BLOCK), F.least(F.col("at") + F.col("size"), F.col("block") * BLOCK + F.col("words"))
    return joined.select("s", "at", "pass", "shard", (begin - F.col("at")).alias("first"), (end - begin).alias("taken")).where("taken > 0")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """What the mix takes of every document: id, size, source_size, target, taken, shards.

    ``taken`` counts words with repeats; per source it sums to the target,
    rounded. ``shards`` says which output shards they go to, as ``shard:words``
    in order, and is empty where none are taken. A null text has size 0 and
    takes 0; a null source is a source of its own; repeated rows are separate
    documents; null ids are allowed; an empty table gives no rows. Other
    columns are ignored.
    """
    sized = cut_lineage(_sized(docs, id_col, text_col, source_col))
    targets = cut_lineage(source_targets(sized))
    placed = place(sized, targets, id_col)
    by_shard = _overlaps(placed, draw_slots(targets)).groupBy("s", "at", "shard").agg(F.sum("taken").alias("taken"))
    parts = F.sort_array(F.collect_list(F.struct("shard", "taken")))
    taken = by_shard.groupBy("s", "at").agg(F.sum("taken").alias("taken"), F.array_join(F.transform(parts, lambda p: F.concat_ws(":", p["shard"].cast("string"), p["taken"].cast("string"))), " ").alias("shards"))
    out = placed.join(taken, ["s", "at"], "left")
    return out.select(id_col, "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"), F.coalesce("shards", F.lit("")).alias("shards"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shard_col: str | None = None) -> DataFrame:
    """The mix as documents: one row for each pass over a document, with the words taken, all other columns kept.

    Words are joined by one space. Where blocks take two separate stretches
    of a document in one pass, they are joined in order. A column
    ``n_chars``, where there is one, is the new text's length. With
    ``shard_col`` there is a row for each output shard too, whose number that
    further column holds: what a shard takes of a pass over a document.
    """
    given = docs.columns
    sized = cut_lineage(_sized(docs, id_col, text_col, source_col))
    targets = cut_lineage(source_targets(sized))
    numbered = docs.select(F.struct(*[F.col(c) for c in given]).alias("row"), F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
    placed = place(numbered, targets, "id")
    narrow = place(sized, targets, id_col)
    key = ["s", "at", "pass"] + (["shard"] if shard_col else [])
    stretches = _overlaps(narrow, draw_slots(targets)).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("first", "taken"))).alias("parts"))
    words = F.regexp_extract_all(F.col(f"row.{text_col}"), F.lit(WORD), F.lit(0))
    cut = F.flatten(F.transform("parts", lambda p: F.slice("words", p["first"].cast("int") + 1, p["taken"].cast("int"))))
    out = placed.join(stretches, ["s", "at"]).withColumn("words", words).withColumn("new", F.array_join(cut, " "))
    columns = [F.col("new").alias(c) if c == text_col else F.length("new").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("row")[c].alias(c) for c in given]
    return out.select(*columns, *([F.col("shard").alias(shard_col)] if shard_col else []))


def oracle_sql() -> str:
    """The same mix in DuckDB SQL over ``documents``."""
    step = "x"
    inner = "select *, slot as x from slots"
    for r in range(ROUNDS):
        key = f"((s + 1) * 1000003 + (pass + 1) * 7919 + {(r + 1) * 104729}) * 48271 % {PRIME} % n"
        inner = f"select * replace (case when ((mixed * mixed) % {PRIME} // 1024) % 2 = 1 then mirror else x end as x) from (select *, (greatest(x, mirror) % {PRIME} * 16807 + (s + 1) * 69621 + (pass + 1) * 40692 + {(r + 1) * 39373}) % {PRIME} as mixed from (select * exclude (mirror, mixed), (({key}) - x + n) % n as mirror from ({inner if r else inner.replace('slot as x', 'slot as x, 0::bigint as mirror, 0::bigint as mixed')})))"
    return f"""
with sized as (select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size from documents),
sums as (select source, sum(size)::bigint as source_size, row_number() over (order by source is null, source) - 1 as s from sized group by source),
w as (select *, [5, 2, 1][(s % 3 + 1)::int]::double as weight, (source_size * 2)::double as lim from sums),
f as (select *, sum(lim) over o - lim as full_, sum(weight) over o - weight as heavy, sum(weight) over () as all_weight, (sum(source_size) over ())::bigint as all_size from w window o as (order by lim / weight, s rows unbounded preceding)),
g as (select *, (all_size * 1.5::double - full_) / (all_weight - heavy) as lev from f),
targets as (select *, least(lim, coalesce((select max(lev) from g), 0) * weight) as target from g),
placed as (select doc_id, size, t.s, source_size, target, sum(size) over (partition by t.s order by substr(md5(coalesce(doc_id::varchar, '') || ' ' || size), 1, 3), doc_id, size rows unbounded preceding)::bigint - size as pos from sized d join targets t on d.source is not distinct from t.source),
p0 as (select s, source_size, floor(target + 0.5)::bigint as goal, ((source_size + {BLOCK - 1}) // {BLOCK})::bigint as n from targets where source_size > 0),
p1 as (select *, unnest(range(goal // source_size + 1)) as pass from p0),
slots0 as (select *, least(source_size, goal - pass * source_size) as due, source_size - (n - 1) * {BLOCK} as short from p1 where goal > pass * source_size),
slots as (select s, pass, n, due, short, unnest(range(n)) as slot from slots0),
perm as (select s, pass, n, due, short, slot, {step} as block from ({inner})),
timed as (select *, sum(case when block = n - 1 then short else {BLOCK} end) over (partition by s, pass order by slot)::bigint as upto, case when block = n - 1 then short else {BLOCK} end as len from perm),
drawn as (select s, pass, unnest(range(least(n, (due + {BLOCK} - short + {BLOCK - 1}) // {BLOCK}))) as k, (select greatest(1, (sum(goal) + {BLOCK * SHARD - 1}) // {BLOCK * SHARD})::bigint from p0) as shards from slots0),
mixed as (select s, pass, k, shards, (k % {PRIME} * 16807 + (s + 1) * 69621 + (pass + 1) * 40692 + 977) % {PRIME} as m from drawn),
dealt as (select s, pass, shard, row_number() over (partition by s, pass order by shard) - 1 as slot from (select s, pass, (m * m % {PRIME} * 48271 + 13) % {PRIME} % shards as shard from mixed)),
takes as (select s, shard, block, least(len, due - (upto - len)) as words from timed join dealt using (s, pass, slot) where due > upto - len),
spans as (select s, pos, size, unnest(range(pos // {BLOCK}, (pos + size - 1) // {BLOCK} + 1)) as block from placed where size > 0),
parts as (select s, pos, shard, sum(greatest(0, least(pos + size, block * {BLOCK} + words) - greatest(pos, block * {BLOCK})))::bigint as taken from spans join takes using (s, block) group by s, pos, shard),
got as (select s, pos, sum(taken)::bigint as taken, string_agg(shard || ':' || taken, ' ' order by shard) as shards from parts where taken > 0 group by s, pos)
select doc_id, size, source_size, target, case when size > 0 then coalesce(taken, 0) else 0 end::bigint as taken, case when size > 0 then coalesce(shards, '') else '' end as shards from placed left join got using (s, pos)
"""
