"""N-gram Jaccard join: a MinHash LSH forest proposes, exact verification decides.

Each distinct set of five-word shingles has a signature of ``DEPTH`` hash
values in each tree of the forest; documents below one node of a tree's
prefix trie share a prefix of it. Matched prefixes start at the full depth
and are shortened, a value at a time, until the recall expected of a pair at
the threshold reaches the target: two sets share a value with their Jaccard
similarity as probability, whatever they hold, so no document need be sampled
for it. Every document is signed to that depth. A prefix is held as one 64-bit number, its values in order from the
highest bits, so prefixes sort as the trie does; the nodes of the trie at
that depth are the candidate groups, deeper nodes lie inside them.

Groups of equal members in several trees are verified once. Large groups are
cut into chunks and compared chunk by chunk, so nothing bounds a group's size
and no pairs are sent: a task returns link counts and a spanning forest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallaxis.llm.common import gram_hashes, hash_words, mix, name_again, number, slices, split_words
from parallaxis.operators.components import connected_components
from parallaxis.runtime import cut_lineage

SHINGLE, THRESHOLD = 5, 0.8
#: Trees, their full depth, and the recall to reach at the threshold.
TREES, DEPTH, RECALL = 16, 8, 0.9995
#: Documents that ``fitted_depth`` measures (of least hashed id, none longer than so many bytes), and neighbours made of each.
SAMPLE, LONGEST, MADE = 1024, 1 << 16, 16
#: Members and shingles of a chunk of a large group.
CHUNK_MEMBERS, CHUNK_SHINGLES = 2048, 1 << 20


def prefix_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix whose expected recall, for any pair at the threshold, reaches ``recall``."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _seeds() -> np.ndarray:
    """Multipliers and offsets of the hash functions: trees by depth by two."""
    drawn = np.random.default_rng(20240229).integers(1, 1 << 63, (TREES, DEPTH, 2), np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)


def matched_depths(values: np.ndarray, threshold: float, rng) -> np.ndarray:
    """Longest prefix that a set shares in some tree with each of ``MADE`` subsets of it at the threshold."""
    gone = int(len(values) * (1 - threshold) + 1e-9)
    if not gone:  # only equal sets can be as near
        return np.zeros(0, np.int64)
    out = np.argsort(rng.random((MADE, len(values))), 1) < gone
    best = np.zeros(MADE, np.int64)
    for tree in _seeds():
        alike = np.ones(MADE, bool)
        for k, (a, b) in enumerate(tree):
            hashed = values * a + b
            least = np.where(out, np.uint64(0xFFFFFFFFFFFFFFFF), hashed).min(1)
            alike &= least == hashed.min()
            best[alike] = np.maximum(best[alike], k + 1)
    return best


def fitted_depth(rows: DataFrame, threshold: float, recall: float = RECALL) -> int:
    """Shorten the prefix from ``DEPTH`` until the share of sampled neighbours that meet in some tree reaches ``recall``.

    A measurement that holds ``prefix_depth`` against documents; the join takes nothing from it.
    """
    short = rows.where((F.octet_length("text") > 0) & (F.octet_length("text") <= LONGEST) & F.col("doc").isNotNull())
    chosen = short.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(SAMPLE)
    sample = short.join(F.broadcast(chosen), "key").groupBy("key").agg(F.max("text").alias("text"))

    def measure(table: pa.Table) -> pa.Table:
        rng = np.random.default_rng(5)
        table = table.sort_by("key")
        cuts, values = shingle_sets(pa.array(table.column("text").to_pylist(), pa.string()))
        met = np.concatenate([matched_depths(values[a:b], threshold, rng) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        return pa.table([pa.array([np.bincount(met, minlength=DEPTH + 1).tolist()], pa.list_(pa.int64()))], names=["met"])

    found = sample.select("key", "text", (F.col("key") * 0).alias("one")).groupBy("one").applyInArrow(measure, "met array<long>").collect()
    if not found or not sum(found[0]["met"]):
        return prefix_depth(threshold, TREES, DEPTH, recall)
    met, depth = found[0]["met"], DEPTH
    while depth > 1 and sum(met[depth:]) < recall * sum(met):
        depth -= 1
    return depth


def shingle_sets(texts: pa.Array):
    """``(offsets, hashes)``: the distinct five-word shingles of each text, sorted.

    A text of one to four words has one shingle, all its words; a null text
    or one without words has none.
    """
    offsets, codes, vocabulary = split_words(texts)
    hashes = hash_words(vocabulary)[codes] if len(codes) else np.zeros(0, np.uint64)
    counts = np.diff(offsets)
    grams = gram_hashes(hashes, SHINGLE)
    owner = np.repeat(np.arange(len(counts)), np.maximum(counts - SHINGLE + 1, 0))
    first = np.repeat(offsets[:-1], np.maximum(counts - SHINGLE + 1, 0))
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(np.maximum(counts - SHINGLE + 1, 0)) - np.maximum(counts - SHINGLE + 1, 0), np.maximum(counts - SHINGLE + 1, 0))
    values = grams[first + nth] if len(owner) else np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        whole = [gram_hashes(hashes[offsets[k] : offsets[k + 1]], int(counts[k]))[0] + np.uint64(counts[k]) for k in short]
        owner, values = np.concatenate([owner, short]), np.concatenate([values, np.array(whole, np.uint64)])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    once = np.ones(len(values), bool)
    once[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    owner, values = owner[once], values[once]
    return np.searchsorted(owner, np.arange(len(counts) + 1)), values


def _signatures(depth: int):
    seeds, bits = _seeds(), 64 // depth

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                cuts, values = shingle_sets(batch.column("text"))
                size = np.diff(cuts)
                full = np.flatnonzero(size)
                labels = np.zeros((len(full), TREES), np.uint64)
                total = np.zeros(len(size), np.uint64)
                if len(full):
                    total[full] = np.add.reduceat(mix(values), cuts[full])
                    for tree in range(TREES):
                        for a, b in seeds[tree, :depth]:
                            least = np.minimum.reduceat(values * a + b, cuts[full])
                            labels[:, tree] = labels[:, tree] << np.uint64(bits) | mix(least) >> np.uint64(64 - bits) if bits < 64 else mix(least)
                rows = np.full(len(size), -1)
                rows[full] = np.arange(len(full))
                packed = [labels[r].tobytes() if r >= 0 else None for r in rows]
                yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("key"), pa.array(size), pa.array(total.view(np.int64)), pa.array(packed, pa.binary())], names=["doc", "key", "size", "digest", "labels"])

    return run


def _entries(batches):
    """One row for each tree of each class: tree, label, and what the group needs to know of the member."""
    for batch in batches:
        n = len(batch)
        labels = np.frombuffer(b"".join(batch.column("labels").to_pylist()), np.int64)
        at = pa.array(np.repeat(np.arange(n), TREES))
        yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(TREES, dtype=np.int32), n)), pa.array(labels), batch.column("doc").take(at), batch.column("size").take(at)], names=["tree", "label", "doc", "size"])


def _members(batches):
    """The shingles of candidate documents, once for each block of each of their groups."""
    for whole in batches:
        for batch in slices(whole, "text"):
            cuts, values = shingle_sets(batch.column("text"))
            out = [[] for _ in range(8)]
            docs = batch.column("doc").to_numpy()
            for k, groups in enumerate(batch.column("groups").to_pylist()):
                blob = values[cuts[k] : cuts[k + 1]].tobytes()
                labels, copies = batch.column("labels")[k].as_py(), batch.column("copies")[k].as_py()
                for g in groups:
                    chunk = int(mix(np.array([docs[k]]).view(np.uint64))[0] % np.uint64(g["chunks"]))
                    for other in range(g["chunks"]):
                        for column, value in zip(out, (g["tree"], g["label"], min(chunk, other), max(chunk, other), int(docs[k]), copies, labels, blob), strict=True):
                            column.append(value)
                    if len(out[7]) * len(blob) > 8 << 20:
                        yield _member_batch(out)
                        out = [[] for _ in range(8)]
            if out[0]:
                yield _member_batch(out)


def _member_batch(out):
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["tree", "label", "a", "b", "doc", "copies", "labels", "shingles"])


def intersections(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """n x n counts of common values of sets given as (owner, value) without repeats."""
    order = np.lexsort((owner, values))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    group = np.cumsum(new) - 1
    times = np.bincount(group)
    out = np.zeros((n, n), np.float32)
    rare = 8
    low = (times[group] <= rare) & (times[group] > 1)
    o, g = owner[low], group[low]
    for gap in range(1, rare):
        same = np.flatnonzero(g[gap:] == g[:-gap]) if len(g) > gap else []
        if not len(same):
            break
        np.add.at(out, (o[same], o[same + gap]), 1)
    out += out.T
    high = times > rare
    number = np.cumsum(high) - 1
    chosen = high[group]
    o, g = owner[chosen], number[group[chosen]]
    width = max(256, (1 << 23) // max(n, 1))
    for start in range(0, int(high.sum()), width):
        inside = (g >= start) & (g < start + width)
        block = np.zeros((n, min(width, int(high.sum()) - start)), np.float32)
        block[o[inside], g[inside] - start] = 1
        out += block @ block.T
    return out


def _verify(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        tree, a, b = (table.column(c)[0].as_py() for c in ("tree", "a", "b"))
        docs, first = np.unique(table.column("doc").to_numpy(), return_index=True)
        copies = table.column("copies").to_numpy()[first]
        sets = [np.frombuffer(table.column("shingles")[int(k)].as_py(), np.uint64) for k in first]
        labels = np.array([np.frombuffer(table.column("labels")[int(k)].as_py(), np.int64) for k in first])
        n = len(docs)
        size = np.array([len(s) for s in sets])
        common = intersections(np.repeat(np.arange(n), size), np.concatenate(sets), n)
        links = np.zeros(n, np.int64)
        near = np.zeros((n, n), bool)
        chunk = (mix(docs.view(np.uint64)) % np.uint64(table.column("chunks")[0].as_py())).astype(np.int64)
        for s in range(0, n, 256):
            part = slice(s, min(s + 256, n))
            joint = common[part].astype(np.float64)
            ok = joint >= threshold * (size[part, None] + size[None, :] - joint) - 1e-9
            ok[np.arange(ok.shape[0]), np.arange(s, s + ok.shape[0])] = False
            if a != b:  # pairs inside a chunk are the business of its own block
                ok &= chunk[part, None] != chunk[None, :]
            near[part] = ok
            row, col = np.nonzero(ok)
            mine = np.ones(len(row), bool)
            for t in range(tree):  # counted in the first tree in which the pair meets
                mine &= labels[s + row, t] != labels[col, t]
            links[part] += np.bincount(row[mine], copies[col[mine]], ok.shape[0]).astype(np.int64)
        root = np.full(n, -1)
        for k in range(n):
            if root[k] >= 0 or not near[k].any():
                continue
            front = np.array([k])
            root[k] = k
            while len(front):
                front = np.flatnonzero(near[front].any(0) & (root < 0))
                root[front] = k
        live = np.flatnonzero(root >= 0)
        return pa.table([pa.array(docs[live]), pa.array(links[live]), pa.array(docs[root[live]])], names=["doc", "links", "root"])

    return run


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, class_id, n_links, component_id, kept.

    Documents link when the Jaccard similarity of their sets of five-word
    shingles is at least ``threshold``. ``class_id`` is the smallest id with
    the same set, ``n_links`` the number of other documents linked directly
    (copies included), ``component_id`` the smallest id reachable by links,
    ``kept`` whether the document is the one of its component that stays.
    Documents without words, and rows with a null id, link with nothing;
    repeated rows are copies of each other and carry the same flag. Ids that
    are no whole numbers are ordered by their hash, which ``class_id`` and
    ``component_id`` then hold (see ``number``). Other columns are ignored;
    an empty table gives no rows.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(number(docs, id_col).alias("doc"), F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))
    depth = prefix_depth(threshold, TREES, DEPTH, RECALL)
    signed = cut_lineage(rows.mapInArrow(_signatures(depth), "doc long, key long, size long, digest long, labels binary"))
    known = signed.where("doc is not null and size > 0")
    classes = known.groupBy("digest", "size").agg(F.min(F.struct("doc", "key", "labels")).alias("rep"), F.count("*").alias("copies"))
    classes = cut_lineage(classes.select("digest", "size", F.col("rep.doc").alias("doc"), F.col("rep.key").alias("key"), F.col("rep.labels").alias("labels"), "copies"))
    entries = classes.select("labels", "doc", "size").mapInArrow(_entries, "tree int, label long, doc long, size long")
    entries = cut_lineage(entries)
    groups = entries.groupBy("tree", "label").agg(F.count("*").alias("n"), F.sum("size").alias("total"), F.sum(F.xxhash64("doc").bitwiseAND(F.lit((1 << 40) - 1))).alias("who"), F.min("doc").alias("low"), F.max("doc").alias("high")).where("n > 1")
    groups = groups.groupBy("n", "total", "who", "low", "high").agg(F.min(F.struct("tree", "label")).alias("g"))
    chunks = F.greatest(F.ceil(F.col("n") / CHUNK_MEMBERS), F.ceil(F.col("total") / CHUNK_SHINGLES)).cast("int")
    groups = groups.select(F.col("g.tree").alias("tree"), F.col("g.label").alias("label"), chunks.alias("chunks"))
    wanted = entries.join(groups, ["tree", "label"]).groupBy("doc").agg(F.collect_list(F.struct("tree", "label", "chunks")).alias("groups"))
    wanted = wanted.join(classes.select("doc", "key", "labels", "copies"), "doc")
    members = rows.join(wanted.withColumnRenamed("doc", "_doc"), (F.col("doc") == F.col("_doc")) & (rows["key"] == wanted["key"])).select("doc", "text", "groups", "labels", "copies")
    members = members.mapInArrow(_members, "tree int, label long, a int, b int, doc long, copies long, labels binary, shingles binary")
    members = members.join(groups, ["tree", "label"])
    found = cut_lineage(members.groupBy("tree", "label", "a", "b").applyInArrow(_verify(threshold), "doc long, links long, root long"))
    links = found.groupBy("doc").agg(F.sum("links").alias("links"))
    component = connected_components(found, "doc", "root").withColumnRenamed("id", "doc")
    of_class = classes.join(links, "doc", "left").join(component, "doc", "left").select("digest", "size", F.col("doc").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "doc").alias("component_id"))
    key = F.when(F.col("doc").isNotNull() & (F.col("size") > 0), F.col("digest"))
    out = signed.withColumn("_d", key).join(of_class.withColumnRenamed("digest", "_d"), ["_d", "size"], "left")
    out = out.select("doc", "key", F.coalesce("class_id", "doc").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "doc").alias("component_id"))
    out = out.select("doc", "class_id", "n_links", "component_id", F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)).alias("kept"))
    return name_again(out, docs, id_col, "doc")


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each component, all columns kept.

    Rows with a null id stay. Where the id that stays is on several rows of
    one text, the least of them (in all columns, nulls first) stays.
    """
    kept = jaccard_join(docs, id_col, text_col, threshold).where("kept").select(id_col).distinct()
    given = docs.columns
    named = docs.where(F.col(id_col).isNotNull()).join(kept, id_col, "left_semi")
    least = named.groupBy(id_col, text_col).agg(F.min(F.struct(*[F.col(c) for c in given])).alias("_row"))
    return least.select(*[F.col("_row")[c].alias(c) for c in given]).unionByName(docs.where(F.col(id_col).isNull()))


def oracle_sql() -> str:
    """The join in DuckDB SQL over ``documents``, by the inverted index of all shingles."""
    return """
with recursive w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
sh as (select distinct doc_id, array_to_string(words[i:i + 4], ' ') as g from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from w where len(words) > 0)),
n as (select doc_id, count(*) as n, md5(string_agg(g, chr(10) order by g)) as sig from sh group by doc_id),
cls as (select doc_id, min(doc_id) over (partition by sig) as class_id from n),
common as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.g = b.g and a.doc_id <> b.doc_id group by all),
links as (select x, y from common join n p on p.doc_id = x join n q on q.doc_id = y where c >= 0.8 * (p.n + q.n - c) - 1e-9),
reach(x, y) as (select doc_id, doc_id from documents union select r.x, l.y from reach r join links l on l.x = r.y),
comp as (select x, min(y) as component_id from reach group by x),
deg as (select x, count(*) as n_links from links group by x)
select d.doc_id, coalesce(class_id, d.doc_id) as class_id, coalesce(n_links, 0)::bigint as n_links, component_id, d.doc_id = component_id as kept
from documents d left join cls on cls.doc_id = d.doc_id left join deg on deg.x = d.doc_id join comp on comp.x = d.doc_id
"""
