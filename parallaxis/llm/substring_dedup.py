"""Substring deduplication: FM-indexes of shards find long passages that documents share.

1. Every window of 13 words has an anchor, the least of its hashed 5-word
   runs. Equal windows have equal anchors, so anchors choose the shard.
2. Anchors of only one document cannot repeat a window; a first, narrow
   exchange of anchor hashes tells which are shared.
3. Around shared anchors, the stretch of words whose windows have that anchor
   goes to the anchor's shard. Stretches that recur within a batch go once,
   for the smallest document; copies are answered on the spot. So a passage
   that a third of all rows hold reaches its shard once a batch.
4. A shard indexes its distinct stretches (compressed FM-index) and streams
   them through backward search: matching statistics say which windows occur
   elsewhere, the suffix interval which smallest document holds them.
5. Intervals return to their documents, which lose the words they cover.

There are two shards for each shuffle partition, and more once the counted
bytes of text call for them, so a shard's size doesn't grow with the corpus.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallaxis.llm.common import gram_hashes, hash_words, mix, name_again, number, slices, split_words
from parallaxis.llm.fm_index import FMIndex

#: Words of an anchor. Windows hold WINDOW words unless told otherwise.
ANCHOR, WINDOW = 5, 13
#: Bytes of text for each shard at most, and suffixes of intervals that are located at once.
SHARD_BYTES, LOCATED = 32 << 20, 1 << 18


def anchors(hashes: np.ndarray, offsets: np.ndarray, window: int):
    """``(window start, anchor hash)`` of every window inside a document, in order."""
    grams = gram_hashes(hashes, ANCHOR)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best = grams[:n].copy()
    for k in range(1, window - ANCHOR + 1):
        np.minimum(best, grams[k : k + n], out=best)
    inside = np.ones(n, bool)
    for end in offsets[1:-1]:
        inside[max(0, end - window + 1) : end] = False
    starts = np.flatnonzero(inside)
    return starts, best[starts]


def _batch(batch, window):
    """Word hashes, offsets, window starts, their anchors and documents of one batch with (key, doc, text)."""
    offsets, codes, vocabulary = split_words(batch.column("text"))
    hashes = hash_words(vocabulary)[codes] if len(codes) else np.zeros(0, np.uint64)
    starts, anchor = anchors(hashes, offsets, window)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return hashes, offsets, starts, anchor, owner


def _short(anchor: np.ndarray, shards: int):
    """Shard of each anchor, and 32 more of its bits."""
    return (anchor % np.uint64(shards)).astype(np.int64), ((anchor // np.uint64(shards)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _by_shard(shard: np.ndarray, shards: int):
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        yield int(s), order[cuts[s] : cuts[s + 1]]


def _by_document(owner: np.ndarray, values: np.ndarray, keys: np.ndarray):
    """Keys and packed values of each document that has any."""
    order = np.argsort(owner, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(owner[order]) != 0, [True]])) if len(order) else [0]
    found = [(int(keys[owner[order[a]]]), values[order[a:b]].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [k for k, _ in found], [v for _, v in found]


def _send_anchors(window, shards):
    """Rows (shard, docs, codes) of distinct anchors by shard, or (key, shared) answered here, for any shard to pass on.

    Of the documents of a batch that share an anchor one is sent; the batch
    itself tells the others, so a common anchor costs a row a batch.
    """

    def run(batches):
        for whole in batches:
            for batch in slices(whole.filter(pc.and_(pc.is_valid(whole["doc"]), pc.is_valid(whole["text"]))), "text"):
                keys = batch.column("key").to_numpy()
                _, _, _, anchor, owner = _batch(batch, window)
                shard, code = _short(anchor, shards)
                value = shard << 32 | code.astype(np.int64)
                order = np.lexsort((owner, value))
                value, owner = value[order], owner[order]
                new_value = np.concatenate([[True], value[1:] != value[:-1]])[: len(value)]
                once = new_value | np.concatenate([[True], owner[1:] != owner[:-1]])[: len(value)]
                value, owner, new_value = value[once], owner[once], new_value[once]
                group = np.cumsum(new_value) - 1
                several = (np.bincount(group) > 1)[group] if len(group) else new_value
                answered, blobs = _by_document(owner[several], value[several], keys)
                n = len(answered)
                rows = [[k % shards for k in answered], [None] * n, [None] * n, answered, blobs]
                value, owner = value[new_value], owner[new_value]
                for s, at in _by_shard(value >> 32, shards):
                    at = at[np.argsort(owner[at], kind="stable")]
                    docs, counts = np.unique(owner[at], return_counts=True)
                    rows[0].append(s)
                    rows[1].append(struct.pack("<q", len(docs)) + keys[docs].tobytes() + counts.astype("<i4").tobytes())
                    rows[2].append((value[at] & 0xFFFFFFFF).astype("<u4").tobytes())
                    rows[3].append(None)
                    rows[4].append(None)
                if rows[0]:
                    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=["shard", "docs", "codes", "key", "shared"])

    return run


def _shared_anchors(table: pa.Table) -> pa.Table:
    """Of one shard: the anchors that two documents have, as (key, shared) rows."""
    shard = table.column("shard")[0].as_py()
    answered, table = table.filter(pc.is_valid(table["key"])), table.filter(pc.is_null(table["key"]))
    answered = answered.select(["key", "shared"])
    if not len(table):
        return answered
    keys, counts, codes = [], [], []
    for docs, code in zip(table.column("docs").to_pylist(), table.column("codes").to_pylist(), strict=True):
        n = struct.unpack_from("<q", docs)[0]
        keys.append(np.frombuffer(docs, "<i8", n, 8))
        counts.append(np.frombuffer(docs, "<i4", n, 8 + 8 * n))
        codes.append(np.frombuffer(code, "<u4"))
    keys, counts, codes = np.concatenate(keys), np.concatenate(counts), np.concatenate(codes)
    owner = np.repeat(np.arange(len(keys)), counts)
    order = np.argsort(codes, kind="stable")
    near = codes[order[1:]] == codes[order[:-1]]
    twice = np.zeros(len(codes), bool)
    twice[order] = np.concatenate([[False], near]) | np.concatenate([near, [False]])
    found, blobs = _by_document(owner[twice], shard << 32 | codes[twice].astype(np.int64), keys)
    return pa.concat_tables([answered, pa.table([pa.array(found, pa.int64()), pa.array(blobs, pa.binary())], names=["key", "shared"])])


def _send_stretches(window, shards):
    """Rows for documents with shared anchors: (shard, blob) to index, or (key, intervals) answered here."""

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                yield from _stretches(batch, window, shards)

    return run


def _stretches(batch, window, shards):
    keys, docs = batch.column("key").to_numpy(), batch.column("doc").to_numpy()
    hashes, offsets, starts, anchor, owner = _batch(batch, window)
    if not len(starts):
        return
    shard, code = _short(anchor, shards)
    marked = np.zeros(len(starts), bool)
    cuts = np.searchsorted(owner, np.arange(len(batch) + 1))
    for n, blobs in enumerate(batch.column("shared").to_pylist()):
        a, b = cuts[n], cuts[n + 1]
        if blobs and b > a:
            known = np.concatenate([np.frombuffer(x, "<i8") for x in blobs])
            marked[a:b] = np.isin(shard[a:b] << 32 | code[a:b].astype(np.int64), known)
    live = np.flatnonzero(marked)
    if not len(live):
        return
    # a stretch: consecutive windows of one document with one anchor
    new = np.ones(len(live), bool)
    new[1:] = (np.diff(live) != 1) | (anchor[live[1:]] != anchor[live[:-1]]) | (owner[live[1:]] != owner[live[:-1]])
    head = np.flatnonzero(new)
    count = np.diff(np.concatenate([head, [len(live)]]))
    first = starts[live[head]]
    words = count + window - 1
    who = owner[live[head]]
    route = shard[live[head]]
    # equal stretches: compared by a 64-bit sum over place-mixed words
    flat = np.repeat(first - (np.cumsum(words) - words), words) + np.arange(words.sum())
    place = np.arange(words.sum()) - np.repeat(np.cumsum(words) - words, words)
    digest = np.add.reduceat(mix(hashes[flat] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), np.cumsum(words) - words) + words.astype(np.uint64)
    order = np.lexsort((docs[who], digest))
    same = np.concatenate([[False], digest[order[1:]] == digest[order[:-1]]])
    group = np.cumsum(~same) - 1
    least = docs[who[order[~same]]][group]
    repeat = np.zeros(len(order), bool)
    repeat[order] = docs[who[order]] > least
    begin = first - offsets[who]
    at = np.flatnonzero(repeat)
    answered, blobs = _by_document(who[at], np.column_stack([begin[at], begin[at] + words[at]]).astype("<i4"), keys)
    out = [[k % shards for k in answered], [None] * len(answered), answered, blobs]
    go = np.flatnonzero(~repeat)
    tail = np.cumsum(words) - words
    for s, at in _by_shard(route[go], shards):
        at = go[at]
        text = hashes[np.concatenate([flat[tail[k] : tail[k] + words[k]] for k in at])]
        out[0].append(s)
        out[1].append(struct.pack("<q", len(at)) + docs[who[at]].astype("<i8").tobytes() + keys[who[at]].astype("<i8").tobytes() + begin[at].astype("<i4").tobytes() + words[at].astype("<i4").tobytes() + (text & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (text >> np.uint64(48)).astype("<u2").tobytes())
        out[2].append(None)
        out[3].append(None)
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())], names=["shard", "blob", "key", "spans"])


def _least_of(index: FMIndex, lo: np.ndarray, hi: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The least of ``docs`` (by segment) in each interval of rows."""
    out = np.empty(len(lo), np.int64)
    ends = np.cumsum(hi - lo)
    a = 0
    while a < len(lo):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + LOCATED, side="right")))
        size = hi[a:b] - lo[a:b]
        rows = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo[a:b], size)
        out[a:b] = np.minimum.reduceat(docs[index.segment(rows)], np.cumsum(size) - size)
        a = b
    return out


def _search(window):
    """Of one shard: index its distinct stretches, stream them, return (key, intervals)."""

    def run(table: pa.Table) -> pa.Table:
        answered, table = table.filter(pc.is_valid(table["key"])), table.filter(pc.is_null(table["key"]))
        answered = answered.select(["key", "spans"])
        if not len(table):
            return answered
        parts = [[], [], [], [], []]
        for blob in table.column("blob").to_pylist():
            n = struct.unpack_from("<q", blob)[0]
            at = 8
            for k, kind in enumerate(("<i8", "<i8", "<i4", "<i4")):
                parts[k].append(np.frombuffer(blob, kind, n, at))
                at += n * int(kind[2])
            total = int(parts[3][-1].sum())
            low, high = np.frombuffer(blob, "<u4", total, at), np.frombuffer(blob, "<u2", total, at + 4 * total)
            parts[4].append(high.astype(np.int64) << 32 | low)  # 48 bits of each word's hash
        docs, keys, begin, words, hashes = (np.concatenate(x) for x in parts)
        _, symbols = np.unique(hashes, return_inverse=True)
        del hashes, parts
        words = words.astype(np.int64)
        head = np.cumsum(words) - words
        place = np.arange(len(symbols)) - np.repeat(head, words)
        digest = np.add.reduceat(mix((symbols.astype(np.uint64) << np.uint64(16)) + place.astype(np.uint64)), head) + words.astype(np.uint64)
        order = np.lexsort((docs, digest))
        new = np.concatenate([[True], digest[order[1:]] != digest[order[:-1]]])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        kept = order[new]  # of equal stretches the one of the smallest document
        least = docs[kept]
        size = words[kept]
        spot = np.cumsum(size + 1) - size - 1
        text = np.zeros(int((size + 1).sum()), np.int64)
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        text[np.repeat(spot, size) + inner] = symbols[np.repeat(head[kept], size) + inner] + 1
        index = FMIndex(text)
        windows = size - window + 1
        nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        start = np.repeat(spot, windows) + nth
        stretch = np.repeat(np.arange(len(kept)), windows)
        covered = np.zeros(len(start), bool)
        for a in range(0, len(start), 1 << 18):  # streamed
            alive, lo, hi = index.matching(text, start[a : a + (1 << 18)] + window, window)
            if len(alive):
                found, back = np.unique(lo, return_inverse=True)
                top = np.zeros(len(found), np.int64)
                top[back] = hi
                low = _least_of(index, found, top, least)
                covered[a + alive] = low[back] < least[stretch[a + alive]]
        later = docs > least[group]
        out_key, out_spans = [], []
        hit = np.flatnonzero(covered)
        edges = np.searchsorted(stretch[hit], np.arange(len(kept) + 1))
        spans = {}
        for g in np.flatnonzero(np.diff(edges)):
            at = nth[hit[edges[g] : edges[g + 1]]]
            first = at[np.concatenate([[True], np.diff(at) > window])]  # apart by more than a window: a gap may remain
            cut = np.flatnonzero(np.concatenate([[True], np.diff(at) > window, [True]]))
            last = at[cut[1:] - 1] + window
            spans[int(g)] = np.column_stack([first, last])
        rows = np.flatnonzero(later | np.isin(group, list(spans)))
        rows = rows[np.argsort(keys[rows], kind="stable")]
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(keys[rows]) != 0, [True]])) if len(rows) else np.zeros(1, np.int64)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            found = [np.array([[begin[k], begin[k] + words[k]]]) if later[k] else spans[int(group[k])] + begin[k] for k in rows[a:b]]
            out_key.append(int(keys[rows[a]]))
            out_spans.append(np.concatenate(found).astype("<i4").tobytes())
        return pa.concat_tables([answered, pa.table([pa.array(out_key, pa.int64()), pa.array(out_spans, pa.binary())], names=["key", "spans"])])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str, rest: list[str]) -> DataFrame:
    """``(key, doc, text, rest)``; the key tells apart rows of one id with different texts.

    Both joins of the plan take these very rows, so Spark deals the texts once.
    """
    text = F.col(text_col).cast("string")
    other = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(None).cast("byte")
    return docs.select(F.xxhash64(F.col(id_col), text).alias("key"), number(docs, id_col).alias("doc"), text.alias("text"), other.alias("rest"))


def covered_spans(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(key, spans)`` of rows ``(key, doc, text, ...)``: word intervals, packed pairs of 32-bit begin and end, that repeat smaller documents.

    ``key`` is the 64-bit hash of id and text. Only documents with such
    intervals appear; intervals may overlap.
    """
    if window < ANCHOR:
        raise ValueError(f"windows hold {ANCHOR} words at least")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    sent = rows.select("key", "doc", "text").mapInArrow(_send_anchors(window, shards), "shard int, docs binary, codes binary, key long, shared binary")
    shared = sent.groupBy("shard").applyInArrow(_shared_anchors, "key long, shared binary")
    shared = shared.groupBy("key").agg(F.collect_list("shared").alias("shared"))
    marked = rows.join(shared, "key")
    found = marked.mapInArrow(_send_stretches(window, shards), "shard int, blob binary, key long, spans binary")
    searched = found.groupBy("shard").applyInArrow(_search(window), "key long, spans binary")
    return searched.groupBy("key").agg(F.collect_list("spans").alias("spans"))


def _keep(text: str | None, spans) -> tuple[int, int, str]:
    """Words, words removed, and the kept words joined by one space."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    gone = 0
    if spans:
        pairs = np.unique(np.concatenate([np.frombuffer(x, "<i4").reshape(-1, 2) for x in spans]), axis=0)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, pairs[:, 0], 1)
        np.subtract.at(change, pairs[:, 1], 1)
        cover = np.cumsum(change[:-1]) > 0
        gone = int(cover.sum())
        kept = [words[k] for k in np.flatnonzero(~cover)]
    else:
        kept = words
    return len(words), gone, b" ".join(kept)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, digest: bool = False, counts: bool = True) -> DataFrame:
    """Documents without the words that windows of smaller documents hold.

    The text becomes the kept words joined by one space (a text that loses
    nothing stays as it is). With ``counts`` the columns ``n_words`` and
    ``n_removed`` are added, in place of given ones of these names; without
    it the columns are those given. With ``digest`` only id, n_words,
    n_removed and kept_sha256 are returned. Windows are judged on the input.
    A null text has no words; a row without id neither removes nor loses
    words; rows that repeat an id don't remove from each other; ids that are
    no whole numbers are ordered by their hash (see ``number``); an empty
    table gives no rows.
    """
    given = [c for c in docs.columns if not (counts and c in ("n_words", "n_removed"))]
    rest = [] if digest else [c for c in given if c != text_col]
    rows = _keyed(docs, id_col, text_col, rest)
    marked = rows.join(covered_spans(rows, window), "key", "left")
    if digest:

        def summarise(batches):
            for batch in batches:
                n, gone, sha = [], [], []
                for text, own in zip(batch.column("text"), batch.column("spans"), strict=True):
                    a, b, kept = _keep(text.as_py(), own.as_py())
                    n.append(a)
                    gone.append(b)
                    sha.append(hashlib.sha256(kept).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], names=["doc", "n_words", "n_removed", "kept_sha256"])

        out = marked.select("doc", "text", "spans").mapInArrow(summarise, "doc long, n_words long, n_removed long, kept_sha256 string")
        return name_again(out, docs, id_col, "doc")
    row_type = rows.schema["rest"].dataType.simpleString()

    def rewrite(batches):
        for batch in batches:
            n, gone, new = [], [], []
            for value, own in zip(batch.column("text"), batch.column("spans"), strict=True):
                given_text = value.as_py()
                a, b, kept = _keep(given_text, own.as_py())
                n.append(a)
                gone.append(b)
                new.append(kept.decode("utf-8", "surrogatepass") if b else given_text)
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(new, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=["rest", "text", "n_words", "n_removed"])

    out = marked.select("doc", "rest", "text", "spans").mapInArrow(rewrite, f"rest {row_type}, text string, n_words long, n_removed long")
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in given], *(("n_words", "n_removed") if counts else ()))


def oracle_sql(window: int = WINDOW) -> str:
    """The digest in DuckDB SQL over ``documents``, by listing all windows."""
    return f"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
win as (select doc_id, unnest(range(1, len(words) - {window} + 2)) as i, words from w where len(words) >= {window}),
g as (select doc_id, i, array_to_string(words[i:i + {window - 1}], ' ') as gram from win),
hit as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by gram) as least from g) where least < doc_id),
gone as (select distinct doc_id, unnest(range(i, i + {window})) as j from hit),
lost as (select doc_id, list(j) as js from gone group by doc_id),
kept as (select w.doc_id, len(words) as n_words, coalesce(len(js), 0) as n_removed, case when js is null then words else list_transform(list_filter(range(1, len(words) + 1), lambda k: not list_contains(js, k)), lambda k: words[k]) end as k from w left join lost using (doc_id))
select doc_id, n_words::bigint as n_words, n_removed::bigint as n_removed, sha256(array_to_string(k, ' ')) as kept_sha256 from kept
"""
