"""A hidden Markov language model, learned by distributed Baum-Welch.

Counts of all training words are taken over the whole corpus, sharded by word
hash. Words of high count (at most ``HEAD``; the count that bounds them is
read off the histogram of counts) are sent to the executors; the counts of
all rarer words stay sharded, and rare words of a text visit them there, so
no word loses its exact count. The most frequent words are emission classes
of their own, one for each ``PER_OWN`` distinct words; the others share
hashed classes, one for each ``PER_SHARED`` distinct words, and have their
add-one share of their class. Both numbers grow with the vocabulary, up to
what a table that every executor holds may have (``MOST_OWN``,
``MOST_SHARED``).

Training texts are written once as class numbers, and block by block laid
out for the recursions. States start from expectation-maximisation on at most
``SEED_ROWS`` texts, go on over every sixteenth and every fourth text (by
hashed id), and then over all training texts. A round runs scaled
forward-backward over its texts, and the partitions' expected counts are summed
by Spark. Over all texts it goes block by block, a quarter of the texts each:
the counts of a block take the place of its earlier ones, and the model is
made anew from the counts of all blocks (incremental expectation-maximisation,
Neal and Hinton 1998, whose fixed points are those of rounds over all texts
at once). Rounds go on until one over all its texts raises the log-likelihood
by no more than ``TOLERANCE`` of itself. Scoring is the scaled forward
recursion over the whole text in double precision: the exact probability, not
a bound or a best path.

A text of n words is trained on in one piece, at about 120 n bytes; scoring
keeps no states, so it takes about 20 n.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallaxis.llm.common import hash_words, name_again, number, slices, split_words
from parallaxis.llm.toxicity import held_out
from parallaxis.runtime import cut_lineage

STATES, HEAD = 12, 1 << 18
#: Classes of single words: at least, at most, and distinct words for each.
OWN, MOST_OWN, PER_OWN = 8192, 57_344, 128
#: Shared classes, powers of two: at least, at most, and distinct words for each.
SHARED, MOST_SHARED, PER_SHARED = 256, 4096, 4096
SEED_ROWS, SEED_ROUNDS, TOLERANCE = 512, 12, 1e-4
#: Blocks of training texts by hashed id, in sixteenths: the first is one text in 16, with the second it is one in 4.
BLOCKS = (1, 3, 4, 4, 4)
#: Tokens of a batch that run in lock step, and classes of a row of expected counts.
TOKENS, ROW = 1 << 20, 4096
#: Bytes of text encoded at once, and tokens that are laid out together.
ENCODED, LAID_OUT = 32 << 20, 1 << 23
#: Texts of a step that is worth its own products, and tokens of a product over many steps.
FEW, STRETCH = 256, 1 << 14


def tokens(texts: pa.Array):
    """``(offsets, codes, hashes)``: words with A-Z lowered; codes into the distinct words' hashes."""
    offsets, codes, vocabulary = split_words(texts, lower=True)
    return offsets, codes, hash_words(vocabulary)


class Lexicon:
    """What an executor knows of words: counts of the frequent ones, and every word's class.

    Class 0 is the end of a text, then come the most frequent words and the
    shared classes. ``shared_total`` and ``shared_distinct`` are given by
    residue modulo ``MOST_SHARED`` over all words.
    """

    def __init__(self, head: np.ndarray, counts: np.ndarray, texts: int, total: int, distinct: int, shared_total: np.ndarray, shared_distinct: np.ndarray):
        most = min(MOST_OWN, max(OWN, distinct // PER_OWN))
        top = np.lexsort((head, -counts))[:most]
        own = np.zeros(len(head), np.int32)
        own[top] = np.arange(1, len(top) + 1)
        order = np.argsort(head)
        self.head, self.counts, self.own = head[order], counts[order], own[order]
        self.texts, self.total, self.distinct = texts, total, distinct
        self.owned = len(top)
        self.pooled = SHARED
        while self.pooled < min(MOST_SHARED, distinct / PER_SHARED):
            self.pooled *= 2
        # words that are classes of their own leave the shared classes
        of_own = self.shared(self.head[self.own > 0]) - 1 - self.owned
        fold = lambda x: np.asarray(x, np.int64).reshape(-1, self.pooled).sum(0)
        self.shared_total = fold(shared_total) - np.bincount(of_own, self.counts[self.own > 0], self.pooled).astype(np.int64)
        self.shared_distinct = fold(shared_distinct) - np.bincount(of_own, minlength=self.pooled)
        self.classes = 1 + self.owned + self.pooled

    def prior(self) -> np.ndarray:
        """Share of all training tokens of each class, never 0."""
        found = np.concatenate([[self.texts], np.zeros(self.owned), self.shared_total]) + 0.01
        found[self.own[self.own > 0]] += self.counts[self.own > 0]
        return found / found.sum()

    def look_up(self, hashes: np.ndarray):
        """``(count, class)`` of words; the count is -1 where only the shards know it."""
        if not len(self.head):
            return np.full(len(hashes), -1), self.shared(hashes)
        at = np.minimum(np.searchsorted(self.head, hashes), len(self.head) - 1)
        known = self.head[at] == hashes
        count = np.where(known, self.counts[at], -1)
        return count, np.where(known & (self.own[at] > 0), self.own[at], self.shared(hashes))

    def shared(self, hashes: np.ndarray) -> np.ndarray:
        return 1 + self.owned + (hashes % np.uint64(self.pooled)).astype(np.int32)

    def within(self, count: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its class."""
        k = kind - 1 - self.owned
        pooled = k >= 0
        size = np.where(pooled, (self.shared_total + self.shared_distinct)[np.maximum(k, 0)] + 1, 1)
        return np.where(pooled, np.log10((count + 1) / size), 0.0)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.total + self.distinct + 1))


def lock_step(offsets: np.ndarray, kinds: np.ndarray):
    """Groups of texts of at most ``TOKENS`` tokens, longest first, laid out by time.

    Yields ``(texts, active, observed)``: text numbers, how many are running
    at each step, and the classes, step after step, the end class last.
    """
    length = np.diff(offsets) + 1
    order = np.argsort(-length, kind="stable")
    start = 0
    while start < len(order):
        ends = np.cumsum(length[order[start:]])
        stop = start + max(1, int(np.searchsorted(ends, TOKENS, side="right")))
        texts = order[start:stop]
        own = length[texts]
        active = np.cumsum(np.bincount(own, minlength=own[0] + 1)[::-1])[::-1][1:]
        step = np.repeat(np.arange(own[0]), active)
        row = np.arange(len(step)) - np.repeat(np.cumsum(active) - active, active)
        last = step == own[row] - 1
        at = np.minimum(offsets[texts][row] + step, max(len(kinds) - 1, 0))
        observed = np.where(last, 0, kinds[at] if len(kinds) else 0)
        yield texts, active, observed
        start = stop


def forward(model, active, observed):
    """log of the probability of each text; no more than one step's states are kept."""
    first, move, emit = model
    turn = np.ascontiguousarray(move.T)
    rows = np.ascontiguousarray(emit.T)
    total = np.zeros(active[0])
    edge = np.concatenate([[0], np.cumsum(active)])
    state, seen, begin, end = None, None, 0, 0
    for a, n in zip(edge[:-1].tolist(), active.tolist(), strict=True):
        if a >= end:  # emissions of the next steps, about 2**16 tokens of them
            begin, end = a, int(edge[np.searchsorted(edge, a + max(n, 1 << 16), side="right") - 1])
            seen = np.take(rows, observed[begin:end].astype(np.intp), 1)
        state = np.repeat(first[:, None], n, 1) if state is None else turn @ state[:, :n]
        state *= seen[:, a - begin : a - begin + n]
        scale = state.sum(0)
        state /= scale
        total[:n] += np.log(scale)
    return total


def expected_counts(model, active, observed, classes: int):
    """Expected starts, moves and emissions of a lock-step group, and its log-likelihood.

    States are rows and texts columns, so every operation runs along the
    texts; the precision is that of the model's arrays.
    """
    first, move, emit = model
    states, n_tokens = len(move), len(observed)
    observed = observed.astype(np.intp)
    seen = np.take(np.ascontiguousarray(emit.T), observed, 1)
    turn = np.ascontiguousarray(move.T)
    edge = np.concatenate([[0], np.cumsum(active)]).tolist()
    state, scales = np.empty_like(seen), np.empty(n_tokens, seen.dtype)
    before = 0
    for t, n in enumerate(active.tolist()):
        begin, end = edge[t], edge[t + 1]
        now = state[:, begin:end]
        if t:
            np.matmul(turn, state[:, before : before + n], out=now)
        else:
            now[:] = first[:, None]
        now *= seen[:, begin:end]
        now /= np.add.reduce(now, 0, out=scales[begin:end])
        before = begin
    # going back, ``seen`` becomes a token and all that follows it, given the state at the token;
    # steps of few texts, at the end, are many: there only this recursion goes step by step
    moves = np.zeros((states, states))
    wide = int(np.searchsorted(-active, -FEW, side="right"))  # steps of at least FEW texts
    tail = edge[wide]
    seen[:, tail:] /= scales[tail:]
    for t in range(len(active) - 2, wide - 1, -1):
        begin, end = edge[t + 1], edge[t + 2]
        seen[:, edge[t] : edge[t] + end - begin] *= move @ seen[:, begin:end]
    previous = np.arange(edge[min(wide + 1, len(active))], n_tokens) - np.repeat(active[wide:-1], active[wide + 1 :])
    for k in range(0, len(previous), STRETCH):
        at = previous[k : k + STRETCH]
        after = seen[:, n_tokens - len(previous) + k :][:, : len(at)]
        now = state[:, at]
        moves += now @ after.T
        state[:, at] = now * (move @ after)  # the states' probability given the whole text
    for t in range(wide - 1, -1, -1):
        now, ahead = state[:, edge[t] : edge[t + 1]], seen[:, edge[t] : edge[t + 1]]
        if t + 1 < len(active):
            after = seen[:, edge[t + 1] : edge[t + 2]]
            n = after.shape[1]
            moves += now[:, :n] @ after.T
            back = move @ after
            now[:, :n] *= back
            ahead[:, :n] *= back
        ahead /= scales[edge[t] : edge[t + 1]]
    emitted = np.stack([np.bincount(observed, state[s], classes) for s in range(states)], 1)
    return state[:, : active[0]].sum(1, dtype=np.float64), moves * move, emitted, float(np.log(scales, dtype=np.float64).sum())


def maximise(starts, moves, emitted, prior) -> tuple:
    """The model of expected counts, each state smoothed towards the classes' overall shares."""
    first = (starts + 0.1) / (starts + 0.1).sum()
    move = (moves + 0.1) / (moves + 0.1).sum(1, keepdims=True)
    emit = emitted + 10.0 * prior[:, None]
    return first, move, emit / emit.sum(0)


def seed_model(groups: list, classes: int, prior: np.ndarray, states: int = STATES) -> tuple:
    """Starting model: sticky states from random responsibilities, then EM on a few texts."""
    rng = np.random.default_rng(3)
    emit = prior[:, None] * rng.gamma(1.0, 1.0, (classes, states))
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9)
    model = np.full(states, 1 / states), move, emit / emit.sum(0)
    for _ in range(SEED_ROUNDS):
        sums = [np.zeros(states), np.zeros((states, states)), np.zeros((classes, states))]
        for _, active, observed in groups:
            for total, part in zip(sums, expected_counts(model, active, observed, classes)[:3], strict=True):
                total += part
        model = maximise(*sums, prior)
    return model


def _count_words(shards: int):
    """Rows (shard, hashes, counts, texts) of a partition's words, merged before they leave."""

    def merge(parts):
        hashes = np.concatenate([h for h, _ in parts])
        found, back = np.unique(hashes, return_inverse=True)
        return found, np.bincount(back, np.concatenate([c for _, c in parts]), len(found)).astype(np.int64)

    def run(batches):
        parts, texts, size = [], 0, 0
        for whole in batches:
            for batch in slices(whole, "text", 8 << 20):
                texts += len(batch)
                _, codes, hashes = tokens(batch.column("text"))
                parts.append((hashes, np.bincount(codes, minlength=len(hashes))))
                size += len(hashes)
                if size > 1 << 21:
                    parts = [merge(parts)]
                    size = len(parts[0][0])
                    if size > 1 << 20:
                        yield send(*parts[0], 0)
                        parts, size = [], 0
        found = merge(parts) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        yield send(*found, texts)

    def send(hashes, counts, texts):
        shard = (hashes % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        blobs = [(hashes[order[a:b]].tobytes(), counts[order[a:b]].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(shards, dtype=np.int32)), pa.array([h for h, _ in blobs], pa.binary()), pa.array([c for _, c in blobs], pa.binary()), pa.array([texts] + [0] * (shards - 1), pa.int64())], names=["shard", "hashes", "counts", "texts"])

    return run


def _merge_counts(table: pa.Table) -> pa.Table:
    hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()])
    counts = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()])
    found, back = np.unique(hashes, return_inverse=True)
    total = np.bincount(back, counts, len(found)).astype(np.int64)
    own = (found % np.uint64(MOST_SHARED)).astype(np.int64)
    sizes, times = np.unique(total, return_counts=True)
    return pa.table([table.column("shard")[:1], pa.array([found.tobytes()]), pa.array([total.tobytes()]), pa.array([int(np.sum(table.column("texts").to_numpy()))]), pa.array([int(total.sum())]), pa.array([len(found)]), pa.array([sizes.tobytes()]), pa.array([times.tobytes()]), pa.array([np.bincount(own, total, MOST_SHARED).astype(np.int64).tobytes()]), pa.array([np.bincount(own, minlength=MOST_SHARED).tobytes()])], names=["shard", "hashes", "counts", "texts", "total", "words", "sizes", "times", "shared_total", "shared_words"])


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """One row per shard of words: sorted hashes with counts, and sums over them."""
    shards = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sent = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_count_words(shards), "shard int, hashes binary, counts binary, texts long")
    return cut_lineage(sent.groupBy("shard").applyInArrow(_merge_counts, "shard int, hashes binary, counts binary, texts long, total long, words long, sizes binary, times binary, shared_total binary, shared_words binary"))


def lexicon(counted: DataFrame) -> Lexicon:
    """Frequent words and sums from the counts; what comes to the driver is bounded by ``HEAD``."""
    rows = counted.select("texts", "total", "words", "sizes", "times", "shared_total", "shared_words").collect()
    texts = sum(r["texts"] for r in rows)
    histogram: dict[int, int] = {}
    for r in rows:
        for size, n in zip(np.frombuffer(r["sizes"], np.int64).tolist(), np.frombuffer(r["times"], np.int64).tolist(), strict=True):
            histogram[size] = histogram.get(size, 0) + n
    least, held = 1, 0
    for size in sorted(histogram, reverse=True):
        if held + histogram[size] > HEAD:
            least = size + 1
            break
        held += histogram[size]

    def frequent(batches):
        for batch in batches:
            for h, c in zip(batch.column("hashes").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                counts = np.frombuffer(c, np.int64)
                keep = counts >= least
                yield pa.RecordBatch.from_arrays([pa.array([np.frombuffer(h, np.uint64)[keep].tobytes()]), pa.array([counts[keep].tobytes()])], names=["hashes", "counts"])

    head = counted.select("hashes", "counts").mapInArrow(frequent, "hashes binary, counts binary").collect()
    join = lambda k, kind: np.concatenate([np.frombuffer(r[k], kind) for r in head]) if head else np.zeros(0, kind)
    add = lambda k: sum((np.frombuffer(r[k], np.int64) for r in rows), np.zeros(MOST_SHARED, np.int64))
    return Lexicon(join("hashes", np.uint64), join("counts", np.int64), texts, sum(r["total"] for r in rows) + texts, sum(r["words"] for r in rows) + (texts > 0), add("shared_total"), add("shared_words"))


def _groups(texts: pa.Array, words: Lexicon):
    offsets, codes, hashes = tokens(texts)
    _, kinds = words.look_up(hashes)
    return lock_step(offsets, kinds[codes] if len(codes) else np.zeros(0, np.int32))


def encode(docs: DataFrame, words: Lexicon, id_col: str, text_col: str) -> DataFrame:
    """Training texts as class numbers, by block: (block, lengths, kinds), a batch's texts of a block in one row."""
    turn = F.pmod(F.xxhash64(F.lit(9), F.col(id_col)), F.lit(sum(BLOCKS)))
    block = sum((turn >= int(n)).cast("int") for n in np.cumsum(BLOCKS)[:-1])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", ENCODED):
                offsets, codes, hashes = tokens(batch.column("text"))
                kinds = words.look_up(hashes)[1].astype("<u2")[codes] if len(codes) else np.zeros(0, "<u2")
                lengths, own = np.diff(offsets), batch.column("block").to_numpy()
                block_of = np.repeat(own, lengths)
                blocks = np.unique(own)
                columns = [pa.array(blocks, pa.int32()), pa.array([lengths[own == b].astype("<i4").tobytes() for b in blocks], pa.binary()), pa.array([kinds[block_of == b].tobytes() for b in blocks], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "lengths", "kinds"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"), block.alias("block"))
    return cut_lineage(rows.mapInArrow(run, "block int, lengths binary, kinds binary"))


def lay_out(batches):
    """Rows (active, observed) of the texts of a partition, ``LAID_OUT`` tokens or a batch's texts at a time.

    The more texts are laid out together, the more of them run beside each other in every step.
    """

    def groups(lengths, kinds):
        for _, active, observed in lock_step(np.concatenate([[0], np.cumsum(np.concatenate(lengths), dtype=np.int64)]), np.concatenate(kinds)):
            yield pa.RecordBatch.from_arrays([pa.array([active.astype("<i4").tobytes()], pa.binary()), pa.array([observed.astype("<u2").tobytes()], pa.binary())], names=["active", "observed"])

    lengths, kinds, size = [], [], 0
    for batch in batches:
        for n, k in zip(batch.column("lengths"), batch.column("kinds"), strict=True):
            lengths.append(np.frombuffer(n.as_py(), "<i4"))
            kinds.append(np.frombuffer(k.as_py(), "<u2"))
            size += len(lengths[-1]) + len(kinds[-1])
            if size >= LAID_OUT:
                yield from groups(lengths, kinds)
                lengths, kinds, size = [], [], 0
    if lengths:
        yield from groups(lengths, kinds)


def _count(encoded: DataFrame, words: Lexicon, model) -> tuple:
    """Expected starts, moves and emissions of all groups, and their log-likelihood.

    A partition sends its sums in rows of ``ROW`` classes, in single precision.
    """
    # a row of other sums comes first: starts, moves, likelihood
    light = tuple(np.asarray(x, np.float32) for x in model)
    classes = words.classes

    def expect(batches):
        emitted, other = np.zeros((classes, STATES)), np.zeros((STATES + 2, STATES))
        for batch in batches:
            for active, observed in zip(batch.column("active"), batch.column("observed"), strict=True):
                starts, moves, seen, likelihood = expected_counts(light, np.frombuffer(active.as_py(), "<i4"), np.frombuffer(observed.as_py(), "<u2"), classes)
                emitted += seen
                other[0] += starts
                other[1:-1] += moves
                other[-1, 0] += likelihood
        if other.any():
            rows = [other.tobytes()] + [emitted[k : k + ROW].astype("<f4").tobytes() for k in range(0, classes, ROW)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(rows, pa.binary())], names=["row", "sums"])

    def add(table: pa.Table) -> pa.Table:
        row = table.column("row")[0].as_py()
        parts = sorted(table.column("sums").to_pylist())  # one order, one rounding
        total = sum(np.frombuffer(x, "<f4" if row else "<f8").astype(np.float64) for x in parts)
        return pa.table([pa.array([row], pa.int32()), pa.array([total.tobytes()])], names=["row", "sums"])

    sent = encoded.select("active", "observed").mapInArrow(expect, "row int, sums binary")
    found = {r["row"]: np.frombuffer(r["sums"]) for r in sent.groupBy("row").applyInArrow(add, "row int, sums binary").collect()}
    if not found:
        return np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((classes, STATES)), 0.0
    other = found.pop(0).reshape(-1, STATES)
    return other[0], other[1:-1], np.concatenate([found[k] for k in sorted(found)]).reshape(-1, STATES), float(other[-1, 0])


def train(docs: DataFrame, words: Lexicon, id_col: str, text_col: str) -> tuple:
    """Baum-Welch over all rows of ``docs``: (first, moves, emissions)."""
    prior = words.prior()
    chosen = docs.select(F.col(id_col).alias("_id")).where("_id is not null").distinct().orderBy(F.xxhash64("_id"), "_id").limit(SEED_ROWS)
    seeds = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.max("text").alias("text"))

    def seed(table: pa.Table) -> pa.Table:
        texts = pa.array(table.sort_by("rank").column("text").to_pylist(), pa.string())
        found = seed_model(list(_groups(texts, words)), words.classes, prior)
        return pa.table([pa.array([x.tobytes()]) for x in found], names=["first", "move", "emit"])

    seeded = seeds.select("text", F.xxhash64("_id").alias("rank"), (F.xxhash64("_id") * 0).alias("one")).groupBy("one").applyInArrow(seed, "first binary, move binary, emit binary").collect()
    if seeded:
        model = np.frombuffer(seeded[0]["first"]), np.frombuffer(seeded[0]["move"]).reshape(STATES, STATES), np.frombuffer(seeded[0]["emit"]).reshape(-1, STATES)
    else:
        model = seed_model([], words.classes, prior)
    encoded = encode(docs, words, id_col, text_col)
    tasks = docs.sparkSession.sparkContext.defaultParallelism  # each sends its sums once a round, so no more than can run at once
    part = lambda blocks: cut_lineage(encoded.where(blocks).coalesce(tasks).mapInArrow(lay_out, "active binary, observed binary"))
    few, quarter = part(F.col("block") == 0), part(F.col("block") <= 1)
    model, _ = settle(model, [few], words, prior)
    model, sums = settle(model, [quarter], words, prior)
    model, _ = settle(model, [quarter, *(part(F.col("block") == k) for k in range(2, len(BLOCKS)))], words, prior, sums)
    return model


def settle(model: tuple, blocks: list, words: Lexicon, prior, sums: list | None = None) -> tuple:
    """``(model, sums)`` after rounds over ``blocks`` until one raises the log-likelihood too little.

    ``sums`` holds the expected counts and likelihood of each block that was
    counted; the model is that of their total. Blocks that ``sums`` has
    already begin as counted there, and the first round starts after them.
    """
    sums, last = list(sums or []), -np.inf
    start = len(sums) % len(blocks)
    while True:
        for k in [*range(start, len(blocks)), *range(start)]:
            found = _count(blocks[k], words, model)
            sums[k : k + 1] = [found]
            model = maximise(*(sum(x) for x in list(zip(*sums, strict=True))[:3]), prior)
        likelihood = sum(x[3] for x in sums)
        if likelihood - last <= TOLERANCE * abs(likelihood):
            return model, sums
        last = likelihood


def _score(words: Lexicon, model, shards: int):
    """Rows (shard, uid, kind, blob): a batch's texts with what is known here, and its rare words by shard."""

    def run(batches):
        uid = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in slices(whole, "text", 12 << 20):
                offsets, codes, hashes = tokens(batch.column("text"))
                count, kind = words.look_up(hashes)
                kinds = kind[codes] if len(codes) else np.zeros(0, np.int32)
                log10 = np.zeros(len(batch))
                for texts, active, observed in lock_step(offsets, kinds):
                    log10[texts] = forward(model, active, observed) / np.log(10)
                owner = np.repeat(np.arange(len(batch)), np.diff(offsets))
                here = count >= 0
                base, share = np.where(here, words.base(np.maximum(count, 0)), 0), np.where(here, words.within(np.maximum(count, 0), kind), 0)
                add = lambda x: np.bincount(owner, x[codes], len(batch)) if len(codes) else np.zeros(len(batch))
                known = add(here.astype(float)) + (words.texts > 0)
                sums = np.column_stack([np.diff(offsets) + 1, known, add(base) + words.base(np.array(words.texts)), add(share) + log10])
                doc_list = batch.column("doc").to_pylist()
                rows = [(int(uid % shards), uid, sums.tobytes(), doc_list, batch.column("held").to_pylist(), None)]
                rare = np.flatnonzero(~here[codes]) if len(codes) else []
                if len(rare):
                    word, doc = hashes[codes[rare]], owner[rare].astype(np.int32)
                    shard = (word % np.uint64(shards)).astype(np.int64)
                    order = np.argsort(shard, kind="stable")
                    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
                    for s in np.flatnonzero(np.diff(cuts)):
                        own = order[cuts[s] : cuts[s + 1]]
                        rows.append((int(s), uid, word[own].tobytes(), None, None, doc[own].tobytes()))
                kinds_ = (pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds_, strict=True)], names=["shard", "uid", "blob", "docs", "held", "who"])
                uid += 1

    return run


def _look_up_rare(words: Lexicon):
    """Rare words meet their shard's counts; (uid, sums by text of the batch)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if len(right):
            hashes, counts = np.frombuffer(right.column("hashes")[0].as_py(), np.uint64), np.frombuffer(right.column("counts")[0].as_py(), np.int64)
        else:
            hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        blobs = []
        for blob, who in zip(left.column("blob").to_pylist(), left.column("who").to_pylist(), strict=True):
            if who is None:
                blobs.append(blob)
                continue
            own, doc = np.frombuffer(blob, np.uint64), np.frombuffer(who, np.int32)
            count = np.zeros(len(own), np.int64)
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                count = np.where(hashes[at] == own, counts[at], 0)
            n = int(doc.max()) + 1
            sums = [np.zeros(n), np.bincount(doc, count > 0, n), np.bincount(doc, words.base(count), n), np.bincount(doc, words.within(count, words.shared(own)), n)]
            blobs.append(np.column_stack(sums).tobytes())
        return pa.table([left.column("uid"), pa.array(blobs, pa.binary()), left.column("docs"), left.column("held")], names=["uid", "blob", "docs", "held"])

    return run


def _sum_up(words: Lexicon):
    def run(table: pa.Table) -> pa.Table:
        docs = held = total = None
        parts = []
        for blob, ids, held_ids in zip(table.column("blob").to_pylist(), table.column("docs").to_pylist(), table.column("held").to_pylist(), strict=True):
            sums = np.frombuffer(blob, np.float64).reshape(-1, 4)
            if ids is not None:
                docs, held, total = ids, held_ids, sums.copy()
            else:
                parts.append(sums)
        for sums in sorted(parts, key=lambda x: x.tobytes()):
            total[: len(sums)] += sums
        n = len(docs)
        return pa.table([pa.array(docs, pa.int64()), pa.array(held, pa.bool_()), pa.array(total[:, 0].astype(np.int64)), pa.array(np.rint(total[:, 1]).astype(np.int64)), pa.array([words.total] * n, pa.int64()), pa.array(total[:, 2]), pa.array(total[:, 3])], names=["doc", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def language_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities of the whole text and its end. Rows whose
    crc32 of the id leaves 2 modulo 7, or whose id is null, teach nothing. A
    null or empty text is one token, the end. Repeated rows count as often as
    they occur. With no training rows the base is add-one over nothing and
    the model knows only classes. Ids may be of any type (see ``number``);
    other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(number(docs, id_col).alias("doc"), held_out(F.col(id_col), 7, 2).alias("held"), F.col(text_col).cast("string").alias("text"))
    learning = rows.where("not held")
    counted = count_words(learning)
    words = lexicon(counted)
    model = train(learning, words, "doc", "text")
    shards = (counted.agg(F.max("shard")).first()[0] or 0) + 1
    sent = rows.mapInArrow(_score(words, model, shards), "shard int, uid long, blob binary, docs array<long>, held array<boolean>, who binary")
    found = sent.groupBy("shard").cogroup(counted.select("shard", "hashes", "counts").groupBy("shard")).applyInArrow(_look_up_rare(words), "uid long, blob binary, docs array<long>, held array<boolean>")
    out = found.where("uid is not null").groupBy("uid").applyInArrow(_sum_up(words), "doc long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return name_again(out, docs, id_col, "doc")
