"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each counted once: its words, their stems (first four
characters), the pairs of adjacent words and the pairs of words with one
between, hashed into 2**20 places. FTRL-proximal keeps a learning rate per
coordinate and an L1 threshold, so few weights are left: the model is sent to
the executors as those pairs of place and weight, at most 2**20 of them.

Training takes at most ``ROWS`` labelled rows of at most ``LONGEST`` bytes,
those of least hashed id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from parallaxis.llm.common import hash_words, least_hashed, mix, slices, split_words

#: Hashed places, the most labelled rows to learn from, passes over them.
BITS, ROWS, PASSES = 20, 12_288, 4
#: A labelled text of more bytes is not learned from (all texts are scored whole).
LONGEST = 1 << 16
#: Training rows that must have a feature for it to count.
LEAST = 3
#: Bytes of text whose features are made at once: they take many times as much memory.
PART = 1 << 20
#: FTRL-proximal: learning rate, its smoothing, L1 and L2 strength.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 3.0, 0.1
#: Characters that do not belong to a word at its ends.
EDGES = ".,;:!?\"'()[]{}<>*_~`|/\\-+=#&%$@^…“”‘’«»¡¿"


def features(texts: pa.Array):
    """``(document, place)`` of every feature of every text, with repeats."""
    offsets, codes, vocabulary = split_words(texts)
    words = pc.utf8_trim(pc.utf8_lower(vocabulary), characters=EDGES)
    word = hash_words(words)
    stem = hash_words(pc.utf8_slice_codeunits(words, 0, 4))
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    own_word = word[codes]
    parts = [(owner, own_word), (owner, stem[codes] ^ np.uint64(0x51ED270B))]
    for gap, salt in ((1, 0xA24BAED4963EE407), (2, 0x9FB21C651E98DF25)):
        same = owner[gap:] == owner[:-gap] if len(owner) > gap else np.zeros(0, bool)
        pair = own_word[:-gap][same] * np.uint64(salt) + own_word[gap:][same] if len(same) else np.zeros(0, np.uint64)
        parts.append((owner[gap:][same] if len(same) else np.zeros(0, np.int64), pair))
    document = np.concatenate([d for d, _ in parts])
    place = mix(np.concatenate([h for _, h in parts])) >> np.uint64(64 - BITS)
    return document, place.astype(np.int64)


def places_of(texts: pa.Array):
    """Slice by slice ``(places, sizes)``: the distinct places of each text in turn, and how many each text has."""
    for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", PART):
        document, place = features(part.column(0))
        rows = np.unique(document << BITS | place)
        yield (rows & ((1 << BITS) - 1)).astype(np.int32), np.bincount(rows >> BITS, minlength=len(part))


def common_places(parts: list) -> list[np.ndarray]:
    """Of each text the places that ``LEAST`` texts or more have. Empties ``parts``: what is rare goes slice by slice."""
    seen = np.zeros(1 << BITS, np.int64)
    for places, _ in parts:
        seen += np.bincount(places, minlength=1 << BITS)
    common, kept = seen >= LEAST, []
    for k, (places, sizes) in enumerate(parts):
        parts[k] = None
        here = common[places]
        cuts = np.concatenate([[0], np.cumsum(here)])[np.cumsum(sizes)]
        kept += np.split(places[here], cuts[:-1])
    parts.clear()
    return kept


def descend(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Places and weights that are not zero, and the bias, from the places of each row in the order given."""
    z, n, weight = np.zeros((3, (1 << BITS) + 1))
    for _ in range(PASSES):
        for places, label in zip(rows, labels, strict=True):
            at = np.append(places, 1 << BITS)  # the last place is the bias
            own = weight[at]
            error = 1 / (1 + np.exp(-np.clip(own.sum(), -35, 35))) - label
            square = error * error
            root = np.sqrt(n[at])
            n[at] += square
            z[at] += error - (np.sqrt(n[at]) - root) / ALPHA * own
            limit = np.full(len(at), L1)
            limit[-1] = 0
            over = np.maximum(np.abs(z[at]) - limit, 0)
            weight[at] = -np.sign(z[at]) * over / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
    live = np.flatnonzero(weight[:-1])
    return live, weight[live], float(weight[-1])


def train(texts: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Places and weights that are not zero, and the bias. Rows count in the order given."""
    return descend(common_places(list(places_of(texts))), labels)


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    """Rows kept from learning: crc32 of the id as text; a null id is kept from it too."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(modulus)) == remainder, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"):
    """The model, learned from labelled rows that are not held out; None where there are none.

    Rows with a null id or label teach nothing; of repeated ids the greatest
    label and text count. The chosen ids (at most ``ROWS``) are broadcast,
    their texts meet in one task, which turns them batch by batch into places
    and returns the sparse weights.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col), 5, 0))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    chosen = least_hashed(known, "_id", ROWS, known.count())
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "_id")
    rows = rows.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= LONGEST)
    rows = rows.groupBy("_id").agg(F.max("text").alias("text"), F.max("label").alias("label")).withColumn("rank", F.xxhash64("_id"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, given = [], []
        for batch in batches:  # each batch's text goes when its places are known
            parts += places_of(batch.column("text"))
            given.append([np.array(batch.column(c)) for c in ("label", "rank")])
            del batch
        label, rank = (np.concatenate(x) for x in zip(*given, strict=True))
        places, order = common_places(parts), np.lexsort((label, rank))
        live, weight, bias = descend([places[k] for k in order], label[order])
        yield pa.RecordBatch.from_arrays([pa.array([live.astype("<i4").tobytes()]), pa.array([weight.astype("<f8").tobytes()]), pa.array([bias])], names=["places", "weights", "bias"])

    found = rows.select("text", "label", "rank", (F.col("label") * 0).alias("one")).groupBy("one").applyInArrow(learn, "places binary, weights binary, bias double").collect()
    if not found:
        return None
    return np.frombuffer(found[0]["places"], "<i4"), np.frombuffer(found[0]["weights"], "<f8"), found[0]["bias"]


def score(docs: DataFrame, model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of the label, from the whole text of each row.

    A null or empty text scores the bias alone. Without a model (nothing was
    labelled) every score is 0. A column of the name ``score_col`` is replaced.
    """
    docs = docs.drop(score_col) if score_col != text_col else docs
    if model is None:
        return docs.withColumn(score_col, F.lit(0.0))
    live, weight, bias = model
    given = docs.columns
    at = next((k for k, f in enumerate(docs.schema) if f.name == text_col and isinstance(f.dataType, StringType)), None)
    rows = docs.select(F.struct(*[F.col(c) for c in given]).alias("_row"), *[F.col(text_col).cast("string").alias("_text")] * (at is None))

    def run(batches):
        table = np.zeros(1 << BITS)
        table[live] = weight
        for whole in batches:
            texts = whole.column("_text") if at is None else pc.struct_field(whole.column("_row"), [at])  # a text travels once
            for batch in slices(pa.RecordBatch.from_arrays([whole.column("_row"), texts], names=["_row", "_text"]), "_text", PART):
                document, place = features(batch.column("_text"))
                hit = np.flatnonzero(table[place])
                pairs = np.unique(document[hit] << BITS | place[hit])
                margin = bias + np.bincount(pairs >> BITS, table[pairs & ((1 << BITS) - 1)], len(batch))
                found = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
                yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(found)], names=["_row", "_score"])

    kind = rows.schema["_row"].dataType.simpleString()
    out = rows.mapInArrow(run, f"_row {kind}, _score double")
    return out.select(*[F.col("_row")[c].alias(c) for c in given], F.col("_score").alias(score_col))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn and apply: all columns of ``docs`` with held_out, score and predicted (score >= 0.5).

    Given columns of these names are replaced. Ids may be of any type; null
    ids and repeated rows are scored like others; an empty table gives no rows.
    """
    docs = docs.drop("held_out", "score", "predicted")
    model = fit(docs, labels, id_col, text_col)
    scored = score(docs.withColumn("held_out", held_out(F.col(id_col), 5, 0)), model, text_col)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
