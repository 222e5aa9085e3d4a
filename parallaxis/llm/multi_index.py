"""Embedding near-duplicates by an inverted multi-index.

Two codebooks, one for each half of the unit vectors, form a product grid of
cells within each label. Every vector lives in the cell of its two nearest
codewords and visits the cells that come first in the multi-sequence order,
the order of summed distances of its halves to the codewords. How many it
visits is calibrated so that a neighbour exactly at the threshold is found
with the target recall from one side alone; a link is found if either vector
visits the other's cell. Cosines in double precision decide.

Equal vectors are one class. A cell's visitors and residents meet in blocks,
so neither a full cell nor a group of near copies meets in one task, and
tasks return counts and spanning forests, never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallaxis.llm.common import least_hashed, name_again, number
from parallaxis.operators.components import connected_components
from parallaxis.runtime import cut_lineage

THRESHOLD, RECALL = 0.98, 0.9995
#: Vectors that the codebooks are fitted on (those of least hashed id), rounds of fitting.
SAMPLE, ROUNDS = 8192, 12
#: Codewords per half at least and at most; one more for each doubling in size of a sixteenth.
LEAST_WORDS, MOST_WORDS = 8, 2048
#: Residents or visitors of a cell that meet in one block.
BLOCK = 2048


def fit_codebook(points: np.ndarray, words: int, seed: int = 7) -> np.ndarray:
    """Lloyd's algorithm from distinct random points; empty codewords stay where they were."""
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    book = points[rng.permutation(len(points))[:words]]
    for _ in range(ROUNDS):
        near = (points @ book.T - (book**2).sum(1) / 2).argmax(1)
        count = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, points)
        book = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], book)
    return book


def distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((points**2).sum(1)[:, None] - 2 * points @ book.T + (book**2).sum(1), 0)


def multi_sequence(first: np.ndarray, second: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` cells nearest to each vector, in order, from the distances of its halves.

    Cell (i, j) in the order of codewords by distance precedes only cells with
    both places behind, so the first ``most`` lie where (i+1)(j+1) <= most;
    only those are summed and sorted.
    """
    a, b = np.argsort(first, 1, kind="stable"), np.argsort(second, 1, kind="stable")
    i, j = np.meshgrid(np.arange(a.shape[1]), np.arange(b.shape[1]), indexing="ij")
    corner = (i + 1) * (j + 1) <= most
    i, j = i[corner], j[corner]
    rows = np.arange(len(a))[:, None]
    total = first[rows, a[:, i]] + second[rows, b[:, j]]
    order = np.argsort(total, 1, kind="stable")[:, :most]
    return (a[:, i] * second.shape[1] + b[:, j])[rows, order]


def calibrate(sample: np.ndarray, books, threshold: float, recall: float) -> int:
    """Cells to visit so that a random neighbour at the threshold is met with ``recall`` from one side."""
    rng = np.random.default_rng(11)
    half = sample.shape[1] // 2
    base = sample[rng.integers(0, len(sample), 4096)]
    noise = rng.standard_normal(base.shape)
    noise -= (noise * base).sum(1, keepdims=True) * base
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-300)
    near = threshold * base + (1 - threshold**2) ** 0.5 * noise
    first, second = distances(base[:, :half], books[0]), distances(base[:, half:], books[1])
    home = distances(near[:, :half], books[0]).argmin(1), distances(near[:, half:], books[1]).argmin(1)
    rows = np.arange(len(base))
    limit = first[rows, home[0]] + second[rows, home[1]]
    ahead = np.zeros(len(base), np.int64)
    chunk = max(1, (1 << 24) // (len(books[0]) * len(books[1])))
    for k in range(0, len(base), chunk):
        part = slice(k, k + chunk)
        ahead[part] = (first[part, :, None] + second[part, None, :] < limit[part, None, None]).sum((1, 2))
    return int(np.quantile(ahead, recall, method="higher")) + 1


def _unit(column) -> np.ndarray:
    width = len(column[0].as_py()) // 8 if len(column) else 0
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), width)


def _pack(batches):
    """(vec_id, label, direction): unit vectors in double precision, null where there is none."""
    for batch in batches:
        packed = []
        for x in batch.column("embedding").to_pylist():
            v = None if x is None or any(y is None for y in x) else np.array(x, np.float64)
            norm = 0.0 if v is None or not len(v) or not np.isfinite(v).all() else float(np.linalg.norm(v / max(np.abs(v).max(), 1e-300)))
            packed.append((v / np.abs(v).max() / norm).tobytes() if norm else None)
        yield pa.RecordBatch.from_arrays([batch.column("vec"), batch.column("label"), pa.array(packed, pa.binary())], names=["vec", "label", "direction"])


def _route(books, visits):
    """Rows (label, cell, resident, vec, copies, direction, visited): a vector at home and where it visits."""

    def run(batches):
        for whole in batches:
            for start in range(0, len(whole), 1024):
                batch = whole.slice(start, 1024)
                unit = _unit(batch.column("direction"))
                half = unit.shape[1] // 2
                first, second = distances(unit[:, :half], books[0]), distances(unit[:, half:], books[1])
                cells = multi_sequence(first, second, visits).astype(np.int64)
                n, t = cells.shape
                at = np.repeat(np.arange(n), t)
                lists = [c.astype("<i4").tobytes() for c in cells]
                columns = [batch.column("label").take(pa.array(at)), pa.array(cells.ravel()), pa.array(np.tile(np.arange(t) == 0, n)), batch.column("vec").take(pa.array(at)), batch.column("copies").take(pa.array(at)), batch.column("direction").take(pa.array(at)), pa.array(lists, pa.binary()).take(pa.array(at))]
                yield pa.RecordBatch.from_arrays(columns, names=["label", "cell", "resident", "vec", "copies", "direction", "visited"])

    return run


def _verify(threshold: float):
    """One block of a cell: link counts of visitors (and of residents that don't visit back), and a forest."""

    def run(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        part, other = table.column("part")[0].as_py(), table.column("other")[0].as_py()
        table = table.combine_chunks()
        vec = table.column("vec").to_numpy()
        vec, first = np.unique(vec, return_index=True)
        copies = table.column("copies").to_numpy()[first]
        unit = _unit(table.column("direction").take(pa.array(first)).combine_chunks())
        lists = [np.frombuffer(x, "<i4") for x in table.column("visited").take(pa.array(first)).to_pylist()]
        home = np.array([x[0] for x in lists])
        slot = table.column("slot").to_numpy()[first]
        resident = np.flatnonzero((home == cell) & (slot == part))
        visitor = np.flatnonzero(slot == other)
        inner = home[visitor] == cell
        links = np.zeros(len(vec), np.int64)
        edges = [], []
        homes = np.unique(home)
        # does a resident visit the home of a visitor: then the pair is counted for it there
        visited = np.array([np.isin(homes, lists[r]) for r in resident]).reshape(len(resident), len(homes))
        back = np.searchsorted(homes, home[visitor])
        for s in range(0, len(visitor), 512):
            own = visitor[s : s + 512]
            near = unit[own] @ unit[resident].T >= threshold
            near &= vec[own][:, None] != vec[resident][None, :]
            links[own] += near @ copies[resident]
            once = near & ~visited[:, back[s : s + 512]].T & ~inner[s : s + 512][:, None]
            np.add.at(links, resident, copies[own] @ once)
            if near.any():
                left, right = _forest(near, own, resident, vec)
                edges[0].append(left)
                edges[1].append(right)
        live = np.flatnonzero(links)
        left = np.concatenate([vec[live], *edges[0]])
        right = np.concatenate([vec[live], *edges[1]])
        count = np.concatenate([links[live], np.zeros(len(left) - len(live), np.int64)])
        return pa.table([pa.array(left), pa.array(right), pa.array(count)], names=["vec", "root", "links"])

    return run


def _forest(near, own, resident, vec):
    """Edges that join what this block links: one from each row and column to its part's first row."""
    rows, cols = near.shape
    row_of, col_of = np.full(rows, -1), np.full(cols, -1)
    for k in np.flatnonzero(near.any(1)):
        if row_of[k] >= 0:
            continue
        front = np.array([k])
        row_of[k] = k
        while len(front):
            met = np.flatnonzero(near[front].any(0) & (col_of < 0))
            col_of[met] = k
            front = np.flatnonzero(near[:, met].any(1) & (row_of < 0)) if len(met) else met
            row_of[front] = k
    r, c = np.flatnonzero(row_of >= 0), np.flatnonzero(col_of >= 0)
    return np.concatenate([vec[own[r]], vec[resident[c]]]), np.concatenate([vec[own[row_of[r]]], vec[own[col_of[c]]]])


def near_duplicates(vectors: DataFrame, id_col="vec_id", vector_col="embedding", label_col="label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null and their cosine is
    at least ``threshold``. A vector that is null, zero, empty or holds null
    or non-finite components, or whose label or id is null, links with
    nothing. Vectors of different lengths don't link. ``n_links`` counts the other vectors linked directly,
    equal ones included; ``component_id`` is the smallest id reachable;
    ``kept`` marks the vector that has that id. Repeated rows count as copies;
    rows of one id with different vectors are vectors of their own. Ids that
    are no whole numbers are ordered by their hash, which ``component_id``
    then holds (see ``number``). Other columns are ignored; an empty table
    gives no rows.
    """
    rows = vectors.select(number(vectors, id_col).alias("vec"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    packed = cut_lineage(rows.mapInArrow(_pack, "vec long, label string, direction binary"))
    whole = packed.where("vec is not null and label is not null and direction is not null").withColumn("label", F.concat_ws("|", "label", F.length("direction")))
    classes = whole.groupBy("label", "direction").agg(F.min("vec").alias("vec"), F.count("*").alias("copies"))
    classes = cut_lineage(classes.withColumn("node", F.xxhash64("label", "direction")))
    links, component = None, None
    for (width,) in classes.select(F.length("direction")).distinct().collect():
        found = _of_width(classes.where(F.length("direction") == width).select("label", "direction", "copies", F.col("node").alias("vec")), threshold)
        links = found if links is None else links.unionByName(found)
    if links is None:
        out = packed.select("vec", F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"), F.lit(True).alias("kept"))
        return name_again(out, vectors, id_col, "vec")
    found = cut_lineage(links)
    counts = found.groupBy(F.col("vec").alias("node")).agg(F.sum("links").alias("links"))
    component = connected_components(found, "vec", "root").withColumnRenamed("id", "node")
    of_class = classes.join(counts, "node", "left").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = of_class.groupBy("component").agg(F.min("vec").alias("component_id"))
    of_class = of_class.join(least, "component").select("label", "direction", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = packed.withColumn("label", F.when(F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("direction").isNotNull(), F.concat_ws("|", "label", F.length("direction"))))
    out = out.join(of_class, ["label", "direction"], "left")
    out = out.select("vec", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec").alias("component_id"))
    return name_again(out.select("*", F.coalesce(F.col("vec") == F.col("component_id"), F.lit(True)).alias("kept")), vectors, id_col, "vec")


def oracle_sql(threshold: float = THRESHOLD) -> str:
    """The same in DuckDB SQL over ``embeddings``, all pairs of a label."""
    return f"""
with recursive v as (select vec_id, label, embedding::double[] as e from embeddings where label is not null and embedding is not null),
u as (select *, sqrt(list_dot_product(e, e)) as norm from v where len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0),
links as (select a.vec_id as x, b.vec_id as y from u a join u b on a.label = b.label and a.vec_id <> b.vec_id and a.norm > 0 and b.norm > 0 and len(a.e) = len(b.e) where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {threshold}),
reach(x, y) as (select vec_id, vec_id from embeddings union select r.x, l.y from reach r join links l on l.x = r.y),
comp as (select x, min(y) as component_id from reach group by x),
deg as (select x, count(*) as n_links from links group by x)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id = component_id as kept from embeddings join comp on comp.x = vec_id left join deg on deg.x = vec_id
"""


def _of_width(classes: DataFrame, threshold: float) -> DataFrame:
    """Rows (vec, root, links) of the classes of one vector length."""
    total = classes.count()
    sample = least_hashed(classes, "vec", SAMPLE, total).select("direction").collect()
    points = np.array([np.frombuffer(r[0], np.float64) for r in sample])
    half = points.shape[1] // 2
    words = int(min(MOST_WORDS, max(LEAST_WORDS, total**0.25)))
    books = fit_codebook(points[:, :half], words), fit_codebook(points[:, half:], words)
    visits = calibrate(points, books, threshold, RECALL)
    routed = classes.mapInArrow(_route(books, visits), "label string, cell long, resident boolean, vec long, copies long, direction binary, visited binary")
    cells = routed.groupBy("label", "cell").agg(F.count("*").alias("n"), F.count_if("resident").alias("residents")).where("residents > 0 and n > 1")
    cells = cells.select("label", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    dealt = routed.join(cells, ["label", "cell"])
    # a vector meets block (its own part as resident, any part) and (any part, its own part as visitor)
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    dealt = dealt.withColumn("slot", F.pmod(F.xxhash64("vec"), F.col("parts")).cast("int"))
    as_visitor = F.transform(every, lambda p: F.struct(p.alias("part"), F.col("slot").alias("other")))
    as_resident = F.transform(every, lambda p: F.struct(F.col("slot").alias("part"), p.alias("other")))
    blocks = F.when(F.col("resident"), F.array_union(as_visitor, as_resident)).otherwise(as_visitor)
    dealt = dealt.withColumn("block", F.explode(blocks)).select("label", "cell", "slot", F.col("block.part").alias("part"), F.col("block.other").alias("other"), "vec", "copies", "direction", "visited")
    return dealt.groupBy("label", "cell", "part", "other").applyInArrow(_verify(threshold), "vec long, root long, links long")

