"""Word splitting, hashing and batch slicing shared by the text operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir: str, name: str):
    """The Parquet table ``name`` of the data folder, by any path that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def number(docs: DataFrame, id_col: str) -> Column:
    """Ids as 64-bit numbers: whole numbers as they are, others by the hash of their text; null stays null."""
    if isinstance(docs.schema[id_col].dataType, IntegralType):
        return F.col(id_col).cast("long")
    return F.when(F.col(id_col).isNotNull(), F.xxhash64(F.col(id_col).cast("string")))


def least_hashed(rows: DataFrame, key: str, most: int, total: int) -> DataFrame:
    """The ``most`` of ``total`` rows whose key has the least hash; keys are distinct and not null.

    A bound on the hash goes first, one that twice as many rows and 100 more
    are expected to pass as are asked for: else every partition would send as
    many, and the rows that meet in one place would grow with the partitions.
    """
    passing = 2 * most + 100
    if total > passing:
        rows = rows.where(F.xxhash64(key) < F.lit(2**64 * passing // total - 2**63))
    return rows.orderBy(F.xxhash64(key), key).limit(most)


def name_again(out: DataFrame, docs: DataFrame, id_col: str, number_col: str) -> DataFrame:
    """``out`` with the ids of ``docs``, named ``id_col``, in place of the numbers of ``number_col``."""
    rest = [c for c in out.columns if c != number_col]
    field = docs.schema[id_col].dataType
    if isinstance(field, IntegralType):
        return out.select(F.col(number_col).cast(field).alias(id_col), *rest)
    names = docs.where(F.col(id_col).isNotNull()).groupBy(number(docs, id_col).alias("_number")).agg(F.min(id_col).alias("_name"))
    return out.join(names, out[number_col] == names["_number"], "left").select(F.col("_name").alias(id_col), *rest)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20):
    """Cut a batch into slices of about ``most_bytes`` of ``column``; longer values come alone."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        used = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, used + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def split_words(texts: pa.Array, lower: bool = False):
    """``(offsets, codes, vocabulary)`` of the words of a string array; null texts have none.

    Document ``i`` holds ``vocabulary[codes[offsets[i]:offsets[i + 1]]]``.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    texts = pc.ascii_trim_whitespace(texts)
    words = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    flat = words.flatten()
    if empty.any():
        flat = flat.filter(pc.not_equal(flat, ""))
        counts = np.where(empty, 0, counts)
    encoded = flat.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return offsets, encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def hash_words(vocabulary: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, alike in every process."""
    if not len(vocabulary):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(vocabulary.to_numpy(zero_copy_only=False), categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive entries (also across documents)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - n + 1 + k]
    return mix(out)
