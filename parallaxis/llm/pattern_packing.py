"""Best-fit packing of tokenised documents by length patterns.

Documents become pieces of at most ``most`` tokens. Only the histogram of
piece lengths (at most ``most`` numbers, whatever the corpus) reaches the
driver. There, few-document patterns that fill a sequence are enumerated,
non-negative least squares fits their repeat counts to the histogram, the
counts are rounded, and what remains is packed best fit, longest first. The
plan says which ranks of each length go where, so pieces find their place by
length and rank alone, without meeting each other.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parallaxis.llm.common import slices
from parallaxis.runtime import cut_lineage

#: Fixed value: the split pattern of byte-level BPE vocabularies of this kind.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A text without these is split into words at its single spaces; no token
#: crosses the place before a lone space. Other texts are encoded whole.
UNUSUAL = r"[ \n\r\t][ \n\r\t]|^[ \n\r\t]|[ \n\r\t]$|[\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
#: Rows of one length that are ranked together.
RANK_GROUP = 20_000


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Encoder:
    """Token ids of many texts under a byte-level BPE file of the ``tokenizers`` library.

    ``tokenizers`` itself encodes about 1 MB a second of text rich in new
    words. So the file's vocabulary is loaded as ranks (ids follow the order
    of merges in such files, which is checked) into ``tiktoken``, each
    distinct word of a batch is encoded once, and ids are gathered by word.
    The ids are those of ``tokenizers``; texts that hold an added token of
    the file (like an end-of-text mark, which is one id there), and any other
    kind of file, are handed to that library whole.
    """

    def __init__(self, path: str | None = None):
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        letters = byte_letters()
        added = {x["content"] for x in spec.get("added_tokens", [])}
        vocabulary = {k: v for k, v in model.get("vocab", {}).items() if k not in added}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
        made = [vocabulary.get("".join(m), -1) for m in merges]
        self.whole = None
        if model.get("type", "BPE") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or pre.get("use_regex") is False or spec.get("normalizer") or made != sorted(made) or len(vocabulary) != 256 + len(merges):
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(path)
            return
        self.path, self.library = path, None
        self.added = "|".join(re.escape(x) for x in sorted(added, key=len, reverse=True))
        import tiktoken

        ranks = {bytes(letters[c] for c in k): v for k, v in vocabulary.items()}
        self.one = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size[list(ranks.values())] = [len(k) for k in ranks]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)``: all ids in a row as unsigned 32-bit numbers, and where each text's end."""
        texts = pc.fill_null(texts, "")
        if self.whole:
            return _joined([x.ids for x in self.whole.encode_batch(texts.to_pylist(), add_special_tokens=False)])
        marked = pc.match_substring_regex(texts, self.added).to_numpy(zero_copy_only=False) if self.added else np.zeros(len(texts), bool)
        odd = pc.or_(pc.match_substring_regex(texts, UNUSUAL), pc.equal(texts, "")).to_numpy(zero_copy_only=False) | marked
        usual = np.flatnonzero(~odd)
        words = pc.split_pattern(texts.take(pa.array(usual)), " ")
        counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(counts)])
        flat = words.flatten().dictionary_encode()
        codes, vocabulary = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary
        ids, ends = self._words(vocabulary)
        # a text's first word has no space before it: entries after the vocabulary
        leads, lead_ends = _joined([self.one(x) for x in vocabulary.take(pa.array(codes[first[:-1]])).to_pylist()])
        codes = codes.astype(np.int64)
        codes[first[:-1]] = len(ends) + np.arange(len(usual))
        ids, ends = np.concatenate([ids, leads]), np.concatenate([ends, lead_ends + (ends[-1] if len(ends) else 0)])
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        out: list = [None] * len(texts)
        sizes = ends - begins
        for k in range(0, len(usual), 64):
            own = codes[first[k] : first[min(k + 64, len(usual))]]
            size = sizes[own]
            stop = np.cumsum(size)
            found = ids[np.repeat(begins[own] - (stop - size), size) + np.arange(stop[-1])]
            last = stop[first[k + 1 : k + 65] - first[k] - 1]
            for n, part in zip(usual[k : k + 64], np.split(found, last[:-1]), strict=True):
                out[n] = part
        for n in np.flatnonzero(odd & ~marked):
            out[n] = np.array(self.one(texts[n].as_py()), np.uint32)
        if marked.any():
            if self.library is None:
                from tokenizers import Tokenizer

                self.library = Tokenizer.from_file(self.path)
            for n in np.flatnonzero(marked):
                out[n] = np.array(self.library.encode(texts[n].as_py(), add_special_tokens=False).ids, np.uint32)
        return _joined(out)

    def _words(self, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word after a space: encoded in one go, parted by the bytes that each id stands for."""
        if not len(vocabulary):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        row = pa.ListArray.from_arrays(pa.array([0, len(vocabulary)], pa.int32()), vocabulary)
        ids = np.array(self.one(" " + pc.binary_join(row, " ")[0].as_py()), np.uint32)
        bytes_at = np.cumsum(pc.binary_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        return ids, np.searchsorted(np.cumsum(self.size[ids]), bytes_at) + 1


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(x) for x in parts], dtype=np.int64)
    return (np.concatenate([np.asarray(x, np.uint32) for x in parts]) if parts else np.zeros(0, np.uint32)), ends


def cut_pieces(docs: DataFrame, id_col="doc_id", text_col="text", tokenizer_path=None, most=2048, end_id=0) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)`` of every piece of every document.

    A null text is empty: one piece, the end id. Documents above ``most`` ids
    are cut so that only the first piece may be shorter. Repeated rows give
    repeated pieces; null ids are kept.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        encoder = Encoder(tokenizer_path)
        for whole in batches:
            for batch in slices(whole, "text", 12 << 20):
                source, rows = [], []
                every, ends = encoder.encode(batch.column(1))
                begins = np.concatenate([[0], ends[:-1]])
                for n, (a, b) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
                    ids = every[a:b].astype("<u4", copy=False).tobytes() + end
                    total = len(ids) // 4
                    count = -(-total // most)
                    first = total - most * (count - 1)
                    start = 0
                    for piece in range(count):
                        length = most if piece else first
                        source.append(n)
                        rows.append((piece, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])))
                        start += length
                piece, start, length, crc = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(source)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=[id_col, "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


def enumerate_patterns(lengths: np.ndarray, most: int, slack: int | None = None, triples: int = 24) -> list[tuple[int, ...]]:
    """Patterns of one to four of these lengths that leave at most ``slack`` unused (a 256th of a sequence, 6 at most)."""
    slack = min(6, most // 256) if slack is None else slack
    have = np.zeros(most + 1, bool)
    have[lengths] = True
    best = np.where(have, np.arange(most + 1), 0)
    np.maximum.accumulate(best, out=best)  # the longest length up to each
    found: set[tuple[int, ...]] = {(int(x),) for x in lengths if most - x <= slack}
    descending = np.sort(lengths)[::-1]
    for a in descending:
        room = most - a
        for gap in range(min(slack, room) + 1):
            if room - gap >= 1 and have[room - gap]:
                found.add(tuple(sorted((int(a), int(room - gap)), reverse=True)))
        second = lengths[(lengths <= min(a, room - 1))] if room > 1 else lengths[:0]
        if len(second):
            for b in second[np.unique(np.linspace(0, len(second) - 1, triples).astype(int))]:
                c = int(best[room - b])
                if c and room - b - c <= slack:
                    found.add(tuple(sorted((int(a), int(b), c), reverse=True)))
                elif c and best[room - b - c] and room - b - c - best[room - b - c] <= slack:
                    found.add(tuple(sorted((int(a), int(b), c, int(best[room - b - c])), reverse=True)))
    return sorted(found)


def non_negative_least_squares(patterns: list[tuple[int, ...]], target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that bring the patterns' length counts near ``target``.

    Accelerated projected gradient; the columns of the matrix have at most
    four entries, so a round costs a few passes over the patterns.
    """
    size = max(map(len, patterns))
    index = np.array([list(p) + [0] * (size - len(p)) for p in patterns])
    used = (index > 0).astype(float)

    def times(x):
        return np.bincount(index.ravel(), (used * x[:, None]).ravel(), len(target))

    def back(r):
        return (r[index] * used).sum(1)

    scale = np.ones(len(patterns))
    for _ in range(12):  # the largest eigenvalue, by power iteration
        scale = back(times(scale))
        norm = np.linalg.norm(scale)
        scale /= norm
    step = 1 / (norm * 1.02)
    x = np.zeros(len(patterns))
    ahead, t = x, 1.0
    for _ in range(rounds):
        new = np.maximum(ahead - step * back(times(ahead) - target), 0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_fit(counts: dict[int, int], most: int) -> Counter:
    """Best-fit decreasing over lengths with counts: patterns and how often each."""
    bins: dict[int, Counter] = {most: Counter()}
    rooms = np.zeros(most + 1, np.int64)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            fits = np.flatnonzero(rooms[length:])
            if len(fits):
                room = length + int(fits[0])
                pattern, n = next(iter(bins[room].items()))
                take, per = (min(left, n), 1)
                bins[room][pattern] -= take
                if not bins[room][pattern]:
                    del bins[room][pattern]
                rooms[room] -= take
            else:
                per = most // length
                pattern, room = (), most
                if left >= per:
                    take = left // per
                else:
                    take, per = 1, left
            rest = room - per * length
            bins.setdefault(rest, Counter())[pattern + (length,) * per] += take
            rooms[rest] += take
            left -= take * per
    return sum(bins.values(), Counter())


def plan(histogram: dict[int, int], most: int) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, sequence of that rank, offset) sorted, and the number of sequences."""
    counts = {int(k): int(v) for k, v in histogram.items() if v}
    chosen: Counter = Counter()
    lengths = np.array(sorted(counts), int)
    patterns = enumerate_patterns(lengths, most) if len(lengths) else []
    if patterns:
        target = np.zeros(most + 1)
        target[lengths] = [counts[x] for x in lengths.tolist()]
        repeats = non_negative_least_squares(patterns, target)
        for k in np.argsort(-repeats, kind="stable"):
            if repeats[k] < 0.5:
                break
            need = Counter(patterns[k])
            m = min(round(repeats[k]), *(counts[x] // n for x, n in need.items())) if len(need) else 0
            if m:
                chosen[patterns[k]] += m
                for x, n in need.items():
                    counts[x] -= m * n
    chosen += best_fit({k: v for k, v in counts.items() if v}, most)
    used: Counter = Counter()
    rows, sequence = [], 0
    for pattern, m in sorted(chosen.items()):
        offset = 0
        for length in pattern:
            rows.append((length, used[length], sequence, offset))
            used[length] += m
            offset += length
        sequence += m
    return np.array(sorted(rows), np.int64).reshape(-1, 4), sequence


def pack(docs: DataFrame, id_col="doc_id", text_col="text", tokenizer_path=None, most=2048, end_id=0) -> DataFrame:
    """Place every piece of every document: id, piece, start, length, ids_crc32, sequence_id, offset.

    Sequences hold at most ``most`` tokens and no gaps. Each length's pieces
    are ranked in hashed groups of about 20,000, so a length that a third of
    all rows share is ranked by many tasks. An empty table gives no rows.
    """
    pieces = cut_lineage(cut_pieces(docs, id_col, text_col, tokenizer_path, most, end_id))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs, _ = plan(histogram, most)
    total = sum(histogram.values())
    groups = max(1, -(-total // RANK_GROUP))
    grouped = pieces.withColumn("_g", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(groups)))
    sizes = grouped.groupBy("length", "_g").count()
    before = sizes.withColumn("_before", F.sum("count").over(Window.partitionBy("length").orderBy("_g")) - F.col("count")).drop("count")
    own = Window.partitionBy("length", "_g").orderBy(id_col, "piece", "ids_crc32")
    ranked = grouped.withColumn("_n", F.row_number().over(own)).join(before, ["length", "_g"])
    ranked = ranked.select(id_col, "piece", "start", "length", "ids_crc32", (F.col("_before") + F.col("_n") - 1).alias("_rank"))
    wide = total + 1
    keys = runs[:, 0] * wide + runs[:, 1]

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(keys, length * wide + rank, side="right") - 1
            names = [id_col, "piece", "start", "length", "ids_crc32"]
            found = [pa.array(runs[at, 2] + rank - runs[at, 1]), pa.array(runs[at, 3])]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), *found], names=[*names, "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    return ranked.mapInArrow(place, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
