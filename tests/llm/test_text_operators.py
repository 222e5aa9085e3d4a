import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parallaxis.llm import fm_index, hidden_markov, html_extraction, jaccard_join, mixing, pattern_packing, substring_dedup, toxicity

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, size STRING, key LONG, score STRING"


def corpus(seed=0):
    """Random prose with copies, near copies, shared passages, odd white space, nulls and a long text."""
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, base = prose(60), prose(120)
    texts = [prose(rnd.randint(0, 90)) for _ in range(40)]
    texts += [base] * 6 + [base.replace("w7 ", "x ", 1) for _ in range(3)] + [" ".join(base.split()[k:]) for k in (1, 2, 5)]
    texts += [f"{prose(20)} {passage} {prose(15)}" for _ in range(8)]
    texts += ["", None, "one", "a\tb\n\x0bc\x0c d  e", "short text here", "short text here", prose(4000), " \n ", "é ü\u00a0x ñ"]
    rnd.shuffle(texts)
    return [(k, t, "en", rnd.choice(["s1", "s1", "s1", "s2", "s3", None]), 3, "clash", 1, "x") for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    return spark.createDataFrame([*rows, rows[5], (None, "no id " * 20, None, None, None, None, None, None)], DOCS).repartition(3)


def words(text):
    return (text or "").encode().split()


def test_substring_dedup_equals_listing_all_windows(spark, docs):
    rows = docs.collect()
    least = {}
    for r in rows:
        w = words(r.text)
        for k in range(len(w) - 12):
            g = tuple(w[k : k + 13])
            if r.doc_id is not None:
                least[g] = min(least.get(g, r.doc_id), r.doc_id)
    want = Counter()
    for r in rows:
        w = words(r.text)
        gone = {j for k in range(len(w) - 12) if r.doc_id is not None and least[tuple(w[k : k + 13])] < r.doc_id for j in range(k, k + 13)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        want[r.doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(tuple(r) for r in substring_dedup.remove_repeats(docs, digest=True).collect()) == want
    kept = substring_dedup.remove_repeats(docs)
    assert kept.columns == [*docs.columns, "n_words", "n_removed"] and kept.count() == docs.count()
    assert sum(r.n_removed for r in kept.collect()) == sum(n[2] * c for n, c in want.items())
    own = docs.withColumn("n_words", F.lit("mine"))
    plain = substring_dedup.remove_repeats(own, counts=False)
    assert plain.columns == own.columns and {r.n_words for r in plain.collect()} == {"mine"}
    assert substring_dedup.remove_repeats(own).columns == [*docs.columns, "n_words", "n_removed"]


def test_fm_index_counts_every_pattern():
    rng = np.random.default_rng(1)
    text = rng.integers(1, 6, 400)
    text[::37] = 0
    index = fm_index.FMIndex(text)
    for _ in range(60):
        n = int(rng.integers(1, 14))
        k = int(rng.integers(0, len(text) - n))
        pattern = text[k : k + n]
        if (pattern == 0).any():
            continue
        lo, hi = index.first[pattern[-1:]], index.first[pattern[-1:] + 1]
        for s in pattern[-2::-1]:
            lo, hi = index.step(np.array([s]), lo, hi)
        windows = np.lib.stride_tricks.sliding_window_view(text, n)
        hits = np.flatnonzero((windows == pattern).all(1))
        assert hi[0] - lo[0] == len(hits)
        segment = (np.cumsum(np.concatenate([[True], text[:-1] == 0])) - 1)[hits]
        assert sorted(index.segment(np.arange(lo[0], hi[0]))) == sorted(segment)


def test_fm_index_keeps_no_suffix_array():
    text = np.concatenate([np.append(np.random.default_rng(k).integers(1, 500, 40), 0) for k in range(500)] + [np.full(5000, 7), [0]])
    index = fm_index.FMIndex(text)
    held = index.segments.nbytes + index.marks.words.nbytes + sum(level.words.nbytes + level.before.nbytes for _, level in index.levels)
    assert held < 4 * len(text)
    assert (index.segment(np.arange(index.first[7], index.first[8])) == 500).sum() == 5000


def test_jaccard_join_equals_all_pairs(docs):
    got = {}
    for r in jaccard_join.jaccard_join(docs.dropDuplicates(["doc_id"])).collect():
        got[r.doc_id] = (r.class_id, r.n_links, r.component_id, r.kept)
    sets = {}
    for r in docs.collect():
        w = words(r.text)
        if r.doc_id is not None and w:
            sets[r.doc_id] = frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1)))
    links = defaultdict(set)
    for a in sets:
        for b in sets:
            if a != b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a].add(b)
    for a in [x for x in got if x is not None]:
        seen, front = {a}, [a]
        while front:
            new = links[front.pop()] - seen
            seen |= new
            front += new
        same = min([x for x in sets if a in sets and sets[x] == sets[a]] or [a])
        assert got[a] == (same, len(links[a]), min(seen), a == min(seen))
    assert got[None] == (None, 0, None, True)


def test_large_groups_are_cut_into_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK_MEMBERS", 7)
    base = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join(base[:40] + [f"x{k}"] + base[41:])) for k in range(30)]
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(29, 0)}


def test_one_document_of_each_group_stays(docs):
    kept = jaccard_join.distinct_documents(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and None in ids
    flagged = {r.doc_id for r in jaccard_join.jaccard_join(docs).where("kept").collect()}
    assert set(ids) == flagged


def test_prefix_depth_reaches_the_recall():
    d = jaccard_join.prefix_depth(0.8, 16, 8, 0.9995)
    assert 1 - (1 - 0.8**d) ** 16 >= 0.9995 > 1 - (1 - 0.8 ** (d + 1)) ** 16


def test_depth_is_fitted_to_the_measured_recall(spark, docs):
    rows = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("doc_id", "text").alias("key"), "text")
    fitted = {r: jaccard_join.fitted_depth(rows, 0.8, r) for r in (0.3, 0.9, 0.9995, 1.0)}
    assert 8 >= fitted[0.3] >= fitted[0.9] > fitted[0.9995] >= fitted[1.0] >= 1
    rng = np.random.default_rng(1)
    sets = [rng.integers(1, 1 << 63, 300, np.uint64) for _ in range(200)]
    met = np.concatenate([jaccard_join.matched_depths(np.sort(s), 0.8, rng) for s in sets])
    for d in (8, 6):  # the measured recall is that of the theory
        assert abs((met >= d).mean() - (1 - (1 - 0.8**d) ** 16)) < 0.03
    assert jaccard_join.fitted_depth(rows.limit(0), 0.8) == jaccard_join.prefix_depth(0.8, 16, 8, 0.9995)


def test_depth_of_the_join_comes_from_no_sample(docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "fitted_depth", lambda *a: pytest.fail("the depth was fitted on a sample"))
    depths, signatures = [], jaccard_join._signatures
    monkeypatch.setattr(jaccard_join, "_signatures", lambda d: depths.append(d) or signatures(d))
    assert jaccard_join.jaccard_join(docs).count() == docs.count()
    assert depths == [4]


def test_joins_of_named_documents(docs):
    named = docs.dropDuplicates(["doc_id"]).withColumn("doc_id", F.concat(F.lit("n"), F.col("doc_id"))).withColumn("doc", F.lit(0))
    links = {r.doc_id: r.n_links for r in jaccard_join.jaccard_join(named).collect()}
    plain = {r.doc_id: r.n_links for r in jaccard_join.jaccard_join(docs.dropDuplicates(["doc_id"])).collect()}
    assert links == {k if k is None else f"n{k}": v for k, v in plain.items()}
    assert {r.doc_id for r in substring_dedup.remove_repeats(named, digest=True).collect()} == set(links)


def test_mix_meets_targets_and_documents_follow(spark, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    size = sum(r["size"] for r in got)
    by = defaultdict(lambda: [0, 0, 0.0])
    for r, s in zip(sorted(got, key=lambda r: (str(r.doc_id), r["size"])), sorted(docs.collect(), key=lambda r: (str(r.doc_id), len(words(r.text)))), strict=True):
        assert r["size"] == len(words(s.text)) and 0 <= r.taken <= 2 * r["size"]
        by[s.source][0] += r["size"]
        by[s.source][1] += r.taken
        by[s.source][2] = r.target
        assert r.source_size >= r["size"]
    assert all(abs(taken - target) <= 0.5 and target <= 2 * own for own, taken, target in by.values())
    assert math.isclose(sum(t for _, _, t in by.values()), 1.5 * size)
    assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, got))
    new = mixing.mixed_documents(docs).collect()
    assert sum(len(words(r.text)) for r in new) == sum(r.taken for r in got) and all(r["size"] in ("clash", None) for r in new)


def test_mix_deals_documents_to_output_shards(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD", 4)
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    targets = mixing.source_targets(sized)
    drawn = mixing.draw_slots(targets).join(targets.select("s", "source"), "s").collect()
    want, slots = Counter(), Counter()
    for r in drawn:
        want[r.shard, r.source] += r.words
        slots[r.shard] += 1
    shards = math.ceil(sum(math.floor(r.target + 0.5) for r in targets.collect()) / (mixing.BLOCK * 4))
    assert 1 < len(slots) <= shards and max(slots) < shards
    got, whole = Counter(), Counter()
    for r in mixing.mixed_documents(docs, shard_col="shard").collect():
        got[r.shard, r.source] += len(words(r.text))
        whole[r.doc_id, r.source] += len(words(r.text))
    assert got == want
    plain = Counter()
    for r in mixing.mixed_documents(docs).collect():
        plain[r.doc_id, r.source] += len(words(r.text))
    assert whole == plain
    listed = Counter()
    for r in mixing.mix(docs).collect():
        parts = [tuple(map(int, p.split(":"))) for p in r.shards.split()]
        assert sum(n for _, n in parts) == r.taken and parts == sorted(parts)
        for shard, n in parts:
            listed[shard] += n
    assert listed == Counter({shard: sum(n for (k, _), n in want.items() if k == shard) for shard in slots})


def test_shard_counts_are_a_draw_of_exact_totals(spark):
    targets = spark.createDataFrame([(0, 400_000, 600_000.0), (1, 90_000, 130_001.0)], "s LONG, source_size LONG, target DOUBLE")
    passes = mixing._passes(targets)
    counts = mixing.draw_counts(passes).collect()
    totals = {(r.s, r["pass"]): r.slots for r in passes.collect()}
    shards = passes.first().shards
    for key, total in totals.items():
        own = sorted((r.shard, r.first, r["count"]) for r in counts if (r.s, r["pass"]) == key)
        assert sum(n for _, _, n in own) == total and all(a[1] + a[2] == b[1] for a, b in zip(own, own[1:], strict=False))
        # chi-square of a uniform draw over the shards
        expected = total / shards
        got = dict((k, n) for k, _, n in own)
        assert sum((got.get(k, 0) - expected) ** 2 / expected for k in range(shards)) < shards + 5 * (2 * shards) ** 0.5


def test_permutation_is_a_bijection(spark):
    rows = spark.range(0, 1000).select(F.lit(3).cast("long").alias("s"), F.lit(1).cast("long").alias("pass"), F.lit(1000).cast("long").alias("n"), F.col("id").alias("slot"))
    there = mixing.permute(rows, "slot", "block", "n")
    back = mixing.permute(there, "block", "again", "n", backwards=True)
    found = back.collect()
    assert sorted(r.block for r in found) == list(range(1000)) and all(r.again == r.slot for r in found)
    assert sum(abs(r.block - r.slot) < 5 for r in found) < 60


def test_packing_places_every_piece(docs):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    reference = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = pattern_packing.pack(docs).collect()
    want = Counter()
    for r in docs.collect():
        ids = reference.encode(r.text or "", add_special_tokens=False).ids + [0]
        n = -(-len(ids) // 2048)
        start = 0
        for piece in range(n):
            size = 2048 if piece else len(ids) - 2048 * (n - 1)
            want[r.doc_id, piece, start, size, zlib.crc32(np.array(ids[start : start + size], "<u4").tobytes())] += 1
            start += size
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    rooms = defaultdict(list)
    for r in got:
        rooms[r.sequence_id].append((r.offset, r.length))
    for places in rooms.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(rooms) <= math.ceil(sum(r.length for r in got) / 2048) + 1


def test_encoder_equals_the_tokenizer_on_junk():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    reference = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(2)
    alphabet = "ab é1²_.,'s \n\t\u00a0Ⅷ\u0301<|endoftext|>—中\x00\r\u200b  x"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(4000)]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "x<|endoftext|>y  z", "<|endoftext", "|endoftext|>", "two words <|endoftext|>"]
    ids, ends = pattern_packing.Encoder().encode(pa.array(texts))
    got = [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    assert got == [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert got[4000] == [64, 220, 50256, 275]


def test_least_squares_and_best_fit():
    lengths = np.array([3, 5, 7])
    patterns = pattern_packing.enumerate_patterns(lengths, 10, slack=0)
    assert (7, 3) in patterns and (5, 5) in patterns
    target = np.zeros(11)
    target[[3, 5, 7]] = 40, 20, 40
    x = pattern_packing.non_negative_least_squares(patterns, target)
    assert dict(zip(patterns, np.rint(x), strict=True))[5, 5] == 10
    runs, n = pattern_packing.plan({3: 40, 5: 20, 7: 40}, 10)
    assert n == 50 and len(runs) == 4
    assert pattern_packing.plan({}, 10)[1] == 0


def test_language_model_scores(spark, docs):
    plain = docs.select("doc_id", "text", "size")
    got = hidden_markov.language_scores(plain).collect()
    token = lambda t: [w.lower() for w in words(t)] + [None]
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for r in docs.collect() if not held(r.doc_id) for w in token(r.text))
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for r in docs.collect():
        t = token(r.text)
        want[r.doc_id, held(r.doc_id), len(t), sum(counts[w] > 0 for w in t), total, round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t), 5)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    named = plain.select(F.concat(F.lit("n"), F.col("doc_id")).alias("doc_id"), "text", F.lit(1).alias("doc"), F.lit(1).alias("score"))
    again = hidden_markov.language_scores(named).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in again) == Counter((r.doc_id and "n" + str(r.doc_id), len(words(r.text)) + 1) for r in plain.withColumn("doc_id", F.col("doc_id").cast("string")).collect())
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(r.doc_id.encode()) % 7 == 2) for r in again)


def test_classes_grow_with_the_vocabulary():
    def classes(distinct):
        n = min(distinct, hidden_markov.HEAD)
        head = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        none = np.zeros(hidden_markov.MOST_SHARED, np.int64)
        found = hidden_markov.Lexicon(head, np.full(n, 5), 3, 5 * n + 3, distinct, none, none)
        return found.owned, found.pooled

    assert classes(100) == (100, 256)
    small, large = classes(2_000_000), classes(6_000_000)
    assert small[0] < large[0] and small[1] < large[1]
    most = classes(10**9)
    assert most == (hidden_markov.MOST_OWN, hidden_markov.MOST_SHARED) and 1 + sum(most) < 1 << 16


def test_training_goes_on_until_the_likelihood_settles(spark):
    rnd = random.Random(8)
    topics = [[f"{t}{k}" for k in range(60)] for t in "abcdefgh"]
    rows = [(k, " ".join(rnd.choice(topics[(k + j // 6) % 8]) for j in range(60))) for k in range(700)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    lexicon = hidden_markov.lexicon(hidden_markov.count_words(docs))
    model = hidden_markov.train(docs, lexicon, "doc_id", "text")
    prior = lexicon.prior()
    assert lexicon.classes == 1 + lexicon.owned + lexicon.pooled and np.isclose(prior.sum(), 1)
    groups = list(hidden_markov._groups(pa.array([t for _, t in rows]), lexicon))
    likelihood = lambda m: sum(hidden_markov.forward(m, active, observed).sum() for _, active, observed in groups)
    sums = [sum(x) for x in zip(*(hidden_markov.expected_counts(model, active, observed, lexicon.classes) for _, active, observed in groups), strict=True)][:3]
    before, after = likelihood(model), likelihood(hidden_markov.maximise(*sums, prior))
    assert after - before <= 1e-4 * abs(after)


def test_forward_equals_summing_all_paths():
    rng = np.random.default_rng(4)
    first, move, emit = rng.dirichlet([1] * 3), rng.dirichlet([1] * 3, 3), rng.dirichlet([1] * 5, 3).T
    offsets, kinds = np.array([0, 3, 3, 5]), np.array([1, 4, 2, 3, 1])
    for texts, active, observed in hidden_markov.lock_step(offsets, kinds):
        total = hidden_markov.forward((first, move, emit), active, observed)
        for row, k in enumerate(texts):
            seen = [*kinds[offsets[k] : offsets[k + 1]], 0]
            state = first * emit[seen[0]]
            for s in seen[1:]:
                state = state @ move * emit[s]
            assert math.isclose(total[row], math.log(state.sum()))
        starts, moves, emitted, likelihood = hidden_markov.expected_counts((first, move, emit), active, observed, 5)
        assert math.isclose(likelihood, total.sum())
        assert math.isclose(starts.sum(), 3) and math.isclose(moves.sum(), 5) and np.allclose(emitted.sum(1), np.bincount(observed, minlength=5))


def test_toxicity_learns_and_holds_out(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(3))
    rows, labels = [], []
    for k in range(400):
        bad = k % 5 == 0
        text = [word() for _ in range(rnd.randint(3, 60))]
        if bad:
            text[rnd.randrange(len(text))] = rnd.choice(["vile.", "Rotten", "nasty,"])
        rows.append((k, " ".join(text), "x"))
        labels.append((k, int(bad)))
    rows += [(400, None, "x"), (401, "", "x"), (402, "vile " * 3000, "x"), (None, "nasty", "x"), (0, "again", "x")]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, predicted STRING").withColumns({"score": F.lit("mine"), "held_out": F.lit(7)})
    marks = spark.createDataFrame([*labels, (None, 1), (7, None), (0, 1)], "doc_id LONG, toxic INT")
    got = toxicity.toxicity(docs, marks).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    test = [r for r in got if r.held_out and r.doc_id in truth and r.text != "again"]
    assert sum(r.predicted == truth[r.doc_id] for r in test) >= 0.97 * len(test) > 30
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert {r.doc_id: r.predicted for r in got if r.doc_id in (400, 401, 402)} == {400: 0, 401: 0, 402: 1}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert {r.score for r in toxicity.toxicity(docs, marks.where("doc_id < 0")).collect()} == {0.0}


def test_weights_are_those_of_learning_row_by_row():
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["vile", "calm", "warm", "Bad.", "so", "it"]) for _ in range(rnd.randint(1, 9))) for _ in range(90)]
    labels = np.array([int("vile" in t.split()) for t in texts])
    own = []
    for text in texts:
        _, places = toxicity.features(pa.array([text]))
        own.append(sorted(set(places.tolist())))
        w = [x.strip(toxicity.EDGES).lower() for x in text.split()]
        kinds = {("w", x) for x in w} | {("s", x[:4]) for x in w} | {("p", a, b) for a, b in zip(w, w[1:], strict=False)} | {("k", a, b) for a, b in zip(w, w[2:], strict=False)}
        assert len(own[-1]) == len(kinds)
    seen = Counter(p for x in own for p in x)
    z, n, weight = Counter(), Counter(), defaultdict(float)
    for _ in range(toxicity.PASSES):
        for places, label in zip(own, labels, strict=True):
            at = [p for p in places if seen[p] >= toxicity.LEAST] + ["bias"]
            error = 1 / (1 + math.exp(-max(-35, min(35, sum(weight[p] for p in at))))) - label
            for p in at:
                z[p] += error - (math.sqrt(n[p] + error * error) - math.sqrt(n[p])) / toxicity.ALPHA * weight[p]
                n[p] += error * error
                over = max(abs(z[p]) - (0 if p == "bias" else toxicity.L1), 0)
                weight[p] = -math.copysign(over, z[p]) / ((toxicity.BETA + math.sqrt(n[p])) / toxicity.ALPHA + toxicity.L2)
    live, found, bias = toxicity.train(pa.array(texts), labels)
    assert math.isclose(bias, weight["bias"], abs_tol=1e-9) and len(live)
    assert {int(k): round(float(v), 9) for k, v in zip(live, found, strict=True)} == {p: round(v, 9) for p, v in weight.items() if v and p != "bias"}


def test_training_keeps_no_more_than_places_of_the_texts():
    rng = np.random.default_rng(4)
    texts = pa.array([" ".join(np.char.mod("%d", rng.integers(0, 10**6, 6_000))) for _ in range(200)])
    labels = (np.arange(200) % 2).astype(int)
    tracemalloc.start()
    try:
        toxicity.train(texts, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    places = 200 * 6_000 * 4 * 4  # four of 4 bytes for a word
    fixed = 3 * 8 << toxicity.BITS  # the weights and their sums
    assert peak < places + fixed + (32 << 20)


def test_training_does_not_depend_on_batches(spark):
    rnd = random.Random(12)
    rows = [(k, " ".join(rnd.choice(["vile", "calm", "warm", "Bad.", "so", "it"]) for _ in range(rnd.randint(1, 9)))) for k in range(150)]
    docs = spark.createDataFrame([*rows, (150, None)], "doc_id LONG, text STRING")
    marks = spark.createDataFrame([(k, int("vile" in (t or ""))) for k, t in [*rows, (150, None)]], "doc_id LONG, toxic INT")
    kept = [r for r in docs.withColumn("rank", F.xxhash64("doc_id")).orderBy("rank").collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    live, weight, bias = toxicity.train(pa.array([r.text for r in kept]), np.array([int("vile" in (r.text or "")) for r in kept]))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = toxicity.fit(docs, marks)
        scored = {r.doc_id: r.score for r in toxicity.score(docs, got).collect()}
        again = {r.doc_id: r.score for r in toxicity.score(docs.withColumn("text", F.col("text").cast("binary")), got).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert np.array_equal(got[0], live) and np.array_equal(got[1], weight) and got[2] == bias
    assert scored == again and len(scored) == 151 and math.isclose(scored[150], 1 / (1 + math.exp(-bias)))


def test_html_blocks_and_labels(spark):
    page = '<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/a">Menu</a><li>More</ul></nav><div class="ad">Buy &amp; go</div><article><h1>The  title</h1><p><b>First&nbsp;one.<br><p>Second &lt;two&gt; <a href=x>link</a> text, with more.</article><footer>&copy; me</footer>'
    assert [t for t, _, _ in html_extraction.blocks(page)] == ["T", "Menu", "More", "Buy & go", "The title", "First one.", "Second <two> link text, with more.", "© me"]
    rng = np.random.default_rng(9)
    model = html_extraction.train()
    good = n = 0
    for _ in range(60):
        body, labels = html_extraction.generated_page(rng)
        found = html_extraction.blocks(body)
        assert len(found) == len(labels)
        want = "\n\n".join(t for (t, _, _), k in zip(found, labels, strict=True) if k)
        good += html_extraction.main_texts([body], model, {})[0] == want
        n += 1
    assert good >= 0.85 * n
    pages = spark.createDataFrame([(1, "u", page, 5), (2, None, None, 5), (2, None, "", 5), (3, "u", "plain <", 5)], "page_id LONG, url STRING, html STRING, n_chars INT")
    got = {(r.page_id, r.text, r.n_chars) for r in html_extraction.extract(pages, model=model).collect()}
    assert (1, "The title\n\nFirst one.\n\nSecond <two> link text, with more.", 57) in got and (2, "", 0) in got


def test_only_scripts_styles_and_templates_are_dropped():
    texts = lambda page: [t for t, _, _ in html_extraction.blocks(page)]
    assert texts('<p>One <svg class="i"/> two.</p><p>Three <svg viewBox="0"><path d="M0"/><text>icon</text></svg> four.') == ["One two.", "Three icon four."]
    assert texts("<video-player src=x></video-player><p>One.</p><script-loader></script-loader><p>Two.") == ["One.", "Two."]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be.</p><object><p>Held.</p></object><noscript><p>Plain.</p></noscript><p>End.") == ["Let x=1 be.", "Held.", "Plain.", "End."]
    assert texts("<iframe src=x><p>One.<canvas><p>Two.<audio><p>Three.") == ["One.", "Two.", "Three."]
    assert texts('<p>One.<script type="a">"<p>no"</script x><style>p{}</style ><template><p>no</template><p>Two.<script>no') == ["One.", "Two."]


def test_every_word_of_a_block_is_evidence():
    edge = " ".join(f"w{k}" for k in range(12))
    known = {}
    (_, (plain, told), _) = html_extraction.encode([(f"{edge} {'x ' * 9}{edge}", ("p",), 0), (f"{edge} {'x ' * 8}advert {edge}", ("p",), 0)], known)
    assert len(plain) == len(told) == 33 and told[20] == html_extraction.place("advert", html_extraction.WORDS) != plain[20]
    model = html_extraction.initial(np.random.default_rng(1))
    path = [np.array([0])] * 2
    out = html_extraction.vectors(model, path, [plain, told], np.zeros((2, html_extraction.NUMBERS)))
    assert np.allclose(out[:, html_extraction.WIDTH : 2 * html_extraction.WIDTH], [model["word"][x].mean(0) for x in (plain, told)])
    assert not np.allclose(out[0], out[1])


def test_lstm_gradient_is_the_difference_quotient():
    rng = np.random.default_rng(2)
    model = html_extraction.initial(rng)
    pages, labels = [], []
    for _ in range(2):
        body, y = html_extraction.generated_page(rng)
        pages.append(html_extraction.encode(html_extraction.blocks(body), {}))
        labels.append(np.array(y, float))
    loss, grads = html_extraction.gradients(model, pages, labels)
    for name, value in model.items():
        flat, g = value.reshape(-1), grads[name].reshape(-1)
        k = int(np.abs(g).argmax())
        flat[k] += 1e-5
        up = html_extraction.gradients(model, pages, labels)[0]
        flat[k] -= 2e-5
        down = html_extraction.gradients(model, pages, labels)[0]
        flat[k] += 1e-5
        assert math.isclose((up - down) / 2e-5, g[k], rel_tol=1e-3, abs_tol=1e-7)


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    marks = spark.createDataFrame([], "doc_id LONG, toxic INT")
    for out in (substring_dedup.remove_repeats(none), substring_dedup.remove_repeats(none, digest=True), jaccard_join.jaccard_join(none), jaccard_join.distinct_documents(none), mixing.mix(none), mixing.mixed_documents(none), pattern_packing.pack(none), hidden_markov.language_scores(none), toxicity.score(none, toxicity.fit(none, marks), score_col="_s")):
        assert out.count() == 0


@pytest.mark.parametrize("together", [1, 40, 1 << 20])
def test_texts_laid_out_together_are_the_texts_encoded(monkeypatch, together):
    monkeypatch.setattr(hidden_markov, "LAID_OUT", together)
    monkeypatch.setattr(hidden_markov, "TOKENS", 50)
    rng = np.random.default_rng(5)
    rows = [[rng.integers(1, 9, n).astype("<u2") for n in rng.integers(0, 30, size)] for size in (3, 1, 7, 4)]
    rows.append([np.zeros(0, "<u2")])
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array([np.array([len(t) for t in r], "<i4").tobytes() for r in part]), pa.array([np.concatenate(r).tobytes() for r in part])], names=["lengths", "kinds"])
    found = []
    for group in hidden_markov.lay_out([batch(rows[:2]), batch(rows[2:])]):
        active, observed = np.frombuffer(group["active"][0].as_py(), "<i4"), np.frombuffer(group["observed"][0].as_py(), "<u2")
        edge = np.concatenate([[0], np.cumsum(active)])
        for r in range(active[0]):
            found.append([int(observed[edge[t] + r]) for t in range(len(active)) if r < active[t]])
    assert sorted(found) == sorted(t.tolist() + [0] for r in rows for t in r)
    assert list(hidden_markov.lay_out([])) == []
