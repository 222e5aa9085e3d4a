import itertools
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from parallaxis.operators import components, covisibility, nearest


def tracks(spark, lists):
    return spark.createDataFrame([(p, i) for p, images in enumerate(lists) for i in images], "p LONG, i LONG")


def images(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "image LONG")


def generated(seed, points=120, n_images=14):
    """Random tracks, with repeats, over images in three rooms that few points join."""
    rnd = random.Random(seed)
    lists = []
    for _ in range(points):
        room = rnd.randrange(3)
        pool = [i for i in range(n_images) if i % 3 == room or rnd.random() < 0.05]
        lists.append([rnd.choice(pool) for _ in range(rnd.randint(0, 7))])
    return lists


def brute_pairs(lists, most):
    found = Counter()
    for images_ in lists:
        own = sorted(set(images_))
        if len(own) <= most:
            found.update(itertools.combinations(own, 2))
    return found


@pytest.mark.parametrize(("seed", "most"), [(0, 300), (1, 4), (2, 2)])
def test_pairs_equal_counting_every_combination(spark, seed, most):
    lists = generated(seed)
    got = {(r.lo, r.hi): r.shared for r in covisibility.covisible_pairs(tracks(spark, lists), "p", "i", most).collect()}
    assert got == brute_pairs(lists, most)
    row = covisibility.track_guard_stats(tracks(spark, lists), "p", "i", most).first()
    sizes = [len(set(x)) for x in lists]
    assert (row.longest_track, row.skipped_long_tracks) == (max(sizes), sum(n > most for n in sizes))


def test_curve_and_near_misses_equal_brute_force(spark):
    lists, nodes = generated(5), list(range(14))
    shared = brute_pairs(lists, 300)
    pairs = covisibility.covisible_pairs(tracks(spark, lists), "p", "i")

    def rooms(t):
        found = naive([p for p, n in shared.items() if n >= t])
        return {i: found.get(i, i) for i in nodes}

    thresholds = sorted({1, 2, max(shared.values()) // 2, max(shared.values()) + 1})
    curve = covisibility.threshold_curve(pairs, images(spark, nodes), thresholds)
    assert {r.threshold: r.components for r in curve.collect()} == {t: len(set(rooms(t).values())) for t in thresholds}
    t = thresholds[2]
    labels = covisibility.label_components(covisibility.component_members(pairs, images(spark, nodes), t))
    root = rooms(t)
    want = sorted((-n, *p) for p, n in shared.items() if n < t and root[p[0]] != root[p[1]])
    assert want and [(-r.shared, r.lo, r.hi) for r in covisibility.near_misses(pairs, labels, t).collect()] == want


def test_labels_are_largest_first_then_smallest_id(spark):
    pairs = spark.createDataFrame([(5, 6, 9), (1, 2, 9), (6, 7, 9)], "lo LONG, hi LONG, shared LONG")
    found = covisibility.label_components(covisibility.component_members(pairs, images(spark, [1, 2, 3, 5, 6, 7]), 5))
    assert {r.image: r.component for r in found.collect()} == {5: 0, 6: 0, 7: 0, 1: 1, 2: 1, 3: 2}


def centres(spark, rows):
    return spark.createDataFrame(rows, "image LONG, component LONG, cx DOUBLE, cy DOUBLE, cz DOUBLE, dx DOUBLE, dy DOUBLE, dz DOUBLE")


def test_nearest_across_equals_measuring_every_distance(spark):
    rnd = random.Random(7)
    rows = [(k, k % 3 if k < 9 else 2, *(rnd.uniform(-5, 5) for _ in range(3)), *random_direction(rnd)) for k in range(17)]
    size = Counter(r[1] for r in rows)
    want = {}
    for a, b in itertools.combinations(sorted(size), 2):
        small, large = (a, b) if size[a] <= size[b] else (b, a)
        for q in (r for r in rows if r[1] == small):
            near = sorted((math.dist(q[2:5], n[2:5]), n[0], n) for n in rows if n[1] == large)[:2]
            for d, other, n in near:
                angle = math.degrees(math.acos(max(-1, min(1, sum(x * y for x, y in zip(q[5:], n[5:], strict=True))))))
                want[a, b, q[0], other] = (round(d, 9), angle)
    got = {(r.component_a, r.component_b, r.image, r.neighbour): round(r.distance, 9) for r in covisibility.nearest_across(centres(spark, rows), 2).collect()}
    assert got == {k: d for k, (d, _) in want.items()}
    facing = {(r.component_a, r.component_b, r.image, r.neighbour) for r in covisibility.nearest_across(centres(spark, rows), 2, 70.0).collect()}
    assert facing == {k for k, (_, angle) in want.items() if angle <= 70.0} and len(facing) < len(want)


def random_direction(rnd):
    v = [rnd.gauss(0, 1) for _ in range(3)]
    return [x / math.hypot(*v) for x in v]


def naive(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(edges=st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), max_size=30), finish=st.sampled_from([0, 1 << 14]))
def test_components_match_union_find(spark, edges, finish):
    before, components.FINISH = components.FINISH, finish
    try:
        got = components.connected_components(spark.createDataFrame(edges, "src LONG, dst LONG"))
        assert {r.id: r.component for r in got.collect()} == naive(edges)
    finally:
        components.FINISH = before


@pytest.mark.parametrize("chunk", [1 << 18, 40])
@pytest.mark.parametrize("strange", [False, True])
def test_nearest_across_copies_chunks_and_odd_places(spark, monkeypatch, chunk, strange):
    monkeypatch.setattr(nearest, "CHUNK", chunk)
    monkeypatch.setattr(nearest, "QUERIES", 50)
    monkeypatch.setattr(nearest, "OPEN", 64)
    rnd = random.Random(3)
    rows = [(k, (k % 7) % 3, *(round(rnd.gauss(0, 1), 1) for _ in range(3)), 1.0, 0.0, 0.0) for k in range(300)]
    rows += [(k, 1, 0.5, 0.5, 0.5, 1.0, 0.0, 0.0) for k in range(400, 470)]  # copies, and copies of rows
    rows += [rows[5], rows[6], (9000, 0, 1e9, 1e9, 1e9, 1.0, 0.0, 0.0), (9001, 4, 0.1, 0.2, 0.3, 1.0, 0.0, 0.0)]
    if strange:
        inf, nan = math.inf, math.nan
        rows += [(500 + k, k % 3, *at, 1.0, 0.0, 0.0) for k, at in enumerate([(None, 0.0, 0.0), (nan, 0.0, 0.0), (inf, 0.0, 0.0), (-inf, None, 0.0), (0.0, inf, nan), (inf, 1.0, 2.0), (1e200, 0.0, 0.0)])]
        rows += [(600, 5, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0), (601, 5, inf, 0.0, 0.0, 1.0, 0.0, 0.0), (602, 6, nan, 0.0, 0.0, 1.0, 0.0, 0.0)]
    con = duckdb.connect()
    con.execute("create table c (image bigint, component bigint, cx double, cy double, cz double, dx double, dy double, dz double)")
    con.executemany("insert into c values (?, ?, ?, ?, ?, ?, ?, ?)", rows)
    want = con.execute("with s as (select component, count(*) as n from c group by all), p as (select a.component as a, b.component as b, case when a.n <= b.n then a.component else b.component end as small from s a join s b on a.component < b.component), met as (select a, b, q.image, o.image as neighbour, sqrt((q.cx-o.cx)*(q.cx-o.cx)+(q.cy-o.cy)*(q.cy-o.cy)+(q.cz-o.cz)*(q.cz-o.cz)) as d from p join c q on q.component = small join c o on o.component = a + b - small) select a, b, image, neighbour, d::varchar, rank from (select *, row_number() over (partition by a, b, image order by d, neighbour) as rank from met) where rank <= 3").fetchall()
    got = [(r.component_a, r.component_b, r.image, r.neighbour, r.distance, r["rank"]) for r in covisibility.nearest_across(centres(spark, rows), 3).collect()]
    plain = lambda d: d if d is None or d != d else float(d)
    text = lambda found: sorted(repr((*r[:4], plain(None if r[4] is None else float(r[4])), r[5])) for r in found)
    assert text(got) == text(want)


def test_nearest_across_sends_no_pairs(spark, monkeypatch):
    """Every image goes to a few tasks; before, each met each of the other component on its way to the window."""
    rnd = random.Random(5)
    rows = [(k, k % 2, *(rnd.gauss(0, 1) for _ in range(3)), 1.0, 0.0, 0.0) for k in range(4000)]
    plan = covisibility.nearest_across(centres(spark, rows), 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Window" not in plan
    measured, length = [], nearest._length
    monkeypatch.setattr(nearest, "_length", lambda x, y, z: measured.append(x.size) or length(x, y, z))
    q, t = (np.array([r[2:5] for r in rows if r[1] == c]) for c in (0, 1))
    nearest.nearest(q, t, np.arange(len(t)), 2)
    assert sum(measured) < len(q) * len(t) / 4
