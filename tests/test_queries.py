import duckdb
import pytest

from parallaxis.plans import catalog, round_trips

SF = "/root/testdata/sf0.001"
TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "labels")
CHOSEN = ["covisible_pairs_capped", "component_sizes", "bridge_knn", "already_matched_split", "error_stats", "registration_by_clip", "dead_and_weak_groups", "model_summary", "window_select_override", "override_by_url_prefix", "frame_name_parse", "points_in_boxes", "box_selection", "subset_features_nulled", "view_directions", "validate_bidirectional", "majority_vote", "suggested_boxes", "crop_counts", "copy_plan", "issue_examples", "trimmed_bounds", "observation_profile", *round_trips.QUERIES]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def test_every_query_has_a_name_and_most_have_sql():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"kmeans_partition", "pca_planarity"}


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, con, name):
    got = catalog.queries()[name](spark, SF)
    want = con.execute(f"select {', '.join(got.columns)} from ({catalog.oracle_sql()[name]})").fetchall()
    plain = lambda rows: sorted((tuple(round(x, 8) if isinstance(x, float) else x for x in r) for r in rows), key=repr)
    assert plain(got.collect()) == plain(want)


@pytest.mark.parametrize("name, table", [("track_offsets", "orders"), ("global_positions", "lineitem")])
def test_tables_get_offsets_and_positions(spark, con, name, table):
    got = catalog.queries()[name](spark, SF)
    rows = sorted(map(tuple, got.collect()))
    assert len(rows) == con.execute(f"select count(*) from {table}").fetchone()[0]
    assert rows == sorted(con.execute(f"select {', '.join(got.columns)} from ({catalog.oracle_sql()[name]})").fetchall())


def test_offsets_and_positions_of_a_small_fixture(spark, tmp_path):
    orders = [(k, "FOP"[k % 3]) for k in range(1, 9)]
    lines = [(k, n, float(k * n % 5), 1, 1, 10.0) for k in range(1, 8) for n in range(1, k % 4 + 1)]
    spark.createDataFrame(orders, "o_orderkey LONG, o_orderstatus STRING").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey LONG, l_linenumber INT, l_extendedprice DOUBLE, l_partkey LONG, l_suppkey LONG, l_quantity DOUBLE").write.parquet(f"{tmp_path}/lineitem.parquet")
    ends, want = {}, []
    for k, model in orders:
        ends[model] = ends.get(model, 0) + sum(line[0] == k for line in lines)
        want.append((model, k, ends[model]))
    assert sorted(map(tuple, catalog.queries()["track_offsets"](spark, tmp_path).collect())) == sorted(want)
    ranked = sorted(lines, key=lambda x: (-x[2], *x[:2]))
    assert sorted(map(tuple, catalog.queries()["global_positions"](spark, tmp_path).collect())) == sorted((*x[:2], n) for n, x in enumerate(ranked))


def test_components_of_tables(spark, con, tmp_path):
    query, sql = catalog.queries()["connected_components"], catalog.oracle_sql()["connected_components"]
    got = sorted(map(tuple, query(spark, SF).collect()))
    assert got == sorted(con.execute(f"select id, component from ({sql})").fetchall())
    ends = "select o_custkey as v from orders union select o_orderkey + 1000000000 from orders union select l_orderkey + 1000000000 from lineitem union select l_suppkey + 2000000000 from lineitem"
    assert [r[0] for r in got] == sorted(r[0] for r in con.execute(ends).fetchall())
    # several components, an order without lines and lines without an order
    orders = [(k, k % 7) for k in range(1, 30) if k % 5]
    lines = [(k, 100 + k % 7 // 2, 1 + k) for k in range(1, 34) if k % 4]
    spark.createDataFrame(orders, "o_orderkey LONG, o_custkey LONG").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey LONG, l_suppkey LONG, l_partkey LONG").write.parquet(f"{tmp_path}/lineitem.parquet")
    edges = [(c, k + 10**9) for k, c in orders] + [(k + 10**9, s + 2 * 10**9) for k, s, _ in lines]
    label = {v: v for e in edges for v in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert len(set(label.values())) > 1
    assert sorted(map(tuple, query(spark, str(tmp_path)).collect())) == sorted(label.items())


def test_kmeans_partition_takes_the_best_of_ten_starts(spark, monkeypatch):
    from pyspark.ml.clustering import KMeans

    fit, models = KMeans.fit, []
    monkeypatch.setattr(KMeans, "fit", lambda *a: models.append(fit(*a)) or models[-1])
    got = {r.id: r.label for r in catalog.queries()["kmeans_partition"](spark, SF).collect()}
    assert len(models) == 10
    best = min(models, key=lambda m: m.summary.trainingCost)
    assert got == {r.id: r.prediction for r in best.summary.predictions.collect()}
