"""Clustering (J7, G6, G7, M1-M6) on a seeded 720-point, 5-column fixture and
the 2-D view operators (P10-P13, J8-J10, G10)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rackpulse.operators import cluster as C
from rackpulse.operators import view as V

FEATS = C.FEATURES


@pytest.fixture(scope="module")
def pts(spark):
    rnd = np.random.default_rng(720)
    n = 720
    data = np.column_stack([
        rnd.gamma(0.6, 110, n).round(),          # filewrites: skewed, 0..~400
        rnd.gamma(0.3, 40, n).round(),           # filereads
        rnd.normal(7.2, 1.4, n).round(2),        # CPU
        rnd.normal(5.76e8, 6.5e7, n).round(),    # diskIOBW
        rnd.lognormal(15, 1.7, n).round(2),      # net bytes
    ])
    rows = [(0, i, *map(float, r)) for i, r in enumerate(data)]
    return spark.createDataFrame(rows, "server int, rn int, " + ", ".join(f"{f} double" for f in FEATS)), data


def test_pick_k(spark):
    df = spark.createDataFrame([(720,), (3,), (16,), (100,)], "n long")
    assert [r.k for r in df.select(C.pick_k(F.col("n")).alias("k")).collect()] == [13, 2, 2, 5]
    assert C.pick_k_value(720) == 13


def test_nearest_and_cost_match_numpy(spark, pts):
    df, data = pts
    centers = C.first_k_centers(df, ["server"], ["rn"], 13)
    a = C.nearest_center(df, centers, ["server"]).orderBy("rn").collect()
    cen = data[:13]
    d2 = ((data[:, None, :] - cen[None, :, :]) ** 2).sum(axis=2)
    assert [r.cluster_id for r in a] == list(d2.argmin(axis=1))
    cost = C.cluster_cost(C.nearest_center(df, centers, ["server"]), ["server"]).collect()[0]
    assert cost.cost == pytest.approx(d2.min(axis=1).sum(), rel=1e-12)
    assert cost.sum_dist == pytest.approx(np.sqrt(d2.min(axis=1)).sum(), rel=1e-12)


def test_lloyd_costs_do_not_rise(spark, pts):
    df, _ = pts
    c = C.first_k_centers(df, ["server"], ["rn"], 13)
    costs = []
    for _ in range(4):
        costs.append(C.cluster_cost(C.nearest_center(df, c, ["server"]), ["server"]).collect()[0].cost)
        c = C.lloyd_step(df, c, ["server"]).select("server", "cluster_id", *FEATS)
    assert all(b <= a * (1 + 1e-12) for a, b in zip(costs, costs[1:]))
    final = C.lloyd(df, C.first_k_centers(df, ["server"], ["rn"], 13), ["server"], 3)
    assert final.count() == 13 and final.agg(F.sum("n_points")).collect()[0][0] == 720


def test_lloyd_keeps_empty_centre(spark):
    p = spark.createDataFrame([(0, 0.0, 0.0), (0, 1.0, 0.0)], "g int, x double, y double")
    c = spark.createDataFrame([(0, 0, 0.5, 0.0), (0, 1, 100.0, 100.0)], "g int, cluster_id int, x double, y double")
    got = {r.cluster_id: (r.x, r.y, r.n_points) for r in C.lloyd_step(p, c, ["g"], ["x", "y"]).collect()}
    assert got == {0: (0.5, 0.0, 2), 1: (100.0, 100.0, 0)}


def test_kmeans_fit_cost_is_own_cost(spark, pts):
    df, _ = pts
    centers, cost, seed = C.kmeans_fit(spark, df, 13, seeds=(0, 1))
    assert centers.count() == 13 and seed in (0, 1)
    c = centers.withColumn("server", F.lit(0))
    own = C.cluster_cost(C.nearest_center(df, c, ["server"]), ["server"]).collect()[0].cost
    # trainingCost is summed in the last iteration, before its centre update:
    # the cost at the returned centres can only be lower or equal
    assert own <= cost * (1 + 1e-9) and own >= 0.9 * cost


def test_linear_scale_and_zero_width(spark):
    df = spark.createDataFrame([(0, 1.0, 5.0), (0, 3.0, 5.0)], "g int, a double, b double")
    r = V.scale_view(df, ["g"], "a", "b").orderBy("a").collect()
    assert [(x.px, x.py) for x in r] == [(0.0, 450.0), (600.0, 450.0)]   # zero-width y maps to range start


def test_quantize_and_ticks(spark):
    df = spark.createDataFrame([(0.0,), (4.99,), (5.0,), (10.0,), (12.0,), (-1.0,)], "x double")
    got = [r.b for r in df.select(V.quantize(F.col("x"), F.lit(0.0), F.lit(10.0), 2).alias("b")).collect()]
    assert got == [0, 0, 1, 1, 1, 0]
    ext = df.sparkSession.createDataFrame([(0, 0.0, 1.0), (1, -3.2, 97.0)], "g int, lo double, hi double")
    t = V.nice_ticks(ext, ["g"]).collect()
    g0 = sorted(round(r.tick, 9) for r in t if r.g == 0)
    assert g0 == [round(0.1 * i, 9) for i in range(11)]
    g1 = sorted(r.tick for r in t if r.g == 1)
    assert g1[0] == 0.0 and g1[-1] == 90.0 and len(g1) == 10


def test_voronoi_cells_properties(spark):
    c = spark.createDataFrame([(0, 0, 100.0, 100.0), (0, 1, 400.0, 300.0), (0, 2, 500.0, 50.0),
                               (0, 3, 400.0, 300.0)],   # coincident with 1: no cell of its own
                              "g int, cluster_id int, px double, py double")
    cells = V.voronoi_cells(c, ["g"]).collect()
    assert {r.cluster_id for r in cells} == {0, 1, 2}
    cen = {0: (100.0, 100.0), 1: (400.0, 300.0), 2: (500.0, 50.0)}
    for r in cells:
        own = np.hypot(r.x - cen[r.cluster_id][0], r.y - cen[r.cluster_id][1])
        assert all(own <= np.hypot(r.x - x, r.y - y) + 1e-6 for x, y in cen.values())
        assert -1e-9 <= r.x <= 600 + 1e-9 and -1e-9 <= r.y <= 450 + 1e-9
    links = sorted((r.a, r.b) for r in V.voronoi_links(c, ["g"]).collect())
    assert links == [(0, 1), (0, 2), (1, 2)]


def test_voronoi_assign_uses_scaled_view(spark):
    p = spark.createDataFrame([(0, 1, 0.0, 0.0), (0, 2, 10.0, 1000.0), (0, 3, 9.0, 0.0)],
                              "g int, rn int, a double, b double")
    c = spark.createDataFrame([(0, 0, 0.0, 0.0), (0, 1, 10.0, 1000.0)], "g int, cluster_id int, a double, b double")
    got = {r.rn: r.cell for r in V.voronoi_assign(p, c, ["g"], "a", "b").collect()}
    # in raw units (9, 0) is nearest centre 0; in the scaled view it is nearer centre 1
    assert got == {1: 0, 2: 1, 3: 1}
    counts = {r.cell: (r.n_points, round(r.share, 6)) for r in V.cell_counts(
        V.voronoi_assign(p, c, ["g"], "a", "b"), ["g"]).collect()}
    assert counts == {0: (1, 0.333333), 1: (2, 0.666667)}


def test_ordinal_codes_first_appearance(spark):
    df = spark.createDataFrame([(5, "b"), (1, "c"), (3, "b"), (2, "a")], "pos int, v string")
    got = {r.v: (r.code, r.slot) for r in V.ordinal_codes(df, "v", "pos", palette=2).collect()}
    assert got == {"c": (0, 0), "a": (1, 1), "b": (2, 0)}


def _as_rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_too_many_centres_are_joined(spark, pts, monkeypatch):
    """The join beyond the bound gives what the broadcast kernel gives, for several groups and runs."""
    df, _ = pts
    df = df.withColumn("server", (F.col("rn") % 3).cast("int")).withColumn("day", F.lit("2020-01-01").cast("date"))
    start = C.start_centers(df, ["server"], F.unix_date("day"), "rn", 4)
    kernel = (_as_rows(C.nearest_center(df, start.where("run = 0").drop("run"), ["server"]), "rn"),
              _as_rows(C.best_run(df, C.lloyd(df, start, ["server"], 3), ["server"]).select("server", "run", "cluster_id", "n_points"), "server", "cluster_id"))
    monkeypatch.setattr(C, "MOST_CENTERS", 5)
    joined = (_as_rows(C.nearest_center(df, start.where("run = 0").drop("run"), ["server"]), "rn"),
              _as_rows(C.best_run(df, C.lloyd(df, start, ["server"], 3), ["server"]).select("server", "run", "cluster_id", "n_points"), "server", "cluster_id"))
    assert kernel == joined and kernel[0] and kernel[1]


def test_lloyd_ends_at_the_fixed_point(spark, monkeypatch):
    p = spark.createDataFrame([(0, float(x)) for x in (0, 1, 10, 11)], "g int, x double")
    c = spark.createDataFrame([(0, 0, 0.0), (0, 1, 1.0)], "g int, cluster_id int, x double")
    steps = []
    real = C._stepped
    monkeypatch.setattr(C, "_stepped", lambda *a: steps.append(1) or real(*a))
    got = {r.cluster_id: (r.x, r.n_points) for r in C.lloyd(p, c, ["g"], 50, ["x"]).collect()}
    assert got == {0: (0.5, 2), 1: (10.5, 2)} and len(steps) < 6


def test_awkward_points_and_groups(spark):
    p = spark.createDataFrame([(None, 1.0), (None, 9.0), ("a", None), ("a", float("nan")), ("a", 2.0), ("b", 1.0)], "g string, x double")
    c = spark.createDataFrame([(None, 5, 0.0), (None, 6, 10.0), ("a", 7, 2.0), ("a", 8, 2.0)], "g string, cluster_id int, x double")
    got = sorted(((r.g, r.cluster_id, r.d2) for r in C.nearest_center(p, c, ["g"], ["x"]).collect()), key=str)
    inf = float("inf")
    assert got == sorted([(None, 5, 1.0), (None, 6, 1.0), ("a", -1, inf), ("a", -1, inf), ("a", 7, 0.0)], key=str)
    assert C.nearest_center(p.limit(0), c, ["g"], ["x"]).count() == 0
    assert C.lloyd(p.limit(0), c, ["g"], 2, ["x"]).agg(F.sum("n_points")).first()[0] == 0


def test_standardised_distances(spark, pts):
    df, data = pts
    start = C.first_k_centers(df, ["server"], ["rn"], 13)
    got = _as_rows(C.lloyd(df, start, ["server"], 2, weights=C.spread(df, ["server"])).select("cluster_id", *FEATS, "n_points"), "cluster_id")
    z, at = (data - data.mean(0)) / data.std(0), None
    cen = z[:13]
    for _ in range(2):
        at = ((z[:, None] - cen[None]) ** 2).sum(2).argmin(1)
        cen = np.array([z[at == k].mean(0) if (at == k).any() else cen[k] for k in range(13)])
    assert [r[-1] for r in got] == np.bincount(at, minlength=13).tolist()
    np.testing.assert_allclose([r[1:-1] for r in got], cen * data.std(0) + data.mean(0), rtol=1e-9)


def test_the_product_finds_what_single_distances_find(monkeypatch):
    rng = np.random.default_rng(3)
    for case in range(60):
        sizes = rng.integers(1, 9, rng.integers(1, 5))
        at = rng.integers(0, 4, (sizes.sum(), 5)).astype(float) if case % 2 else rng.random((sizes.sum(), 5)) * 10.0 ** rng.integers(-3, 9, 5)
        points = np.vstack([at[rng.integers(0, len(at), 40)], rng.integers(0, 4, (200, 5))])  # ties, and points on centres
        if case % 5 == 0:
            points[3, 2], at[0, 1] = np.nan, np.nan
        weights = {"a": rng.choice([0, 1, 3.7e-9, 2e8], 5)} if case % 3 == 0 else None
        held = C.Gathered(["a"] * len(at), [r for r, n in enumerate(sizes) for _ in range(n)], [i for n in sizes for i in range(n)], at, weights)
        for block, place, d2 in held.nearest(points, "a"):
            want = C._by_feature(points[block], held.at, weights and weights["a"], [(s, e) for _, s, e in held.parts["a"]])
            assert (place == want[0]).all() and (d2 == want[1]).all()
    # without ties no point is compared with every centre feature by feature
    at = rng.random((400, 5))
    held = C.Gathered(["a"] * 400, [i // 40 for i in range(400)], [i % 40 for i in range(400)], at)
    monkeypatch.setattr(C, "_by_feature", None)
    assert sum(len(place) for _, place, _ in held.nearest(rng.random((5000, 5)), "a")) == 5000


def test_points_are_laid_out_by_group(spark):
    rows = [(i % 3, i, *[float(i * 7 % 11 + f) for f in range(5)]) for i in range(3000)] + [(None, 1, 1.0, 2.0, 3.0, 4.0, 5.0)]
    points = spark.createDataFrame(rows, "g int, rn int, " + ", ".join(f"{f} double" for f in C.FEATURES))
    laid = C.laid_out(points, ["g"], ["rn"], "laid")
    assert sorted(map(str, laid.drop("_group").collect())) == sorted(map(str, points.collect()))
    files = laid.selectExpr("input_file_name() AS f", "_group").distinct().groupBy("f").count().collect()
    assert len(files) > 3 and max(r["count"] for r in files) <= 2  # hot groups in several files, few groups in one
    starts = C.start_centers(points, ["g"], F.lit(1), "rn", 2)
    a, b = (sorted(map(str, C.best_run(p, C.lloyd(p, starts, ["g"], 5), ["g"]).collect())) for p in (points, laid))
    assert a == b


def test_small_results_are_written_by_several_tasks(spark, tmp_path):
    import os

    from rackpulse.sources import sinks

    rows = [(f"n{i % 40}", *[float(i)] * 5) for i in range(80)]
    df = spark.createDataFrame(rows, "name string, " + ", ".join(f"{f} double" for f in C.FEATURES))
    sinks.write_named(df, df, str(tmp_path))
    assert sinks.read_named(spark, str(tmp_path)).count() == 160
    for kind in ("centers", "manifest"):
        tasks = {f[:10] for _, _, own in os.walk(tmp_path / kind) for f in own if f.startswith("part-")}
        assert len(tasks) > 4, (kind, tasks)
