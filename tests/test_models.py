"""Models without an SQL twin: likelihood, forecasts, forest and Shapley values against brute force."""

import math
import tracemalloc
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellcast import fixed
from cellcast.functions import arma
from cellcast.functions import trees as grown
from cellcast.operators import arima, forest, hotspot, sampling, shapley
from cellcast.operators.split import dates_of


def covariance(phi, theta, n):
    gamma = np.array(arma._autocovariance(phi, theta, n - 1))
    return gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]


@pytest.mark.parametrize("phi,theta", [([0.5, -0.3], [0.4, 0.2]), ([0.6], []), ([], [0.5, -0.2]), ([0.3], [0.9]), ([-0.4, 0.2], [0.7])])
def test_likelihood_and_forecast_match_the_full_covariance(phi, theta):
    y = np.random.default_rng(3).normal(size=40)
    cov = covariance(phi, theta, 44)
    inner = cov[:40, :40]
    weights, var = arma.innovation_weights(phi, theta, 44)
    errors = arma.innovations(y, phi, weights)
    spread = np.array(var[:40] + [var[-1]] * (40 - len(var)))
    assert (errors**2 / spread).sum() == pytest.approx(y @ np.linalg.solve(inner, y), rel=1e-8)
    assert np.log(spread).sum() == pytest.approx(np.linalg.slogdet(inner)[1], abs=1e-8)
    ahead = arma.forecast(y, phi, weights, 4)
    assert ahead == pytest.approx(cov[40:, :40] @ np.linalg.solve(inner, y), abs=1e-8)


def test_fit_recovers_an_autoregression():
    rng = np.random.default_rng(0)
    y = np.zeros(400)
    for i in range(1, 400):
        y[i] = 0.6 * y[i - 1] + rng.normal()
    y = y[100:] + 20
    aic, values = arma.fit_forecast(y, 1, 0, 0, 200)
    mean = values[-1]
    assert mean == pytest.approx(20, abs=0.6)
    assert (values[1] - mean) / (values[0] - mean) == pytest.approx(0.6, abs=0.1)
    assert aic < arma.fit_forecast(y, 0, 0, 1, 1)[0]


def test_differenced_forecast_continues_from_the_last_value_and_is_not_negative():
    walk = np.cumsum(np.random.default_rng(5).normal(size=60)) + 30
    assert arma.fit_forecast(walk, 0, 1, 1, 3)[1][0] == pytest.approx(walk[-1], abs=3)
    assert min(arma.fit_forecast(walk - 60, 1, 0, 0, 5)[1]) == 0.0


def test_constant_and_short_series_have_no_fit():
    assert arma.fit_forecast(np.ones(50), 1, 0, 1, 2) is None
    assert arma.fit_forecast(np.array([1.0, 2.0, 0.0]), 2, 1, 2, 2) is None


def test_order_grid():
    assert len(arima.orders()) == 16 and all(p or q for p, _, q in arima.orders())


def test_forecasts_cover_every_test_day(spark):
    rng = np.random.default_rng(2)
    days = pd.date_range("2024-01-01", periods=30).date
    rows = [(c, d, int(rng.poisson(1.0)) if c != "flat" else 2) for c in ("a", "b", "flat", "quiet") for d in days]
    table = spark.createDataFrame(rows, "grid_id string, date date, incident_count bigint")
    train, test = table.filter("date <= '2024-01-24'"), table.filter("date > '2024-01-24'")
    cells = spark.createDataFrame([("a",), ("b",), ("flat",)], "grid_id string")
    got = arima.arima_grid_forecast(train, cells, dates_of(test)).toPandas()
    assert len(got) == 3 * 6 and not got.duplicated(["grid_id", "date"]).any()
    assert (got.forecast >= 0).all()
    # No order fits a constant series: the mean stands in.
    assert got[got.grid_id == "flat"].forecast.tolist() == pytest.approx([2.0] * 6)
    scored = arima.train_and_predict(train, test).toPandas()
    assert len(scored) == 24 and scored.arima_prob.max() == pytest.approx(1.0)
    assert ((scored.arima_forecast >= 0.1).astype(int) == scored.arima_pred).all()


def brute_shapley(x, nodes, width):
    table = {r.id: r for r in nodes.itertuples()}

    def expected(i, known):
        n = table[i]
        if n.left < 0:
            return n.value
        if n.feature in known:
            return expected(n.left if x[n.feature] <= n.threshold else n.right, known)
        lw, rw = table[n.left].cover, table[n.right].cover
        return (lw * expected(n.left, known) + rw * expected(n.right, known)) / (lw + rw)

    out = []
    for f in range(width):
        others, total = [g for g in range(width) if g != f], 0.0
        for size in range(width):
            for s in combinations(others, size):
                w = math.factorial(size) * math.factorial(width - size - 1) / math.factorial(width)
                total += w * (expected(0, {*s, f}) - expected(0, set(s)))
        out.append(total)
    return [*out, expected(0, set())]


def random_tree(rng, width, depth):
    nodes = []

    def grow(level, cover):
        i = len(nodes)
        nodes.append(None)
        if level == 0 or rng.random() < 0.15:
            nodes[i] = (i, -1, -1, -1, np.nan, cover, rng.random())
            return i
        f, t, part = int(rng.integers(width)), float(rng.normal()), rng.uniform(0.1, 0.9)
        left = grow(level - 1, cover * part)
        right = grow(level - 1, cover * (1 - part))
        nodes[i] = (i, left, right, f, t, cover, 0.0)
        return i

    grow(depth, 100.0)
    return pd.DataFrame(nodes, columns=["id", "left", "right", "feature", "threshold", "cover", "value"])


def test_contributions_match_brute_force():
    rng = np.random.default_rng(1)
    for width, depth in ((3, 2), (4, 5), (5, 6)):
        nodes = random_tree(rng, width, depth)
        x = rng.normal(size=(6, width))
        got = shapley.contributions(x, shapley.leaf_games(nodes, width))
        for row, values in zip(x, got):
            assert values == pytest.approx(brute_shapley(row, nodes, width), abs=1e-12)


def test_one_split_tree_by_hand():
    nodes = pd.DataFrame([(0, 1, 2, 1, 0.5, 10.0, 0.0), (1, -1, -1, -1, np.nan, 4.0, 0.2), (2, -1, -1, -1, np.nan, 6.0, 0.7)],
                         columns=["id", "left", "right", "feature", "threshold", "cover", "value"])
    got = shapley.contributions(np.array([[9.0, 0.5, 9.0], [9.0, 0.6, 9.0]]), shapley.leaf_games(nodes, 3))
    assert got == pytest.approx(np.array([[0, -0.3, 0, 0.5], [0, 0.2, 0, 0.5]]))


@pytest.fixture(scope="module")
def small_model(spark):
    rng = np.random.default_rng(7)
    days = pd.date_range("2024-01-01", periods=40)
    rows = []
    for c in range(12):
        for d in days:
            lag, roll = float(rng.poisson(0.8)), float(rng.poisson(4))
            y = int(rng.random() < 0.1 + 0.5 * (roll > 5))
            weather = [None if rng.random() < 0.05 else float(rng.normal()) for _ in range(4)]
            rows.append((f"r0_c{c}", d.date(), *weather, d.dayofweek, d.month, int(d.dayofweek > 4), 0, lag, 0.0, 1.0, roll, roll * 2, y))
    names = ["grid_id string", "date date", *[f"{f} double" for f in fixed.FEATURES[:4]], *[f"{f} int" for f in fixed.FEATURES[4:8]],
             *[f"{f} double" for f in fixed.FEATURES[8:]], f"{fixed.TARGET} int"]
    table = spark.createDataFrame(rows, ", ".join(names))
    fitted = forest.train_forest(table.filter("date <= '2024-02-01'"), trees=12, depth=6, min_leaf=5)
    return table.filter("date > '2024-02-01'"), fitted


def test_forest_scores_and_exact_additivity(spark, small_model):
    test, fitted = small_model
    scored = forest.forest_predict(test, fitted)
    assert scored.count() == test.count() and scored.columns == [*test.columns, "rf_prob", "rf_pred"]
    assert scored.filter("rf_prob < 0 OR rf_prob > 1").count() == 0
    # Null features stay null in the output although the model saw zeros.
    assert scored.filter("temperature IS NULL").count() == test.filter("temperature IS NULL").count() > 0
    limit = fitted.threshold.first().threshold
    assert scored.filter((F.col("rf_prob") >= limit).cast("int") != F.col("rf_pred")).count() == 0
    explained = shapley.explain_forest(forest.forest_scores(test, fitted), fitted).toPandas()
    assert len(explained) == test.count()
    total = explained[[f"{f}_shap" for f in fixed.MODEL_FEATURES]].sum(axis=1) + explained.base_value
    assert total.to_numpy() == pytest.approx(explained.rf_prob.to_numpy(), abs=1e-9)
    falls = shapley.shap_waterfall(shapley.contributions_long(shapley.explain_forest(forest.forest_scores(test, fitted).limit(3), fitted))).toPandas()
    last = falls.sort_values("step").groupby(["grid_id", "date"]).running.last().to_numpy()
    assert set(np.round(last, 9)) <= set(np.round(explained.rf_prob, 9))


def test_broadcast_and_grouped_contributions_agree(spark, small_model, monkeypatch):
    test, fitted = small_model
    rows = forest.forest_scores(test, fitted).limit(40)
    def shap():
        return shapley.tree_shap(rows, fitted.nodes, fitted.model.getNumTrees)

    whole = shap()
    # The rows are dealt out; nodes are in no exchange.
    assert "FlatMapCoGroups" not in whole._jdf.queryExecution().toString() and "MapInArrow" in whole._jdf.queryExecution().toString()
    monkeypatch.setattr(shapley, "PACKED_BYTES", 0)
    grouped = shap()
    assert "FlatMapCoGroups" in grouped._jdf.queryExecution().toString()
    a, b = (df.orderBy("grid_id", "date").toPandas() for df in (whole, grouped))
    names = [f"{f}_shap" for f in fixed.MODEL_FEATURES] + ["base_value"]
    assert len(a) == 40 and a[names].to_numpy() == pytest.approx(b[names].to_numpy(), abs=1e-12)


def test_parts_follow_the_rows():
    assert [forest.feature_parts(n) for n in (0, 1, 1_000_000, 10**9)] == [0, 1, 1, 895]
    assert shapley.unpacked(np.arange(14.0).tobytes(), 2)[3].tolist() == [[5.0, 6.0], [12.0, 13.0]]


def test_forest_is_better_than_chance_and_importance_sums_to_one(spark, small_model):
    test, fitted = small_model
    importance = forest.forest_importance(fitted).toPandas()
    assert importance.importance.sum() == pytest.approx(1.0)
    assert sampling.topk_importance(forest.forest_importance(fitted), 1).first().feature in ("rolling_sum_7", "rolling_sum_14")
    means = forest.forest_predict(test, fitted).groupBy(fixed.TARGET).agg(F.avg("rf_prob").alias("p")).toPandas().set_index(fixed.TARGET).p
    assert means[1] > means[0]


def test_density_matches_a_direct_sum(spark):
    rng = np.random.default_rng(4)
    side = 40
    cells = [(f"r{r}_c{c}", r, c, 33 + r * 0.009 + c * 0.0002, -84 + c * 0.011 - r * 0.0001) for r in range(side) for c in range(side)]
    weight = {cells[i][0]: int(w) for i, w in zip(rng.choice(len(cells), 300, replace=False), rng.integers(1, 50, 300))}
    weight[cells[0][0]] = 5000  # one cell holds a third of all incidents
    centroids = spark.createDataFrame(cells, "grid_id string, cell_row int, cell_col int, lat_center double, lon_center double")
    train = spark.createDataFrame(list(weight.items()), "grid_id string, incident_count bigint")
    got = {r.grid_id: r.score for r in hotspot.hotspot_kde(train, centroids).collect()}
    at = {c[0]: np.array(c[3:]) for c in cells}
    points, w = np.array([at[g] for g in weight]), np.array(list(weight.values()), float)
    n = w.sum()
    cov = np.cov(points.T, fweights=w.astype(int)) * n ** (-1 / 3)
    inv, norm = np.linalg.inv(cov), n * 2 * np.pi * np.sqrt(np.linalg.det(cov))
    dens = {g: float((w * np.exp(-0.5 * np.einsum("ij,jk,ik->i", points - p, inv, points - p))).sum() / norm) for g, p in at.items()}
    lo, hi = min(dens.values()), max(dens.values())
    assert len(got) == side * side
    for g in at:
        assert got[g] == pytest.approx((dens[g] - lo) / (hi - lo + 1e-12), abs=1e-10)


def test_density_prunes_by_distance(spark):
    """Fewer than half of the kernels of whole neighbouring tiles are evaluated, and a tolerance saves more for its own price."""
    rng = np.random.default_rng(6)
    cells = [(f"r{r}_c{c}", r, c, 33 + r * 0.01, -84 + c * 0.01) for r in range(0, 96) for c in range(0, 96)]
    targets = spark.createDataFrame(cells, "grid_id string, cell_row int, cell_col int, lat double, lon double").cache()
    some = [(*cells[i], int(w)) for i, w in zip(rng.choice(len(cells), 2500, replace=False), rng.integers(50_000, 90_000, 2500))]
    sources = spark.createDataFrame(some, "grid_id string, cell_row int, cell_col int, lat double, lon double, w bigint").cache()
    k = hotspot.bandwidth(sources).first()

    def white(rows):
        lat, lon = (np.array([r[j] for r in rows]) for j in (3, 4))
        return k.a * (lat - k.lat) + k.b * (lon - k.lon), k.c * (lon - k.lon)

    (tp, tq), (sp, sq) = white(cells), white(some)
    apart = (tp[:, None] - sp) ** 2 + (tq[:, None] - sq) ** 2
    tiles = [np.floor(x / k.reach) for x in (tp, tq, sp, sq)]
    whole = ((abs(tiles[0][:, None] - tiles[2]) <= 1) & (abs(tiles[1][:, None] - tiles[3]) <= 1)).sum()
    got = hotspot.kernel_parts(targets, sources).agg(F.sum("kernels")).first()[0]
    assert (apart <= k.reach**2).sum() <= got < whole / 2
    assert hotspot.kernel_parts(targets, sources, 1e-6).agg(F.sum("kernels")).first()[0] < got

    want = k.k * np.exp(apart * -0.5) @ np.array([r[5] for r in some], float)
    for tolerance in (hotspot.TOLERANCE, 1e-6):
        dens = {r.grid_id: r.density for r in hotspot.kernel_density(targets, sources, tolerance).collect()}
        assert len(dens) == len(cells)
        assert max(abs(dens[c[0]] - w) for c, w in zip(cells, want)) <= tolerance * k.k + 1e-13 * want.max()


def test_density_work_does_not_grow_with_pairs(spark):
    """Sources and targets meet by the nodes of their tiles only; targets beyond all tiles of sources are not packed."""
    rng = np.random.default_rng(9)
    schema = "grid_id string, cell_row int, cell_col int, lat double, lon double"
    near = [(f"r{r}_c{c}", r, c, 33 + r * 0.01, -84 + c * 0.01 + r * 0.001) for r in range(30) for c in range(30)]
    far = [(f"far{c}", 9000 + c, 0, 60.0 + c, 40.0) for c in range(20)]
    targets = spark.createDataFrame(near + far, schema)
    some = [(*near[i], int(w)) for i, w in zip(rng.choice(len(near), 700, replace=False), rng.integers(1, 900, 700))]
    sources = spark.createDataFrame(some, schema + ", w bigint")
    density = hotspot.kernel_density(targets, sources)
    plan = density._jdf.queryExecution().toString()
    assert "sources_box" not in plan and "moments" in plan
    k = hotspot.bandwidth(sources).first()
    got = {r.grid_id: r.density for r in density.collect()}
    at = np.array([r[3:5] for r in near + far]) - [k.lat, k.lon]
    p, q = k.a * at[:, 0] + k.b * at[:, 1], k.c * at[:, 1]
    place = {r[0]: i for i, r in enumerate(near + far)}
    from_ = [place[r[0]] for r in some]
    want = k.k * np.exp(((p[:, None] - p[from_]) ** 2 + (q[:, None] - q[from_]) ** 2) * -0.5) @ np.array([r[5] for r in some], float)
    assert len(got) == len(place) and all(got[f[0]] == 0 for f in far)
    assert max(abs(got[g] - want[i]) for g, i in place.items()) <= 1e-13 * want.max()
    assert {r.grid_id for r in hotspot.kernel_fields(targets, sources).collect()} <= {r[0] for r in near}


def test_expansions_hold_at_any_reach():
    for reach in (1.2, 9.0, 11.0, 37.0):
        n, side = hotspot.expansion_order(reach), reach / hotspot.TILES
        t, s = np.linspace(3 * side, 4 * side, 50), np.linspace(3 * side, 4 * side, 41)
        nodes = (hotspot._nodes(n) + 1) / 2 * side + 3 * side
        middle = np.exp((nodes[:, None] - nodes) ** 2 * -0.5)
        got = hotspot._basis(t, 3, reach, n) @ middle @ hotspot._basis(s, 3, reach, n).T
        assert abs(got - np.exp((t[:, None] - s) ** 2 * -0.5)).max() < 1e-12


def test_density_without_usable_incidents(spark):
    centroids = spark.createDataFrame([(f"r0_c{c}", 0, c, 33.0, -84.0 + c) for c in range(3)],
                                      "grid_id string, cell_row int, cell_col int, lat_center double, lon_center double")
    for counts in ({"r0_c0": 0}, {"r0_c0": 4}, {"r0_c0": 4, "r0_c1": 3}):  # none, one place, one line
        train = spark.createDataFrame([(g, n, 1) for g, n in counts.items()], f"grid_id string, incident_count bigint, {fixed.TARGET} int")
        scores = hotspot.hotspot_kde(train, centroids)
        assert scores.count() == 0
        assert hotspot.hotspot_threshold(train.withColumn(fixed.TARGET, F.lit(0)), scores).first().threshold == 0.5


def test_given_forest_equals_the_fitted_model(spark):
    """Path conditions from the node table of a small fitted forest give the model's own scores, nulls and unknown cells included."""
    rng = np.random.default_rng(5)
    rows = [(f"c{i % 9}", *[float(x) for x in rng.integers(0, 6, len(fixed.FEATURES))], int(rng.integers(0, 2))) for i in range(300)]
    cols = ", ".join(f"{f} double" for f in fixed.FEATURES)
    df = spark.createDataFrame(rows, f"grid_id string, {cols}, {fixed.TARGET} int")
    fitted = forest.train_forest(df, trees=4, depth=4, min_leaf=5)
    extra = [("new", *[None] * len(fixed.FEATURES), None), (None, *rows[0][1:])]
    asked = df.unionByName(spark.createDataFrame(extra, df.schema))
    key = ["grid_id", *fixed.FEATURES]
    want = sorted(map(repr, forest.forest_predict(asked, fitted, 0.5).select(*key, F.round("rf_prob", 9).alias("p"), "rf_pred").collect()))
    got = forest.given_forest_predict(asked, fitted.nodes, fitted.codes).select(*key, F.round("rf_prob", 9).alias("p"), "rf_pred")
    assert sorted(map(repr, got.collect())) == want
    with pytest.raises(ValueError):
        forest.path_conditions(fitted.nodes.filter("tree_id < 0"), fixed.MODEL_FEATURES)


def test_trees_are_fitted_in_groups_on_any_number_of_cores(spark):
    rng = np.random.default_rng(8)
    rows = [(f"c{i % 9}", *[float(x) for x in rng.integers(0, 6, len(fixed.FEATURES))], int(rng.integers(0, 2))) for i in range(300)]
    cols = ", ".join(f"{f} double" for f in fixed.FEATURES)
    df = spark.createDataFrame(rows, f"grid_id string, {cols}, {fixed.TARGET} int")
    fitted = forest.train_forest(df, trees=forest.TREES_PER_FIT + 3, depth=3, min_leaf=5)
    assert [g.getNumTrees for g in fitted.model.groups] == [forest.TREES_PER_FIT, 3] and fitted.model.getNumTrees == forest.TREES_PER_FIT + 3
    assert {r.tree_id for r in fitted.nodes.collect()} == set(range(forest.TREES_PER_FIT + 3))
    assert fitted.model.featureImportances.sum() == pytest.approx(1.0)
    # The mean over all trees, not over the groups.
    explained = shapley.explain_forest(forest.forest_scores(df.limit(5).withColumn("date", F.lit("2024-01-01").cast("date")), fitted), fitted).toPandas()
    total = explained[[f"{f}_shap" for f in fixed.MODEL_FEATURES]].sum(axis=1) + explained.base_value
    assert total.to_numpy() == pytest.approx(explained.rf_prob.to_numpy(), abs=1e-9)
    # Parts follow the rows, so rows in few parts are fitted in few tasks, on any cluster.
    assert fitted.model.transform(forest.feature_rows(df, fitted.codes)).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


def labelled(spark, n=300, seed=8, high=6):
    rng = np.random.default_rng(seed)
    rows = [(f"c{i % 9}", *[float(x) for x in rng.integers(0, high, len(fixed.FEATURES))], int(rng.integers(0, 2))) for i in range(n)]
    cols = ", ".join(f"{f} double" for f in fixed.FEATURES)
    return spark.createDataFrame(rows, f"grid_id string, {cols}, {fixed.TARGET} int")


def test_a_forest_depends_neither_on_the_order_of_rows_nor_on_their_parts(spark, monkeypatch):
    monkeypatch.setattr(forest, "PASS_ROWS", 0)
    df = labelled(spark)
    settings = {"trees": 6, "depth": 5, "min_leaf": 4}
    a = forest.train_forest(df, **settings)
    b = forest.train_forest(df.orderBy(F.rand(1)).repartition(5), tasks=3, **settings)
    key = lambda fitted: sorted(map(repr, fitted.nodes.collect()))
    assert key(a) == key(b) and a.threshold.first() == b.threshold.first()
    # Other seeds draw others, and so does every tree.
    assert key(a) != key(forest.train_forest(df, seed=1, **settings))
    assert len({t.tobytes() for t in a.model.trees}) == 6


@pytest.mark.parametrize("at_once", [1 << 17, 40])
def test_a_tree_takes_the_best_split_of_its_draw(monkeypatch, at_once):
    """Against the direct search: no split of a node lowers the variance more, every leaf is large enough, covers and values add up."""
    monkeypatch.setattr(grown, "ROWS_AT_ONCE", at_once)
    rng = np.random.default_rng(1)
    width, n, depth, least, c0, c1 = 5, 400, 6, 7, 0.8, 1.5
    x = rng.integers(0, 9, (width, n)).astype(np.uint8)
    n0, n1 = rng.integers(0, 3, n), rng.integers(0, 2, n)
    cuts = [np.arange(8) + 0.5] * width
    tree = grown.grow(x, n0, n1, c0, c1, cuts, np.random.default_rng(5), depth, least, width)
    draw = np.random.default_rng(5)
    w0, w1 = draw.poisson(n0), draw.poisson(n1)

    def lowered(mask, f, t):
        parts = [mask, mask & (x[f] <= t), mask & (x[f] > t)]
        if min((w0 + w1)[p].sum() for p in parts[1:]) < least:
            return -1.0
        mass = [(c1 * w1[p].sum()) ** 2 / (c0 * w0[p].sum() + c1 * w1[p].sum()) for p in parts]
        return mass[1] + mass[2] - mass[0]

    open_nodes, seen = [(0, np.ones(n, bool), 0)], 0
    while open_nodes:
        i, mask, level = open_nodes.pop()
        node, seen = tree[i], seen + 1
        ones, total = c1 * w1[mask].sum(), c0 * w0[mask].sum() + c1 * w1[mask].sum()
        assert node["cover"] == pytest.approx(total) and node["value"] == pytest.approx(ones / total)
        most = max(lowered(mask, f, t) for f in range(width) for t in cuts[f])
        if node["left"] < 0:
            assert level == depth or most < 1e-12
            continue
        f, t = node["feature"], node["threshold"]
        assert lowered(mask, f, t) == pytest.approx(most) and most > 0
        open_nodes += [(node["left"], mask & (x[f] <= t), level + 1), (node["left"] + 1, mask & (x[f] > t), level + 1)]
    assert seen == len(tree) > 30
    values = grown.code_values(x.T, cuts)
    assert (grown.bin_codes(values, cuts, np.uint8) == x.T).all()
    by_hand = []
    for row in values:
        i = 0
        while tree["left"][i] >= 0:
            i = tree["left"][i] + int(row[tree["feature"][i]] > tree["threshold"][i])
        by_hand.append(tree["value"][i])
    assert grown.mean_scores(values, grown.walks([tree, tree])).tolist() == pytest.approx(by_hand)
    assert grown.split_decreases(tree, width).sum() == pytest.approx(1.0)


def test_equal_splits_do_not_favour_the_first_feature():
    x = np.tile(np.repeat(np.arange(4), 25), (4, 1)).astype(np.uint8)  # four features that part rows alike
    n0, n1 = np.repeat([3, 0], 50), np.repeat([0, 3], 50)
    trees = [grown.grow(x, n0, n1, 1.0, 1.0, [np.arange(3) + 0.5] * 4, np.random.default_rng(i), 1, 1, 2) for i in range(60)]
    assert min(np.bincount([t["feature"][0] for t in trees], minlength=4)) >= 5


def test_cut_points_come_from_all_rows(spark):
    rng = np.random.default_rng(2)
    n = 3000
    skewed, few = np.sort(np.round(rng.exponential(size=n), 4)), rng.integers(0, 5, n) * 2.0
    ones = (np.arange(n) < 300).astype(int)  # the lowest tenth, which weighs as much as the rest
    features = [[0.0] * len(fixed.MODEL_FEATURES) for _ in range(n)]
    for row, a, b in zip(features, skewed, few):
        row[0], row[1] = float(a), float(b)
    df = spark.createDataFrame([(f, int(y)) for f, y in zip(features, ones)], "features array<double>, y int")
    cuts, n0, n1 = forest.split_points(df, "y", 16)
    assert (n0, n1) == (2700, 300) and cuts[1].tolist() == [1.0, 3.0, 5.0, 7.0] and len(cuts[2]) == 0
    assert 14 <= len(cuts[0]) <= 15 and (np.diff(cuts[0]) > 0).all()
    weight = np.where(ones == 1, 1 / 600, 1 / 5400)
    shares = np.bincount(np.searchsorted(cuts[0], skewed), weight)
    assert abs(shares - 1 / 16).max() < 0.01
    for bad in (df.limit(0), df.withColumn("y", F.lit(None).cast("int")), df.withColumn("y", F.lit(2))):
        with pytest.raises(ValueError):
            forest.split_points(bad, "y", 16)


def test_threshold_of_folded_rows_is_that_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(forest, "PASS_ROWS", 0)
    df = labelled(spark, high=2)
    df = df.unionByName(df.limit(100))
    fitted = forest.train_forest(df, trees=5, depth=6, min_leaf=2)
    rows = fitted.model.transform(forest.feature_rows(df, fitted.codes))
    assert fitted.threshold.first().threshold == hotspot.best_f1_threshold(rows, "rf_prob").first().threshold
    assert fitted.threshold.first().f1 == pytest.approx(hotspot.best_f1_threshold(rows, "rf_prob").first().f1)


@pytest.mark.parametrize("folded", [True, False])
def test_many_rows_are_folded_as_long_as_a_task_holds_them(spark, monkeypatch, folded):
    monkeypatch.setattr(forest, "PASS_ROWS", 0)
    monkeypatch.setattr(forest, "FOLDED_BYTES", forest.FOLDED_BYTES if folded else 0)
    df = labelled(spark)
    together = forest.TREES_PER_TASK if folded else forest.TREES_PER_FIT
    trees = together + 3
    fitted = forest.train_forest(df, trees=trees, depth=3, min_leaf=5)
    assert [g.getNumTrees for g in fitted.model.groups] == [together, 3]
    nodes = fitted.nodes.toPandas()
    assert set(nodes.tree_id) == set(range(trees)) and (nodes.right[nodes.left >= 0] == nodes.left[nodes.left >= 0] + 1).all()
    assert fitted.model.featureImportances.sum() == pytest.approx(1.0)
    explained = shapley.explain_forest(forest.forest_scores(df.limit(5).withColumn("date", F.lit("2024-01-01").cast("date")), fitted), fitted).toPandas()
    total = explained[[f"{f}_shap" for f in fixed.MODEL_FEATURES]].sum(axis=1) + explained.base_value
    assert total.to_numpy() == pytest.approx(explained.rf_prob.to_numpy(), abs=1e-9)


def test_contributions_work_on_pieces_of_leaves_and_rows(monkeypatch):
    """Large trees and many rows pass through arrays of a bounded size, and the pieces do not show."""
    rng = np.random.default_rng(12)
    inner = 2**12 - 1
    rows = [(i, 2 * i + 1, 2 * i + 2, int(rng.integers(4)), rng.normal(), 0.0) for i in range(inner)]
    rows += [(i, -1, -1, -1, np.nan, rng.random()) for i in range(inner, 2 * inner + 1)]
    nodes = pd.DataFrame(rows, columns=["id", "left", "right", "feature", "threshold", "value"]).sample(frac=1, random_state=1)
    cover = {i: 1.0 + i % 3 for i in range(inner, 2 * inner + 1)}
    for i in reversed(range(inner)):
        cover[i] = cover[2 * i + 1] + cover[2 * i + 2]
    games = shapley.leaf_games(nodes.assign(cover=nodes.id.map(cover)), 4)
    assert len(games[0]) == inner + 1 and (games[3] <= 1).all() and games[3].prod(axis=1).sum() < inner
    x = rng.normal(size=(60, 4))
    tracemalloc.start()
    got = shapley.contributions(x, games)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6e6
    monkeypatch.setattr(shapley, "CHUNK", 1 << 30)
    monkeypatch.setattr(shapley, "ROWS_PER_CHUNK", 1 << 30)
    assert got == pytest.approx(shapley.contributions(x, games), abs=1e-12)
    monkeypatch.setattr(shapley, "CHUNK", 1)
    monkeypatch.setattr(shapley, "ROWS_PER_CHUNK", 7)
    assert got[:3] == pytest.approx(shapley.contributions(x[:3], games), abs=1e-12)
