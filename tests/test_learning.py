"""Neighbours, baselines, learners, saved models and scoring."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from linkrisk import schemas
from linkrisk.operators import bayes, metrics, models, neighbours, prep, splits
from linkrisk.plans import training
from linkrisk.session import cut_lineage
from linkrisk.sources import registry


def pages(spark, n=240):
    """Feature rows whose label follows the features, with some nulls."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(n):
        bad = int(i % 3 == 0)
        age = None if i % 11 == 0 else int(rng.integers(0, 300) if bad else rng.integers(200, 4000))
        rows.append(
            (i, bad, age, float(rng.integers(20, 80) if bad else 100), int(not bad), 999999 if bad else int(rng.integers(1, 9000)),
             int(rng.random() < 0.8), int(rng.integers(0, 90)), int(rng.integers(20, 90)), int(rng.integers(0, 4)))
        )
    columns = "page_id BIGINT, label INT, " + ", ".join(
        f"{c} {'DOUBLE' if c == 'secure_percentage' else 'BIGINT'}" for c in schemas.FEATURES
    )
    return spark.createDataFrame(rows, columns)


@pytest.fixture(scope="module")
def split(spark):
    rows = splits.stratified_split(pages(spark), "label", "page_id")
    return cut_lineage(splits.stratified_kfold(rows, "label", "page_id", 3))


def train_of(split):
    return split.where(F.col("split") == "train")


def brute_force(train, queries, k):
    found = {}
    for qid, q in queries:
        away = sorted((round(sum((a - b) ** 2 for a, b in zip(q, v)), 9), i) for i, _, v in train)
        found[qid] = away[:k]
    return found


@pytest.mark.parametrize("leaves, group_rows", [(None, 1000), (8, 1000), (8, 7), (500, 3)])
def test_neighbours_equal_brute_force(spark, leaves, group_rows):
    rng = np.random.default_rng(3)
    train = [(i, int(i % 2), [float(x) for x in rng.integers(0, 6, 2)]) for i in range(120)]
    train += [(i, 1, [2.0, 2.0]) for i in range(120, 180)]  # a third of the rows are copies
    queries = [(i, [float(x) for x in rng.normal(3, 4, 2)]) for i in range(50)] + [(99, [2.0, 2.0])]
    known = spark.createDataFrame(train, "id BIGINT, label INT, vector ARRAY<DOUBLE>")
    asked = spark.createDataFrame(queries, "query_id BIGINT, vector ARRAY<DOUBLE>")
    got: dict = {}
    for r in neighbours.nearest(known, asked, 5, leaves, group_rows, group_rows).orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append((r.distance2, r.id))
    assert got == brute_force(train, queries, 5)


def test_the_pivot_tree_leaves_out_most_pairs(spark):
    rng = np.random.default_rng(5)
    centres = rng.uniform(0, 100, (60, 3))
    points = centres[rng.integers(0, 60, 6_000)] + rng.normal(0, 0.5, (6_000, 3))
    train = [(i, i % 2, v) for i, v in enumerate(points.tolist())]
    asked = [(i, v) for i, v in enumerate((points[::20] + rng.normal(0, 0.1, (300, 3))).tolist())] + [(900, [500.0] * 3)]
    known = spark.createDataFrame(train, "id BIGINT, label INT, vector ARRAY<DOUBLE>")
    queries = spark.createDataFrame(asked, "query_id BIGINT, vector ARRAY<DOUBLE>")
    tree, celled = neighbours.plant(known, 120)
    assert len(tree.tops) == 10 and np.count_nonzero(tree.rows) > 80 and tree.rows.sum() == 6_000
    found = neighbours.nearest(known, queries, 5, 120)
    got: dict = {}
    for r in found.orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append((r.distance2, r.id))
    assert got == brute_force(train, asked, 5)
    kth = found.where("place = 5").selectExpr("query_id", "distance2 as kth")
    visits = neighbours.home_visits(tree, queries).union(neighbours.other_visits(tree, queries.join(kth, "query_id"), 5))
    pairs = sum(int(tree.rows[r.cell]) for r in visits.collect())
    assert pairs < 0.1 * len(train) * len(asked)


def test_vectors_go_to_a_sector_once_where_nothing_can_be_left_out(spark):
    rng = np.random.default_rng(11)
    points = rng.normal(0, 1, (3_000, 40))
    points[2_500:] = points[:500]  # copies
    points[2_400:2_500] = points[2_400]
    train = [(i, i % 2, v) for i, v in enumerate(points.tolist())]
    asked = [(i, v) for i, v in enumerate(points[::10].tolist())]
    known = spark.createDataFrame(train, "id BIGINT, label INT, vector ARRAY<DOUBLE>")
    queries = spark.createDataFrame(asked, "query_id BIGINT, vector ARRAY<DOUBLE>")
    tree, _ = neighbours.plant(known, 60)
    sector = neighbours._sectors(tree, 700)
    held = np.bincount(sector, weights=tree.rows)
    assert held.max() <= 700 and held.sum() == 3_000 and len(held) <= 9
    bound = queries.withColumn("kth", F.lit(60.0))
    visits = neighbours.other_visits(tree, bound, 5).count()
    met = neighbours._meetings(neighbours._elsewhere(tree, 5), sector, bound)
    assert met.count() <= len(held) * len(asked) < visits / 5
    assert met.agg(F.sum(F.size("cells"))).first()[0] == visits
    calls, per_sector = neighbours._load(neighbours._elsewhere(tree, 5), sector, bound)
    assert (calls.sum(), per_sector.sum()) == (visits, met.count())
    got: dict = {}
    for r in neighbours.nearest(known, queries, 5, 60, 700, 100).orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append((r.distance2, r.id))
    assert got == brute_force(train, asked, 5)


def test_neighbours_far_from_the_origin(spark):
    """The matrix product loses digits there; the margin keeps every row that could count."""
    rng = np.random.default_rng(13)
    points = 1e5 + np.round(rng.normal(0, 0.01, (1_500, 6)), 3)
    train = [(i, i % 2, v) for i, v in enumerate(points.tolist())]
    asked = [(i, v) for i, v in enumerate(points[::5].tolist())]
    known = spark.createDataFrame(train, "id BIGINT, label INT, vector ARRAY<DOUBLE>")
    queries = spark.createDataFrame(asked, "query_id BIGINT, vector ARRAY<DOUBLE>")
    got: dict = {}
    for r in neighbours.nearest(known, queries, 5, 20).orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append((r.distance2, r.id))
    assert got == brute_force(train, asked, 5)


@pytest.mark.parametrize("scale, centre", [(1.0, 0.0), (1e-7, 0.0), (1e-3, 1e6), (1e20, 0.0)])
def test_single_precision_loses_no_neighbour(scale, centre):
    rng = np.random.default_rng(17)
    heaps = rng.normal(0, 1, (20, 8))[rng.integers(0, 20, 600)] + rng.normal(0, 1e-5, (600, 8))  # much closer than single precision tells
    known, asked = (v * scale + centre for v in (heaps, heaps[::4] + rng.normal(0, 1e-5, (150, 8))))
    away = np.round(((asked[:, None] - known[None]) ** 2).sum(axis=2), 9)
    wanted = np.sort(away, axis=1)[:, :5]
    for bound in (np.full(len(asked), np.nan), wanted[:, 4] * (1 + 1e-12)):
        best = neighbours._Best(asked, bound, 5)
        for part in np.array_split(np.arange(len(known)), 3):
            best.meet(np.arange(len(asked)), known, part)
        assert np.allclose(best.away, wanted, rtol=1e-12, atol=2e-9)
        assert (np.sort(best.row, axis=1) >= 0).all() and all(len(set(row)) == 5 for row in best.row.tolist())


def test_rows_that_pass_the_product_wait_for_the_leaf(monkeypatch):
    rng = np.random.default_rng(19)
    known, asked = rng.normal(0, 1, (1_000, 16)), rng.normal(0, 1, (5_000, 16))
    square = (asked**2).sum(axis=1)[:, None] + (known**2).sum(axis=1)[None] - 2 * asked @ known.T
    best = neighbours._Best(asked, np.round(np.sort(square, axis=1)[:, 4], 9), 5)
    taken, take = [], neighbours._Best._take
    monkeypatch.setattr(neighbours._Best, "_take", lambda self, query, row, base: taken.append(len(query)) or take(self, query, row, base))
    best.meet(np.arange(len(asked)), known, np.arange(len(known)))
    assert len(taken) == 1 and taken[0] < 6 * len(asked)  # not once for each product, and hardly a row too many
    assert (np.sort(best.row, axis=1) == np.sort(np.argsort(square, axis=1)[:, :5], axis=1)).mean() > 0.999


def test_groups_are_dealt_over_more_tasks_than_the_session_has_partitions(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "_LEAST_PAIRS", 1_000)
    rng = np.random.default_rng(23)
    points = rng.normal(0, 1, (1_200, 12))
    train = [(i, i % 2, v) for i, v in enumerate(points.tolist())]
    asked = [(i, v) for i, v in enumerate(points[::10].tolist())]
    known = spark.createDataFrame(train, "id BIGINT, label INT, vector ARRAY<DOUBLE>")
    queries = spark.createDataFrame(asked, "query_id BIGINT, vector ARRAY<DOUBLE>").withColumn("kth", F.lit(None).cast("double"))
    tree, celled = neighbours.plant(known, 30)
    found = neighbours._compare(tree, celled, queries, neighbours._elsewhere(tree, 5), 5, 200, 200)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 4
    assert found.select(F.spark_partition_id().alias("task")).distinct().count() > 12
    got: dict = {}
    for r in neighbours.nearest(known, queries.drop("kth"), 5, 30, 200, 200).orderBy("query_id", "place").collect():
        got.setdefault(r.query_id, []).append((r.distance2, r.id))
    assert got == brute_force(train, asked, 5)


def test_fewer_training_rows_than_k(spark):
    known = spark.createDataFrame([(1, 0, [0.0]), (2, 1, [1.0])], "id BIGINT, label INT, vector ARRAY<DOUBLE>")
    asked = spark.createDataFrame([(7, [0.2])], "query_id BIGINT, vector ARRAY<DOUBLE>")
    row = neighbours.knn_classify(known, asked, 5).first()
    assert (row.prediction, row.score) == (0, 0.5)
    near = neighbours.knn_classify(known, asked, 5, "distance").first()
    assert near.prediction == 0 and abs(near.score - 0.8) < 1e-9
    hit = neighbours.knn_classify(known, asked.withColumn("vector", F.array(F.lit(1.0))), 5, "distance").first()
    assert (hit.prediction, hit.score) == (1, 1.0)


def test_training_rows_of_the_perceptron_are_spread_by_their_number(spark):
    """Few bytes a row: adaptive execution would leave all of them in one task, for hundreds of passes."""
    copies = spark.range(0, 80, 1, 1).withColumnRenamed("id", "copy")
    rows = cut_lineage(pages(spark).coalesce(1).crossJoin(copies).withColumn("page_id", F.col("page_id") + 240 * F.col("copy")).coalesce(1))
    assert rows.rdd.getNumPartitions() == 1
    prepared = models.spread_rows(models.NETWORK, models.prepare_training(rows)[1])
    sizes = [r["count"] for r in prepared.groupBy(F.spark_partition_id()).count().collect()]
    cores = spark.sparkContext.defaultParallelism
    assert sum(sizes) == 240 * 80 and len(sizes) == min(cores, 240 * 80 // models.LEAST_TASK_ROWS) > 1
    assert max(sizes) <= min(sizes) + 8
    assert prepared.select("page_id").distinct().count() == 240 * 80
    assert models.spread_rows(models.NETWORK, rows.where("copy = 0")).rdd.getNumPartitions() == 1
    assert models.spread_rows(models.FOREST, rows).rdd.getNumPartitions() == 1


def test_bayes_equals_spark(spark, split):
    features = schemas.CONTINUOUS
    rows = prep.median_impute(split, features)
    fitted = bayes.gaussian_nb_fit(rows, "label", features)
    mine = {r.page_id: r.score for r in bayes.gaussian_nb_score(fitted, rows, "label", features).collect()}
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    stages = [VectorAssembler(inputCols=features, outputCol="v"), NaiveBayes(modelType="gaussian", featuresCol="v")]
    theirs = Pipeline(stages=stages).fit(rows).transform(rows)
    for r in theirs.select("page_id", vector_to_array("probability")[1].alias("p")).collect():
        assert abs(mine[r.page_id] - r.p) < 1e-6


def test_baselines(spark):
    rows = spark.range(4000).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    top = bayes.majority_baseline(rows, rows, "label").select("prediction", "score").distinct().collect()
    assert [tuple(r) for r in top] == [(0, 0.0)]
    drawn = bayes.stratified_baseline(rows, rows, "label", "id").agg(F.avg("prediction")).first()[0]
    assert abs(drawn - 0.25) < 0.03


def test_weights(spark):
    rows = spark.createDataFrame([(0,)] * 3 + [(1,)], "label INT")
    weights = {r.label: r.weight for r in prep.balanced_weights(rows, "label").collect()}
    assert weights == {0: 4 / 6, 1: 2.0}
    assert prep.add_weights(rows, "label").agg(F.sum("weight")).first()[0] == pytest.approx(4.0)


def test_logistic_regression_solves_the_penalised_problem(spark, split):
    """At the optimum the gradient of C * weighted loss + |w|^2 / 2 vanishes."""
    stages, prepared, totals = models.prepare_training(train_of(split))
    fitted = Pipeline(stages=models.learner(models.LOGISTIC, {"C": 0.5}, **totals)).fit(prepared).stages[-1]
    scaled = prepared.select(*[f"{c}_scaled" for c in schemas.FEATURES], "label", "weight").toPandas().to_numpy(float)
    x, y, weight = scaled[:, :8], scaled[:, 8], scaled[:, 9]
    w = fitted.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + fitted.intercept)))
    gradient = 0.5 * x.T @ (weight * (p - y)) + w
    assert np.abs(gradient).max() < 1e-3


def test_all_models_beat_the_majority(spark, split):
    light = {
        models.FOREST: {"numTrees": 10, "maxDepth": 4},
        models.BOOSTING: {"maxIter": 5, "maxDepth": 3},
        models.NETWORK: {"hidden": (8,), "maxIter": 60},
        models.SVM_LINEAR: {"maxIter": 10},
        models.SVM_RBF: {"maxIter": 10},
    }
    train, rows = train_of(split), split.where(F.col("split") != "test")
    fitted = models.train_all(train, overrides=light)
    scored = models.score_models(fitted, rows, "page_id", "label", "split")
    simple = training.score_simple(train, rows, "page_id", "label", "split")
    table = {r.model: r for r in metrics.compare_models(cut_lineage(scored.unionByName(simple))).collect()}
    assert len(table) == 10
    floor = table[training.MAJORITY].val_accuracy
    for name, row in table.items():
        if not name.startswith("Baseline"):
            assert row.val_accuracy > floor and row.roc_auc > 0.9, name
    importance = models.feature_importance(fitted, spark)
    kinds = {(r.model, r.kind) for r in importance.collect()}
    assert kinds == {
        (models.LOGISTIC, "Coefficient-based"),
        (models.FOREST, "Tree-based"),
        (models.BOOSTING, "Tree-based"),
        (models.SVM_LINEAR, "Coefficient-based"),
    }


def test_search_returns_a_ranked_table(spark, split):
    train = train_of(split)
    model, results = models.grid_search(models.FOREST, train, 3, {"numTrees": [3], "maxDepth": [2, 4]})
    assert results.count() == 2 and results.where("mean_test_score > 0.8").count() == 2
    assert models.apply_model(model, train, "page_id").count() == train.count()
    plain, none = models.grid_search(models.BAYES, train)
    assert none.count() == 0 and len(plain.stages) == 3
    with pytest.raises(ValueError):
        models.grid_search("no such model", train)


def test_grids_have_the_documented_sizes():
    sizes = {name: len(models.settings(grid)) for name, grid in models.GRIDS.items()}
    assert sizes[models.BOOSTING] == 27 and sizes[models.SVM_RBF] == 12 and sizes[models.SVM_LINEAR] == 3
    drawn = models.draw_settings(models.WIDE_GRIDS[models.FOREST], 50)
    assert len({str(d) for d in drawn}) == 50 and drawn == models.draw_settings(models.WIDE_GRIDS[models.FOREST], 50)


def test_scoring_uses_training_statistics(spark, split, root):
    model = models.fit_model(models.LOGISTIC, train_of(split))
    row = metrics.evaluate(models.apply_model(model, split, "label", "split").withColumn("model", F.lit("lr")))
    row = row.where("split = 'val'").drop("model", "split")
    first = registry.save_model(model, row, root, "m", schemas.FEATURES, "Best parameters: none")
    second = registry.save_model(model, row, root, "m", schemas.FEATURES, "other words")
    assert (first, second) == (1, 2)
    loaded, known = registry.load_model(spark, root, "m")
    assert known.first().version == 2 and known.first().description is None
    assert registry.load_model(spark, root, "m", 1)[1].first().description == "Best parameters: none"
    with pytest.raises(ValueError):
        registry.load_model(spark, root, "unknown")
    one = pages(spark, 12).where("page_id = 11")  # its age is null
    assert one.first().domain_age_days is None
    assert models.batch_score(loaded, one).collect() == models.batch_score(model, one).collect()
    scored = models.batch_score(loaded, pages(spark), "page_id").collect()
    for r in scored:
        assert abs(r.phishing_probability + r.legitimate_probability - 1) < 1e-12
        assert r.confidence == (r.phishing_probability if r.is_phishing else r.legitimate_probability)
        assert r.prediction == ("PHISHING" if r.is_phishing else "LEGITIMATE")


def test_unreadable_scans_become_errors(spark, split):
    model = models.fit_model(models.LOGISTIC, train_of(split))
    good = json.dumps({"task": {"url": "http://a.b.c/", "uuid": "u"}, "page": {"domain": "a.b.c"}})
    docs = spark.createDataFrame([(good,), ("broken",), ("{}",), (None,), ('{"page": null}',)], "document STRING")
    rows = models.score_scans(model, docs).collect()
    states = sorted((r.scan_uuid, r.prediction == "ERROR", r.confidence == 0.0, r.error is not None) for r in rows)
    assert states == [("N/A", False, False, False)] + [("N/A", True, True, True)] * 3 + [("u", False, False, False)]


def test_training_runs(spark, root):
    rows = cut_lineage(pages(spark))
    light = {models.FOREST: {"numTrees": 5, "maxDepth": 3}}
    grids = {models.LOGISTIC: {"C": [1.0]}, models.FOREST: {"numTrees": [5], "maxDepth": [2, 3]}}
    run = training.select_model(rows, "page_id", [models.LOGISTIC, models.FOREST], light, grids, folds=2, top=2)
    assert run.name in grids and run.metrics.first().accuracy > 0.8
    assert run.comparison.count() == 5 and run.comparison.where("cv_mean IS NULL").count() == 0
    final = training.train_final(rows, "page_id", models.FOREST, 2, 2, {"numTrees": [3, 5], "maxDepth": [2, 3]}, root)
    summary = final.summary.first()
    assert summary.n_features == 8 and summary.n_train + summary.n_test == 160 and summary.test_accuracy > 0.8
    assert registry.load_model(spark, root, "url_risk_model")[1].first().version == 1
