"""Baselines, learners, tuning, saved models and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linkrisk import schemas
from linkrisk.catalog import base, splitting
from linkrisk.catalog.base import LABELLED_LINES, query, table
from linkrisk.functions import outcomes
from linkrisk.operators import bayes, metrics, models, neighbours, splits
from linkrisk.plans import training
from linkrisk.session import cut_lineage, scratch_path
from linkrisk.sources import registry

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINES = """lines AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INTEGER) AS line_id,
  CAST(l_returnflag = 'R' AS INTEGER) AS label, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem)"""


@query("majority_baseline", f"""WITH {LABELLED_LINES}, top AS (SELECT label FROM ll GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
SELECT line_id, top.label AS prediction, CAST(top.label = 1 AS INTEGER)::DOUBLE AS score FROM ll, top""")
def majority_baseline(spark, sf):
    lines = base.labelled_lines(spark, sf)
    return bayes.majority_baseline(lines, lines, "label").select("line_id", "prediction", "score")


@query("stratified_baseline", f"""WITH {LABELLED_LINES}, prior AS (SELECT avg(label) AS p FROM ll)
SELECT line_id, CAST(('0x' || substr(md5(digest || ':draw'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < p AS INTEGER) AS prediction FROM ll, prior""")
def stratified_baseline(spark, sf):
    lines = base.labelled_lines(spark, sf)
    return bayes.stratified_baseline(lines, lines, "label", "line_id").select("line_id", "prediction")


NB_STATS = f"""{LINES}, spread AS (SELECT greatest({", ".join(f"var_pop({c})" for c in LINE_FEATURES)}, 0) AS s FROM lines),
nb AS ({" UNION ALL ".join(
    f"SELECT label, count(*) / (SELECT count(*) FROM lines) AS prior, '{c}' AS feature, avg({c}) AS mean, "
    f"var_pop({c}) + 1e-9 * (SELECT s FROM spread) AS variance FROM lines GROUP BY label"
    for c in LINE_FEATURES
)})"""


@query("gaussian_nb", f"""WITH {NB_STATS} SELECT label, feature, round(prior, 6) AS prior, round(mean, 6) AS mean, round(variance, 4) AS variance FROM nb""")
def gaussian_nb(spark, sf):
    lines = base.labelled_lines(spark, sf, *LINE_FEATURES)
    fitted = bayes.gaussian_nb_fit(lines, "label", LINE_FEATURES)
    return base.rounded(base.rounded(fitted, "prior", "mean"), "variance", digits=4)


@query("gaussian_nb_score", f"""WITH {NB_STATS}, joint AS (
  SELECT line_id, nb.label, ln(min(prior)) - sum((ln(2 * pi() * variance) + power(value - mean, 2) / variance) / 2) AS ll
  FROM (SELECT line_id, unnest([{", ".join(f"'{c}'" for c in LINE_FEATURES)}]) AS feature, unnest([{", ".join(LINE_FEATURES)}]) AS value FROM lines) v
  JOIN nb ON nb.feature = v.feature GROUP BY line_id, nb.label)
SELECT a.line_id, round(1 / (1 + exp(a.ll - b.ll)), 6) AS score FROM joint a JOIN joint b ON a.line_id = b.line_id AND a.label = 0 AND b.label = 1""")
def gaussian_nb_score(spark, sf):
    lines = base.labelled_lines(spark, sf, *LINE_FEATURES)
    fitted = bayes.gaussian_nb_fit(lines, "label", LINE_FEATURES)
    scored = bayes.gaussian_nb_score(fitted, lines, "label", LINE_FEATURES)
    return base.rounded(scored.select("line_id", "score"), "score")


NEAREST = """vectors AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
pairs AS (SELECT a.vec_id AS query_id, b.vec_id AS id, b.label,
  round(list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), 9) AS distance2 FROM vectors a, vectors b),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance2, id) AS place FROM pairs) WHERE place <= 5)"""


def _vectors(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("vector")
    )


@query("knn", f"""WITH {NEAREST}, votes AS (SELECT query_id, label, count(*) AS n FROM near GROUP BY ALL)
SELECT query_id, CAST(label AS INTEGER) AS prediction, round(n / 5, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY n DESC, label) AS place FROM votes) WHERE place = 1""")
def knn(spark, sf):
    vectors = _vectors(spark, sf)
    return base.rounded(neighbours.knn_classify(vectors, vectors.select(F.col("id").alias("query_id"), "vector")), "score")


@query("knn_neighbours", f"WITH {NEAREST} SELECT query_id, id, CAST(place AS INTEGER) AS place, round(distance2, 6) AS distance2 FROM near")
def knn_neighbours(spark, sf):
    vectors = _vectors(spark, sf)
    found = neighbours.nearest(vectors, vectors.select(F.col("id").alias("query_id"), "vector"))
    return base.rounded(found.select("query_id", "id", "place", "distance2"), "distance2")


PARTS = """parts AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, p_retailprice / 10 AS y, (p_size + p_retailprice) * 0.7 AS z FROM part),
pairs AS (SELECT a.p_partkey AS query_id, b.p_partkey AS id,
  round((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), 9) AS distance2 FROM parts a, parts b)"""


@query("knn_cells", f"""WITH {PARTS} SELECT query_id, id, CAST(place AS INTEGER) AS place, round(distance2, 6) AS distance2 FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance2, id) AS place FROM pairs) WHERE place <= 5""")
def knn_cells(spark, sf):
    """The five nearest parts of every part by size and price, over a tree of many leaves."""
    size, price = F.col("p_size").cast("double"), F.col("p_retailprice")
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.lit(0).alias("label"), F.array(size, price / 10, (size + price) * F.lit(0.7)).alias("vector")
    )
    leaves = max(1, parts.count() // 50)
    found = neighbours.nearest(parts, parts.select(F.col("id").alias("query_id"), "vector"), leaves=leaves)
    return base.rounded(found.select("query_id", "id", "place", "distance2"), "distance2")


# --- learners on the scanned pages -------------------------------------------------------------


def page_split(spark, sf, folds: int = 3) -> DataFrame:
    """Feature rows of all pages with a stratified split and folds, written once."""
    rows = splitting.feature_rows(spark, sf)
    split = splits.stratified_split(rows, "label", "page_id")
    return cut_lineage(splits.stratified_kfold(split, "label", "page_id", folds))


def _learner(query_name: str, name: str, params: dict | None = None):
    """Register one learner: fitted on train, with metrics of all splits."""

    def run(spark, sf):
        split = page_split(spark, sf)
        model = models.fit_model(name, split.where(F.col("split") == "train"), params)
        scored = models.apply_model(model, split, "page_id", "label", "split").withColumn("model", F.lit(name))
        return metrics.evaluate(scored)

    query(query_name)(run)


_learner("logistic_regression", models.LOGISTIC)
_learner("random_forest", models.FOREST)
_learner("gradient_boosting", models.BOOSTING)
_learner("mlp", models.NETWORK)
_learner("svm_linear", models.SVM_LINEAR)
_learner("svm_rbf", models.SVM_RBF)
_learner("naive_bayes", models.BAYES)

# Smaller ensembles where a query fits many models.
LIGHT = {
    models.FOREST: {"numTrees": 20, "maxDepth": 5},
    models.BOOSTING: {"maxIter": 10, "maxDepth": 3},
    models.NETWORK: {"hidden": (16,), "maxIter": 50},
    models.SVM_LINEAR: {"maxIter": 10},
    models.SVM_RBF: {"maxIter": 10},
}


@query("train_all")
def train_all(spark, sf):
    split = page_split(spark, sf)
    train, rows = split.where(F.col("split") == "train"), split.where(F.col("split") != "test")
    scored = models.score_models(models.train_all(train, overrides=LIGHT), rows, "page_id", "label", "split")
    simple = training.score_simple(train, rows, "page_id", "label", "split")
    return metrics.evaluate(cut_lineage(scored.unionByName(simple)))


@query("grid_search")
def grid_search(spark, sf):
    train = page_split(spark, sf).where(F.col("split") == "train")
    return models.grid_search(models.LOGISTIC, train, 3, {"C": [0.1, 1.0]})[1]


@query("random_search")
def random_search(spark, sf):
    train = page_split(spark, sf).where(F.col("split") == "train")
    grid = {"numTrees": [5, 10], "maxDepth": [3, 5], "minInstancesPerNode": [1, 2]}
    results = models.random_search(models.FOREST, train, 3, 3, grid)[1]
    return metrics.cv_rank(results, ["model"])


@query("feature_importance")
def feature_importance(spark, sf):
    train = page_split(spark, sf).where(F.col("split") == "train")
    fitted = models.train_all(train, [models.LOGISTIC, models.FOREST, models.SVM_LINEAR], LIGHT)
    return models.feature_importance(fitted, spark)


@query("refit_train_val")
def refit_train_val(spark, sf):
    split = page_split(spark, sf)
    final = models.refit_train_val(models.LOGISTIC, split)
    test = models.apply_model(final, split.where(F.col("split") == "test"), "page_id", "label", "split")
    return metrics.evaluate(test.withColumn("model", F.lit(models.LOGISTIC)))


def _saved(spark, sf, versions: int = 1) -> tuple[str, DataFrame]:
    split = page_split(spark, sf)
    train = split.where(F.col("split") == "train")
    root = scratch_path(spark, "models")
    for _ in range(versions):
        model = models.fit_model(models.LOGISTIC, train)
        scored = models.apply_model(model, split, "page_id", "label", "split").withColumn("model", F.lit("lr"))
        row = metrics.evaluate(scored).where(F.col("split") == "val").drop("model", "split")
        registry.save_model(model, row, root, "url_risk_model", schemas.FEATURES, "Best parameters: C = 1")
    return root, split


@query("save_model")
def save_model(spark, sf):
    root, _ = _saved(spark, sf, 2)
    _, known = registry.load_model(spark, root, "url_risk_model", 1)
    return known.select("version", "accuracy", "f1", "roc_auc", "description")


@query("load_model")
def load_model(spark, sf):
    root, split = _saved(spark, sf)
    model, known = registry.load_model(spark, root, "url_risk_model")
    return models.apply_model(model, split, "page_id")


@query("batch_score")
def batch_score(spark, sf):
    split = page_split(spark, sf)
    model = models.fit_model(models.LOGISTIC, split.where(F.col("split") == "train"))
    return models.batch_score(model, splitting.feature_rows(spark, sf), "page_id")


@query("score_scans")
def score_scans(spark, sf):
    split = page_split(spark, sf)
    model = models.fit_model(models.LOGISTIC, split.where(F.col("split") == "train"))
    docs = base.scan_documents(spark, sf)
    broken = F.when(F.col("page_id") % 7 == 0, "no document").otherwise(F.col("document"))
    return models.score_scans(model, docs.withColumn("document", broken))


@query("prediction_label", f"""WITH {base.SCORED} SELECT model, doc_id,
  CASE WHEN prediction = 1 THEN 'PHISHING' ELSE 'LEGITIMATE' END AS prediction FROM scored""")
def prediction_label(spark, sf):
    label = outcomes.prediction_label(F.col("prediction"))
    return base.scored_rows(spark, sf).select("model", "doc_id", label.alias("prediction"))


@query("prediction_confidence", f"""WITH {base.SCORED} SELECT model, doc_id,
  round(CASE WHEN prediction = 1 THEN score ELSE 1 - score END, 6) AS confidence FROM scored""")
def prediction_confidence(spark, sf):
    confidence = outcomes.prediction_confidence(F.col("prediction"), F.col("score"), 1 - F.col("score"))
    return base.rounded(base.scored_rows(spark, sf).select("model", "doc_id", confidence.alias("confidence")), "confidence")
