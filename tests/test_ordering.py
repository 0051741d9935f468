"""Exact draws, ranks and running totals, also where buckets must be refined or values repeat."""

from __future__ import annotations

import hashlib
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from linkrisk.functions import ordering
from linkrisk.operators import metrics, prep, sampling, splits


def seeded(keys, seed=42):
    return sorted(keys, key=lambda k: hashlib.md5(f"{seed}:{'' if k is None else k}".encode()).hexdigest())


def classes(spark, ones, zeros):
    rows = [(i, int(i < ones)) for i in range(ones + zeros)]
    return spark.createDataFrame(rows, "id INT, label INT")


@pytest.mark.parametrize("edge", [1, 3, 1_000_000])
def test_sample_is_the_start_of_the_seeded_order(spark, monkeypatch, edge):
    monkeypatch.setattr(ordering, "EDGE_ROWS", edge)
    monkeypatch.setattr(ordering, "BUCKET_DIGITS", 1)
    rows = spark.range(300).withColumnRenamed("id", "k")
    for n in (0, 1, 17, 299, 300, 1000):
        got = {r.k for r in sampling.sample_exact(rows, n, "k").collect()}
        assert got == set(seeded(range(300))[:n])


def test_null_key_has_a_place(spark):
    rows = spark.createDataFrame([("b",), (None,), ("a",)], "k STRING")
    ranked = sampling.shuffle(rows, "k").orderBy("rn").collect()
    assert [r.k for r in ranked] == seeded(["b", None, "a"])


def test_ranks_are_dense_per_class(spark):
    ranked = sampling.class_quota_rank(classes(spark, 40, 60), "label", "id").collect()
    for cls, ids in ((1, range(40)), (0, range(40, 100))):
        by_rank = sorted((r.rn, r.id) for r in ranked if r.label == cls)
        assert [i for _, i in by_rank] == seeded(ids)
        assert [rn for rn, _ in by_rank] == list(range(1, len(ids) + 1))


def test_shared_key_fails_instead_of_drawing_too_much(spark):
    rows = spark.createDataFrame([(1,)] * 5 + [(2,)], "k INT")
    with pytest.raises(Exception, match="must identify a row"):
        sampling.sample_exact(rows, 3, "k").collect()
    with pytest.raises(Exception, match="must identify a row"):
        sampling.shuffle(rows, "k").collect()


def test_balanced_sample_sizes(spark):
    rows = classes(spark, 30, 50).withColumn("url", F.concat(F.lit("u"), F.col("id").cast("string")))
    seen = rows.where("id < 10").select("url")
    for size, expected in ((None, 20), (7, 7), (100, 20)):
        got = sampling.balanced_sample(rows, "label", "id", seen, size).collect()
        assert sum(r.label for r in got) == expected and len(got) == 2 * expected
        assert not {r.id for r in got} & set(range(10))


def test_balanced_sample_with_an_empty_class_is_empty(spark):
    rows = classes(spark, 0, 20)
    assert sampling.balanced_sample(rows, "label", "id").count() == 0
    assert sampling.balanced_sample(rows.limit(0), "label", "id").count() == 0


def sizes(split):
    return {(r.split, r.label): r["count"] for r in split.groupBy("split", "label").count().collect()}


def test_fully_balanced_split(spark):
    got = splits.split_data(classes(spark, 60, 100), "label", "id", balanced_train_val=True, balanced_test=True)
    assert sizes(got) == {(s, c): n for s, n in (("train", 42), ("val", 9), ("test", 9)) for c in (0, 1)}
    assert got.count() == got.select("id").distinct().count() == 120


def test_balanced_test_split(spark):
    got = splits.split_data(classes(spark, 60, 100), "label", "id", balanced_test=True)
    by = sizes(got)
    assert by["test", 0] == by["test", 1] == 12
    assert by["val", 0] + by["val", 1] == 21 and got.count() == 160


def test_stratified_split_uses_all_rows(spark):
    got = splits.split_data(classes(spark, 60, 100), "label", "id")
    by = sizes(got)
    assert by["test", 0] + by["test", 1] == 24 and by["test", 0] == 15
    assert by["val", 0] + by["val", 1] == 24 and got.count() == 160


@pytest.mark.parametrize("part", [0, 1, 7, 10])
def test_share_out_is_exact(part):
    quota = splits.share_out({0: 5, 1: 5}, part)
    assert sum(quota.values()) == part and abs(quota[0] - quota[1]) <= 1 and quota[0] >= quota[1]


def test_folds_keep_class_shares(spark):
    got = splits.stratified_kfold(classes(spark, 23, 41), "label", "id", 5)
    counts = {(r.label, r.fold): r["count"] for r in got.groupBy("label", "fold").count().collect()}
    for cls, n in ((1, 23), (0, 41)):
        per_fold = [counts[cls, f] for f in range(5)]
        assert sum(per_fold) == n and max(per_fold) - min(per_fold) <= 1


def test_batches(spark):
    got = sampling.assign_batches(spark.range(45), "id", 10).groupBy("batch").count().collect()
    assert {r.batch: r["count"] for r in got} == {0: 10, 1: 10, 2: 10, 3: 10, 4: 5}
    assert sampling.assign_batches(spark.range(45), "id", 10, 2).count() == 20


def test_numbers_follow_the_order(spark):
    rows = spark.range(1000).select((1000 - F.col("id")).alias("k"))
    got = ordering.number_rows(rows, ["k"], "no", 1).collect()
    assert all(r.no == r.k for r in got) and len(got) == 1000


@pytest.fixture
def small_bins(monkeypatch):
    """Makes running totals use bins of about five values."""
    monkeypatch.setattr(ordering, "BIN_ROWS", 5)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3), st.floats(-1e9, 1e9)), min_size=1, max_size=60))
def test_medians_equal_the_definition(spark, small_bins, values):
    rows = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v DOUBLE")
    known = [float(v) for v in values if v is not None]
    got = prep.column_medians(rows, ["v"]).first()[0]
    assert got == (statistics.median(known) if known else None)


@pytest.mark.parametrize("bin_rows", [10, 1_000_000])
def test_even_median_and_hot_value(spark, monkeypatch, bin_rows):
    monkeypatch.setattr(ordering, "BIN_ROWS", bin_rows)
    rows = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "v DOUBLE")
    assert prep.column_medians(rows, ["v"]).first()[0] == 2.5
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("v"))
    values = [7.0 if i % 3 == 0 else float(i) for i in range(3000)]
    assert prep.column_medians(hot, ["v"]).first()[0] == statistics.median(values)


def test_medians_of_many_columns_count_only_around_the_middle(spark):
    r = random.Random(5)
    rows = [
        (r.gauss(0, 1), r.choice([1.0, 1.0, 2.0, None]), r.choice([float("nan"), float("inf"), 3.0]), float(i), None)
        for i in range(40_000)
    ]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    got = prep.column_medians(frame, frame.columns).first()
    known = [[x for x in column if x is not None] for column in zip(*rows)]
    assert [got.a, got.b, got.d] == [statistics.median(known[i]) for i in (0, 1, 3)]
    middle = sorted(known[2], key=lambda x: (x != x, 0 if x != x else x))[20_000]
    assert got.c == middle == float("inf") and got.e is None
    counted = prep._bracketed(frame, prep._brackets(frame, frame.columns, prep.MEDIAN_SLACK))
    assert counted.where("column in ('a', 'd')").count() < 400


def test_a_bracket_that_misses_the_median_is_widened(spark, monkeypatch):
    right, slacks = prep._brackets, []

    def sometimes_wrong(values, columns, slack):
        slacks.append(slack)
        wrong = {c: (n, 90.0, 95.0) for c, (n, _, _) in right(values, columns, slack).items()}
        return wrong if len(slacks) == 1 else right(values, columns, slack)

    monkeypatch.setattr(prep, "_brackets", sometimes_wrong)
    rows = spark.range(100).selectExpr("cast(id as double) as v", "cast(id + 1000 as double) as w")
    assert tuple(prep.column_medians(rows, ["v", "w"]).first()) == (49.5, 1049.5)
    assert len(slacks) == 2 and slacks[1] > slacks[0]
    assert tuple(prep.column_medians(rows.limit(0), ["v", "w"]).first()) == (None, None)


@pytest.mark.parametrize("bin_rows", [2, 1_000_000])
def test_auc_with_ties_equals_pair_counting(spark, monkeypatch, bin_rows):
    monkeypatch.setattr(ordering, "BIN_ROWS", bin_rows)
    rng = random.Random(1)
    rows = [(rng.randint(0, 1), round(rng.random(), 1)) for _ in range(300)]
    pairs = [(p, n) for lp, p in rows if lp == 1 for ln, n in rows if ln == 0]
    expected = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    scored = spark.createDataFrame([("m", "val", lab, s) for lab, s in rows], "model STRING, split STRING, label INT, score DOUBLE")
    assert abs(metrics.roc_auc(scored).first().roc_auc - expected) < 1e-12


def test_auc_of_one_class_is_null(spark):
    scored = spark.createDataFrame([("m", "val", 1, 0.5)], "model STRING, split STRING, label INT, score DOUBLE")
    assert metrics.roc_auc(scored).first().roc_auc is None


def test_scaler_of_a_constant_column(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a DOUBLE, b DOUBLE")
    got = prep.zscore(rows, prep.scaler_fit(rows, ["a", "b"]), ["a", "b"]).orderBy("a").collect()
    assert [tuple(r) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]


def test_metrics_without_positives(spark):
    scored = spark.createDataFrame([("m", "val", 0, 0)], "model STRING, split STRING, label INT, prediction INT")
    row = metrics.binary_metrics(scored).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)
