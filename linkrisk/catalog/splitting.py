"""Splits, folds, imputation and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkrisk import schemas
from linkrisk.catalog import base
from linkrisk.catalog.base import LABELLED_LINES, query, table
from linkrisk.operators import features, prep, splits
from linkrisk.sources.scans import read_scan_documents

TOTALS = "totals AS (SELECT label, count(*) AS n FROM ll GROUP BY label)"


def _share_out(source: str, rows: str, part: str, name: str) -> str:
    """SQL for a largest-remainder quota per class."""
    return f"""{name} AS (
  SELECT * EXCLUDE (exact, part), CAST(floor(exact) + CASE WHEN
      row_number() OVER (ORDER BY exact - floor(exact) DESC, label) <= part - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS {name}_n
  FROM (SELECT *, {part} AS part, ({part}) * {rows} / sum({rows}) OVER () AS exact FROM {source}))"""


PLACED = """SELECT line_id, ll.label,
  CASE WHEN rn <= t THEN 'test' WHEN rn <= v THEN 'val' WHEN rn <= m THEN 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY digest) AS rn FROM ll) ll JOIN cuts ON cuts.label = ll.label
WHERE rn <= m"""

STRATIFIED = f"""{TOTALS},
{_share_out("totals", "n", "ceil(0.15::DOUBLE * sum(n) OVER ())", "test")},
{_share_out("test", "(n - test_n)", "ceil((0.15::DOUBLE / (1.0::DOUBLE - 0.15::DOUBLE)) * sum(n - test_n) OVER ())", "val")},
cuts AS (SELECT label, test_n AS t, test_n + val_n AS v, n AS m FROM val)"""
BALANCED_TEST = f"""{TOTALS},
test AS (SELECT *, CAST(least(min(n) OVER (), floor(floor(sum(n) OVER () * 0.15::DOUBLE) / 2)) AS BIGINT) AS test_n FROM totals),
{_share_out("test", "(n - test_n)", "ceil(0.15::DOUBLE * sum(n - test_n) OVER ())", "val")},
cuts AS (SELECT label, test_n AS t, test_n + val_n AS v, n AS m FROM val)"""
FULLY_BALANCED = f"""{TOTALS},
cuts AS (SELECT label, floor(min(n) OVER () * 0.15::DOUBLE) AS t,
  floor(min(n) OVER () * 0.15::DOUBLE) + floor(min(n) OVER () * 0.15::DOUBLE) AS v, min(n) OVER () AS m FROM totals)"""


@query("stratified_split", f"WITH {LABELLED_LINES}, {STRATIFIED} {PLACED}")
def stratified_split(spark, sf):
    return splits.split_data(base.labelled_lines(spark, sf), "label", "line_id")


@query("balanced_test_split", f"WITH {LABELLED_LINES}, {BALANCED_TEST} {PLACED}")
def balanced_test_split(spark, sf):
    return splits.split_data(base.labelled_lines(spark, sf), "label", "line_id", balanced_test=True)


@query("fully_balanced_split", f"WITH {LABELLED_LINES}, {FULLY_BALANCED} {PLACED}")
def fully_balanced_split(spark, sf):
    return splits.split_data(base.labelled_lines(spark, sf), "label", "line_id", balanced_train_val=True)


@query("train_plus_val", f"""WITH {LABELLED_LINES}, {FULLY_BALANCED}
SELECT split, label, count(*) AS n FROM ({PLACED}) WHERE split IN ('train', 'val') GROUP BY ALL""")
def train_plus_val(spark, sf):
    split = splits.fully_balanced_split(base.labelled_lines(spark, sf), "label", "line_id")
    return splits.train_plus_val(split).groupBy("split", "label").agg(F.count("*").alias("n"))


@query("split_class_distribution", f"""WITH {LABELLED_LINES}, {STRATIFIED}
SELECT split, label, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share
FROM ({PLACED}) GROUP BY split, label""")
def split_class_distribution(spark, sf):
    split = splits.stratified_split(base.labelled_lines(spark, sf), "label", "line_id")
    return base.rounded(splits.class_distribution(split, "split", "label"), "share")


@query("stratified_kfold", f"""WITH {LABELLED_LINES}
SELECT line_id, label,
  CAST((row_number() OVER (PARTITION BY label ORDER BY digest) - 1) % 5 AS INTEGER) AS fold FROM ll""")
def stratified_kfold(spark, sf):
    return splits.stratified_kfold(base.labelled_lines(spark, sf), "label", "line_id")


# --- feature rows of the scanned pages -------------------------------------------------------

ROWS = f"""{base.SCANS}, {base.FEATURE_ROWS}, rows AS (
  SELECT page_id, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in schemas.FEATURES)}, label, digest
  FROM feats JOIN (SELECT page_id, CAST({base.IS_HTTP} <> (page_id % 10 = 0) AS INTEGER) AS label,
    md5('42:' || page_id) AS digest FROM pages) USING (page_id))"""
MEDIANS = f"medians AS (SELECT {', '.join(f'median({c}) AS {c}' for c in schemas.FEATURES)} FROM rows)"
FILLED = f"""filled AS (
  SELECT r.page_id, r.label, r.digest, {", ".join(f"coalesce(r.{c}, m.{c}) AS {c}" for c in schemas.FEATURES)}
  FROM rows r, medians m)"""


def feature_rows(spark, sf):
    """(page_id, label, features as doubles) of all pages."""
    docs = read_scan_documents(base.scan_documents(spark, sf))
    labelled = base.labelled_pages(spark, sf).select("page_id", F.col("is_phishing").alias("label"))
    rows = features.select_features(features.scan_features(docs, "page_id"), None, "page_id")
    return rows.join(labelled, "page_id")


@query("missing_cells", f"""WITH {ROWS} SELECT {", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in schemas.FEATURES)},
  {" + ".join(f"count(*) FILTER ({c} IS NULL)" for c in schemas.FEATURES)} AS total FROM rows""")
def missing_cells(spark, sf):
    return prep.missing_cells(feature_rows(spark, sf), schemas.FEATURES)


@query("column_medians", f"WITH {ROWS}, {MEDIANS} SELECT * FROM medians")
def column_medians(spark, sf):
    return prep.column_medians(feature_rows(spark, sf), schemas.FEATURES)


@query("column_medians_lines", """SELECT median(l_quantity) AS l_quantity, median(l_extendedprice) AS l_extendedprice,
  median(l_discount) AS l_discount FROM lineitem""")
def column_medians_lines(spark, sf):
    return prep.column_medians(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query("median_impute", f"WITH {ROWS}, {MEDIANS}, {FILLED} SELECT page_id, {base.FEATURE_LIST} FROM filled")
def median_impute(spark, sf):
    rows = feature_rows(spark, sf)
    return prep.median_impute(rows, schemas.FEATURES).select("page_id", *schemas.FEATURES)


@query("scaler_fit", """SELECT 'l_quantity' AS feature, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS std FROM lineitem
UNION ALL SELECT 'l_extendedprice', round(avg(l_extendedprice), 6), round(stddev_pop(l_extendedprice), 6) FROM lineitem
UNION ALL SELECT 'l_tax', round(avg(l_tax), 6), round(stddev_pop(l_tax), 6) FROM lineitem""")
def scaler_fit(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_tax"]
    fitted = prep.scaler_fit(table(spark, sf, "lineitem"), columns).unpivot([], columns, "feature", "s")
    return base.rounded(fitted.select("feature", "s.mean", "s.std"), "mean", "std")


_Z = "round((r.{c} - s.{c}_m) / coalesce(nullif(s.{c}_s, 0), 1), 6) AS {c}"


def _zscore_sql(rows: str, fit: str, columns: list[str], keep: str) -> str:
    stats = ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in columns)
    return f"SELECT {keep}, {', '.join(_Z.format(c=c) for c in columns)} FROM {rows} r, (SELECT {stats} FROM {fit}) s"


@query("zscore", _zscore_sql("lineitem", "lineitem", ["l_quantity", "l_extendedprice"], "r.l_orderkey, r.l_linenumber"))
def zscore(spark, sf):
    columns = ["l_quantity", "l_extendedprice"]
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *columns)
    return base.rounded(prep.zscore(lines, prep.scaler_fit(lines, columns), columns), *columns)


_PAGE_PLACED = PLACED.replace("line_id, ll.label", "ll.*")
_PREPARED = f"""ll AS (SELECT * FROM filled), {STRATIFIED}, placed AS ({_PAGE_PLACED})"""


@query("prepare_data", f"""WITH {ROWS}, {MEDIANS}, {FILLED}, {_PREPARED}
{_zscore_sql("placed", "placed WHERE split = 'train'", schemas.CONTINUOUS,
             "r.page_id, r.label, r.split, r.has_umbrella_rank, r.has_tls")}""")
def prepare_data(spark, sf):
    filled = prep.median_impute(feature_rows(spark, sf), schemas.FEATURES)
    split = splits.stratified_split(filled, "label", "page_id")
    return base.rounded(prep.scale_splits(split), *schemas.CONTINUOUS)


@query("balanced_weights", f"""WITH {LABELLED_LINES}, {TOTALS}
SELECT label, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM totals""")
def balanced_weights(spark, sf):
    return base.rounded(prep.balanced_weights(base.labelled_lines(spark, sf), "label"), "weight")
