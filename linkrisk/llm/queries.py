"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from linkrisk.llm import archives, bucket_digest, directcodes, language, licenses, mixing, negatives, packing, repetition, runs, sharding, simhash, templates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/pages.parquet")


HASH60 = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"
WORDS = r"len(regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+'))"

MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST({WORDS.format('text')} AS BIGINT) AS size,
         {HASH60.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')")} AS h FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sizes),
weighed AS (SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS bound FROM placed),
shared AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY bound / weight, place
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY bound / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shares,
    row_number() OVER (ORDER BY bound / weight, place) AS pos FROM weighed),
freed AS (SELECT *, bound * shares > weight * rest AS free FROM shared),
unit AS (SELECT CAST(rest AS DOUBLE) / CAST(shares AS DOUBLE) AS share FROM freed WHERE free ORDER BY pos LIMIT 1),
goal AS (
  SELECT source, source_size, CASE WHEN free THEN weight * (SELECT share FROM unit) ELSE CAST(bound AS DOUBLE) END AS target FROM freed),
passes AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 1 END AS whole FROM goal),
hashes AS (SELECT source, h, CAST(sum(size) AS BIGINT) AS n FROM sized GROUP BY source, h),
running AS (SELECT *, CAST(sum(n) OVER (PARTITION BY source ORDER BY h) AS BIGINT) AS upto FROM hashes),
chosen AS (
  SELECT r.source, r.h,
    CASE WHEN p.source_size = 0 THEN 0
         WHEN upto <= target - whole * source_size THEN 1
         WHEN upto - n <= target - whole * source_size
              AND 2 * (target - whole * source_size - (upto - n)) >= n THEN 1 ELSE 0 END AS more
  FROM running r JOIN passes p ON r.source IS NOT DISTINCT FROM p.source)
SELECT d.doc_id, d.size, p.source_size, p.target, d.size * least(p.whole + c.more, 3) AS taken
FROM sized d JOIN passes p ON d.source IS NOT DISTINCT FROM p.source
JOIN chosen c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h"""


@query("op1_mixture", MIX_SQL)
def op1_mixture(spark, sf):
    """All documents with the words the mix takes of them."""
    return mixing.copies(documents(spark, sf)).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_rendezvous")
def op3_rendezvous(spark, sf):
    """All documents over 24 shards by their key."""
    rows = sharding.assign(documents(spark, sf), shards=24)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


@query("op2_bucket_digest")
def op2_bucket_digest(spark, sf):
    """Digests of all documents and of their edited texts."""
    return bucket_digest.edited_fingerprints(documents(spark, sf))


@query("op4_repetition")
def op4_repetition(spark, sf):
    """Repetition measures and verdict of all documents."""
    measured = repetition.repeats(documents(spark, sf))
    return measured.withColumns({"base_failed": repetition.base_failed(), "kept": repetition.keeps()})


@query("op8_simhash")
def op8_simhash(spark, sf):
    """SimHash fingerprints of all documents and the components they form."""
    return simhash.classes(documents(spark, sf))


@query("op7_language")
def op7_language(spark, sf):
    """The language of every document, learnt from those that are not held out."""
    return language.identify(documents(spark, sf)).select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op9_templates")
def op9_templates(spark, sf):
    """The main text of every page."""
    return templates.main_text(pages(spark, sf))


def _license_sql() -> str:
    known = ", ".join(f"'{text}': '{name}'" for name, text in licenses.SENTENCES.items())
    left = "';' || array_to_string(list_transform(ids, lambda i: i || ';'), ';')"
    steps, hits = [], []
    for number, (_, _, sequence) in enumerate(licenses.RULES):
        pattern = "".join(f";{i};" for i in sequence)
        steps.append(f"r{number} AS (SELECT *, contains(left{number}, '{pattern}') AS hit{number}, replace(left{number}, '{pattern}', ';#;') AS left{number + 1} FROM {f'r{number - 1}' if number else 'started'})")
        hits.append(f"CASE WHEN hit{number} THEN {{}} END")
    named = lambda k: "[" + ", ".join(h.format(f"'{r[k]}'") for h, r in zip(hits, licenses.RULES)) + "]"
    return rf"""
WITH cut AS (
  SELECT doc_id, list_filter(list_transform(
    string_split(regexp_replace(coalesce(text, ''), '([.!?])[\x20\x09-\x0D]+', '\1' || chr(10), 'g'), chr(10)),
    lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') AS sentences FROM documents),
known AS (SELECT doc_id, CAST(len(sentences) AS BIGINT) AS n_sentences,
  list_filter(list_transform(sentences, lambda s: MAP {{{known}}}[s]), lambda i: i IS NOT NULL) AS ids FROM cut),
started AS (SELECT *, {left} AS left0 FROM known),
{", ".join(steps)}
SELECT doc_id, n_sentences, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_filter({named(0)}, lambda x: x IS NOT NULL), ',') AS rules,
  array_to_string(list_sort(list_distinct(list_filter({named(1)}, lambda x: x IS NOT NULL))), ',') AS licenses
FROM r{len(licenses.RULES) - 1}"""


@query("op10_license", _license_sql())
def op10_license(spark, sf):
    """Licence sentences, rules and licences of every document, as comma-separated lists."""
    found = licenses.recognise(documents(spark, sf))
    return found.select("doc_id", "n_sentences", *[F.array_join(c, ",").alias(c) for c in ("sentence_ids", "rules", "licenses")])


@query("op5_packing")
def op5_packing(spark, sf):
    """All documents in sequences of 2048 tokens, a row for each piece."""
    return packing.pack(documents(spark, sf))


@query("op6_archives")
def op6_archives(spark, sf):
    """All pages through ARC and WARC files, and what the files say of them."""
    return archives.archive(pages(spark, sf))


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet")


NEGATIVES_SQL = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0),
near AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT n.anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM near n JOIN scored s ON n.anchor_id = s.anchor_id AND NOT s.same
  AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW best AS (PARTITION BY n.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER best <= 3"""


@query("op13_threshold", NEGATIVES_SQL)
def op13_threshold(spark, sf):
    """Hard negatives of every 50th vector against all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(embeddings(spark, sf), label=label)


def planted_run(words: list[bytes], h: int | None) -> list[bytes]:
    """A tenth of the documents, by the checksum ``h`` of their key, repeat a stretch of their words to their end."""
    if h is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


@query("op11_runs")
def op11_runs(spark, sf):
    """Periodic runs of the words of all documents; a row without a key is looked at as it is."""
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = runs.find(documents(spark, sf), rewrite=planted_run, by=key)
    best = found.withColumn("best", runs.best_run())
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


@query("op12_directcodes")
def op12_directcodes(spark, sf):
    """The ids of all documents, written in directly addressable codes and read back."""
    return directcodes.encode(documents(spark, sf))
