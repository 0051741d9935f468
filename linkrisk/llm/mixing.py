"""Mixing sources to target weights by hash thresholds.

Every document has a fixed hash. For each source a histogram adds up the sizes by the
leading bits of the hash; the bucket in which the budget ends is split by its next bits,
until it holds one hash. What lies below that threshold is taken: one filter, no sort.
A larger budget has a higher threshold, so the mixes of growing budgets are nested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from linkrisk.llm.common import digest60, own_names, word_count
from linkrisk.session import write_scratch

HASH_BITS, STEP_BITS = 60, 12


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``source, source_size`` with the words each source should give.

    Sources in code point order, null last, take the weights in turn and share the sum of
    all sizes. A source gives ``most`` times its size at most; what that leaves is shared
    by weight among the others. With the sources ordered by bound / weight, those at
    their bound come first, and the first that is not fixes the share of one weight.
    Rows here are sources, not documents.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") - 1) % len(weights) + 1)
    by_bound = W.orderBy(F.col("bound") / F.col("weight"), "place")
    everything = W.partitionBy()
    earlier = F.coalesce(F.sum("bound").over(by_bound.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return (
        sizes.withColumn("place", place)
        .withColumns({"weight": weight.cast("long"), "bound": F.col("source_size") * most})
        .withColumns(
            {
                "rest": F.sum("source_size").over(everything) - earlier,
                "shares": F.sum("weight").over(by_bound.rowsBetween(0, W.unboundedFollowing)),
                "order": F.row_number().over(by_bound),
            }
        )
        .withColumn("free", F.col("bound") * F.col("shares") > F.col("weight") * F.col("rest"))
        .withColumn("first", F.min(F.when(F.col("free"), F.col("order"))).over(everything))
        .withColumn(
            "share",
            F.max(F.when(F.col("order") == F.col("first"), F.col("rest").cast("double") / F.col("shares"))).over(everything),
        )
        .select(
            "source",
            "source_size",
            F.when(F.col("free"), F.col("weight") * F.col("share")).otherwise(F.col("bound").cast("double")).alias("target"),
        )
    )


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def thresholds(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row per source: its size, target, whole passes and the hash below which one more copy is taken.

    ``sized`` has ``source, size, hash``. Each round reads the rows of the boundary
    buckets only; it ends when every such bucket holds a single hash.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    full = F.col("source_size") > 0
    state = write_scratch(
        targets(sizes, weights, most)
        .withColumn("whole", F.when(full, F.floor(F.col("target") / F.col("source_size"))).otherwise(1).cast("long"))
        .withColumns(
            {
                "left": F.col("target") - F.col("whole") * F.col("source_size"),
                "prefix": F.lit(0).cast("long"),
                "cut": F.when(full, F.lit(None)).otherwise(0).cast("long"),
            }
        ),
        "mix-targets",
    )
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        open_ = state.where(F.col("cut").isNull())
        inside = sized.alias("d").join(
            open_.select(F.col("source").alias("s"), "prefix"),
            _same(F.col("source"), F.col("s")) & (F.shiftright("hash", shift + STEP_BITS) == F.col("prefix")),
        )
        buckets = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("bucket_size"), F.min("hash").alias("least"), F.max("hash").alias("greatest")
        )
        running = W.partitionBy("source").orderBy("bucket")
        reached = buckets.withColumn("upto", F.sum("bucket_size").over(running)).join(
            open_.select(F.col("source").alias("s"), "left"), _same(F.col("source"), F.col("s"))
        )
        edge = (
            reached.where(F.col("upto") > F.col("left"))
            .groupBy("source")
            .agg(F.min_by(F.struct("bucket", "bucket_size", "upto", "least", "greatest"), "bucket").alias("e"))
            .select(F.col("source").alias("s"), "e.*")
        )
        left = F.col("left") - (F.col("upto") - F.col("bucket_size"))
        single = F.col("least") == F.col("greatest")
        nearer = F.when(2 * left >= F.col("bucket_size"), F.col("least") + 1).otherwise(F.col("least"))
        cut = (
            F.when(F.col("cut").isNotNull(), F.col("cut"))
            .when(F.col("bucket").isNull(), F.lit(1 << HASH_BITS))
            .when(single, nearer)
        )
        state = write_scratch(
            state.join(edge, _same(F.col("source"), F.col("s")), "left").select(
                "source", "source_size", "target", "whole", cut.alias("cut"),
                F.coalesce(left, F.col("left")).alias("left"),
                F.coalesce("bucket", "prefix").alias("prefix"),
            ),
            "mix-edge",
        )
        if state.where(F.col("cut").isNull()).isEmpty():
            break
    return state.select("source", "source_size", "target", "whole", "cut")


def copies(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", most: int = 3, weights=(1, 2, 3)) -> DataFrame:
    """Every document with how often the mix takes it: ``key, size, source_size, target, copies, taken``.

    Size counts words; a null text has size 0. Null sources are one source. The hash
    comes from key and text, so reruns agree and only fully equal rows stand or fall
    together. A document is taken ``most`` times at most. The budget of a source is met
    to within half of the one document, or group of fully equal rows, at its edge. A source without any
    words keeps each of its documents once. Other columns are not read; an empty table
    gives an empty result.
    """
    sized = write_scratch(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).cast("string").alias("source"),
            word_count(F.col(text)).alias("size"),
            digest60(F.col(key), F.col(text)).alias("hash"),
        ),
        "mix-sizes",
    )
    cuts = thresholds(sized, weights, most).withColumnRenamed("source", "s")
    times = F.least(F.col("whole") + (F.col("hash") < F.col("cut")).cast("long"), F.lit(most).cast("long"))
    return sized.join(cuts, _same(F.col("source"), F.col("s"))).select(
        F.col("key").alias(key), "size", "source_size", "target", times.alias("copies"), (times * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", most: int = 3, weights=(1, 2, 3)) -> DataFrame:
    """The mixed documents, all columns as they were, each row as often as the mix takes it."""
    hashed = digest60(F.col(key), F.col(text))
    sized = docs.select(F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), hashed.alias("hash"))
    cuts = thresholds(write_scratch(sized, "mix-sizes"), weights, most)
    of, whole, cut, number = own_names(docs, "of_source", "whole_passes", "cut_hash", "copy_number")
    cuts = cuts.select(F.col("source").alias(of), F.col("whole").alias(whole), F.col("cut").alias(cut))
    times = F.least(F.col(whole) + (hashed < F.col(cut)).cast("long"), F.lit(most).cast("long"))
    return (
        docs.join(cuts, _same(F.col(source).cast("string"), F.col(of)))
        .withColumn(number, F.explode(F.when(times > 0, F.sequence(F.lit(1).cast("long"), times))))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
