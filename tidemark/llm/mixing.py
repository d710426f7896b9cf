"""Mixing sources to target weights with hash-threshold histograms.

Every row has a size (its number of words) and a 60-bit hash of its id. A source whose
target is ``q`` whole passes and a rest takes every row ``q`` times, and once more the rows
whose hash is below the source's threshold. The threshold is found without sorting the
rows: sizes are summed by source and hash bucket, the bucket where the running sum crosses
the rest is refined into smaller buckets, and only its rows are read again, until the
bucket is one single hash. Thresholds are nested: a larger rest takes a superset.

Sources are ranked by code point, null last, and weigh ``weights`` in turn. Together they
get all sizes; no target is above ``max_repeat`` times its source's size, and what a capped
source leaves is shared again by weight among the others. The crossing hash is taken when
that brings the source nearer to its rest. Rows with the same id share a hash and are taken
together. A null or empty text has size 0; a source of size 0 has target 0. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import Scratch, fresh, words

HASH_BITS = 60
LEVEL_BITS = 10


def row_hash(id_col: str) -> Column:
    """60 bits of the md5 of the id's text (a null id counts as an empty text)."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeat: int) -> DataFrame:
    """Target of each source from ``sizes`` (columns source, source_size): one row a source.

    Sources reach their cap in the order of cap over weight, so the level at which the
    uncapped ones share the rest follows from running sums in that order. The windows run
    over one row per source.
    """
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1))
    ranked = sizes.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    ).withColumn("weight", turn.cast("long"))
    cap = F.col("source_size") * max_repeat
    by_ratio = Window.orderBy(cap / F.col("weight"), "rank")
    every = Window.partitionBy()
    # The level at which all sources from here on would share what the earlier caps leave.
    left = F.sum("source_size").over(every) - (F.sum(cap).over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) - cap)
    weight = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = (
        ranked.withColumn("left", left)
        .withColumn("left_weight", weight)
        .withColumn("fits", F.col("left") * F.col("weight") <= cap * F.col("left_weight"))
    )
    first = F.min(F.when(F.col("fits"), F.struct(cap / F.col("weight"), "rank", "left", "left_weight")))
    return level.withColumn("at", first.over(every)).select(
        "source",
        "source_size",
        F.least(
            cap.cast("double"),
            F.col("at.left").cast("double") / F.col("at.left_weight") * F.col("weight"),
        ).alias("target"),
    )


def mixing_plan(
    docs: DataFrame,
    scratch: Scratch,
    weights: Sequence[int] = (1, 2, 3),
    max_repeat: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The rows (id, source, hash, size) and the plan: per source its size, target,
    whole passes ``full`` and the largest hash ``upto`` that is taken once more."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        row_hash(id_col).alias("hash"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
    )
    rows = scratch.write(rows, "sizes", keep=True)
    targets = source_targets(
        rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeat
    )
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    plan = targets.withColumn("full", F.coalesce(full, F.lit(0)).cast("long")).select(
        "*",
        (F.col("target") - F.col("full") * F.col("source_size")).alias("rest"),
        F.lit(0).cast("long").alias("prefix"),
    )
    plan = scratch.write(plan, "level_0")
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        plan = scratch.write(_refine(rows, plan, level), f"level_{level}", keep=level * LEVEL_BITS == HASH_BITS)
    return rows, plan.select("source", "source_size", "target", "full", F.col("prefix").alias("upto"))


def _refine(rows: DataFrame, plan: DataFrame, level: int) -> DataFrame:
    """Cut every source's boundary bucket into 2**LEVEL_BITS smaller ones, and keep the one
    in which the running sum of sizes crosses the rest (minus one: none is taken)."""
    shift = HASH_BITS - level * LEVEL_BITS
    inside = rows.join(
        plan.select(F.col("source").alias("s"), "prefix"),
        F.col("source").eqNullSafe(F.col("s"))
        & (F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix")),
    )
    buckets = inside.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(
        F.sum("size").alias("size")
    )
    order = Window.partitionBy("source").orderBy("bucket")
    below = F.sum("size").over(order) - F.col("size")
    last = level * LEVEL_BITS == HASH_BITS
    joined = plan.select(F.col("source").alias("s"), "rest").join(
        buckets.withColumn("below", below), F.col("source").eqNullSafe(F.col("s"))
    )
    # At the last level a bucket is one hash: taken when that leaves the smaller error.
    reach = F.col("below") + F.col("size") / 2 if last else F.col("below").cast("double")
    found = (
        joined.where(reach <= F.col("rest"))
        .groupBy("source")
        .agg(F.max(F.struct("bucket", "below")).alias("at"))
    )
    return (
        plan.join(found.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
        .select(
            "source",
            "source_size",
            "target",
            "full",
            (F.col("rest") - F.coalesce("at.below", F.lit(0))).alias("rest"),
            # No bucket is reached only at the last level: the hash before it is the last one taken.
            F.coalesce(
                "at.bucket", F.shiftleft("prefix", LEVEL_BITS) - (1 if last else 0)
            ).alias("prefix"),
        )
    )


def _with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    more = (F.col("hash") <= F.col("upto")).cast("long")
    return rows.join(
        plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
    ).withColumn("copies", F.col("full") + F.when(F.col("target") > F.col("full") * F.col("source_size"), more).otherwise(0))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target`` of its
    source, ``taken`` (words taken, repeats counted) and ``copies`` (times taken)."""
    with Scratch(docs.sparkSession) as scratch:
        rows, plan = mixing_plan(docs, scratch, **options)
        return _with_copies(rows, plan).select(
            F.col("id").alias(options.get("id_col", "doc_id")),
            "size",
            "source_size",
            "target",
            (F.col("copies") * F.col("size")).alias("taken"),
            "copies",
        )


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix with all their columns, each as often as it is taken."""
    id_col, source_col = options.get("id_col", "doc_id"), options.get("source_col", "source")
    with Scratch(docs.sparkSession) as scratch:
        _, plan = mixing_plan(docs, scratch, **options)
        names = [fresh(docs, n) for n in ("mix_hash", "mix_copy")]
        own = {c: fresh(docs, "mix_plan_" + c) for c in plan.columns}
        plan = plan.select(*[F.col(c).alias(n) for c, n in own.items()])
        more = (F.col(names[0]) <= F.col(own["upto"])) & (
            F.col(own["target"]) > F.col(own["full"]) * F.col(own["source_size"])
        )
        copies = (F.col(own["full"]) + more.cast("long")).cast("int")
        return (
            docs.withColumn(names[0], row_hash(id_col))
            .join(plan, F.col(source_col).eqNullSafe(F.col(own["source"])))
            .withColumn(names[1], F.explode(F.array_repeat(F.lit(1), copies)))
            .select(docs.columns)
        )
