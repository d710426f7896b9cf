"""Exact deduplication with streaming state.

The digests of all texts run as a stream through an aggregation whose keyed state lives on
disk (RocksDB state store, checkpointed to the shared folder) and never expires. The state
holds, for a digest, the identifier and the place (file, row) of the row that stays, and the
number of rows seen. Every hit is then confirmed on full bytes: the row's text is compared
with the text at the kept row's place.

Two texts are equal when they are identical after lower-casing A-Z only; null counts as
empty. Of equal texts the row with the largest id stays (null ids come last; rows equal in
id are told apart by their place, so one row stays of exactly repeated rows). Empty texts
are equal to each other. Extra columns are ignored by ``exact_dedup`` and carried
unchanged by ``drop_exact_copies``. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, ascii_lower, fresh, locate, split_by_hits

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Copies confirmed against one replica of the kept text; larger groups get more replicas.
COPIES_PER_REPLICA = 256


def _state_session(spark: SparkSession, memory_mb: int) -> SparkSession:
    """A session of its own, so that the caller's settings stay as they are."""
    session = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(key, spark.conf.get(key))
    rocks = "spark.sql.streaming.stateStore.rocksdb"
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set(f"{rocks}.changelogCheckpointing.enabled", "true")
    session.conf.set(f"{rocks}.boundedMemoryUsage", "true")
    session.conf.set(f"{rocks}.allowFAllocate", "false")  # no megabytes reserved per partition
    session.conf.set(f"{rocks}.maxMemoryUsageMB", str(memory_mb))
    return session


def stream_groups(
    digests: str,
    spark: SparkSession,
    scratch: Scratch,
    bytes_per_batch: int = 64 << 30,
    memory_mb: int = 256,
) -> DataFrame:
    """Run the digest files as a stream into the keyed state; one row per digest of it:
    ``digest``, ``keeper`` (id, place) and ``n`` (rows seen). A rerun with the same
    checkpoint folder goes on where the stream stopped."""
    session = _state_session(spark, memory_mb)
    state = scratch.path("state")
    seen = (
        session.readStream.schema(session.read.parquet(digests).schema)
        .option("maxBytesPerTrigger", str(bytes_per_batch))
        .parquet(digests)
    )
    query = (
        seen.groupBy("digest")
        .agg(F.max("member").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    stored = session.read.format("statestore").load(state)
    kinds = {f.name: f.dataType.simpleString() for f in stored.schema["value"].dataType.fields}
    n = next(k for k, t in kinds.items() if t == "bigint")
    keeper = next(k for k, t in kinds.items() if t.startswith("struct"))
    out = stored.select(
        F.col("key.digest").alias("digest"),
        F.col("value")[keeper].alias("keeper"),
        F.col("value")[n].alias("n"),
    )
    scratch.write(out, "groups")
    return spark.read.schema(out.schema).parquet(f"{scratch.root}/groups")


def _decide(docs: DataFrame, id_col: str, text_col: str, scratch: Scratch) -> DataFrame:
    """One row per row of ``docs`` (which has a column ``place``)."""
    spark = docs.sparkSession
    normal = ascii_lower(F.col(text_col))
    rows = docs.select(
        F.struct(F.col(id_col).alias("id"), F.col("place")).alias("member"),
        F.sha2(normal, 256).alias("digest"),
    )
    digests = scratch.write(rows, "digests")
    if digests.isEmpty():
        return digests.select(
            "member", "digest", F.col("member").alias("keeper"), F.lit(0).cast("long").alias("n")
        )
    groups = stream_groups(f"{scratch.root}/digests", spark, scratch)
    decided = scratch.write(digests.join(groups, "digest", "left"), "decided")
    # Only rows of groups are read again with their texts, once; the others aren't shuffled.
    rows_of_groups = decided.where("n > 1").select(
        F.col("member.place").alias("place"), F.col("keeper.place").alias("kept_place"), "n"
    )
    hits = scratch.write(rows_of_groups, "hits")
    likely, _ = split_by_hits(docs.select("place", normal.alias("content")), hits, "place", scratch, "hit_bits")
    texts = scratch.write(likely.join(hits.hint("merge"), "place"), "texts")

    # A kept text is replicated once per COPIES_PER_REPLICA copies and a copy is dealt to
    # one replica by its place, so a text that many rows share is spread over many tasks.
    replicas = F.ceil(F.col("n") / F.lit(COPIES_PER_REPLICA))
    copies = texts.where(F.col("place") != F.col("kept_place")).select(
        "place", "kept_place", "content", F.pmod(F.xxhash64("place"), replicas).alias("replica")
    )
    kept = texts.where(F.col("place") == F.col("kept_place")).select(
        "kept_place",
        F.col("content").alias("kept_content"),
        F.explode(F.sequence(F.lit(0).cast("long"), replicas - 1)).alias("replica"),
    )
    wrong = scratch.write(
        copies.join(kept, ["kept_place", "replica"])
        .where(F.col("content") != F.col("kept_content"))
        .select("place", "content"),
        "wrong",
    )
    if wrong.isEmpty():
        return decided
    # Digest hits whose bytes differ form groups of their own, by their full text.
    own = wrong.join(decided.select("member", "digest", F.col("member.place").alias("place")), "place")
    regrouped = own.groupBy("digest", "content").agg(
        F.max("member").alias("keeper"), F.count(F.lit(1)).alias("n")
    )
    strays = own.groupBy("digest").agg(F.count(F.lit(1)).alias("strays"))
    rest = (
        decided.join(own.select("member"), "member", "left_anti")
        .join(strays, "digest", "left")
        .withColumn("n", F.col("n") - F.coalesce("strays", F.lit(0)))
        .drop("strays")
    )
    return rest.unionByName(own.join(regrouped, ["digest", "content"]).select(rest.columns))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id`` (the id that stays),
    ``group_size``, ``kept`` and ``text_sha256`` (of the normalised text in UTF-8)."""
    with Scratch(docs.sparkSession) as scratch:
        place = locate(docs.select(id_col, text_col), scratch, "place")
        out = _decide(place, id_col, text_col, scratch).select(
            F.col("member.id").alias(id_col),
            F.col("keeper.id").alias("keep_id"),
            F.col("n").cast("long").alias("group_size"),
            (F.col("member.place") == F.col("keeper.place")).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )
        return scratch.write(out, "result", keep=True)


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    with Scratch(docs.sparkSession) as scratch:
        name = fresh(docs, "place")
        rows = locate(docs, scratch, name)
        decided = _decide(
            rows.select(id_col, text_col, F.col(name).alias("place")), id_col, text_col, scratch
        )
        dropped = scratch.write(
            decided.where(F.col("member.place") != F.col("keeper.place")).select(
                F.col("member.place").alias(name)
            ),
            "dropped",
            keep=True,
        )
        likely, clean = split_by_hits(rows, dropped, name, scratch, "dropped_bits", keep=True)
        kept = likely.join(dropped.hint("merge"), name, "left_anti")
        return clean.select(docs.columns).unionByName(kept.select(docs.columns))
