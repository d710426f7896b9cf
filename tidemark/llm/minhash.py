"""MinHash near-deduplication with sequential Bayesian verification.

A document's set are its distinct shingles of five words (words split at blanks, tabs and
line ends, A-Z lower-cased); with fewer words the whole sequence is one shingle. Documents
are linked when the Jaccard similarity of their sets is at least ``THRESHOLD``.

* Documents with equal sets form one class; the rest works on classes.
* A signature of 128 minimum hashes is cut into 32 bands of 4; classes that agree in a band
  share its bucket. A pair at the threshold misses all buckets with probability 5e-6.
* First every member of a bucket is paired with the bucket's smallest member only. A pair's
  signatures are compared batch by batch; after each batch the posterior of the similarity
  (uniform prior, so a beta distribution) tells whether it can still reach the threshold,
  and the pair is dropped when that is less likely than ``MISS``. Survivors are confirmed
  exactly on the full sets of both texts.
* Links found so far join classes to components. Buckets that still hold several components
  then compare all their members across components, in blocks of bounded size with their
  texts, so that no link is lost and none is looked for inside a component: a task skips
  pairs it has connected already and reports a forest of links, never all pairs. There is
  no cap on buckets or candidates.

Null and empty texts have an empty set and are linked with nothing. A component's id is the
smallest document id in it (null ids last; a component of null ids only has a null id).
Repeated rows have equal sets. Extra columns are ignored; an empty table gives an empty
result. Shingles are told apart by 64-bit hashes while candidates are searched (classes by
128 bits of these); links are confirmed on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, arrow_batches, fresh, locate, split_by_hits
from tidemark.llm.components import components

SHINGLE = 5
THRESHOLD = 0.75
HASHES, BANDS = 128, 32
ROWS = HASHES // BANDS
BATCH = 32  # hashes compared before the posterior is looked at again
MISS = 1e-6
BLOCK = 256  # members of a bucket compared in one task
SALTS = 64  # tasks that the pairs of one class are dealt to when they are confirmed
BATCH_ROWS = 1000  # rows handed to Python at once


def hash_family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    odd = rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def text_words(text: str) -> list[bytes]:
    """The words of a text. On bytes, lower() and split() know ASCII only, as asked for."""
    return text.encode().lower().split()


def shingle_set(text: str) -> set[tuple[bytes, ...]]:
    words = text_words(text)
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(SHINGLE)], strict=False))


def shingle_hashes(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text_words(text)
    n = len(words)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes())] if n else [], np.uint64)
    mixed = np.zeros(n - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        mixed = (mixed ^ h[i : n - SHINGLE + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(hashes: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    out = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(hashes), 4096):
        part = (hashes[i : i + 4096, None] * family[0] + family[1]) >> np.uint64(32)
        np.minimum(out, part.min(axis=0), out=out)
    return out.astype("<u4")


def least_matches() -> list[int]:
    """For every batch, the least number of equal hashes so far that keeps a pair: with
    fewer, similarity reaches THRESHOLD with a posterior probability below MISS. The tail of
    the beta posterior is a binomial sum."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < MISS:
            m += 1
            tail += comb(n + 1, m) * THRESHOLD**m * (1 - THRESHOLD) ** (n + 1 - m)
        out.append(m)
    return out


def still_possible(left: np.ndarray, right: np.ndarray, least: list[int]) -> np.ndarray:
    """Sequential test of pairs of signatures (rows of equal shape): the rows that survive."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), dtype=np.int64)
    for k, needed in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= needed]
    return alive


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u4").reshape(-1, HASHES)


def sketch(docs: DataFrame) -> DataFrame:
    """(place, id, text) -> (place, id, n_shingles, key, sig); key and sig are null for
    empty sets."""
    family = hash_family()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_hashes(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([signature(s, family).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["place", "id", "n_shingles", "key", "sig"],
            )

    rows = docs.select("place", "id", "text")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(
        run, f"place {kinds['place']}, id {kinds['id']}, n_shingles long, key binary, sig binary"
    )


def _survives(left: Column, right: Column) -> Column:
    least = least_matches()

    @F.pandas_udf("boolean")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        out = np.zeros(len(left), dtype=bool)
        if len(left):
            out[still_possible(_signatures(left), _signatures(right), least)] = True
        return pd.Series(out)

    return run(left, right)


def _similar(left: set, right: set) -> bool:
    if min(len(left), len(right)) < THRESHOLD * max(len(left), len(right)):
        return False
    both = len(left & right)
    return both >= THRESHOLD * (len(left) + len(right) - both)


def _linked(left: Column, right: Column) -> Column:
    """Exact test of two texts on their full sets."""

    @F.pandas_udf("boolean")
    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        out = []
        last, last_set = None, set()
        for a, b in zip(left, right, strict=True):
            if a != last:  # pairs come sorted by their left side
                last, last_set = a, shingle_set(a)
            out.append(_similar(last_set, shingle_set(b)))
        return pd.Series(out)

    return run(left, right)


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are linked. Many pairs may have one ``a``: they are dealt
    to SALTS tasks by ``b``, each with a copy of the text of ``a``."""
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    return (
        salted.join(right, "b")
        .join(salted.select("a", "salt").distinct().join(left, "a"), ["a", "salt"])
        .where(_linked(F.col("text_a"), F.col("text_b")))
        .select("a", "b")
    )


def _meetings(members: DataFrame, labels: DataFrame) -> DataFrame:
    """How the members of buckets that hold several components meet. The members of a
    bucket's largest component (which need not be compared with each other) and all others
    are cut into blocks of about BLOCK members; every two blocks that can hold a link meet
    in a group (bucket, r, o) of their own."""
    known = members.where("n > 2").join(labels.withColumnRenamed("node", "key"), "key", "left")
    known = known.select("bucket", "key", F.coalesce("label", "key").alias("label"))
    sizes = known.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("size"))
    open_buckets = (
        sizes.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("labels"),
            F.sum("size").alias("size"),
            F.max(F.struct("size", "label")).alias("largest"),
        )
        .where("labels > 1")
        .select(
            "bucket",
            F.col("largest.label").alias("large"),
            F.ceil(F.col("largest.size") / BLOCK).cast("int").alias("large_blocks"),
            F.ceil((F.col("size") - F.col("largest.size")) / BLOCK).cast("int").alias("rest_blocks"),
        )
    )
    in_large = F.col("label") == F.col("large")
    own = F.pmod(F.xxhash64("key"), F.when(in_large, F.col("large_blocks")).otherwise(F.col("rest_blocks"))).cast("int")
    rest_numbers = F.sequence(F.lit(0), F.col("rest_blocks") - 1)
    large_numbers = F.sequence(F.lit(0), F.col("large_blocks") - 1)
    # A meeting is (rest block, other block); others are rest blocks from 0 up, and blocks of
    # the largest component from -1 down.
    meetings = F.when(
        in_large, F.transform(rest_numbers, lambda r: F.struct(r.alias("r"), (-1 - own).alias("o")))
    ).otherwise(
        F.concat(
            F.transform(
                rest_numbers,
                lambda r: F.struct(F.least(r, own).alias("r"), F.greatest(r, own).alias("o")),
            ),
            F.transform(large_numbers, lambda x: F.struct(own.alias("r"), (-1 - x).alias("o"))),
        )
    )
    return known.join(open_buckets, "bucket").select(
        "bucket",
        "key",
        "label",
        F.when(in_large, -1 - own).otherwise(own).alias("block"),
        F.explode(meetings).alias("meeting"),
    ).select("bucket", "meeting.r", "meeting.o", "block", "key", "label")


def _across(met: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between members of different components that meet: pairs that survive the
    sequential test and are confirmed on their texts. A group reports a forest."""
    dealt = met.join(classes.select("key", "sig"), "key").join(texts, "key")
    least = least_matches()

    def compare(block: pa.Table) -> pa.Table:
        rest, other = block.column("r")[0].as_py(), block.column("o")[0].as_py()
        keys = block.column("key").to_pylist()
        number = np.unique(np.array(block.column("label").to_pylist(), dtype=object), return_inverse=True)[1]
        sigs = _signatures(block.column("sig").to_pylist())
        of = block.column("block").to_numpy()
        ours, theirs = np.flatnonzero(of == rest), np.flatnonzero(of == other)
        sets: dict[int, set] = {}

        def full_set(i: int) -> set:
            if i not in sets:
                sets[i] = shingle_set(block.column("text")[i].as_py() or "")
            return sets[i]

        forest = []
        for x in ours:
            y = theirs[number[theirs] != number[x]]
            if rest == other:
                y = y[y > x]
            for k in still_possible(np.broadcast_to(sigs[x], (len(y), HASHES)), sigs[y], least):
                i, j = int(x), int(y[k])
                if number[i] != number[j] and _similar(full_set(i), full_set(j)):
                    forest.append((min(keys[i], keys[j]), max(keys[i], keys[j])))
                    number[number == number[j]] = number[i]
        return pa.table(
            {
                "a": pa.array([a for a, _ in forest], pa.binary()),
                "b": pa.array([b for _, b in forest], pa.binary()),
            }
        )

    return dealt.groupBy("bucket", "r", "o").applyInArrow(compare, "a binary, b binary").distinct()


def _label(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(place, id, text) -> (place, id, n_shingles, first): first is the row (unnamed, id,
    place) that stays of the row's component, null for empty sets."""
    rows = scratch.write(sketch(docs), "sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "place")).alias("first")
    classes = scratch.write(
        rows.where("key is not null").groupBy("key").agg(first, F.first("sig").alias("sig")), "classes"
    )
    bands = classes.select(
        "key",
        F.explode(
            F.array(
                *[
                    F.xxhash64(F.lit(i), F.substring("sig", i * ROWS * 4 + 1, ROWS * 4))
                    for i in range(BANDS)
                ]
            )
        ).alias("bucket"),
    )
    heads = bands.groupBy("bucket").agg(F.min("key").alias("head"), F.count(F.lit(1)).alias("n"))
    members = scratch.write(bands.join(heads.where("n > 1"), "bucket"), "members")

    head_pairs = (
        members.where(F.col("key") != F.col("head"))
        .select(F.col("head").alias("a"), F.col("key").alias("b"))
        .distinct()
    )
    sigs = classes.select("key", "sig")
    likely = scratch.write(
        head_pairs.join(sigs.toDF("b", "sig_b"), "b")
        .join(sigs.toDF("a", "sig_a"), "a")
        .where(_survives(F.col("sig_a"), F.col("sig_b")))
        .select("a", "b"),
        "likely",
    )
    paired = likely.select(F.explode(F.array("a", "b")).alias("key"))
    links = scratch.write(_confirm(likely, _texts(docs, classes, paired, scratch, "paired")), "links")
    labels = scratch.write(components(links, scratch, "first"), "labels")

    met = scratch.write(_meetings(members, labels), "met")
    texts = scratch.write(_texts(docs, classes, met.select("key"), scratch, "open"), "met_texts")
    found = scratch.write(_across(met, classes, texts), "found")
    if not found.isEmpty():
        stars = labels.where("node != label").select(F.col("label").alias("a"), F.col("node").alias("b"))
        labels = scratch.write(components(stars.unionByName(found), scratch, "second"), "all_labels")

    named = classes.select("key", "first").join(labels.withColumnRenamed("node", "key"), "key", "left")
    named = named.withColumn("label", F.coalesce("label", "key"))
    firsts = named.groupBy("label").agg(F.min("first").alias("first"))
    by_key = named.select("key", "label").join(firsts, "label").select("key", "first")
    return rows.select("place", "id", "n_shingles", "key").join(by_key, "key", "left").drop("key")


def _texts(docs: DataFrame, classes: DataFrame, keys: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """One text of every class in ``keys``; the texts of other rows are not shuffled."""
    places = classes.join(keys.distinct(), "key").select("key", F.col("first.place").alias("place"))
    places = scratch.write(places, f"{name}_places")
    likely, _ = split_by_hits(docs.select("place", "text"), places, "place", scratch, f"{name}_bits")
    return likely.join(places.hint("merge"), "place").select("key", "text")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` (size of its set),
    ``component_id`` (smallest id reachable by links) and ``kept`` (the id is that one)."""
    with Scratch(docs.sparkSession) as scratch, arrow_batches(docs.sparkSession, BATCH_ROWS):
        stored = locate(docs.select(id_col, text_col), scratch, "place")
        rows = stored.select("place", F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        component = F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id"))
        out = _label(rows, scratch).select(
            F.col("id").alias(id_col),
            "n_shingles",
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        )
        return scratch.write(out, "result", keep=True)


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without all but one of each component (the one with the smallest
    id; of equal ids the one stored first), with all their columns."""
    with Scratch(docs.sparkSession) as scratch, arrow_batches(docs.sparkSession, BATCH_ROWS):
        name = fresh(docs, "place")
        stored = locate(docs, scratch, name)
        rows = stored.select(
            F.col(name).alias("place"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
        )
        dropped = scratch.write(
            _label(rows, scratch)
            .where(F.col("first").isNotNull() & (F.col("place") != F.col("first.place")))
            .select(F.col("place").alias(name)),
            "dropped",
            keep=True,
        )
        likely, clean = split_by_hits(stored, dropped, name, scratch, "dropped_bits", keep=True)
        kept = likely.join(dropped.hint("merge"), name, "left_anti")
        return clean.select(docs.columns).unionByName(kept.select(docs.columns))
