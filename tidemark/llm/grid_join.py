"""Embedding near-deduplication by an epsilon grid order join.

Vectors are scaled to length 1, where a cosine of at least ``COSINE`` is a distance of at
most epsilon. They are projected on the leading principal dimensions of all vectors and
sorted by the numbers of their grid cells (of width epsilon) in these dimensions, one after
another. The sorted sequence is cut into blocks. Starting from the whole sequence joined
with itself, pairs of intervals are cut into smaller intervals again and again, and a pair
is skipped as soon as the bounding boxes of its intervals are further apart than epsilon:
projections never lengthen a distance, so nothing is lost. Pairs of blocks that remain are
compared in a task each, where the recursion goes on down to small leaves whose vectors are
compared by cosine in double precision.

A task reports per vector how many vectors it links with, and links that connect what is
connected (a forest), never all pairs of a dense group. Equal vectors form one class first
and count with their number. The result has one row per row: ``vec_id``, ``n_links``
(other rows linked directly), ``component_id`` (smallest id reachable) and ``kept``.

Null vectors, zero vectors and vectors with null or non-finite components link with
nothing, as do vectors of different lengths with each other. Ids may be null (they come
last when the smallest is taken) or repeated. Extra columns are ignored; an empty table
gives an empty result. The principal dimensions only decide what can be skipped, never
what is linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch
from tidemark.llm.components import components

COSINE = 0.95
LEADING = 12  # principal dimensions used
BLOCK = 4096  # vectors compared with as many others in one task
LEAF = 128  # vectors below which the recursion compares
FAN = 3  # bits of the sequence number by which an interval is cut
SLACK = 1e-9  # for rounding in projections and boxes


def _unit(values: list | None) -> np.ndarray | None:
    if not values or any(v is None for v in values):
        return None
    vector = np.array(values, dtype=np.float64)
    top = np.abs(vector).max()
    if not np.isfinite(top) or top == 0:
        return None
    vector /= top  # neither overflows nor vanishes when squared
    return vector / np.sqrt((vector * vector).sum())


def _normalise(vectors: DataFrame) -> DataFrame:
    """(id, vector) -> (id, key, unit): key is null for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [v.as_py() for v in batch.column(1)]
            units = [_unit(v) for v in values]
            keys = [
                None if u is None else xxhash.xxh3_128_digest(np.array(v, np.float64).tobytes())
                for u, v in zip(units, values, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(keys, pa.binary()),
                    pa.array([None if u is None else u.tobytes() for u in units], pa.binary()),
                ],
                ["id", "key", "unit"],
            )

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", "vector").mapInArrow(run, f"id {kind}, key binary, unit binary")


def _matrix(units: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float64).reshape(len(units), -1)


def principal_dimensions(classes: DataFrame) -> np.ndarray:
    """The leading eigenvectors of the covariance of all vectors of the most usual length.
    Tasks sum products; one number per cell of the matrix reaches the driver."""
    length = F.length("unit")
    usual = classes.groupBy(length.alias("bytes")).count().orderBy(F.desc("count"), "bytes").first()
    if usual is None:
        return np.zeros((0, 0))
    d = usual["bytes"] // 8

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums, n = np.zeros((d, d)), np.zeros(d), 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0).to_pylist())
                total, sums, n = total + x.T @ x, sums + x.sum(axis=0), n + len(x)
        cells = np.concatenate([total.ravel(), sums, [n]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "value"]
        )

    rows = (
        classes.where(length == usual["bytes"])
        .select("unit")
        .mapInArrow(products, "cell long, value double")
        .groupBy("cell")
        .agg(F.sum("value").alias("value"))
        .orderBy("cell")
        .collect()
    )
    cells = np.array([r["value"] for r in rows])
    n, mean = cells[-1], cells[d * d : -1] / cells[-1]
    covariance = cells[: d * d].reshape(d, d) / n - np.outer(mean, mean)
    return np.linalg.eigh(covariance)[1][:, ::-1][:, : min(LEADING, d)]


def _project(units: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Coordinates on the basis; vectors of another length are cut or filled with zeros,
    which lengthens no distance between vectors of one length."""
    d, k = basis.shape
    shared = min(d, units.shape[1])
    return units[:, :shared] @ basis[:shared, :k]


def _epsilon(cosine: float) -> float:
    return float(np.sqrt(2 - 2 * cosine))


def _in_grid_order(classes: DataFrame, basis: np.ndarray, cosine: float) -> DataFrame:
    """Classes with the length of their vector, coordinates and cells."""
    epsilon, k = _epsilon(cosine), basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = [
                _project(np.frombuffer(u, np.float64)[None, :], basis)[0]
                for u in batch.column(2).to_pylist()
            ]
            cells = [np.floor(s / epsilon).astype(np.int32) for s in spots]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([s.tolist() for s in spots], pa.list_(pa.float64())),
                    pa.array([c.tolist() for c in cells], pa.list_(pa.int32())),
                ],
                ["key", "weight", "unit", "spot", "cell"],
            )

    rows = classes.select("key", "weight", "unit").mapInArrow(
        run, "key binary, weight long, unit binary, spot array<double>, cell array<int>"
    )
    order = ["length", *[F.col("cell")[i] for i in range(k)], "key"]
    return (
        rows.withColumn("length", F.length("unit"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id().cast("long"))
        .drop("cell")
    )


def _numbered(rows: DataFrame, block: int) -> DataFrame:
    """Number the blocks of the sorted sequence within each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            position = np.arange(batch.num_rows) + seen
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(position), pa.array(position // block)],
                [*batch.schema.names, "position", "number"],
            )

    schema = "key binary, weight long, unit binary, spot array<double>, length int, part long"
    return rows.mapInArrow(run, schema + ", position long, number long")


def _block_pairs(sequence: DataFrame, k: int, cosine: float) -> DataFrame:
    """Pairs (l, r), l <= r, of blocks that may hold links, by cutting intervals."""
    spark = sequence.sparkSession
    bounds = [
        f(F.col("spot")[i]).alias(f"{name}{i}")
        for i in range(k)
        for name, f in (("lo", F.min), ("hi", F.max))
    ]
    boxes = sequence.groupBy("block").agg(*bounds)
    top = sequence.agg(F.max("block")).first()[0] or 0
    levels = max(1, -(-int(top).bit_length() // FAN))
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("l"), F.lit(0).cast("long").alias("r"))
    again = [
        f(f"{name}{i}").alias(f"{name}{i}")
        for i in range(k)
        for name, f in (("lo", F.min), ("hi", F.max))
    ]
    for level in range(levels - 1, -1, -1):
        bits = level * FAN
        here = (
            boxes.withColumn("at", F.shiftright("block", bits)).groupBy("at").agg(*again)
            if bits
            else boxes.withColumnRenamed("block", "at")
        ).withColumn("above", F.shiftright("at", FAN))
        left = here.select(*[F.col(c).alias("l_" + c) for c in here.columns])
        right = here.select(*[F.col(c).alias("r_" + c) for c in here.columns])
        apart = sum(
            (
                F.greatest(F.col(f"r_lo{i}") - F.col(f"l_hi{i}"), F.col(f"l_lo{i}") - F.col(f"r_hi{i}"), F.lit(0.0)) ** 2
                for i in range(k)
            ),
            F.lit(0.0),
        )
        pairs = (
            pairs.join(left, F.col("l") == F.col("l_above"))
            .join(right, F.col("r") == F.col("r_above"))
            .where((F.col("l_at") <= F.col("r_at")) & (apart <= 2 - 2 * cosine + SLACK))
            .select(F.col("l_at").alias("l"), F.col("r_at").alias("r"))
        )
    return pairs


class _Side:
    """The vectors of a block in order, with the bounding boxes of its intervals."""

    def __init__(self, table: pa.Table, picked: np.ndarray, k: int):
        self.keys = [table.column("key")[int(i)].as_py() for i in picked]
        self.weights = table.column("weight").to_numpy()[picked]
        units = [table.column("unit")[int(i)].as_py() for i in picked]
        self.lengths = np.array([len(u) for u in units])
        width = max(self.lengths, default=0) // 8
        self.units = np.zeros((len(units), width))
        for row, u in zip(self.units, units, strict=True):
            row[: len(u) // 8] = np.frombuffer(u)
        self.spots = np.array([table.column("spot")[int(i)].as_py() for i in picked]).reshape(-1, k)
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        if (lo, hi) not in self.boxes:
            spots = self.spots[lo:hi]
            self.boxes[lo, hi] = spots.min(axis=0), spots.max(axis=0)
        return self.boxes[lo, hi]


def _leaves(a: _Side, b: _Side, same: bool, most: float) -> Iterator[tuple[int, int, int, int]]:
    """Recursive join of intervals: the pairs of leaves that are not provably distant."""
    open_pairs = [(0, len(a.keys), 0, len(b.keys))]
    while open_pairs:
        i, j, m, n = open_pairs.pop()
        if i >= j or m >= n or same and m + n < i + j:
            continue
        (lo, hi), (other_lo, other_hi) = a.box(i, j), b.box(m, n)
        gap = np.maximum(np.maximum(other_lo - hi, lo - other_hi), 0)
        if (gap * gap).sum() > most:
            continue
        if j - i <= LEAF and n - m <= LEAF:
            yield i, j, m, n
            continue
        half, other_half = (i + j) // 2, (m + n) // 2
        lefts = [(i, half), (half, j)] if j - i > LEAF else [(i, j)]
        rights = [(m, other_half), (other_half, n)] if n - m > LEAF else [(m, n)]
        open_pairs += [(*x, *y) for x in lefts for y in rights]


def _compare(table: pa.Table, k: int, cosine: float) -> pa.Table:
    """Links between the two blocks of a pair: per vector the number of linked rows
    (a is null), and the links (a, b) of a spanning forest."""
    block = table.column("block").to_numpy()
    left, right = table.column("l")[0].as_py(), table.column("r")[0].as_py()
    order = np.lexsort((table.column("position").to_numpy(), block))
    a = _Side(table, order[block[order] == left], k)
    same = left == right
    b = a if same else _Side(table, order[block[order] == right], k)
    if not same and a.units.shape[1] != b.units.shape[1]:
        width = max(a.units.shape[1], b.units.shape[1])
        for side in (a, b):
            side.units = np.pad(side.units, ((0, 0), (0, width - side.units.shape[1])))
    shift = 0 if same else len(a.keys)
    keys = a.keys if same else a.keys + b.keys
    counts, label = np.zeros(len(keys), np.int64), np.arange(len(keys))
    forest: list[tuple[bytes, bytes]] = []
    for i, j, m, n in _leaves(a, b, same, 2 - 2 * cosine + SLACK):
        linked = a.units[i:j] @ b.units[m:n].T >= cosine
        linked &= a.lengths[i:j, None] == b.lengths[None, m:n]
        if same:
            linked &= np.arange(i, j)[:, None] < np.arange(m, n)[None, :]
        counts[i:j] += linked @ b.weights[m:n]
        counts[shift + m : shift + n] += a.weights[i:j] @ linked
        for x in np.flatnonzero(linked.any(axis=1)):
            near = shift + m + np.flatnonzero(linked[x])
            for old in np.unique(label[near]):
                own, hits = label[i + x], near[label[near] == old]
                if old != own and len(hits):
                    y = int(hits[0])
                    forest.append((min(keys[i + x], keys[y]), max(keys[i + x], keys[y])))
                    label[label == max(old, own)] = min(old, own)
    some = np.flatnonzero(counts)
    return pa.table(
        {
            "a": pa.array([None] * len(some) + [x for x, _ in forest], pa.binary()),
            "b": pa.array([keys[i] for i in some] + [y for _, y in forest], pa.binary()),
            "n": pa.array(counts[some].tolist() + [0] * len(forest), pa.int64()),
        }
    )


def cosine_links(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``vectors``: id, ``n_links``, ``component_id`` and ``kept``."""
    spark = vectors.sparkSession
    with Scratch(spark) as scratch:
        rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
        rows = scratch.write(_normalise(rows), "units")
        first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id")).alias("first")
        classes = scratch.write(
            rows.where("key is not null")
            .groupBy("key")
            .agg(first, F.count(F.lit(1)).alias("weight"), F.first("unit").alias("unit")),
            "classes",
        )
        basis = principal_dimensions(classes)
        k = basis.shape[1]
        ordered = _numbered(_in_grid_order(classes, basis, cosine), block) if k else None
        if ordered is None:
            found = spark.createDataFrame([], "a binary, b binary, n long")
        else:
            sequence = scratch.write(ordered, "sequence")
            bits = int(sequence.agg(F.max("number")).first()[0] or 0).bit_length()
            at = F.shiftleft("part", bits).bitwiseOR(F.col("number"))
            sequence = sequence.withColumn("block", at)
            pairs = scratch.write(_block_pairs(sequence, k, cosine), "pairs")
            meets = pairs.select("l", "r", F.explode(F.array_distinct(F.array("l", "r"))).alias("block"))
            dealt = sequence.join(meets, "block").drop("part", "number", "length")
            compared = dealt.groupBy("l", "r").applyInArrow(
                lambda table: _compare(table, k, cosine), "a binary, b binary, n long"
            )
            found = scratch.write(compared, "found")
        counts = found.where("a is null").groupBy(F.col("b").alias("key")).agg(F.sum("n").alias("n"))
        labels = components(found.where("a is not null").select("a", "b"), scratch, "links")
        named = classes.select("key", "first", "weight").join(
            labels.withColumnRenamed("node", "key"), "key", "left"
        )
        named = named.withColumn("label", F.coalesce("label", "key"))
        smallest = named.groupBy("label").agg(F.min("first").alias("smallest"))
        by_key = (
            named.join(smallest, "label")
            .join(counts, "key", "left")
            .select(
                "key",
                F.col("smallest.id").alias("component"),
                (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"),
            )
        )
        component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component"))
        out = rows.select("id", "key").join(by_key, "key", "left").select(
            F.col("id").alias(id_col),
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.col("id").eqNullSafe(component).alias("kept"),
        )
        return scratch.write(out, "result", keep=True)
