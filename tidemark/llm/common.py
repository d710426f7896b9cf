"""Helpers shared by the operators: word splitting, tables written to the shared folder."""

from __future__ import annotations

import json
import string
import sys
import types
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

# Words are maximal runs of anything but blank, tab, line feed, VT, FF and carriage return.
SPACE_REGEX = r"[ \t\n\x0B\f\r]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is; null counts as empty."""
    return F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase
    )


def words(text: Column) -> Column:
    """The words of a text as an array (null or no words: an empty array)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_REGEX), "")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def array_literal(values: list, element: str) -> Column:
    """A list of bounded length as one literal; it is parsed once, when the plan is made."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{element}>")


def per_process(key: tuple, make: Callable[[], Any]) -> Any:
    """``make()``, kept for the tasks that follow in the same worker process."""
    kept = sys.modules.setdefault("_tidemark_kept", types.ModuleType("_tidemark_kept"))
    if key not in kept.__dict__:
        kept.__dict__[key] = make()
    return kept.__dict__[key]


class Remembered(dict):
    """Key -> ``make(key)``. When ``most`` keys are kept they become the older ones, and of
    these only keys asked for again are kept further, so frequent ones are made once."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        found = self.older.get(key)
        self[key] = out = self.make(key) if found is None else found
        return out


@contextmanager
def arrow_batches(spark: SparkSession, rows: int):
    """Frames written inside hand at most ``rows`` rows at a time to Python, so that long
    texts need little memory; the session's own setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written as Parquet under the shared checkpoint folder.

    ``write`` cuts the lineage of a frame: what follows reads the files, so a lost executor
    costs one read and not the whole plan. Leaving the ``with`` block deletes every table
    but those written with ``keep=True``, which the returned frame still reads; like
    Spark's own checkpoints these belong to the folder's owner. With ``drop_shuffles`` the
    shuffle files of a write go when it ends, not when the driver collects its garbage.
    """

    def __init__(self, spark: SparkSession, drop_shuffles: bool = False):
        self.spark, self.drop_shuffles = spark, drop_shuffles
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}"
        self.dropped: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        for path in self.dropped:
            self.delete(path)

    def path(self, name: str, keep: bool = False) -> str:
        path = f"{self.root}/{name}"
        if not keep:
            self.dropped.append(path)
        return path

    def write(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path = self.path(name, keep)
        before = self.spark.conf.get(SHUFFLE_CLEANUP)
        if self.drop_shuffles:
            self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self, path: str) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


# A row of bitmap_construct_agg holds so many bits; a hit table has at most HIT_ROWS rows, 64 MB.
HIT_BITS = 1 << 15
HIT_ROWS = 1 << 14


def split_by_hits(
    rows: DataFrame, hits: DataFrame, key: str, scratch: Scratch, name: str, keep: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` may be one of ``hits`` (a written table), and those whose key
    surely is none, so that a join with the hits need not shuffle all rows.

    A table of bits, 64 to a hit, has the bit of each hit's hash set. It is broadcast: it
    never has more than HIT_ROWS rows, where more hits only let more rows through.
    """
    n = min(max(hits.count() * 64 // HIT_BITS + 1, 1), HIT_ROWS)

    def place(part: DataFrame) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(part[key]), F.lit(n * HIT_BITS))
        return F.shiftright(at, 15), at.bitwiseAND(F.lit(HIT_BITS - 1))

    of_hits = hits.select(*[c.alias(x) for c, x in zip(place(hits), ("hit_row", "hit_bit"), strict=True)])
    table = of_hits.groupBy("hit_row").agg(F.bitmap_construct_agg("hit_bit").alias("hit_bits"))
    table = scratch.write(table, name, keep)
    row_no, bit = place(rows)
    found, bits = fresh(rows, "hit_row"), fresh(rows, "hit_bits")
    table = F.broadcast(table.toDF(found, bits))
    # One byte of the bitmap, as a number.
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    is_set = F.bit_get(byte.cast("int"), bit.bitwiseAND(F.lit(7)).cast("int")) == 1
    looked = rows.join(table, row_no == F.col(found), "left")
    may = F.coalesce(is_set, F.lit(False))
    return looked.where(may).select(rows.columns), looked.where(~may).select(rows.columns)


# What may lie above a read of files for its rows to have a place of their own each.
PLAIN_NODES = {"Project", "Filter", "SubqueryAlias", "View", "LogicalRelation"}


def _is_plain_read(df: DataFrame) -> bool:
    """Whether every row of ``df`` is another stored row: a read of files, of which columns
    and rows may be left out, but none made (as by an explode or a sample with replacement)."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in PLAIN_NODES:
        if plan.children().isEmpty():
            return True
        plan = plan.children().head()
    return False


def locate(df: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``df`` with a column ``name``: where its row is stored (file path, row number).

    Rows read from files have such a place already; any other frame is written to the
    shared folder first, also one that makes several rows of a stored one. The place tells
    rows apart that are equal in every column.
    """
    if _is_plain_read(df) and not any(c.lower() == "_metadata" for c in df.columns):
        try:
            return df.select("*", _place("_metadata").alias(name))
        except AnalysisException:
            pass
    # A column of that name would hide the place: it is stored under another and put back.
    hidden = {c: fresh(df, "own_metadata") for c in df.columns if c.lower() == "_metadata"}
    stored = scratch.write(df.withColumnsRenamed(hidden), "located", keep=True)
    located = stored.select("*", _place("_metadata").alias(name))
    return located.withColumnsRenamed({new: old for old, new in hidden.items()})


def _place(metadata: str) -> Column:
    return F.struct(
        F.col(f"{metadata}.file_path").alias("file"), F.col(f"{metadata}.row_index").alias("row")
    )
