"""Substring dedup by level-wise doubling of repeated windows.

A word goes when a window of ``length`` consecutive words that covers it also starts in a
document with a smaller id. Windows are found level by level: those of a short length that
occur in one document only can't be part of a longer repeated one, so only windows repeated
at one length are extended to twice that length, until ``length`` is reached or no candidate
survives. The shortest level starts at ``length`` halved as often as 20 words remain.

* A level of l words does not list all windows. Every window of the next length holds many of
  l words; the one with the smallest hash among them, its *anchor*, is the same wherever the
  window occurs. So anchors alone are counted (about two in l words), with the stretch of
  longer windows that share an anchor, and a stretch survives if its anchor occurs in two
  documents. Nothing is lost, and frequent anchors collapse before they are dealt out.
* At the last level a stretch is a *block* of words. Equal blocks settle all their windows at
  once: those in every document but the first one go. The windows of the first occurrence of
  each block remain to be compared one by one, if its anchor comes with other blocks too.

Windows and blocks are told apart by 64 and 128 bits of hashes independent of the anchor's
64 bits, which must be equal as well; texts themselves meet in no task.

``drop_repeated_windows`` gives one row per row: all columns and ``n_words``, ``n_removed``,
``kept_text`` (the words that stay, joined by one space). Columns with these names are
replaced. Words are runs of anything but blank, tab, line feed, VT, FF and carriage return,
compared byte by byte. A null or empty text has no words. Rows with one id are one document:
they take nothing from each other, and repeated rows get the same result each. Null ids come
after all others, and take nothing from each other. Texts are read whole; an empty table gives
an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, arrow_batches, fresh

LENGTH = 50
SHORTEST = 20  # words of a window at the first level, at least
BATCH = 256  # texts handed over at a time
# Odd multipliers of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15 | 3, 0xC2B2AE3D27D4EB4F | 3)


def levels(length: int) -> list[int]:
    """The lengths below ``length``, each half of the next one (rounded down)."""
    out = [length // 2]
    while out[0] // 2 >= SHORTEST:
        out.insert(0, out[0] // 2)
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits spread by a fixed reversible rule."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class Words:
    """The words of a batch of texts in one sequence, and hashes of stretches of them."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        flat, parent = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
        real = pc.not_equal(flat, "")
        flat, self.text = flat.filter(real), parent[real.to_numpy(zero_copy_only=False)]
        self.n = len(flat)
        self.counts = np.bincount(self.text, minlength=len(texts))
        self.start = np.cumsum(self.counts) - self.counts  # of each text
        coded = flat.dictionary_encode()
        codes, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        self.sums, self.back = [], []
        for seed, base in enumerate(BASES):
            named = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in distinct], np.uint64)
            terms = named[codes] * _powers(base, self.n)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)]))
            self.back.append(_powers(pow(base, -1, 1 << 64), self.n))

    def stretch(self, kind: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words from ``start`` to ``end`` (not included)."""
        sums = self.sums[kind]
        return _mixed((sums[end] - sums[start]) * self.back[kind][start] + (end - start).astype(np.uint64))

    def whole(self, length: int) -> np.ndarray:
        """Which places of the sequence start a window that ends in the same text."""
        at = np.arange(self.n)
        return at + length <= (self.start + self.counts)[self.text]

    def blocks(self, short: int, length: int, open_: np.ndarray) -> tuple[np.ndarray, ...]:
        """(first, count, anchor): stretches of places of ``open_`` that start windows of
        ``length`` words with one anchor, the window of ``short`` words of smallest hash,
        the first of equal ones."""
        places = np.flatnonzero(open_)
        if not len(places):
            return (places, places, np.zeros(0, np.uint64))
        at = np.arange(self.n - short + 1)
        value = self.stretch(0, at, at + short)
        span, best = 1, at
        width = length - short + 1
        while span < width:  # places of the smallest of twice as many
            step = min(span, width - span)
            a, b = best[: len(best) - step], best[step:]
            best = np.where(value[b] < value[a], b, a)
            span += step
        anchor = best[places]
        new = np.ones(len(places), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (places[1:] != places[:-1] + 1)
        heads = np.flatnonzero(new)
        counts = np.diff(np.append(heads, len(places)))
        return places[heads], counts, value[anchor[heads]]


def _open(words: Words, spans: pa.Array | None, length: int, together: int) -> np.ndarray:
    """Places that start a window of ``length`` words and, with the places after them, at
    least ``together`` candidates: ``spans`` lists (first, count) of these per text (null:
    every place is one)."""
    whole = words.whole(length)
    if spans is None:
        return whole
    flat = spans.flatten()
    text = pc.list_parent_indices(spans).to_numpy()
    first = flat.field("first").to_numpy() + words.start[text]
    marks = np.zeros(words.n + 1, np.int64)
    np.add.at(marks, first, 1)
    np.add.at(marks, first + flat.field("count").to_numpy(), -1)
    closed = np.concatenate([[0], np.cumsum(np.cumsum(marks[:-1]) <= 0)])
    end = np.minimum(np.arange(words.n) + together, words.n)
    return whole & (closed[end] == closed[:-1])


def _stretches(docs: DataFrame, short: int, length: int, together: int = 0, blocks: bool = False) -> DataFrame:
    """The stretches of windows of ``length`` words with one anchor of ``short`` words, in
    ``docs`` (id, key, text; with ``together`` also ``spans``, and only windows that start
    with so many candidates in a row). With ``blocks`` also the hashes of all words of a
    stretch and of each of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(2))
            if not words.n:
                continue
            spans = batch.column(3) if together else None
            first, count, anchor = words.blocks(short, length, _open(words, spans, length, together))
            text = words.text[first]
            columns = [
                batch.column(0).take(pa.array(text)),
                batch.column(1).take(pa.array(text)),
                pa.array(anchor.view(np.int64)),
                pa.array(first - words.start[text]),
                pa.array(count),
            ]
            names = ["id", "key", "anchor", "first", "count"]
            if blocks:
                end = first + count - 1 + length
                columns += [pa.array(words.stretch(k, first, end).view(np.int64)) for k in (0, 1)]
                offsets = np.append(0, np.cumsum(count))
                each = np.repeat(first - offsets[:-1], count) + np.arange(offsets[-1])
                hashes = words.stretch(1, each, each + length).view(np.int64)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes)))
                names += ["block_a", "block_b", "windows"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, key bigint, anchor bigint, first bigint, count bigint"
    if blocks:
        schema += ", block_a bigint, block_b bigint, windows array<bigint>"
    wanted = ["id", "key", "text"] + (["spans"] if together else [])
    return docs.select(*wanted).mapInArrow(run, schema)


# Conditions on the holders of something: ``lo`` and ``hi`` are their smallest and largest id,
# ``unnamed`` says whether one has no id. SHARED: there are two documents, of which one has an
# id. LATER: the row's document comes after the first of them.
SHARED = "lo < hi or (unnamed and lo is not null)"
LATER = "coalesce(id > lo or (id is null and lo is not null), false)"


def _holders(rows: DataFrame, *by: str) -> DataFrame:
    unnamed = F.bool_or(F.col("id").isNull()).alias("unnamed")
    return rows.groupBy(*by).agg(F.min("id").alias("lo"), F.max("id").alias("hi"), unnamed)


def _with_spans(
    docs: DataFrame, rows: DataFrame, how: str, own_id: str = "id", own_key: str = "key", spans: str = "spans"
) -> DataFrame:
    """``docs`` with the (first, count) of their ``rows`` as column ``spans``."""
    lists = rows.groupBy("id", "key").agg(F.collect_list(F.struct("first", "count")).alias(spans))
    of, of_key = fresh(docs, "of"), fresh(docs, "of_key")
    lists = lists.select(F.col("id").alias(of), F.col("key").alias(of_key), spans)
    match = (F.col(own_key) == F.col(of_key)) & F.col(own_id).eqNullSafe(F.col(of))
    return docs.join(lists, match, how).drop(of, of_key)


def _later_copies(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, key, first, count) of the windows that a document with a smaller id holds too."""
    block = ["anchor", "block_a", "block_b"]
    kinds = scratch.write(_holders(blocks, *block), "block_kinds")
    several = kinds.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("forms"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.bool_or("unnamed").alias("unnamed"),
    )
    several = several.where("forms > 1").where(SHARED).select("anchor", F.lit(True).alias("varied"))
    kinds = (
        kinds.join(several, "anchor", "left")
        .withColumn("varied", F.coalesce("varied", F.lit(False)))
        .where(F.expr(SHARED) | F.col("varied"))
        .select(*block, "lo", "varied")
    )
    judged = blocks.join(scratch.write(kinds, "open_kinds"), block).withColumn("later", F.expr(LATER))
    judged = judged.where("later or varied").select(
        "id", "key", "first", "count", "later", "anchor", F.when(~F.col("later"), F.col("windows")).alias("windows")
    )
    judged = scratch.write(judged, "judged")
    single = judged.where("not later").select(
        "id", "key", "anchor", "first", F.posexplode("windows").alias("at", "window")
    )
    earliest = _holders(single, "anchor", "window").where(SHARED).select("anchor", "window", "lo")
    found = (
        single.join(scratch.write(earliest, "windows"), ["anchor", "window"])
        .where(LATER)
        .select("id", "key", (F.col("first") + F.col("at")).alias("first"), F.lit(1).cast("long").alias("count"))
    )
    return judged.where("later").select("id", "key", "first", "count").unionByName(found)


def _covered(starts: list[dict], length: int) -> list[tuple[int, int]]:
    """The stretches of words that windows of ``length`` words at ``starts`` cover."""
    out: list[tuple[int, int]] = []
    for first, end in sorted((s["first"], s["first"] + s["count"] - 1 + length) for s in starts):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def later_copies(docs: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """(id, key, first, count): the stretches of places in ``docs`` (id, key, text) that start
    a window which a document with a smaller id holds too."""
    if length < 2:
        raise ValueError("a window has two words at least")
    steps = levels(length)
    candidates, together = docs, 0
    for short, longer in zip(steps, [*steps[1:], length], strict=True):
        rows = scratch.write(_stretches(candidates, short, longer, together), f"anchors_{short}")
        repeated = _holders(rows, "anchor").where(SHARED).select("anchor")
        repeated = scratch.write(repeated, f"repeated_{short}")
        survivors = scratch.write(rows.join(repeated, "anchor").drop("anchor"), f"survivors_{short}")
        if survivors.isEmpty():
            return survivors
        candidates = _with_spans(docs, survivors, "inner")
        following = 2 * longer if 2 * longer < length else length
        together = following - longer + 1
    blocks = _stretches(candidates, steps[-1], length, together=1, blocks=True)
    return _later_copies(scratch.write(blocks, "blocks"), scratch)


ADDED = ("n_words", "n_removed", "kept_text")


def _kept(docs: DataFrame, id_col: str, text_col: str, length: int, scratch: Scratch) -> DataFrame:
    """``docs`` and the ``ADDED`` columns, not yet written."""
    carried = [c for c in docs.columns if c.lower() not in ADDED]
    own_id, own_key = fresh(docs, "window_id"), fresh(docs, "window_key")
    own_text = next((c for c in carried if c.lower() == text_col.lower()), fresh(docs, "window_text"))
    key = F.xxhash64(id_col, text_col)
    plain = docs.select(F.col(id_col).alias("id"), key.alias("key"), F.col(text_col).alias("text"))
    found = scratch.write(later_copies(plain, length, scratch), "found")
    extra = [] if own_text in carried else [F.col(text_col).alias(own_text)]
    frame = docs.select(*carried, *extra, F.col(id_col).alias(own_id), key.alias(own_key))
    spans = fresh(frame, "spans")
    frame = _with_spans(frame, found, "left", own_id, own_key, spans).drop(own_id, own_key)
    at, spans_at = frame.columns.index(own_text), len(frame.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            for raw, spans in zip(texts, batch.column(spans_at).to_pylist(), strict=True):
                words = (raw or b"").split()
                stay, end = [], 0
                for first, after in _covered(spans or [], length):
                    stay.append(words[end:first])
                    end = after
                stay = [*itertools.chain.from_iterable(stay), *words[end:]]
                counts.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(b" ".join(stay))
            added = [
                pa.array(counts, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ]
            columns = [batch.column(i) for i in range(len(carried))] + added
            yield pa.RecordBatch.from_arrays(columns, [*carried, *ADDED])

    added = T._parse_datatype_string("n_words bigint, n_removed bigint, kept_text string")
    schema = T.StructType([docs.schema[c] for c in carried] + added.fields)
    return frame.mapInArrow(run, schema)


def drop_repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``."""
    spark = docs.sparkSession
    with Scratch(spark) as scratch, arrow_batches(spark, BATCH):
        return scratch.write(_kept(docs, id_col, text_col, length, scratch), "kept", keep=True)


def repeat_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed`` and the digest of the words that stay."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    with Scratch(spark) as scratch, arrow_batches(spark, BATCH):
        report = _kept(docs, "id", "text", length, scratch).select(
            F.col("id").alias(id_col), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
        )
        return scratch.write(report, "report", keep=True)
