"""Token ids in files: static range asymmetric numeral system over shared frequencies.

``write_tokens`` encodes every text with a tokenizer, appends the end id, and writes the ids
in ascending order of documents. One frequency table, counted over all ids, is shared by all
files. Ids are coded in blocks that know nothing of each other. A block deals its ids to
``LANES`` coders whose 32-bit words are interleaved in one stream. A shard holds whole
documents; its head lists its blocks (a checkpoint each: number of ids, offset of the words,
states of the coders, checksum), so any block can be decoded alone and many at once.

A folder written has two Parquet tables: ``table`` (symbol, frequency) and ``shards`` (part
of the order, number of the shard, ids before it in its part, the documents' ids and
lengths, and the coded bytes). ``read_tokens`` decodes the shards and gives every document
its place in the whole order; a checksum that does not fit raises an error.

Null and empty texts have the end id alone. Null document ids come first; rows of equal id
follow each other in the order of their ids. Extra columns are ignored; an empty table
writes an empty folder that reads as an empty table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import Remembered, Scratch, arrow_batches, per_process
from tidemark.llm.tokens import WordTokenizer, pieces

LANES = 64
BLOCK = LANES * 1024  # ids of a block
SHARD = 16 * BLOCK  # ids after which a shard ends with its document
BITS = 20  # frequencies sum to 2**BITS
LOW = np.uint64(1 << 31)  # states stay in [LOW, LOW * 2**32)
REMEMBERED = 400_000  # runs of text a worker keeps the ids of
BATCH_ROWS = 2000  # rows handed to Python at once
CHARS = 1 << 24  # after so many characters the texts before are cut into runs together

HEAD = np.dtype([("ids", "<u4"), ("words", "<u4"), ("crc", "<u4"), ("states", "<u8", (LANES,))])


class FrequencyTable:
    """Symbols in ascending order and their frequencies, which sum to 2**BITS."""

    def __init__(self, symbols: np.ndarray, frequencies: np.ndarray):
        self.symbols = np.asarray(symbols, np.uint32)
        self.frequency = np.asarray(frequencies, np.uint64)
        self.start = np.cumsum(self.frequency) - self.frequency
        self.rank = np.zeros(int(self.symbols.max(initial=0)) + 1, np.uint32)
        self.rank[self.symbols] = np.arange(len(self.symbols))
        self.filler = int(np.argmax(self.frequency)) if len(self.symbols) else 0
        self._slots: np.ndarray | None = None

    @property
    def slots(self) -> np.ndarray:
        """The rank of the symbol that owns each of the 2**BITS slots."""
        if self._slots is None:
            self._slots = np.repeat(
                np.arange(len(self.symbols), dtype=np.uint32), self.frequency.astype(np.int64)
            )
        return self._slots

    @classmethod
    def of_counts(cls, symbols: np.ndarray, counts: np.ndarray) -> FrequencyTable:
        """Every symbol gets one slot, and the others go by count; what rounding leaves goes
        to the most frequent symbol."""
        order = np.argsort(symbols)
        symbols, counts = symbols[order], counts[order].astype(np.float64)
        if len(symbols) > 1 << (BITS - 1):
            raise ValueError(f"{len(symbols)} symbols do not fit a table of 2**{BITS} slots")
        free = (1 << BITS) - len(symbols)
        frequency = 1 + np.floor(counts / max(counts.sum(), 1) * free).astype(np.int64)
        if len(symbols):
            frequency[np.argmax(counts)] += (1 << BITS) - frequency.sum()
        return cls(symbols, frequency)


def encode_blocks(ids: np.ndarray, table: FrequencyTable) -> bytes:
    """The ids as a shard: number of blocks, heads, words. All blocks advance together."""
    blocks = -(-len(ids) // BLOCK)
    steps = -(-min(len(ids), BLOCK) // LANES)
    ranks = np.full((blocks, LANES * steps), table.filler, np.uint32)
    # A lane takes neighbouring ids; only the last block may be filled up.
    sizes = [min(BLOCK, len(ids) - b * BLOCK) for b in range(blocks)]
    for b, n in enumerate(sizes):
        ranks[b, :n] = table.rank[ids[b * BLOCK : b * BLOCK + n]]
    ranks = ranks.reshape(blocks * LANES, steps)
    words = np.zeros((steps, blocks * LANES), np.uint32)
    written = np.zeros((steps, blocks * LANES), bool)
    state = np.full(blocks * LANES, LOW, np.uint64)
    limit = np.uint64((int(LOW) >> BITS) << 32)
    for t in range(steps - 1, -1, -1):
        frequency, start = table.frequency[ranks[:, t]], table.start[ranks[:, t]]
        full = state >= limit * frequency
        written[t], words[t] = full, state.astype(np.uint32)
        state = np.where(full, state >> np.uint64(32), state)
        whole = state // frequency
        state = (whole << np.uint64(BITS)) + (state - whole * frequency) + start
    heads, streams = np.zeros(blocks, HEAD), []
    for b in range(blocks):
        lanes = slice(b * LANES, (b + 1) * LANES)
        stream = words[:, lanes][written[:, lanes]].astype("<u4")
        heads[b] = (sizes[b], len(stream), zlib.crc32(stream.tobytes()), state[lanes])
        streams.append(stream.tobytes())
    return np.array([blocks, steps], "<u4").tobytes() + heads.tobytes() + b"".join(streams)


def decode_blocks(coded: bytes, table: FrequencyTable, only: int | None = None) -> np.ndarray:
    """The ids of a shard, or of its block number ``only``."""
    blocks, steps = (int(x) for x in np.frombuffer(coded, "<u4", 2))
    heads = np.frombuffer(coded, HEAD, blocks, 8)
    stream = np.frombuffer(coded, "<u4", offset=8 + heads.nbytes)
    at = np.cumsum(heads["words"].astype(np.int64)) - heads["words"]
    chosen = np.arange(blocks) if only is None else np.array([only])
    for b in chosen:
        part = stream[at[b] : at[b] + heads["words"][b]]
        if zlib.crc32(part.tobytes()) != heads["crc"][b]:
            raise ValueError(f"block {b} of a shard is damaged")
    stream = np.append(stream, np.uint32(0)).astype(np.uint64)
    at = at[chosen]
    state = heads["states"][chosen].astype(np.uint64).ravel()
    out = np.zeros((len(state), steps), np.uint32)
    mask = np.uint64((1 << BITS) - 1)
    for t in range(steps):
        slot = state & mask
        rank = table.slots[slot.astype(np.int64)]
        out[:, t] = rank
        state = table.frequency[rank] * (state >> np.uint64(BITS)) + slot - table.start[rank]
        short = state < LOW
        reads = short.reshape(-1, LANES)
        place = (at[:, None] + np.cumsum(reads, axis=1) - 1).ravel()[short]
        state[short] = (state[short] << np.uint64(32)) | stream[place]
        at = at + reads.sum(axis=1)
    ids = table.symbols[out.reshape(len(chosen), -1)]
    return np.concatenate([ids[i, : heads["ids"][b]] for i, b in enumerate(chosen)])


class _Codes(Remembered):
    """Run of text between blanks -> its ids, in the width asked for."""

    def __init__(self, spec: str, width: str):
        super().__init__(self.of_run, REMEMBERED)
        self.tokenizer, self.letter = WordTokenizer(spec), {"<u2": "H", "<u4": "I"}[width]
        # Runs differ by punctuation; their words recur.
        self.words = Remembered(self.of_word, REMEMBERED)

    def of_word(self, word: str) -> bytes:
        ids = self.tokenizer.encode(word)
        return struct.pack(f"<{len(ids)}{self.letter}", *ids)

    def of_run(self, run: str) -> bytes:
        words = self.tokenizer.find(run)
        return self.words[words[0]] if len(words) == 1 else self.encode(words)

    def encode(self, words: list[str]) -> bytes:
        return b"".join(map(self.words.__getitem__, words))

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, null counting as empty. Arrow cuts the texts and finds their
        distinct runs, so that a run is looked up once for many texts."""
        plain, others = [], {}
        for i, text in enumerate(texts):
            text = text.as_py() or ""
            if (normal := self.tokenizer.spaced(text)) is None:
                others[i] = self.encode(self.tokenizer.words(text))
            plain.append(normal or "")
        at = first = 0
        while first < len(plain):
            at, size = first, 0
            while at < len(plain) and size < CHARS:
                size += len(plain[at])
                at += 1
            runs = pc.utf8_split_whitespace(pa.array(plain[first:at], pa.large_string()))
            keys = runs.flatten().dictionary_encode()
            # Through NumPy, which makes the strings several times faster than to_pylist.
            distinct = keys.dictionary.to_numpy(zero_copy_only=False).tolist()
            ids = pa.array(list(map(self.__getitem__, distinct)), pa.large_binary()).take(keys.indices)
            ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[runs.offsets.to_numpy()].tolist()
            data = ids.buffers()[2]
            data = data.to_pybytes() if data is not None else b""
            for k, i in enumerate(range(first, at)):
                yield others[i] if i in others else data[ends[k] : ends[k + 1]]
            first = at


def id_width(spec: str, end_id: int) -> str:
    """Little-endian unsigned integers that hold every id: while they are shuffled, ids take
    two bytes each where the vocabulary allows."""
    return "<u2" if max(len(pieces(spec)) - 1, end_id) < 1 << 16 else "<u4"


def tokenize(docs: DataFrame, spec: str, end_id: int) -> DataFrame:
    """(id, text) -> (id, ids): ids in ``id_width``, with the end id."""
    width = id_width(spec, end_id)
    end = np.array([end_id], width).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = per_process(("codes", spec), lambda: _Codes(spec, width))
        for batch in batches:
            ids = [x + end for x in codes.texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"]
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, ids binary")


def count_symbols(tokens: DataFrame, width: str) -> DataFrame:
    """How often each id occurs: summed in every task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), width)
            here = np.bincount(ids, minlength=len(counts))
            here[: len(counts)] += counts
            counts = here
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["symbol", "n"])

    return (
        tokens.select("ids")
        .mapInArrow(run, "symbol long, n long")
        .groupBy("symbol")
        .agg(F.sum("n").alias("n"))
    )


def write_tokens(
    docs: DataFrame,
    path: str,
    spec: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode ``docs`` into the folder ``path``."""
    spark = docs.sparkSession
    width = id_width(spec, end_id)
    with Scratch(spark) as scratch, arrow_batches(spark, BATCH_ROWS):
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        tokens = scratch.write(tokenize(rows, spec, end_id), "tokens")
        counts = count_symbols(tokens, width).toPandas()  # a row per symbol of the vocabulary
        table = FrequencyTable.of_counts(counts["symbol"].to_numpy(), counts["n"].to_numpy())
        listing = list(zip(table.symbols.tolist(), table.frequency.tolist(), strict=True))
        spark.createDataFrame(listing, "symbol long, frequency long").write.parquet(f"{path}/table")
        kind = rows.schema["id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard = before = 0
            part, ids, codes, size = 0, [], [], 0

            def flush() -> pa.RecordBatch:
                values = np.frombuffer(b"".join(codes), width)
                lengths = np.array([len(c) // values.itemsize for c in codes], np.int64)
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int64()),
                        pa.array([shard], pa.int64()),
                        pa.array([before], pa.int64()),
                        pa.array([len(values)], pa.int64()),
                        pa.array([ids], pa.list_(id_type)),
                        pa.array([lengths], pa.list_(pa.int64())),
                        pa.array([encode_blocks(values, table)], pa.binary()),
                    ],
                    ["part", "shard", "before", "n_ids", "ids", "lengths", "coded"],
                )

            for batch in batches:
                id_type = batch.column(0).type
                for key, code, at in zip(*batch.columns, strict=True):
                    part = at.as_py()
                    ids.append(key.as_py())
                    codes.append(code.as_py())
                    size += len(codes[-1]) // np.dtype(width).itemsize
                    if size >= SHARD:
                        yield flush()
                        shard, before = shard + 1, before + size
                        ids, codes, size = [], [], 0
            if ids:
                yield flush()

        order = ["id", F.xxhash64("ids"), "ids"]
        (
            tokens.repartitionByRange(*order[:2])
            .sortWithinPartitions(*order)
            .select("id", "ids", F.spark_partition_id().cast("long").alias("part"))
            .mapInArrow(
                run,
                "part long, shard long, before long, n_ids long, "
                f"ids array<{kind}>, lengths array<long>, coded binary",
            )
            .write.option("compression", "none")
            .parquet(f"{path}/shards")
        )


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document: its id, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers)."""
    listing = spark.read.parquet(f"{path}/table").orderBy("symbol").collect()
    symbols = np.array([r["symbol"] for r in listing], np.uint32)
    frequencies = np.array([r["frequency"] for r in listing], np.uint64)
    shards = spark.read.parquet(f"{path}/shards")
    kind = shards.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = FrequencyTable(symbols, frequencies)
        for batch in batches:
            for first, ids, lengths, coded in zip(*batch.columns, strict=True):
                values = decode_blocks(coded.as_py(), table).astype("<u4")
                sizes = lengths.values.to_numpy()
                ends = np.cumsum(sizes)
                pieces = [values[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values,
                        pa.array(first.as_py() + ends - sizes),
                        pa.array(sizes),
                        pa.array(pieces, pa.binary()),
                    ],
                    ["id", "start", "n_tokens", "ids"],
                )

    # One row per part of the order, whatever the number of documents.
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = totals.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start")
    )
    return (
        shards.join(starts, "part")
        .select((F.col("part_start") + F.col("before")).alias("first"), "ids", "lengths", "coded")
        .mapInArrow(run, f"id {kind}, start long, n_tokens long, ids binary")
        .withColumnRenamed("id", id_col)
    )
