"""BPE encoding with a table of distinct words, and decoding through the piece table.

Texts are cut into chunks of stored rows. Every chunk lists its distinct words by frequency
and keeps its documents as sequences of positions in that list. The lists are shuffled by
the words' hash, so that equal words of all chunks meet; there each distinct word of the
corpus is encoded once, and its ids go back to the chunks by position. A chunk then puts the
ids in place of its positions. Only distinct words of a chunk are shuffled: a frequent word
is there once per chunk, however often it occurs, and words and positions travel in
compressed packets. No task holds more than one chunk or one hash's share of the words.

Decoding looks up every id's piece in the vocabulary's piece table (one entry per id, so
its size is the vocabulary's) and joins the pieces as the tokenizer does without a decoder,
with blanks, special tokens included.

Null and empty texts have no ids and decode to the empty text. Ids of documents may be null
or repeated: rows are told apart by where they are stored. Extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, fresh, locate, per_process
from tidemark.llm.tokens import WordTokenizer, pieces

CHUNK_CHARS = 16 << 20
CUT_CHARS = 4 << 20  # after so many characters the texts before are cut into words together


def _number(chunk: str) -> int:
    """A chunk's name as a 64-bit number, by which its words come back to it."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(chunk)).astype(np.int64))


def _pack(values: np.ndarray) -> bytes:
    """Integers as four planes of bytes, compressed: high planes are mostly zeros."""
    planes = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


class _Chunk:
    """Documents of one piece of a file, and their distinct words."""

    def __init__(self, source: tuple[str, int], number: int, splitter: WordTokenizer):
        self.source, self.number, self.chars, self.splitter = source, number, 0, splitter
        self.first_use: dict[str, int] = _Positions()
        self.ids: list = []
        self.sequences: list[np.ndarray | None] = []  # null for a text that waits
        self.waiting_for: list[int] = []
        self.waiting: list[str] = []
        self.waiting_chars = 0

    def add(self, key, text: str) -> None:
        self.chars += len(text) + 1
        self.ids.append(key)
        if (spaced := self.splitter.spaced(text)) is None:
            self.sequences.append(self.places(self.splitter.words(text)))
            return
        self.waiting_for.append(len(self.sequences))
        self.sequences.append(None)
        self.waiting.append(spaced)
        self.waiting_chars += len(spaced)
        if self.waiting_chars >= CUT_CHARS:
            self.cut()

    def places(self, words: list[str]) -> np.ndarray:
        return np.array([self.first_use[w] for w in words], dtype=np.uint32)

    def cut(self) -> None:
        """The words of the texts that wait. Arrow cuts them into runs between blanks and finds
        the distinct ones, whose words are looked up once for all these texts."""
        if not self.waiting:
            return
        runs = pc.utf8_split_whitespace(pa.array(self.waiting, pa.large_string()))
        keys = runs.flatten().dictionary_encode()
        # Through NumPy, which makes the strings several times faster than to_pylist.
        distinct = keys.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = [self.splitter.find(run) for run in distinct]
        places = self.places(list(chain.from_iterable(found)))
        long = np.fromiter(map(len, found), np.int64, len(found))
        flat, ends = _spread(places, np.cumsum(long) - long, long, keys.indices.to_numpy())
        bounds = np.concatenate([[0], ends])[runs.offsets.to_numpy()]
        for at, (i, j) in zip(self.waiting_for, pairwise(bounds.tolist()), strict=True):
            self.sequences[at] = flat[i:j]
        self.waiting_for, self.waiting, self.waiting_chars = [], [], 0

    @property
    def name(self) -> str:
        return f"{self.source[0]}:{self.source[1]}:{self.number}:{len(self.first_use)}"

    def by_frequency(self) -> tuple[list[str], np.ndarray]:
        """The distinct words, most frequent first, and the documents' words as places in
        that list, one document after another."""
        flat = np.concatenate([*self.sequences, np.zeros(0, np.uint32)])
        counts = np.bincount(flat, minlength=len(self.first_use))
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order))
        words = list(self.first_use)
        return [words[i] for i in order], place[flat]


def _spread(
    values: np.ndarray, start: np.ndarray, long: np.ndarray, sequence: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``values`` (``start``, ``long``) that ``sequence`` names, one after
    another, and where each ends."""
    each = long[sequence]
    ends = np.cumsum(each)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(start[sequence] - (ends - each), each) + np.arange(total)], ends


class _Positions(dict):
    """Position of each distinct word in order of first use."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _chunks(batches: Iterator[pa.RecordBatch], splitter: WordTokenizer) -> Iterator[_Chunk]:
    """Cut the rows of a task into chunks. A chunk ends with its piece of a file or at
    CHUNK_CHARS, so the same rows always make the same chunks."""
    chunk = None
    for batch in batches:
        for file, start, key, text in zip(*batch.columns, strict=True):
            source = (file.as_py(), start.as_py())
            if chunk is None or source != chunk.source or chunk.chars >= CHUNK_CHARS:
                if chunk is not None:
                    chunk.cut()
                    yield chunk
                same = chunk is not None and source == chunk.source
                chunk = _Chunk(source, chunk.number + 1 if same else 0, splitter)
            chunk.add(key.as_py(), text.as_py() or "")
    if chunk is not None:
        chunk.cut()
        yield chunk


def encode(
    docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``ids``. ``spec`` is the text of a
    tokenizer file (``tokens.read_spec``)."""
    spark = docs.sparkSession
    stored = locate(docs.select(id_col, text_col), Scratch(spark), "place").select(
        F.col("place.file").alias("file"),
        F.input_file_block_start().alias("start"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
    )
    id_type = stored.schema["id"].dataType.simpleString()
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def tokenizer() -> WordTokenizer:
        return per_process(("words", spec), lambda: WordTokenizer(spec))

    def list_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, tokenizer()):
            words, _ = chunk.by_frequency()
            share = np.array([xxhash.xxh3_64_intdigest(w) % shares for w in words], np.int64)
            order = np.argsort(share, kind="stable")
            used, starts = np.unique(share[order], return_index=True)
            parts = np.split(order, starts[1:]) if len(order) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used),
                    pa.array(np.full(len(parts), _number(chunk.name))),
                    pa.array([_pack(p) for p in parts], pa.binary()),
                    pa.array([zstandard.compress(json.dumps([words[i] for i in p]).encode()) for p in parts], pa.binary()),
                ],
                ["share", "chunk", "places", "words"],
            )

    def list_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, tokenizer()):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_number(chunk.name)]),
                    pa.array([chunk.name], pa.string()),
                    pa.array([chunk.ids], pa.list_(ids_type(id_type))),
                    pa.array([[len(s) for s in chunk.sequences]], pa.list_(pa.int64())),
                    pa.array([_pack(chunk.by_frequency()[1])], pa.binary()),
                ],
                ["chunk", "name", "ids", "lengths", "sequence"],
            )

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by share: its words are encoded when they first show up."""
        words, table, share = tokenizer(), {}, None
        for batch in batches:
            for at, chunk, places, packed in zip(*batch.columns, strict=True):
                if at != share:
                    table, share = {}, at
                codes = []
                for word in json.loads(zstandard.decompress(packed.as_py())):
                    if word not in table:
                        table[word] = np.array(words.encode(word), np.uint32)
                    codes.append(table[word])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk.as_py()], pa.int64()),
                        pa.array([places.as_py()], pa.binary()),
                        pa.array([_pack(np.array([len(c) for c in codes]))], pa.binary()),
                        pa.array([_pack(np.concatenate(codes))], pa.binary()),
                    ],
                    ["chunk", "places", "lengths", "codes"],
                )

    def put_back(coded: pa.Table, documents: pa.Table) -> pa.Table:
        places, lengths, codes = (
            np.concatenate([_unpack(x) for x in coded.column(c).to_pylist()] + [np.zeros(0, np.uint32)])
            for c in ("places", "lengths", "codes")
        )
        name = documents.column("name").to_pylist()
        if len(name) != 1 or int(name[0].rpartition(":")[2]) != len(places):
            raise ValueError(f"words and documents of chunks {name} do not belong together")
        # Where the ids of the word at each place start, and how many it has.
        start, long = np.empty((2, len(places)), np.int64)
        start[places], long[places] = np.cumsum(lengths, dtype=np.int64) - lengths, lengths
        sequence = _unpack(documents.column("sequence")[0].as_py())
        flat, ends = _spread(codes, start, long, sequence)
        words = np.cumsum(documents.column("lengths")[0].values.to_numpy())
        bounds = np.concatenate([[0], np.concatenate([[0], ends])[words]])
        ids = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype(np.int32)))
        return pa.table({"id": documents.column("ids").combine_chunks().flatten(), "ids": ids})

    coded = (
        stored.mapInArrow(list_words, "share long, chunk long, places binary, words binary")
        .repartition(shares, "share")
        .sortWithinPartitions("share")
        .mapInArrow(encode_words, "chunk long, places binary, lengths binary, codes binary")
    )
    listed = stored.mapInArrow(
        list_documents,
        f"chunk long, name string, ids array<{id_type}>, lengths array<long>, sequence binary",
    )
    encoded = (
        coded.groupBy("chunk")
        .cogroup(listed.groupBy("chunk"))
        .applyInArrow(put_back, f"id {id_type}, ids array<int>")
    )
    return encoded.withColumnRenamed("id", id_col)


def ids_type(spark_type: str) -> pa.DataType:
    """The Arrow type of a document id."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    if spark_type not in kinds:
        raise ValueError(f"document ids of type {spark_type} are not supported")
    return kinds[spark_type]


def decode(encoded: DataFrame, spec: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: every id is looked up in the piece table, and
    the pieces are joined by blanks."""
    # The table is a scalar subquery: as a literal it would be in every text of the plan, and
    # the driver makes several of each stage.
    rows = pa.table({"pieces": pa.array([pieces(spec)], pa.list_(pa.string()))})
    table = fresh(encoded, "pieces")
    found = F.transform(ids_col, lambda i: F.get(F.col(table), i))
    return (
        encoded.withColumn(table, encoded.sparkSession.createDataFrame(rows).scalar())
        .withColumn("decoded", F.array_join(found, " "))
        .drop(table)
    )


def digests(encoded: DataFrame, spec: str, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``encode``'s result: ``doc_id``, ``n_tokens``, and the sha256 of the ids'
    text and of the decoded text."""
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decode(encoded, spec).select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
