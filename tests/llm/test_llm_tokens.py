"""Encoding, decoding, prefix counts and token files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, prefix_counts, rans
from tidemark.llm.tokens import WordTokenizer, pieces, read_spec

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string"

PARTS = ["a", "the", "ing", " ", "  ", "\n", "\n\n", "\t", "'s", "'re", "'ve", "'ll", "'l", "'", "!", "--------",
         "é", "e\u0301", "Σ", "ΟΔΟΣ", "İ", "日本", "😀", "1", "23", "½", "<|endoftext|>", "<|startoftext|>", "<|endo", "|>",
         "x" * 40, " " * 20, "\x85", "\x1c", "\u200b", "\u3000", "don't", "I'LL", "\U00010940", "\u0558", "&&&", ".\r\n"]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 15))) for _ in range(n)]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_words_encode_as_the_library_does(path):
    words, library = WordTokenizer(read_spec(path)), Tokenizer.from_file(path)
    for text in odd_texts(1500, 3):
        ids = [i for w in words.words(text) for i in words.encode(w)]
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_bpe_round_trip_on_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 200)  # many chunks
    library = Tokenizer.from_file(WORD)
    texts = [None, "", "  ", "word " * 20_000, *odd_texts(120, 5)]
    rows = [(i, t, "c") for i, t in enumerate(texts)] + [(1, "again", "c"), (1, "again", "c"), (None, "no id", "c")]
    docs = spark.createDataFrame(rows, DOCS + ", ids string")
    spec = read_spec(WORD)
    encoded = bpe.encode(docs, spec)
    got = sorted((str(r["doc_id"]), list(r["ids"]), r["decoded"]) for r in bpe.decode(encoded, spec).collect())
    expected = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((str(i), ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(expected)
    one = bpe.digests(encoded, spec).where("doc_id = 4").first()
    ids = library.encode(texts[4], add_special_tokens=False).ids
    assert one["n_tokens"] == len(ids)
    assert one["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.encode(docs.limit(0), spec).count() == 0


@pytest.mark.parametrize("chars, lookups", [(1, 50), (110, 8), (1 << 24, 1)])
def test_words_of_a_run_are_found_once_for_many_texts(monkeypatch, chars, lookups):
    monkeypatch.setattr(bpe, "CUT_CHARS", chars)
    words = WordTokenizer(read_spec(WORD))

    def chunks(texts):
        n = len(texts)
        columns = [pa.array(["f"] * n, pa.string()), pa.array([0] * n), pa.array(range(n)), pa.array(texts, pa.string())]
        return list(bpe._chunks(iter([pa.RecordBatch.from_arrays(columns, list("abcd"))]), words))

    texts = odd_texts(300, 8) + ["", " ", None, "\u00a0a\u2028b\x85c ", "a\x1cb \x1f", "<|endoftext|> a", "a \u3000 b"]
    (chunk,) = chunks(texts)
    listed, sequence = chunk.by_frequency()
    ends = np.cumsum([len(s) for s in chunk.sequences])[:-1]
    assert [[listed[k] for k in s] for s in np.split(sequence, ends)] == [words.words(t or "") for t in texts]
    asked, find = [], words.find
    monkeypatch.setattr(words, "find", lambda run: asked.append(run) or find(run))
    (chunk,) = chunks(["don't go don't", "go!!"] * 50)
    assert chunk.by_frequency()[0][:2] == ["don", "'t"]
    assert asked.count("don't") == lookups


def test_plan_texts_do_not_hold_the_piece_table(spark, capsys):
    spec = read_spec(WORD)
    rows = [(1, "own", [1, 2, None, -1, 999_999]), (2, "own", None), (3, None, [])]
    encoded = spark.createDataFrame(rows, "doc_id long, pieces string, ids array<int>")
    decoded = bpe.decode(encoded, spec)
    decoded.explain("formatted")
    assert len(capsys.readouterr().out) < 20_000
    table = pieces(spec)
    assert sorted(map(tuple, decoded.collect())) == [
        (*rows[0], f"{table[1]} {table[2]}"), (*rows[1], None), (*rows[2], "")
    ]


def test_prefix_counts_of_every_prefix(spark):
    library = Tokenizer.from_file(BYTE)
    texts = [None, "", "-" * 300, *odd_texts(200, 7)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], DOCS + ", n_tokens int")
    table = prefix_counts.prefix_table(docs, read_spec(BYTE))
    for r in table.collect():
        text = texts[r["doc_id"]] or ""
        expected = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        counts = np.concatenate([[0], np.cumsum(np.frombuffer(r["steps"], np.int8), dtype=int)])
        assert counts.tolist() == expected, repr(text)
        assert (r["n_tokens"], r["n_bytes"]) == (expected[-1], len(text.encode()))


def test_prefix_answers(spark):
    library = Tokenizer.from_file(BYTE)
    texts = [*odd_texts(60, 9), ""]
    table = prefix_counts.prefix_table(spark.createDataFrame(list(enumerate(texts)), DOCS), read_spec(BYTE))
    answers = table.select(
        "doc_id",
        prefix_counts.count_at(F.col("steps"), F.lit(5)).alias("five"),
        prefix_counts.fit_budget(F.col("steps"), F.lit(4)).alias("fits"),
    )
    for r in answers.collect():
        text = texts[r["doc_id"]]
        counts = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert r["five"] == counts[min(5, len(text))]
        assert r["fits"] == max(k for k, c in enumerate(counts) if c <= 4)


def test_prefix_counts_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b"), (2, "a b"), (2, "a b")], DOCS)
    assert [r["n_tokens"] for r in prefix_counts.prefix_table(docs, read_spec(BYTE)).collect()] == [2, 2, 2]
    assert prefix_counts.prefix_table(docs.limit(0), read_spec(BYTE)).count() == 0


def test_rans_blocks_round_trip_alone_and_together():
    rng = np.random.default_rng(2)
    for n in (1, 63, 65, 5000, rans.BLOCK + 1, 3 * rans.BLOCK):
        ids = rng.zipf(1.3, n) % 3000
        table = rans.FrequencyTable.of_counts(*np.unique(ids, return_counts=True))
        assert table.frequency.sum() == 1 << rans.BITS and table.frequency.min() > 0
        coded = rans.encode_blocks(ids, table)
        assert (rans.decode_blocks(coded, table) == ids).all()
        last = (n - 1) // rans.BLOCK
        assert (rans.decode_blocks(coded, table, last) == ids[last * rans.BLOCK :]).all()


def test_rans_size_is_near_the_entropy_and_damage_is_found():
    ids = np.random.default_rng(4).zipf(1.5, 2 * rans.BLOCK) % 1000
    symbols, counts = np.unique(ids, return_counts=True)
    table = rans.FrequencyTable.of_counts(symbols, counts)
    coded = rans.encode_blocks(ids, table)
    share = counts / counts.sum()
    heads = 2 * rans.HEAD.itemsize + 8
    assert len(coded) - heads < 1.01 * -(share * np.log2(share)).sum() * len(ids) / 8 + 600
    broken = bytearray(coded)
    broken[-3] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.decode_blocks(bytes(broken), table)


@pytest.mark.parametrize("chars, lookups", [(1, 100), (200, 6), (1 << 24, 2)])
def test_runs_of_many_texts_are_looked_up_once(monkeypatch, chars, lookups):
    monkeypatch.setattr(rans, "CHARS", chars)
    library = Tokenizer.from_file(WORD)
    texts = odd_texts(300, 7) + ["", " ", None, "\u00a0a\u2028b\x85c ", "a\x1cb \x1f", "<|endoftext|> a", "a \u3000 b"]
    codes = rans._Codes(read_spec(WORD), "<u2")
    got = [np.frombuffer(x, "<u2").tolist() for x in codes.texts(pa.array(texts, pa.string()))]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert list(codes.texts(pa.array([], pa.string()))) == []
    asked = []
    codes = rans._Codes(read_spec(WORD), "<u2")
    monkeypatch.setattr(rans._Codes, "__getitem__", lambda self, run: asked.append(run) or self.of_run(run), raising=False)
    list(codes.texts(pa.array(["one two one"] * 50, pa.string())))
    assert len(asked) == lookups and set(asked) == {"one", "two"}


def test_token_files_round_trip(spark, tmp_dir, monkeypatch):
    library = Tokenizer.from_file(WORD)
    rows = [(i * 7 % 101, t) for i, t in enumerate([None, "", "word " * 3000, *odd_texts(98, 13)])]
    docs = spark.createDataFrame([(*r, 0) for r in rows], DOCS + ", part int").repartition(5)
    rans.write_tokens(docs, f"{tmp_dir}/files", read_spec(WORD), 2)
    got = rans.read_tokens(spark, f"{tmp_dir}/files").orderBy("doc_id").collect()
    start = 0
    for (key, text), r in zip(sorted(rows, key=lambda x: x[0]), got, strict=True):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (key, start, len(ids))
        assert zlib.crc32(r["ids"]) == zlib.crc32(ids.tobytes())
        start += len(ids)


def test_token_files_null_repeated_and_no_rows(spark, tmp_dir):
    rows = [(None, "b"), (3, "same"), (3, "same"), (1, "a")]
    rans.write_tokens(spark.createDataFrame(rows, DOCS), f"{tmp_dir}/a", read_spec(WORD), 2)
    got = rans.read_tokens(spark, f"{tmp_dir}/a").orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in got] == [(None, 0, 2), (1, 2, 2), (3, 4, 2), (3, 6, 2)]
    rans.write_tokens(spark.createDataFrame([], DOCS), f"{tmp_dir}/b", read_spec(WORD), 2)
    assert rans.read_tokens(spark, f"{tmp_dir}/b").count() == 0
