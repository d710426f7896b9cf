"""Substring dedup against a plain dictionary of all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import queries, substring_dedup
from tidemark.llm.substring_dedup import Words, drop_repeated_windows, levels

SF = "/root/testdata/sf0.001"


def plain_words(text):
    return [w.decode() for w in (text or "").encode().split()]


def plain_dedup(rows, length):
    """[(id, n_words, n_removed, kept text)] of the rows (id, text)."""
    first = {}
    for i, text in rows:
        w = plain_words(text)
        for s in range(len(w) - length + 1):
            if i is not None:
                window = tuple(w[s : s + length])
                first[window] = min(first.get(window, i), i)
    out = []
    for i, text in rows:
        w = plain_words(text)
        gone = set()
        for s in range(len(w) - length + 1):
            holder = first.get(tuple(w[s : s + length]))
            if holder is not None and (i is None or holder < i):
                gone.update(range(s, s + length))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


def got_rows(frame):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in frame.collect()), key=repr)


def corpus(seed, n=60, length=12):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice(["", "é", "1", "2"])
    passages = [[word() for _ in range(rng.choice([length - 1, length, length + 1, 2 * length, 5 * length]))] for _ in range(6)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(5)):
            text += [word() for _ in range(rng.randrange(2 * length))]
            piece = list(rng.choice(passages))
            if rng.random() < 0.4:
                piece = piece[rng.randrange(3) : len(piece) - rng.randrange(3)]
            if piece and rng.random() < 0.3:
                piece[rng.randrange(len(piece))] = "X"
            text += piece
        rows.append((i, rng.choice([" ", "  ", "\n", " \t"]).join(text)))
    rows += [(n + k, rows[k][1]) for k in range(0, n, 7)]  # copies
    rows += [(500, "x " * 40), (501, "x " * 55), (502, "x y " * 30), (503, "y x " * 31)]  # repeating words
    return rows


@pytest.mark.parametrize("seed, length", [(1, 12), (2, 13), (3, 5), (4, 2)])
def test_against_all_windows(spark, seed, length):
    rows = corpus(seed, length=length)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got_rows(drop_repeated_windows(docs, length=length)) == plain_dedup(rows, length)


def test_several_levels(spark):
    assert levels(50) == [25] and levels(200) == [25, 50, 100] and levels(2) == [1] and levels(83) == [20, 41]
    rows = corpus(7, length=83)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got_rows(drop_repeated_windows(docs, length=83)) == plain_dedup(rows, 83)
    assert got_rows(drop_repeated_windows(docs, length=10_000)) == plain_dedup(rows, 10_000)
    with pytest.raises(ValueError, match="two words"):
        drop_repeated_windows(docs, length=1)


def test_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [
        (5, passage), (5, passage), (3, f"a {passage} b"), (None, f"c {passage}"), (None, passage), (9, None), (10, ""),
        (11, " \n\t "), (12, "one"), (13, "w" * 200_000), (2, "long " + "ha " * 60_000), (14, "ha " * 70),
        (15, " ".join(f"n{i}" for i in range(60))), (None, " ".join(f"n{i}" for i in range(59))), (16, "p0\x1cp1 p2"),
        (17, " ".join(f"u{i}" for i in range(60))), (17, "z " + " ".join(f"u{i}" for i in range(60))),
    ]
    full = [(i, t, 1, "k", [2]) for i, t in rows]
    docs = spark.createDataFrame(full, "doc_id long, text string, N_words int, spans string, of array<int>")
    got = drop_repeated_windows(docs)
    assert got.columns == ["doc_id", "text", "spans", "of", "n_words", "n_removed", "kept_text"]
    assert got_rows(got) == plain_dedup(rows, 50)
    assert {(r["spans"], r["of"][0]) for r in got.collect()} == {("k", 2)}
    assert drop_repeated_windows(docs.limit(0)).collect() == []
    one = docs.where("doc_id = 12")
    assert got_rows(drop_repeated_windows(one)) == [(12, 1, 0, "one")]


def test_query_on_given_documents(spark):
    got = queries.QUERIES["op12_substring_dedup"](spark, SF)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(i, n, removed, digest(kept)) for i, n, removed, kept in plain_dedup(rows, 50)]
    assert sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr) == sorted(want, key=repr)
    assert sum(r[2] for r in want) > 0


def test_words_and_hashes_of_a_batch():
    texts = [None, "a b  c", "", "b c a b c", "\x0b\x0cc \r\n", "a\x1cb é c"]
    words = Words(pa.array(texts, pa.string()))
    flat = [w for t in texts for w in plain_words(t)]
    assert words.counts.tolist() == [len(plain_words(t)) for t in texts]
    start, end = np.array([s for s in range(len(flat)) for e in range(s, len(flat) + 1)]), np.array([e for s in range(len(flat)) for e in range(s, len(flat) + 1)])
    for kind in (0, 1):
        seen = {}
        for s, e, h in zip(start.tolist(), end.tolist(), words.stretch(kind, start, end).tolist(), strict=True):
            assert seen.setdefault(tuple(flat[s:e]), h) == h
        assert len(set(seen.values())) == len(seen)
