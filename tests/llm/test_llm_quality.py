"""The quality classifier against a plain version; columns with clashing names."""

import struct
import zlib

import numpy as np
import pytest
import xxhash
import zstandard

from tidemark.llm import mixing, quality
from tidemark.llm.exact_dedup import drop_exact_copies
from tidemark.llm.line_dedup import drop_repeated_lines
from tidemark.llm.minhash import drop_near_copies

SF = "/root/testdata/sf0.01"


def spark_hash(*values):
    """Spark's xxhash64: each value's hash is the seed of the next one's."""
    seed = 42
    for v in values:
        data = v if isinstance(v, bytes) else struct.pack("<q" if abs(v) >> 31 or not hasattr(v, "small") else "<i", v)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >> 63 else seed


class Small(int):
    small = True  # an int column: four bytes


def plain_sizes(text, dictionary):
    settings = zstandard.ZstdCompressionParameters.from_level(
        3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0
    )
    made = zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings) if dictionary else zstandard.ZstdCompressor(compression_params=settings)
    return sum(len(made.compress(text[i : i + 1024])) for i in range(0, len(text), 1024))


def plain_model(docs, labels):
    """(good, bad, weights) by hand: dictionaries of one half, a logistic fit of the other."""
    known = {i: q for i, q in labels.items() if zlib.crc32(str(i).encode()) % 3 != 1 and docs.get(i)}
    half = {i: spark_hash(i, b"half") & 1 for i in known}
    texts = lambda k, h: [(i, docs[i].encode()) for i in known if known[i] == k and half[i] == h]
    built = {}
    for k in (0, 1):
        chunks = [(spark_hash(t[at : at + 1024], i, Small(at // 1024)), t[at : at + 1024]) for i, t in texts(k, 0) for at in range(0, len(t), 1024)]
        built[k] = zstandard.train_dictionary(112 << 10, [c for _, c in sorted(chunks)])
    return built[1], built[0], [(k, t) for k in (0, 1) for _, t in texts(k, 1)], sum(known.values()) / len(known)


def plain_features(text, good, bad):
    g, b, p, n = plain_sizes(text, good), plain_sizes(text, bad), plain_sizes(text, None), len(text)
    return (b - g) / (b + g + 40), (n - p) / (n + 40)


def test_model_and_scores_are_those_of_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    good, bad, checked, share = plain_model(texts, marks)
    assert model.good == good.as_bytes() and model.bad == bad.as_bytes()
    found = np.array([plain_features(t, good, bad) for _, t in checked])
    y = np.array([k for k, _ in checked], float)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    x = np.column_stack([np.ones(len(y)), found[:, 0], found[:, 1], found[:, 1] ** 2])
    scale = np.append(1.0, x[:, 1:].std(axis=0))
    z, w = x / scale, np.zeros(4)
    for _ in range(200):  # Newton's method on the ridge-weighted likelihood
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w += np.linalg.solve((z.T * (p * (1 - p) * weight)) @ z + 0.01 * np.eye(4), z.T @ ((y - p) * weight) - 0.01 * w)
    assert np.allclose(model.weights, w / scale, rtol=1e-6)
    rows = quality.score_documents(docs, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        d, c = plain_features((texts[r["doc_id"]] or "").encode(), good, bad)
        score = 1 / (1 + np.exp(-np.clip(np.array([1, d, c, c * c]) @ (w / scale), -30, 30)))
        assert r["score"] == pytest.approx(score, abs=1e-6)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.5)


def test_what_a_long_text_holds_at_its_end_is_learnt(spark):
    """Good and bad texts differ only far behind their beginning."""
    same = "the same beginning of every text " * 900  # about 29 000 characters
    texts = [(i, same + (f"harbour lights {i % 7} and quiet water " if i % 2 else f"BUY NOW {i % 7} click here ") * 300) for i in range(60)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, quality int")
    rows = quality.score_documents(docs, quality.fit(docs, labels)).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in rows)


def test_clashing_columns_are_carried(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text + "\nline one of these lines is here", "m", "a", 1.0), (2, text + "\nline one of these lines is here", "n", "a", 2.0), (3, None, "o", None, 3.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _metadata string, source string, mix_plan_source double")
    for drop in (drop_exact_copies, drop_near_copies, drop_repeated_lines, mixing.take_mix):
        got = drop(docs)
        assert got.columns == docs.columns
        assert {r["_metadata"] for r in got.collect()} <= {"m", "n", "o"}
        assert drop(docs.limit(0)).collect() == []
    assert {r["doc_id"] for r in drop_exact_copies(docs).collect()} == {2, 3}
    assert {r["doc_id"] for r in drop_near_copies(docs).collect()} == {1, 3}
