"""Quality classifier by compression.

Two zstandard dictionaries are built, one from good and one from bad labelled text. A text is
cut into chunks, and the chunks are compressed with either dictionary and with none. Two
normalised differences of compressed sizes describe the text: good against bad dictionary,
and plain text against its own compression (repetition). A logistic calibration on labelled
texts that built no dictionary turns them into a score, the probability of a good label.

Fitting uses a bounded sample of labelled rows: per class the ``sample`` rows with the
smallest hash of their id, with their whole texts. Half of them (by another bit of the hash)
give the chunks the dictionaries are built from, ``sample_chunks`` a class at most, drawn by a
hash of chunk and place from anywhere in the texts; of the other half tasks compute the two
differences over whole texts, and only these numbers reach the driver for the calibration.
Scores read whole texts and depend on nothing else. A null or empty text has both differences
0 and gets the score these have. Rows with conflicting or null labels, or without a text,
teach nothing; when a class has no labelled row, every score is the share of good labels
(0.5 without labels). Ids may be null or repeated: every row is scored by its own text. A
score of exactly 0.5 counts as good. An empty table gives an empty result; extra columns of
the tables are ignored by ``fit`` and ``score_documents`` and carried by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

CHUNK = 1024
DICTIONARY_BYTES = 112 << 10
# Bytes added to every denominator, so that a short text's differences weigh less.
SMOOTHING = 40


def _parameters() -> zstandard.ZstdCompressionParameters:
    """Frames without magic number, content size and dictionary id: small texts count too."""
    return zstandard.ZstdCompressionParameters.from_level(
        3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0
    )


def _chunks(text: bytes) -> list[bytes]:
    return [text[i : i + CHUNK] for i in range(0, len(text), CHUNK)]


def _dictionary(chunks: list[bytes]) -> zstandard.ZstdCompressionDict:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, chunks)
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return zstandard.ZstdCompressionDict(
            b"".join(chunks)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )


class Compressors:
    """Compressed sizes of a text with the good, the bad and no dictionary."""

    def __init__(self, good: zstandard.ZstdCompressionDict, bad: zstandard.ZstdCompressionDict):
        settings = _parameters()
        for dictionary in (good, bad):
            dictionary.precompute_compress(compression_params=settings)
        self.good = zstandard.ZstdCompressor(dict_data=good, compression_params=settings)
        self.bad = zstandard.ZstdCompressor(dict_data=bad, compression_params=settings)
        self.plain = zstandard.ZstdCompressor(compression_params=settings)

    def features(self, text: bytes) -> tuple[float, float]:
        chunks = _chunks(text)
        good, bad, plain = (
            sum(len(c.compress(x)) for x in chunks) for c in (self.good, self.bad, self.plain)
        )
        n = len(text)
        return (bad - good) / (bad + good + SMOOTHING), (n - plain) / (n + SMOOTHING)


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the calibration; a few hundred kilobytes whatever the corpus."""

    good: bytes
    bad: bytes
    kinds: tuple[int, int]
    weights: tuple[float, ...]

    def compressors(self) -> Compressors:
        return Compressors(
            zstandard.ZstdCompressionDict(self.good, dict_type=self.kinds[0]),
            zstandard.ZstdCompressionDict(self.bad, dict_type=self.kinds[1]),
        )

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(features) @ np.array(self.weights), -30, 30)))


def _design(features: np.ndarray) -> np.ndarray:
    difference, repetition = features[:, 0], features[:, 1]
    return np.stack([np.ones(len(features)), difference, repetition, repetition**2], axis=1)


def _calibrate(features: np.ndarray, labels: np.ndarray, good_share: float) -> np.ndarray:
    """Logistic regression (Newton steps, a light ridge), classes weighted to their shares."""
    x = _design(features)
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1.0
    x = x / scale
    weight = np.where(
        labels == 1, good_share / labels.mean(), (1 - good_share) / (1 - labels.mean())
    )
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) * weight)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w += np.linalg.solve(hessian, x.T @ ((labels - p) * weight) - 1e-2 * w)
    return w / scale


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learnt: crc32 of the id's text leaves 1 modulo 3."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = 2000,
    sample_chunks: int = 16_384,
) -> QualityModel:
    """Learn from the labelled rows that are not held out."""
    with Scratch(docs.sparkSession) as scratch:
        return _fit(docs, labels, id_col, text_col, label_col, sample, sample_chunks, scratch)


def _fit(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
    sample: int, sample_chunks: int, scratch: Scratch,
) -> QualityModel:
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).alias("label"), F.max(label_col).alias("other"))
        .where("label = other")
        .select("id", "label")
    )
    present = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    good_share = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = some if chosen is None else chosen.unionByName(some)
    half = F.xxhash64("id", F.lit("half")).bitwiseAND(F.lit(1)).alias("half")
    rows = scratch.write(
        present.join(F.broadcast(chosen), "id")  # at most 2 * sample ids
        .groupBy("id", "label")
        .agg(F.min("text").alias("text"))
        .where("text <> ''")
        .select("id", "label", "text", half),
        "labelled",
    )
    halves = {(r["label"], r["half"]) for r in rows.select("label", "half").distinct().collect()}
    if {k for k, _ in halves} != {0, 1}:
        share = min(max(good_share, 1e-6), 1 - 1e-6)
        prior = float(np.log(share / (1 - share)))
        return QualityModel(b"", b"", (0, 0), (prior, 0.0, 0.0, 0.0))
    # A class with rows in one half only teaches both with them.
    teaches, checks = F.lit(False), F.lit(False)
    for k in (0, 1):
        both = {(k, 0), (k, 1)} <= halves
        teaches |= (F.col("label") == k) & ((F.col("half") == 0) if both else F.lit(True))
        checks |= (F.col("label") == k) & ((F.col("half") == 1) if both else F.lit(True))
    build = {k: _dictionary(_drawn_chunks(rows.where(teaches & (F.col("label") == k)), sample_chunks)) for k in (0, 1)}
    differences = rows.where(checks).select("label", _features(build[1], build[0], F.col("text")).alias("found"))
    checked = differences.orderBy(F.xxhash64("found"), "label").collect()
    weights = _calibrate(
        np.array([r["found"] for r in checked]), np.array([r["label"] for r in checked], float), good_share
    )
    kinds = (_kind(build[1]), _kind(build[0]))
    return QualityModel(build[1].as_bytes(), build[0].as_bytes(), kinds, tuple(map(float, weights)))


def _drawn_chunks(rows: DataFrame, most: int) -> list[bytes]:
    """At most ``most`` chunks of the texts, those with the smallest hashes, in their order."""

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([_chunks(t.encode()) for t in texts])

    chunks = rows.select("id", F.posexplode(cut("text")).alias("at", "chunk"))
    drawn = F.xxhash64("chunk", "id", "at")
    return [bytes(r["chunk"]) for r in chunks.orderBy(drawn, "chunk").limit(most).select("chunk").collect()]


def _features(good: zstandard.ZstdCompressionDict, bad: zstandard.ZstdCompressionDict, text: Column) -> Column:
    """The two differences of each whole text, by a dictionary pair."""
    given = [(d.as_bytes(), _kind(d)) for d in (good, bad)]
    shared: dict[str, Compressors] = {}

    @F.pandas_udf("array<double>")
    def differences(texts: pd.Series) -> pd.Series:
        if "c" not in shared:  # once per task
            shared["c"] = Compressors(*[zstandard.ZstdCompressionDict(b, dict_type=k) for b, k in given])
        return pd.Series([list(shared["c"].features(t.encode())) for t in texts])

    return differences(text)


def _kind(dictionary: zstandard.ZstdCompressionDict) -> int:
    return zstandard.DICT_TYPE_FULLDICT if dictionary.dict_id() else zstandard.DICT_TYPE_RAWCONTENT


def quality_score(model: QualityModel, text: Column) -> Column:
    """The model's score of a text column, in Arrow batches."""
    shared: dict[str, Compressors] = {}

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if "c" not in shared:  # once per task
            shared["c"] = model.compressors()
        features = [shared["c"].features((t or "").encode()) for t in texts]
        return pd.Series(model.score(np.array(features).reshape(-1, 2)))

    return score(text)


def score_documents(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score`` and ``predicted``."""
    return docs.select(
        id_col,
        held_out(F.col(id_col)).alias("held_out"),
        quality_score(model, F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least 0.5, with all their columns."""
    return docs.where(quality_score(model, F.col(text_col)) >= 0.5)
