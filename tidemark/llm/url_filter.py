"""URL filter: a blocked Bloom filter of listed URLs in front of an exact hash join.

A rule lists a canonical URL ``host + path`` with a verdict; it fits the host and all its
subdomains, and every path that starts with the rule's. Of the rules that fit the longest
wins (block before allow among equal ones); a URL that no rule fits gets the default
verdict. Every distinct URL is looked up under the keys the rules can have (a host suffix
of as many labels and a path prefix of as many characters as some rule has). The Bloom
filter, a few bits in one 32-byte block per key, drops keys that are not listed; possible
hits are joined with the rules on the whole key, which removes the filter's false positives.

The filter is sent to the executors and never larger than ``max_bytes``: beyond that it
passes more keys to the join, and results stay the same. Null URLs and URLs without ``://``
have an empty host and path and get the default verdict. Rows may repeat; extra columns are
ignored. Without rules every URL gets the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower

WORDS = 8  # 32-bit words of a block; a key sets one bit in each
# Odd multipliers, one per word of a block (the golden ratio's multiples).
SALTS = np.array([(0x9E3779B1 * (2 * i + 1)) & 0xFFFFFFFF for i in range(WORDS)], dtype=np.uint64)
BYTES_PER_KEY = 2


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _blocks_and_masks(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block number and the words of the mask of each 64-bit hash."""
    h = hashes.astype(np.int64).view(np.uint64)
    low = h & np.uint64(0xFFFFFFFF)
    bits = ((low[:, None] * SALTS) & np.uint64(0xFFFFFFFF)) >> np.uint64(27)
    return ((h >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64), np.left_shift(
        np.uint64(1), bits
    ).astype(np.uint32)


def bloom_filter(keys: DataFrame, max_bytes: int = 4 << 20) -> np.ndarray:
    """Blocked Bloom filter of the column ``key``: one row of words per block."""
    n = keys.count()
    blocks = max(1, min(n * BYTES_PER_KEY // (4 * WORDS) + 1, max_bytes // (4 * WORDS)))

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = np.zeros((blocks, WORDS), dtype=np.uint32)
        for batch in batches:
            at, mask = _blocks_and_masks(batch["h"].to_numpy(), blocks)
            np.bitwise_or.at(words, at, mask)
        used = np.flatnonzero(words.any(axis=1))
        columns = {f"w{i}": words[used, i].astype(np.int64) for i in range(WORDS)}
        yield pd.DataFrame({"block": used, **columns})

    schema = "block long, " + ", ".join(f"w{i} long" for i in range(WORDS))
    rows = (
        keys.select(F.xxhash64("key").alias("h"))
        .mapInPandas(fill, schema)
        .groupBy("block")
        .agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
        .collect()  # at most max_bytes / 32 blocks
    )
    words = np.zeros((blocks, WORDS), dtype=np.uint32)
    for row in rows:
        words[row["block"]] = row[1:]
    return words


def maybe_listed(words: np.ndarray, key: Column) -> Column:
    """False where the key is certainly not in the filter."""

    @F.pandas_udf("boolean")
    def probe(hashes: pd.Series) -> pd.Series:
        at, mask = _blocks_and_masks(hashes.to_numpy(), len(words))
        return pd.Series(((words[at] & mask) == mask).all(axis=1))

    return probe(F.xxhash64(key))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    max_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule`` (the longest
    that fits, or null) and ``verdict``. ``rules`` has the columns host, path and verdict."""
    listed = rules.select(
        F.concat(ascii_lower(F.col("host")), F.coalesce("path", F.lit(""))).alias("key"),
        _labels(F.col("host")).alias("labels"),
        F.length(F.coalesce("path", F.lit(""))).alias("chars"),
        "verdict",
    ).where(F.col("host").isNotNull() & (F.col("host") != ""))
    shapes = listed.select("labels", "chars").distinct().collect()  # lengths, not rules
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    parsed = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url")
    ).withColumns({"host": url_host(url), "path": url_path(url)})
    keys = [
        F.when(
            (host != "") & (_labels(host) >= s["labels"]) & (F.length(path) >= s["chars"]),
            F.concat(F.substring_index(host, ".", -s["labels"]), F.substring(path, 1, s["chars"])),
        )
        for s in shapes
    ]
    lookups = (
        parsed.select("url", "host", "path")
        .where(F.col("url").isNotNull())
        .distinct()
        .select("url", F.explode(F.array_compact(F.array(*keys))).alias("key"))
        if keys
        else parsed.select("url", F.col("url").alias("key")).limit(0)
    )
    words = bloom_filter(listed.select("key").distinct(), max_bytes)
    best = (
        lookups.where(maybe_listed(words, F.col("key")))
        .join(listed.select("key", "verdict"), "key")
        .groupBy("url")
        .agg(F.max(F.struct(F.length("key").alias("n"), "key", "verdict")).alias("best"))
    )
    return parsed.join(best, "url", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
