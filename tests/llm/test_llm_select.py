"""Mixing, URL filter, quality classifier, registered queries and the pipeline."""

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import mixing, quality, queries, url_filter
from tidemark.llm.common import Scratch
from tidemark.llm.minhash import shingle_set

SF = "/root/testdata/sf0.001"
MIX = "doc_id long, text string, source string"


def n_words(text):
    return len([w for w in re.split(r"[ \t\n\x0B\f\r]+", text or "") if w])


def plain_targets(sizes):
    """Shares by weight, capped at three times the size; the excess is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        rest = [s for s in order if s not in capped]
        level = left / max(1, sum(weight[s] for s in rest))
        above = [s for s in rest if level * weight[s] > 3 * sizes[s]]
        if not above:
            return {s: 3 * sizes[s] if s in capped else level * weight[s] for s in order}
        capped.update(above)


def mix_rows(seed, n=400):
    rng = random.Random(seed)
    sources = ["a", "B", "é", "zz", "", None, "tiny"]
    rows = [(i, "w " * rng.choice([0, 1, 5, 50, 300]), rng.choice([*sources[:5], "a", "a", "a"])) for i in range(n)]
    return [*rows, (n, "only one", "tiny"), (n + 1, None, None), (n + 2, "x y", None), (n + 3, "", "empty")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mix_meets_targets(spark, seed):
    rows = mix_rows(seed)
    docs = spark.createDataFrame([(*r, 1) for r in rows], MIX + ", size int")
    got = mixing.mix_sources(docs).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += n_words(t)
    targets, source = plain_targets(sizes), {i: s for i, _, s in rows}
    assert sorted(r["doc_id"] for r in got) == sorted(source)
    taken = defaultdict(int)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s]
        assert r["target"] == pytest.approx(targets[s], rel=1e-12)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        taken[s] += r["taken"]
    longest = max(r["size"] for r in got)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= longest / 2 + 1e-6
    again = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(docs.repartition(3)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}
    mixed = mixing.take_mix(docs)
    assert mixed.columns == docs.columns
    times = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert times == {r["doc_id"]: r["copies"] for r in got if r["copies"]}


def test_mix_thresholds_are_nested(spark):
    rows = [(i, "w " * (i % 9), "a" if i % 5 else "b") for i in range(300)]
    docs = spark.createDataFrame(rows, MIX)
    few = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(docs, weights=(1, 3)).collect()}
    many = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(docs, weights=(1, 1)).collect()}
    for i, (_, _, s) in enumerate(rows):
        assert (few[i] <= many[i]) if s == "a" else (few[i] >= many[i])


def test_mix_no_rows_one_source_repeated_ids(spark):
    assert mixing.mix_sources(spark.createDataFrame([], MIX)).count() == 0
    assert mixing.take_mix(spark.createDataFrame([], MIX)).count() == 0
    got = mixing.mix_sources(spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (None, "c", "s")], MIX))
    assert [r["copies"] for r in got.collect()] == [1, 1, 1]


# --- URLs -----------------------------------------------------------------------------------

RULES = [("org", "/", "allow"), ("Example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("b.example.org", "/en/1", "allow"), ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("net", "", "block")]


def plain_judge(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = host.lower() if host.isascii() else host
    fits = [(h.lower() + p, v) for h, p, v in RULES
            if host and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, "allow"))
    return host, path, rule, verdict


@pytest.mark.parametrize("max_bytes", [4 << 20, 32])
def test_urls_judged_by_longest_rule(spark, max_bytes):
    rng = random.Random(max_bytes)
    hosts = ["example.org", "B.example.org", "a.b.example.org", "org", "xorg", "x.com", "com", "net", "n.net.", ""]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12?q=/es/", "/fr/x#/de/", "/de/", "?/es/", "#x", "//"]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)]
    urls += [None, "", "no scheme", "a://b://org/", "://org/"]
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)], "page_id long, url string, key string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, rules, max_bytes=max_bytes).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == [plain_judge(u) for u in urls]


def test_urls_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(None, "http://a.org/x"), (1, None), (1, None)], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, rules, default="block").collect()
    assert len(got) == 3 and {r["verdict"] for r in got} == {"block"} and {r["rule"] for r in got} == {None}
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("h"), F.col("id").cast("string")).alias("key"))
    words = url_filter.bloom_filter(keys, max_bytes=1 << 13)
    assert words.nbytes <= 1 << 13
    assert keys.where(url_filter.maybe_listed(words, F.col("key"))).count() == 5000
    large = url_filter.bloom_filter(keys)
    others = spark.range(20_000).select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("key"))
    assert others.where(url_filter.maybe_listed(large, F.col("key"))).count() < 1000


# --- quality --------------------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    scored = quality.score_documents(docs, model).join(labels, "doc_id").where("held_out")
    rows = scored.select("predicted", "quality").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    assert len(rows) > 1000 and right > 0.98 and sum(good) / len(good) > 0.99


def test_quality_never_learns_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    changed = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    assert quality.fit(docs, labels) == quality.fit(docs, changed)
    for r in quality.score_documents(docs.limit(50), quality.fit(docs, labels)).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_quality_edge_rows(spark):
    docs = spark.createDataFrame(
        [(None, "words"), (1, None), (1, ""), (2, "x" * 300_000), (2, "x" * 300_000)], "doc_id long, text string"
    ).withColumn("score", F.lit("clash"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.score_documents(docs, quality.fit(docs, none)).collect()} == {0.5}
    few = spark.createDataFrame([(0, 1), (2, 0), (3, 1), (3, 0), (4, None), (None, 1)], "doc_id long, quality int")
    texts = spark.createDataFrame([(0, "good text here"), (2, "$$$ ### !!!"), (3, "both")], "doc_id long, text string")
    model = quality.fit(texts, few)
    scores = quality.score_documents(docs, model).collect()
    assert len(scores) == 5 and all(0 <= r["score"] <= 1 for r in scores)
    assert len({r["score"] for r in scores if r["doc_id"] == 2}) == 1
    assert quality.score_documents(docs.limit(0), model).count() == 0
    assert quality.keep_good(docs, model).columns == docs.columns


# --- registered queries and pipeline ----------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    expected = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert sorted(expected.columns) == columns
    at = [expected.columns.index(c) for c in columns]
    assert sorted(str([r[i] for i in at]) for r in expected.fetchall()) == sorted(
        str([r[c] for c in columns]) for r in got.collect()
    )


def test_every_operator_has_a_query():
    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES)
    assert numbers == list(range(1, 11))


def test_pipeline_stages_against_plain_versions(spark):
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    results = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = scratch.write(stage(spark, docs, SF), f"test_stage_{k}")
        results.append(docs)
    columns = results[0].columns
    rows = [r.collect() for r in results]
    assert all(r.columns == columns for r in results[:-1])
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(results[0], labels)
    good = {r["doc_id"] for r in quality.score_documents(results[0], model).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in rows[1]} == good
    last = {}
    for r in rows[1]:
        key = quality_lower(r["text"])
        last[key] = max(last.get(key, -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in rows[2]) == sorted(last.values())
    sets = {r["doc_id"]: shingle_set(r["text"]) for r in rows[2]}
    label = {i: i for i in sets}
    for _ in sets:
        before = dict(label)
        for a in sets:
            for b in sets:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if label == before:
            break
    assert sorted(r["doc_id"] for r in rows[3]) == sorted(set(label.values()))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(results[3]).collect()}
    times = defaultdict(int)
    for r in rows[4]:
        times[r["doc_id"]] += 1
    assert dict(times) == {i: c for i, c in copies.items() if c}
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    expected = []
    for r in rows[4]:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        expected.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in rows[5]) == sorted(expected)


def quality_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
