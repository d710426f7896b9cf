"""Periodic runs against a plain search of every period."""

import hashlib
import random
import zlib

import pytest

from tidemark.llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"


def plain_runs(t):
    n, out = len(t), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if t[i] != t[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and t[i] == t[i + q]:
                i += 1
            length = i - start + q
            part = t[start : start + length]
            if length >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(words):
    runs = plain_runs(words)
    top = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(runs), *top, 1000 * top[1] // top[2] if runs else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def plain_words(text):
    return [w.decode() for w in (text or "").encode().split()]


def plain_tail(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def sequence(rng):
    n, k = rng.randrange(60), rng.choice([1, 2, 2, 3, 4, 8])
    t = [rng.randrange(k) for _ in range(n)]
    if rng.random() < 0.5 and n > 8:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 4))
        t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
    if t and rng.random() < 0.3:
        u = list(t)
        u[rng.randrange(n)] = 9
        t = t + u + t
    return t


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_many_sequences(seed):
    rng = random.Random(seed)
    for _ in range(2500):
        t = sequence(rng)
        assert periodic_runs.find_runs(t) == plain_runs(t), t


def test_grammar_gives_the_text_back_and_repeats_no_pair():
    rng = random.Random(9)
    for _ in range(500):
        t = sequence(rng)
        if len(t) < 2:
            continue
        rules, rest = periodic_runs.re_pair(t, periodic_runs._next_pairs(periodic_runs.np.array(t)))
        spell = lambda s: [s] if s >= 0 else spell(rules[-1 - s][0]) + spell(rules[-1 - s][1])
        assert [w for _, s in rest for w in spell(s)] == t
        for k, (_, _, first, middle, end) in enumerate(rules):
            assert spell(-1 - k) == t[first:end] and spell(rules[k][0]) == t[first:middle]
        symbols = [s for _, s in rest]
        pairs = list(zip(symbols, symbols[1:], strict=False))
        for pair in set(pairs):  # repeated only where its occurrences overlap
            at = [i for i, p in enumerate(pairs) if p == pair]
            assert len(at) == 1 or (pair[0] == pair[1] and at == [at[0], at[0] + 1])


def test_most_frequent_pair_goes_first():
    t = [1, 2, 3, 1, 2, 4, 1, 2, 5, 3, 6, 3, 6]
    rules, _ = periodic_runs.re_pair(t, periodic_runs._next_pairs(periodic_runs.np.array(t)))
    assert rules[0][:2] == (1, 2) and {r[:2] for r in rules} == {(1, 2), (3, 6)}


@pytest.mark.parametrize("t", [[0] * 50_000, ([0] * 500 + [1]) * 40, [i % 7 for i in range(30_000)]])
def test_long_periodic_texts(t):
    got = periodic_runs.find_runs(t)
    if len(set(t)) != 2:
        assert got == [(0, len(t), len(set(t)))]
    else:
        assert got == sorted([(0, len(t), 501)] + [(501 * i, 500, 1) for i in range(40)], key=lambda r: (r[0], r[2]))


def test_query_on_given_documents(spark):
    got = queries.QUERIES["op11_periodic_runs"](spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {i: plain_row(plain_tail(i, plain_words(t))) for i, t in docs}
    assert {r["doc_id"]: tuple(r)[1:] for r in got.collect()} == want
    assert sum(r[0] for r in want.values()) > 10


def test_tails_of_all_lengths(spark):
    text = lambda i: " ".join(f"w{i % 5}{j % (3 + i % 4)}" for j in range(i % 40))
    rows = [(i, f" \t{text(i)}\n\n") for i in range(800)] + [(None, "a b c d"), (19, None)]
    tailed = periodic_runs.repeat_tails(queries.F.col("text"), queries.F.col("doc_id"))
    got = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", tailed.alias("text"), "text")
    got = [(r[0], plain_words(r[1]), plain_words(r[2])) for r in got.collect()]
    assert all(t == plain_tail(i, w) for i, t, w in got)
    assert sum(t != w for _, t, w in got) > 40


def test_odd_rows(spark):
    long_word, unusual = "x" * 300_000, "a b c d " * 6
    texts = [None, "", " \t\n", "one", "a a a a a a", "a a a a a", "ab c ab c ab c ab c", long_word, unusual, "ha " * 100_000]
    rows = [(i, t, i, "x", [1]) for i, t in enumerate(texts)] + [(4, texts[4], 4, "x", [1])] * 2 + [(None, "b " * 7, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Runs int, run_text string, extra array<int>")
    got = periodic_runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "text", "run_text", "extra", "n_words", "runs", "best", "collapsed"]
    got = got.collect()
    assert len(got) == len(rows) and sum(r["doc_id"] == 4 for r in got) == 3
    by_id = {r["doc_id"]: r for r in got}
    for i, t in enumerate(texts[:-1]):
        words = plain_words(t)
        assert by_id[i]["n_words"] == len(words)
        assert [tuple(r) for r in by_id[i]["runs"]] == plain_runs(words)
    assert [tuple(r) for r in by_id[9]["runs"]] == [(0, 100_000, 1)] and by_id[9]["collapsed"] == "ha"
    assert by_id[0]["collapsed"] == "" and by_id[0]["best"] is None
    assert by_id[None]["collapsed"] == "b" and by_id[None]["run_text"] is None
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []
    assert periodic_runs.run_report(docs.limit(0)).collect() == []


def test_best_run_is_exact_and_first_of_ties(spark):
    assert periodic_runs.best_run([(0, 12, 3), (5, 8, 2), (9, 6, 1), (20, 6, 1)]) == 2
    far = 10**15
    assert periodic_runs.best_run([(0, 4 * far, far), (1, 4 * far + 1, far)]) == 1
    assert periodic_runs.best_run([]) is None
