"""Exact, near, line and embedding deduplication against plain versions."""

import hashlib
import random
import re
import string
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, exact_dedup, grid_join, line_dedup, minhash
from tidemark.llm.common import Scratch, locate

DOCS = "doc_id long, text string"


def lower(text):
    return (text or "").translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


# --- exact ----------------------------------------------------------------------------------


def test_exact_dedup_edge_rows(spark):
    rows = [(1, "Same text"), (2, "same TEXT"), (3, None), (4, ""), (5, "ÄB"), (6, "äb"), (7, "x" * 50_000)]
    rows += [(8, "twice"), (8, "twice"), (None, "same text"), (9, "ÄB")]
    docs = spark.createDataFrame(rows, DOCS)
    docs = docs.withColumn("kept", F.lit("clash")).withColumn("place", F.lit(0))
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_digest[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max(i for i in ids if i is not None)
    # Exactly one row of each group stays, also of repeated rows.
    assert sum(r["kept"] for r in got) == len(groups)
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(
        max(i for i in ids if i is not None) for ids in groups.values()
    )


def test_exact_dedup_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert exact_dedup.exact_dedup(docs).count() == 0
    assert exact_dedup.drop_exact_copies(docs).count() == 0


def test_exact_dedup_compares_bytes_of_digest_hits(spark, monkeypatch):
    whole = F.sha2
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, bits: F.substring(whole(c, bits), 1, 1))
    rows = [(i, f"text {i % 40}") for i in range(100)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, DOCS)).collect()
    for r in got:
        ids = [i for i, _ in rows if i % 40 == r["doc_id"] % 40]
        assert (r["keep_id"], r["group_size"]) == (max(ids), len(ids))


def test_exact_dedup_large_group_uses_replicas(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "COPIES_PER_REPLICA", 7)
    rows = [(i, "hot" if i % 3 else f"own {i}") for i in range(300)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, DOCS)).where("text_sha256 is not null")
    hot = got.where("group_size > 1").collect()
    assert len(hot) == 200 and {r["keep_id"] for r in hot} == {299}


@pytest.mark.parametrize("most_rows", [1, 1 << 14])
def test_split_by_hits_loses_no_hit(spark, tmp_dir, monkeypatch, most_rows):
    monkeypatch.setattr(common, "HIT_ROWS", most_rows)
    rows = spark.range(20_000).selectExpr("id as key", "id % 7 as hit_row", "'x' as hit_bits")
    scratch = Scratch(spark)
    for name, cond, n in (("some", "key % 10 = 0", 2000), ("none", "key < 0", 0), ("all", "true", 20_000)):
        hits = scratch.write(rows.where(cond).select("key"), name)
        likely, clean = common.split_by_hits(rows, hits, "key", scratch, f"{name}_bits")
        assert likely.columns == clean.columns == rows.columns
        assert likely.unionByName(clean).distinct().count() == 20_000
        assert clean.where(cond).count() == 0 and likely.where(cond).count() == n
        # 64 bits to a hit let few others through; a full table lets more.
        assert likely.where(f"not ({cond})").count() <= (600 if most_rows > 1 else 2000)


def test_dropped_copies_leave_clean_rows_and_columns(spark):
    rows = [(i, "copy" if i % 3 == 0 else f"own text of row {i}", i) for i in range(90)]
    docs = spark.createDataFrame(rows + [(None, None, 1), (None, None, 1)], "doc_id long, text string, hit_row int")
    got = exact_dedup.drop_exact_copies(docs)
    assert got.columns == docs.columns
    assert sorted((r[0] or -1, r[1] or "") for r in got.collect()) == sorted(
        [(i, t) for i, t, _ in rows if t != "copy"] + [(87, "copy"), (-1, "")]
    )


def test_rows_exploded_from_stored_rows_have_places_of_their_own(spark, tmp_dir):
    path = f"{tmp_dir}/docs"
    line = "one two three four five six seven"
    rows = [(1, [line, line, "own words of the first row here"]), (2, [line, "own words of the second row here"])]
    spark.createDataFrame(rows, "doc_id long, parts array<string>").coalesce(1).write.parquet(path)
    stored = spark.read.parquet(path)
    passages = stored.select("doc_id", F.explode("parts").alias("text"))
    expected = sorted([line, rows[0][1][2], rows[1][1][1]])
    assert sorted(r["text"] for r in exact_dedup.drop_exact_copies(passages).collect()) == expected
    assert sorted(r["text"] for r in minhash.drop_near_copies(passages).collect()) == expected
    left = [r["text"] for r in line_dedup.drop_repeated_lines(passages).collect()]
    assert sorted(t for t in left if t) == expected and len(left) == 5
    for frame in (passages, stored.sample(True, 3.0, 1), stored):
        placed = locate(frame, Scratch(spark), "place")
        assert placed.select("place").distinct().count() == placed.count() > 0
    # A plain read, also of some columns and rows, is not written again.
    part = stored.where("doc_id > 1").select("doc_id")
    assert locate(part, Scratch(spark), "place").inputFiles() == stored.inputFiles()


# --- near -----------------------------------------------------------------------------------


def components_of(n, links):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def plain_near(texts):
    sets = [minhash.shingle_set(t or "") for t in texts]
    links = [
        (i, j)
        for j in range(len(sets))
        for i in range(j)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    return [len(s) for s in sets], components_of(len(sets), links)


def near_texts(seed):
    """Chains of copies in which each differs from the next by a word, so that the ends of
    a chain are not alike, and texts that share a passage."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices(string.ascii_lowercase, k=5)) for _ in range(3000)]
    texts = ["", None, "one", "ONE", "two words", " \t\n", "a b c d", "A b C d"]
    passage = rng.choices(vocabulary, k=60)
    for _ in range(6):
        words = rng.choices(vocabulary, k=rng.randint(30, 90))
        for step in range(rng.randint(1, 18)):
            if step:
                words = list(words)
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    texts += [" ".join(rng.choices(vocabulary, k=40) + passage) for _ in range(6)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [256, 3])
def test_near_dedup_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    texts = near_texts(block)
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS + ", key string")
    got = minhash.near_dedup(docs).orderBy("doc_id").collect()
    sizes, component = plain_near(texts)
    assert [r["n_shingles"] for r in got] == sizes
    assert [r["component_id"] for r in got] == component
    assert [r["kept"] for r in got] == [i == c for i, c in enumerate(component)]
    kept = minhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(component))


def test_near_dedup_block_comparison_alone_finds_all(spark, monkeypatch):
    """With no pairs of heads every link must come from the comparison across components."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    texts = near_texts(11)
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    rows = minhash.sketch(docs.select(F.struct(F.lit("f").alias("file"), F.col("doc_id").alias("row")).alias("place"), F.col("doc_id").alias("id"), "text"))
    classes = rows.where("key is not null").dropDuplicates(["key"])
    members = classes.select(F.lit(0).cast("long").alias("bucket"), "key", F.lit(classes.count()).alias("n"))
    none = spark.createDataFrame([], "node binary, label binary")
    met = minhash._meetings(members, none)
    by_key = spark.createDataFrame([(bytes(r["key"]), texts[r["id"]]) for r in classes.collect()], "key binary, text string")
    found = [(bytes(r["a"]), bytes(r["b"])) for r in minhash._across(met, classes, by_key).collect()]
    sets = {bytes(r["key"]): minhash.shingle_set(texts[r["id"]]) for r in classes.collect()}
    keys = sorted(sets)
    links = [
        (i, j)
        for j, b in enumerate(keys)
        for i, a in enumerate(keys[:j])
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    at = {k: i for i, k in enumerate(keys)}
    assert {(at[a], at[b]) for a, b in found} <= set(links)
    assert components_of(len(keys), [(at[a], at[b]) for a, b in found]) == components_of(len(keys), links)


def test_near_dedup_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (5, text), (5, text), (3, text + " more"), (None, "alone in the world it stands")]
    got = minhash.near_dedup(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in got) == [
        ("3", "3", True), ("5", "3", False), ("5", "3", False), ("None", "3", False), ("None", "None", True)
    ]
    assert minhash.drop_near_copies(spark.createDataFrame(rows, DOCS)).count() == 2
    assert minhash.near_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_least_matches_keeps_pairs_at_the_threshold():
    """Simulated pairs at the threshold are hardly ever dropped; unlike pairs nearly always."""
    rng = np.random.default_rng(1)
    least = minhash.least_matches()
    left = np.zeros((20_000, minhash.HASHES), np.uint32)

    def survivors(similarity):
        right = (rng.random(left.shape) >= similarity).astype(np.uint32)
        return len(minhash.still_possible(left, right, least)) / len(left)

    assert survivors(0.75) > 0.9995
    assert survivors(0.3) < 0.001


# --- lines ----------------------------------------------------------------------------------


def plain_lines(texts):
    index, sets, out = defaultdict(list), [], []
    for text in texts:
        removed = []
        for i, line in enumerate((text or "").split("\n")):
            words = [w for w in re.split(r"[ \t\n\x0B\f\r]+", line.lower()) if w]
            if not words:
                continue
            own = {tuple(words)} if len(words) < 5 else set(zip(*[words[k:] for k in range(5)], strict=False))
            if any(4 * len(own & sets[j]) >= 3 * len(own | sets[j]) for j in {j for x in own for j in index[x]}):
                removed.append(i)
            for x in own:
                index[x].append(len(sets))
            sets.append(own)
        out.append(removed)
    return out


def line_texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 30))] for _ in range(25)]
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            words = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            line = rng.choice([" ", "\t", "  "]).join(words)
            lines.append(rng.choice([line, line.upper(), "  " + line, ""]))
        texts.append("\n".join(lines))
    patterns = [" ".join(["*"] * n) for n in (5, 7, 4, 6)]
    patterns += ["|" + " --- |" * n for n in (3, 4, 2)] + ["ha ho " * 3, "ho ha " * 4, "ha ho ha ho ha"]
    return [*texts, None, "", texts[0], texts[0], "\n".join(patterns), *rng.sample(patterns, 4)]


def test_lines_that_repeat_a_pattern_match_at_any_length(spark):
    lines = ["* * * * *", "* * * * * * *", "* * * *", "| --- | --- | --- |", "| --- | --- | --- | --- |"]
    lines += ["ha ho ha ho ha ho", "ho ha ho ha ho ha", "ha ho ha ho ha"]
    got = line_dedup.repeated_lines(spark.createDataFrame([(1, "\n".join(lines))], DOCS)).collect()
    assert got[0]["removed_lines"] == [1, 4, 6] == plain_lines(["\n".join(lines)])[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_lines_equal_all_pairs(spark, tmp_dir, seed):
    texts = line_texts(seed)
    path = f"{tmp_dir}/docs"
    spark.createDataFrame(list(enumerate(texts)), DOCS).withColumn("line", F.lit(1)).coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    stored = [r["text"] for r in docs.collect()]
    ids = [r["doc_id"] for r in docs.collect()]
    expected = dict(zip(ids, plain_lines(stored), strict=True))
    got = {r["doc_id"]: r for r in line_dedup.repeated_lines(docs).collect()}
    assert {i: list(r["removed_lines"]) for i, r in got.items()} == expected
    for i, text in zip(ids, stored, strict=True):
        assert got[i]["n_lines"] == len((text or "").split("\n"))
        assert got[i]["n_removed"] == len(expected[i])
    cleaned = line_dedup.drop_repeated_lines(docs)
    assert cleaned.columns == docs.columns
    for r in cleaned.collect():
        lines = (stored[ids.index(r["doc_id"])] or "").split("\n")
        gone = expected[r["doc_id"]]
        left = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        assert (r["text"] or "") == left


@pytest.mark.parametrize("block", [2, 5])
def test_large_groups_of_lines_are_compared_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    monkeypatch.setattr(line_dedup, "MEMBERS", block)
    texts = ["\n".join(filter(None, line_texts(3)))]
    # Every shingle of a base stands alone before it, so that no like line is its token's first.
    base = [f"b{k}" for k in range(24)]
    texts.append("\n".join(" ".join(base[k : k + 5]) for k in range(20)))
    texts += [" ".join([*base, f"end{k}"]) for k in range(9)]
    texts += [" ".join([f"other{k}", *base[:12], f"own{k}", *base[12:]]) for k in range(9)]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).coalesce(1)
    made = []
    whole = line_dedup._match_in_blocks

    def counted(*args):
        out = whole(*args)
        made.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "_match_in_blocks", counted)
    got = {r["doc_id"]: r["removed_lines"] for r in line_dedup.repeated_lines(docs).collect()}
    assert got == dict(enumerate(plain_lines(texts)))
    assert made[0] > 0


def test_prefix_rows_are_made_for_anchors_not_for_each_token(spark):
    rng = random.Random(5)
    lines = [" ".join(rng.sample([f"w{k}" for k in range(3000)], 60)) for _ in range(40)]
    classes = spark.createDataFrame([(1, k, x) for k, x in enumerate(lines)], "doc long, line int, content string")
    rows = line_dedup._prefixes(classes, line_dedup._rarity(classes)).collect()
    # A prefix of 15 tokens each.
    assert len({r["line"] for r in rows}) == len(lines)
    assert len(rows) <= 9 * len(lines)


def test_pairs_take_short_hashes_along_and_lose_no_match(spark, monkeypatch):
    words = [f"w{k}" for k in range(60)]
    # The last ones match the first at the limit (48 of 64 tokens) and just not (47 of 65).
    ends = [f"x{k}" for k in range(9)]
    texts = [" ".join(words), " ".join([*words[:52], *ends[:8]]), " ".join([*words[:51], *ends])]
    lines = spark.createDataFrame([(1, k, x) for k, x in enumerate(texts)], "doc long, line int, content string")
    pairs = spark.createDataFrame([(1, k, 1, 0) for k in (1, 2)], "doc long, line int, to_doc long, to_line int")
    types, both = [], line_dedup._with_both

    def recorded(pairs, lines, column):
        types.append(lines.schema[column].dataType.simpleString())
        return both(pairs, lines, column)

    monkeypatch.setattr(line_dedup, "_with_both", recorded)
    with Scratch(spark) as scratch:
        likely = scratch.write(line_dedup._likely(pairs, lines, scratch, "some"), "likely")
        assert (1, 1, 1, 0) in [tuple(r) for r in likely.select("doc", "line", "to_doc", "to_line").collect()]
        found = line_dedup._verify(likely, lines, scratch, "some").collect()
    assert [r["line"] for r in found] == [1]
    assert types == ["array<int>", "string"]


@pytest.mark.parametrize("seed", [4, 5])
def test_matching_lines_share_an_anchor_that_the_filters_keep(spark, seed):
    texts = "\n".join(filter(None, line_texts(seed))).lower().split("\n")
    lines = sorted({" ".join(x.split()) for x in texts if len(x.split()) >= 5})
    sets = [set(zip(*[x.split()[k:] for k in range(5)], strict=False)) for x in lines]
    matching = {
        (i, j) for j in range(len(lines)) for i in range(j) if 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])
    }
    classes = spark.createDataFrame([(1, k, x) for k, x in enumerate(lines)], "doc long, line int, content string")
    rows = line_dedup._prefixes(classes, line_dedup._rarity(classes)).cache()
    names = ("line", "size", "most", "pos")
    a, b = (rows.select("token", *[F.col(c).alias(x + c) for c in names]) for x in ("a_", "b_"))
    kept = a.join(b, "token").where("a_line < b_line").where(line_dedup._may_match("a_", "b_"))
    assert matching and matching <= {(r["a_line"], r["b_line"]) for r in kept.collect()}


def test_repeated_lines_empty_table_and_null_ids(spark):
    assert line_dedup.repeated_lines(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "some words that stand in a line"), (None, "some words that stand in a line")]
    got = line_dedup.repeated_lines(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r["n_removed"] for r in got) == [0, 1]


# --- embeddings -----------------------------------------------------------------------------


def vector_rows(seed, n=300, d=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, d))
    rows = []
    for i in range(n):
        v = centres[rng.integers(30)] + rng.normal(scale=rng.choice([0.02, 0.2, 1.0]), size=d)
        rows.append((i, [float(x) for x in v * rng.uniform(0.1, 10)]))
    rows += [(n + i, list(rows[i][1])) for i in range(20)]  # exact copies
    rows += [(n + 30, None), (n + 31, [0.0] * d), (n + 32, [float("nan")] + [1.0] * (d - 1)), (n + 33, [])]
    rows += [(n + 34, [None] + [1.0] * (d - 1)), (n + 35, [float("inf")] * d), (n + 36, rows[0][1][: d - 1])]
    rows += [(n + 37, [1e300] * d), (n + 38, [1e-300] * d), (n + 39, rows[0][1][: d - 1])]
    return rows


def plain_cosine(rows):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v) / np.abs(v).max()
        return a / np.sqrt((a * a).sum())

    units = [unit(v) for _, v in rows]
    links = [
        (i, j)
        for j in range(len(rows))
        for i in range(j)
        if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j])
        and float(units[i] @ units[j]) >= 0.95
    ]
    degree = [0] * len(rows)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return degree, components_of(len(rows), links)


@pytest.mark.parametrize(("block", "leaf"), [(4096, 128), (16, 4)])
def test_cosine_links_equal_all_pairs(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(grid_join, "LEAF", leaf)
    rows = vector_rows(block)
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, key int")
    got = grid_join.cosine_links(vectors, block=block).orderBy("vec_id").collect()
    degree, component = plain_cosine(rows)
    ids = [i for i, _ in rows]
    assert [r["vec_id"] for r in got] == ids
    assert [r["n_links"] for r in got] == degree
    assert [r["component_id"] for r in got] == [ids[c] for c in component]
    assert [r["kept"] for r in got] == [ids[c] == i for c, i in zip(component, ids, strict=True)]


def test_cosine_links_empty_and_null_ids(spark):
    schema = "vec_id long, embedding array<float>"
    assert grid_join.cosine_links(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0]), (4, [2.0, 0.0]), (4, [2.0, 0.0]), (None, None)]
    got = grid_join.cosine_links(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got) == [
        ("4", 2, "4"), ("4", 2, "4"), ("None", 0, "None"), ("None", 2, "4")
    ]
