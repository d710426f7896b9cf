"""Line deduplication by an exact set-similarity join.

A line's tokens are its distinct shingles of five words (lower-cased words between blanks;
a line of fewer words has its whole sequence as one token). Two lines match when the Jaccard
similarity of their tokens is at least 0.75. A line is removed when a line before it matches
it; lines are ordered by where their document is stored (file, row) and their number. Lines
without words are never removed.

* Lines with equal words form one class; only its first line can stay. Classes of lines of
  fewer than five words match no other; all others are compared, also those of one or two
  tokens (lines that repeat a word or two have equal tokens at any length).
* A token's anchor is, of the three runs of three words in it, the one whose first word is the
  rarest (counts of all words in a table of hashed buckets; hashes decide between equals).
  Tokens are ordered by their anchors, so that the first ones of a line share a few anchors:
  three words stand in up to three neighbouring tokens. Matching classes share one of their first
  ``size // 4 + 1`` tokens (prefix filter), so also its anchor; their sizes differ by a quarter
  at most (length filter), and the tokens from the shared anchor on are enough for the overlap
  they need (positional filter). A line has a row for each anchor of its prefix, not one for
  each token of it.
* Of classes that share an anchor, each is compared with the first. Classes that match
  are done with. Of the others, those of an anchor with at most ``BLOCK`` lines are paired with
  what else comes before them.
* The lines of anchors with more lines, where any are open, get new prefixes: by the real
  counts of all their tokens (a written table, joined by token). What still shares a prefix
  token meets in blocks of bounded size, without a row for each pair.
* Pairs are verified on their full token sets, word by word.

Null and empty texts are one line without words. Ids may be null or repeated: documents are
told apart by where they are stored, and of repeated rows the first keeps its lines. Extra
columns are ignored by ``repeated_lines`` and kept by ``drop_repeated_lines``; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import Scratch, array_literal, fresh, locate, split_by_hits

SHINGLE = 5
# Jaccard 3/4: the sizes' ratio is at least that, and the overlap 3/7 of their sum.
RARITY_BITS = 16
# An order code is a long: rank of a word, its hash mixed with the next two's, the token's hash.
HASH_BITS = 48  # below the rank
TOKEN_BITS = 20  # of them the token's own
# Every run of SHINGLE words (possessive: a word has no second way to match), found one by one.
SHINGLE_RUN = r"(?=(" + " ".join([r"[^ ]++"] * SHINGLE) + r"))[^ ]++"
ODD_SPACE = r"[ \t\n\x0B\f\r]{2,}|[\t\n\x0B\f\r]"
ROW_BITS = 40  # rows of one file
FILES = 100_000  # file names that are broadcast
BLOCK = 128  # lines of a token that are paired at most
MEMBERS = 8 * BLOCK  # of a block of a larger token's lines


def _number_documents(
    docs: DataFrame, place: str, name: str, scratch: Scratch, keep: bool = False
) -> DataFrame:
    """A number per document that follows the order of storage (one row per file is ranked).
    The table of files is broadcast up to FILES rows, so that no text is shuffled for it."""
    file, at = fresh(docs, "file"), fresh(docs, "at")
    files = docs.select(F.col(f"{place}.file").alias(file)).distinct()
    files = files.withColumn(at, F.row_number().over(Window.orderBy(file)).cast("long"))
    files = scratch.write(files, "files", keep)
    if files.count() <= FILES:
        files = F.broadcast(files)
    number = F.shiftleft(at, ROW_BITS).bitwiseOR(F.col(f"{place}.row"))
    return (
        docs.join(files, F.col(f"{place}.file") == F.col(file))
        .withColumn(name, number)
        .drop(file, at, place)
    )


def _split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, text) -> (doc, line, content, key): lines with words; content joins the words."""
    # Outer generators here and below: for a plain one the optimizer adds a filter on its
    # input, with all that computes the array a second time.
    lines = docs.select("doc", F.posexplode_outer(_split_lines(F.col("text"))).alias("line", "raw"))
    # Only stretches that are not one blank are looked for: most lines stay as they are.
    odd = F.contains("raw", F.lit("  "))
    for space in "\t\x0b\f\r":
        odd = odd | F.contains("raw", F.lit(space))
    lower = F.lower("raw")
    content = F.trim(F.when(odd, F.regexp_replace(lower, ODD_SPACE, " ")).otherwise(lower)).alias("content")
    return (
        lines.where(F.col("raw").rlike(r"[^ \t\n\x0B\f\r]"))
        .select("doc", "line", content)
        .withColumn("key", F.unhex(F.md5("content")))
    )


def _runs(parts: Column, width: int) -> Column:
    """An array of structs: the ``width`` neighbours from each element on that has so many."""
    starts = F.size(parts) - (width - 1)
    return F.arrays_zip(*[F.slice(parts, F.lit(k + 1), starts).alias(f"w{k}") for k in range(width)])


def _with_hashes(
    rows: DataFrame, content: str, tokens: str, hashed: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """Add a line's distinct tokens as hashes (of the words' 64-bit hashes). The words are a
    column of their own first, so that they are split once a line and not once a token."""
    parts = fresh(rows, "parts")
    words = F.transform(F.split(F.col(content), " "), lambda w: F.xxhash64(w))
    many = F.transform(_runs(F.col(parts), SHINGLE), lambda run: hashed(run))
    return (
        rows.withColumn(parts, words)
        .withColumn(
            tokens,
            F.array_distinct(F.when(F.size(parts) >= SHINGLE, many).otherwise(F.array(hashed(F.col(parts))))),
        )
        .drop(parts)
    )


def _shingles(content: str) -> Column:
    """The tokens of a line of at least SHINGLE words in full, in order, with repeats."""
    return F.regexp_extract_all(content, F.lit(SHINGLE_RUN), F.lit(1))


def _long(classes: DataFrame) -> DataFrame:
    """The classes of lines with a whole shingle; shorter lines match equal ones only."""
    return classes.where(F.size(F.split("content", " ", SHINGLE)) == SHINGLE)


def _rarity(lines: DataFrame) -> Column:
    """An array of ranks by hash bucket (1 << RARITY_BITS numbers, whatever the input): a
    larger rank is a more frequent bucket of words."""
    words = lines.select(F.explode_outer(F.split("content", " ")).alias("word"))
    words = words.select(F.xxhash64("word").alias("h"))
    rank = F.round(F.log2(F.count(F.lit(1))) * 500).cast("long")  # below 1 << (63 - HASH_BITS)
    found = words.groupBy(_bucket(F.col("h")).alias("bucket")).agg(rank.alias("rank")).collect()
    ranks = [0] * (1 << RARITY_BITS)
    for row in found:
        ranks[row["bucket"]] = row["rank"]
    return array_literal(ranks, "long")


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - RARITY_BITS)


def _prefixes(classes: DataFrame, ranks: Column) -> DataFrame:
    """(doc, line, content) -> a row per anchor of the prefix: token (the anchor), doc, line,
    pos (distinct tokens before it) and the size's bounds: size (tokens whose codes differ)
    and most (never more than the tokens with repeats). Both are the size for a line that
    repeats no token and has none whose codes collide."""
    low, own = (1 << HASH_BITS) - 1, (1 << TOKEN_BITS) - 1

    def word(h: Column) -> Column:
        return F.shiftleft(F.get(ranks, _bucket(h).cast("int")), HASH_BITS).bitwiseOR(h.bitwiseAND(F.lit(low)))

    def joined(parts: Column, shift: int) -> Column:
        # The rank stays that of the first word.
        firsts, seconds = (F.slice(parts, F.lit(k), F.size(parts) - 1) for k in (1, 2))
        return F.zip_with(
            firsts, seconds, lambda x, y: x.bitwiseXOR(F.shiftright(y.bitwiseAND(F.lit(low)), shift))
        )

    def code(run: Column) -> Column:
        anchor = F.least(*[run[f"w{k}"] for k in range(SHINGLE - 2)]).bitwiseAND(F.lit(~own))
        # Never null, but Spark sorts long integers faster where it knows that.
        return F.coalesce(anchor.bitwiseOR(F.xxhash64(run).bitwiseAND(F.lit(own))), F.lit(0))

    words = F.transform(F.split("content", " "), lambda w: F.xxhash64(w))
    ordered = (
        classes.select("doc", "line", words.alias("hashes"))
        .select("doc", "line", F.transform("hashes", word).alias("words"))
        .select("doc", "line", joined(F.col("words"), 1).alias("pairs"))
        .select("doc", "line", joined(F.col("pairs"), 2).alias("triples"))
        .select("doc", "line", F.transform(_runs(F.col("triples"), SHINGLE - 2), code).alias("codes"))
        .select("doc", "line", F.size("codes").alias("n"), F.sort_array(F.array_distinct("codes")).alias("codes"))
        .select("doc", "line", "n", F.size("codes").alias("size"), "codes")
    )
    # Far more than collide where TOKEN_BITS tell the tokens of an anchor apart; none are given
    # away where a line repeats none.
    spare = F.when(F.col("size") < 1 << (TOKEN_BITS - 6), F.col("size") + 2 + F.shiftright("size", 3))
    ordered = ordered.withColumn("most", F.least("n", F.coalesce(spare, F.col("n"))))
    first = F.slice("codes", F.lit(1), F.shiftright("most", 2) + 1)
    before = F.slice(F.concat(F.array(F.lit(-1).cast("long")), F.col("codes")), F.lit(1), F.size("first"))
    rows = (
        ordered.select("doc", "line", "size", "most", "codes", first.alias("first"))
        .select("doc", "line", "size", "most", "first", before.alias("before"))
        .select("doc", "line", "size", "most", F.arrays_zip("first", "before").alias("prefix"))
        .select("doc", "line", "size", "most", F.posexplode_outer("prefix").alias("pos", "at"))
    )
    anchor = F.shiftright("at.first", TOKEN_BITS)
    return rows.where(anchor != F.shiftright("at.before", TOKEN_BITS)).select(
        anchor.alias("token"), "doc", "line", "size", "most", "pos"
    )


def _length_filter(a: Column, b: Column) -> Column:
    return F.least(a, b) * 4 >= F.greatest(a, b) * 3


def _position_filter(size: Column, pos: Column, to_size: Column, to_pos: Column) -> Column:
    return F.least(size - pos, to_size - to_pos) * 7 >= (size + to_size) * 3


def _may_match(a: str, b: str) -> Column:
    """The filters between rows of ``_prefixes`` with the columns' prefixes ``a`` and ``b``. They
    hold for the anchor of the first token that two matching lines share."""
    size, most, pos = (F.col(a + c) for c in ("size", "most", "pos"))
    to_size, to_most, to_pos = (F.col(b + c) for c in ("size", "most", "pos"))
    lengths = (most * 4 >= to_size * 3) & (to_most * 4 >= size * 3)
    return lengths & (F.least(most - pos, to_most - to_pos) * 7 >= (size + to_size) * 3)


def _prefixes_by_count(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """Like ``_prefixes``, with tokens ordered by their counts in these lines. Tokens of one
    line only come first and give no row."""
    sets = _with_hashes(lines.select("doc", "line", "content"), "content", "tokens").select(
        "doc", "line", F.size("tokens").alias("size"), F.explode_outer("tokens").alias("h")
    )
    sets = scratch.write(sets, "tokens")
    counts = scratch.write(sets.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "counts")
    ordered = (
        sets.join(counts, "h")
        .groupBy("doc", "line", "size")
        .agg(F.sort_array(F.collect_list(F.struct("n", "h"))).alias("tokens"))
        .withColumn("single", F.col("size") - F.size("tokens"))
    )
    some = F.greatest((F.col("size") / 4).cast("int") + 1 - F.col("single"), F.lit(0))
    prefix = F.posexplode(F.slice("tokens", F.lit(1), some)).alias("at", "token")
    return ordered.select("doc", "line", "size", "single", prefix).select(
        F.col("token.h").alias("token"), "doc", "line", "size", (F.col("single") + F.col("at")).alias("pos")
    )


def _match_in_blocks(prefixes: DataFrame, lines: DataFrame, scratch: Scratch) -> DataFrame:
    """The open ones of ``lines`` that match a line before them. The members of a token are
    cut into blocks of about MEMBERS; every two blocks meet in a group (token, r, o) of their
    own, which is compared as it is, so that no row is made for a pair."""
    members = scratch.write(prefixes.join(lines.select("doc", "line", "open"), ["doc", "line"]), "members")
    blocks = (
        members.groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or("open").alias("any"))
        .where("n > 1 and any")
        .select("token", F.ceil(F.col("n") / MEMBERS).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("doc", "line"), F.col("blocks")).cast("int")
    meetings = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda r: F.struct(F.least(r, F.col("own")).alias("r"), F.greatest(r, F.col("own")).alias("o")),
    )
    met = (
        members.join(blocks, "token")
        .withColumn("own", own)
        .select(*members.columns, "own", F.explode(meetings).alias("meeting"))
        .join(lines.select("doc", "line", "content"), ["doc", "line"])
        .select("token", "meeting.r", "meeting.o", "doc", "line", "size", "pos", "open", "own", "content")
        .repartition("token", "r", "o")
    )
    member = F.struct("doc", "line", "size", "pos", "open", "own", "set")
    groups = met.withColumn("set", F.array_distinct(_shingles("content"))).groupBy("token", "r", "o")
    groups = groups.agg(F.collect_list(member).alias("all"))

    def matches(x: Column, y: Column) -> Column:
        both = F.size(F.array_intersect(x["set"], y["set"]))
        return (
            ((y["doc"] < x["doc"]) | ((y["doc"] == x["doc"]) & (y["line"] < x["line"])))
            & ((F.col("r") == F.col("o")) | (x["own"] != y["own"]))
            & _length_filter(x["size"], y["size"])
            & _position_filter(x["size"], x["pos"], y["size"], y["pos"])
            & (both * 4 >= (F.size(x["set"]) + F.size(y["set"]) - both) * 3)
        )

    found = F.filter("all", lambda x: x["open"] & F.exists("all", lambda y: matches(x, y)))
    return (
        groups.select(F.explode_outer(F.transform(found, lambda x: F.struct(x["doc"].alias("doc"), x["line"].alias("line")))).alias("x"))
        .where("x is not null")
        .select("x.doc", "x.line")
        .distinct()
    )


def _placed_in(lines: DataFrame, places: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The lines (doc, line, content) that may be at one of ``places``; a bounded table of bits
    tells, so that the others are not shuffled."""
    placed = lines.select("doc", "line", "content").withColumn("place", F.struct("doc", "line"))
    found, _ = split_by_hits(placed, places, "place", scratch, name)
    return found.select("doc", "line", "content")


def _places(pairs: DataFrame) -> DataFrame:
    to_place = F.struct(F.col("to_doc").alias("doc"), F.col("to_line").alias("line"))
    return pairs.select(F.struct("doc", "line").alias("place")).unionByName(pairs.select(to_place.alias("place")))


def _with_both(pairs: DataFrame, lines: DataFrame, column: str) -> DataFrame:
    """Add ``column`` of both lines of a pair, as ``a`` and ``b``. One shuffle of the lines
    serves both joins."""
    dealt = lines.select("doc", "line", column).repartition("doc", "line")
    left = dealt.withColumnRenamed(column, "a")
    right = dealt.select(F.col("doc").alias("to_doc"), F.col("line").alias("to_line"), F.col(column).alias("b"))
    return pairs.join(left, ["doc", "line"]).join(right, ["to_doc", "to_line"])


def _likely(pairs: DataFrame, lines: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Of pairs those that may match by their lines' hashed tokens, which are made once a line
    and not once a pair. The hashes have 32 bits, as every pair takes them along. Some tokens
    are given away, far more than may have the hash of another of the line."""
    pairs = scratch.write(pairs, f"{name}_all")
    found = _placed_in(lines, _places(pairs), scratch, f"{name}_all_bits")
    sets = _with_both(pairs, _with_hashes(found, "content", "set", F.hash), "set")
    spare = F.shiftright(F.size("a"), 10) + 2
    may = (F.size(F.array_intersect("a", "b")) + spare) * 4 >= F.size(F.array_union("a", "b")) * 3
    return sets.select(*pairs.columns, may.alias("may")).where("may").drop("may")


def _verify(pairs: DataFrame, lines: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Of pairs (doc, line; to_doc, to_line) those whose lines match."""
    pairs = scratch.write(pairs, f"{name}_pairs")
    found = _placed_in(lines, _places(pairs), scratch, f"{name}_bits")
    texts = _with_both(pairs, found, "content")
    sets = texts.select("doc", "line", _shingles("a").alias("a"), _shingles("b").alias("b"))
    match = F.size(F.array_intersect("a", "b")) * 4 >= F.size(F.array_union("a", "b")) * 3
    # The filter stays above the aggregate: pushed below the projections it would compute the
    # sets again for every use of them.
    return (
        sets.select("doc", "line", match.alias("match"))
        .groupBy("doc", "line")
        .agg(F.bool_or("match").alias("match"))
        .where("match")
        .select("doc", "line")
    )


def _decide(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc, text) -> (doc, removed): the numbers of the lines that go, where any do."""
    lines = scratch.write(_lines(docs), "lines")
    groups = lines.groupBy("key").agg(F.min(F.struct("doc", "line")).alias("first"), F.count(F.lit(1)).alias("n"))
    groups = scratch.write(groups.where("n > 1").select("key", "first"), "groups")
    # Only the texts of lines that may have copies are shuffled.
    some, alone = split_by_hits(lines, groups, "key", scratch, "group_bits")
    is_copy = F.coalesce(F.struct("doc", "line") != F.col("first"), F.lit(False))
    some = some.join(groups, "key", "left").withColumn("copy", is_copy)
    copies = scratch.write(some.where("copy").select("doc", "line"), "copies")
    classes = alone.select("doc", "line", "content").unionByName(
        some.where("not copy").select("doc", "line", "content")
    )
    # The prefixes are shuffled by token once, for the first class of a token and for all.
    dealt = _prefixes(_long(classes), _rarity(_long(lines))).repartition("token")
    heads = (
        dealt.groupBy("token")
        .agg(F.min(F.struct("doc", "line", "size", "most", "pos")).alias("head"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    shared = scratch.write(dealt.join(heads, "token"), "shared")
    later = shared.where((F.col("doc") != F.col("head.doc")) | (F.col("line") != F.col("head.line")))
    with_head = later.where(_may_match("", "head.")).select(
        "doc", "line", F.col("head.doc").alias("to_doc"), F.col("head.line").alias("to_line")
    )
    removed = scratch.write(_verify(with_head.distinct(), lines, scratch, "head"), "removed")

    rest = later.where("n > 2").select("token", "doc", "line", "size", "most", "pos", "n")
    open_rows = rest.join(removed, ["doc", "line"], "left_anti")
    small = rest.where(F.col("n") <= BLOCK)
    before = small.select("token", *[F.col(c).alias("to_" + c) for c in ("doc", "line", "size", "most", "pos")])
    pairs = (
        open_rows.where(F.col("n") <= BLOCK)
        .join(before, "token")
        .where(F.struct("to_doc", "to_line") < F.struct("doc", "line"))
        .where(_may_match("", "to_"))
        .select("doc", "line", "to_doc", "to_line")
        .distinct()
    )
    likely = _likely(pairs, lines, scratch, "other")
    more = scratch.write(_verify(likely, lines, scratch, "other"), "more")

    large = scratch.write(open_rows.where(F.col("n") > BLOCK).select("token").distinct(), "large")
    gone = copies.unionByName(removed).unionByName(more)
    if not large.isEmpty():
        settled = removed.unionByName(more).distinct().withColumn("open", F.lit(False))
        members = rest.where(F.col("n") > BLOCK).join(large, "token", "left_semi").select("doc", "line").distinct()
        members = members.join(settled, ["doc", "line"], "left").withColumn("open", F.coalesce("open", F.lit(True)))
        members = scratch.write(members, "large_members")
        places = members.select(F.struct("doc", "line").alias("place"))
        texts = _placed_in(lines, places, scratch, "large_bits")
        involved = scratch.write(members.join(texts, ["doc", "line"]), "involved")
        last = _match_in_blocks(_prefixes_by_count(involved, scratch), involved, scratch)
        gone = gone.unionByName(scratch.write(last, "last"))
    return gone.groupBy("doc").agg(F.sort_array(F.collect_list("line")).alias("removed"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_lines``, ``n_removed`` and
    ``removed_lines`` (their numbers, from 0, in order)."""
    with Scratch(docs.sparkSession, drop_shuffles=True) as scratch:
        stored = locate(docs.select(id_col, text_col), scratch, "place")
        rows = _number_documents(
            stored.select("place", F.col(id_col).alias("id"), F.col(text_col).alias("text")),
            "place",
            "doc",
            scratch,
        )
        removed = _decide(rows.select("doc", "text"), scratch)
        sizes = rows.select("doc", "id", F.size(_split_lines(F.col("text"))).alias("n_lines"))
        out = sizes.join(removed, "doc", "left").select(
            F.col("id").alias(id_col),
            F.col("n_lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
            F.coalesce("removed", F.array().cast("array<int>")).alias("removed_lines"),
        )
        return scratch.write(out, "result", keep=True)


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with all their columns, their texts without the removed lines."""
    with Scratch(docs.sparkSession, drop_shuffles=True) as scratch:
        place, name, gone = (fresh(docs, n) for n in ("place", "doc_number", "removed"))
        numbered = _number_documents(locate(docs, scratch, place), place, name, scratch, keep=True)
        removed = scratch.write(
            _decide(numbered.select(F.col(name).alias("doc"), F.col(text_col).alias("text")), scratch),
            "removed_lines",
            keep=True,
        ).toDF(name, gone)
        kept = F.filter(
            _split_lines(F.col(text_col)),
            lambda _, i: ~F.array_contains(F.col(gone), i),
        )
        text = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
        joined = numbered.join(removed, name, "left")
        return joined.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])
