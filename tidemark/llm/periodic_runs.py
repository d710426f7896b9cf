"""Periodic run detection over the grammar of each text.

The words of a text are numbered and compressed by Re-Pair: the most frequent pair of
neighbouring symbols becomes a new symbol, again and again, until no pair occurs twice. What
remains is split in halves down to single symbols, so that the whole text is one derivation
tree with two children a node. A run that lies in a node and in neither of its children
crosses the boundary between these, so every run is met at one node: each nonterminal's
boundary is looked at once, at its first occurrence, and the runs found there are translated
to all positions the nonterminal has in the derivation. Intervals of one period that overlap
by a period at least are merged; what the edge of a nonterminal cut off is a part of the run
found at a node above.

A run of period q crossing a boundary has 2 q words on one of its sides (it has 4 q in all),
so on that side the two words next to the boundary come again q words away. Only such
distances are tried, smallest first: links from each pair of words to its next occurrence give
them, common extensions are taken over from those of nearer distances as in a Z table, and
distances that a smaller period already covers are passed over.

``periodic_runs`` gives one row per row: all columns of the table and ``n_words``, ``runs``
(start, length, period of every run, by start, then period), ``best`` (index in ``runs`` of
the greatest length / period, compared exactly; of equal ones the first in order; null
without runs) and ``collapsed`` (the words that no run holds after its first period, joined
by one space). Columns of the table with these names are replaced. Words are runs of anything
but blank, tab, line feed, VT, FF and carriage return, and compared byte by byte. A null or
empty text has no words, no runs and an empty ``collapsed``. Repeated rows each give a row;
an empty table gives an empty result. Texts are processed whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Scratch, arrow_batches, fresh, words

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
BATCH = 256  # texts handed over at a time

Run = tuple[int, int, int]  # start, length, period


def _next_pairs(ids: np.ndarray) -> np.ndarray:
    """For each word the next place where it and the word after it come again, or -1."""
    keys = ids[:-1] * (int(ids.max()) + 1) + ids[1:]
    order = np.argsort(keys, kind="stable")
    again = keys[order[:-1]] == keys[order[1:]]
    out = np.full(len(ids), -1)
    out[order[:-1][again]] = order[1:][again]
    return out


def re_pair(ids: list[int], following: np.ndarray) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int]]]:
    """(rules, rest). A rule is (left, right, first, middle, end): its two symbols and the
    words of its first occurrence; rule k is symbol -1 - k. ``rest`` lists (start, symbol)
    of the compressed text. ``following`` are the links of ``_next_pairs``."""
    n = len(ids)
    symbols: list[int | None] = list(ids)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], list[int]] = {}
    for i in np.flatnonzero(following >= 0).tolist():
        pair = (ids[i], ids[i + 1])
        if pair in places:
            continue
        found = places[pair] = [i]
        while (i := int(following[i])) >= 0:
            found.append(i)
    queue = [(-len(found), pair) for pair, found in places.items()]
    heapify(queue)
    rules: list[tuple[int, int, int, int, int]] = []
    while queue:
        count, pair = heappop(queue)
        a, b = pair
        matching, valid, behind = [], [], -1
        for i in places[pair]:
            if symbols[i] == a:
                j = right[i]
                if j < n and symbols[j] == b:
                    matching.append(i)
                    if i >= behind:  # does not overlap the one before
                        valid.append(i)
                        behind = right[j]
        if len(valid) < 2:
            continue
        if len(valid) < -count:  # fewer are left than when it was queued
            places[pair] = matching
            heappush(queue, (-len(valid), pair))
            continue
        new = -1 - len(rules)
        rules.append((a, b, valid[0], right[valid[0]], right[right[valid[0]]]))
        for i in valid:
            j = right[i]
            after = right[j]
            symbols[i], symbols[j] = new, None
            right[i] = after
            if after < n:
                left[after] = i
        near: dict[tuple[int, int], list[int]] = {}
        for i in valid:
            before, after = left[i], right[i]
            if before >= 0 and symbols[before] != new:
                near.setdefault((symbols[before], new), []).append(before)
            if after < n:
                near.setdefault((new, symbols[after]), []).append(i)
        for pair, found in near.items():
            if len(found) > 1:
                places[pair] = found
                heappush(queue, (-len(found), pair))
    rest, i = [], 0
    while i < n:
        rest.append((i, symbols[i]))
        i = right[i]
    return rules, rest


def _halves(starts: np.ndarray, n: int) -> np.ndarray:
    """(low, boundary, high) of the nodes above the symbols that begin at ``starts``."""
    edges = np.append(starts, n)
    low, high = np.array([0]), np.array([len(starts)])
    out = [np.zeros((0, 3), np.int64)]
    while len(low):
        middle = (low + high) // 2
        inner = high - low > 1
        low, middle, high = low[inner], middle[inner], high[inner]
        out.append(np.stack([edges[low], edges[middle], edges[high]], axis=1))
        low, high = np.concatenate([low, middle]), np.concatenate([middle, high])
    return np.concatenate(out)


def _agree(t: list[int], i: int, j: int, most: int) -> int:
    """How many words t[i:] and t[j:] have in common at their beginning, up to ``most``."""
    same, step = 0, 8
    while same < most:
        step = min(step, most - same)
        if t[i + same : i + same + step] == t[j + same : j + same + step]:
            same += step
            step *= 2
        elif step == 1:
            break
        else:  # they differ among these words
            most = same + step - 1
            step = max(1, step // 2)
    return same


def _crossing(t: list[int], back: list[int], following: list[int], low: int, b: int, high: int) -> Iterator[Run]:
    """Runs in t[low:high] that hold t[b - 1] and t[b] and two periods from t[b] on (three
    words, for period 1). ``back`` is t reversed."""
    known: dict[int, int] = {}
    box_start = box_end = reach = 0
    half, n = (high - b) // 2, len(t)
    j = following[b]
    while j >= 0 and (q := j - b) <= half:
        if 2 * q > reach:
            same = 0
            if q < box_end:
                same = min(known.get(q - box_start, 0), box_end - q)
            if q + same >= box_end:
                same += _agree(t, b + same, j + same, high - j - same)
            elif q - box_start not in known:
                same = _agree(t, b, j, high - j)
            known[q] = same
            if q + same > box_end:
                box_start, box_end = q, q + same
            if same >= q:
                reach = max(reach, q + same)
                before = _agree(back, n - b, n - b - q, b - low)
                length = before + q + same
                if before and length >= max(LEAST_LENGTH, LEAST_EXPONENT * q):
                    yield b - before, length, q
        j = following[j]


def find_runs(ids: list[int]) -> list[Run]:
    """All runs of a sequence of numbers, by start, then period."""
    n = len(ids)
    if n < LEAST_LENGTH:
        return []
    numbers = np.array(ids)
    following = _next_pairs(numbers)
    if not (following >= 0).any():
        return []  # a run repeats a pair of words
    rules, rest = re_pair(ids, following)
    nodes = _halves(np.array([i for i, _ in rest]), n)
    if rules:
        nodes = np.concatenate([np.array(rules)[:, 2:], nodes])
    # The nodes at whose boundary a pair of words comes again near enough, on either side.
    preceding = _next_pairs(numbers[::-1])
    low, b, high = nodes.T
    ahead, behind = following[b], preceding[n - b]
    wide = high - low >= LEAST_LENGTH
    onward = wide & (ahead >= 0) & (ahead - b <= (high - b) // 2)
    backward = wide & (behind >= 0) & (behind - (n - b) <= (b - low) // 2)
    open_ = np.flatnonzero(onward | backward)
    if not len(open_):
        return []
    back = ids[::-1]
    links, back_links = following.tolist(), preceding.tolist()
    found: list[Run] = []
    inside: dict[int, list[Run]] = {}
    for k in open_.tolist():
        lo, at, hi = nodes[k].tolist()
        here: list[Run] = []
        if onward[k]:
            here += _crossing(ids, back, links, lo, at, hi)
        if backward[k]:
            here += [
                (n - s - length, length, q)
                for s, length, q in _crossing(back, ids, back_links, n - hi, n - at, n - lo)
            ]
        if k >= len(rules):
            found += here
        elif here:
            inside[-1 - k] = [(s - lo, length, q) for s, length, q in set(here)]
    if inside:
        _translate(rules, rest, inside, found)
    return _merged(found)


def _translate(rules: list, rest: list[tuple[int, int]], inside: dict[int, list[Run]], found: list[Run]) -> None:
    """Add the runs of ``inside`` (within nonterminals) at all their positions."""
    holds: set[int] = set()
    for k, (a, b, *_) in enumerate(rules):  # symbols of a rule are older than the rule
        if -1 - k in inside or a in holds or b in holds:
            holds.add(-1 - k)
    todo = [(i, symbol) for i, symbol in rest if symbol in holds]
    while todo:
        i, symbol = todo.pop()
        found += [(i + s, length, q) for s, length, q in inside.get(symbol, ())]
        a, b, first, middle, _ = rules[-1 - symbol]
        if a in holds:
            todo.append((i, a))
        if b in holds:
            todo.append((i + middle - first, b))


def _merged(found: list[Run]) -> list[Run]:
    """Maximal intervals: those of one period that share a period of words become one."""
    out: list[Run] = []
    start = end = period = 0
    for s, length, q in sorted(found, key=lambda r: (r[2], r[0])):
        if q == period and s + q <= end:
            end = max(end, s + length)
            continue
        if period:
            out.append((start, end - start, period))
        start, end, period = s, s + length, q
    if period:
        out.append((start, end - start, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def best_run(runs: list[Run]) -> int | None:
    """Index of the run with the greatest length / period, the first of equal ones."""
    best = None
    for i, (_, length, q) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * q:
            best = i
    return best


def collapse(text_words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(text_words)
    kept: list[bytes] = []
    at = 0
    for start, end in sorted((s + q, s + length) for s, length, q in runs):
        kept += text_words[at:start]
        at = max(at, end)
    return b" ".join(kept + text_words[at:])


ADDED = ("n_words", "runs", "best", "collapsed")


def _with_runs(docs: DataFrame, text: Column | str) -> DataFrame:
    """What ``periodic_runs`` returns, not yet written."""
    carried = [c for c in docs.columns if c.lower() not in ADDED]
    source = fresh(docs, "run_text")
    frame = docs.select(*carried, (F.col(text) if isinstance(text, str) else text).alias(source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(carried)).cast(pa.binary()).to_pylist()
            counts, offsets, flat, best, collapsed = [], [0], [], [], []
            for raw in texts:
                split = (raw or b"").split()
                numbers = {w: i for i, w in enumerate(dict.fromkeys(split))}
                # Numbers of different words differ, so a run of words is a run of numbers.
                runs = find_runs([numbers[w] for w in split]) if len(numbers) < len(split) else []
                counts.append(len(split))
                flat += runs
                offsets.append(len(flat))
                best.append(best_run(runs))
                collapsed.append(collapse(split, runs))
            columns = np.array(flat, np.int64).reshape(-1, 3).T
            structs = pa.StructArray.from_arrays(
                [pa.array(c) for c in columns], ["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i) for i in range(len(carried))],
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                    pa.array(best, pa.int32()),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                [*carried, *ADDED],
            )

    spans = "runs array<struct<start: bigint, length: bigint, period: bigint>>"
    schema = T.StructType(
        [frame.schema[c] for c in carried]
        + T._parse_datatype_string(f"n_words bigint, {spans}, best int, collapsed string").fields
    )
    return frame.mapInArrow(run, schema)


def periodic_runs(docs: DataFrame, text: Column | str = "text") -> DataFrame:
    """``docs`` with the columns ``n_words``, ``runs``, ``best`` and ``collapsed``."""
    spark = docs.sparkSession
    with arrow_batches(spark, BATCH):
        return Scratch(spark).write(_with_runs(docs, text), "runs", keep=True)


def repeat_tails(text: Column, key: Column) -> Column:
    """Texts whose words repeat from some place on, for one key in ten: with h the crc32 of
    the key's decimal text and g = h div 10, a text of n words becomes, if h is divisible by
    10, its words up to a = g mod n and the next 1 + (n - a) div (3 + g mod 8) words over and
    over, n words in all. Null keys and texts without words stay as they are."""
    h = F.crc32(key.cast("string"))
    g = F.floor(h / 10)
    w = words(text)
    n = F.size(w)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    times, rest = F.floor((n - a) / p).cast("int"), ((n - a) % p).cast("int")
    parts = F.array(
        F.slice(w, 1, a),
        F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)),
        F.slice(w, a + 1, rest),
    )
    return F.when((h % 10 == 0) & (n > 0), F.concat_ws(" ", F.flatten(parts))).otherwise(text)


def run_report(docs: DataFrame, id_col: str = "doc_id", text: Column | str = "text") -> DataFrame:
    """Per row: id, ``n_runs``, the run of greatest exponent (``start``, ``length``,
    ``period``, ``exponent_milli``) and digests of all runs and of the collapsed text."""
    text = F.col(text) if isinstance(text, str) else text
    found = _with_runs(docs.select(F.col(id_col).alias("id"), text.alias("text")), "text")
    top = F.get("runs", F.col("best"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    report = found.select(
        F.col("id").alias(id_col),
        F.size("runs").cast("long").alias("n_runs"),
        top["start"].alias("start"),
        top["length"].alias("length"),
        top["period"].alias("period"),
        F.floor(F.lit(1000) * top["length"] / top["period"]).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    spark = docs.sparkSession
    with arrow_batches(spark, BATCH):
        return Scratch(spark).write(report, "run_report", keep=True)
