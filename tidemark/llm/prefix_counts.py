"""Token counts of every prefix of a text, by dynamic programming over prefixes.

A byte-pair encoding of a text is made of neighbours that the merges would leave apart, and
for each prefix there is just one such way. So the last token of a prefix is the vocabulary
token that ends it and may follow the last token of the prefix before it, and the prefix's
count is that prefix's count plus one. Words (the tokenizer's pieces) are solved once per
task and reused; a text's counts are those of its words, put one after another, corrected
where a cut text splits differently than the whole: inside contractions, at the last blank
of a run of blanks, and inside special tokens.

``prefix_table`` stores the counts as differences, one signed byte per character. With them
``count_at`` (tokens of the first k characters) and ``fit_budget`` (the longest prefix
within a budget) answer without encoding anything again.

Null texts count as empty: no bytes, no tokens. Ids may be null or repeated: every row is
counted by its own text. Extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Remembered, per_process
from tidemark.llm.tokens import SETTLED, WordTokenizer

# Words, runs and neighbour pairs a worker remembers of each. Beyond that it forgets those not
# met since it last forgot some, so frequent ones are not solved again.
REMEMBERED = 300_000

# A cut inside these leaves an apostrophe and a letter, which are two words.
LONG_CONTRACTIONS = {"'re", "'ve", "'ll"}


NEVER = 1 << 60


def _along(counts: _Counts, lead: str) -> Remembered:
    """Run of text without white space -> the changes along it, after ``lead``."""
    find, known = counts.tokenizer.find, counts.__getitem__

    def make(run: str) -> bytes:
        words = find(lead + run)
        return known(words[0]) if len(words) == 1 else b"".join(map(known, words))

    return Remembered(make, REMEMBERED)


class _Counts(Remembered):
    """Word -> changes of the token count from prefix to prefix, one signed byte each."""

    def __init__(self, spec: str):
        super().__init__(self.steps_of, REMEMBERED)
        self.tokenizer = WordTokenizer(spec)
        self.vocabulary = set(self.tokenizer.library.get_vocab(with_added_tokens=False))
        self.longest = max(map(len, self.vocabulary))
        merges = [tuple(m) for m in json.loads(spec)["model"]["merges"]]
        self.rank = {pair: k for k, pair in enumerate(merges)}
        # The symbols at a token's left and right edge while it is merged, each with the
        # rank of the merge that uses it up; the token itself stays.
        self.left = {c: [(c, NEVER)] for c in self.vocabulary if len(c) == 1}
        self.right = dict(self.left)
        for (a, b), k in self.rank.items():
            if a in self.left and b in self.left:
                self.left[a + b] = [*self.left[a][:-1], (a, k), (a + b, NEVER)]
                self.right[a + b] = [*self.right[b][:-1], (b, k), (a + b, NEVER)]
        self.pairs: dict[tuple[str, str], bool] = {}
        self.first, self.spaced = _along(self, ""), _along(self, " ")

    def follows(self, left: str, right: str) -> bool:
        """True if the merges leave the two tokens apart."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[left, right] = self._apart(self.right[left], self.left[right])
        return known

    def _apart(self, left: list[tuple[str, int]], right: list[tuple[str, int]]) -> bool:
        """Run the merges at both edges in order of rank: the tokens merge into each other
        if at some time the symbols at the edges merge before either is used up otherwise
        (of equal ranks the leftmost goes first)."""
        i = j = 0
        while True:
            (x, x_used), (y, y_used) = left[i], right[j]
            k = self.rank.get((x, y))
            if k is not None and k < x_used and k <= y_used:
                return False
            if x_used == y_used == NEVER:
                return True
            if x_used <= y_used:
                i += 1
            else:
                j += 1

    def solve(self, letters: str) -> list[int]:
        """Token counts of all byte prefixes of a word. The last token of a longer prefix
        mostly starts where the one before it does or later, so these places are tried
        first; only one place fits."""
        n, vocabulary, known = len(letters), self.vocabulary, self.pairs
        last, count = [""] * (n + 1), [0] * (n + 1)
        begin = 0
        for end in range(1, n + 1):
            for start in range(begin, end):
                token = letters[start:end]
                if token in vocabulary:
                    if not start:
                        break
                    before = last[start]
                    fits = known.get((before, token))
                    if fits is None:
                        fits = self.follows(before, token)
                    if fits:
                        break
            else:
                for start in range(begin - 1, max(end - self.longest, 0) - 1, -1):
                    token = letters[start:end]
                    if token in vocabulary and (not start or self.follows(last[start], token)):
                        break
            last[end], count[end], begin = token, count[start] + 1, start
        return count

    def word(self, word: str) -> list[int]:
        """Token counts after each character of a word."""
        count = self.solve(self.tokenizer.to_letters(word))
        if word.isascii():
            out = count[1:]
        else:
            ends = np.cumsum([len(c.encode()) for c in word])
            out = [count[e] for e in ends]
        if word in LONG_CONTRACTIONS:
            out[1] = self.tokens("'") + self.tokens(word[1])
        return out

    def tokens(self, word: str) -> int:
        return sum(np.frombuffer(self[word], np.int8).tolist())

    def steps_of(self, word: str) -> bytes:
        count = self.word(word)
        return bytes([b - a & 255 for a, b in zip([0, *count], count, strict=False)])

    def plain(self, text: str) -> np.ndarray:
        """The changes along a text without special tokens; their sum is its count."""
        if SETTLED(text) and not UNUSUAL_BLANKS(text):
            # Words end before a lone blank and on both sides of a lone line feed.
            lines = []
            for line in text.split("\n"):
                first, *rest = line.split(" ")
                lines.append(self.first[first] + b"".join(map(self.spaced.__getitem__, rest)))
            return np.frombuffer(self["\n"].join(lines), np.int8)
        words = self.tokenizer.plain_words(text)
        steps = np.frombuffer(b"".join(map(self.__getitem__, words)), np.int8)
        if DOUBLE_BLANK(text):
            # Cut after the last blank of a run, the whole run is one word.
            steps = steps.copy()
            at = 0
            for before, word in zip(["", *words], words, strict=False):
                if BLANKS(before) and BLANKS(word[0]):
                    change = self.tokens(before + word[0]) - self.tokens(before)
                    change -= int(steps[at])
                    steps[at] += change
                    steps[at + 1] -= change
                at += len(word)
        return steps

    def text(self, text: str) -> np.ndarray:
        """The changes along a text."""
        parts = self.tokenizer.segments(text)
        if len(parts) == 1:
            return self.plain(text)
        out = [self.plain(parts[0])]
        for before, special, after in zip(parts[::2], parts[1::2], parts[2::2], strict=False):
            # Inside a special token the cut text is ordinary; at its end it is one token.
            cut = np.cumsum(self.plain(before + special), dtype=np.int64)[len(before) :]
            cut -= out[-1].sum(dtype=np.int64)
            cut[-1] = 1
            out += [np.diff(cut, prepend=0).astype(np.int8), self.plain(after)]
        return np.concatenate(out)


UNUSUAL_BLANKS = regex.compile(r"\s\s|[^\S \n]").search
DOUBLE_BLANK = regex.compile(r"\s\s").search
BLANKS = regex.compile(r"\s+").fullmatch


def prefix_table(
    docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and
    ``steps`` (per character, the change of the token count). ``spec`` is the text of a
    byte-level tokenizer file (``tokens.read_spec``)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = per_process(("prefix counts", spec), lambda: _Counts(spec))
        for batch in batches:
            steps = [counts.text(t.as_py() or "") for t in batch.column(1)]
            sizes = [t.as_buffer().size if t.is_valid else 0 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array([int(s.sum(dtype=np.int64)) for s in steps], pa.int64()),
                    pa.array([s.tobytes() for s in steps], pa.binary()),
                ],
                ["id", "n_bytes", "n_tokens", "steps"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        count, f"id {kind}, n_bytes long, n_tokens long, steps binary"
    ).withColumnRenamed("id", id_col)


def count_at(steps: Column, chars: Column) -> Column:
    """Tokens of the text's first ``chars`` characters."""

    @F.pandas_udf("long")
    def total(steps: pd.Series, chars: pd.Series) -> pd.Series:
        return pd.Series(
            [int(np.frombuffer(s, np.int8)[:k].sum(dtype=np.int64)) for s, k in zip(steps, chars, strict=True)]
        )

    return total(steps, chars)


def fit_budget(steps: Column, budget: Column) -> Column:
    """Characters of the longest prefix that takes at most ``budget`` tokens."""

    @F.pandas_udf("long")
    def longest(steps: pd.Series, budget: pd.Series) -> pd.Series:
        out = []
        for s, most in zip(steps, budget, strict=True):
            within = np.flatnonzero(np.cumsum(np.frombuffer(s, np.int8), dtype=np.int64) <= most)
            out.append(int(within[-1]) + 1 if len(within) else 0)
        return pd.Series(out)

    return longest(steps, budget)
