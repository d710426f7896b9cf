"""A tokenizer file's word splitting and word encoding, as small helpers for tasks.

Words are the pieces a BPE tokenizer encodes one by one, so a text's ids are its words' ids
in order. Special tokens inside a text are words of their own with one id.
"""

from __future__ import annotations

import json
import unicodedata

import regex
from tokenizers import Tokenizer

# Fixed value: the pattern of byte-level tokenizers that name none.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# Blocks of long-settled letters, in which every Unicode version splits texts alike. Texts
# with other characters are split by the tokenizers library itself, which is slower.
SETTLED = regex.compile(
    "[\\u0000-\\u052f\\u2000-\\u206f\\u20a0-\\u20bf\\u2190-\\u21ff\\u2500-\\u25ff"
    "\\u3040-\\u3096\\u30a0-\\u30ff\\u4e00-\\u9fa5\\uac00-\\ud7a3]*"
).fullmatch


# Control characters that Python's str.split takes for white space, and the pattern does not.
ODD_BLANKS = regex.compile("[\\x1c-\\x1f]").search


def read_spec(path: str) -> str:
    """The tokenizer file's text; it travels to the executors with the job."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others for the characters from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class WordTokenizer:
    """Splits texts into words and encodes words, as the tokenizer file says."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        steps = (parsed["normalizer"] or {"normalizers": []})["normalizers"]
        kinds = [s["type"] for s in steps]
        if kinds not in ([], ["NFC", "Replace", "Lowercase"]):
            raise ValueError(f"unsupported normalizer {kinds}")
        # White space never ends up in a word of a splitting pattern, so the normalizer's
        # replacement of its runs changes no word.
        self.normalize = bool(steps)
        before = parsed["pre_tokenizer"]
        if before["type"] == "ByteLevel" and before["use_regex"]:
            self.pattern = BYTE_LEVEL_PATTERN
        else:
            self.pattern = before["pretokenizers"][0]["pattern"]["Regex"]
        self.find = regex.compile(self.pattern).findall
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.bytes = {c: b for b, c in byte_letters().items()}
        self.library = Tokenizer.from_str(spec)
        self.model = self.library.model

    def plain_words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not SETTLED(text):
            if self.normalize:
                text = self.library.normalizer.normalize_str(text)
            split = self.library.pre_tokenizer.pre_tokenize_str(text)
            return [bytes(map(self.bytes.__getitem__, w)).decode() for w, _ in split]
        if self.normalize:
            # Letter by letter: the capital sigma has no final form here.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.find(text)

    def spaced(self, text: str) -> str | None:
        """The text normalised, where the words of its runs between white space are the same
        as inside the text: null for a tokenizer whose words may hold white space, and for
        texts with special tokens or unsettled characters."""
        if not self.normalize or len(self.segments(text)) > 1 or ODD_BLANKS(text):
            return None
        if text.isascii():
            return text.lower()
        if not SETTLED(text):
            return None
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def runs(self, text: str) -> list[str] | None:
        """The runs of ``spaced``."""
        spaced = self.spaced(text)
        return None if spaced is None else spaced.split()

    def segments(self, text: str) -> list[str]:
        """The text cut around special tokens; every second one is a special token."""
        if not any(s in text for s in self.special):
            return [text]
        return self.cut(text)

    def words(self, text: str) -> list[str]:
        parts = self.segments(text)
        if len(parts) == 1:
            return self.plain_words(text)
        out: list[str] = []
        for i, part in enumerate(parts):
            out += [part] if i % 2 else self.plain_words(part)
        return out

    def encode(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        return [t.id for t in self.model.tokenize(self.to_letters(word))]

    def to_letters(self, word: str) -> str:
        if word.isascii() and word.isalnum():  # these stand for themselves
            return word
        return word.encode().decode("latin-1").translate(self.letters)


def pieces(spec: str) -> list[str]:
    """The piece of every id, in order of ids (empty where the file skips an id)."""
    vocab = Tokenizer.from_str(spec).get_vocab(with_added_tokens=True)
    out = [""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        out[i] = piece
    return out
