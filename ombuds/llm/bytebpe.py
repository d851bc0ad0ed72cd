"""Byte-level BPE vocabularies: the file, the split into pre-tokens, and the exact encoder by prefixes.

The encoder does not merge pairs step by step. For every prefix of a pre-token it finds the one token that the
prefix's encoding ends with: a token that ends there (an automaton names all of them) and that may stand after the
last token of the prefix before it. The ids are then read along the back-pointers.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import cached_property, lru_cache

import ahocorasick
from tokenizers import Tokenizer

#: Up to this code point the classes of characters are settled, and the standard library's patterns are quicker.
SETTLED = 0x250


def split_pattern() -> tuple[re.Pattern, re.Pattern]:
    """Byte-level BPE's pattern for texts of settled characters, and the pattern that finds any other.

    Controls that only some libraries take for white space count as not settled.
    """

    def members(test: Callable[[str], bool]) -> str:
        return "".join(re.escape(c) for c in map(chr, range(SETTLED)) if test(c))

    letters = members(lambda c: unicodedata.category(c)[0] == "L")
    numbers = members(lambda c: unicodedata.category(c)[0] == "N")
    blank = members(lambda c: c.isspace())
    doubtful = members(lambda c: "\x1c" <= c <= "\x1f" or c == "\x85")
    # The contractions and the order of the alternatives.
    split = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{blank}{letters}{numbers}]+|[{blank}]+(?![^{blank}])|[{blank}]+"
    return re.compile(split), re.compile(rf"[{doubtful}\u0250-\u200f\u2028-\u202f\u205f-\U0010ffff]")


NEVER = 1 << 60


def alphabet() -> list[str]:
    """The character that stands for each byte: itself where it is visible, else the next one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in visible)
    stands = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [stands[b] for b in range(256)]


class Vocabulary:
    """A ``tokenizer.json`` with a byte-level BPE model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = {k: split.get(k) for k in ("type", "add_prefix_space", "use_regex")}
        if model["type"] != "BPE" or spec.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path}: only plain byte-level BPE without a normalizer is supported")
        if plain != {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}:
            raise ValueError(f"{path}: another split into pre-tokens than byte-level BPE's: {split}")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens that take in what stands around them")
        self.path = path
        self.byte_of = {char: byte for byte, char in enumerate(alphabet())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {self.raw(text): number for text, number in model["vocab"].items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.merges = [(self.tokens[self.raw(a)], self.tokens[self.raw(b)]) for a, b in pairs]
        split, odd = split_pattern()
        self._find, self._odd = split.findall, odd.search
        longest_first = sorted(self.special, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None

    def raw(self, text: str) -> bytes:
        return bytes(self.byte_of[char] for char in text)

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    @cached_property
    def bytes_of(self) -> dict[int, bytes]:
        """The bytes of every id, special tokens included."""
        table = {number: token for token, number in self.tokens.items()}
        return table | {number: text.encode() for text, number in self.special.items()}

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a text without special tokens."""
        if self._odd(text) is None:
            return self._find(text)
        split = self.library.pre_tokenizer.pre_tokenize_str(text)
        return [self.raw(piece).decode() for piece, _ in split]

    def parts(self, text: str) -> list[tuple[int | None, list[str]]]:
        """The text cut at special tokens: (id of the special token or None, pre-tokens)."""
        if self._cut is None or not any(special in text for special in self.special):
            return [(None, self.words(text))]
        pieces = self._cut.split(text)
        return [
            (self.special[piece], []) if place % 2 else (None, self.words(piece))
            for place, piece in enumerate(pieces)
            if piece
        ]


class PrefixEncoder:
    """Exact BPE ids of a pre-token, from the last tokens of its prefixes."""

    def __init__(self, vocabulary: Vocabulary):
        self.rank = {pair: rank for rank, pair in enumerate(vocabulary.merges)}
        names, tokens = vocabulary.bytes_of, vocabulary.tokens
        #: For a token the merge that makes it: (rank, left part, right part).
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(vocabulary.merges):
            self.made.setdefault(tokens[names[left] + names[right]], (rank, left, right))
        self.automaton = ahocorasick.Automaton()
        for token, number in tokens.items():
            if token:
                self.automaton.add_word(token.decode("latin-1"), (len(token), number))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.wholes: dict[int, bool] = {}

    def _apart(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge reaches over the border between two tokens before ``limit``.

        Goes back in time: the merge made last, of either token, is undone, until both neighbours of the border are
        single bytes. A merge over the border would have come first if its rank is below that of the merge just
        undone on the left, or not above that of one undone on the right, since equal merges go from left to right.
        """
        while True:
            if self.rank.get((left, right), NEVER) < limit:
                return False
            of_left, of_right = self.made.get(left), self.made.get(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and of_left[0] > of_right[0]):
                limit, left = of_left[0], of_left[2]
            else:
                limit, right = of_right[0] + 1, of_right[1]

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left`` in an encoding."""
        key = (left, right)
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= 1_000_000:
                self.pairs.clear()
            found = self.pairs[key] = self._apart(left, right, NEVER)
        return found

    def whole(self, token: int) -> bool:
        """Whether the bytes of a token encode to the token itself."""
        found = self.wholes.get(token)
        if found is None:
            made = self.made.get(token)
            found = made is None or (
                self.whole(made[1]) and self.whole(made[2]) and self._apart(made[1], made[2], made[0])
            )
            self.wholes[token] = found
        return found

    def encode(self, word: bytes) -> list[int]:
        """The ids of one pre-token."""
        last: list[int] = [-1] * (len(word) + 1)
        start: list[int] = [0] * (len(word) + 1)
        for at, (size, token) in self.automaton.iter(word.decode("latin-1")):
            end, begin = at + 1, at + 1 - size
            if last[end] < 0 and (
                self.whole(token) if not begin else last[begin] >= 0 and self.compatible(last[begin], token)
            ):
                last[end], start[end] = token, begin
        ids, end = [], len(word)
        while end:
            if last[end] < 0:
                raise ValueError(f"no token for byte {word[end - 1]}")
            ids.append(last[end])
            end = start[end]
        return ids[::-1]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Read once per worker."""
    return Vocabulary(path)


@lru_cache(maxsize=4)
def encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(vocabulary(path))
