"""Pre-tokens of byte-level vocabularies, split as their libraries split.

Matches of the splitting pattern never reach over a single space or line
feed between two other characters: the space joins what follows, the line
feed stands alone.  So a text without neighbouring white space falls into
words whose pre-tokens do not depend on the words around them, and what is
computed for a word can be kept and used again.  Any other text is matched
as a whole.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import regex
from tokenizers import pre_tokenizers

NEIGHBOURS = re.compile(r"\s\s")
MARKS = frozenset(".,;:!?")


@lru_cache(maxsize=1)
def _young() -> regex.Pattern:
    """Characters that ``regex`` knows as letters, numbers or white space but
    this Python does not know at all.  The tokenizer libraries follow an
    older Unicode version, so texts with any of these are left to them."""
    unknown = "".join([ch for ch in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(ch) == "Cn"])
    runs: list[list[int]] = []
    for ch in regex.findall(r"[\p{L}\p{N}\s]", unknown):
        if runs and runs[-1][1] == ord(ch) - 1:
            runs[-1][1] = ord(ch)
        else:
            runs.append([ord(ch), ord(ch)])
    return regex.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs) + "]" if runs else r"(?!)")


class Words:
    """Applies a function of a list of pre-tokens word by word, and keeps the
    results of short words in a bounded memo.

    ``of_pieces(list of lists of pre-tokens)`` returns one value for each.
    """

    LONGEST = 64      # longer words are not kept

    def __init__(self, pattern: str, of_pieces: Callable[[list[list[str]]], list], keep: int = 500_000):
        self.pattern = regex.compile(pattern)
        self.of_pieces = of_pieces
        self.keep = keep
        self.first: dict[str, object] = {}   # words that begin a line
        self.later: dict[str, object] = {}   # words that follow a space
        self.newline = of_pieces([["\n"]])[0]
        self._library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and _young().search(text):
            return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def pieces_of_word(self, lead: str, word: str) -> list[str]:
        """As ``pieces(lead + word)``, at once for letters with or without a
        mark behind them."""
        if word.isalpha():
            return [lead + word]
        if word[-1:] in MARKS and word[:-1].isalpha():
            return [lead + word[:-1], word[-1]]
        return self.pieces(lead + word)

    def _learn(self, memo: dict, words: set, lead: str) -> dict:
        """A table with the values of ``words``: the memo, which takes in the
        short ones, or one for this text alone if there are others."""
        new = [w for w in words if w not in memo]
        if len(memo) + len(new) > self.keep:
            memo.clear()
            new = list(words)
        found = dict(zip(new, self.of_pieces([self.pieces_of_word(lead, w) for w in new])))
        short = {w: v for w, v in found.items() if len(w) <= self.LONGEST}
        if len(short) == len(found) <= self.keep:
            memo.update(found)
            return memo
        found.update((w, memo[w]) for w in words if w not in found)
        if len(memo) + len(short) <= self.keep:
            memo.update(short)
        return found

    def values(self, text: str) -> list:
        """Values in order; their sum (join) is the value of the text."""
        if not text:
            return []
        if text[0].isspace() or text[-1].isspace() or NEIGHBOURS.search(text):
            return self.of_pieces([self.pieces(text)])
        lines = [line.split(" ") for line in text.split("\n")]
        first = self._learn(self.first, {line[0] for line in lines}, "")
        later = self._learn(self.later, {w for line in lines for w in line[1:]}, " ")
        out = []
        for line in lines:
            out.append(first[line[0]])
            out.extend(map(later.__getitem__, line[1:]))
            out.append(self.newline)
        out.pop()
        return out
