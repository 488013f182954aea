"""Vocabulary encoding of text to fixed-length id arrays, natively.

The vocabulary is a literal map and a character translation; no Python
runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import fixed
from tidemark.functions.text import SPACE_RUN_PATTERN, strip_ws


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c) -> Column:
    """Markers padded with spaces, then split on whitespace (no empties)."""
    t = F.replace(_c(c), F.lit(fixed.IM_START), F.lit(" " + fixed.IM_START + " "))
    t = F.replace(t, F.lit(fixed.IM_END), F.lit(" " + fixed.IM_END + " "))
    return F.filter(F.split(strip_ws(t), SPACE_RUN_PATTERN), lambda w: w != "")


# An id is held as one character while a text is encoded, so whole words and
# single characters are mapped by string functions and the ids are read off
# the characters at the end.
FIRST_ID_CHAR = 0x10000


def _id_char(i: int) -> str:
    if not 0 <= i <= 0x10FFFF - FIRST_ID_CHAR:
        raise ValueError(f"an id must lie between 0 and {0x10FFFF - FIRST_ID_CHAR}: {i}")
    return chr(FIRST_ID_CHAR + i)


def _id_chars(c, vocab: dict | None = None) -> Column:
    """One character for each id: a whole word found in the vocabulary
    becomes its id; any other word becomes one id per character (the
    character's id, or UNK)."""
    vocab = fixed.VOCAB if vocab is None else vocab
    word_map = F.create_map(*[x for k, v in vocab.items() for x in (F.lit(k), F.lit(_id_char(v)))])
    singles = [k for k in vocab if len(k) == 1]
    other = "[^" + "".join("\\" + ch if ch in "\\^-][&" else ch for ch in singles) + "]" if singles else "(?s)."

    def per_word(w):
        known = F.regexp_replace(w, other, _id_char(fixed.UNK_ID))
        return F.coalesce(F.try_element_at(word_map, w), F.translate(
            known, "".join(singles), "".join(_id_char(vocab[ch]) for ch in singles)))

    return F.array_join(F.transform(words(c), per_word), "")


def _ids_of(chars) -> Column:
    return F.transform(F.filter(F.split(chars, ""), lambda x: x != ""), lambda x: F.ascii(x) - FIRST_ID_CHAR)


def token_ids(c, vocab: dict | None = None) -> Column:
    """Ids of the words: a known word maps to its id; an unknown word maps
    character by character, unknown characters to the UNK id."""
    return _ids_of(_id_chars(c, vocab))


def pad_truncate(ids, max_length: int, pad_id: int = fixed.PAD_ID) -> Column:
    """Cut to ``max_length`` or right-pad with ``pad_id``."""
    return F.slice(F.concat(_c(ids), F.array_repeat(F.lit(pad_id), max_length)), 1, max_length)


def encode(c, max_length: int, vocab: dict | None = None) -> Column:
    """Exactly ``max_length`` ids, cut or padded; see ``token_ids`` for all."""
    return pad_truncate(token_ids(c, vocab), max_length)


def attention_mask(ids) -> Column:
    """All-ones mask of the id array's length (padding included)."""
    return F.array_repeat(F.lit(1), F.size(_c(ids)))


def decode(ids, vocab: dict | None = None) -> Column:
    """Ids back to tokens joined by one space; unknown ids become [UNK].
    Ids are dense positions, so the lookup is an array index."""
    vocab = fixed.VOCAB if vocab is None else vocab
    by_id = {v: k for k, v in vocab.items()}
    n = max(by_id) + 1
    tokens = F.array(*[F.lit(by_id.get(i, fixed.UNK_TOKEN)) for i in range(n)])
    return F.array_join(
        F.transform(_c(ids), lambda i: F.when((i >= 0) & (i < n), F.element_at(tokens, i + 1))
                                        .otherwise(F.lit(fixed.UNK_TOKEN))),
        " ")
