"""Words of many texts at once, cut out of the bytes of a whole batch.

Texts are joined by line feeds, so a *piece* is a text or, where the table
turns characters into line feeds, a part of one.  The bytes are worked on in
slices of a bounded size (a long text takes several), each with its own
dictionary of words; the last few words of a slice are repeated in the next
one, so that runs of words across the cut are seen whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 8 << 20     # bytes worked on at once
_GAP = re.compile(rb"[ \n]")


def table(blanks: bytes, breaks: bytes = b"", lower: bool = False) -> bytes:
    """Byte table that makes ``blanks`` spaces and ``breaks`` line feeds, and
    A-Z small letters on request.  Other bytes stay as they are."""
    to = bytearray(range(256))
    for b in blanks:
        to[b] = 32
    for b in breaks:
        to[b] = 10
    if lower:
        to[65:91] = bytes(range(97, 123))
    return bytes(to)


@dataclass
class Words:
    ids: np.ndarray        # of each word, in ``vocabulary``
    vocabulary: pa.Array   # binary
    piece: np.ndarray      # number of each word's piece
    fresh: int             # words before this one were in the last slice too
    number: int            # of the first word, counted from the first text


def slices(texts: Sequence[bytes], to: bytes, carry: int, limit: int = SLICE) -> Iterator[Words]:
    """The words of ``texts``, slice by slice; ``carry`` words are repeated."""
    data = b"\n".join([t.translate(to) for t in texts])
    done = begin = number = piece = 0
    while done < len(data):
        end = len(data)
        if done + limit < end and (gap := _GAP.search(data, done + limit)):
            end = gap.end()
        raw = np.frombuffer(data, np.uint8, end - begin, begin)
        feeds = raw == 10
        inside = ~(feeds | (raw == 32))
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        start, stop = edges[::2], edges[1::2]
        offsets = np.zeros(len(start) + 1, np.int32)
        np.cumsum(stop - start, out=offsets[1:])
        flat = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside])])
        code = flat.dictionary_encode()
        feeds = np.flatnonzero(feeds)
        yield Words(code.indices.to_numpy(), code.dictionary, piece + np.searchsorted(feeds, start),
                    int(np.searchsorted(start, done - begin)), number)
        keep = min(carry, len(start))
        after = begin + int(start[-keep]) if keep else end
        number += len(start) - keep
        piece += int(np.searchsorted(feeds, after - begin))
        done, begin = end, after
