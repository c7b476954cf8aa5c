"""Texts of Arrow batches as arrays: bounded pieces, and parts of texts as codes.

Texts are cut by Arrow's kernels and every distinct part of a piece gets a code, so Python
looks at distinct parts only and everything per occurrence is numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ROWS, BYTES = 8192, 4_000_000
#: every character that Python's ``\s`` matches
SPACES = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_STEP = re.compile(r"(?<=\S)(?=[ \n])")


class Parts(NamedTuple):
    """Parts of texts in order: text ``i`` has ``codes[offsets[i]:offsets[i + 1]]``, which
    point into ``distinct``."""

    offsets: np.ndarray
    codes: np.ndarray
    distinct: pa.Array

    def owners(self) -> np.ndarray:
        """The text of every part."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def pieces(batch: pa.RecordBatch, column: str | int = "text", rows: int = ROWS, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``rows`` rows and about ``size`` bytes of text; a longer
    text is a slice of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        fits = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right"))
        to = min(max(fits, at + 1), at + rows)
        yield batch.slice(at, to - at)
        at = to


def _coded(lists: pa.Array) -> Parts:
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    return Parts(offsets - offsets[0], coded.indices.to_numpy(), coded.dictionary)


def _without_empty(parts: Parts) -> Parts:
    empty = pc.index(parts.distinct, "").as_py()
    if empty < 0:
        return parts
    real = parts.codes != empty
    return Parts(np.r_[0, np.cumsum(real)][parts.offsets], parts.codes[real], parts.distinct)


def ascii_words(texts: pa.Array) -> Parts:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; null has none.  ``distinct`` may
    hold an empty string that no code points to."""
    return _without_empty(_coded(pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))))


def unicode_words(texts: pa.Array) -> Parts:
    """Words between any white space, in lower case; null has none."""
    return _without_empty(_coded(pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))))


def chunks(texts: pa.Array) -> Parts:
    """Texts cut before every blank or line feed that follows a non-space character."""
    texts = pc.fill_null(texts, "")
    mark = next((m for m in ("\x00", "\x01", "") if not pc.any(pc.match_substring(texts, m)).as_py()), None)
    if mark is None:
        return _coded(pa.array([_STEP.split(t) for t in texts.to_pylist()], pa.list_(pa.string())))
    if pc.any(pc.match_substring_regex(texts, rf"(^|[{SPACES}])[ \n]")).as_py():
        marked = pc.replace_substring_regex(texts, rf"([^{SPACES}])([ \n])", rf"\1{mark}\2")
    else:
        marked = pc.replace_substring(pc.replace_substring(texts, " ", mark + " "), "\n", mark + "\n")
    return _coded(pc.split_pattern(marked, mark))


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` one behind the other, and where each ends."""
    ends = np.cumsum(lengths)
    if not len(ends):
        return values[:0], ends
    return values[np.arange(ends[-1]) + np.repeat(starts - (ends - lengths), lengths)], ends
