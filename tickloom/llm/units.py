"""Texts cut at the spaces where no tokenizer of words looks across, as distinct units and their codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Empty, or white space, a control or a mark of width zero at an end; more than any tokenizer's white space.
LOOSE = (
    r"^$|^[\x00-\x20\x7f-\xa0\x{ad}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{206f}\x{3000}\x{feff}]"
    r"|[\x00-\x20\x7f-\xa0\x{ad}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{206f}\x{3000}\x{feff}]$"
)


@dataclass
class Units:
    """``distinct`` units without the space in front of them; ``code`` of each unit; how many each text has.

    ``loose`` tells the distinct ones that must not be encoded next to others.
    """

    distinct: pa.Array
    loose: np.ndarray
    code: np.ndarray
    counts: np.ndarray


def units_of(texts: pa.Array) -> Units:
    """Cut every text at each space that has no white space beside it and stands at no end.

    A text is its units with one space between them; a text has one unit at least, the empty one that of
    the empty unit. Null counts as empty.
    """
    parts = pc.split_pattern(pc.fill_null(texts, "").cast(pa.large_string()), " ")
    counts = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    distinct, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    loose = _loose(distinct)
    if loose.any():
        first = np.zeros(len(code), bool)
        first[np.cumsum(counts) - counts] = True
        unsafe = loose[code]
        starts = np.flatnonzero(first | ~(unsafe | np.concatenate([[False], unsafe[:-1]])))
        sizes = np.diff(np.append(starts, len(code)))
        many = np.flatnonzero(sizes > 1)
        if len(many):
            owner = np.cumsum(first) - 1
            counts = np.bincount(owner[starts], minlength=len(counts))
            inside = np.repeat(sizes > 1, sizes)
            ends = np.concatenate([[0], np.cumsum(sizes[many])])
            joined = joined_runs(distinct.take(pa.array(code[inside])), ends, " ").dictionary_encode()
            code = code[starts]
            code[many] = len(distinct) + joined.indices.to_numpy(zero_copy_only=False)
            distinct = pa.concat_arrays([distinct, joined.dictionary])
            loose = np.concatenate([loose, _loose(joined.dictionary)])
    return Units(distinct, loose, code, counts)


def _loose(words: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(words, LOOSE).to_numpy(zero_copy_only=False)


def joined_runs(words: pa.Array, cuts: np.ndarray, mark: str) -> pa.Array:
    """The words of each run, joined; ``cuts`` are the ends of runs, from 0 on."""
    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words)
    return pc.binary_join(lists, pa.scalar(mark, words.type))


def gathered(values: np.ndarray, sizes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The runs of ``values``, of the given sizes, that ``code`` asks for, one after another."""
    size = sizes[code]
    first = (np.cumsum(sizes) - sizes)[code]
    before = np.cumsum(size) - size
    return values[np.repeat(first - before, size) + np.arange(size.sum())]
