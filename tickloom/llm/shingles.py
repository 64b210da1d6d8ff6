"""Five-word shingles of texts as hashes, vectorised over an Arrow slice."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from tickloom.llm.tables import mixed

WORDS = 5
NOT_WORD = re.compile(r"[\W_]+")


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word, in reading order.

    Words are lower-case pieces between white space, without punctuation; what has no letter or digit
    is no word.
    """
    pieces = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(pieces).to_numpy(zero_copy_only=False))
    coded = pieces.flatten().dictionary_encode()
    plain = (NOT_WORD.sub("", piece) for piece in coded.dictionary.to_pylist())
    table = np.fromiter((xxhash.xxh64_intdigest(w) if w else 0 for w in plain), np.uint64, len(coded.dictionary))
    hashes = table[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.uint64)
    is_word = hashes != 0
    return hashes[is_word], owner[is_word]


def sequence_keys(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys per text that are equal when its words are equal, in order."""
    counts = np.bincount(owner, minlength=n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    keys = []
    for salt in (11, 12):
        terms = mixed(hashes ^ mixed(place, salt), salt)
        total = np.zeros(n, np.uint64)
        np.add.at(total, owner, terms)
        keys.append(total.view(np.int64))
    return keys[0], keys[1]


def shingle_counts(
    hashes: np.ndarray, owner: np.ndarray, words: int = WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and number of occurrences of each distinct shingle, sorted by text and hash.

    A text of fewer words than ``words`` has one shingle of all of them.
    """
    counts = np.bincount(owner) if len(owner) else np.zeros(0, int)
    size = np.minimum(counts, words)[owner] if len(owner) else owner
    start = np.arange(len(owner))
    last = np.repeat(np.cumsum(counts), counts)
    fits = start + size <= last
    first = start[fits]
    value = np.zeros(len(first), np.uint64)
    for k in range(words):
        at = first + k
        inside = k < size[first]
        word = hashes[np.minimum(at, len(hashes) - 1)] if len(hashes) else hashes
        value = np.where(inside, mixed(value * np.uint64(0x100000001B3) + word, k), value)
    texts = owner[first]
    order = np.lexsort((value, texts))
    value, texts = value[order], texts[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (texts[1:] != texts[:-1])
    at = np.flatnonzero(new)
    return texts[at], value[at], np.diff(np.append(at, len(value)))
