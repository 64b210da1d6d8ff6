"""Token ids by a byte-level BPE tokenizer, each distinct unit of a slice of texts encoded once."""

from __future__ import annotations

import json
import os
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tickloom.llm.units import Units, gathered, joined_runs, units_of

#: How byte-level tokenizers part words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose categories no Unicode version has changed, so that both libraries part them alike.
SETTLED = r"^[\x00-\x{24F}]*$"


class ByteEncoder:
    """Ids as the ``tokenizers`` library gives them, and the bytes that each id stands for.

    Units of settled characters are encoded many at a time, by ranks that the vocabulary itself gives,
    and parted again by the lengths of their tokens; all others go through the library. Nothing is
    remembered from slice to slice. With ``plain``, names of special tokens in texts are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        level = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or level.get("type") != "ByteLevel" or level.get("add_prefix_space"):
            raise ValueError("not a byte-level tokenizer that takes texts as they are")
        added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        if any(" " in name for name in added):
            raise ValueError("a special token with a space would be cut")
        self.special = [] if plain else list(added)
        vocab = {**spec["model"]["vocab"], **added}
        byte_of = {mark: byte for byte, mark in enumerate(byte_marks())}
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for name, i in vocab.items():
            self.bytes_of[i] = name.encode() if name in added else bytes(byte_of[c] for c in name)
        self.size_of = np.fromiter(map(len, self.bytes_of), np.int64, len(self.bytes_of))
        self.ranked = self._by_rank(spec["model"], added) if level.get("use_regex", True) else None

    def _by_rank(self, model: dict, added: dict):
        """An encoder by ranks, if merging in order of ids is merging in order of the merges."""
        merges = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        made = [model["vocab"]["".join(merge)] for merge in merges]
        if made != sorted(set(made)) or len(made) + 256 != len(model["vocab"].keys() - added.keys()):
            return None
        from tiktoken import Encoding

        ranks = {self.bytes_of[i]: i for name, i in model["vocab"].items() if name not in added}
        return Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has; null counts as empty."""
        units = units_of(texts)
        ids, sizes = self.encode_units(units)
        # the first unit of a text has no space in front
        starts = np.cumsum(units.counts) - units.counts
        first, place = np.unique(units.code[starts], return_inverse=True)
        own = self._one_by_one(units.distinct.take(pa.array(first)).to_pylist())
        code = units.code.copy()
        code[starts] = len(sizes) + place
        sizes = np.concatenate([sizes, own[1]])
        total = np.concatenate([[0], np.cumsum(sizes[code])])
        ids = gathered(np.concatenate([ids, own[0]]), sizes, code)
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(units.counts)])])

    def encode_units(self, units: Units) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every distinct unit with a space in front, one after another, and how many each has."""
        if self.ranked is None:
            return self._one_by_one([" " + word for word in units.distinct.to_pylist()])
        odd = units.loose | ~pc.match_substring_regex(units.distinct, SETTLED).to_numpy(zero_copy_only=False)
        for name in self.special:
            odd |= pc.match_substring(units.distinct, name).to_numpy(zero_copy_only=False)
        usual = units.distinct.filter(pa.array(~odd))
        ids, sizes = np.zeros(0, np.uint32), np.zeros(len(odd), np.int64)
        if len(usual):
            ids = self.ranked.encode_to_numpy(" " + joined_runs(usual, [0, len(usual)], " ")[0].as_py()).astype(np.uint32)
            ends = np.cumsum(pc.binary_length(usual).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            last = np.searchsorted(np.cumsum(self.size_of[ids]), ends, side="right")
            sizes[~odd] = np.diff(np.concatenate([[0], last]))
        if odd.any():
            rest = [" " + word for word in units.distinct.filter(pa.array(odd)).to_pylist()]
            more, sizes[odd] = self._one_by_one(rest)
            merged = np.zeros(sizes.sum(), np.uint32)
            from_rest = np.repeat(odd, sizes)
            merged[from_rest], merged[~from_rest] = more, ids
            ids = merged
        return ids, sizes

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum()), sizes


def byte_marks() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be seen."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in seen else chr(next(other)) for b in range(256)]


@cache
def byte_encoder(path: str, plain: bool = False) -> ByteEncoder:
    """One per worker process; it holds the vocabulary and no texts."""
    return ByteEncoder(path, plain)
