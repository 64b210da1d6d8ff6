"""Token ids of whole texts by a BPE tokenizer that drops white space, each distinct piece of a slice once."""

from __future__ import annotations

import json
import os
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tickloom.llm.byte_tokens import byte_marks
from tickloom.llm.units import gathered, joined_runs

#: Pieces of characters that no normalisation but lower case changes and whose categories are settled; without
#: the sign that names of special tokens begin with.
SETTLED = r"^[\x21-\x3b\x3d-\x7e\xa1-\x{12f}\x{131}-\x{24f}]*$"
#: Ends a word where words are encoded one after another; no settled piece holds it.
WORD_END = "\x00"


class PieceEncoder:
    """Encodes texts piece by piece between spaces and line feeds.

    This gives the ids of the whole text for tokenizers whose words never span white space; the tests
    compare both ways. Settled pieces are parted into words and encoded many at a time, by ranks that the
    vocabulary itself gives; all others go through the library. Nothing is remembered from slice to slice.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.ranked, self.size_of, self.words = None, np.zeros(0, np.int64), ""
        model = spec["model"]
        if model.get("end_of_word_suffix") and model.get("unk_token") is None:
            self._rank(spec, model["end_of_word_suffix"])

    def _rank(self, spec: dict, suffix: str) -> None:
        """An encoder by ranks, where a word's last byte and its end are merged before anything else.

        It is used if merging in order of ids is merging in order of the merges and the words are parted by
        one pattern.
        """
        model, added = spec["model"], {token["content"] for token in spec["added_tokens"]}
        parting = [step["pattern"].get("Regex") for step in spec["pre_tokenizer"].get("pretokenizers", []) if step["type"] == "Split"]
        steps = [step["type"] for step in spec["normalizer"].get("normalizers", [])]
        if len(parting) != 1 or not parting[0] or steps != ["NFC", "Replace", "Lowercase"]:
            return
        byte_of = {mark: byte for byte, mark in enumerate(byte_marks())}

        def as_bytes(name: str) -> bytes:
            ends = name.endswith(suffix) and name != suffix
            return bytes(byte_of[c] for c in name.removesuffix(suffix)) + WORD_END.encode() * ends

        ranks = {as_bytes(name): i for name, i in model["vocab"].items() if name not in added}
        merges = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        made = [model["vocab"]["".join(merge)] for merge in merges]
        first = min(made, default=0)
        if made != sorted(set(made)) or sorted(ranks.values()) != list(range(512 + len(made))) or first != 512:
            return
        from tiktoken import Encoding

        self.ranked = Encoding("ranks", pat_str=f"[^{WORD_END}]+{WORD_END}", mergeable_ranks=ranks, special_tokens={})
        self.words = f"({parting[0]})"
        self.size_of = np.zeros(len(ranks), np.int64)
        self.size_of[list(ranks.values())] = [len(token) for token in ranks]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has; null counts as empty."""
        plain = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ").cast(pa.large_string())
        pieces = pc.split_pattern(plain, " ")
        coded = pieces.flatten().dictionary_encode()
        ids, sizes = self._encode_distinct(coded.dictionary)
        code = coded.indices.to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], np.cumsum(sizes[code])])
        ends = np.cumsum(pc.list_value_length(pieces).to_numpy(zero_copy_only=False), dtype=np.int64)
        return gathered(ids, sizes, code), np.diff(total[np.concatenate([[0], ends])])

    def _encode_distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.ranked is None:
            return self._one_by_one(pieces.to_pylist())
        usual = pc.match_substring_regex(pieces, SETTLED).to_numpy(zero_copy_only=False)
        lower = pc.utf8_lower(pieces.filter(pa.array(usual))).dictionary_encode()
        ids, own = self._by_rank(lower.dictionary)
        sizes = np.zeros(len(pieces), np.int64)
        rest, sizes[~usual] = self._one_by_one(pieces.filter(pa.array(~usual)).to_pylist())
        code = lower.indices.to_numpy(zero_copy_only=False)
        sizes[usual] = own[code]
        merged = np.zeros(sizes.sum(), np.uint32)
        by_rank = np.repeat(usual, sizes)
        merged[by_rank], merged[~by_rank] = gathered(ids, own, code), rest
        return merged, sizes

    def _by_rank(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        marked = pc.replace_substring_regex(pieces, self.words, rf"\1{WORD_END}")
        ids = self.ranked.encode_to_numpy(joined_runs(marked, [0, len(marked)], "")[0].as_py()).astype(np.uint32)
        ends = np.cumsum(pc.binary_length(marked).to_numpy(zero_copy_only=False).astype(np.int64))
        last = np.searchsorted(np.cumsum(self.size_of[ids]), ends, side="right")
        return ids, np.diff(last, prepend=0)

    def _one_by_one(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, sizes.sum()), sizes


@cache
def encoder(path: str) -> PieceEncoder:
    """One per worker process; it holds the vocabulary and no texts."""
    return PieceEncoder(path)
