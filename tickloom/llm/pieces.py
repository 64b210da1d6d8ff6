"""SentencePiece encoding and decoding by shortest paths through a weighted transducer."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tickloom.llm.tables import text_slices
from tickloom.llm.units import Units, gathered, joined_runs, units_of

SPACE = "▁"
NONE, FALLBACK = -1, -2
MOST_UNITS = 1 << 18
MARKS = ",."
MOST_PAIRS = 1 << 20
#: So many units are composed together; longer ones are composed by themselves.
TOGETHER, LONGEST_TOGETHER = 1 << 13, 64
UNREACHED = -3


class PieceTransducer:
    """The normaliser, the pieces and the byte fallback of a BPE model, compiled for composition.

    States are the last piece read. An arc reads a piece and costs 0 if the model's merges leave the two
    pieces apart, and infinity (no arc) if they would merge across their border: a sequence of pieces is
    what the merges make of a text exactly when every two neighbours stay apart. A character that is no
    piece has an arc that writes its bytes. Composed with an input, each of its prefixes so has one path
    of finite weight, and the tropical shortest path is found from left to right.

    Inputs are composed unit by unit, a unit being spaces and the characters up to the next ones: no
    piece has a space after another character, which is checked here. A mark after a letter is a unit too
    where no piece holds both. Units are remembered in two generations of ``MOST_UNITS``: when the younger
    one is full the older one goes, so that what is in use stays.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.ids, self.score, self.bytes_of = {}, {}, []
        self.byte_ids = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.ids[piece], self.score[piece] = i, model.get_score(i)
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
        if missing := {c for piece in self.ids for c in piece} - self.ids.keys():
            raise ValueError(f"characters of pieces that are no pieces: {sorted(missing)[:5]}")
        self.by_units = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        # the arcs as a prefix tree: a piece has its id, a mere beginning of pieces NONE
        self.arcs = {piece[:k]: NONE for piece in self.ids for k in range(1, len(piece))} | self.ids
        self.pieces = {i: p for p, i in self.ids.items()}
        self.arrow_bytes = pa.array(self.bytes_of, pa.large_binary())
        self.is_byte = np.zeros(len(self.bytes_of), bool)
        self.is_byte[self.byte_ids] = True
        self.apart: dict[tuple[int, int], bool] = {}
        self._number_arcs()
        self.stems, self.again = pa.array([], pa.large_string()), np.zeros(0, bool)
        self.stem_ids, self.stem_sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.marks = {
            mark: (self.ids[mark],)
            for mark in MARKS
            if mark in self.ids and not any(mark in piece and any(c.isalpha() for c in piece) for piece in self.ids)
        }

    def _number_arcs(self) -> None:
        """The prefix tree in arrays: characters, nodes and the arcs between them have numbers.

        Node 0 is the root. ``arc_keys`` are node times characters plus character, ascending, and
        ``arc_ends`` the nodes that these arcs reach. ``pair_keys`` and ``pair_free`` repeat ``apart`` at
        a place that the pair determines; a pair that finds another there is looked up.
        """
        characters = sorted({c for prefix in self.arcs for c in prefix[-1:]})
        self.character = np.zeros(0x110000, np.int32)
        self.character[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self.n_characters = len(characters) + 1
        node = {"": 0} | {prefix: k for k, prefix in enumerate(self.arcs, 1)}
        keys = np.array([node[p[:-1]] * self.n_characters + int(self.character[ord(p[-1])]) for p in self.arcs], np.int64)
        order = np.argsort(keys)
        self.arc_keys, self.arc_ends = keys[order], order + 1
        self.node_piece = np.array([NONE, *self.arcs.values()], np.int64)
        self.pair_keys, self.pair_free = np.full(MOST_PAIRS, -1, np.int64), np.zeros(MOST_PAIRS, bool)

    # the normaliser: a space in front, spaces as visible marks, everything else as it is
    def units(self, text: str) -> list[str]:
        if not text:
            return []
        whole = SPACE + text.replace(" ", SPACE)
        if not self.by_units:
            return [whole]
        units = [SPACE + part for part in whole.split(SPACE)[1:]]
        # a run of spaces stands in front of the unit after it
        joined, run = [], ""
        for unit in units:
            if unit == SPACE:
                run += unit
            else:
                joined.append(run + unit)
                run = ""
        return [*joined, run] if run else joined

    def encode(self, text: str) -> list[int]:
        """Ids of a text; the empty text has none."""
        return [i for unit in self.units(text) for i in self._of_unit(unit)]

    def _of_unit(self, unit: str) -> tuple[int, ...]:
        mark = self.marks.get(unit[-1:], ())
        if mark and unit[-2:-1].isalpha():
            unit = unit[:-1]
        else:
            mark = ()
        found = self.known.get(unit)
        if found is None:
            found = self.older.get(unit)
            if len(self.known) >= MOST_UNITS:
                self.older, self.known = self.known, {}
            found = self.known[unit] = tuple(self.shortest_path(unit)) if found is None else found
        return found + mark

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after another, how many each has, how many of them are bytes, and whether
        they give the text back; each distinct unit is composed once. Null counts as empty."""
        texts = pc.fill_null(texts, "")
        filled = pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
        if self.by_units:
            units = units_of(texts)
        else:
            whole = texts.cast(pa.large_string()).dictionary_encode()
            code = whole.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            units = Units(whole.dictionary, np.zeros(len(whole.dictionary), bool), code, np.ones(len(code), np.int64))
        ids, sizes = self._of_words(units.distinct)
        owner = np.repeat(np.arange(len(filled)), units.counts)
        code, used = units.code[filled[owner]], owner[filled[owner]]

        def summed(per_unit: np.ndarray) -> np.ndarray:
            return np.bincount(used, per_unit[code], len(filled)).astype(np.int64)

        ends = np.concatenate([[0], np.cumsum(self.is_byte[ids])])[np.cumsum(sizes)] if len(sizes) else sizes
        n_bytes = summed(np.diff(ends, prepend=0))
        wrong = summed(~self._gives_back(units.distinct, ids, sizes))
        return gathered(ids, sizes, code), summed(sizes), n_bytes, wrong == 0

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, a space being in front, one after another, and how many each has.

        A mark after a letter is a unit of its own here too.
        """
        marked = pc.match_substring_regex(words, f"[A-Za-z][{''.join(self.marks)}]$" if self.marks else "$^.")
        stems = pc.if_else(marked, pc.utf8_slice_codeunits(words, 0, -1), words).dictionary_encode()
        ids, sizes = self._of_stems(stems.dictionary)
        code = stems.indices.to_numpy(zero_copy_only=False)
        last = pc.utf8_slice_codeunits(words.filter(marked), -1).dictionary_encode()
        mark_ids = np.array([self.marks[mark][0] for mark in last.dictionary.to_pylist()], np.int64)[last.indices.to_numpy(zero_copy_only=False)]
        marked = marked.to_numpy(zero_copy_only=False)
        return np.insert(gathered(ids, sizes, code), np.cumsum(sizes[code])[marked], mark_ids), sizes[code] + marked

    def _of_stems(self, stems: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_of_words` for distinct ones; those that are not remembered are composed together."""
        known = len(self.stems)
        place = pc.index_in(stems, value_set=self.stems)
        is_new = pc.is_null(place)
        new = stems.filter(is_new)
        ids, sizes = self.shortest_paths([SPACE + stem.replace(" ", SPACE) for stem in new.to_pylist()])
        is_new = is_new.to_numpy(zero_copy_only=False)
        place = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        place[is_new] = known + np.arange(len(new))
        self.stems = pa.concat_arrays([self.stems, new])
        self.stem_ids, self.stem_sizes = np.concatenate([self.stem_ids, ids]), np.concatenate([self.stem_sizes, sizes])
        self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
        self.again[place[~is_new]] = True
        found = gathered(self.stem_ids, self.stem_sizes, place), self.stem_sizes[place]
        if len(self.stems) > MOST_UNITS:
            self._forget()
        return found

    def _forget(self) -> None:
        """Keep the stems that were met again since this was last done, or none if they are too many."""
        kept = np.flatnonzero(self.again)[: MOST_UNITS if self.again.sum() <= MOST_UNITS // 2 else 0]
        self.stem_ids, self.stem_sizes = gathered(self.stem_ids, self.stem_sizes, kept), self.stem_sizes[kept]
        self.stems, self.again = self.stems.take(pa.array(kept)), np.zeros(len(kept), bool)

    def _gives_back(self, units: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which units, with a space in front, are what the bytes of their ids join to."""
        data = self.arrow_bytes.take(pa.array(ids))
        joined = joined_runs(data, np.concatenate([[0], np.cumsum(sizes)]), b"")
        given = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), pc.replace_substring(units, SPACE, " "), pa.scalar("", pa.large_string()))
        return pc.equal(joined, given.cast(pa.large_binary())).to_numpy(zero_copy_only=False)

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space that the normaliser put in front."""
        table = self.bytes_of
        data = b"".join([table[i] for i in ids])
        return data.removeprefix(b" ").decode("utf-8", "replace")

    def shortest_path(self, unit: str) -> list[int]:
        """The arcs of the only path of finite weight through the unit composed with the transducer."""
        n, arcs, apart = len(unit), self.arcs, self.apart
        state, back = [None] * (n + 1), [0] * (n + 1)
        state[0] = NONE
        for i in range(n):
            last = state[i]
            if last is None:
                continue
            for j in range(i + 1, n + 1):
                piece = arcs.get(unit[i:j])
                if piece is None:
                    if j == i + 1:
                        state[j], back[j] = FALLBACK, i
                    break
                if piece >= 0 and state[j] is None:
                    free = apart.get((last, piece))
                    if self._stay_apart(last, piece) if free is None else free:
                        state[j], back[j] = piece, i
        path, end = [], n
        while end:
            start = back[end]
            if state[end] == FALLBACK:
                path += [self.byte_ids[b] for b in reversed(unit[start:end].encode("utf-8", "surrogatepass"))]
            else:
                path.append(state[end])
            end = start
        return path[::-1]

    def shortest_paths(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`shortest_path` for every unit, one after another, and how many ids each has.

        Many are composed together, position by position; long ones go by themselves.
        """
        size = np.fromiter(map(len, units), np.int64, len(units))
        short = size <= LONGEST_TOGETHER
        parts, counts = [np.zeros(0, np.int64)], np.zeros(len(units), np.int64)
        for rows in np.split(np.flatnonzero(short), np.arange(TOGETHER, short.sum(), TOGETHER)):
            text = "".join([units[row] for row in rows.tolist()]).encode("utf-32-le", "surrogatepass")
            ids, counts[rows] = self._composed(np.frombuffer(text, np.uint32), size[rows])
            parts.append(ids)
        alone = [self.shortest_path(units[row]) for row in np.flatnonzero(~short).tolist()]
        counts[~short] = [len(path) for path in alone]
        by_itself, ids = np.repeat(~short, counts), np.zeros(counts.sum(), np.int64)
        ids[~by_itself] = np.concatenate(parts)
        ids[by_itself] = list(chain.from_iterable(alone))
        return ids, counts

    def _composed(self, text: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, given as code points one after another, and how many each has."""
        # a unit of n characters has the places 0 to n, all units' places are numbered through
        letters, unit = self.character[text], np.repeat(np.arange(len(size)), size)
        first = np.cumsum(size + 1) - size - 1
        place, last = np.arange(len(letters)) + unit, (first + size)[unit]
        odd = np.flatnonzero(letters == 0)
        starts, ends, pieces = [place[odd]], [place[odd] + 1], [np.full(len(odd), FALLBACK)]
        at, node, length = np.arange(len(letters)), np.zeros(len(letters), np.int64), 0
        while len(at):
            key = node * self.n_characters + letters[at + length]
            slot = np.minimum(np.searchsorted(self.arc_keys, key), len(self.arc_keys) - 1)
            arc = self.arc_keys[slot] == key
            at, node, length = at[arc], self.arc_ends[slot[arc]], length + 1
            piece = self.node_piece[node]
            whole = piece >= 0
            starts.append(place[at[whole]])
            ends.append(starts[-1] + length)
            pieces.append(piece[whole])
            more = place[at] + length < last[at]
            at, node = at[more], node[more]
        start, end, piece = map(np.concatenate, (starts, ends, pieces))
        state, back = np.full(len(letters) + len(size), UNREACHED, np.int64), np.zeros(len(letters) + len(size), np.int64)
        state[first] = NONE
        step = (start - np.repeat(first, size + 1)[start]).astype(np.uint8)
        order = np.argsort(step, kind="stable")
        for arcs in np.split(order, np.cumsum(np.bincount(step))[:-1]):
            arcs = arcs[(state[start[arcs]] != UNREACHED) & (state[end[arcs]] == UNREACHED)]
            free = piece[arcs] == FALLBACK
            asked = arcs[~free]
            free[~free] = self._all_apart(state[start[asked]], piece[asked])
            arcs = arcs[free]
            state[end[arcs]], back[end[arcs]] = piece[arcs], start[arcs]
        # from the ends back, an id of each unit at a time
        owner, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left = np.flatnonzero(size)
        here = (first + size)[left]
        while len(left):
            owner.append(left)
            # a character that is no piece stands for its bytes, beyond the ids
            found.append(np.where(state[here] == FALLBACK, len(self.bytes_of) + text[here - 1 - left], state[here]))
            here = back[here]
            more = here != first[left]
            left, here = left[more], here[more]
        owners = np.concatenate(owner)[::-1]
        order = np.argsort(owners, kind="stable")
        owners, ids = owners[order], np.concatenate(found)[::-1][order]
        if len(odd):
            is_odd = ids >= len(self.bytes_of)
            character, code = np.unique(ids[is_odd] - len(self.bytes_of), return_inverse=True)
            written = [chr(c).encode("utf-8", "surrogatepass") for c in character.tolist()]
            n_bytes = np.array([len(data) for data in written])
            many = np.ones(len(ids), np.int64)
            many[is_odd] = n_bytes[code]
            ids, owners, is_odd = np.repeat(ids, many), np.repeat(owners, many), np.repeat(is_odd, many)
            ids[is_odd] = gathered(np.array(self.byte_ids)[list(b"".join(written))], n_bytes, code)
        return ids, np.bincount(owners, minlength=len(size))

    def _all_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_stay_apart`` of many pairs."""
        key = (left - FALLBACK) * len(self.bytes_of) + right
        place = key * 0x9E3779B1 % MOST_PAIRS
        missing = np.flatnonzero(self.pair_keys[place] != key)
        if not len(missing):
            return self.pair_free[place]
        free = self.pair_free[place]
        _, one, same = np.unique(key[missing], return_index=True, return_inverse=True)
        one = missing[one]
        pairs = zip(left[one].tolist(), right[one].tolist())
        found = np.array([self._stay_apart(*pair) if (known := self.apart.get(pair)) is None else known for pair in pairs])
        free[missing] = found[same]
        self.pair_keys[place[one]] = key[one]
        self.pair_free[place[one]] = found
        return free

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether merging the two texts together gives just these two pieces."""
        if len(self.apart) >= MOST_PAIRS:
            self.apart.clear()
        pair = [p for p in (self.pieces.get(left), self.pieces[right]) if p is not None]
        found = self.apart[left, right] = self.merged("".join(pair)) == pair
        return found

    def merged(self, text: str) -> list[str]:
        """The merges themselves, for two pieces: always the best-scored neighbours, then the leftmost."""
        symbols, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                value = score.get(symbols[k] + symbols[k + 1])
                if value is not None and (best is None or value > best):
                    best, at = value, k
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]


@cache
def transducer(path: str) -> PieceTransducer:
    """One per worker process, so that units are remembered from task to task."""
    return PieceTransducer(path)


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids)`` for every row of ``docs (doc_id, text)``; a null or empty text has no ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            ids, sizes, _, _ = transducer(model).encode_all(batch.column("text"))
            cuts = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            lists = pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32)))
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), lists], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, ids array<int>")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """``(doc_id, text)`` for rows ``(doc_id, ids)``; null ids count as none.

    The text is the one that was encoded, but that a visible space mark in it comes back as a space.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [transducer(model).decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def piece_digest(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, n_pieces, n_bytes, ids_crc32, round_trip)``: encoded and decoded, without the ids.

    ``n_bytes`` counts the ids of the byte fallback; ``round_trip`` says that decoding gives the text
    back (null counts as empty).
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            ids, sizes, n_bytes, same = transducer(model).encode_all(batch.column("text"))
            parts = np.split(ids.astype("<u4"), np.cumsum(sizes)[:-1])
            columns = [sizes, n_bytes, np.array([zlib.crc32(part) for part in parts], np.int64), same]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), *columns], ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "round_trip"])

    schema = "doc_id long, n_pieces long, n_bytes long, ids_crc32 long, round_trip boolean"
    return docs.select("doc_id", "text").mapInArrow(digest, schema)
