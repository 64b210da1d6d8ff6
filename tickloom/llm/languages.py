"""Language of texts: scripts narrow the candidates, then Viterbi over per-word scores."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.tables import text_slices, texts_of

#: Bound of the training sample: labelled documents per language, and languages.
DOCS_PER_LANGUAGE, MAX_LANGUAGES = 4_000, 256
#: Letters the word model tells apart, the most frequent ones of the sample; others count as one.
LETTERS = 64
#: What changing the language between two words costs, in nats.
SWITCH = 8.0
#: A language may be written in a script that holds this share of its letters in the sample.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
OFF_SCRIPT = -50.0
#: Scripts by the first code point of their ranges; a range ends where the next starts.
SCRIPT_RANGES = (
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"),
    (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"),
    (0x323B0, "other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_RANGES))


@dataclass(frozen=True)
class LanguageModel:
    """Letter trigram scores: ``scores[t, l]`` is the log probability of trigram ``t`` in language ``l``."""

    languages: tuple[str, ...]
    letters: tuple[int, ...]
    scores: np.ndarray
    scripts: np.ndarray


def fit_languages(labelled: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel | None:
    """Learn from ``labelled (doc_id, text, lang)``; null languages and texts are left out.

    About ``per_language`` documents of each language are read, chosen by a hash of their id; the
    ``MAX_LANGUAGES`` most frequent languages are learned. Counts are made in Spark; what reaches the
    driver is bounded by the number of letters, trigrams and languages. Without labels: None.
    """
    labelled = labelled.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    languages = tuple(sorted(row["lang"] for row in sizes))
    if not languages:
        return None
    share = F.create_map(*[F.lit(x) for row in sizes for x in (row["lang"], min(1.0, per_language / row["count"]))])
    chance = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.filter(chance < F.coalesce(share[F.col("lang")], F.lit(0.0))).select("text", "lang")
    place = {name: k for k, name in enumerate(languages)}
    seen = sample.mapInArrow(_count_letters, "lang string, letter int, n long").groupBy("lang", "letter")
    letter_rows = seen.agg(F.sum("n").alias("n")).collect()
    total: dict[int, int] = {}
    scripts = np.zeros((len(SCRIPTS), len(languages)))
    script_of = _tables()[2]
    for row in letter_rows:
        total[row["letter"]] = total.get(row["letter"], 0) + row["n"]
        scripts[script_of[row["letter"]], place[row["lang"]]] += row["n"]
    letters = tuple(sorted(total, key=lambda c: (-total[c], c))[: LETTERS - 2])
    grams = sample.mapInArrow(_count_trigrams(letters), "lang string, gram int, n long").groupBy("lang", "gram")
    counts = np.zeros((LETTERS**3, len(languages)))
    for row in grams.agg(F.sum("n").alias("n")).collect():
        counts[row["gram"], place[row["lang"]]] = row["n"]
    known = max(1, int((counts.sum(axis=1) > 0).sum()))
    scores = np.log((counts + 0.1) / (counts.sum(axis=0) + 0.1 * known))
    used = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=0))
    return LanguageModel(languages, letters, scores.astype(np.float32), used)


def predict_languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row of ``docs (doc_id, text)``.

    The language of a text is the one whose spans hold most of its letters (the first in name order
    of equal ones) and ``score`` is their share of all letters. A text that is null or without
    letters is ``und`` with score 0, as is every text without a model; letters of a script that no
    learned language uses belong to no language. The whole text is read.
    """
    return _predicted(docs, model, False).select("doc_id", "lang_pred", "score")


def keep_languages(docs: DataFrame, model: LanguageModel | None, least: float) -> DataFrame:
    """The rows of ``docs`` whose own text has a language with ``least`` of its letters, all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            lang, score, _ = _judged(batch, shared.value, False)
            yield batch.filter(pa.array([name != UNKNOWN and share >= least for name, share in zip(lang, score)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def language_spans(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``(doc_id, start, end, lang)``: runs of words of one language, as code point offsets."""
    spans = _predicted(docs, model, True).select("doc_id", F.inline("spans"))
    return spans.select("doc_id", "start", "end", "lang")


def _predicted(docs: DataFrame, model: LanguageModel | None, with_spans: bool) -> DataFrame:
    schema = "doc_id long, lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: LETTERS ** 3 rows of languages
    return docs.select("doc_id", "text").mapInArrow(_predict(shared, with_spans), schema)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: whether it is part of a word (a letter or a mark), its lower case, its script,
    and whether it is a mark."""
    n = 0x110000
    is_letter, lower, script = np.zeros(n, bool), np.arange(n, dtype=np.uint32), np.zeros(n, np.uint8)
    is_mark = np.zeros(n, bool)
    for first, name in SCRIPT_RANGES:
        script[first:] = SCRIPTS.index(name)
    for c in [*range(0xD800), *range(0xE000, 0x32400)]:
        char = chr(c)
        if unicodedata.category(char)[0] in "LM":
            is_letter[c] = True
            is_mark[c] = unicodedata.category(char)[0] == "M"
            if len(low := char.lower()) == 1:
                lower[c] = ord(low)
    return is_letter, lower, script, is_mark


class _Words:
    """Words of a slice of texts: runs of letters of one script, as code points."""

    def __init__(self, texts: list[str]):
        is_letter, lower, script, is_mark = _tables()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.text_start = np.cumsum(sizes + 1) - sizes - 1
        letter = is_letter[points]
        kind = np.where(letter, script[points].astype(np.int16) + 1, 0)
        before = np.concatenate([[0], kind[:-1]]) if len(kind) else kind
        self.start = np.flatnonzero((kind != before) & letter)
        self.size = np.diff(np.append(np.cumsum(letter)[self.start] - 1, letter.sum()))
        self.letters = lower[points[letter]]
        self.n_marks = np.diff(np.append(0, np.cumsum(is_mark[points[letter]]))[np.append(0, np.cumsum(self.size))])
        self.script = script[points[self.start]]
        self.text = np.searchsorted(self.text_start, self.start, side="right") - 1

    def trigrams(self, letters: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Trigram of every letter with its neighbours in the word, and where each word starts."""
        code = np.ones(0x110000, np.int32)
        code[list(letters)] = np.arange(2, len(letters) + 2)
        coded = code[self.letters]
        first = np.cumsum(self.size) - self.size
        left, right = np.roll(coded, 1), np.roll(coded, -1)
        left[first] = 0
        right[first + self.size - 1] = 0
        return (left * LETTERS + coded) * LETTERS + right, first


def _count_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        words = _Words(texts_of(batch))
        yield _counted(batch, np.repeat(words.text, words.size), words.letters.astype(np.int64), "letter")


def _count_trigrams(letters: tuple[int, ...]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            words = _Words(texts_of(batch))
            yield _counted(batch, np.repeat(words.text, words.size), words.trigrams(letters)[0].astype(np.int64), "gram")

    return count


def _counted(batch: pa.RecordBatch, text: np.ndarray, what: np.ndarray, name: str) -> pa.RecordBatch:
    coded = batch.column("lang").dictionary_encode()
    both = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text] * (1 << 32) + what
    keys, n = np.unique(both, return_counts=True)
    lang = coded.dictionary.take(pa.array(keys >> 32))
    return pa.record_batch([lang, (keys & 0xFFFFFFFF).astype(np.int32), n], ["lang", name, "n"])


def _judged(batch: pa.RecordBatch, model: LanguageModel | None, with_spans: bool) -> tuple[list, np.ndarray, list]:
    """Language, its share of the letters, and spans of each text of a slice."""
    n = batch.num_rows
    words = _Words(texts_of(batch))
    if model is None or not len(words.start):
        return [UNKNOWN] * n, np.zeros(n), [[]] * n
    best = label_words(words, model, n)
    size = len(model.languages)
    at = words.text[best >= 0] * size + best[best >= 0]
    weight = np.bincount(at, words.size[best >= 0], minlength=n * size).reshape(n, size)
    letters = np.bincount(words.text, words.size, minlength=n)
    has_letter = np.bincount(words.text, words.size - words.n_marks, minlength=n) > 0
    # letters of unlearned scripts alone leave all shares at 0: the first language, which is no evidence
    lang = [model.languages[k] if has else UNKNOWN for k, has in zip(weight.argmax(axis=1), has_letter)]
    spans = _spans(words, best, model, n) if with_spans else [[]] * n
    return lang, np.where(has_letter, weight.max(axis=1) / np.maximum(1, letters), 0.0), spans


def _predict(shared, with_spans: bool):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        for batch in text_slices(batches):
            lang, score, spans = _judged(batch, shared.value, with_spans)
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(lang, pa.string()), pa.array(score)]
            yield pa.record_batch([*columns, pa.array(spans, kind)], ["doc_id", "lang_pred", "score", "spans"])

    return predict


def label_words(words: _Words, model: LanguageModel, n: int) -> np.ndarray:
    """Language of each word by Viterbi within its text; -1 for words no learned language can have.

    All texts of the slice go one word further at a time, the longest first, so that a step is one
    operation on as many rows as texts are still going.
    """
    grams, first = words.trigrams(model.letters)
    scores = np.add.reduceat(model.scores[grams], first, axis=0)
    allowed = model.scripts[words.script]
    fits = allowed.any(axis=1)
    scores = np.where(allowed, scores, OFF_SCRIPT)
    scores[~fits] = 0
    count = np.bincount(words.text, minlength=n)
    begin = np.cumsum(count) - count
    order = np.argsort(-count, kind="stable")
    going = np.searchsorted(-count[order], -np.arange(count.max()), side="left")
    state = np.zeros((n, scores.shape[1]), np.float64)
    stays = np.zeros(scores.shape, bool)
    came = np.zeros(len(scores), np.int16)
    for step, rows in enumerate(going):
        at = begin[order[:rows]] + step
        now = state[:rows]
        leader = now.argmax(axis=1)
        jump = now[np.arange(rows), leader][:, None] - SWITCH
        stays[at] = now >= jump
        came[at] = leader
        state[:rows] = np.maximum(now, jump) - jump + scores[at]
    label = np.zeros(len(scores), np.int64)
    last = state.argmax(axis=1)
    for step in range(len(going) - 1, -1, -1):
        rows = going[step]
        at = begin[order[:rows]] + step
        label[at] = last[:rows]
        last[:rows] = np.where(stays[at, last[:rows]], last[:rows], came[at])
    label[~fits] = -1
    return label


def _spans(words: _Words, best: np.ndarray, model: LanguageModel, n: int) -> list[list[dict]]:
    spans: list[list[dict]] = [[] for _ in range(n)]
    new = np.ones(len(best), bool)
    new[1:] = (best[1:] != best[:-1]) | (words.text[1:] != words.text[:-1])
    firsts = np.flatnonzero(new)
    for first, last in zip(firsts, [*(firsts[1:] - 1), len(best) - 1]):
        text = words.text[first]
        offset = words.text_start[text]
        spans[text].append(
            {
                "start": int(words.start[first] - offset),
                "end": int(words.start[last] + words.size[last] - offset),
                "lang": model.languages[best[first]] if best[first] >= 0 else UNKNOWN,
            }
        )
    return spans
