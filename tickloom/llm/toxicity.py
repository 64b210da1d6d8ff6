"""Toxicity by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.shingles import NOT_WORD
from tickloom.llm.tables import mixed, text_slices, written

#: Bounds of the fit: labelled documents per mark, features and grades.
DOCS_PER_MARK, FEATURES, GRADES = 12_000, 8_192, 4
#: Lengths of the letter runs that are features beside whole words.
RUNS = (4, 5)
#: A run or word is a feature if its log odds exceed this and its likelihood ratio statistic (G) the
#: other: chance exceeds it about once in 40,000 features.
LEAST_LOG_ODDS, LEAST_G = 1.5, 18.0
#: A document of a marked grade gets one grade more for each of these numbers of strong words passed.
GRADE_STEPS = (2, 5)
REJECT_SEVERITY = 0.5
STEPS, RATE, RIDGE = 400, 0.1, 1e-4
#: Bytes of sampled texts whose features are spread over their texts at once, some hundred times as many.
SAMPLE_BYTES = 1 << 20


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade <= k) = sigmoid(thresholds[k] - weights of the features that occur)."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_mark: int = DOCS_PER_MARK) -> OrdinalModel | None:
    """Learn severity grades from ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``.

    Labels only say toxic or not. Grade 0 is not toxic; a toxic document has grade 1, and one more for
    each of ``GRADE_STEPS`` that its number of strongly toxic words reaches, so grades are ordered by
    how much of it there is. Those words and the features are found on the sample: a feature is a
    whole word or a run of letters in a word (the word's ends marked) that is over-represented in
    toxic documents. About ``per_mark`` documents of each mark are read, chosen by a hash of their
    id. The driver gets at most ``FEATURES`` features and, of each sampled document, those it has.
    Null labels are left out; without documents of both marks: None.
    """
    marks = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {row["toxic"]: row["count"] for row in marks.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    if len(sizes) < 2:
        return None
    shares = {mark: min(1.0, per_mark / n) for mark, n in sizes.items()}
    chance = F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    toxic = F.col("toxic") > 0
    chosen = marks.filter(chance < F.when(toxic, shares[True]).otherwise(shares[False]))
    # about 2 * per_mark ids, whatever the size of the tables
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    sample = written(texts.select("doc_id", "text", toxic.cast("long").alias("toxic")), "labelled")
    n_toxic, n = sample.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    if not n_toxic or n_toxic == n:
        return None
    seen = sample.mapInArrow(_features_by_mark, "feature long, toxic long, n long").groupBy("feature")
    seen = seen.agg(F.sum(F.col("n") * F.col("toxic")).alias("bad"), F.sum("n").alias("all"))
    odds = F.log((F.col("bad") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("all") - F.col("bad") + 0.5) / (n - n_toxic + 1.0))
    base = float(n_toxic) / n
    good, rate = F.col("all") - F.col("bad"), F.col("bad") / F.col("all")
    rest = F.when(good > 0, good * F.log((1 - rate) / F.lit(1 - base))).otherwise(0.0)
    ratio = 2 * (F.col("bad") * F.log(rate / F.lit(base)) + rest)
    strong = seen.filter("bad > 0").withColumn("g", ratio).filter((F.col("g") >= LEAST_G) & (odds >= LEAST_LOG_ODDS))
    kept = strong.orderBy(F.desc("g"), "feature").limit(FEATURES)
    rows = kept.select("feature").collect()
    features = np.array(sorted(row["feature"] for row in rows), np.int64)
    found = sample.mapInArrow(_grade_rows(features), "toxic long, words long, present binary").collect()
    grades = np.array([r["toxic"] and 1 + sum(r["words"] >= s for s in GRADE_STEPS) for r in found])
    present = [np.frombuffer(r["present"], np.int32) for r in found]
    return _fit(features, present, grades)


def _fit(features: np.ndarray, present: list[np.ndarray], grades: np.ndarray) -> OrdinalModel:
    """Maximum likelihood with a ridge, by gradient steps with momentum and scaling (Adam).

    One weight per feature is shared by all thresholds; these stay in order as sums of positive gaps.
    """
    owner = np.repeat(np.arange(len(present)), [len(p) for p in present])
    feature = np.concatenate(present) if present else np.zeros(0, np.int64)
    levels = int(grades.max())
    share = [(grades <= k).mean() for k in range(levels)]
    first = math.log((share[0] + 1e-3) / (1 - share[0] + 1e-3))
    parameters = np.concatenate([np.zeros(len(features)), [first], np.zeros(levels - 1)])
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    n, low = len(grades), grades - 1
    for step in range(1, STEPS + 1):
        weights, thresholds = parameters[: len(features)], _thresholds(parameters[len(features) :])
        score = np.bincount(owner, weights[feature], minlength=n)
        edges = np.concatenate([[-40.0], thresholds, [40.0]])
        upper, lower = _sigmoid(edges[grades + 1] - score), _sigmoid(edges[low + 1] - score)
        chance = np.maximum(upper - lower, 1e-12)
        slope_up, slope_low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_score = (slope_up - slope_low) / n
        by_edge = np.bincount(low + 1, slope_low, minlength=levels + 2) - np.bincount(grades + 1, slope_up, minlength=levels + 2)
        by_threshold = by_edge[1 : levels + 1] / n
        by_gap = np.cumsum(by_threshold[::-1])[::-1]
        by_gap[1:] *= np.exp(parameters[len(features) + 1 :])
        gradient = np.concatenate([np.bincount(feature, by_score[owner], minlength=len(features)) + RIDGE * weights, by_gap])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        parameters = parameters - RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return OrdinalModel(features, parameters[: len(features)], _thresholds(parameters[len(features) :]))


def _thresholds(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def predict_toxicity(docs: DataFrame, model: OrdinalModel | None, reject: float = REJECT_SEVERITY) -> DataFrame:
    """``(doc_id, severity, p_toxic, grade, toxic)`` for every row of ``docs (doc_id, text)``.

    ``severity`` is the expected grade, ``p_toxic`` the probability of a grade above 0, ``grade`` the
    most probable one; ``toxic`` says that the severity reaches ``reject``. Features of the whole text
    count once each. A null or empty text has none and gets the model's base severity; without a
    model every severity is 0.
    """
    schema = "doc_id long, severity double, p_toxic double, grade int, toxic boolean"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: FEATURES numbers
    return docs.select("doc_id", "text").mapInArrow(_predict(shared, reject), schema)


def drop_toxic(docs: DataFrame, model: OrdinalModel | None, reject: float = REJECT_SEVERITY) -> DataFrame:
    """The rows of ``docs`` whose own text is not toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            yield batch.filter(pa.array(_severities(batch, shared.value)[0] < reject))

    return docs.mapInArrow(clean, docs.schema)


def _predict(shared, reject: float):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            severity, p_toxic, grade = _severities(batch, shared.value)
            yield pa.record_batch(
                [batch.column("doc_id").cast(pa.int64()), severity, p_toxic, grade.astype(np.int32), pa.array(severity >= reject)],
                ["doc_id", "severity", "p_toxic", "grade", "toxic"],
            )

    return predict


def _severities(batch: pa.RecordBatch, model: OrdinalModel | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = batch.num_rows
    if model is None:
        return np.zeros(n), np.zeros(n), np.zeros(n)
    owner, present, _ = _present(batch, model.features)
    score = np.bincount(owner, model.weights[present], minlength=n)
    at_most = _sigmoid(model.thresholds[None, :] - score[:, None])
    chances = np.diff(np.concatenate([np.zeros((n, 1)), at_most, np.ones((n, 1))], axis=1), axis=1)
    return (1 - at_most).sum(axis=1), 1 - at_most[:, 0], chances.argmax(axis=1)


# --- features ---------------------------------------------------------------------------


def _word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a word and of the letter runs in it, and the word each belongs to."""
    marked = ["" if not w else f"^{w}$" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(marked)), sizes)
    value, place = np.zeros(len(points), np.uint64), np.arange(len(points))
    end = np.cumsum(sizes)[owner]
    hashes, owners = [], []
    for k in range(max(RUNS)):
        ahead = np.minimum(place + k, max(0, len(points) - 1))
        value = mixed(value * np.uint64(31) + points[ahead], k)
        if k + 1 in RUNS:
            fits = place + k < end
            hashes.append(value[fits])
            owners.append(owner[fits])
    whole = np.zeros(len(marked), np.uint64)
    np.add.at(whole, owner, mixed(points + ((place - (end - sizes[owner])).astype(np.uint64) << np.uint64(32)), 50))
    has = sizes > 0
    hashes.append(whole[has])
    owners.append(np.flatnonzero(has))
    return np.concatenate(hashes).view(np.int64), np.concatenate(owners)


def _words(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of a slice, and which text has which word, once each."""
    pieces = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(batch.column("text"), "")))
    text = np.repeat(np.arange(batch.num_rows), pc.list_value_length(pieces).to_numpy(zero_copy_only=False))
    coded = pieces.flatten().dictionary_encode()
    words = [NOT_WORD.sub("", piece) for piece in coded.dictionary.to_pylist()]
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    both = np.unique(text * max(1, len(words)) + at)
    return words, both // max(1, len(words)), both % max(1, len(words))


def _spread(owner: np.ndarray, values: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``values`` listed by ``owner`` (sorted), repeated for every element of ``at``; and its place."""
    first = np.searchsorted(owner, np.arange(n))
    size = np.searchsorted(owner, np.arange(n), side="right") - first
    repeat = size[at]
    start = np.repeat(first[at] - np.cumsum(repeat) + repeat, repeat)
    return values[start + np.arange(repeat.sum())], np.repeat(np.arange(len(at)), repeat)


def _features_by_mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, limit=SAMPLE_BYTES):
        words, text, at = _words(batch)
        hashes, owner = _word_features(words)
        order = np.argsort(owner, kind="stable")
        names, coded = np.unique(hashes, return_inverse=True)
        values, place = _spread(owner[order], coded[order], at, len(words))
        both = np.unique(text[place] * max(1, len(names)) + values)
        toxic = batch.column("toxic").to_numpy()[both // max(1, len(names))]
        keys, n = np.unique((both % max(1, len(names))) * 2 + toxic, return_counts=True)
        yield pa.record_batch([names[keys // 2], keys % 2, n], ["feature", "toxic", "n"])


def _present(batch: pa.RecordBatch, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and place of each feature that a text has, once; and its number of words with any."""
    words, text, at = _words(batch)
    hashes, owner = _word_features(words)
    place = np.searchsorted(features, hashes)
    known = (place < len(features)) & (features[np.minimum(place, len(features) - 1)] == hashes) if len(features) else np.zeros(len(hashes), bool)
    owner, place = owner[known], place[known]
    order = np.argsort(owner, kind="stable")
    values, index = _spread(owner[order], place[order], at, len(words))
    strong = np.bincount(text[np.unique(index)], minlength=batch.num_rows)
    both = np.unique(text[index] * max(1, len(features)) + values)
    return both // max(1, len(features)), both % max(1, len(features)), strong


def _grade_rows(features: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            owner, present, strong = _present(batch, features)
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            lists = [present[i:j].astype(np.int32).tobytes() for i, j in zip(cuts[:-1], cuts[1:])]
            yield pa.record_batch([batch.column("toxic"), pa.array(strong), pa.array(lists, pa.binary())], ["toxic", "words", "present"])

    return rows
