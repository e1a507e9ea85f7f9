"""Quality classifier by attention-based multiple-instance learning (Ilse, Tomczak and Welling, 2018).

A document is a bag of passages. Every passage of the whole text is encoded; gated attention, learned from document labels alone, weighs
the passages; the weighted representation is scored. The model has a few thousand numbers and travels with the function.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import released, smallest
from .text_arrays import WordHasher, distinct, shingles, sums, text_slices, word_bounds

#: words of a passage, however long the text; passages of a text that the model is fitted on at most
PASSAGE_WORDS, PASSAGES = 64, 64
#: labelled documents the model is fitted on at most: those whose hashed id is smallest
FIT_DOCUMENTS = 3000
HIDDEN, ATTENTION, EPOCHS, RATE = 16, 8, 200, 0.03
SYMBOLS = "#*$%&|<>!?.,;:\n"


def byte_classes() -> np.ndarray:
    """Class of every byte: 0 other, 1 upper case, 2 lower case, 3 digit, 4 white space, 5 not ASCII, 6 and up single symbols."""
    table = np.zeros(256, np.int64)
    table[ord("A"):ord("Z") + 1], table[ord("a"):ord("z") + 1], table[ord("0"):ord("9") + 1] = 1, 2, 3
    table[[0x20, *range(0x09, 0x0E)]] = 4
    table[128:] = 5
    for i, c in enumerate(SYMBOLS):
        table[ord(c)] = 6 + i
    return table


CLASSES = 6 + len(SYMBOLS)
FEATURES = CLASSES + 5


def encoded(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher, most: int | None = PASSAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage and the number of passages of each text; a text without words is one passage of zeros.

    With ``most``, for fitting, a text with more passages gives that many, evenly spread over it. Scores take all (None): their features need a
    few bytes for each word, less than the words' hashes do.
    """
    starts, ends = word_bounds(data, offsets)
    first_word = np.searchsorted(starts, offsets)
    words = np.diff(first_word)
    count = np.maximum(1, -(-words // PASSAGE_WORDS))
    text = np.repeat(np.arange(len(words)), count)
    within = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    low = first_word[text] + within * PASSAGE_WORDS  # first word of each passage
    high = np.minimum(low + PASSAGE_WORDS, first_word[text + 1])
    # bytes of a passage reach to the next one of its text, so that line breaks count
    begin = np.where(within == 0, offsets[text], np.r_[starts, len(data)][np.minimum(low, len(starts))])
    stop = np.r_[begin[1:], len(data)]
    passage = np.repeat(np.arange(len(text)), stop - begin)
    kinds = np.bincount(passage * CLASSES + byte_classes()[data], minlength=len(text) * CLASSES).reshape(-1, CLASSES)
    size, n = np.maximum(stop - begin, 1)[:, None], np.maximum(high - low, 1)
    hashes, bounds = hasher(data, starts, ends), np.r_[low, len(starts)]
    widths = (ends - starts).astype(np.float64)
    mean = sums(widths, bounds) / n
    spread = np.sqrt(np.maximum(sums(widths * widths, bounds) / n - mean * mean, 0))
    owner = np.repeat(np.arange(len(text)), high - low)
    _, different = distinct(hashes, owner, len(text))
    # words that begin a run of three which the whole text repeats
    runs, of = shingles(hashes, words, 3)
    order = np.lexsort((runs, of))
    same = np.zeros(len(runs) + 1, bool)
    same[1:-1] = (runs[order][1:] == runs[order][:-1]) & (of[order][1:] == of[order][:-1])
    twice = np.zeros(len(starts) + 1, np.float64)
    at = first_word[of] + np.arange(len(of)) - np.searchsorted(of, of)
    twice[at[order]] = same[1:] | same[:-1]
    rows = np.column_stack([
        np.log1p(high - low) / 5, np.where(high > low, mean, 0) / 10, spread / 10, np.where(high > low, 1 - different / n, 0), sums(twice[:len(starts)], bounds) / n])
    features = np.hstack([kinds / size, rows]).astype(np.float32)
    if most is None or count.max(initial=0) <= most:
        return features, count
    # the first passage of each of ``most`` equal parts
    part = within * most // count[text]
    chosen = (count[text] <= most) | (within == 0) | (part != np.r_[-1, part[:-1]])
    return features[chosen], np.minimum(count, most)


def _softmax(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    top = np.repeat(np.maximum.reduceat(values, first), count)
    powers = np.exp(values - top)
    return powers / np.repeat(np.add.reduceat(powers, first), count)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(model: dict, features: np.ndarray, count: np.ndarray) -> tuple:
    x = np.clip((features - model["mean"]) / model["scale"], -8, 8)
    h = np.tanh(x @ model["w"] + model["b"])
    gate, value = _sigmoid(h @ model["u"]), np.tanh(h @ model["v"])
    first = np.cumsum(count) - count
    weight = _softmax((gate * value) @ model["a"], first, count)
    bag = np.add.reduceat(h * weight[:, None], first, axis=0)
    return x, h, gate, value, first, weight, bag, _sigmoid(bag @ model["o"] + model["c"])


def fit(features: np.ndarray, count: np.ndarray, labels: np.ndarray) -> dict:
    """Full-batch Adam on the log loss; deterministic. Without both labels the model answers their smoothed share."""
    rng = np.random.default_rng(7)
    start = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    model = {"mean": np.zeros(FEATURES), "scale": np.ones(FEATURES), "w": start(FEATURES, HIDDEN), "b": np.zeros(HIDDEN),
             "u": start(HIDDEN, ATTENTION), "v": start(HIDDEN, ATTENTION), "a": start(ATTENTION), "o": start(HIDDEN) * 0, "c": np.zeros(1)}
    share = (labels.sum() + 1) / (len(labels) + 2)
    model["c"] += np.log(share / (1 - share))
    if not 0 < labels.sum() < len(labels):
        return model
    model["mean"], model["scale"] = features.mean(0), features.std(0) + 1e-3
    names = ["w", "b", "u", "v", "a", "o", "c"]
    m, s = ({k: np.zeros_like(model[k]) for k in names} for _ in range(2))
    for step in range(1, EPOCHS + 1):
        x, h, gate, value, first, weight, bag, p = forward(model, features, count)
        error = (p - labels) / len(labels)
        bag_error = np.outer(error, model["o"])
        spread = np.repeat(bag_error, count, axis=0)
        pull = (h * spread).sum(1)
        score = weight * (pull - np.repeat(np.add.reduceat(weight * pull, first), count))
        mixed = score[:, None] * model["a"]
        d_gate, d_value = mixed * value * gate * (1 - gate), mixed * gate * (1 - value * value)
        d_h = (spread * weight[:, None] + d_gate @ model["u"].T + d_value @ model["v"].T) * (1 - h * h)
        grads = {"w": x.T @ d_h, "b": d_h.sum(0), "u": h.T @ d_gate, "v": h.T @ d_value, "a": (gate * value).T @ score,
                 "o": bag.T @ error, "c": np.array([error.sum()])}
        for k in names:
            g = grads[k] + 1e-5 * model[k]
            m[k], s[k] = 0.9 * m[k] + 0.1 * g, 0.999 * s[k] + 0.001 * g * g
            model[k] = model[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = WordHasher()
    for batch in batches:
        for first, last, data, offsets in text_slices(batch, "text"):
            features, count = encoded(data, offsets, hasher)
            bounds = np.r_[0, np.cumsum(count)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(first, last - first), batch.column("label").slice(first, last - first),
                pa.array([features[bounds[i]:bounds[i + 1]].tobytes() for i in range(len(count))], pa.binary())], ["doc_id", "label", "passages"])


def train(docs: DataFrame, labels: DataFrame, usable=None) -> dict:
    """Fits the model on at most FIT_DOCUMENTS labelled documents (``labels``: doc_id, quality); ``usable`` is a condition over doc_id.

    Only text and label are read. Labels that are null are passed over; of several for one document the larger counts. Rows of
    ``docs`` that repeat a doc_id are all used. What reaches the driver is bounded by FIT_DOCUMENTS times PASSAGES encoded passages.
    """
    chosen = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    chosen = chosen.where(usable) if usable is not None else chosen
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    chosen = smallest(chosen.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")), place, FIT_DOCUMENTS, "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    bags = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
            .mapInArrow(released(_encode), f"doc_id {kind}, label int, passages binary").toPandas())
    if not len(bags):
        return fit(np.zeros((0, FEATURES)), np.zeros(0, np.int64), np.zeros(0))
    bags = bags.sort_values(["doc_id", "passages"])
    parts = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in bags["passages"]]
    return fit(np.vstack(parts).astype(np.float64), np.array([len(p) for p in parts]), (bags["label"].to_numpy() > 0).astype(np.float64))


def _scores(model: dict):
    def score(batch: pa.RecordBatch, column: str, hasher: WordHasher) -> np.ndarray:
        out = [forward(model, *encoded(data, offsets, hasher, None))[-1] for _, _, data, offsets in text_slices(batch, column)]
        return np.concatenate(out) if out else np.zeros(0)
    return score


def scored(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row, 0 to 1; null and empty texts are one passage of zeros. Rows never leave their task."""
    score = _scores(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(batch, text, hasher), pa.float64())], [key, "score"])

    return docs.select(key, text).mapInArrow(released(run), f"{key} {docs.schema[key].dataType.simpleString()}, score double")


def accepted(docs: DataFrame, model: dict, threshold: float, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns, whatever these are called."""
    score = _scores(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            yield batch.filter(pa.array(score(batch, text, hasher) >= threshold))

    return docs.mapInArrow(released(run), docs.schema)
