"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of ``PASSAGE`` words (the last may be shorter). Every passage is encoded: 16
measures of its characters, words and repeats, standardised, go through one tanh layer. A gated attention
layer, tanh(V h) * sigmoid(U h) projected to one number and normalised over the bag, weighs the passages;
the weighted sum is scored by a logistic layer. Only documents have labels: the weights of the passages are
learned from them.

The model is fitted on the driver to a bounded sample of labelled documents (``max_train``, taken by hash of
doc_id); with more than that many labels the others are not used. Scoring runs in Arrow batches over the
whole table. Texts are measured in pieces of about a megabyte, cut at white space, so memory does not grow
with a text.

Defined results: a null text is an empty one; an empty text is a bag of one empty passage and gets a score;
of several labels of one doc_id the largest counts; without labels of both kinds the score is the smoothed
share of label 1 (0.5 without labels); repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.common import row_columns, whole_row

PASSAGE = 64
MAX_TRAIN = 4000
THRESHOLD = 0.7
PIECE = 1 << 20
HIDDEN, GATES = 12, 6
EPOCHS, RATE, DECAY, SEED = 300, 0.02, 1e-3, 7

#: Classes of bytes: lower, upper, digit, white space, symbol, exclamation, other ASCII, non-ASCII, continuation.
_CLASS = np.full(256, 6, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 4
_CLASS[[ord(c) for c in "!?"]] = 5
_CLASS[192:], _CLASS[128:192] = 7, 8
N_CLASSES = 9
N_FEATURES = 16
_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, dtype=np.uint64))


def _pieces(data: bytes | memoryview) -> Iterator[bytes]:
    """Pieces of at most about PIECE bytes, cut at white space where there is any."""
    data, at = bytes(data), 0
    while len(data) - at > PIECE:
        cut = max(data.rfind(b" ", at, at + PIECE), data.rfind(b"\n", at, at + PIECE))
        cut = at + PIECE if cut <= at else cut
        yield data[at:cut]
        at = cut
    yield data[at:]


def _share(counts: np.ndarray, of: np.ndarray) -> np.ndarray:
    return counts / np.maximum(of, 1)


def _measure(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some pieces, and the piece of each passage."""
    data = np.frombuffer(b" ".join(pieces) + b" ", dtype=np.uint8)
    kinds = _CLASS[data]
    gap = kinds == 3
    edges = np.flatnonzero(np.diff(np.concatenate(([1], gap.view(np.int8), [1]))))
    starts, stops = edges[::2], edges[1::2]
    piece_ends = np.cumsum([len(p) + 1 for p in pieces])
    owner = np.searchsorted(piece_ends, starts, side="right")
    words_of = np.bincount(owner, minlength=len(pieces))
    first_word = np.cumsum(words_of) - words_of
    passages_of = np.maximum(-(-words_of // PASSAGE), 1)
    first_passage = np.cumsum(passages_of) - passages_of
    n = int(passages_of.sum())
    piece_of = np.repeat(np.arange(len(pieces)), passages_of)
    out = np.zeros((n, N_FEATURES), dtype=np.float32)
    if not len(starts):
        return out, piece_of
    passage = first_passage[owner] + (np.arange(len(starts)) - first_word[owner]) // PASSAGE
    sizes = stops - starts
    # byte classes of the words; white space belongs to no word
    word_of = np.repeat(np.arange(len(starts)), sizes)
    inside = np.flatnonzero(~gap)
    classes = np.bincount(passage[word_of] * N_CLASSES + kinds[inside], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    by_word = lambda k: np.bincount(word_of[kinds[inside] == k], minlength=len(starts))
    upper, symbols = by_word(1), by_word(4)
    letters = upper + by_word(0) + by_word(7)
    hashed = np.add.reduceat(
        (data[inside].astype(np.uint64) + np.uint64(1)) * _POWERS[(inside - starts[word_of]) % len(_POWERS)],
        np.cumsum(sizes) - sizes,
    )
    count = lambda flags: np.bincount(passage[flags], minlength=n)
    n_words = np.bincount(passage, minlength=n)
    n_bytes = classes.sum(axis=1)
    mean = _share(np.bincount(passage, weights=sizes, minlength=n), n_words)
    square = _share(np.bincount(passage, weights=sizes.astype(float) ** 2, minlength=n), n_words)
    same_before = np.concatenate(([False], (hashed[1:] == hashed[:-1]) & (passage[1:] == passage[:-1])))
    # distinct words and the commonest word of each passage
    order = np.lexsort((hashed, passage))
    new = np.concatenate(([True], (hashed[order][1:] != hashed[order][:-1]) | (passage[order][1:] != passage[order][:-1])))
    heads = np.flatnonzero(new)
    runs = np.diff(np.append(heads, len(order)))
    most = np.zeros(n)
    np.maximum.at(most, passage[order][heads], runs)
    # windows of five words that occur again in the piece
    again = np.zeros(n)
    if len(hashed) >= 5:
        window = np.zeros(len(hashed) - 4, dtype=np.uint64)
        for k in range(5):
            window = window * np.uint64(0xC2B2AE3D27D4EB4F) + hashed[k:len(hashed) - 4 + k]
        whole = np.flatnonzero(owner[:-4] == owner[4:])
        at = whole[np.lexsort((window[whole], owner[whole]))]
        if len(at) > 1:
            equal = (window[at][1:] == window[at][:-1]) & (owner[at][1:] == owner[at][:-1])
            twice = np.concatenate(([False], equal)) | np.concatenate((equal, [False]))
            again = np.bincount(passage[at[twice]], minlength=n)
    columns = [
        mean / 8, np.sqrt(np.maximum(square - mean**2, 0)) / 4,
        *[_share(classes[:, k], n_bytes) * 4 for k in (1, 2, 4, 5, 6, 7)],
        _share(np.bincount(passage[order][heads], minlength=n), n_words), _share(most, n_words),
        _share(count(same_before), n_words), _share(again, n_words), _share(count(symbols > 0), n_words),
        _share(count((upper > 1) & (upper == letters)), n_words),
        np.log1p(n_words) / 4, np.log1p(words_of[piece_of]) / 8,
    ]
    out[:] = np.stack(columns, axis=1)
    return out, piece_of


def bags(texts: pa.Array) -> Iterator[np.ndarray]:
    """The passage features of each text, in order."""
    pending: list[list[bytes]] = []
    size = 0

    def flush():
        flat = [p for pieces in pending for p in pieces]
        features, piece_of = _measure(flat)
        text_of = np.repeat(np.arange(len(pending)), [len(p) for p in pending])[piece_of]
        yield from np.split(features, np.searchsorted(text_of, np.arange(1, len(pending))))

    for text in texts:
        data = (text.as_py() or "").encode("utf-8", "surrogatepass")
        if len(data) > PIECE:  # by itself, piece after piece
            if pending:
                yield from flush()
                pending, size = [], 0
            yield np.concatenate([_measure([p])[0] for p in _pieces(data)])
            continue
        pending.append([data])
        size += len(data)
        if size > PIECE:
            yield from flush()
            pending, size = [], 0
    if pending:
        yield from flush()


# The model


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _first_of(bag: np.ndarray) -> np.ndarray:
    """Where each bag begins; bags lie one after another and none is empty."""
    return np.flatnonzero(np.diff(bag, prepend=-1))


def _bag_sums(values: np.ndarray, bag: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, _first_of(bag), axis=0)


def _forward(model: dict, x: np.ndarray, bag: np.ndarray) -> dict:
    h = np.tanh(((x - model["mean"]) / model["spread"]) @ model["W"] + model["b"])
    v, u = np.tanh(h @ model["V"]), _sigmoid(h @ model["U"])
    e = (v * u) @ model["w"]
    a = np.exp(e - np.maximum.reduceat(e, _first_of(bag))[bag])
    a /= _bag_sums(a, bag)[bag]
    z = _bag_sums(a[:, None] * h, bag)
    return {"h": h, "v": v, "u": u, "a": a, "z": z, "score": _sigmoid(z @ model["c"] + model["d"])}


def fit(x: np.ndarray, bag: np.ndarray, labels: np.ndarray) -> dict:
    """Gradient descent (Adam) on the mean log loss of the bags."""
    rng, n = np.random.default_rng(SEED), len(labels)
    start = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    model = {"W": start(N_FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": start(HIDDEN, GATES),
             "U": start(HIDDEN, GATES), "w": start(GATES), "c": start(HIDDEN), "d": np.zeros(1)}
    fixed = {"mean": x.mean(axis=0), "spread": np.maximum(x.std(axis=0), 1e-3)}
    xs = (x - fixed["mean"]) / fixed["spread"]
    first, second = ({k: np.zeros_like(p) for k, p in model.items()} for _ in range(2))
    for step in range(1, EPOCHS + 1):
        f = _forward({**model, **fixed}, x, bag)
        dlogit = (f["score"] - labels) / n
        dz = np.outer(dlogit, model["c"])
        dh = f["a"][:, None] * dz[bag]
        da = (dz[bag] * f["h"]).sum(axis=1)
        de = f["a"] * (da - _bag_sums(f["a"] * da, bag)[bag])
        dv = np.outer(de, model["w"]) * f["u"] * (1 - f["v"] ** 2)
        du = np.outer(de, model["w"]) * f["v"] * f["u"] * (1 - f["u"])
        dh = (dh + dv @ model["V"].T + du @ model["U"].T) * (1 - f["h"] ** 2)
        grads = {"W": xs.T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dv, "U": f["h"].T @ du,
                 "w": (f["v"] * f["u"]).T @ de, "c": f["z"].T @ dlogit, "d": np.array([dlogit.sum()])}
        for k, g in grads.items():
            g = g + DECAY * model[k] / 10
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            model[k] = model[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return {**model, **fixed}


# On tables


def held_out(doc_id: Column) -> Column:
    """The rows that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> dict:
    """The model, from the labelled documents that are not held out."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sample = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [b.tobytes() for b in bags(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(raw, pa.binary())],
                names=["doc_id", "quality", "bag"],
            )

    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, quality int, bag binary"
    chosen = docs.select("doc_id", "text").join(sample.withColumn("quality", F.col("quality").cast("int")), "doc_id")
    rows = sorted(chosen.mapInArrow(run, kinds).collect(), key=lambda r: (r.doc_id, r.bag))  # bounded by max_train
    y = np.array([r.quality for r in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return {"constant": float((y.sum() + 1) / (len(y) + 2))}
    parts = [np.frombuffer(r.bag, dtype=np.float32).reshape(-1, N_FEATURES).astype(float) for r in rows]
    return fit(np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts]), y)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc, score) for every row: the row as a struct, and its score; needs a column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            if "constant" in model:
                scores = [model["constant"]] * batch.num_rows
            else:
                waiting, size = [], 0
                for bag in bags(batch.column("text")):
                    waiting.append(bag)
                    size += len(bag)
                    if size > 20_000:
                        scores += _scores(model, waiting)
                        waiting, size = [], 0
                scores += _scores(model, waiting)
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(scores, pa.float64())], names=["doc", "score"])

    rows = docs.select(whole_row(docs), "text")
    shape = T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, shape)


def _scores(model: dict, waiting: list[np.ndarray]) -> list[float]:
    if not waiting:
        return []
    bag = np.repeat(np.arange(len(waiting)), [len(b) for b in waiting])
    return _forward(model, np.concatenate(waiting).astype(float), bag)["score"].tolist()


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    model = train(docs, labels, max_train)
    scored = score(docs.select("doc_id", "text"), model).select("doc.doc_id", "score")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` or more."""
    scored = score(docs, train(docs, labels, max_train)).where(F.col("score") >= threshold)
    return scored.select(row_columns(docs))
