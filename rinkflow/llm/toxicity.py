"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the hashed embeddings of its character n-grams
and of the word itself, and a bag's vector is the mean of its words'.  Bags are
windows of ``WINDOW`` words, so that a few toxic words show in a long text: a
document is toxic if one of its windows is.  Embeddings and softmax are trained
together in numpy on a bounded sample, by the likelihood that at least one
window of a toxic document and none of a clean one is toxic.  A misspelling
that the sample lacks still shares most of its n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from ._util import id_remainder

WINDOW = 16
GRAMS = (3, 4, 5)
BUCKETS, DIMS = 1 << 18, 4
#: Training rows of each label at most; the model is fitted on this sample of whole texts.
SAMPLE = 2500
STEPS, RATE = 75, 1.5
#: Gradients under this share of the largest one take steps in proportion, so what few documents show weighs little.
FLOOR = 0.05
#: Share of the sample that the scale of the scores is fitted on, and how much a clean document counts there.
CALIBRATION, CLEAN_WEIGHT = 0.2, 3.0


def _subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of all subwords of the given words, each word's together."""
    own, ptr = tk.gather_words(data, starts, ends, True)
    word, bucket = [np.arange(len(starts))], [hashes]
    for n in GRAMS:
        w, h = tk.char_ngrams(own, ptr, n)
        word.append(w)
        bucket.append(h)
    word, bucket = np.concatenate(word), np.concatenate(bucket)
    order = np.argsort(word, kind="stable")
    return word[order], (bucket[order] & np.uint64(BUCKETS - 1)).astype(np.int32)


def windows_of(ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each window, and each text's first window."""
    n = np.diff(ptr)
    count = -(-n // WINDOW)
    win_ptr = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(n)), count)
    return ptr[:-1][doc] + WINDOW * (np.arange(win_ptr[-1]) - win_ptr[:-1][doc]), win_ptr


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(texts: list[str], labels: np.ndarray) -> dict:
    """Subword scores and bias, and the scale of a document's score.

    The embeddings see four fifths of the sample.  On the rest, a logistic curve
    is fitted to the largest logit of a document's windows.
    """
    rest = np.arange(len(labels)) % round(1 / CALIBRATION) == 0
    if not (labels[rest].any() and not labels[rest].all() and labels[~rest].any() and not labels[~rest].all()):
        return embed(texts, labels) | {"scale": (1.0, 0.0)}
    model = embed([t for t, r in zip(texts, rest, strict=True) if not r], labels[~rest]) | {"scale": (1.0, 0.0)}
    held = pa.array([t for t, r in zip(texts, rest, strict=True) if r], pa.large_string())
    return model | {"scale": _fit_scale(text_logits(model, held), labels[rest])}


def _fit_scale(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of labels over logits (Newton's method, lightly ridged)."""
    weight = np.where(y == 1, 1 / y.sum(), CLEAN_WEIGHT / (y == 0).sum())
    x = np.stack([z, np.ones(len(z))])
    c = np.array([1.0, 0.0])
    for _ in range(50):
        p = _sigmoid(c @ x)
        grad = x @ (weight * (p - y)) + 1e-3 * (c - [1.0, 0.0])
        hess = (x * (weight * p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        c = c - np.linalg.solve(hess, grad)
    return (float(c[0]), float(c[1])) if c[0] > 0 and np.isfinite(c).all() else (1.0, 0.0)


def embed(texts: list[str], labels: np.ndarray, seed: int = 7) -> dict:
    """Subword scores and bias: the embeddings applied to the softmax, toxic less clean.

    Full-batch Adagrad on embeddings (buckets x dims), softmax weights and bias.
    """
    empty = {"weights": np.zeros(BUCKETS, np.float32), "bias": -20.0 if len(labels) == 0 or not labels.any() else 20.0}
    if len(labels) == 0 or labels.all() or not labels.any():
        return empty
    data, offsets = tk.string_buffers(pa.array(texts, pa.large_string()))
    w = tk.words_of(data, offsets, tk.alnum_words())
    if not len(w.hashes):
        return empty
    _, first, at = np.unique(w.hashes, return_index=True, return_inverse=True)
    parts = [_subwords(data, w.starts[x], w.ends[x], w.hashes[x]) for x in np.array_split(first, max(1, len(first) // 50_000))]
    sizes = np.concatenate([np.bincount(a, minlength=1) for a, _ in parts])
    bucket = np.concatenate([b for _, b in parts])
    heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    word_of = np.repeat(np.arange(len(first)), sizes).astype(np.int32)
    del parts
    win, win_ptr = windows_of(w.ptr)
    win_size = np.diff(np.append(win, len(at)))
    win_of = np.repeat(np.arange(len(win)), win_size)
    doc_of = np.repeat(np.arange(len(labels)), np.diff(win_ptr))
    toxic = labels[doc_of] == 1
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))[doc_of]
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.05, (DIMS, BUCKETS)).astype(np.float32)
    u, b = rng.normal(0, 0.5, (2, DIMS)), np.array([0.0, -4.0])
    gu, gb, ge = np.full((2, DIMS), 1e-8), np.full(2, 1e-8), np.full((DIMS, BUCKETS), 1e-12, np.float32)
    floor = 0.0
    for _ in range(STEPS):
        mean = np.empty((DIMS, len(win)))
        for d in range(DIMS):
            vec = np.add.reduceat(e[d, bucket], heads) / sizes
            mean[d] = WINDOW * np.bincount(win_of, weights=vec[at], minlength=len(win)) / win_size
        logit = u @ mean + b[:, None]
        p = _sigmoid(logit[1] - logit[0])
        none = np.bincount(doc_of, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(labels))
        some = np.maximum(1e-6, -np.expm1(none))[doc_of]
        # d(-log likelihood)/d(logit difference) of each window
        g = np.where(toxic, -p * (1 - some) / some, p) * weight
        both = np.stack([-g, g])
        du, db = both @ mean.T, both.sum(axis=1)
        back = u.T @ both
        for d in range(DIMS):
            by_word = np.bincount(at, weights=(WINDOW * back[d] / win_size)[win_of], minlength=len(first)) / sizes
            de = np.bincount(bucket, weights=by_word[word_of], minlength=BUCKETS).astype(np.float32)
            floor = floor or float(FLOOR * np.abs(de).max())
            ge[d] += de * de
            e[d] -= RATE * de / np.sqrt(ge[d] + floor * floor)
        gu += du * du
        gb += db * db
        u -= 0.1 * RATE * du / np.sqrt(gu)
        b -= 0.1 * RATE * db / np.sqrt(gb)
    return {"weights": ((u[1] - u[0]) @ e).astype(np.float32), "bias": float(b[1] - b[0])}


def text_logits(model: dict, texts: pa.Array) -> np.ndarray:
    """Largest logit of each text's windows; the bias for a text without words."""
    data, offsets = tk.string_buffers(texts)
    w = tk.words_of(data, offsets, tk.alnum_words())
    _, first, at = np.unique(w.hashes, return_index=True, return_inverse=True)
    by_word = np.empty(len(first))
    order = np.argsort(w.starts[first], kind="stable")
    size = np.cumsum((w.ends - w.starts)[first][order])
    i = 0
    while i < len(order):
        j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + tk.CHUNK // 2, "right")))
        x = first[order[i:j]]
        word, bucket = _subwords(data, w.starts[x], w.ends[x], w.hashes[x])
        n = np.bincount(word, minlength=len(x))
        by_word[order[i:j]] = np.bincount(word, weights=model["weights"][bucket], minlength=len(x)) / n
        i = j
    win, win_ptr = windows_of(w.ptr)
    best = np.full(len(texts), float(model["bias"]))
    if len(win):
        mean = WINDOW * np.add.reduceat(by_word[at], win) / np.diff(np.append(win, len(at)))
        full = np.diff(win_ptr) > 0
        best[full] = np.maximum.reduceat(mean, win_ptr[:-1][full]) + model["bias"]
    return best


def _scorer(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        slope, shift = m["scale"]
        for batch in batches:
            for part in tk.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_sigmoid(slope * text_logits(m, part.column(1)) + shift))], ["doc_id", "score"])

    return score


def sample(docs: DataFrame, labels: DataFrame, train_rows: Column) -> tuple[list[str], np.ndarray]:
    """Texts and labels to train on: of each label the ``SAMPLE`` ids of smallest hash, with whole texts.

    An id with several labels is toxic if one of them says so; of several texts
    under an id the first in order counts.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(train_rows).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.withColumn("draw", F.xxhash64("doc_id", F.lit("toxicity")))
    ids = known.where("toxic = 1").orderBy("draw").limit(SAMPLE).unionAll(known.where("toxic = 0").orderBy("draw").limit(SAMPLE))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    rows = text.join(F.broadcast(ids), "doc_id").groupBy("draw", "toxic").agg(F.min("text").alias("text"))  # at most 2 * SAMPLE rows
    got = rows.orderBy("draw").collect()
    return [r.text for r in got], np.array([r.toxic for r in got], np.int8)


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: Column | None = None) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs(doc_id, text, ...)``.

    Learns from ``labels(doc_id, toxic)`` where ``train_rows`` holds (all by
    default); labels are no input of a score.  ``score`` is the largest
    probability of a window; a null text or one without words has no window and
    gets the score of an empty bag.  Without labels of both kinds to learn
    from, all scores are near 0 (or near 1 if all are toxic).  Repeated rows
    and null ids get their rows; equal texts get equal scores; a very long text
    is scored in all its windows; other columns, whatever their names, are
    ignored.  An empty table gives an empty result, and empty labels the bias.
    """
    texts, y = sample(docs, labels, train_rows if train_rows is not None else F.lit(True))
    model = docs.sparkSession.sparkContext.broadcast(train(texts, y))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(tk.lean(_scorer(model)), "doc_id long, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(column: str = "doc_id") -> Column:
    return id_remainder(5, column) == 0
