"""Language identification by words first, then by ever shorter character n-grams.

A word that the model knows counts with its log frequency in each language.
For an unseen word every character position counts with the longest n-gram
that starts there and is known, from ``LONGEST`` characters down to one.  How
many of a text's words and long n-grams are known at all tells whether it is in
one of the languages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textkernel as tk
from ._util import id_remainder

LONGEST = 4
#: Training documents of each language, expected number at most; the model is fitted on this sample.
SAMPLE = 4000
#: Languages at most; more are an error, as each entry holds a number for every one.
LANGUAGES = 512
#: Occurrences in the sample that make a word known, and the weight of an occurrence that wasn't seen.
WORD_COUNT, ALPHA = 2, 0.1
#: Length from which a known n-gram counts as a sign of a known language.
FITTING = 4


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cls = tk.letter_words()
    for batch in batches:
        for part in tk.slices(batch, "text"):
            langs = part.column(0).dictionary_encode()
            names, code = langs.dictionary, langs.indices.to_numpy()
            data, offsets = tk.string_buffers(part.column(1))
            w = tk.words_of(data, offsets, cls)
            lang = np.repeat(code, np.diff(w.ptr))
            found = [(0, w.hashes, lang)]
            step = max(1, len(w.starts) // max(1, len(data) // tk.CHUNK))
            for i in range(0, len(w.starts), step):
                own, ptr = tk.gather_words(data, w.starts[i : i + step], w.ends[i : i + step], True)
                for n in range(1, LONGEST + 1):
                    word, h = tk.char_ngrams(own, ptr, n)
                    found.append((n, h, lang[i + word]))
            for n, h, code_ in found:
                for c in range(len(names)):
                    u, k = np.unique(h[code_ == c], return_counts=True)
                    if len(u):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), n, np.int32)), pa.array(u.view(np.int64)), pa.array([names[c].as_py()] * len(u), pa.string()), pa.array(k.astype(np.int64))], ["n", "h", "lang", "c"])


def fit(labelled: DataFrame) -> dict:
    """Log frequencies from ``labelled(doc_id, lang, text)``, all of it non-null.

    The sample takes each language's documents with a chance of ``SAMPLE`` over
    their number, by a hash of the id, and whole texts; all their n-grams and all
    words of ``WORD_COUNT`` occurrences are kept.
    """
    sizes = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(LANGUAGES + 1).collect()}
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    langs = sorted(sizes)
    model = {"langs": langs, "keys": [], "logs": []}
    if not langs:
        return model
    chance = labelled.sparkSession.createDataFrame([(x, min(1.0, SAMPLE / sizes[x])) for x in langs], "lang string, chance double")
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.join(F.broadcast(chance), "lang").where(draw < F.col("chance")).select("lang", "text")
    counts = sample.mapInArrow(tk.lean(_counter), "n int, h long, lang string, c long").groupBy("n", "h", "lang").agg(F.sum("c").alias("c"))
    per_key = counts.groupBy("n", "h").agg(F.sum("c").alias("total"), F.collect_list(F.struct("lang", "c")).alias("by"))
    index = {x: i for i, x in enumerate(langs)}
    total = {}
    kept = per_key.where((F.col("n") > 0) | (F.col("total") >= WORD_COUNT))
    t = kept.select("n", "h", F.explode("by").alias("x")).select("n", "h", "x.lang", "x.c").toArrow()
    n, h, c = (t.column(k).to_numpy() for k in ("n", "h", "c"))
    lang = np.array([index[x] for x in t.column("lang").to_pylist()], np.int64)
    for k in range(LONGEST + 1):
        own = n == k
        keys, at = np.unique(h[own].view(np.uint64), return_inverse=True)
        table = np.full((len(keys), len(langs)), ALPHA)
        np.add.at(table, (at, lang[own]), c[own])
        total[k] = table.sum(axis=0)
        model["keys"].append(keys)
        model["logs"].append(np.log(table / total[k]).astype(np.float32))
    return model


def _scores(model: dict, data: np.ndarray, w: tk.Words) -> tuple[np.ndarray, np.ndarray]:
    """(texts, languages): sum of log frequencies over the words; and each text's sum of the words' known shares."""
    langs = len(model["langs"])
    keys, first, at = np.unique(w.hashes, return_index=True, return_inverse=True)
    by_word = np.zeros((len(keys), langs))
    known = tk.lookup(model["keys"][0], keys)
    fit = (known >= 0).astype(float)
    by_word[known >= 0] = model["logs"][0][known[known >= 0]]
    new = np.flatnonzero(known < 0)
    starts, ends = w.starts[first[new]], w.ends[first[new]]
    cum = np.concatenate([[0], np.cumsum(ends - starts)])
    i = 0
    while i < len(new):
        j = max(i + 1, int(np.searchsorted(cum, cum[i] + tk.CHUNK, "right")) - 1)
        j = min(j, len(new))
        own, ptr = tk.gather_words(data, starts[i:j], ends[i:j], True)
        chars = np.flatnonzero((own & 0xC0) != 0x80)
        rank = np.full(len(own) + 1, -1, np.int64)
        rank[chars] = np.arange(len(chars))
        word_of = np.searchsorted(ptr, chars, "right") - 1
        position = np.zeros((len(chars), langs))
        open_, fits = np.ones(len(chars), bool), np.zeros(len(chars), bool)
        heads = rank[ptr[:-1]]
        for n in range(LONGEST, 0, -1):
            word, h = tk.char_ngrams(own, ptr, n)
            # n-grams come in the order of their first characters, word by word
            count = np.bincount(word, minlength=j - i)
            base = np.concatenate([[0], np.cumsum(count)])
            char = heads[word] + np.arange(len(word)) - base[:-1][word]
            todo = open_[char]
            found = tk.lookup(model["keys"][n], h[todo])
            hit = found >= 0
            position[char[todo][hit]] = model["logs"][n][found[hit]]
            open_[char[todo][hit]] = False
            fits[char[todo][hit]] = n >= FITTING
        sums = np.zeros((j - i, langs))
        for x in range(langs):
            sums[:, x] = np.bincount(word_of, weights=position[:, x], minlength=j - i)
        size = np.maximum(1, np.bincount(word_of, minlength=j - i))
        by_word[new[i:j]] = sums / size[:, None]
        # the last places of a word are too short for a long n-gram
        fit[new[i:j]] = np.bincount(word_of, weights=fits, minlength=j - i) / np.maximum(1, size - FITTING + 1)
        i = j
    out = np.zeros((len(w.ptr) - 1, langs))
    doc = np.repeat(np.arange(len(w.ptr) - 1), np.diff(w.ptr))
    for x in range(langs):
        out[:, x] = np.bincount(doc, weights=by_word[at, x], minlength=len(out))
    return out, np.bincount(doc, weights=fit[at], minlength=len(out))


def _predict(m: dict, texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Language and score of each text, and how much of it is known."""
    cls = tk.letter_words()
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    data, offsets = tk.string_buffers(texts)
    w = tk.words_of(data, offsets, cls)
    run = np.concatenate([[0], np.cumsum(ascii_letter[data])])
    lettered = run[offsets[1:]] > run[offsets[:-1]]
    for i in np.flatnonzero(~lettered & (np.diff(w.ptr) > 0)):
        lettered[i] = any(x.isalpha() for x in texts[int(i)].as_py())
    names, scores, fits = np.full(len(lettered), "und", object), np.zeros(len(lettered)), np.zeros(len(lettered))
    if m["langs"] and lettered.any():
        n = np.maximum(1, np.diff(w.ptr))[:, None]
        sums, fit = _scores(m, data, w)
        z = sums / np.sqrt(n)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        names[lettered] = np.array(m["langs"], object)[best[lettered]]
        scores[lettered] = p[np.arange(len(best)), best][lettered]
        fits[lettered] = (fit / n[:, 0])[lettered]
    return pa.array(names, pa.string()), pa.array(scores), pa.array(fits)


def _predictor(model, text_at: int):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch, "text"):
                found = _predict(model.value, part.column(text_at))
                yield pa.RecordBatch.from_arrays([part.column(0), *found], ["doc_id", "lang_pred", "score", "fit"])

    return predict


def _fitted(docs: DataFrame, train: Column | None):
    known = docs.where(train) if train is not None else docs
    model = fit(known.where("text is not null and lang is not null").select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")))
    return docs.sparkSession.sparkContext.broadcast(model)


def spoken(docs: DataFrame, least: float, train: Column | None = None) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are in a learned language.

    ``least`` is the share of a text that must be known: a known word counts
    whole, another one by the share of its n-grams of ``FITTING`` characters
    that the languages have.  Null texts, texts without letters and, where there
    is nothing to learn from, all texts go.
    """
    model, at = _fitted(docs, train), docs.columns.index("text")

    def filter_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch, "text"):
                names, _, fits = _predict(model.value, part.column(at))
                yield part.filter(pa.array((np.asarray(names) != "und") & (fits.to_numpy() >= least)))

    return docs.mapInArrow(tk.lean(filter_), docs.schema)


def identify(docs: DataFrame, train: Column | None = None) -> DataFrame:
    """(doc_id, lang_pred, score, fit) of every row of ``docs(doc_id, text, lang, ...)``.

    Learns from the rows where ``train`` holds (all by default) whose text and
    lang aren't null; a prediction uses the text alone.  ``lang_pred`` is one of
    the learned values, or ``und`` with score 0 if the text is null or holds no
    letter, or if there was nothing to learn from.  ``score`` is the softmax of
    the languages' log frequencies over the root of the number of words.
    ``fit`` is the share of the text that the model knows, 0 with ``und``.
    Equally likely languages: the first by name.  Repeated rows and null ids
    get their rows; a very long text is read in chunks; other columns are
    ignored.  An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = rows.mapInArrow(tk.lean(_predictor(_fitted(docs, train), 1)), "doc_id long, lang_pred string, score double, fit double")
    return found


def held_out(column: str = "doc_id") -> Column:
    return id_remainder(4, column) == 2
