"""Language identification by a convolutional network over bytes.

A window of ``WINDOW`` bytes is embedded byte by byte, filters of several widths run over it,
each filter's maximum over the window is kept, and a softmax over these gives the language.
The network is trained in numpy, on windows of a bounded sample of labelled documents
(``SAMPLE_DOCS`` for each language in expectation, drawn by a hash of the id, up to
``SAMPLE_WINDOWS`` windows each).  A whole text is predicted: all its windows, in batches; the
windows' log probabilities are averaged by their bytes.

Applying a filter to an embedded byte is one look-up in a table of 256 rows, so prediction
adds such rows instead of multiplying matrices.

Nulls and odd input: a null text, or one without any letter, is ``und`` with score 0; a null
language is not learned from; with a single known language all get it; with none, ``und``;
repeated rows are reported each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table

WINDOW = 256
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4), 16, 8
SAMPLE_DOCS, SAMPLE_WINDOWS = 1500, 3
#: Documents of a rare language are repeated in training up to this many times.
MOST_REPEATS = 20
LETTER = re.compile(r"[^\W\d_]")


class Network(NamedTuple):
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # for each width: width * EMBEDDING x FILTERS
    biases: list[np.ndarray]
    dense: np.ndarray  # len(WIDTHS) * FILTERS x languages
    offset: np.ndarray


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text's bytes, the last one padded with zeros, and their byte counts."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, dtype=np.uint8)
    out[:len(data)] = data
    return out.reshape(n, WINDOW), np.minimum(WINDOW, len(data) - WINDOW * np.arange(n))


def _unrolled(x: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` consecutive embedded bytes: windows x places x (width * EMBEDDING)."""
    return np.concatenate([x[:, j:x.shape[1] - width + 1 + j] for j in range(width)], axis=2)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 1200, batch: int = 64, rate: float = 0.01, seed: int = 4) -> Network:
    """Train by Adam on cross entropy; ``x``: windows of bytes, ``y``: language numbers."""
    rng = np.random.default_rng(seed)
    f32 = np.float32
    p = [rng.normal(0, 0.3, (256, EMBEDDING)).astype(f32)]
    p += [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)).astype(f32) for w in WIDTHS]
    p += [np.zeros(FILTERS, f32) for _ in WIDTHS]
    p += [rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(f32), np.zeros(len(languages), f32)]
    k = len(WIDTHS)
    moment, square = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x), batch)
        data, target = x[rows], y[rows]
        # Half of the windows are cut short, as short texts and last windows are.
        short = np.where(rng.random(batch) < 0.5, rng.integers(12, WINDOW, batch), WINDOW)
        data = np.where(np.arange(WINDOW) < short[:, None], data, 0)
        emb, filters, biases, dense, offset = p[0], p[1:1 + k], p[1 + k:1 + 2 * k], p[-2], p[-1]
        e = emb[data]
        pooled, tops, unrolled = [], [], []
        for w, f, b in zip(WIDTHS, filters, biases):
            u = _unrolled(e, w)
            z = u @ f + b
            top = z.argmax(axis=1)
            unrolled.append(u)
            tops.append(top)
            pooled.append(np.take_along_axis(z, top[:, None, :], axis=1)[:, 0])
        h = np.maximum(np.concatenate(pooled, axis=1), 0)
        logits = h @ dense + offset
        prob = np.exp(logits - logits.max(axis=1, keepdims=True))
        prob /= prob.sum(axis=1, keepdims=True)
        d = prob
        d[np.arange(batch), target] -= 1
        d /= batch
        grads = [np.zeros_like(a) for a in p]
        grads[-2], grads[-1] = h.T @ d, d.sum(axis=0)
        dh = (d @ dense.T) * (h > 0)
        at = np.arange(batch)[:, None]
        for i, w in enumerate(WIDTHS):
            g = dh[:, i * FILTERS:(i + 1) * FILTERS]
            chosen = unrolled[i][at, tops[i]]  # windows x filters x (width * EMBEDDING)
            grads[1 + i] = np.einsum("bfk,bf->kf", chosen, g)
            grads[1 + k + i] = g.sum(axis=0)
            back = g[:, :, None] * filters[i].T[None]
            for j in range(w):
                np.add.at(grads[0], data[at, tops[i] + j], back[:, :, j * EMBEDDING:(j + 1) * EMBEDDING])
        slow = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for i, g in enumerate(grads):
            moment[i] = 0.9 * moment[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            p[i] = (p[i] - slow * (moment[i] / (1 - 0.9 ** step)) / (np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-8)).astype(f32)
    return Network(languages, p[0], p[1:1 + k], p[1 + k:1 + 2 * k], p[-2], p[-1])


class Predictor:
    """A network with its look-up tables."""

    def __init__(self, net: Network):
        self.net = net
        self.tables = [[np.ascontiguousarray(net.embedding @ f[j * EMBEDDING:(j + 1) * EMBEDDING]) for j in range(w)]
                       for w, f in zip(WIDTHS, net.filters)]

    def log_probabilities(self, data: np.ndarray) -> np.ndarray:
        """windows x languages, a few windows at a time so that the sums stay in cache."""
        out = []
        for i in range(0, len(data), 32):
            part, pooled = data[i:i + 32], []
            for w, tables, bias in zip(WIDTHS, self.tables, self.net.biases):
                z = tables[0].take(part[:, :WINDOW - w + 1], axis=0)
                for j in range(1, w):
                    z += tables[j].take(part[:, j:WINDOW - w + 1 + j], axis=0)
                pooled.append(z.max(axis=1) + bias)
            logits = np.maximum(np.concatenate(pooled, axis=1), 0) @ self.net.dense + self.net.offset
            logits -= logits.max(axis=1, keepdims=True)
            out.append(logits - np.log(np.exp(logits).sum(axis=1, keepdims=True)))
        return np.concatenate(out)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and probability of each whole text."""
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        if not self.net.languages:
            return out
        known = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        cut = [windows(texts[i]) for i in known]
        if not cut:
            return out
        scores = self.log_probabilities(np.concatenate([w for w, _ in cut]))
        begin = 0
        for i, (w, sizes) in zip(known, cut):
            mean = (scores[begin:begin + len(w)] * sizes[:, None]).sum(axis=0) / sizes.sum()
            begin += len(w)
            prob = np.exp(mean - mean.max())
            best = int(prob.argmax())
            out[i] = (self.net.languages[best], float(prob[best] / prob.sum()))
        return out


def held_out(doc_id: Column) -> Column:
    """Ids whose language must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Network:
    """Learn from the text and the language of the documents that are not held out."""
    text = F.col(text_col)
    rows = docs.where(F.col(lang_col).isNotNull() & text.isNotNull() & ~held_out(F.col(id_col))).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), text.alias("text"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Network([], np.zeros((256, EMBEDDING), np.float32), [], [], np.zeros((0, 0)), np.zeros(0))
    share = F.element_at(F.create_map(*[F.lit(v) for lang in languages for v in (lang, min(1.0, SAMPLE_DOCS / counts[lang]))]), F.col("lang"))
    drawn = F.shiftrightunsigned(F.xxhash64("id", F.lit("language")), 11).cast("double") / float(1 << 53)
    # Windows of code points at hashed places; encoded, they hold WINDOW bytes at least if the text does.
    place = lambda k: 1 + F.pmod(F.xxhash64("id", F.lit(k)), F.greatest(F.lit(1), F.length("text") - WINDOW + 1).cast("long"))
    cuts = F.array(*[F.substring("text", place(k).cast("int"), F.lit(WINDOW)) for k in range(SAMPLE_WINDOWS)])
    sample = rows.where(drawn < share).select("lang", F.explode(F.array_distinct(cuts)).alias("cut")).orderBy("lang", "cut").collect()
    x = [windows(r["cut"])[0][0] for r in sample]
    y = [languages.index(r["lang"]) for r in sample]
    have = np.bincount(y, minlength=len(languages))
    repeat = [min(MOST_REPEATS, max(1, int(have.max()) // max(1, int(have[k])))) for k in y]
    return fit(np.repeat(np.array(x), repeat, axis=0), np.repeat(np.array(y), repeat), languages)


def identify(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` for every whole text."""
    bounded_batches(docs.sparkSession, 256)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(net) if net.languages else None
        for batch in batches:
            found = predictor.predict(batch["text"].to_pylist()) if predictor else [("und", 0.0)] * len(batch)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([lang for lang, _ in found], pa.string()),
                                              pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(predict, "doc_id long, lang_pred string, score double")


def op4_byte_cnn_language(spark, sf_dir: str) -> DataFrame:
    """All documents with their predicted language."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {"op4_byte_cnn_language": op4_byte_cnn_language}
ORACLE: dict[str, str] = {}
