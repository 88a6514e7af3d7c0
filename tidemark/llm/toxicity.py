"""Toxicity by a linear-chain conditional random field over words.

A word is tagged clean (0) or toxic (1).  Labels are per document, so words are labelled
first: features of words (the word, its first 3 to 5 and its last 4 letters) are counted over
all labelled training documents, by label, in Spark; a feature found far more often in toxic
documents than in clean ones is telling, if chance is ruled out by a log-likelihood test on its
counts.  The test asks for a few documents, however many there are, so a rare term is found
once the corpus holds enough of it.  Counting starts again over the toxic documents that
no telling feature explains, until no feature is added, so that a toxic document's other words
do not become telling.  In a toxic document the words with a telling
feature are labelled toxic, all other words clean.  The field (a weight for each telling
feature, a bias, four transitions) is then fitted by gradient descent on the exact
conditional likelihood, on windows of a bounded sample of the labelled documents
(``SAMPLE_DOCS`` for each label) and one window more for each telling feature outside it.

Scoring covers every word of the whole text: forward-backward gives each word's marginal.
Words without a telling feature all have the same potentials, so a run of them is a power of
one 2x2 matrix; this is exact, and a text costs time in proportion to its telling words.  The
document's score is the chance that any word is toxic (noisy-or of the marginals), lifted by
the rate of toxic documents among those without evidence; the offending words' offsets are
kept as spans.

Nulls and odd input: a null or empty text has no words and gets the rate without evidence;
null or conflicting labels are left out or count as toxic if any is; without any toxic
training row all scores are 0; repeated rows are reported each; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, broadcast_if_small, staged, table, temporary

#: Documents of each label that the weights are fitted on (by lowest hash of their id), and
#: the words of each of their windows.
SAMPLE_DOCS, WINDOW = 1500, 48
#: A feature is telling if so many toxic documents have it, at so many times the rate of clean
#: ones, with at most one clean document for ``LEAST_ODDS`` toxic ones, and if its counts are so
#: unlikely under the common rate of toxic documents that chance explains at most
#: ``FALSE_SHARE`` of a round's features.
LEAST_TOXIC, LEAST_RATIO, LEAST_ODDS, FALSE_SHARE = 3, 20, 10, 0.1
PREFIXES, SUFFIX = (3, 4, 5), 4
#: Telling features taken in one round; what they leave unexplained is for the next rounds.
ROUND_FEATURES = 20_000
THRESHOLD = 0.3

WORD = re.compile(r"[^\W_]+")


def features(word: str) -> list[str]:
    n = len(word)
    return [word] + [f"{word[:k]}*" for k in PREFIXES if n > k] + ([f"*{word[-SUFFIX:]}"] if n > SUFFIX else [])


def text_words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Field(NamedTuple):
    """Fitted weights; potentials are exp(transition + state * emission)."""
    weights: dict[str, float]
    bias: float
    transitions: np.ndarray  # 2 x 2
    base_rate: float


class Telling(dict):
    """Whether a word has a telling feature, kept for words seen lately."""

    def __init__(self, telling: frozenset, most: int = 200_000):
        super().__init__()
        self.telling, self.most = telling, most

    def __missing__(self, word: str) -> bool:
        if len(self) >= self.most:
            self.clear()
        t = self[word] = not self.telling.isdisjoint(features(word))
        return t


class Emissions(dict):
    """Sum of a word's feature weights (0: no telling feature), kept for words seen lately."""

    def __init__(self, weights: dict[str, float], most: int = 200_000):
        super().__init__()
        self.weights, self.most = weights, most

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
        e = self[word] = sum(self.weights[f] for f in features(word) if f in self.weights)
        return e


def marginals(places: np.ndarray, emissions: np.ndarray, length: int, field: Field) -> np.ndarray:
    """P(toxic) at the telling words of a text of ``length`` words, by forward-backward.

    ``step`` is one neutral word: transition, then its own potentials.
    """
    step = np.exp(field.transitions) * np.array([1.0, np.exp(field.bias)])
    values, vectors = np.linalg.eig(step)
    inverse = np.linalg.inv(vectors)
    top = np.max(np.abs(values))

    def power(k: int) -> np.ndarray:
        return ((vectors * (values / top) ** k) @ inverse).real

    n = len(places)
    own = np.stack([np.ones(n), np.exp(emissions)], axis=1)
    gaps = np.diff(np.concatenate([[-1], places, [length - 1]]))
    forward, state = np.empty((n, 2)), np.array([1.0, 0.0])
    for i in range(n):
        state = (state @ power(gaps[i])) * own[i]
        forward[i] = state = state / state.sum()
    out, back = np.empty(n), power(gaps[n]) @ np.ones(2)
    for i in range(n - 1, -1, -1):
        both = forward[i] * back
        out[i] = both[1] / both.sum()
        back = power(gaps[i]) @ (own[i] * back)
        back /= back.sum()
    return out


def _fit(windows: np.ndarray, toxic: np.ndarray, mask: np.ndarray, lists: list[list[int]], size: int,
         rounds: int = 120, rate: float = 0.15, l2: float = 1e-4) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and transitions that maximise the conditional likelihood of the tags.

    ``windows`` holds word numbers; ``lists`` the telling features of each numbered word.
    """
    flat = np.array([f for fs in lists for f in fs], dtype=np.int64)
    owner = np.repeat(np.arange(len(lists)), [len(fs) for fs in lists])
    n, steps = windows.shape
    w, bias, trans = np.zeros(size), -2.0, np.array([[0.5, -0.5], [0.0, 0.0]])
    moment = [np.zeros(size), 0.0, np.zeros((2, 2))]
    square = [np.zeros(size), 0.0, np.zeros((2, 2))]
    # A rare feature's evidence is small beside the whole sample, and so must be its penalty.
    held = np.bincount(flat, weights=np.bincount(windows.ravel(), weights=mask.ravel(), minlength=len(lists))[owner], minlength=size) if len(flat) else np.zeros(size)
    pull = l2 * np.minimum(1.0, 100 * held / n)
    for r in range(1, rounds + 1):
        per_word = np.bincount(owner, weights=w[flat], minlength=len(lists)) if len(flat) else np.zeros(len(lists))
        e = per_word[windows] + bias
        pot, t = np.stack([np.ones_like(e), np.exp(np.clip(e, -30, 30))], axis=2), np.exp(trans)
        alpha, beta = np.empty((n, steps, 2)), np.ones((n, steps, 2))
        a = np.tile([1.0, 0.0], (n, 1))
        for i in range(steps):
            a = (a @ t) * pot[:, i]
            a /= a.sum(axis=1, keepdims=True)
            alpha[:, i] = a
        for i in range(steps - 2, -1, -1):
            b = (pot[:, i + 1] * beta[:, i + 1]) @ t.T
            beta[:, i] = b / b.sum(axis=1, keepdims=True)
        post = alpha * beta
        post /= post.sum(axis=2, keepdims=True)
        pair = alpha[:, :-1, :, None] * t * (pot[:, 1:] * beta[:, 1:])[:, :, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        off = (toxic - post[:, :, 1]) * mask
        both = mask[:, 1:]
        seen = np.array([[((toxic[:, :-1] == x) & (toxic[:, 1:] == y) & (both > 0)).sum() for y in (0, 1)] for x in (0, 1)], dtype=float)
        by_word = np.bincount(windows.ravel(), weights=off.ravel(), minlength=len(lists))
        grads = [np.bincount(flat, weights=by_word[owner], minlength=size) / n - pull * w if len(flat) else np.zeros(size),
                 off.sum() / n, (seen - (pair * both[:, :, None, None]).sum(axis=(0, 1))) / n - l2 * trans]
        new = []
        for k, (value, g) in enumerate(zip((w, bias, trans), grads)):
            moment[k] = 0.9 * moment[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            new.append(value + rate * (moment[k] / (1 - 0.9 ** r)) / (np.sqrt(square[k] / (1 - 0.99 ** r)) + 1e-8))
        w, bias, trans = new
    return w, float(bias), trans


def held_out(doc_id: Column) -> Column:
    """Ids whose labels must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def least_evidence(levels: dict[int, int]) -> float:
    """The least evidence at which chance explains at most ``FALSE_SHARE`` of the features that
    have it (Benjamini-Hochberg), from the number of features at each tenth of evidence."""
    tests, passed, least = sum(levels.values()), 0, math.inf
    for level in sorted(levels, reverse=True):
        passed += levels[level]
        if tests * math.exp(-level / 10) <= FALSE_SHARE * passed:
            least = level / 10
    return least


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """The field, learned from the labelled documents that are not held out."""
    with temporary(docs.sparkSession):
        return _train(docs, labels, id_col, text_col)


def _train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> Field:
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    digest = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    # Copies of a text would make its every word telling: one row for each text and label.
    rows = docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), digest.alias("digest"), F.col(text_col).alias("text"))
    one = rows.select("id", "digest").join(known, "id").groupBy("digest", "toxic").agg(F.min("id").alias("id"))
    one = broadcast_if_small(staged(one.join(rows.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("rows")), ["id", "digest"]), "toxic-ids"))
    rows = rows.join(one, ["id", "digest"]).select("id", "digest", "text", "toxic", "rows")
    rows = staged(rows.where("rows = 1").union(rows.where("rows > 1").dropDuplicates(["id", "digest"])).select("id", "text", "toxic"), "toxic-train")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not n.get(1):
        return Field({}, 0.0, np.zeros((2, 2)), 0.0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many texts hold each word; a batch sums its own."""
        for batch in batches:
            seen: Counter = Counter()
            for text in batch["text"].to_pylist():
                seen.update(set(text_words(text)))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    def silent(telling: frozenset) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tells = Telling(telling)
            for batch in batches:
                yield batch.filter(pa.array([not any(map(tells.__getitem__, set(text_words(t)))) for t in batch["text"].to_pylist()], pa.bool_()))
        return keep

    words = lambda part: part.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    clean = staged(words(rows.where("toxic = 0")).withColumnRenamed("n", "clean"), "toxic-clean-words")
    telling: dict[str, int] = {}
    left = rows.where("toxic = 1").select("text", "toxic")
    while unexplained := left.count():
        # Counts of a feature: the sums over its words.
        word = F.col("word")
        each = F.array_compact(F.array(word, *[F.when(F.length(word) > k, F.concat(F.substring(word, 1, k), F.lit("*"))) for k in PREFIXES],
                                       F.when(F.length(word) > SUFFIX, F.concat(F.lit("*"), F.substring(word, -SUFFIX, SUFFIX)))))
        counts = words(left).join(clean, "word", "full").select(F.explode(each).alias("f"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("clean", F.lit(0)).alias("clean"))
        n_clean = n.get(0, 0)
        rate = unexplained / (unexplained + n_clean)
        if rate == 1:
            break
        # Chernoff: documents of the common rate look like this with a chance of exp(-evidence) at most.
        share = F.col("n") / (F.col("n") + F.col("clean"))
        against = F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - rate))).otherwise(0.0)
        evidence = F.when(share > rate, F.col("n") * F.log(share / rate) + against).otherwise(0.0)
        sums = counts.groupBy("f").agg(F.sum("n").alias("n"), F.sum("clean").alias("clean")).where(F.col("n") + F.col("clean") >= LEAST_TOXIC)
        sums = staged(sums.withColumn("evidence", evidence), "toxic-features")
        least = least_evidence({r["level"]: r["count"] for r in sums.groupBy(F.floor(10 * F.least("evidence", F.lit(100.0))).alias("level")).count().collect()})
        found = sums.where((F.col("n") >= LEAST_TOXIC) & (F.col("n") * n_clean >= LEAST_RATIO * F.col("clean") * unexplained)
                           & (F.col("n") >= LEAST_ODDS * F.col("clean")) & (F.col("evidence") >= least)).orderBy(
            F.col("evidence").desc(), "f").limit(ROUND_FEATURES).collect()
        before = len(telling)
        for r in found:
            telling.setdefault(r["f"], len(telling))
        if len(telling) == before:
            break
        left = staged(left.mapInArrow(silent(frozenset(telling)), left.schema), "toxic-unexplained")
    number, everything = telling, frozenset(telling)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows around the first and the middle telling word, or in the middle, as space-joined words."""
        tells = Telling(everything)
        for batch in batches:
            texts, toxic = [], []
            for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                found = text_words(text)
                at = [i for i, w in enumerate(found) if tells[w]]
                for i in {at[0], at[len(at) // 2]} if at else {len(found) // 2}:
                    begin = max(0, i - WINDOW // 2)
                    texts.append(" ".join(found[begin:begin + WINDOW]))
                    toxic.append(label)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(toxic, pa.int32())], names=["words", "toxic"])

    def window_of_each(unseen: frozenset) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """For each feature the window of a task's first text by order, around its first place."""
            tells, least = Telling(unseen), {}
            for batch in batches:
                for rank, text in zip(batch["rank"].to_pylist(), batch["text"].to_pylist()):
                    found = text_words(text)
                    for i, w in enumerate(found):
                        for f in unseen.intersection(features(w)) if tells[w] else ():
                            if f not in least or rank < least[f][0]:
                                begin = max(0, i - WINDOW // 2)
                                least[f] = (rank, " ".join(found[begin:begin + WINDOW]))
            yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.string()), pa.array([r for r, _ in least.values()], pa.int64()),
                                              pa.array([t for _, t in least.values()], pa.string())], names=["f", "rank", "words"])
        return choose

    order = F.xxhash64("id", F.lit("crf"))
    # Only ids are ranked; the chosen ones' texts follow by a join with these few rows.
    ids = rows.select("id", "toxic")
    ids = ids.where("toxic = 1").orderBy(order, "id").limit(SAMPLE_DOCS).union(ids.where("toxic = 0").orderBy(order, "id").limit(SAMPLE_DOCS))
    chosen = rows.join(F.broadcast(ids), ["id", "toxic"])
    picked = chosen.select("text", "toxic").mapInArrow(sample, "words string, toxic int").collect()
    # A telling feature outside these windows would get no weight.
    unseen = everything.difference(*(features(w) for r in picked if r["toxic"] for w in r["words"].split()))
    if unseen:
        more = rows.where("toxic = 1").select("text", order.alias("rank")).mapInArrow(window_of_each(unseen), "f string, rank long, words string")
        more = more.groupBy("f").agg(F.min(F.struct("rank", "words")).alias("least")).select(F.col("least.words").alias("words"), F.lit(1).alias("toxic"))
        picked += more.distinct().collect()
    # How often is a document toxic that shows no evidence (over all training rows)?
    quiet_clean, quiet_toxic = (rows.where(F.col("toxic") == k).select("text").mapInArrow(silent(everything), "text string").count() for k in (0, 1))

    vocabulary: dict[str, int] = {"": 0}
    windows, tags, mask = [], [], []
    for r in picked:
        words = r["words"].split()[:WINDOW]
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
        pad = WINDOW - len(ids)
        windows.append(ids + [0] * pad)
        tags.append([float(r["toxic"] and w and not everything.isdisjoint(features(w))) for w in words] + [0.0] * pad)
        mask.append([1.0] * len(ids) + [0.0] * pad)
    lists = [[number[f] for f in features(w) if f in number] if w else [] for w in vocabulary]
    w, bias, trans = _fit(np.array(windows), np.array(tags), np.array(mask), lists, len(number))
    return Field({f: float(w[i]) for f, i in number.items()}, bias, trans, quiet_toxic / max(1, quiet_clean + quiet_toxic))


def document_score(words: list[str], emissions: Emissions, field: Field) -> tuple[float, list[int]]:
    """The document's score, and which words are toxic (marginal of a half or more)."""
    e = np.fromiter(map(emissions.__getitem__, words), dtype=float, count=len(words))
    places = np.flatnonzero(e)
    if not len(places):
        return field.base_rate, []
    p = marginals(places, e[places] + 0.0, len(words), field)
    some = 1.0 - float(np.exp(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))
    return some + (1 - some) * field.base_rate, places[p >= 0.5].tolist()


def score_toxicity(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score``, ``spans`` (start and end of the offending words, in code points
    of the lower-cased text) for every document."""
    bounded_batches(docs.sparkSession)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = Emissions(field.weights)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            scores, spans = [], []
            for text in batch["text"].to_pylist():
                s, at = document_score(text_words(text), emissions, field)
                scores.append(s)
                where = [m.span() for m in WORD.finditer(text.lower())] if at else []
                spans.append([{"start": where[i][0], "end": where[i][1]} for i in at])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64()), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(score, "doc_id long, score double, spans array<struct<start: int, end: int>>")


def drop_toxic(docs: DataFrame, field: Field, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents, all columns, that score below the threshold."""
    bounded_batches(docs.sparkSession)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = Emissions(field.weights)
        for batch in batches:
            yield batch.filter(pa.array([document_score(text_words(t), emissions, field)[0] < threshold for t in batch[text_col].to_pylist()], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)


def op8_crf_toxicity(spark, sf_dir: str) -> DataFrame:
    """All documents scored."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    out = score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans")


QUERIES = {"op8_crf_toxicity": op8_crf_toxicity}
ORACLE: dict[str, str] = {}
