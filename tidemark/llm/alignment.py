"""Cross-tokenizer alignment: two tokenisations of a text, cut into groups where both end a token.

Divide and conquer at shared cuts: an interval of the text looks for a byte offset near its
middle at which tokens of both kinds end, by bisection: the next end of A from the middle, then
the next end of B from there, and so on until they agree, upwards first and then downwards.
Both halves go on alike; an interval without an inner cut is a leaf, one group.  All open
intervals of a batch of texts take each step together.

A group's last A token and last B token end together; such a pair is a link.  A link's count is
the number of links of the whole corpus with its id pair.

Nulls and odd input: texts that are null or empty, and texts that either tokenizer does not give
back byte for byte (its tokens joined differ from a space and the text), have no tokens and only
zeros; special tokens' strings inside a text are plain text; rows with a null or repeated id, and
repeated texts, are rows of their own; an empty table gives an empty one.  Texts are encoded
whole, however long.  The tokenizer files are read once, on the driver, and travel with the task
functions.

Memory: a batch's texts are encoded a few MB at a time.  The table of pair counts is broadcast
when counting proves it has at most ``BROADCAST_PAIRS`` rows; beyond that the texts' pairs are
joined with it by a shuffle, for which pairs that hold more than a ten-thousandth of all links (at
most 10,000 of them) are broadcast and the others shuffled, so no key is hot.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, staged, table

TOKENIZER_FOLDER = "/opt/tokenizers"
TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pair tables of up to this many rows (16 bytes each) are broadcast.
BROADCAST_PAIRS = 2_000_000
#: A pair with more than one in so many links is joined by broadcast.
HOT_SHARE = 10_000
#: Bytes of text that are encoded at once (a longer text is one piece of work).
PIECE_BYTES = 500_000

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters stand for themselves, the other bytes, in order, for those from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Fixed value: the pattern by which byte-level BPE cuts texts into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that every version of Unicode puts into the same classes of that pattern.
OLD_CHARACTERS = re.compile(r"[\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac]*")


class BytePieces:
    """Tokenizer A: byte-level BPE in the JSON format of the tokenizers library.  Where the file
    says no more than a vocabulary whose ids are its merges' ranks, texts of old characters are
    encoded by those ranks with tiktoken, which gives the same tokens several times faster."""

    def __init__(self, spec: bytes):
        import json

        from tokenizers import Tokenizer
        model = json.loads(spec)
        self.tokenizer = Tokenizer.from_str(spec.decode("utf-8"))
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size, byte = self.tokenizer.get_vocab_size(), byte_of_char()
        entries = [self.tokenizer.id_to_token(i) or "" for i in range(self.size)]
        self.bytes = [bytes(byte[c] for c in e) if all(c in byte for c in e) else e.encode() for e in entries]
        self.ranked, cut, bpe = None, model.get("pre_tokenizer") or {}, model["model"]
        vocab, special = bpe["vocab"], {t["content"] for t in model.get("added_tokens", [])}
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in bpe.get("merges", [])]
        plain = (bpe.get("type") in (None, "BPE") and not any(bpe.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
                 and model.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space"))
        if plain and all(vocab.get(c, 256) < 256 for c in byte) and all(vocab.get(m) == 256 + i for i, m in enumerate(merges)):
            import tiktoken
            ranks = {self.bytes[i]: i for e, i in vocab.items() if e not in special}
            self.ranked = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list = [self.ranked.encode_ordinary(" " + t) if self.ranked and OLD_CHARACTERS.fullmatch(t) else None for t in texts]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, e in zip(rest, self.tokenizer.encode_batch_fast([" " + texts[k] for k in rest], add_special_tokens=False)):
            out[k] = e.ids
        return out


class SentencePieces:
    """Tokenizer B: a sentencepiece model with byte fallback, which puts a space before the text."""

    def __init__(self, spec: bytes):
        import sentencepiece
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=spec)
        self.size = self.processor.get_piece_size()
        self.bytes = [bytes([int(p[3:5], 16)]) if self.processor.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(self.processor.id_to_piece(i) for i in range(self.size))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, out_type=int, num_threads=1)


NONE = np.iinfo(np.int64).max


def next_common(a: np.ndarray, b: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Per interval, the least value of both sorted arrays from ``start`` on and below ``stop``,
    or NONE: each side in turn moves on to its first value not below the other's.  (Both arrays
    end with NONE.)"""
    at, found = start.copy(), np.full(len(start), NONE)
    open_ = np.flatnonzero(at < stop)
    while len(open_):
        x = a[np.searchsorted(a, at[open_])]
        y = b[np.searchsorted(b, x)]
        same = (x == y) & (x < stop[open_])
        found[open_[same]] = x[same]
        at[open_] = y
        open_ = open_[(x != y) & (y < stop[open_])]
    return found


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """All offsets where both end a token, sorted; ``bounds`` are the texts' own bounds.
    Downward searches run on the mirrored ends."""
    low, high, cuts = bounds[:-1], bounds[1:], [bounds[1:]]
    up = [np.append(x, NONE) for x in (ends_a, ends_b)]
    down = [np.append(-x[::-1], NONE) for x in (ends_a, ends_b)]
    while len(low):
        middle = (low + high + 1) // 2
        cut = next_common(*up, middle, high)
        none = np.flatnonzero(cut == NONE)
        below = next_common(*down, 1 - middle[none], -low[none])
        cut[none] = np.where(below == NONE, NONE, -below)
        halved = cut != NONE
        cuts.append(cut[halved])
        # Intervals are disjoint: sorted bounds pair up, and ordered searches are fast.
        low, high = np.sort(np.concatenate([low[halved], cut[halved]])), np.sort(np.concatenate([cut[halved], high[halved]]))
    return np.sort(np.concatenate(cuts))


def align(texts: list[str], a, b, text_a: list[str], text_b: list[str]) -> Iterator[tuple]:
    """Per text: numbers of tokens and groups, the digest, and its id pairs with their times."""
    ids_a, ids_b, whole, bounds = a.encode(texts), b.encode(texts), [], [0]
    for k, text in enumerate(texts):
        want = b" " + text.encode("utf-8")
        if b"".join(map(a.bytes.__getitem__, ids_a[k])) == want and b"".join(map(b.bytes.__getitem__, ids_b[k])) == want:
            whole.append(k)
            bounds.append(bounds[-1] + len(want))
    bounds = np.array(bounds, dtype=np.int64)
    length_a, length_b = (np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (a, b))
    flat_a, flat_b = (np.fromiter(chain.from_iterable(ids[k] for k in whole), dtype=np.int64) for ids in (ids_a, ids_b))
    ends_a, ends_b = np.cumsum(length_a[flat_a]), np.cumsum(length_b[flat_b])
    cuts = shared_cuts(ends_a, ends_b, bounds)
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    last_a, last_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
    pairs = flat_a[last_a] * b.size + flat_b[last_b]
    # The tokens as text, each with what follows it: all of a group's A ids, then its B ids.
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    ends = np.zeros(len(flat_a) + len(flat_b), dtype=np.int64)
    ends[last_a], ends[len(flat_a) + last_b] = 1, 1
    code = np.concatenate([flat_a, flat_b + a.size]) * 2 + ends
    code, names = code[order].tolist(), text_a + text_b
    first_a, first_b, first_g = (np.searchsorted(x, bounds, side="right") for x in (ends_a, ends_b, cuts))
    at = {k: i for i, k in enumerate(whole)}
    for k in range(len(texts)):
        i = at.get(k)
        if i is None:
            yield 0, 0, 0, 0, "", [], []
            continue
        na, nb, ng = (int(x[i + 1] - x[i]) for x in (first_a, first_b, first_g))
        lo = int(first_a[i] + first_b[i])
        groups = "".join([names[c] for c in code[lo:lo + na + nb]])[:-1]
        own, times = np.unique(pairs[first_g[i]:first_g[i + 1]], return_counts=True)
        yield na, nb, ng, ng, hashlib.sha256(groups.encode()).hexdigest(), own, times.astype(np.int32)


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _aligner(spec_a: bytes, spec_b: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has its core, no more
        a = b = None
        for batch in batches:
            if a is None:
                a, b = BytePieces(spec_a), SentencePieces(spec_b)
                text_a = [f"{i}{s}" for i in range(a.size) for s in ",|"]
                text_b = [f"{i}{s}" for i in range(b.size) for s in ",;"]
            ids, texts = batch["doc_id"], batch["text"].to_pylist()
            at = 0
            while at < len(texts):
                size, end = 0, at
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= PIECE_BYTES):
                    size, end = size + len(texts[end] or ""), end + 1
                some = texts[at:end]
                full = [t for t in some if t]
                got = iter(align(full, a, b, text_a, text_b) if full else ())
                rows = [next(got) if t else (0, 0, 0, 0, "", [], []) for t in some]
                cols = list(zip(*rows))
                arrays = [ids.slice(at, end - at), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()),
                          pa.array(cols[5], pa.list_(pa.int64())), pa.array(cols[6], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
                at = end
    return run


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The times of each pair, summed over some batches at once before they are shuffled."""
    kept: list[tuple[np.ndarray, np.ndarray]] = []

    def merged():
        pairs, times = (np.concatenate(x) for x in zip(*kept))
        own, place = np.unique(pairs, return_inverse=True)
        return own, np.bincount(place, weights=times, minlength=len(own)).astype(np.int64)
    size = 0
    for batch in batches:
        pairs, times = batch["pairs"].flatten().to_numpy(), batch["times"].flatten().to_numpy()
        kept.append((pairs, times.astype(np.int64)))
        size += len(pairs)
        if size > 2_000_000:
            kept = [merged()]
            size = len(kept[0][0])
            if size > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept[0]], names=["pair", "n"])
                kept, size = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged()], names=["pair", "n"])


def _scored(pairs: np.ndarray, counts: np.ndarray, best: np.ndarray):
    """Sums over a row's links, looked up in the broadcast pair table."""
    table_ = (pairs, counts, best)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = table_
        for batch in batches:
            own, times = batch["pairs"].flatten().to_numpy(), batch["times"].flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(batch)), batch["pairs"].value_lengths().to_numpy())
            at = np.searchsorted(pairs, own)
            n_best, count_sum = np.zeros(len(batch), dtype=np.int64), np.zeros(len(batch), dtype=np.int64)
            np.add.at(n_best, row, times * best[at])
            np.add.at(count_sum, row, times * counts[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), pa.array(n_best), pa.array(count_sum), batch["groups_sha256"]],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return run


def align_tokenizers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZER_FOLDER,
                     broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum``, ``groups_sha256``."""
    spark = docs.sparkSession
    spec_a, spec_b = _read(f"{folder}/{TOKENIZER_A}"), _read(f"{folder}/{TOKENIZER_B}")
    size_b = SentencePieces(spec_b).size
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with small_batches(spark):
        rows = staged(slim.mapInArrow(_aligner(spec_a, spec_b), ALIGNED), "aligned")
    counts = rows.select("pairs", "times").mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = staged(counts, "align-pairs")
    of_b = F.expr(f"pair % {size_b}")
    top = counts.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))       # as many rows as B has ids
    judged = counts.join(F.broadcast(top), of_b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if counts.count() <= broadcast_pairs:
        found = judged.orderBy("pair").toArrow()
        pairs, n, best = (found[c].to_numpy().astype(np.int64) for c in ("pair", "n", "best"))
        if not len(pairs):
            return rows.withColumn("n_best", F.lit(0).cast("long")).withColumn("count_sum", F.lit(0).cast("long")).select(*out)
        schema = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in out)
        return rows.mapInArrow(_scored(pairs, n, best), schema)
    rows = staged(rows.withColumn("uid", F.monotonically_increasing_id()), "align-rows")
    links = rows.select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("uid", "p.pairs", "p.times")
    total = counts.agg(F.sum("n")).first()[0]
    hot = F.col("n") * F.lit(HOT_SHARE) > F.lit(total)
    often = F.broadcast(judged.where(hot).select("pair", F.col("n").alias("hot_n"), F.col("best").alias("hot_best")))
    marked = links.join(often, links.pairs == often.pair, "left").drop("pair")
    sums = [F.sum(F.col("times") * F.col("best")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    parts = [marked.where("hot_n IS NOT NULL").select("uid", "times", F.col("hot_n").alias("n"), F.col("hot_best").alias("best")),
             marked.where("hot_n IS NULL").join(judged.where(~hot), F.col("pairs") == F.col("pair")).select("uid", "times", "n", "best")]
    per_row = parts[0].unionByName(parts[1]).groupBy("uid").agg(*sums)
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return rows.join(per_row, "uid", "left").select(*out[:5], *zero, "groups_sha256")


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    """All documents under both public tokenizers."""
    return align_tokenizers(table(spark, sf_dir, "documents"))


QUERIES = {"op13_token_alignment": op13_token_alignment}
ORACLE: dict[str, str] = {}
