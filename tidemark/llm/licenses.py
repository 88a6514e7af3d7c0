"""Licence scan by a positional rare-token index.

Templates are word sequences (opening words of notices, paragraphs of licences) with mandatory
key phrases.  The document frequencies of their words over the whole corpus say how rare each
word is.  The index posts every word of every template with its places.  Per text:

1. a template is in question if the text holds all words of its key phrases;
2. the text's licence words are ranked by rarity; for every template in question the rarest
   ones are looked up: a place of the word in the text and one posted place in a key phrase
   give an alignment (where the template would begin), and the alignments of the looked-up
   postings are intersected;
3. an alignment that is left stands if every key phrase is there word for word at its relative
   place; its score is the share of the template's words, weighted by rarity, that stand where
   they should.

A standing alignment has all its key words in place, so no intersection loses one: the labels
do not depend on which words are rare.

Words are runs of digits, a-z (A-Z in lower case) and non-ASCII characters of the whole text.

Nulls and odd input: a null or empty text has no words, no places and score 0; labels are
empty strings then; repeated rows are reported each; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table

#: The base phrases with their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Fixed values: (label, words of a notice or paragraph, key phrases in it that must be there).
NOTICES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ("permission is hereby granted free of charge",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ("redistribution and use in source and binary forms",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
     ("gnu general public license",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc0", "to the extent possible under law the author has waived all copyright cc0", ("waived all copyright",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("released into the public domain",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
     "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
     "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
     "the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions "
     "of the software", ("without restriction including without limitation the rights to use copy modify merge publish distribute sublicense",
                         "substantial portions of the software")),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license "
     "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in "
     "writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either "
     "express or implied", ("except in compliance with the license", "apache org licenses license 2 0")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
     "conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following "
     "disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
     "disclaimer in the documentation and or other materials provided with the distribution",
     ("redistributions of source code must retain the above copyright notice",)),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
     "derived from this software without specific prior written permission",
     ("may be used to endorse or promote products derived from this software",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
     "that the above copyright notice and this permission notice appear in all copies",
     ("distribute this software for any purpose with or without fee is hereby granted",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any "
     "damages arising from the use of this software", ("in no event will the authors be held liable for any damages",)),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ("boost software license version 1 0",)),
)

_SPACED = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def scan_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(_SPACED).split() if text else []


class Template(NamedTuple):
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[int, tuple[bytes, ...]], ...]  # (place in the template, words)
    base: bool


def _template(label: str, text: str, phrases: tuple[str, ...], base: bool) -> Template:
    words = tuple(scan_words(text))
    keys = []
    for phrase in phrases:
        p = tuple(scan_words(phrase))
        keys.append((next(i for i in range(len(words)) if words[i:i + len(p)] == p), p))
    return Template(label, words, tuple(keys), base)


TEMPLATES = tuple([_template(label, p, (p,), True) for p, label in BASE_PHRASES.items()] + [_template(*n, False) for n in NOTICES])
VOCABULARY = frozenset(w for t in TEMPLATES for w in t.words)


def document_frequencies(texts: DataFrame) -> tuple[int, dict[bytes, int]]:
    """Number of texts, and for each template word the number that hold it (over all rows)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = defaultdict(int)
        for batch in batches:
            held[b""] += len(batch)
            for text in batch["text"]:
                for w in VOCABULARY.intersection(scan_words(text.as_py())):
                    held[w] += 1
        yield pa.RecordBatch.from_pydict({"word": [w.decode() for w in held], "n": list(held.values())},
                                         schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

    sums = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    n = {r["word"].encode(): r["n"] for r in sums}
    return n.get(b"", 0), {w: n.get(w, 0) for w in VOCABULARY}


#: So many of a template's key words, the rarest in the text first, are looked up and intersected.
PROBES = 3


class RareTokenIndex:
    """Template word -> the templates that hold it, with its places in them."""

    def __init__(self, total: int, held: dict[bytes, int]):
        self.idf = {w: math.log((total + 1) / (held[w] + 0.5)) + 1 for w in VOCABULARY}
        self.rank = {w: k for k, w in enumerate(sorted(VOCABULARY, key=lambda w: (-self.idf[w], w)))}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.key_places: list[set[int]] = []
        for t, template in enumerate(TEMPLATES):
            for place, word in enumerate(template.words):
                self.postings[word].append((t, place))
            self.key_places.append({at + j for at, phrase in template.keys for j in range(len(phrase))})
        self.key_words = [frozenset(template.words[p] for p in places) for template, places in zip(TEMPLATES, self.key_places)]
        self.all_keys = frozenset().union(*self.key_words)
        self.weight = [sum(self.idf[w] for w in t.words) for t in TEMPLATES]

    def alignments(self, words: list[bytes]) -> dict[int, set[int]]:
        """Template -> where it may begin, by the text's rarest words that the template must hold."""
        held = self.all_keys.intersection(words)
        asked = [t for t, keys in enumerate(self.key_words) if keys <= held] if held else []
        if not asked:
            return {}
        left = {t: min(PROBES, len(self.key_places[t])) for t in asked}
        probes: list[tuple[int, int, bytes]] = []
        for word in sorted(held, key=self.rank.__getitem__):
            for t, place in self.postings[word]:
                if left.get(t) and place in self.key_places[t]:
                    left[t] -= 1
                    probes.append((t, place, word))
        places: dict[bytes, list[int]] = {word: [] for _, _, word in probes}
        for at, word in enumerate(words):
            if word in places:
                places[word].append(at)
        begins: dict[int, set[int]] = {}
        for t, place, word in probes:
            here = begins.get(t)
            if here is None:
                begins[t] = {at - place for at in places[word]}
            elif here:
                here.intersection_update([at - place for at in places[word]])
        return begins

    def stands(self, words: list[bytes], t: int, begin: int) -> bool:
        return all(begin + p >= 0 and tuple(words[begin + p:begin + p + len(key)]) == key for p, key in TEMPLATES[t].keys)

    def score(self, words: list[bytes], t: int, begin: int) -> float:
        there = sum(self.idf[x] for j, x in enumerate(TEMPLATES[t].words) if 0 <= begin + j < len(words) and words[begin + j] == x)
        return min(1.0, there / self.weight[t])

    def find(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, place of its first key word, score) of every alignment that stands, by place."""
        out = [(t, begin + TEMPLATES[t].keys[0][0], self.score(words, t, begin))
               for t, begins in self.alignments(words).items() for begin in begins if self.stands(words, t, begin)]
        return sorted(out, key=lambda x: (x[1], x[0]))


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, places array<struct<label: string, word: int, score: double>>")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its licence labels and the places where they stand."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    index = RareTokenIndex(*document_frequencies(slim.select("text")))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places")}
            for text in batch["text"]:
                words = scan_words(text.as_py())
                found = index.find(words)
                base = [(TEMPLATES[t].label, at) for t, at, _ in found if TEMPLATES[t].base]
                out["n_words"].append(len(words))
                out["n_base"].append(len(base))
                out["first_word"].append(min((at for _, at in base), default=None))
                out["last_word"].append(max((at for _, at in base), default=None))
                out["base_labels"].append(",".join(sorted({label for label, _ in base})))
                out["labels"].append(",".join(sorted({TEMPLATES[t].label for t, _, _ in found})))
                out["score"].append(max((s for _, _, s in found), default=0.0))
                out["places"].append([{"label": TEMPLATES[t].label, "word": at, "score": s} for t, at, s in found])
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), place]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(v, k) for v, k in zip(out.values(), kinds))], names=["doc_id", *out])

    return slim.mapInArrow(scan, SCHEMA)


def op5_rare_token_licenses(spark, sf_dir: str) -> DataFrame:
    """All documents with their licence labels."""
    return scan_licenses(table(spark, sf_dir, "documents"))


QUERIES = {"op5_rare_token_licenses": op5_rare_token_licenses}
ORACLE: dict[str, str] = {}
