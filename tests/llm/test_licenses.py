"""Licence scan against a plain search."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import licenses

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, label) for p, label in BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    return (len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at})))


PIECES = ["cc", "by", "CC-BY", "general", "public", "license", "all", "rights", "reserved", "All Rights\nReserved.", "é", "x1", "nc", "MIT license", "GNU General Public License, version 3."]


def test_base_places_of_random_texts(documents):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(PIECES) for _ in range(rng.randrange(30)))) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "cc by"), (902, "cc by " * 30_000), (903, "cc by"), (903, "cc by")]
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in licenses.scan_licenses(documents(rows)).collect()]
    assert sorted(got, key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)


def test_templates_and_scores(documents):
    out = {r["doc_id"]: r for r in licenses.scan_licenses(documents([
        (1, "Released under the MIT License."), (2, "Licensed under the Apache License, Version 2.0."), (3, "Licensed under CC BY-NC 4.0."),
        (4, "GNU Lesser General Public License"), (5, "the rights of all reserved seats"), (6, "under GNU General Public License, version 3")])).collect()}
    assert [out[i]["labels"] for i in range(1, 7)] == ["mit", "apache-2.0", "cc-by,cc-by-nc", "gpl,lgpl", "", "gpl,gpl-3.0"]
    assert out[1]["score"] == 1.0 and 0 < out[4]["score"] <= 1 and out[5]["score"] == 0.0 and out[5]["base_labels"] == ""


def test_no_rows(documents):
    assert licenses.scan_licenses(documents([])).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.text())
def test_words_of_any_text(text):
    index = licenses.RareTokenIndex(10, {w: 1 for w in licenses.VOCABULARY})
    words = licenses.scan_words(text)
    assert len(words) == brute(text)[0]
    index.find(words)


def brute_alignments(index, words):
    """Every template tried at every place, without the index."""
    out = []
    for t, template in enumerate(licenses.TEMPLATES):
        for begin in range(-len(template.words), len(words)):
            if all(begin + p >= 0 and tuple(words[begin + p:begin + p + len(key)]) == key for p, key in template.keys):
                there = [x for j, x in enumerate(template.words) if begin + j >= 0 and words[begin + j:begin + j + 1] == [x]]
                out.append((t, begin + template.keys[0][0], min(1.0, sum(index.idf[x] for x in there) / index.weight[t])))
    return sorted(out, key=lambda x: (x[1], x[0]))


def license_text(rng):
    """Runs out of the templates, whole, cut or with a word changed, between other words."""
    out = []
    for _ in range(rng.randrange(6)):
        words = [w.decode() for w in rng.choice(licenses.TEMPLATES).words]
        kind = rng.randrange(4)
        if kind == 1:
            words = words[rng.randrange(len(words)):]
        elif kind == 2:
            words = words[:rng.randrange(1, len(words) + 1)]
        elif kind == 3:
            words[rng.randrange(len(words))] = rng.choice(PIECES)
        out += words + [rng.choice(PIECES) for _ in range(rng.randrange(3))]
    return " ".join(out)


def test_all_labels_places_and_scores_against_every_alignment(documents):
    rng = random.Random(7)
    rows = [(i, license_text(rng)) for i in range(250)]
    index = licenses.RareTokenIndex(*licenses.document_frequencies(documents(rows).select("text")))
    got = {r["doc_id"]: r for r in licenses.scan_licenses(documents(rows)).collect()}
    for i, text in rows:
        want = brute_alignments(index, licenses.scan_words(text))
        assert [(p["label"], p["word"], round(p["score"], 9)) for p in got[i]["places"]] == \
            [(licenses.TEMPLATES[t].label, at, round(score, 9)) for t, at, score in want]
        assert got[i]["labels"] == ",".join(sorted({licenses.TEMPLATES[t].label for t, _, _ in want}))


@settings(max_examples=200, deadline=None)
@given(st.randoms(use_true_random=False))
def test_rarity_changes_no_place(rng):
    words = licenses.scan_words(license_text(rng))
    index = licenses.RareTokenIndex(1000, {w: rng.randrange(1000) for w in licenses.VOCABULARY})
    assert index.find(words) == brute_alignments(index, words)


def test_rare_words_are_looked_up_first():
    held = {w: 900 for w in licenses.VOCABULARY} | {b"mozilla": 1}
    index = licenses.RareTokenIndex(1000, held)
    words = licenses.scan_words("public license " * 500 + "the mozilla public license " + "public license " * 500)
    mpl = next(t for t, x in enumerate(licenses.TEMPLATES) if x.label == "mpl-2.0")
    assert len(index.alignments(words)[mpl]) == 1
    assert min(index.rank, key=index.rank.get) == b"mozilla"


def test_whole_licence_texts(documents):
    whole = {t.label: " ".join(w.decode() for w in t.words) for t in licenses.TEMPLATES if not t.base}
    out = {r["doc_id"]: r for r in licenses.scan_licenses(documents(list(enumerate(whole.values())))).collect()}
    for i, label in enumerate(whole):
        assert label in out[i]["labels"].split(",") and out[i]["score"] == 1.0
    cut = "Redistributions of source code must retain the above copyright notice,\nthis list of conditions"
    got = licenses.scan_licenses(documents([(1, cut)])).first()
    assert got["labels"] == "bsd" and 0 < got["score"] < 1
