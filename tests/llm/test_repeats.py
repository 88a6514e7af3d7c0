"""Repeated lines and sentences against a plain search."""

import random
import re

from tidemark.llm import repeats

PASSAGE = " ".join(f"Every p{i} part of this passage has its own number {i} here." for i in range(6))


def brute(rows):
    """(doc_id, start, text) of all occurrences of repeated units, in rank order."""
    seen = {}
    for n, (d, text) in enumerate(rows):
        for line in re.finditer(r"[^\n]+", text or ""):
            for m in re.finditer(r"\S(?:.*?[.!?](?=[ \t]|$)|.*)", line[0]):
                key = re.findall(r"[a-z0-9]+", m[0].lower())
                if len(key) >= repeats.LEAST_WORDS:
                    seen.setdefault(tuple(key), []).append((d, line.start() + m.start(), n))
    return {(d, s, i == 0) for v in seen.values() if len(v) > 1 for i, (d, s, _) in enumerate(sorted(v, key=lambda x: (x[0], x[1])))}


def test_occurrences_match_a_plain_search(documents):
    rng = random.Random(9)
    units = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "so", "on"]) for _ in range(rng.randrange(2, 9))) + rng.choice([".", "!", "?"]) for _ in range(60)]
    rows = [(i, "".join(rng.choice(units) + rng.choice([" ", "\n", "\n\n"]) for _ in range(rng.randrange(6)))) for i in range(120)]
    got = {(r["doc_id"], r["start"], r["kept"]) for r in repeats.repeated_units(documents(rows)).collect()}
    assert got == brute(rows)


def test_a_passage_in_the_middle_of_lines_is_found(documents):
    rows = [(i, f"Only document {i} begins like that, truly. {PASSAGE} And only {i} ends in these words.") for i in range(5)] + [(9, "Nothing here stands anywhere else at all.")]
    out = repeats.remove_repeats(documents(rows)).collect()
    text = {r["doc_id"]: r["text"] for r in out}
    assert text[0] == rows[0][1] and text[9] == rows[5][1]
    for i in range(1, 5):
        assert "passage" not in text[i] and f"Only document {i} begins" in text[i] and f"only {i} ends" in text[i]
    removed = {r["doc_id"]: r["removed"] for r in out}
    assert removed[0] is None and removed[9] is None
    assert [rows[2][1][s["start"]:s["start"] + s["chars"]] for s in removed[2]] == re.findall(r"Every.*?\.", PASSAGE)


def test_a_passage_without_marks_is_found_between_other_words(documents):
    rng = random.Random(11)
    passage = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    rows = [(i, " ".join(f"own{i}x{k}" for k in range(30)) + " " + passage + " " + " ".join(f"end{i}x{k}" for k in range(30))) for i in range(6)]
    rows.append((9, " ".join(f"clean{k}" for k in range(200))))
    out = {r["doc_id"]: r for r in repeats.remove_repeats(documents(rows)).collect()}
    for i in range(1, 6):
        left = set(out[i]["text"].split()) & set(passage.split())
        assert len(left) <= 30 and all(f"own{i}x{k}" in out[i]["text"] for k in range(20))
        assert "".join(rows[i][1][s["start"]:s["start"] + s["chars"]] for s in out[i]["removed"]).split()
    assert out[0]["text"] == rows[0][1] and out[9]["text"] == rows[6][1]


def test_a_long_passage_goes_but_for_a_few_words_at_its_ends(documents):
    rng = random.Random(12)
    some = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passages = [some(n) for n in (51, 60, 80) for _ in range(40)]
    rows = [(2 * i + k, " ".join(some(30) + p + some(30))) for i, p in enumerate(passages) for k in (0, 1)]
    out = {r["doc_id"]: r["text"].split() for r in repeats.remove_repeats(documents(rows)).collect()}
    lost = []
    for i, p in enumerate(passages):
        assert " ".join(out[2 * i]) == rows[2 * i][1]
        words = rows[2 * i + 1][1].split()
        assert out[2 * i + 1][:30] == words[:30] and out[2 * i + 1][-30:] == words[-30:]
        middle = out[2 * i + 1][30:-30]
        head = next((k for k, (x, y) in enumerate(zip(middle, p)) if x != y), len(middle))
        assert middle == p[:head] + p[len(p) - (len(middle) - head):]  # only the ends stay
        lost.append(len(middle))
    assert max(lost) <= 30 and sum(lost) <= 8 * len(lost) and sum(n <= 12 for n in lost) >= 0.85 * len(lost)


def test_a_repeated_long_line_goes_wholly(documents):
    rng = random.Random(13)
    line = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200))
    rows = [(1, line), (2, f"own words of two\n{line}"), (3, f"{line}\nlast words of three")]
    out = {r["doc_id"]: r["text"].strip() for r in repeats.remove_repeats(documents(rows)).collect()}
    assert out == {1: line, 2: "own words of two", 3: "last words of three"}


def test_odd_input(documents):
    line = "this very line is there again"
    docs = documents([(None, line), (1, None), (2, ""), (3, line), (3, line), (4, "Too short.\nToo short."), (5, (line + "\n") * 3000), (6, "\n \n")])
    got = sorted((r["doc_id"] or 0, r["copies"], r["kept"]) for r in repeats.repeated_units(docs).collect() if r["doc_id"] != 5)
    assert got == [(0, 3003, False), (3, 3003, False), (3, 3003, True)]
    out = repeats.remove_repeats(docs)
    assert out.columns[-2:] == ["text", "removed"]
    text = sorted((r["doc_id"] or 0, (r["text"] or "").strip()) for r in out.collect())
    assert text == [(0, ""), (1, ""), (2, ""), (3, ""), (3, line), (4, "Too short.\nToo short."), (5, ""), (6, "")]
    assert repeats.remove_repeats(documents([])).collect() == []


def test_columns_of_any_name_come_back(spark):
    from pyspark.sql import functions as F
    unit = "This very line is repeated here."
    df = spark.createDataFrame([(1, unit), (2, unit + "\nAnd here is something else again.")], "doc_id long, text string")
    names = ["_row", "_gone", "_clean", "_text", "_doc"]
    for name in names:
        df = df.withColumn(name, F.lit("mine"))
    out = {r["doc_id"]: r for r in repeats.remove_repeats(df).collect()}
    assert all(out[i][n] == "mine" for i in out for n in names)
    assert out[1]["text"] == unit and out[1]["removed"] is None and unit not in out[2]["text"]


def test_units_are_shuffled_without_padding(documents, monkeypatch):
    """Nothing of variable length in the rows that are staged and shuffled: no offsets, no length prefixes."""
    from tidemark.llm import repeats
    kinds, staged = [], repeats.staged
    monkeypatch.setattr(repeats, "staged", lambda df, name: kinds.append(df.schema.simpleString()) or staged(df, name))
    line = "one two three four five six seven"
    got = repeats.repeated_units(documents([(1, line), (2, f"{line}\nother words here that stand alone once")])).collect()
    assert [(r.doc_id, r.start, r.chars, r.words, r.copies, r.kept) for r in sorted(got)] == [(1, 0, len(line), 7, 2, True), (2, 0, len(line), 7, 2, False)]
    assert kinds and not any("binary" in k for k in kinds)
