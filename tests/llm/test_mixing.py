"""Mixing sources to target weights."""

import pytest

from tidemark.llm import mixing


def brute_targets(sizes, budget=1.5, weights=(3, 1, 2), cap=2):
    """Share by weight; what exceeds a cap is shared again among the others."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), budget * sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] >= cap * sizes[s]}
        if not over:
            target |= {s: level * w[s] for s in free}
            break
        target |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free -= over
    return target


def mix(df, **kw):
    return [r.asDict() for r in mixing.mix_sources(df, carry=["doc_id", "source"], **kw).collect()]


@pytest.mark.parametrize("sizes", [
    {"a": 1000, "b": 1000, "c": 1000}, {"a": 3000, "b": 100, "c": 50, None: 400}, {"é": 10, "a": 5000, "Z": 700, "b": 900, "c": 20},
    {"only": 500},
])
def test_targets_and_taken_words(documents, sizes):
    rows, i = [], 0
    for s, n in sizes.items():
        left = n
        while left:
            k = min(left, 1 + i % 7)
            rows.append((i, " ".join(["w"] * k), "en", s))
            left, i = left - k, i + 1
    got = mix(documents(rows))
    want = brute_targets(sizes)
    assert len(got) == len(rows)
    for s in sizes:
        of = [r for r in got if r["source"] == s]
        assert of[0]["source_size"] == sizes[s] and abs(of[0]["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert abs(sum(r["taken"] for r in of) - want[s]) <= 7
        assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in of)
        # Whole epochs come first.
        assert len({r["copies"] for r in of if r["size"]}) <= 2


def test_quality_weighs(spark, documents):
    docs = documents([(i, "one two three four", "en", "a") for i in range(2000)] + [(9000 + i, "x " * 4, "en", "b") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(2000)], "doc_id long, quality int, toxic int")
    got = mix(docs, quality=mixing.quality_weights(labels), budget=0.5)
    good, bad = (sum(r["copies"] for r in got if r["doc_id"] < 2000 and r["doc_id"] % 2 == q) for q in (1, 0))
    assert good > 1.5 * bad > 0


def test_reruns_agree(documents):
    rows = [(i, "a b c " * (i % 5), "en", "abc"[i % 3] if i % 4 else "d") for i in range(1500)]
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, mix(documents(rows)))) == sorted(map(key, mix(documents(rows, parts=5))))


def test_nulls_empty_repeated_and_no_rows(documents):
    got = mix(documents([(None, None, None, None), (1, "", None, "a"), (2, "w " * 20_000, None, "a"), (2, "w " * 20_000, None, "a"), (3, "x y z", None, None)]))
    assert sorted((r["size"], r["source"] or "") for r in got) == [(0, ""), (0, "a"), (2, ""), (20_000, "a"), (20_000, "a")]
    assert mix(documents([])) == []


def test_a_source_of_repeated_rows_is_narrowed_down(documents):
    got = mix(documents([(1, "a b", "en", "a")] * 9000 + [(2, "c", "en", "b")] * 900))
    for s, n in (("a", 18_000), ("b", 900)):
        of = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in of) - of[0]["target"]) <= 2


def test_rows_without_an_id_draw_by_their_text(documents):
    rows = [(None, f"w{i} a b", "en", "a") for i in range(1200)]

    def drawn(parts):
        got = mixing.mix_sources(documents(rows, parts=parts), budget=0.5, carry=["text"]).collect()
        return sorted(r["text"] for r in got if r["copies"])
    assert drawn(3) == drawn(5) and abs(len(drawn(3)) - 600) <= 1
