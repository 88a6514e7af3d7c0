"""Near-duplicates by an LSH forest, against all pairs."""

import random

import pytest

from tidemark.llm import neardup


def shingle_set(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split(" ")
    words = [w for w in words if w]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return {(d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows)}


def got(df):
    return {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df).collect()}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**9)}"
    return out


def test_components_match_all_pairs(documents):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, i = [], 0
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(rng.choice([1, 2, 6])):
            rows.append((i, " ".join(edited(rng, base, rng.randrange(len(base) // 20 + 1)))))
            i += 1
    rows += [(i + k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60)))) for k in range(200)]
    rng.shuffle(rows)
    assert got(documents(rows)) == brute(rows)


def test_a_large_group_of_near_copies_with_strays(documents):
    """Edits of one text: most are linked through others, the heavily edited ones are strays."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(140)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([1, 2, 3, 5, 8])))) for i in range(400)]
    assert got(documents(rows)) == brute(rows)


def test_short_empty_null_and_long_texts(documents):
    long = " ".join(f"u{i}" for i in range(30_000))
    rows = [(1, None), (2, None), (3, ""), (4, " \t\n"), (5, "one two"), (6, "ONE  two"), (7, "two one"), (8, "a b c d e"), (9, "A b\tc d e "),
            (10, long), (11, long + " tail"), (12, "É x"), (13, "é x")]
    out = {r["doc_id"]: r for r in neardup.near_duplicates(documents(rows)).collect()}
    assert {k: out[k]["component_id"] for k in out} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 8, 10: 10, 11: 10, 12: 12, 13: 13}
    assert all(out[k]["n_shingles"] == 0 and out[k]["kept"] for k in (1, 2, 3, 4))
    assert [out[k]["kept"] for k in (5, 6, 8, 9, 10, 11)] == [True, False, True, False, True, False]


def test_repeated_rows_null_ids_and_no_rows(documents):
    out = neardup.near_duplicates(documents([(5, "a b c d e f")] * 3 + [(None, "a b c d e f"), (None, "q r s t u v")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in out) == [(-1, -1, False), (-1, 5, False)] + [(5, 5, True)] * 3
    assert neardup.near_duplicates(documents([])).collect() == []


def test_one_document_of_each_group_stays(documents):
    rows = [(5, "a b c d e f")] * 3 + [(6, "a b c d e f"), (7, "x y"), (8, None), (8, None), (9, "")]
    docs = documents(rows)
    out = neardup.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [5, 7, 8, 8, 9]


def test_one_document_of_each_group_stays_with_null_and_repeated_ids(documents):
    base = {k: [f"{k}{i}" for i in range(100)] for k in "abcd"}
    near = lambda k, *tail: " ".join([*base[k], *tail])
    rows = [(None, near("a", "x")), (None, near("a", "y")), (None, near("a", "y")),  # null ids alone
            (3, near("b")), (None, near("b", "x")), (None, near("b")),  # near and exact copies of a document with an id
            (5, near("c", "x")), (5, near("c", "y")), (5, near("c", "y")), (6, near("c")),  # one id, two texts
            (None, near("d")), (None, None), (None, None), (7, "")]
    docs = documents(rows)
    left = [(r["doc_id"], (r["text"] or "-")[0]) for r in neardup.drop_near_duplicates(docs).collect()]
    assert sorted(left, key=str) == sorted([(None, "a"), (3, "b"), (5, "c"), (None, "d"), (None, "-"), (None, "-"), (7, "-")], key=str)
    found = neardup.near_duplicates(docs).where("n_shingles > 0").select("doc_id", "digest", "component_id", "kept", "stays").distinct().collect()
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"]) for r in found)
    assert sorted(r["doc_id"] for r in found if r["stays"] and r["doc_id"]) == [3, 5]


def test_near_copies_under_one_id_are_both_kept_rows(documents):
    """``kept`` compares ids alone; ``stays`` names the one survivor."""
    base = " ".join(f"w{i}" for i in range(100))
    out = neardup.near_duplicates(documents([(1, base + " x"), (1, base + " y")])).collect()
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in out] == [(1, 1, True)] * 2 and sum(r["stays"] for r in out) == 1


def test_columns_of_any_name_come_back(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words stand in this one")], "doc_id long, text string")
    names = ["_digest", "_id", "_rows", "_n", "_kept", "_own", "_doc", "digest", "a.b"]
    for name in names:
        df = df.withColumn(name, F.lit("mine"))
    left = neardup.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(tuple(r) for r in left.collect()) == [(i, t, *["mine"] * len(names)) for i, t in [(1, "a b c d e f g"), (3, "other words stand in this one")]]


def test_seams_between_sorted_partitions(spark):
    """The last row of a task and the first of the next are neighbours too."""
    import pandas as pd
    one = pd.concat(neardup._neighbours(iter([pd.DataFrame({"region": [1, 1], "deep": [0, 0], "cid": [1, 2]})])))
    two = pd.concat(neardup._neighbours(iter([pd.DataFrame({"region": [1, 2], "deep": [0, 0], "cid": [3, 4]})])))
    ends = pd.concat([one, two])
    assert sorted(ends[ends["b"].isna()]["a"]) == [1, 2, 3, 4]


@pytest.mark.parametrize("n", [2, 24])
def test_components_of_chains(spark, n):
    from tidemark.llm.components import connected_components, merged
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(500, 500), (700, 701)], "a long, b long")
    out = dict(map(tuple, connected_components(edges).collect()))
    assert out == {i: 0 for i in range(n + 1)} | {700: 700, 701: 700}
    more = merged(merged(None, edges), spark.createDataFrame([(n, 700), (900, 901)], "a long, b long"))
    assert dict(map(tuple, more.collect())) == {i: 0 for i in range(n + 1)} | {700: 0, 701: 0, 900: 900, 901: 900}
