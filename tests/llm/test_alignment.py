"""Alignment of two tokenisations against a plain walk along both."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import alignment as A


@pytest.fixture(scope="module")
def tokenizers():
    return tuple(kind(A._read(f"{A.TOKENIZER_FOLDER}/{name}")) for kind, name in ((A.BytePieces, A.TOKENIZER_A), (A.SentencePieces, A.TOKENIZER_B)))


def plain(text, a, b):
    """(n_a, n_b, groups as text, links) by walking along both."""
    if not text:
        return 0, 0, "", []
    ids_a = a.tokenizer.encode(" " + text, add_special_tokens=False).ids
    ids_b = b.processor.encode(text, out_type=int)
    want = b" " + text.encode()
    if b"".join(a.bytes[i] for i in ids_a) != want or b"".join(b.bytes[i] for i in ids_b) != want:
        return 0, 0, "", []
    ends = []
    for ids, t in ((ids_a, a), (ids_b, b)):
        ends.append(np.cumsum([len(t.bytes[i]) for i in ids]).tolist())
    groups, links, own, i, j = [], [], ([], []), 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        own = ([], [])
        while i < len(ids_a) and ends[0][i] <= cut:
            own[0].append(ids_a[i])
            i += 1
        while j < len(ids_b) and ends[1][j] <= cut:
            own[1].append(ids_b[j])
            j += 1
        groups.append("|".join(",".join(map(str, o)) for o in own))
        links.append((own[0][-1], own[1][-1]))
    return len(ids_a), len(ids_b), ";".join(groups), links


def expected(rows, a, b):
    made = [(i, *plain(t, a, b)) for i, t in rows]
    counts = Counter(link for m in made for link in m[4])
    top = defaultdict(int)
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return sorted(((i if i is not None else -1), na, nb, len(links), len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
                   hashlib.sha256(g.encode()).hexdigest() if links else "") for i, na, nb, g, links in made)


TEXTS = ["A plain sentence, with words.", "A plain sentence, with words.", None, "", " ", "  two  blanks ", "line\nbreak\ttab\r\n", "日本語のテキストです。", "naïve café 😀!",
         "<|endoftext|> and <s></s><unk> are text", "x" * 3000, "\x00null", "ﬁ ½ ² 　 wide", "▁ mark", "word " * 400, "don't we'll I'd 12 345"]


def run(docs, **kw):
    got = A.align_tokenizers(docs, **kw).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    return sorted(((r.doc_id if r.doc_id is not None else -1), *tuple(r)[1:]) for r in got)


def test_against_a_plain_walk_by_broadcast_and_by_shuffle(documents, tokenizers):
    rows = list(enumerate(TEXTS)) + [(None, "A plain sentence, with words."), (3, "again"), (3, "again")]
    want = expected(rows, *tokenizers)
    assert run(documents(rows)) == want
    assert run(documents(rows), broadcast_pairs=0) == want


def test_rare_and_hot_pairs_by_shuffle(documents, tokenizers, monkeypatch):
    monkeypatch.setattr(A, "HOT_SHARE", 20)
    rows = [(k, f"the the the word{k % 7} and {k}") for k in range(40)]
    assert run(documents(rows), broadcast_pairs=0) == expected(rows, *tokenizers)


def test_empty_table_and_table_without_tokens(documents):
    assert run(documents([])) == []
    zero = [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert run(documents([(1, None), (2, "")])) == run(documents([(1, None), (2, "")]), broadcast_pairs=0) == zero


def test_the_session_setting_comes_back(spark, documents):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    run(documents([(1, "a")]))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t'sdABé日0▁ 　\x85\x1c"), st.characters(exclude_categories=["Cs"])), max_size=30))
def test_any_text_is_encoded_as_the_files_say(tokenizers, text):
    a, b = tokenizers
    assert a.encode([text]) == [a.tokenizer.encode(" " + text, add_special_tokens=False).ids]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=12), min_size=1, max_size=4), st.randoms())
def test_cuts_are_all_shared_ends(sizes, random):
    ends_a, ends_b, bounds, at = [], [], [0], 0
    for text in sizes:
        n = sum(text)
        ends_a += (at + np.cumsum(text)).tolist()
        ends_b += sorted({at + n, *random.sample(range(at + 1, at + n + 1), random.randint(0, n))})
        at += n
        bounds.append(at)
    cuts = A.shared_cuts(np.array(ends_a), np.array(ends_b), np.array(bounds))
    assert cuts.tolist() == sorted(set(ends_a) & set(ends_b))
