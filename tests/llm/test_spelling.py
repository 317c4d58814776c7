"""Spelling variants against brute force over deletions, and the words of whole texts against Python's own."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm import queries, spelling

LETTERS = "abcdefghijklmnopqrstuvwxyzàéüßÿ"


def near_words(words):
    """Words one letter apart, found where both are equal after a deletion at one place."""
    by_rest = defaultdict(set)
    for w in words:
        for rest in {(i, w[:i] + w[i + 1 :]) for i in range(len(w))}:
            by_rest[rest].add(w)
    near = defaultdict(set)
    for same in by_rest.values():
        for w in same:
            near[w] |= same - {w}
    known = set(words)
    for w in words:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            if rest in known:
                near[w].add(rest)
                near[rest].add(w)
    return near


def brute(counts):
    near, form = near_words(counts), {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    rows = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] is not None else None)
    return rows


def found(spark, counts, most, extra=()):
    words = spark.createDataFrame([*counts.items(), *extra], "word string, n long").repartition(3)
    out = spelling.grouped(words, most)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = {r.word: tuple(r)[1:] for r in out.collect()}
    assert len(rows) == out.count()
    return rows


def variants(seed, roots, per_root):
    """Words of few letters and many that differ by one letter, with counts that make chains."""
    rng = random.Random(seed)
    words = {}
    for _ in range(roots):
        w = "".join(rng.choices(LETTERS[:6], k=rng.randint(6, 9)))
        n = 5 ** rng.randint(1, 6)
        for _ in range(per_root):
            words.setdefault(w, max(1, n))
            i, kind = rng.randrange(len(w)), rng.randrange(3)
            w = w[:i] + (rng.choice(LETTERS) if kind else "") + w[i + (kind != 1) :]
            n = max(1, n // rng.choice([1, 5, 6]))
    return {w: n for w, n in words.items() if w}


@pytest.mark.parametrize("most", [spelling.CELL, 40, 1])
def test_groups_as_by_brute_force(spark, most):
    counts = variants(5, 40, 12)
    assert found(spark, counts, most) == brute(counts)


def test_long_equal_null_and_repeated_words(spark):
    long_ = "ab" * 30_000
    counts = {long_: 100, long_[1:]: 10, long_ + "c": 9, "aaaaaa": 50, "aaaaaaa": 5, "aaaaaaaa": 1, "zzz": 7}
    rows = found(spark, counts, spelling.CELL, [(None, 5), ("aaaaaa", None), ("zzz", 3)])
    assert rows == brute({**counts, "zzz": 10})
    assert rows["aaaaaaaa"][:2] == ("aaaaaaa", "aaaaaa")
    assert found(spark, {}, spelling.CELL) == {}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abé"), min_size=1, max_size=6), min_size=2, max_size=30, unique=True))
def test_pairs_of_any_words(words):
    spelt = spelling.Spelt(words)
    vectors = spelt.vectors(spelling.letter_groups(np.bincount(spelt.letters, minlength=256)))
    i, j = spelling.near_in_cell(spelt, vectors, np.ones(len(words), bool))
    pairs = [tuple(sorted((words[a], words[b]))) for a, b in zip(i, j)]
    near = near_words(words)
    assert sorted(pairs) == sorted({tuple(sorted((w, x))) for w in words for x in near[w]})


def test_words_that_all_fall_into_one_vector(spark):
    rng = random.Random(2)
    counts = {"".join(rng.sample("abcdefgh", 8)): rng.randint(1, 500) for _ in range(400)}
    counts |= {w[:-1]: 7 for w in list(counts)[:50]}
    assert found(spark, counts, 30) == brute(counts)


def test_query_as_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    counts = Counter()
    for doc_id, text in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    rows = {r.word: tuple(r)[1:] for r in queries.op12_spelling_variants(spark, sf).collect()}
    assert rows == brute(counts)
    assert any(form is not None for form, *_ in rows.values())


def test_runs_of_odd_texts(spark):
    texts = [(1, None), (None, "ABC déf×÷ÿ ĀbÀ"), (2, ""), (2, "1 2 3"), (3, "x" * 100_000 + "ＡＢ Zz")]
    rows = spelling.runs(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.run[:9]) for r in rows) == [(0, "abc"), (0, "bÀ"), (0, "déf×÷ÿ"), (3, "x" * 9), (3, "zz")]
