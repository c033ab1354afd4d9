"""Spelling variants against plain Python: counts, near words, forms and roots."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from gapscan.llm import spelling as S


def brute_counts(docs, every=31, least=7):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if every and h % every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= 2}


def brute_variants(counts, ratio=10):
    """Words that agree with one place open are one replacement apart, a word
    and its deletions are one insertion apart."""
    near = defaultdict(set)
    open_ = defaultdict(list)
    for w in counts:
        for i in range(len(w)):
            open_[w[:i], w[i + 1:]].append(w)
            shorter = w[:i] + w[i + 1:]
            if shorter in counts:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in open_.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    rows = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return rows


def rows_of(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_edge_documents(spark, edge_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert {r.word: r.n for r in S.word_counts(edge_docs, every=31).collect()} == brute_counts(docs)
    odd = [(1, "ÀÉÎÕÜÿx ×÷ABCDEF" * 2), (None, "ÉCOLIÈRE écolière ecolière"), (3, "ÉCOLIÈRE " * 3 + "a" * 70_000 + " " + "a" * 70_000),
           (4, "a" * 69_999 + " " + "a" * 69_999), (5, None), (6, "")]
    frame = spark.createDataFrame(odd, "doc_id long, text string")
    counts = brute_counts(odd, every=None)
    assert {r.word: r.n for r in S.word_counts(frame).collect()} == counts
    assert rows_of(S.variants(S.word_counts(frame))) == brute_variants(counts)
    assert S.variants(S.word_counts(frame.limit(0))).count() == 0


@pytest.mark.parametrize("hot", [3, 256])
def test_near_words_of_random_words(spark, hot):
    """Few letters make many near words, repeated letters and hot chunks."""
    rnd = random.Random(hot)
    counts = {}
    for _ in range(1500):
        word = "".join(rnd.choice("abç") for _ in range(rnd.choice([7, 7, 8, 9, 12])))
        counts[word] = rnd.choice([2, 2, 3, 20, 21, 200, 2500])
    for word in list(counts)[:300]:     # planted variants of every kind
        at = rnd.randrange(len(word) + 1)
        counts.setdefault(word[:at] + "é" + word[at:], 2)
        counts.setdefault(word[:at] + "é" + word[at + 1:], 2)
    counts = {w: n for w, n in counts.items() if len(w) >= 7}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(S.variants(frame, hot=hot)) == brute_variants(counts)


def test_long_chains_of_forms(spark):
    words = ["abcdefg" + "z" * k for k in range(18)]
    counts = {w: 2 * 10 ** k for k, w in enumerate(words)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = rows_of(S.variants(frame))
    assert got == brute_variants(counts) and {r[2] for r in got} == {words[-1]}


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    expected = brute_variants(brute_counts(docs))
    assert any(r[1] for r in expected) and rows_of(S.op11_spelling(spark, path)) == expected
