"""Texts of templates in the n-gram join: every link is counted, by whichever blocks; texts that can't link aren't compared."""

import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_llm import brute_set

from foliomill.llm import ngram_join


def plain(texts, width, num, den):
    """component and number of links (between different sets) of each text, by all pairs."""
    sets = [frozenset(brute_set(t, width)) for t in texts]
    first, postings = {}, defaultdict(set)
    for i, s in enumerate(sets):
        first.setdefault(s, i)
    for s, i in first.items():
        for x in s:
            postings[x].add(i)
    parent, links = list(range(len(texts))), [0] * len(texts)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for s, i in first.items():
        for j in {j for x in s for j in postings[x] if j > i}:
            both = len(s & sets[j])
            if both * den >= len(s | sets[j]) * num:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(find(first[s]) if s else i, links[first[s]] if s else 0) for i, s in enumerate(sets)]


def templates(rnd, slots, words, count, length=60):
    """Texts of one template: some of its words are drawn from a few."""
    base = [f"w{i}" for i in range(length)]
    at = sorted(rnd.sample(range(length), slots))
    out = []
    for _ in range(count):
        text = list(base)
        for s in at:
            text[s] = f"x{s}_{rnd.randrange(words)}"
        out.append(" ".join(text[: rnd.choice([length, length, length - 1, length - 7])]))
    return out


@pytest.mark.parametrize("apart", [False, True])
def test_links_of_templates(spark, monkeypatch, apart):
    """With ``apart`` blocks are small, so clusters count as large and fall into their elements where that is less."""
    rnd = random.Random(9)
    texts = templates(rnd, 3, 6, 150) + templates(rnd, 2, 40, 150) + templates(rnd, 5, 30, 200, 90) + templates(rnd, 1, 99, 120, 12)
    texts += ["", "w1", " ".join(f"u{i}" for i in range(40))]
    if apart:
        monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 12)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for width, num, den in ((5, 4, 5), (3, 90, 100)):
        got = {r.doc_id: (r.component_id, r.links) for r in ngram_join.near_duplicates(docs, width, num, den).collect()}
        assert [got[i] for i in range(len(texts))] == plain(texts, width, num, den)


def test_clusters_fall_into_elements(spark, monkeypatch):
    """A chain of small groups that share an element each is one cluster; its blocks are those of the elements."""
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 12)
    rows = [(e, i, 100, 5, 0, i) for e in range(60) for i in range(20 * e, 20 * e + 25)]  # neighbouring groups share five documents
    placed = spark.createDataFrame(rows, "element long, id long, n long, m int, p long, at long")
    members = placed.select(F.lit(0).cast("long").alias("cluster"), "id", "n", "at").distinct()
    split = ngram_join._by_element(members, placed, 4, 5).collect()
    assert len({r.element for r in split}) == 60 and None not in {r.element for r in split}
    assert all(r.element in r.lives and len(r.lives) <= 2 for r in split)


def test_unlinked_template_texts_take_linear_time(spark):
    """One word at the start differs: the next elements are common to all, but none can be the first that linked sets share."""
    def took(n):
        docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("x"), "id", F.lit(" " + " ".join(f"w{i}" for i in range(11)))).alias("text"))
        start = time.time()
        found = ngram_join.near_duplicates(docs.repartition(4), 5, 4, 5).agg(F.sum("links"), F.countDistinct("component_id")).first()
        assert tuple(found) == (0, n)
        return time.time() - start

    took(100)
    assert took(100_000) < 4 * took(20_000) + 20


def test_block_counting_against_sets():
    """Products and pairs of columns together count what sets share, in one block and between two."""
    import numpy as np

    rng = np.random.default_rng(7)
    for split in (0, 13, 30):
        sets = [np.unique(np.concatenate([rng.integers(0, 30, rng.integers(0, 20)), rng.integers(0, 4000, rng.integers(0, 90))])) for _ in range(60)]
        lives = [x[:5] for x in sets]
        shared = ngram_join._shared(*ngram_join._columns(sets, split), split or 60, split, 60)
        for i in range(split or 60):
            for j in range(split, 60):
                if split or i != j:
                    assert shared[i, j - split] == len(np.intersect1d(sets[i], sets[j]))
        links, degrees = ngram_join._links_between(list(range(60)), list(range(60)), sets, split, 1, 9, lives, 15)
        want = [0] * 60
        for i in range(split or 60):
            for j in range(split or i + 1, 60):
                both = len(np.intersect1d(sets[i], sets[j]))
                met = np.intersect1d(lives[i], lives[j])
                if 9 * both >= len(sets[i]) + len(sets[j]) - both and not (met < 15).any():
                    want[i] += 1
                    want[j] += 1
        assert degrees.tolist() == want
