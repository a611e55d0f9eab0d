"""Queries scored together: frequent terms by matrix, the others by posting, the same rows as one document at a time."""

import random

import numpy as np
import pytest

from claimlake.llm import search

MEAN = 30.0


def _index(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    return search.build_index(df).first().asDict()


@pytest.mark.parametrize("share,most", [(32, 1024), (1, 1024), (32, 0)])
def test_groups_of_queries_are_exact(spark, monkeypatch, share, most):
    monkeypatch.setattr(search, "GROUP", 3)
    monkeypatch.setattr(search, "SCORED", 2)
    monkeypatch.setattr(search, "DENSE_SHARE", share)
    monkeypatch.setattr(search, "DENSE_TERMS", most)
    r = random.Random(4)
    word = lambda: f"w{int(r.paretovariate(0.6)) % 500}"  # noqa: E731 - few frequent words, many rare ones
    texts = [" ".join(word() for _ in range(r.randint(1, 60))) for _ in range(290)]
    texts += texts[:25] + ["same text"] * 15  # ties are broken by id
    index = _index(spark, texts)
    terms, weights = [], []
    for text in [*texts[:10], "same text", "none_has_this", "w1"]:
        h = np.unique(np.array([search.xxhash.xxh3_64_intdigest(t) for t in text.split()], np.uint64))
        terms.append(h)
        weights.append(np.array([0.5 + x % 7 for x in h.tolist()]))
    tops = [search.Top(7) for _ in terms]
    search.run_queries(search.Shard(index, MEAN), search.Queries(terms, weights), tops)
    for h, w, top in zip(terms, weights, tops, strict=True):
        weight, want = dict(zip(h.tolist(), w.tolist(), strict=True)), []
        for i, text in enumerate(texts):
            words = [search.xxhash.xxh3_64_intdigest(t) for t in text.split()]
            score = sum(weight[t] * words.count(t) * (search.K1 + 1) / (words.count(t) + search.K1 * (1 - search.B + search.B * len(words) / MEAN))
                        for t in sorted(set(words)) if t in weight)
            if score > 0:
                want.append((-score, i))
        want = sorted((round(s, 9), i) for s, i in want)[:7]
        assert [(round(-s, 9), i) for s, i in top.rows] == want


def test_a_block_is_skipped_when_its_rare_terms_are_in_different_documents(spark):
    texts = [" ".join(["a b"] * 24 + ["x y" if i < 10 else "x a" if i % 64 == 20 else "a y" if i % 64 == 40 else "a b"]) for i in range(1280)]
    shard, top = search.Shard(_index(spark, texts), 50.0), search.Top(5)
    h = np.unique(np.array([search.xxhash.xxh3_64_intdigest(t) for t in ("x", "y")], np.uint64))
    assert search.run_query(shard, h, np.array([3.0, 3.0]), top) <= 2 < shard.blocks
    assert [i for _, i in top.rows] == [0, 1, 2, 3, 4]


def test_groups_hold_queries_alike_and_a_bounded_number_of_terms(monkeypatch):
    monkeypatch.setattr(search, "GROUP", 4)
    monkeypatch.setattr(search, "GROUP_TERMS", 10)
    terms = [np.array([1 + i % 2, 10 + i, 20 + i], np.uint64) for i in range(6)] + [np.arange(40, 60, dtype=np.uint64)]
    weights = [np.array([0.1, 5.0, 5.0])] * 6 + [np.full(20, 5.0)]
    asked = search.Queries(terms, weights)
    assert len(asked) == 7 and sorted(i for g in asked.groups for i in g[0]) == list(range(7))
    for group, row, number, weight in asked.groups:
        assert len(group) == 1 or len(weight) <= 10
        assert len({i % 2 for i in group}) == 1
        for at, i in enumerate(group):
            assert asked.terms[number[row == at]].tolist() == terms[i].tolist() and weight[row == at].tolist() == weights[i].tolist()
