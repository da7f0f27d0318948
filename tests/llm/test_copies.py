import random

import brute
import numpy as np
import pytest

from wardline.llm import ngram_join, substring_dedup
from wardline.llm.components import components
from wardline.llm.skew import semi_join

SCHEMA = "doc_id bigint, text string"


def ids(rows, *names):
    return sorted((tuple(r[n] for n in names) for r in rows), key=str)


def mixed_docs(seed, n=60):
    """Prose with copies, near copies, chains of near copies, shared passages and repeats within a text."""
    draw = random.Random(seed)
    common = [f"w{i}" for i in range(40)]
    prose = lambda k: [draw.choice(common) if draw.random() < 0.3 else f"u{draw.randrange(10**6)}" for _ in range(k)]
    passage = prose(50)
    texts = [prose(draw.randrange(1, 200)) for _ in range(n)]
    for k in range(0, n, 4):
        texts[k] = texts[k] + passage
    base = prose(120)
    for _ in range(25):
        near = list(base)
        for _ in range(draw.randrange(0, 5)):
            near[draw.randrange(len(near))] = f"e{draw.randrange(10**6)}"
        texts.append(near)
    chain = prose(90)
    for k in range(12):
        chain = chain[4:] + prose(4)
        texts.append(chain)
    texts += [texts[1], texts[1], prose(40) * 3, ["a"], ["a"], ["a", "b"], []]
    return [(i * 7 + 1, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_equal_brute_force(spark, seed):
    docs = mixed_docs(seed)
    got = substring_dedup.dedup_digests(spark.createDataFrame(docs, SCHEMA))
    assert ids(got.collect(), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.passages(docs), key=str)


def test_passages_of_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = substring_dedup.dedup(odd_docs, width=5)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"] and got.count() == len(docs)
    digests = substring_dedup.dedup_digests(odd_docs, width=5)
    assert ids(digests.collect(), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.passages(docs, 5), key=str)
    assert substring_dedup.dedup(no_docs).count() == 0


def test_anchors_of_equal_windows_are_equal():
    draw = np.random.default_rng(3)
    values = draw.integers(0, 50, 3_000).astype(np.uint64)
    at = substring_dedup.leftmost_smallest(values, 24)
    assert at.tolist() == [i + int(values[i : i + 24].argmin()) for i in range(len(values) - 23)]
    assert (np.diff(at) >= 0).all()


def test_rolling_hash_is_one_of_the_window():
    codes = np.tile(np.arange(1, 40, dtype=np.uint64) ** np.uint64(9), 3)
    h = substring_dedup.rolling(codes, 35, substring_dedup._BASES[0])
    assert (h[:39] == h[39:78]).all() and len(set(h[:39].tolist())) == 39


@pytest.mark.parametrize("seed, frequent, pivots", [(1, 256, 4), (2, 3, 1), (3, 3, 4)])
def test_classes_equal_brute_force(spark, monkeypatch, seed, frequent, pivots):
    """A low bound of frequent tokens puts most of the index into pairs; one pivot needs several rounds."""
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "FIRST_PIVOTS", pivots)
    docs = mixed_docs(seed)
    got = ngram_join.classes(spark.createDataFrame(docs, SCHEMA))
    assert ids(got.collect(), "doc_id", "n_shingles", "component_id") == sorted(brute.classes(docs), key=str)


def test_classes_of_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert ids(ngram_join.classes(odd_docs).collect(), "doc_id", "n_shingles", "component_id") == sorted(brute.classes(docs), key=str)
    assert ngram_join.classes(no_docs).count() == 0


def test_one_of_each_class_stays(spark, odd_docs, no_docs):
    kept = ngram_join.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 2, 3, 5, 7, 8, None]
    docs = mixed_docs(4)
    kept = ngram_join.one_of_each(spark.createDataFrame(docs, SCHEMA))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, n, c in brute.classes(docs) if d == c)
    assert ngram_join.one_of_each(no_docs).count() == 0


def test_cells_of_linked_sizes_have_a_level_in_common():
    for n in range(1, 3_000):
        mine = {ngram_join.cells(m) for m in (ngram_join.shortest(n), n, 100 * n // 80)}
        assert all(ngram_join.cells(m) in mine for m in range(ngram_join.shortest(n), 100 * n // 80 + 1))


def test_components_equal_brute_force(spark):
    draw = random.Random(6)
    edges = [(draw.randint(-80, 80), draw.randint(-80, 80)) for _ in range(70)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5001 + i) for i in range(50)] + [(7, 7)]
    got = components(spark.createDataFrame([*edges, (None, 3)], "a bigint, b bigint"))
    assert {r.node: r.component for r in got.collect()} == brute.components(edges)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_semi_join_splits_hot_keys(spark):
    rows = spark.createDataFrame([(k % 7 if k % 3 else 0, k) for k in range(3_000)] + [(None, -1)], "k bigint, v bigint")
    counted = rows.groupBy("k").count().where("k IN (0, 2, 5)")
    got = semi_join(rows, counted, ["k"], "count")
    assert ids(got.collect(), "k", "v") == ids(rows.where("k IN (0, 2, 5)").collect(), "k", "v")


def test_many_near_copies_of_one_null_id(spark):
    """Sets are read again by their texts: 500 rows share one id, and each goes through Python once."""
    draw = random.Random(11)
    base = [f"w{draw.randrange(10**5)}" for _ in range(80)]
    docs = []
    for i in range(500):
        own = list(base)
        own[i % 3] = f"x{i}"
        docs.append((None, " ".join(own)))
    docs += [(7, " ".join(base)), (8, "another text of more than five words")]
    out = ngram_join.classes(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert sorted({(r.doc_id, r.component_id) for r in out}, key=str) == [(7, 7), (8, 8), (None, 7)] and len(out) == 502
