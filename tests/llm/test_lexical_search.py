"""Ranked lexical search against scoring every document: ties, copies, nulls, long texts, many masks, several passes and chunks."""

import random

import brute
import numpy as np
import pytest

from tagloom.llm import lexical_search as LS
from tagloom.llm.common import release_scratch
from tagloom.session import release_stored

DOCS, ITEMS = "doc_id bigint, text string, score string, n string, terms string", "item_id bigint, text string, rank string, _row string"


@pytest.fixture(autouse=True)
def scratch(spark):
    yield
    release_scratch(spark)
    release_stored(spark)


def check(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, "s", "n", "t") for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(i, t, "r", "w") for i, t in items], ITEMS)
    got = LS.lexical_search(d, q, **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute.ranked(docs, items, more.get("k", 20)), key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    words = ["the", "of", "Boat", "harbour", "née", "日本", "x1", "42", "wind", "sea-side", "a_b", "É", "éa", "rare", "grey", "Ünder"]
    weights = [30, 20, 9, 7, 5, 5, 4, 4, 3, 3, 2, 2, 2, 1, 1, 1]

    def text(k):
        return "".join(w + rnd.choice([" ", ", ", "\n", "!", "_", "\x7f"]) for w in rnd.choices(words, weights, k=k))

    docs = [(i, text(rnd.randrange(1, 60))) for i in range(n)]
    docs += [(1000 + i, docs[3][1]) for i in range(45)] + [(5, docs[3][1]), (None, docs[4][1]), (None, None), (7, ""), (8, " \n!")]
    items = [(i, text(rnd.randrange(1, 25))) for i in range(12)] + [(3, "boat"), (3, "boat boat"), (None, "rare wind"), (50, None), (51, "?"), (52, "unheard of")]
    return docs, items


def test_every_rank_and_score(spark):
    check(spark, *corpus(1, 300))


def test_small_chunks_and_many_passes(spark):
    docs, items = corpus(2, 400)
    check(spark, docs, items, cells=1, terms_per_pass=40)


def test_items_of_more_terms_than_a_mask_word(spark):
    rnd = random.Random(3)
    docs = [(i, " ".join(f"w{rnd.randrange(150)}" for _ in range(rnd.randrange(40)))) for i in range(500)]
    check(spark, docs, [(0, " ".join(f"w{i}" for i in range(150))), (1, " ".join(f"w{i % 70}" for i in range(90)))], k=7)


def test_large_group_of_copies_and_hot_term(spark):
    docs = [(i, "hot term here") for i in range(900)] + [(5000 + i, "hot other thing " * (1 + i % 4)) for i in range(300)]
    check(spark, docs, [(1, "hot"), (2, "term other"), (3, "here")])


def test_empty_tables(spark):
    check(spark, [], [(1, "word")])
    check(spark, [(1, "word")], [])


def test_long_texts_are_cut_between_terms(monkeypatch):
    rnd = random.Random(4)
    text = "".join(rnd.choice(["ab", "é", " ", "!", "long" * 30, "Z9"]) for _ in range(3000))
    want = brute.Counter(brute.TERM.findall(brute.low(text)))
    vocabulary = {t.encode(): i for i, t in enumerate(sorted(want))}
    monkeypatch.setattr(LS, "PIECE", 64)
    n, counts = LS.term_counts(text.encode(), vocabulary)
    assert n == sum(want.values()) and {t: counts[i] for t, i in vocabulary.items()} == {t.encode(): c for t, c in want.items()}
    assert LS.term_counts(None, vocabulary) == (0, {})


def test_masks_group_equal_presence_and_bound_every_score():
    rng = np.random.default_rng(5)
    for terms_asked in (5, 64, 90):
        present = rng.random((200, terms_asked)) < 0.1
        tfs = rng.integers(1, 9, present.sum())
        starts = np.concatenate([[0], np.cumsum(present.sum(axis=1))])
        chunk = LS.Chunk(np.full(200, 30), starts, np.nonzero(present)[1], tfs, terms_asked, 200, 6000)
        terms, weights = np.arange(terms_asked), rng.integers(0, 5000, terms_asked)
        docs, groups, most = chunk.masks(terms, weights)
        assert sorted(docs) == list(range(200)) and (np.diff(most) <= 0).all()
        for a, b, bound in zip(groups, groups[1:], most):
            assert len({present[d].tobytes() for d in docs[a:b]}) == 1
            assert (chunk.scores(terms, weights, docs[a:b]) <= bound).all()
        assert len(most) == len({p.tobytes() for p in present})
