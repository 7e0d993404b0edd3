"""Sorted ranges of suffix deduplication: frequent heads, texts across segments, clashing columns."""
import random

import numpy as np
from test_documents import brute_repeats

from ledgerflow.llm import suffix_dedup


def deduplicated(spark, texts, shape):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, block int, n_removed string")
    return sorted((g.doc_id, g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in suffix_dedup.dedup(df, shape=shape).collect())


def test_ranges_keep_cores_together():
    r = np.random.default_rng(1)
    heads = r.integers(0, 6, 500)
    cores = heads * 1000 + r.integers(-3, 3, 500)
    borders = np.array([1, 3, 3, 3, 4], np.int64)
    found = suffix_dedup.ranges_of(heads, cores, borders)
    assert all(len(set(found[cores == c])) == 1 for c in set(cores))
    assert len(set(found[heads == 3])) == 3 and found.max() <= len(borders)
    assert all(found[heads == h].min() > found[heads == h - 2].max() for h in (2, 4, 5))


def test_a_frequent_head_in_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGE_BYTES", 300)
    r = random.Random(3)
    tails = ["".join(r.choice("abcdé ") for _ in range(60)) for _ in range(12)]
    texts = ["same head" + r.choice(tails)[r.randint(0, 3):] + "".join(r.choice("xyz") for _ in range(20)) for _ in range(60)]
    texts += ["same head" * 30, "a" * 200, None, ""]
    assert deduplicated(spark, texts, suffix_dedup.Shape(30, 16, 6)) == sorted((i, *x) for i, x in enumerate(brute_repeats(texts, 30)))


def test_texts_across_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 64)      # the cut into segments is the workers': here for its own sake
    shape = suffix_dedup.Shape(30, 16, 6)
    text = bytes(random.Random(5).choices(b"abc", k=500))
    pieces = [p for g in suffix_dedup.segments([text], shape.length) for p in g]
    assert len(pieces) > 5 and {text[a:a + 30] for a in range(471)} == {p[i:i + 30] for _, _, p in pieces for i in range(len(p) - 29)}
    starts = [a + i for _, a, p in pieces for i in range(len(p) - 29)]
    assert sorted(starts) == list(range(471))             # every place once
