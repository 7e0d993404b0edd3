"""Suffix deduplication at two lengths at once: the long one's columns stay, the short one's are as exact."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_documents import brute_repeats, by_id

from ledgerflow.llm import queries, suffix_dedup

SHAPE = dict(length=30, window=12, kmer=6, shorter=18)


def texts_of(seed):
    r = random.Random(seed)
    passages = ["".join(r.choice("abcdé ") for _ in range(r.randint(12, 70))) for _ in range(8)]
    texts = ["".join(r.choice(passages)[r.randint(0, 20):] if r.random() < .5 else "".join(r.choice("abcdé ") for _ in range(r.randint(1, 40)))
                     for _ in range(r.randint(0, 6))) for _ in range(40)]
    # passages between the lengths, at the ends of texts, whose contexts are cut short; copies; one text's own repeats
    texts += [texts[1] + "mno" * 9 + p[:n] for n in (18, 24, 29, 30, 31) for p in passages[:3] if len(p) >= n]
    return texts + [None, "", "a" * 17, "a" * 90, "ab" * 40, "abc" * 6, texts[0], texts[1], texts[1], passages[0][:24]]


@pytest.mark.parametrize("hot", [20_000, 2])
def test_both_lengths_as_by_hand(spark, hot):
    texts = texts_of(4)
    df = spark.createDataFrame([(i if i % 9 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, length string")
    got = suffix_dedup.dedup(df, with_text=True, shape=suffix_dedup.Shape(**SHAPE), hot_core=hot).collect()
    ids = [i if i % 9 else None for i in range(len(texts))]
    want = [(i, *x, *y[1:3]) for i, x, y in zip(ids, brute_repeats(texts, 30), brute_repeats(texts, 18), strict=True)]
    assert by_id((g.doc_id, g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256, g.passage_removed, g.passage_spans) for g in got) == by_id(want)
    assert any(x[2] < x[5] and x[2] for x in want) and any(not x[2] and x[5] for x in want)
    # the texts are those of either length alone
    for n, column in ((30, "text"), (18, "text_without_passages")):
        alone = suffix_dedup.dedup(df, with_text=True, shape=suffix_dedup.Shape(n, 12, 6), hot_core=hot).collect()
        assert by_id((g.doc_id, g[column]) for g in got) == by_id((g.doc_id, g.text) for g in alone)


def test_places_and_contexts_across_segments(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 64)
    shape = suffix_dedup.Shape(**SHAPE)
    for size in (*range(17, 33), 64 + 17, 64 + 18, 64 + 29, 64 + 30, 300):
        text = bytes(random.Random(size).choices(b"abc", k=size))
        places = []
        for group in suffix_dedup.segments([text], shape.least, shape.length):
            x = suffix_dedup.anchors(group, shape)
            assert (x["end"] == np.minimum(x["hi"] + 30, size)).all()
            places += [p for lo, hi in zip(x["lo"], x["hi"], strict=True) for p in range(lo, hi + 1)]
        assert sorted(places) == list(range(size - 17))


def test_lengths_in_order():
    for wrong in (30, 31):
        with pytest.raises(ValueError):
            suffix_dedup.Shape(30, 12, 6, shorter=wrong)
    with pytest.raises(ValueError):
        suffix_dedup.Shape(30, 14, 6, shorter=18)


def test_query_shows_passages_under_400_bytes(spark, tmp_dir):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, long = " ".join(word() for _ in range(53)), prose(120)
    assert 300 < len(passage) < 400 < len(long)
    texts = [f"{prose(80)} {passage} {prose(60)}", f"{passage} {prose(90)}", prose(100), f"{prose(30)} {long}", f"{long} {prose(9)}", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit("x") for c in ("lang", "source")})
    df.withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_dir}/documents.parquet")
    got = sorted(queries.op5_suffix_dedup(spark, tmp_dir).collect())
    assert [(g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got] == list(brute_repeats(texts, 400))
    assert [(g.passage_removed, g.passage_spans) for g in got] == [x[1:3] for x in brute_repeats(texts, 250)]
    assert passage in got[0].text and passage in got[1].text
    assert not any(passage[10:-10] in (g.text_without_passages or "") or long[10:-10] in (g.text or "") for g in got)
    assert got[2].text_without_passages == texts[2] and got[5].text_without_passages is None
