"""Every operator against a brute-force version or its library, with nulls, empty and long texts, ties and copies."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import (kn_quality, lang_id, line_rules, orc_tokens, sentencepiece_codec, simhash_gray, source_mix,
                            spot_signatures, suffix_dedup, token_counts)
from ledgerflow.llm.common import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, block string"


def docs(spark, seed=0, n=40):
    """Small documents with every odd case, and columns whose names the operators use themselves."""
    r = random.Random(seed)
    words = ["the", "of", "and", "Haus", "été", "naïve", "中文", "don't", "a", "x" * 70, "ok.", "<|endoftext|>"]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 30))), r.choice(["en", "de"]), r.choice(["s1", "s2", None]), 1, "n", "b")
            for i in range(n)]
    rows += [(100, None, None, None, None, None, None), (None, "the end of it.", "en", "s1", 3, "n", "b"), (None, "", "en", "s2", 0, "n", "b"),
             (5, rows[5][1], "en", "s1", 1, "n", "b"), (5, rows[5][1], "en", "s1", 1, "n", "b"), (7, "another\ttext \n\n of the  end ", "en", "s9", 1, "n", "b"),
             (101, "the cat and the dog " * 3000, "en", "s1", 1, "n", "b"), (102, "y" * 5000, "en", "s1", 1, "n", "b")]
    return spark.createDataFrame(rows, SCHEMA), rows


def by_id(rows):
    return sorted(rows, key=repr)


def test_token_counts(spark):
    from tokenizers import Tokenizer

    df, rows = docs(spark)
    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = by_id((i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x, *_ in rows)
    for chunk, overlap in ((32_768, 1_024), (50, 4)):
        got = token_counts.count_tokens(df, chunk_chars=chunk, overlap_chars=overlap).collect()
        assert by_id(tuple(r)[:3] for r in got) == want
    assert any(r.n_widened for r in got)


def test_line_rules(spark):
    df, rows = docs(spark)
    assert line_rules.clean_lines(df).count() == len(rows)
    r = random.Random(1)
    for _ in range(200):
        words = [r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(0, 20))]
        windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        assert line_rules.repeated_words(words) == len(hit)
    prose = "A line of clean prose with a few more words in it.\n" + "".join(f"Sentence {k} says one new thing about {k * 7} cats.\n" for k in range(12))
    assert line_rules.clean_text(prose)["kept"]
    menu = "".join(f"Home{k} | Shop{k} | News{k} | Jobs{k} | About{k}\n" for k in range(12))
    assert not line_rules.clean_text(prose + menu)["kept"]
    assert "Home1" not in line_rules.clean_text(prose + menu)["text"]


def test_spot_signatures(spark):
    df, rows = docs(spark)
    got = spot_signatures.compare_with_edited(df).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(got) == len(rows)
    unique = {r[0]: k for k, r in enumerate(order) if sum(x[0] == r[0] for x in order) == 1}
    for g in got:
        if g.doc_id in unique and sum(x[0] == order[(unique[g.doc_id] + 1) % len(order)][0] for x in order) == 1:
            own, nxt = order[unique[g.doc_id]][1] or "", order[(unique[g.doc_id] + 1) % len(order)][1] or ""
            half = len(own) // 2
            edited = own[:len(own) - half] + nxt[:half]
            assert g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert (g.near_edited == 1) == (g.fingerprint == g.edited_fingerprint)
    assert len({g.fingerprint for g in got if g.doc_id == 5}) == 1


def test_spot_copies(spark):
    """Many rows alike, with and without an id, come back each, followed by their like and the last one by the next key."""
    text = "the quick fox and the lazy dog in a small town"
    rows = [(7, text, "x")] * 400 + [(None, text, "y")] * 300 + [(None, None, "z")] * 2 + [(None, "", "z"), (7, "on the hill", "x"), (9, "", "x"), (3, text[5:], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, copies string").repartition(5)
    ties = {r.text: r.t for r in df.select("text", F.xxhash64("text").alias("t")).distinct().collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), ties[r[1]]))
    want = Counter()
    for (i, own, _), (_, following, _) in zip(order, order[1:] + order[:1], strict=True):
        own, following = own or "", following or ""
        half = len(own) // 2
        edited = own[:len(own) - half] + following[:half]
        want[i, len(own), hashlib.sha256(edited.encode()).hexdigest(), own == following] += 1
    got = spot_signatures.compare_with_edited(df).collect()
    assert Counter((g.doc_id, g.n_chars, g.edited_sha256, g.near_next == 1) for g in got) == want


def brute_signature(text):
    import re

    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    out = set()
    for i, w in enumerate(words):
        if w in spot_signatures.ANCHORS:
            chain = [x for x in words[i + 1:] if x not in spot_signatures.ANCHORS][:2]
            if chain:
                out.add((w, *chain))
    return out or {("", *words)}


def test_spot_pairs(spark):
    r = random.Random(2)
    texts = []
    for _ in range(12):
        base = [r.choice(["the", "of", "a"] + [f"w{k}" for k in range(40)]) for _ in range(60)]
        texts += [" ".join(base), " ".join(base[:-1]), " ".join(base[: r.randint(30, 60)])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = spot_signatures.fingerprints(df)
    name = {x.doc_id: x.fingerprint for x in found.collect()}
    want = set()
    for i, a in enumerate(texts):
        for j, b in enumerate(texts[:i]):
            x, y = brute_signature(a), brute_signature(b)
            if name[i] != name[j] and len(x & y) / len(x | y) >= 0.8:
                want.add(tuple(sorted((name[i], name[j]))))
    assert {(p.a, p.b) for p in spot_signatures.near_pairs(found).collect()} == want and want


def brute_repeats(texts, n):
    raw = [(t or "").encode() for t in texts]
    counts = Counter(b[i:i + n] for b in raw for i in range(len(b) - n + 1))
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - n + 1):
            if counts[b[i:i + n]] > 1:
                gone[i:i + n] = [True] * n
        left = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        yield len(b), sum(gone), sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize("hot", [20_000, 2])
def test_suffix_dedup(spark, hot):
    r = random.Random(4)
    passages = ["".join(r.choice("abcdé ") for _ in range(r.randint(20, 120))) for _ in range(6)]
    texts = ["".join(r.choice(passages)[r.randint(0, 20):] if r.random() < .5 else "".join(r.choice("abcdé ") for _ in range(r.randint(1, 40)))
                     for _ in range(r.randint(0, 6))) for _ in range(40)]
    texts += [None, "", "a" * 90, "ab" * 40, texts[0], texts[1]]
    df = spark.createDataFrame([(i if i % 9 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = suffix_dedup.dedup(df, shape=suffix_dedup.Shape(30, 16, 6), hot_core=hot).collect()
    want = [(i if i % 9 else None, *x) for i, x in enumerate(brute_repeats(texts, 30))]
    assert by_id((g.doc_id, g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) for g in got) == by_id(want)


def test_loser_tree_keeps_order_and_prefixes():
    r = random.Random(5)
    runs = [sorted(bytes(r.choice(b"ab") for _ in range(r.randint(0, 9))) for _ in range(k)) for k in (30, 0, 7, 50, 1)]
    _, shared, out = suffix_dedup.merged([suffix_dedup.front_coded(x) for x in runs])
    assert out == sorted(x for run in runs for x in run)
    assert all(n == suffix_dedup.common_prefix(a, b, 0) for a, b, n in zip(out, out[1:], shared[1:], strict=False))


def test_language_id(spark):
    r = random.Random(6)
    en, de = "this house with three windows and another thing".split(), "dieses haus mit drei fenstern und ein anderes ding".split()
    rows = [(i, " ".join(r.choices(en if i % 2 else de, k=30)), "en" if i % 2 else "de") for i in range(60)]
    odd = [(100, None, "en"), (101, "123 !?", "de"), (None, "this house", None), (102, " ".join(en * 4 + de * 4), None), (102, "", None)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    got = lang_id.learn_and_identify(df).collect()
    assert len(got) == len(rows) + len(odd)
    truth = {i: x for i, _, x in rows}
    assert all(g.lang_pred == truth[g.doc_id] for g in got if g.doc_id in truth)
    assert {g.lang_pred for g in got if g.doc_id in (100, 101)} == {"und"}
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 4 == 2) for g in got if g.doc_id is not None)
    mixed = [g for g in lang_id.identify(df.filter("doc_id = 102"), lang_id.Model(lang_id.learn(df))).collect() if g.n_spans]
    assert [s.lang for s in mixed[0].spans] == ["en", "de"]


def test_sentencepiece(spark):
    df, rows = docs(spark)
    own = sentencepiece_codec.codec(vocabulary("piece_bpe_32k.model"))
    r = random.Random(7)
    texts = [x[1] or "" for x in rows] + ["".join(r.choice("ab  ▁\n\té中😀ñ.<s>the") for _ in range(r.randint(0, 90))) for _ in range(500)]
    texts += [" ", "  a", "a  ", "▁", "\x00"]
    ids, wrong = own.encode(texts)
    assert wrong == 0
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == own.library.encode(texts, add_bos=True, add_eos=True)
    assert [own.decode(x) for x in ids] == [own.library.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
    assert sentencepiece_codec.encode_decode(df).count() == len(rows)


def test_orc_tokens(spark):
    from tokenizers import Tokenizer

    df, rows = docs(spark)
    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = sorted(orc_tokens.round_trip(df).collect(), key=lambda r: r.start)
    assert [g.doc_id for g in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    start, want = 0, Counter()
    for i, x, *_ in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids + [1]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    for g in got:
        assert g.start == start
        start += g.n_tokens
    assert Counter((g.doc_id, g.n_tokens, g.ids_crc32) for g in got) == want


def test_simhash(spark):
    from xxhash import xxh64_intdigest

    df, rows = docs(spark)
    got = simhash_gray.documents_by_component(df, words=4, bits=4).collect()
    assert len(got) == len(rows)

    def brute(text):
        w = (text or "").encode().lower().split()
        h = [xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    fps = [brute(r[1]) for r in rows]
    assert Counter((g.doc_id, int(g.fingerprint, 16)) for g in got) == Counter((r[0], f) for r, f in zip(rows, fps, strict=True))
    forest = simhash_gray.Forest(len(fps))
    f = np.array(fps, np.uint64)
    for i in range(len(f)):
        near = np.flatnonzero(simhash_gray.differ(f[i], f) <= 4)
        forest.link(np.full(len(near), i), near)
    least = {}
    for r, root in zip(rows, forest.root.tolist(), strict=True):
        least[root] = min((x for x in (least.get(root), r[0]) if x is not None), default=None)
    want = Counter((r[0], least[root]) for r, root in zip(rows, forest.root.tolist(), strict=True))
    assert Counter((g.doc_id, g.component_id) for g in got) == want


def test_simhash_index(monkeypatch, spark):
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 62, 30, dtype=np.uint64)
    f = base[rng.integers(0, 30, 900)]
    for _ in range(6):
        f = f ^ np.where(rng.random(900) < .5, np.uint64(1) << rng.integers(0, 64, 900, dtype=np.uint64), np.uint64(0))
    f = np.unique(f)
    forest = simhash_gray.Forest(len(f))
    a, b = np.triu_indices(len(f), 1)
    hit = simhash_gray.differ(f[a], f[b]) <= 4
    forest.link(a[hit], b[hit])
    df = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")
    for hot in (20_000, 40):
        monkeypatch.setattr(simhash_gray, "HOT_NODE", hot)
        root = {r.fp: r.root for r in simhash_gray.components(simhash_gray.links(df, 4)).collect()}
        groups = {}
        for x, c in zip(f.view(np.int64).tolist(), forest.root.tolist(), strict=True):
            groups.setdefault(c, []).append(x)
        assert all(root.get(x, x) == min(g) for g in groups.values() for x in g)


def test_source_mix(spark):
    df, rows = docs(spark, n=300)
    got = source_mix.mix(df, keep=("src",)).collect()
    assert len(got) == len(rows)
    size = Counter()
    for r in rows:
        size[r[3]] += len((r[1] or "").encode().split())
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(size.values()), dict.fromkeys(names, 0.0), set(names)
    while open_:
        rest = total - sum(target[s] for s in names if s not in open_)
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in full} if full else share
        open_ = open_ - full if full else set()
    taken = Counter()
    for g in got:
        s = None if g.src.missing else g.src.name
        assert g.source_size == size[s] and abs(g.target - target[s]) < 1e-6 and 0 <= g.taken <= 2 * g.size
        taken[s] += g.taken
    # whole copies: where one document outweighs the rest of its source, half of it is the bound that holds
    largest = {s: max((len((r[1] or "").encode().split()) for r in rows if r[3] == s), default=0) for s in names}
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in names)
    again = source_mix.mix(df.repartition(5)).collect()
    assert Counter((g.doc_id, g.taken) for g in got) == Counter((g.doc_id, g.taken) for g in again)


def brute_kn(train, order, text):
    """Mean negative log probability by the textbook formula over dictionaries."""
    pad = "\x00" * (order - 1)
    counts = {order: Counter(pad[0:0] + (pad + t)[i:i + order] for t in train for i in range(len(t)))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    d = {}
    for n, c in counts.items():
        k = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        y = k[0] / (k[0] + 2 * k[1]) if k[0] + 2 * k[1] else 0.5
        d[n] = [min(i - 0.01, max(0.1, i - (i + 1) * y * (k[i] / k[i - 1] if k[i - 1] else 0))) for i in (1, 2, 3)]

    def p(g):
        n = len(g)
        if not n:
            return 1 / (len(counts[1]) + 1)
        c = {x: v for x, v in counts[n].items() if x[:-1] == g[:-1]}
        if not c:
            return p(g[1:])
        cut = lambda v: d[n][min(v, 3) - 1]
        total = sum(c.values())
        own = (c[g] - cut(c[g])) / total if g in c else 0
        return own + sum(map(cut, c.values())) / total * p(g[1:])

    return -sum(np.log(p((pad + text)[i:i + order])) for i in range(len(text))) / len(text)


def test_kn_quality(spark, monkeypatch):
    monkeypatch.setattr(kn_quality, "FOLDS", 4)
    r = random.Random(9)
    good = [" ".join(r.choice(["the", "cat", "dog", "ran", "home"]) for _ in range(25)) for _ in range(40)]
    junk = ["".join(r.choice("QXZ#$%@^&*") for _ in range(120)) for _ in range(5)]
    rows = [(i, t, "en") for i, t in enumerate(good + junk)] + [(90, None, None), (91, "", "en"), (None, good[0], "xx"), (3, good[3], "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(0, 1), (None, 1), (40, 0)], "doc_id long, quality int")
    got = kn_quality.classify(df, labels, order=3).collect()
    assert len(got) == len(rows)
    kept = {g.doc_id: g.kept for g in got if g.doc_id is not None}
    assert all(kept[i] for i in range(40)) and not any(kept[i] for i in range(40, 45)) and not kept[90] and not kept[91]
    fold = {x.doc_id for x in labels.filter("quality = 1 and doc_id is not null and pmod(xxhash64(doc_id, 'fold'), 4) != 0").distinct().collect()}
    train = [good[i] for i in sorted(fold)]
    train += [good[3]] if 3 in fold else []        # the repeated row counts as any other
    for g in got:
        if g.doc_id in (1, 35, 41):
            assert abs(np.log(g.perplexity) - brute_kn(train, 3, rows[g.doc_id][1])) < 1e-5


def test_kn_quality_word_loops(spark):
    """Loops of real words have characters like prose; bounds as narrow as the documents' own spread show half of them
    (47 of these 90), loops whose mean lies at the centre stay."""
    r = random.Random(11)
    parts = ["the", "er", "an", "in", "re", "on", "at", "en", "nd", "ti", "es", "or", "te", "of", "ed", "is", "it", "al", "ar", "st"]
    word = lambda: "".join(r.choice(parts) for _ in range(r.randint(1, 4)))
    prose = [" ".join(word() for _ in range(r.randint(60, 400))) for _ in range(260)]
    loops = []
    for c in (1, 2, 3):
        loops += [" ".join(w for w in (word() for _ in range(c)) for _ in range(r.randint(180, 360) // c)) for _ in range(30)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(prose + loops)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(230)], "doc_id long, quality int")
    kept = {g.doc_id for g in kn_quality.classify(df, labels).collect() if g.kept}
    assert len([i for i in kept if i >= 260]) <= 50
    assert len([i for i in kept if i < 230]) >= 220 and len([i for i in kept if 230 <= i < 260]) >= 26


def test_orc_lookup_and_metadata(spark, tmp_dir):
    import glob

    df, _ = docs(spark, n=200)
    folder = f"{tmp_dir}/ids"
    orc_tokens.write(df, folder)
    asked = [3, 5, 100, 102, 9999]
    plain = lambda rows: by_id((r.doc_id, r.n_tokens, list(r.ids)) for r in rows)
    want = plain(r for r in orc_tokens.read(spark, folder).collect() if r.doc_id in asked)
    # 5 is there three times, 100 and 102 twice
    assert len(want) == 8 and plain(orc_tokens.lookup(spark, folder, asked).collect()) == want
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in glob.glob(f"{folder}/*.orc"):
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(name), jvm.org.apache.orc.OrcFile.readerOptions(conf))
        if not reader.getNumberOfRows():
            continue
        at = list(reader.getSchema().getFieldNames()).index("doc_id") + 1
        statistics, own = reader.getStatistics()[at], [r.doc_id for r in spark.read.orc(name).collect() if r.doc_id is not None]
        assert reader.getRowIndexStride() > 0
        assert (statistics.getMinimum(), statistics.getMaximum()) == (min(own), max(own))
        rows = reader.rows()
        streams = {str(x.getKind()) for stripe in reader.getStripes() for x in rows.readStripeFooter(stripe).getStreamsList() if x.getColumn() == at}
        rows.close()
        assert "ROW_INDEX" in streams and any(x.startswith("BLOOM_FILTER") for x in streams)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for found in (token_counts.count_tokens(df), line_rules.clean_lines(df), spot_signatures.compare_with_edited(df), suffix_dedup.dedup(df),
                  lang_id.learn_and_identify(df), sentencepiece_codec.encode_decode(df), orc_tokens.round_trip(df),
                  simhash_gray.documents_by_component(df, 4, 4), source_mix.mix(df), kn_quality.classify(df, labels)):
        assert found.count() == 0
