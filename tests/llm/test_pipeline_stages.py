"""Every stage of the pipeline against a version by hand, on rows with nulls, empty texts, copies and extra columns."""
import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from statistics import NormalDist

import numpy as np
import xxhash
from test_documents import brute_kn, brute_repeats

import corpus_pipeline as cp
from ledgerflow.llm import kn_quality, suffix_dedup
from ledgerflow.llm.common import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tie string, block long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", 5) for r in rows], SCHEMA)


def kept(df):
    assert df.columns == list(cp.COLUMNS)
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(n=60, words=(3, 40)):
    r = random.Random(21)
    parts = ["the", "er", "an", "in", "re", "on", "at", "en", "nd", "ti", "es", "or"]
    text = lambda: " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(r.randint(*words)))
    rows = [(i, text(), ["en", "de", None][i % 3], ["a", "b", None, "c"][i % 4]) for i in range(n)]
    rows += [(100, None, "en", "a"), (101, "", "en", None), (None, rows[3][1], None, "b"), (None, rows[3][1], None, "b"), (3, rows[3][1], "en", "a"),
             (3, rows[3][1], "en", "a"), (200, "QX ZZ#QX", "en", "a"), (201, rows[5][1], "fr", "zz")]
    return [(i, t, la, s, len(t or "")) for i, t, la, s in rows]


# --- quality ---------------------------------------------------------------------------------------------------

def _quantile(values, share, edge):
    steps = sorted(math.floor(x / kn_quality.STEP) for x in values)
    at = next(s for k, s in enumerate(steps, 1) if k / len(steps) >= share)
    return (at + edge) * kn_quality.STEP


def _fit(rows):
    """Variance a + b / n of (n, distance), least squares weighed with n."""
    n, d = (np.array(x, float) for x in zip(*rows, strict=True))
    w, u, q = n, 1 / n, d * d
    sw, su, suu, sr, sur = (float(x.sum()) for x in (w, w * u, w * u * u, w * q, w * u * q))
    det = sw * suu - su * su
    a, b = ((suu * sr - su * sur) / det, (sw * sur - su * sr) / det) if det > 1e-9 * sw * suu else (0.0, sr / su)
    return (sr / sw, 0.0) if b < 0 else (0.0, sur / suu) if a < 0 else (a, b)


def _student(share, n):
    z = NormalDist().inv_cdf(share)
    return z * (1 + (z * z + 1) / (4 * (n - 1))) if n > 1 else math.inf


def verdicts(rows):
    """Kept or not, of rows (lang, n, log perplexity, kept back: True, False or None if not trusted)."""
    spread = lambda f, n: max(kn_quality.LEAST_SPREAD, math.sqrt(f[0] + f[1] / max(n, 1)))
    trusted = [r for r in rows if r[3] is not None and r[1] > 0]
    held = [r for r in trusted if r[3]]
    own = defaultdict(list)
    for la, _, x, _ in held:
        own[la].append(x)
    centre = {la: _quantile(v, 0.5, 0.5) for la, v in own.items()}
    middle = _quantile([r[2] for r in held], 0.5, 0.5)
    together = _fit([(n, x - centre[la]) for la, n, x, _ in held])
    strange = _fit([(n, x - middle) for _, n, x, _ in held])
    enough = {la: len(v) >= kn_quality.ENOUGH for la, v in own.items()}
    fit = {la: _fit([(n, x - centre[la]) for l2, n, x, _ in held if l2 == la]) if enough[la] else together for la in own}

    def bounds(of):
        out = []
        for chosen, share, edge, sign in ((trusted, kn_quality.LOW_QUANTILE, 0.0, -1), (held, kn_quality.HIGH_QUANTILE, 1.0, 1)):
            xs = [x for r in chosen for x in of(r)]
            q = _quantile(xs, share, edge)
            if len(xs) < kn_quality.ENOUGH:
                q = sign * max(sign * q, _student(kn_quality.HIGH_QUANTILE, len(xs)))
            out.append(q)
        return out

    all_of = bounds(lambda r: [(r[2] - centre[r[0]]) / spread(together, r[1])] if r[0] in centre else [])
    other = bounds(lambda r: [(r[2] - middle) / spread(strange, r[1])])
    result = []
    for la, n, x, _ in rows:
        if n == 0:
            result.append(False)
            continue
        if la in centre:
            got = bounds(lambda r: [(r[2] - centre[la]) / spread(fit[la], r[1])] if r[0] == la else []) if enough[la] else all_of  # noqa: B023
            c, f, (low, high) = centre[la], fit[la], [b * math.sqrt(1 + 1 / len(own[la])) for b in got]
        else:
            c, f, (low, high) = middle, strange, other
        result.append(c + low * spread(f, n) <= x <= c + high * spread(f, n))
    return result


def test_quality_by_hand(spark, monkeypatch):
    monkeypatch.setattr(kn_quality, "ENOUGH", 6)
    rows = corpus(90)
    trusted = [r[0] for r in rows[:90] if r[0] % 5]
    labels = spark.createDataFrame([(i, 1) for i in trusted] + [(200, 0), (None, 1)], "doc_id long, quality int")
    monkeypatch.setattr(kn_quality, "read_labels", lambda *_: labels)
    fold = {r[0]: r[1] for r in labels.filter("doc_id is not null and quality = 1").selectExpr("doc_id", f"pmod(xxhash64(doc_id, 'fold'), {kn_quality.FOLDS}) = 0").collect()}
    train = [r[1] for r in rows if fold.get(r[0]) is False]
    score = {t: brute_kn(train, kn_quality.ORDER, t) for t in {r[1] for r in rows if r[1]}}
    seen = verdicts([(la, len(t or ""), score.get(t), fold.get(i)) for i, t, la, _, _ in rows])
    want = sorted((r for r, ok in zip(rows, seen, strict=True) if ok), key=repr)
    got = kept(cp.quality(spark, table(spark, rows), ""))
    assert got == want and 0 < len(want) < len(rows)


# --- near duplicates -------------------------------------------------------------------------------------------

def _fingerprint(text):
    words = [w.encode() for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates_by_hand(spark):
    rows = corpus(40, (20, 60))
    rows += [(300 + k, " ".join(["same"] * 3 + rows[k][1].split()[:-1]), "en", "a", 9) for k in range(15)]
    prints = [_fingerprint(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                group = [group[j] if g == group[i] else g for g in group]
    tie = {r.t: r.h for r in spark.createDataFrame([(t,) for t in {r[1] for r in rows}], "t string").selectExpr("t", "xxhash64(t) as h").collect()}
    order = lambda r: (r[0] is None, r[0] or 0, tie[r[1]], r[2] is not None, r[2] or "", r[3] is not None, r[3] or "", r[4])
    first = {}
    for g, r in zip(group, rows, strict=True):
        if g not in first or order(r) < order(first[g]):
            first[g] = r
    assert kept(cp.near_duplicates(spark, table(spark, rows), "")) == sorted(first.values(), key=repr)


# --- repeated passages -----------------------------------------------------------------------------------------

def test_repeated_passages_by_hand(spark, monkeypatch):
    monkeypatch.setattr(cp, "PASSAGE", suffix_dedup.Shape(30, 16, 6))
    rows = corpus(20, (1, 12))
    shared = "a passage that several documents of this table share é "
    rows = [(i, t if t is None or k % 3 else shared + t + shared[:40], la, s, n) for k, (i, t, la, s, n) in enumerate(rows)]
    rows = [(i, t, la, s, len(t or "")) for i, t, la, s, _ in rows] + [(400, shared, "en", "a", len(shared))]
    raw = [(r[1] or "").encode() for r in rows]
    counts = Counter(b[i:i + 30] for b in raw for i in range(len(b) - 29))
    want = []
    for r, b, (_, n_removed, _, sha) in zip(rows, raw, brute_repeats([r[1] for r in rows], 30), strict=True):
        gone = {k for i in range(len(b) - 29) if counts[b[i:i + 30]] > 1 for k in range(i, i + 30)}
        left = bytes(c for k, c in enumerate(b) if k not in gone)
        assert len(gone) == n_removed and hashlib.sha256(left).hexdigest() == sha
        text = left.decode("utf-8", "ignore") if r[1] is not None else None
        if not gone:
            want.append(r)
        elif WORD.search(text):
            want.append((r[0], text, r[2], r[3], len(text)))
    got = kept(cp.repeated_passages(spark, table(spark, rows), ""))
    assert got == sorted(want, key=repr) and len(got) < len(rows)


# --- source weights --------------------------------------------------------------------------------------------

def test_source_weights_by_hand(spark):
    rows = corpus(80)
    size = lambda t: len(WORD.findall(t or ""))
    total = Counter()
    for r in rows:
        total[r[3]] += size(r[1])
    names = [*sorted(s for s in total if s is not None), None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, free = {}, set(names)
    while free:
        rest = 1.5 * sum(total.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 2 * total[s]}
        target |= {s: 2.0 * total[s] for s in full} if full else share
        free = free - full if full else set()
    got = kept(cp.source_weights(spark, table(spark, rows), ""))
    own, copies, taken, largest = Counter(rows), Counter(got), Counter(), Counter()
    for r, n in copies.items():
        same = sum(c for x, c in own.items() if (x[0], x[1], x[3]) == (r[0], r[1], r[3]))
        assert r in own and n <= 2 * same
        taken[r[3]] += n * size(r[1])
    for r in rows:
        largest[r[3]] = max(largest[r[3]], size(r[1]))
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in names)
    assert got == kept(cp.source_weights(spark, table(spark, rows).repartition(3), ""))


# --- token ids, empty tables -----------------------------------------------------------------------------------

def test_token_ids_by_hand(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    rows = corpus(30)
    want = []
    for r in rows:
        ids = model.encode(r[1] or "", add_bos=True, add_eos=True)
        raw = np.array(ids, "<u4").tobytes()
        want.append((r[0], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    got = cp.token_ids(spark, table(spark, rows), "")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_stages_on_an_empty_table(spark, monkeypatch):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    monkeypatch.setattr(kn_quality, "read_labels", lambda *_: labels)
    for _, stage in cp.STAGES:
        assert stage(spark, table(spark, []), "").count() == 0
