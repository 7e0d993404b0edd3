"""Hard negatives, winnowing and collocations against brute force, odd inputs included."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerflow.llm import collocations, hard_negatives, winnowing

VECTORS = "vec_id long, embedding array<double>, label int, id long, q string"


# ---- hard negatives ---------------------------------------------------------------------------------------------

def mined(spark, rows, **more):
    table = spark.createDataFrame([(*r, 7, "clash") for r in rows], VECTORS)
    found = hard_negatives.mine(hard_negatives.shifted_labels(hard_negatives.prepare(table)), F.col("id") % 50 == 0, **more)
    return sorted(tuple(r) for r in found.collect())


def mined_by_hand(rows, positives=5, negatives=3):
    fine = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fine.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))
    fine = sorted(set(fine))
    out = []
    for a in fine:
        if a[0] % 50:
            continue
        score = lambda r: sum(x * y for x, y in zip(a[2], r[2], strict=False))  # noqa: B023, E731
        ranked = sorted((r for r in fine if r != a), key=lambda r: (-score(r), r[0], r[1]))
        for p in [r for r in ranked if r[1] == a[1]][:positives]:
            s = score(p)
            near = [r for r in ranked if r[1] != a[1] and 50 * s <= 100 * score(r) <= 95 * s][:negatives]
            out += [(a[0], p[0], k, r[0], s, score(r)) for k, r in enumerate(near, 1)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)], rng.choice([0, 0, 1, 2])) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6, i % 3) for i in range(60)]                        # ties
    rows += [(2000, [0.0] * 6, 0), (2050, [0.25] * 3, 1), (2100, [], 2)]             # zero, short and empty vectors
    for held in (4096, 64):                                                          # one block, many blocks
        assert mined(spark, rows, block_rows=held) == mined_by_hand(rows)


def test_hard_negatives_odd_rows(spark):
    odd = [(None, [1.0], 1), (50, None, 1), (100, [1.0], None), (150, [None], 1), (200, [float("nan")], 1), (250, [float("inf")], 1)]
    rows = [(0, [1.0, 0.5], 3), (1, [1.0, 0.25], 4), (2, [0.75, 0.25], 5), (3, [0.7, 0.25], 4)]
    assert mined(spark, odd + rows + rows) == mined_by_hand(odd + rows)              # repeated rows count once
    assert mined(spark, []) == []
    huge = [(50, [1e300, 1.0], 1), (51, [1e300, 1.0], 1), (52, [1e17, 0.0], 2), (53, [3e7, 1.0], 2), (54, [1.0, 1.0], 1)]
    assert mined(spark, huge) == []                        # all scores are held at the limit of 64 bits: none is below 95 %
    wide = [(50, [1e11], 1), (51, [1e3], 1), (52, [9e2], 2), (53, [7e2], 3), (54, [1e2], 2)]
    want = mined_by_hand(wide)
    assert mined(spark, wide) == want and len(want) == 2 and want[0][4] > 1 << 53     # beyond doubles' integers, exact


# ---- winnowing ------------------------------------------------------------------------------------------------

def hits_by_hand(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    known = defaultdict(set)
    for item, text in items:
        w = words(text)
        t = min(window, len(w))
        for j in range(len(w) - t + 1 if w else 0):
            known[tuple(w[j:j + t])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w = words(text)
        hit, named = set(), set()
        for t in {len(k) for k in known}:
            for j in range(len(w) - t + 1):
                if tuple(w[j:j + t]) in known:
                    hit.update(range(j, j + t))
                    named |= known[tuple(w[j:j + t])]
        ids = ",".join(sorted(named))
        out.append((doc, len(w), len(hit), len(named), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def decontaminated(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, "clash", 1) for r in docs], "doc_id long, text string, words string, t int")
    i = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, class int")
    return sorted((tuple(r) for r in winnowing.decontaminate(d, i, **more).collect()), key=repr)


def winnowing_case():
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["a", "b", "tree", "Élan", "x1", "the"]) + rng.choice(["", ",", "!"]) for _ in range(n))
    items = [(i, text(rng.choice([14, 25, 40]))) for i in range(30)]
    items += [(100, "one"), (101, "two words"), (102, "Nine words are fewer than ten words you see"), (103, None), (104, "..."),
              (105, items[0][1]), (105, items[1][1]), (None, items[2][1])]
    items += [(200 + i, "same boiler plate line that many of the items repeat at once") for i in range(50)]
    docs = [(i, text(rng.choice([5, 60, 300]))) for i in range(30)]
    docs += [(50 + i, text(20) + " " + items[i][1].upper().replace("É", "é") + " " + text(20)) for i in range(10)]
    docs += [(70, text(1020) + " " + items[5][1] + " " + text(3000)), (71, "a " * 5000), (72, None), (73, ""), (74, ", ."), (75, "ONE two Words"),
             (None, items[7][1]), (None, items[7][1]), (76, items[7][1]), (76, text(30)),
             (77, "same boiler plate line that many of the items repeat at once"), (78, " ".join(items[3][1].split()[:9]))]
    return docs, items


def test_winnowing_equals_brute_force(spark):
    docs, items = winnowing_case()
    want = hits_by_hand(docs, items)
    assert decontaminated(spark, docs, items) == want
    assert decontaminated(spark, docs, items, broadcast=0) == want            # both sides shuffled


def test_winnowing_empty_tables(spark):
    docs, items = winnowing_case()
    assert decontaminated(spark, [], items) == []
    assert decontaminated(spark, docs[:5], []) == hits_by_hand(docs[:5], [])
    assert decontaminated(spark, docs[:5], [(1, None), (2, "")]) == hits_by_hand(docs[:5], [])


# ---- collocations ---------------------------------------------------------------------------------------------

def phrases_by_hand(docs, least, best=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            if not inside:
                score, _, le, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), le, r))
        out += [(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(rows)[:best], 1)]
    return sorted(out)


def mined_phrases(spark, docs, **more):
    table = spark.createDataFrame([(t, la, 1, "clash") for t, la in docs], "text string, lang string, n int, chunk string")
    return sorted(tuple(r) for r in collocations.collocations(table, **more).collect())


def collocation_case():
    rng = random.Random(11)
    vocabulary = ["new", "york", "City", "of", "the", "ß", "rain", "日本", "tea", "cup", "and", "x" * 300]
    texts = []
    for _ in range(150):
        w = []
        for _ in range(rng.choice([3, 40, 200])):
            w += rng.choice([["new", "York"], ["cup", "of", "tea", "and"], [rng.choice(vocabulary)], [rng.choice(vocabulary) + rng.choice(",.;\n")]])
        texts.append((" ".join(w), rng.choice(["en", "en", "de", None, "und"])))
    return texts + texts[:20] * 3 + [("the " * 9000, "en"), (None, "en"), ("", "fr"), ("...\n\t ,", "de"), ("once only", "es")]


def test_collocations_equal_brute_force(spark):
    docs = collocation_case()
    for more in ({"least": 5}, {"least": 30, "best": 7}, {"least": 5, "trigger": 1, "bits": 1 << 16}, {"least": 5, "trigger": 1 << 40}):
        own = {k: v for k, v in more.items() if k in ("least", "best")}
        assert mined_phrases(spark, docs, **more) == phrases_by_hand(docs, **own)


def test_collocations_empty_and_saturated(spark):
    assert mined_phrases(spark, []) == []
    docs = collocation_case()
    assert mined_phrases(spark, docs, least=5, bits=8) == phrases_by_hand(docs, 5)     # every bit set: nothing is pruned


def test_chunks_own_every_word_once(spark):
    docs = [("a b c d e f g h " * 50, "en"), ("a b, c", None)]
    table = spark.createDataFrame(docs, "text string, lang string")
    for trigger in (1, 3, 16):
        own = collocations.dictionary(table, trigger=trigger).selectExpr("sum(own * n)").first()[0]
        assert own == 403
