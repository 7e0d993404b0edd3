"""Language paths against a Viterbi by hand, and across the slices of long texts."""
import random

import numpy as np

from ledgerflow.llm import lang_id

WORDS = {"en": "this house with three windows and another thing", "de": "dieses haus mit drei fenstern und ein anderes ding",
         "ru": "этот дом с тремя окнами и другая вещь"}


def trained(spark):
    r = random.Random(2)
    rows = [(i, " ".join(r.choices(WORDS[la].split(), k=30)), la, 3, "x") for i in range(30) for la in WORDS]
    return lang_id.Model(lang_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string, feature int, spans string")))


def path_by_hand(model, text):
    """(start, end, language) of every word: the best sum of word scores less the penalty of each change."""
    words, a = [], None
    for i, c in enumerate(text + " "):
        if c.isalpha() and a is None:
            a = i
        if not c.isalpha() and a is not None:
            words.append((a, i))
            a = None
    best, back = np.zeros(len(model.langs)), []
    for a, z in words:
        _, bucket, script, _ = lang_id.trigrams([text[a:z]])
        score = model.score[bucket].sum(axis=0).astype(float)
        score[~model.candidates[script[0]]] += lang_id.OUT
        change = best[None, :] - lang_id.SWITCH * (1 - np.eye(len(best)))
        back.append(change.argmax(axis=1))
        best = change.max(axis=1) + score
    state, labels = best.argmax(), []
    for b in reversed(back):
        labels.append(int(state))
        state = b[state]
    return [(a, z, la) for (a, z), la in zip(words, reversed(labels), strict=True)]


def mixed(r, n):
    return "".join(r.choice(WORDS[r.choice(list(WORDS))].split()) + r.choice([" ", " ", "\n", "-", "1", ", "]) for _ in range(n))


def test_paths_equal_viterbi_by_hand(spark):
    model, r = trained(spark), random.Random(3)
    texts = [mixed(r, r.randint(0, 60)) for _ in range(60)] + ["", "123", "ß", "haus"]
    for text, (start, end, label) in zip(texts, model.paths(texts), strict=True):
        assert list(zip(start.tolist(), end.tolist(), label.tolist(), strict=True)) == path_by_hand(model, text)


def test_slices_of_a_long_text_change_nothing(spark, monkeypatch):
    model, r = trained(spark), random.Random(4)
    rows = [(i, mixed(r, 80), "clash", 1) for i in range(5)] + [(6, "haus" * 60 + " " + mixed(r, 20), "", 1), (7, None, "", 1), (8, "x" * 200, "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, score int")
    whole = {x.doc_id: x for x in lang_id.identify(df, model).collect()}
    monkeypatch.setattr(lang_id, "SLICE", 40)
    parts = [p for _, _, p in sorted(lang_id.slices([rows[0][1]], 40), key=lambda x: x[1])]
    assert "".join(parts) == rows[0][1] and len(parts) > 5
    # the function that is sent to the workers reads SLICE there, so the path is taken here
    for i, text, *_ in rows[:6]:
        cut = sorted(lang_id.slices([text], 40), key=lambda x: x[1])
        found = [(a + o, z + o, la) for (_, o, _), part in zip(cut, model.long_path([p for _, _, p in cut]), strict=True)
                 for a, z, la in zip(*(c.tolist() for c in part), strict=True)]
        assert found == path_by_hand(model, text)
        letters = sum(z - a for a, z, la in found if model.langs[la] == whole[i].lang_pred)
        assert abs(whole[i].score - letters / sum(z - a for a, z, _ in found)) < 1e-9
