"""Language identification: script ranges narrow the candidates, Viterbi over word scores labels spans.

Model: for every language, counts of hashed letter trigrams (a letter with its neighbours inside the word) and letters
by script, over all documents that it may learn from. It has at most languages * (BUCKETS + scripts) numbers, which is
its size bound wherever it is sent.

Prediction: a word is a run of letters. Its score for a language is the sum of its trigrams' smoothed log
probabilities; languages that hardly use the script of the word's first letter are out (all stay in if none uses it).
The best path through a document's words pays ``SWITCH`` for every change of language; its runs are the spans of a
mixed text. The predicted language has the most letters on the path (the first by name of equals), the score is its
share of the letters.

Texts of more than ``SLICE`` characters are read in slices that part no word; the path runs on from slice to slice.
Documents of like length are scored side by side.

Defined results: null text or one without a letter: ``und``, score 0. With nothing to learn from, all are ``und``.
Null ids, ties and repeated rows give one row each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_arrow, texts_of

UND = "und"
BUCKETS = 1 << 14
SMOOTHING = 0.5
SWITCH = 12.0
SCRIPT_SHARE = 0.01
SLICE = 2_000_000
OUT = np.float32(-1e4)

# Blocks of letters by script, first and last code point.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF), (0xFB1D, 0xFB4F)),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F), (0xA8E0, 0xA8FF)),
    "bengali": ((0x980, 0x9FF),),
    "gurmukhi": ((0xA00, 0xA7F),),
    "gujarati": ((0xA80, 0xAFF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "kannada": ((0xC80, 0xCFF),),
    "malayalam": ((0xD00, 0xD7F),),
    "thai": ((0xE00, 0xE7F),),
    "lao": ((0xE80, 0xEFF),),
    "georgian": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)),
    "ethiopic": ((0x1200, 0x139F),),
    "khmer": ((0x1780, 0x17FF),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "han": ((0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)),
}


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: is it a letter, and the number of its script (0: any other)."""
    letter = np.array([chr(c).isalpha() for c in range(0x110000)])
    script = np.zeros(0x110000, np.int8)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for a, z in ranges:
            script[a:z + 1] = k
    return letter, script


def _lower(text: str) -> str:
    """Lower case, one character for one, so that offsets hold."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def slices(texts: list[str], size: int) -> list[tuple[int, int, str]]:
    """(text, offset, slice) of about ``size`` characters, no word in two, of like length next to each other."""
    out = []
    for k, t in enumerate(texts):
        a = 0
        while a < len(t):
            z = len(t) if len(t) - a <= size else t.rfind(" ", a, a + size) + 1
            if z <= a:                         # no blank: up to the end of the word that the slice would cut
                z = next((i for i in range(a + size, len(t)) if not t[i].isalpha()), len(t))
            out.append((k, a, t[a:z]))
            a = z
    out.sort(key=lambda x: len(x[2]))
    return out


def groups(parts: list[tuple[int, int, str]], size: int) -> Iterator[list[tuple[int, int, str]]]:
    held, n = [], 0
    for p in parts:
        if held and n + len(p[2]) > size:
            yield held
            held, n = [], 0
        held.append(p)
        n += len(p[2])
    if held:
        yield held


def trigrams(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all letters of the parts in order: place in the parts joined by a newline, bucket, script, starts a word."""
    letter, script = _tables()
    codes = np.frombuffer("\n".join(map(_lower, parts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letter[codes]
    c = np.where(known, codes, 0).astype(np.uint32)
    at = np.flatnonzero(known)
    before = np.concatenate([[0], c[:-1]]).astype(np.uint32)[at]
    after = np.concatenate([c[1:], [0]]).astype(np.uint32)[at]
    h = before * np.uint32(0x9E3779B1) + c[at] * np.uint32(0x85EBCA77) + after * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x27D4EB2F)
    return at, (h >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64), script[codes[at]], before == 0


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, feature, n) over all rows with a text and a language; feature: a trigram's bucket, or BUCKETS + script."""
    size = BUCKETS + len(SCRIPTS) + 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            by: dict[str, list[str]] = {}
            for x, t in zip(langs, texts_of(batch.column("text")), strict=True):
                by.setdefault(x, []).append(t)
            for x, ts in by.items():
                n = found.setdefault(x, np.zeros(size, np.int64))
                for group in groups(slices(ts, SLICE), SLICE):
                    _, bucket, script, _ = trigrams([p[2] for p in group])
                    n += np.bincount(bucket, minlength=size)
                    n += np.bincount(script.astype(np.int64) + BUCKETS, minlength=size)
        for x, n in found.items():
            f = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([x] * len(f), pa.string()), pa.array(f, pa.int32()), pa.array(n[f])],
                                             ["lang", "feature", "n"])

    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    return map_arrow(rows, counted, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))


class Model:
    """Log probabilities (buckets x languages) and the languages that each script leaves in."""

    def __init__(self, counts: DataFrame):
        rows = counts.toArrow()                     # bounded: languages * (BUCKETS + scripts) rows at most
        names = rows.column("lang").to_pylist()
        self.langs = sorted(set(names))
        number = {x: k for k, x in enumerate(self.langs)}
        n = np.zeros((BUCKETS + len(SCRIPTS) + 1, len(self.langs)))
        n[rows.column("feature").to_numpy(), [number[x] for x in names]] = rows.column("n").to_numpy()
        grams, scripts = n[:BUCKETS], n[BUCKETS:]
        self.score = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)
        self.candidates = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
        self.candidates[~self.candidates.any(axis=1)] = True

    def words(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words of the parts joined by a newline, and their scores by language."""
        at, bucket, script, starts = trigrams(parts)
        if not len(at):
            return np.empty(0, int), np.empty(0, int), np.empty((0, len(self.langs)), np.float32)
        first = np.flatnonzero(starts)
        score = np.add.reduceat(self.score[bucket], first, axis=0)
        score[~self.candidates[script[first]]] += OUT
        return at[first], at[np.append(first[1:], len(at)) - 1] + 1, score

    def long_path(self, parts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """As ``paths``, for the slices of one text in order: the path runs on from slice to slice."""
        own = np.arange(len(self.langs))
        best, turns, found = np.zeros(len(self.langs), np.float32), [], []
        for part in parts:
            w_start, w_end, score = self.words([part])
            back = np.empty(score.shape, np.int8 if len(self.langs) < 128 else np.int32)
            for t in range(len(score)):
                top = best.argmax()
                moved = best[top] - np.float32(SWITCH)
                stay = best >= moved
                back[t] = np.where(stay, own, top)
                best = np.where(stay, best, moved) + score[t]
            turns.append(back)
            found.append((w_start, w_end, np.empty(len(score), np.int64)))
        state = best.argmax()
        for back, (_, _, label) in zip(reversed(turns), reversed(found), strict=True):
            for t in range(len(label) - 1, -1, -1):
                label[t] = state
                state = back[t, state]
        return found

    def paths(self, parts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each part its words' starts, ends (offsets of letters) and languages (numbers)."""
        w_start, w_end, score = self.words(parts)
        edges = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])])
        if not len(score):
            return [(np.empty(0, int),) * 3] * len(parts)
        bounds = np.searchsorted(w_start, edges)
        n_words = np.diff(bounds)
        order = np.argsort(-n_words, kind="stable")
        base, sizes = bounds[:-1][order], n_words[order]
        steps = int(sizes[0])
        live = np.searchsorted(-sizes, -np.arange(steps), side="left")      # parts with more than t words
        back = np.empty(score.shape, np.int8 if len(self.langs) < 128 else np.int32)
        best = np.zeros((len(parts), len(self.langs)), np.float32)
        own = np.arange(len(self.langs))
        for t in range(steps):
            a = live[t]
            v = best[:a]
            top = v.argmax(axis=1)
            moved = v[np.arange(a), top] - np.float32(SWITCH)
            stay = v >= moved[:, None]
            rows = base[:a] + t
            back[rows] = np.where(stay, own, top[:, None])
            best[:a] = np.where(stay, v, moved[:, None]) + score[rows]
        state = best.argmax(axis=1)
        label = np.empty(len(score), np.int64)
        for t in range(steps - 1, -1, -1):
            rows = base[:live[t]] + t
            label[rows] = state[:live[t]]
            state[:live[t]] = back[rows, state[:live[t]]]
        return [(w_start[a:z] - e, w_end[a:z] - e, label[a:z]) for a, z, e in zip(bounds[:-1], bounds[1:], edges[:-1], strict=True)]


def held_out(doc_id: str = "doc_id") -> Column:
    """The rows kept from learning: CRC-32 of the id as text leaves 2 by 4 (a null id: learned from)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model, text: str = "text", spans: bool = True) -> DataFrame:
    """(doc_id, lang_pred, score, n_spans, spans) for every row; spans: (lang, start, end) offsets in characters."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.langs, model.score, model.candidates))
    names = ["doc_id", "lang_pred", "score", "n_spans"] + ["spans"] * spans
    schema = "doc_id long, lang_pred string, score double, n_spans long"
    schema += ", spans array<struct<lang: string, start: long, end: long>>" if spans else ""
    kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.__new__(Model)
        own.langs, own.score, own.candidates = shared.value
        for batch in batches:
            texts = texts_of(batch.column("text"))
            letters = np.zeros((len(texts), max(1, len(own.langs))), np.int64)
            runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            short = [(k, 0, t) for k, t in enumerate(texts) if len(t) <= SLICE]
            found = [(g, own.paths) for g in groups(sorted(short, key=lambda x: len(x[2])), SLICE)]
            long = [[(k, a, p) for _, a, p in sorted(slices([t], SLICE), key=lambda x: x[1])] for k, t in enumerate(texts) if len(t) > SLICE]
            for group, path in found + [(g, own.long_path) for g in long] if own.langs else []:
                for (k, offset, _), (start, end, label) in zip(group, path([p[2] for p in group]), strict=True):
                    if len(start):
                        letters[k] += np.bincount(label, end - start, len(own.langs)).astype(np.int64)
                        turn = np.flatnonzero(np.diff(label, prepend=-1))
                        runs[k] += [(int(start[a]) + offset, int(end[z]) + offset, int(label[a]))
                                    for a, z in zip(turn, np.append(turn[1:], len(label)) - 1, strict=True)]
            total, top = letters.sum(axis=1), letters.argmax(axis=1)
            score = letters[np.arange(len(texts)), top] / np.maximum(total, 1)
            cols = [batch.column("doc_id"), pa.array([own.langs[x] if n else UND for x, n in zip(top, total, strict=True)], pa.string()),
                    pa.array(score, pa.float64()), pa.array([len(r) for r in runs], pa.int64())]
            if spans:
                cols.append(pa.array([[{"lang": own.langs[x], "start": a, "end": z} for a, z, x in sorted(r)] for r in runs], kind))
            yield pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(rows, predicted, schema)


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_spans): learns from the rows not held out, predicts all."""
    model = Model(learn(docs.filter(~held_out())))
    return identify(docs, model, spans=False).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_spans")
