"""Exact removal of long repeated byte strings by a sparse suffix array, sorted by a distributed merge sort.

Every byte that lies in a string of ``length`` bytes which also starts anywhere else goes. Strings are judged on the
input, documents never run into each other.

Which suffixes: of the ``WINDOW`` k-mers that follow a place, the one of the least hash (leftmost of equals) is the
place's anchor. Equal strings have their anchors at the same offset, so every repeated string is found at its anchor,
and only suffixes at anchors (about two in ``WINDOW`` + 1 bytes) are of interest. An anchor stands for the run of
places that share it; its context is all that their strings cover, its core the bytes from the anchor on that each of
their strings covers.

1. Anchors whose core's hash occurs once can't repeat and go. This is the only use of hashes for telling apart; equal
   cores never have different hashes.
2. Contexts that are equal as a whole (128-bit hash; copies, passages far from their edges) repeat at all their places.
   They are counted by aggregation, so a group of copies of any size is one row, and one of each takes part in
3. the sort of all different contexts that share a core. Each block of documents sorts its suffixes and cuts the run at
   range borders; runs travel front-coded (bytes shared with the suffix before, and the rest). Each range is merged by a
   loser tree that keeps, for every run's head, how many bytes it shares with the last winner: heads that share
   different numbers are ordered by these alone, heads that share the same number are compared from that byte on.
   Borders are 8-byte heads; the suffixes of one frequent head are dealt over several ranges by core.
   The order and its common prefixes then give, for every offset o before an anchor, the suffixes that agree in
   ``length`` - o bytes; the contexts that also agree in the o bytes before it hold the same string there.
   Cores with more than ``HOT_CORE`` different contexts are not sorted in one task: their strings' 128-bit hashes are
   counted by aggregation instead.
4. Removed runs of each document are the union of its strings.

A second, shorter length shares all of this: a repeated long string begins with a repeated short one, so the shorter
length's anchors find both. Contexts reach as far as their long strings (or the text's end), and the one order decides
both lengths. What repeated long strings cover, repeated short ones cover as well: it is sent once, as the long one's.

Defined results: a null text counts as empty; texts shorter than ``length`` keep all; rows equal in id and text repeat
each other; null ids and ties give one row each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import discard, map_arrow, ship, texts_of
from ledgerflow.session import materialize

LENGTH = 400
WINDOW = 256
KMER = 24
SEGMENT = 1 << 18
BLOCK_BYTES = 12 << 20
RANGE_BYTES = 8 << 20
HOT_CORE = 20_000

BASE = np.uint64(0x5851F42D4C957F2D)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
MIX = np.uint64(0xD6E8FEB86659FD93)


# --- rolling hashes and anchors -------------------------------------------------------------------------------------

@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64."""
    up = np.full(n, BASE, np.uint64)
    down = np.full(n, INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@lru_cache(4)
def _byte_values(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


class Rolling:
    """Hashes of any substrings of an array of bytes."""

    def __init__(self, data: np.ndarray, seed: int):
        size = max(SEGMENT * 2, len(data) + 1)
        self.up, self.down = _powers(1 << (size - 1).bit_length())
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values(seed)[data] * self.up[:len(data)], out=self.prefix[1:])

    def __call__(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return _mixed((self.prefix[end] - self.prefix[start]) * self.down[start])


def _sliding_min(keys: np.ndarray, window: int) -> np.ndarray:
    """Least of each ``window`` neighbours, by minima running forwards and backwards in blocks."""
    n = len(keys) - window + 1
    full = np.full(-(-len(keys) // window) * window, np.iinfo(np.uint64).max, np.uint64)
    full[:len(keys)] = keys
    blocks = full.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[window - 1:window - 1 + n])


def segments(texts: Iterable[bytes], length: int, reach: int = 0) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text, offset, bytes) of about SEGMENT bytes; long texts in pieces that overlap by length - 1, or by
    reach - 1 if that is more."""
    reach = max(length, reach)
    held, size = [], 0
    for k, t in enumerate(texts):
        for a in range(0, max(0, len(t) - length) + 1, SEGMENT):
            piece = t[a:a + SEGMENT + reach - 1]
            if len(piece) < length:
                continue
            if held and size + len(piece) > SEGMENT + reach:
                yield held
                held, size = [], 0
            held.append((k, a, piece))
            size += len(piece)
    if held:
        yield held


class Shape:
    """Sizes that go together; smaller ones serve tests. ``shorter``: a second length, found along with ``length``."""

    def __init__(self, length: int = LENGTH, window: int = WINDOW, kmer: int = KMER, shorter: int | None = None):
        if shorter is not None and shorter >= length:
            raise ValueError("the second length must be the shorter one")
        self.lengths = (length,) if shorter is None else (length, shorter)
        self.least = min(self.lengths)
        if window + kmer - 1 > self.least:
            raise ValueError("a string must hold all k-mers of a window")
        self.length, self.window, self.kmer, self.core = length, window, kmer, self.least - window + 1


def anchors(group: list[tuple[int, int, bytes]], shape: Shape) -> dict[str, np.ndarray]:
    """Of a group of pieces: text, anchor, first and last place, the context's end, the core's head and hash, the
    context's two hashes."""
    data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
    edges = np.cumsum([0] + [len(p) for _, _, p in group])
    first = Rolling(data, 1)
    n = len(data) - shape.kmer + 1
    low = np.uint64((1 << 24) - 1)
    place = np.arange(n, dtype=np.uint64)
    keys = (first(slice(0, n), slice(shape.kmer, shape.kmer + n)) & ~low) | place
    chosen = (_sliding_min(keys, shape.window) & low).astype(np.int64)
    # places whose string lies inside its piece
    places = np.minimum(np.diff(edges) - shape.least + 1, SEGMENT)
    starts = np.concatenate([np.arange(a, a + m) for a, m in zip(edges[:-1], places, strict=True)])
    piece = np.repeat(np.arange(len(group)), places)
    at = chosen[starts]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])]))
    last = np.append(new[1:], len(at)) - 1
    a, lo, hi, own = at[new], starts[new], starts[last], piece[new]
    second = Rolling(data, 2)
    end = np.minimum(hi + shape.length, edges[1:][own])
    extra = ((a - lo).astype(np.uint64) << np.uint64(48)) | ((hi - lo).astype(np.uint64) << np.uint64(32)) | (end - lo).astype(np.uint64)
    eight = np.zeros(len(a), np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | (data[a + k] if shape.core >= 8 else np.uint64(0))
    base = np.array([offset for _, offset, _ in group])[own] - edges[own]
    return {"text": np.array([k for k, _, _ in group])[own], "a": a + base, "lo": lo + base, "hi": hi + base, "end": end + base,
            "head": (eight ^ np.uint64(1 << 63)).view(np.int64), "core": first(a, a + shape.core).view(np.int64),
            "h1": _mixed(first(lo, end) ^ extra).view(np.int64), "h2": _mixed(second(lo, end) + extra).view(np.int64)}


# --- merging ----------------------------------------------------------------------------------------------------------

def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Bytes that a and b share, ``known`` of which are known to."""
    n, step = min(len(a), len(b)), 16
    while known < n:
        z = min(n, known + step)
        if a[known:z] == b[known:z]:
            known = z
            step *= 4
            continue
        while a[known] == b[known]:
            known += 1
        return known
    return n


def front_coded(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Bytes shared with the string before, and the rest, of sorted strings."""
    shared, before = [], b""
    for s in strings:
        shared.append(common_prefix(before, s, 0))
        before = s
    return shared, [s[n:] for s, n in zip(strings, shared, strict=True)]


def merged(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[tuple[int, int]], list[int], list[bytes]]:
    """(run, place in it) in the order of the strings, the bytes each shares with the one before, the strings.

    The tree's inner nodes hold losers. Every head knows how many bytes it shares with the winner that left last; of
    two heads the one that shares more is the lesser, and only heads that share equally many are compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    ended = (-1, b"", -1)
    place = [0] * k
    heads = [(0, r[1][0], i) if r[1] else ended for i, r in enumerate(runs)] + [ended] * (k - len(runs))

    def play(x: tuple[int, bytes, int], y: tuple[int, bytes, int]) -> tuple[tuple, tuple]:
        """(winner, loser); the loser's number is what it shares with the winner if that is what decided."""
        if x[0] != y[0]:
            return (x, y) if x[0] > y[0] else (y, x)
        if x[2] < 0:
            return x, y
        n = common_prefix(x[1], y[1], x[0])
        a, b = x[1][n:n + 1], y[1][n:n + 1]
        if a < b or a == b and x[2] < y[2]:
            return x, (n, y[1], y[2])
        return y, (n, x[1], x[2])

    tree: list[tuple[int, bytes, int]] = [ended] * k
    level = heads
    width = k
    while width > 1:
        width //= 2
        nxt = []
        for i in range(width):
            win, tree[width + i] = play(level[2 * i], level[2 * i + 1])
            nxt.append(win)
        level = nxt
    top = level[0]
    order, shared, strings = [], [], []
    while top[2] >= 0:
        n, s, i = top
        at = place[i]
        order.append((i, at))
        shared.append(n)
        strings.append(s)
        place[i] = at = at + 1
        run = runs[i]
        top = (run[0][at], s[:run[0][at]] + run[1][at], i) if at < len(run[0]) else ended
        node = (k + i) // 2
        while node:
            top, tree[node] = play(top, tree[node])
            node //= 2
    return order, shared, strings


def repeated_places(shared: np.ndarray, lefts: list[bytes], limits: dict[int, tuple[np.ndarray, np.ndarray]],
                    shape: Shape) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For suffixes in order (bytes shared with the one before, bytes before each anchor, for each length the offsets that
    its places have): by length, the least and the greatest offset at which its string equals another suffix's; greatest
    -1 if there is none."""
    n = len(lefts)
    reach = shape.window
    back = np.zeros((n, reach), np.uint8)
    for i, s in enumerate(lefts):
        back[i, :len(s)] = np.frombuffer(s, np.uint8)[::-1]
    rows = np.ascontiguousarray(back).view(f"S{reach}").ravel() if reach else None
    order = np.argsort(rows, kind="stable")
    sorted_ = back[order]
    unlike = sorted_[1:] != sorted_[:-1]
    agree = np.where(unlike.any(axis=1), unlike.argmax(axis=1), reach) if n > 1 else np.empty(0, int)
    left_of = np.empty(n, np.int64)
    found = {}
    for length, (least, most) in limits.items():
        low, high = np.full(n, reach + 1), np.full(n, -1)
        for o in range(int(least.min()), int(most.max()) + 1):
            ok = np.flatnonzero((least <= o) & (o <= most))
            if len(ok) < 2:
                continue
            right = np.cumsum(shared < length - o)
            left_of[order] = np.concatenate([[0], np.cumsum(agree < o)])
            key = right[ok] * np.int64(n + 1) + left_of[ok]
            by = np.argsort(key, kind="stable")
            same = key[by][1:] == key[by][:-1]
            hit = ok[np.unique(np.concatenate([by[1:][same], by[:-1][same]]))]
            low[hit] = np.minimum(low[hit], o)
            high[hit] = o
        found[length] = low, high
    return found


# --- jobs -------------------------------------------------------------------------------------------------------------

def _block(doc_id: Column, tie: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(doc_id, F.lit(0).cast("long")), tie), F.lit(n)).cast("int")


POINTER = "doc_id long, tie long, a int, lo int, hi int, end int"
SPAN = "doc_id long, tie long, length int, start long, end long"


def all_anchors(rows: DataFrame, shape: Shape) -> DataFrame:
    """Every anchor of (doc_id, tie, text)."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.encode("utf-8") for t in texts_of(batch.column("text")))
            for group in segments(texts, shape.least, shape.length):
                x = anchors(group, shape)
                index = pa.array(x["text"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(index), batch.column("tie").take(index),
                     *(pa.array(x[c].astype(np.int32)) for c in ("a", "lo", "hi", "end")), *(pa.array(x[c]) for c in ("head", "core", "h1", "h2"))],
                    ["doc_id", "tie", "a", "lo", "hi", "end", "head", "core", "h1", "h2"])

    return map_arrow(rows, found, f"{POINTER}, head long, core long, h1 long, h2 long")


def _texts(left: pa.Table) -> dict[tuple[int | None, int], bytes]:
    keys = zip(left.column("doc_id").to_pylist(), left.column("tie").to_pylist(), strict=True)
    return {k: (t or "").encode("utf-8") for k, t in zip(keys, left.column("text").to_pylist(), strict=True)}


def _pointers(table: pa.Table) -> list[tuple]:
    return list(zip(*(table.column(c).to_pylist() for c in ("doc_id", "tie", "a", "lo", "hi", "end")), strict=True))


def ranges_of(heads: np.ndarray, cores: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Number of each suffix's range. A border that repeats is a head with several ranges' suffixes: they are dealt over
    as many ranges by core, as only suffixes of one core are compared."""
    low, high = np.searchsorted(borders, heads, "left"), np.searchsorted(borders, heads, "right")
    return high - np.where(high > low, (cores.view(np.uint64) % np.maximum(high - low, 1).astype(np.uint64)).astype(np.int64), 0)


def sorted_runs(blocks: DataFrame, chosen: DataFrame, cuts: list[int], shape: Shape) -> DataFrame:
    """A row for each block and range: the block's suffixes in the range, front-coded, with what a merge needs."""
    borders = np.array(cuts, np.int64)
    columns = {"shared": pa.int32(), "rest": pa.binary(), "left": pa.binary(), "doc_id": pa.int64(), "tie": pa.int64(),
               "a": pa.int32(), "lo": pa.int32(), "hi": pa.int32(), "end": pa.int32()}

    def runs(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = _texts(left)
        rows = []
        for p, r in zip(_pointers(right), ranges_of(right.column("head").to_numpy(), right.column("core").to_numpy(), borders).tolist(), strict=True):
            doc_id, tie, a, lo, _, end = p
            t = texts[doc_id, tie]
            rows.append((r, t[a:end], t[lo:a], p))
        rows.sort(key=lambda x: x[:2])
        out: dict[str, list] = {c: [] for c in ("range", *columns)}
        i = 0
        while i < len(rows):
            j = i
            while j < len(rows) and rows[j][0] == rows[i][0]:
                j += 1
            part = rows[i:j]
            shared, rest = front_coded([x[1] for x in part])
            out["range"].append(part[0][0])
            for c, v in zip(columns, (shared, rest, [x[2] for x in part], *zip(*(x[3] for x in part), strict=True)), strict=True):
                out[c].append(list(v))
            i = j
        return pa.table({"range": pa.array(out["range"], pa.int32()), **{c: pa.array(out[c], pa.list_(t)) for c, t in columns.items()}})

    kinds = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary"}
    schema = "range int, " + ", ".join(f"{c} array<{kinds[t]}>" for c, t in columns.items())
    return blocks.groupBy("block").cogroup(chosen.groupBy("block")).applyInArrow(runs, schema)


def merged_spans(runs: DataFrame, shape: Shape) -> DataFrame:
    """(doc_id, tie, length, start, end) of what repeats among the suffixes of each range; a shorter length's spans only
    where they aren't inside the longer one's."""
    kinds = {"doc_id": pa.int64(), "tie": pa.int64(), "length": pa.int32(), "start": pa.int64(), "end": pa.int64()}

    def spans(table: pa.Table) -> pa.Table:
        lists = {c: table.column(c).to_pylist() for c in table.column_names if c != "range"}
        order, shared, _ = merged(list(zip(lists["shared"], lists["rest"], strict=True)))
        shared = np.array(shared)
        shared[0] = 0
        # alone with its core: nothing to compare
        close = shared >= shape.core
        with_next = np.append(close[1:], False)
        keep = np.flatnonzero(close | with_next)
        if not len(keep):
            return pa.table({c: pa.array([], t) for c, t in kinds.items()})
        pick = [order[i] for i in keep]
        get = lambda c: [lists[c][r][i] for r, i in pick]
        a, lo, hi, end = (np.array(get(c), np.int64) for c in ("a", "lo", "hi", "end"))
        # the last places of a text have no long string
        limits = {n: (a - np.minimum(hi, end - n), a - lo) for n in shape.lengths}
        ids, ties, parts = get("doc_id"), get("tie"), []
        start, stop = np.full(len(a), np.iinfo(np.int64).max), np.full(len(a), -1)
        for n, (low, high) in repeated_places(np.where(close[keep], shared[keep], 0), get("left"), limits, shape).items():
            new = (high >= 0) & ((a - high < start) | (a - low + n > stop))      # not inside the longer length's
            hit = np.flatnonzero(new)
            start, stop = np.where(new, a - high, start), np.where(new, a - low + n, stop)
            cols = [[ids[i] for i in hit], [ties[i] for i in hit], np.full(len(hit), n), start[hit], stop[hit]]
            parts.append(pa.table({c: pa.array(x, t) for (c, t), x in zip(kinds.items(), cols, strict=True)}))
        return pa.concat_tables(parts)

    return runs.groupBy("range").applyInArrow(spans, SPAN)


def hashed_spans(blocks: DataFrame, chosen: DataFrame, shape: Shape) -> DataFrame:
    """The same for contexts of hot cores: every string's hash, counted by aggregation."""
    kinds = {"doc_id": pa.int64(), "tie": pa.int64(), "length": pa.int32(), "start": pa.int64(), "h1": pa.int64(), "h2": pa.int64()}

    def strings(left: pa.Table, right: pa.Table) -> pa.Table:
        texts = _texts(left)
        out: dict[str, list] = {c: [] for c in kinds}
        for doc_id, tie, _, lo, hi, end in _pointers(right):
            data = np.frombuffer(texts[doc_id, tie][lo:end], np.uint8)
            hashes = [Rolling(data, s) for s in (1, 2)]
            for n in shape.lengths:
                starts = np.arange(max(0, min(hi, end - n) - lo + 1))
                h1, h2 = (h(starts, starts + n).view(np.int64) for h in hashes)
                for c, x in zip(kinds, ([doc_id] * len(starts), np.full(len(starts), tie), np.full(len(starts), n), starts + lo, h1, h2), strict=True):
                    out[c].append(pa.array(x, kinds[c]))
        return pa.table({c: pa.chunked_array(out[c], t) for c, t in kinds.items()})

    every = blocks.groupBy("block").cogroup(chosen.groupBy("block")).applyInArrow(strings, "doc_id long, tie long, length int, start long, h1 long, h2 long")
    every = materialize(every, "suffix-hot")
    twice = every.groupBy("length", "h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").select("length", "h1", "h2")
    return every.join(twice, ["length", "h1", "h2"]).select("doc_id", "tie", "length", "start", (F.col("start") + F.col("length")).alias("end"))


def repeated_spans(docs: DataFrame, shape: Shape, text: str = "text", hot_core: int = HOT_CORE,
                   carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(blocks of documents, spans): spans (block, doc_id, tie, length, start, end) of at least a length cover all that
    repeats at it, in bytes."""
    spark = docs.sparkSession
    ship(spark)
    body = F.col(text).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("tie"), body.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size) // BLOCK_BYTES + 1
    block = _block(F.col("doc_id"), F.col("tie"), n)
    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("tie"), body.alias("text"),
                         *(F.col(c).alias(f"carry_{c}") for c in carry)).withColumn("block", block)

    every = materialize(all_anchors(rows, shape), "suffix-anchors")
    # written first, so that the join has its own shuffle, whose large partitions can be split
    twice = materialize(every.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core"), "suffix-twice")
    close = materialize(every.join(twice, "core"), "suffix-close")
    discard(every)
    discard(twice)
    contexts = close.groupBy("h1", "h2", "core").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "tie", "a", "lo", "hi", "end", "head")).alias("one"))
    contexts = materialize(contexts, "suffix-contexts")
    copies = contexts.filter("n > 1").select("h1", "h2")
    whole = close.join(copies, ["h1", "h2"])
    whole = whole.withColumn("length", F.when(F.expr("end - lo") >= shape.length, shape.length).otherwise(shape.least))
    whole = whole.select("doc_id", "tie", "length", F.col("lo").cast("long").alias("start"), F.least(F.col("hi") + F.col("length"), "end").cast("long").alias("end"))

    per_core = materialize(contexts.groupBy("core").agg(F.count("*").alias("m")).filter("m > 1"), "suffix-cores")
    one = contexts.join(per_core, "core").select("one.*", "core", "m").withColumn("block", block)
    one = materialize(one, "suffix-different")
    cold = one.filter(F.col("m") <= hot_core)
    count = cold.count()
    ranges = int(count * (2 * shape.length) // RANGE_BYTES + 1)
    cuts = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cuts = sorted(cold.agg(F.percentile_approx("head", shares, 10 * ranges)).first()[0])
    spans = whole
    if count:
        spans = spans.unionByName(merged_spans(sorted_runs(blocks, cold, cuts, shape), shape))
    hot = one.filter(F.col("m") > hot_core)
    if not hot.isEmpty():
        spans = spans.unionByName(hashed_spans(blocks, hot, shape))
    return blocks, spans.select(block.alias("block"), "doc_id", "tie", "length", "start", "end")


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def dedup(docs: DataFrame, length: int = LENGTH, text: str = "text", with_text: bool = False, shape: Shape | None = None,
          hot_core: int = HOT_CORE, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, tie, n_bytes, n_removed, n_spans, kept_sha256) for every row, with ``with_text`` also what is left: its
    bytes read as UTF-8, bytes of characters cut in two left out. With a shorter length in ``shape`` also
    (passage_removed, passage_spans), and with ``with_text`` text_without_passages: the same for its strings, judged on
    the input as well. ``carry``: columns of ``docs`` to hand through."""
    shape = shape or Shape(length)
    blocks, spans = repeated_spans(docs, shape, text, hot_core, carry)
    named = list(zip(shape.lengths, (("n_removed", "n_spans", "text"), ("passage_removed", "passage_spans", "text_without_passages")), strict=False))
    kinds = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}
    for _, (removed, runs, rest) in named:
        kinds |= {removed: "long", runs: "long"} | ({rest: "string"} if with_text else {})
    schema = "doc_id long, tie long" + "".join(f", {c} {k}" for c, k in kinds.items())
    schema += "".join(f", `carry_{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        by: dict[tuple, list[tuple[int, int, int]]] = {}
        for i, t, n, a, z in zip(*(right.column(c).to_pylist() for c in ("doc_id", "tie", "length", "start", "end")), strict=True):
            by.setdefault((i, t), []).append((n, a, z))
        out: dict[str, list] = {c: [] for c in kinds}
        for i, t, s in zip(*(left.column(c).to_pylist() for c in ("doc_id", "tie", "text")), strict=True):
            raw = (s or "").encode("utf-8")
            out["n_bytes"].append(len(raw))
            for n, (removed, runs, rest) in named:
                gone = _union([(a, z) for m, a, z in by.get((i, t), ()) if m >= n])
                edges = [0, *(x for g in gone for x in g), len(raw)]
                left_over = b"".join(raw[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))
                out[removed].append(len(raw) - len(left_over))
                out[runs].append(len(gone))
                if n == shape.length:
                    out["kept_sha256"].append(hashlib.sha256(left_over).hexdigest())
                if with_text:
                    out[rest].append(left_over.decode("utf-8", "ignore") if s is not None else None)
        table = {"doc_id": left.column("doc_id"), "tie": left.column("tie"),
                 **{c: pa.array(out[c], pa.int64() if k == "long" else pa.string()) for c, k in kinds.items()}}
        return pa.table(table | {f"carry_{c}": left.column(f"carry_{c}") for c in carry})

    found = blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(cut, schema)
    return found.withColumnsRenamed({f"carry_{c}": c for c in carry})
