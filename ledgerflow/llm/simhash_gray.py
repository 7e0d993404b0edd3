"""SimHash near duplicates by a Gray-order hierarchical index.

Fingerprint: ASCII letters lower-cased, words, shingles of ``words`` words joined by one space, repeats included (fewer
words: the whole sequence; none: fingerprint zero). Bit i is 1 if more than half of the shingles' XXH64 (seed 42) have
it. Fingerprints link at ``bits`` or fewer differing bits; a document's component is what links reach.

Index, over distinct fingerprints (equal texts fall together before anything is compared):
* Upper nodes are shared masked bit patterns. The 64 bits are cut into ``bits + 2`` fields; fingerprints within
  ``bits`` bits agree in two fields at least, so each one goes to one node for every pair of fields, named by the two
  fields' content. Nodes are dealt over the cluster by that name; nothing is compared outside its node.
* Inside a node the fingerprints stand in Gray order (the rank of a fingerprint read as a Gray code), so neighbours
  differ in few bits. Every ``FAN`` neighbours have a parent that keeps the bits all below it share (mask and pattern),
  and so on upwards. Two groups whose shared patterns differ in more than ``bits`` bits are pruned whole; two whose
  difference cannot exceed ``bits`` whatever the open bits are are linked whole; only the rest is opened.
* A node of more than ``HOT_NODE`` fingerprints is cut into runs by hash, and every two runs are a task of their own.
What leaves a node is a spanning forest of its links, never all pairs. Components come from alternating large-star and
small-star steps over these edges, each written to the shared folder.

Defined results: a null text counts as empty; null ids are never a component's name unless all its ids are null;
repeated rows and ties give one row each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_arrow, texts_of
from ledgerflow.session import materialize

WORDS = 5
BITS = 3
FAN = 16
SMALL_NODE = 64
HOT_NODE = 20_000
PAIRS_AT_ONCE = 1 << 20
MAX_ROUNDS = 60


# --- fingerprints ---------------------------------------------------------------------------------------------------

def fingerprints_of(texts: list[str], words: int) -> np.ndarray:
    """Fingerprints of texts as unsigned 64-bit integers; bits are counted over blocks of shingles."""
    from xxhash import xxh64_intdigest

    out = np.zeros(len(texts), np.uint64)
    hashes: list[np.ndarray] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if owners:
            sizes = np.array([len(h) for h in hashes])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            bits = np.unpackbits(np.concatenate(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
            packed = np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little")
            out[owners] = packed.reshape(-1).view(np.uint64)
        hashes.clear()
        owners.clear()
        held = 0

    for k, t in enumerate(texts):
        parts = t.encode("utf-8").lower().split()
        n = len(parts)
        if not n:
            continue
        if n <= words:
            out[k] = xxh64_intdigest(b" ".join(parts), 42)
            continue
        joined = b" ".join(parts)
        ends = np.cumsum([len(p) + 1 for p in parts])
        starts = np.concatenate([[0], ends[:-words]])
        found = [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts.tolist(), (ends[words - 1:] - 1).tolist(), strict=True)]
        if len(found) > 1 << 20:                  # a very long text is counted by itself, in blocks
            ones, h = np.zeros(64, np.int64), np.array(found, np.uint64)
            for a in range(0, len(h), 1 << 18):
                ones += np.unpackbits(h[a:a + (1 << 18)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[k] = np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0]
            continue
        hashes.append(np.array(found, np.uint64))
        owners.append(k)
        held += len(found)
        if held > 1 << 18:
            flush()
    flush()
    return out


def fingerprints(docs: DataFrame, words: int = WORDS, text: str = "text") -> DataFrame:
    """(doc_id, tie, fp): fp as a signed long; tie, a hash of the text, tells rows of one id apart."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprints_of(texts_of(batch.column("text")), words)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(fp.view(np.int64))],
                                             ["doc_id", "tie", "fp"])

    body = F.col(text).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("tie"), body.alias("text"))
    return map_arrow(rows, hashed, "doc_id long, tie long, fp long")


# --- one node of the index ------------------------------------------------------------------------------------------

class Forest:
    """Components of 0..n-1, as the smallest member of each."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            open_ = ra != rb
            if not open_.any():
                return
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def index_levels(fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(all-ones AND, all-zeros OR) of the groups of each level, leaves' parents first, up to FAN * 4 groups."""
    both, any_, out = fps, fps, []
    while len(both) > 4 * FAN or not out:
        starts = np.arange(0, len(both), FAN)
        both, any_ = np.bitwise_and.reduceat(both, starts), np.bitwise_or.reduceat(any_, starts)
        out.append((both, any_))
    return out


def node_links(fps: np.ndarray, bits: int) -> np.ndarray:
    """Component (smallest index) of each fingerprint of a node in Gray order."""
    n, forest = len(fps), Forest(len(fps))
    levels = index_levels(fps)
    top = len(levels) - 1
    work = [(top, *np.triu_indices(len(levels[top][0])))]
    while work:
        level, a, b = work.pop()
        if len(a) > PAIRS_AT_ONCE:
            half = len(a) // 2
            work += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
            continue
        span = FAN ** (level + 1)
        both, any_ = levels[level]
        open_ = (both ^ any_)[a] | (both ^ any_)[b]     # bits that one of the groups leaves open
        base = (both[a] ^ both[b]) & ~open_
        whole = np.bitwise_count(base | open_) <= bits
        for x, y in zip(a[whole].tolist(), b[whole].tolist(), strict=True):
            members = np.concatenate([np.arange(x * span, min(n, (x + 1) * span)), np.arange(y * span, min(n, (y + 1) * span))])
            forest.link(members[:-1], members[1:])
        opened = (np.bitwise_count(base) <= bits) & ~whole
        a, b = a[opened], b[opened]
        step = PAIRS_AT_ONCE // (FAN * FAN)
        size = n if level == 0 else len(levels[level - 1][0])
        for k in range(0, len(a), step):
            i = a[k:k + step, None, None] * FAN + np.arange(FAN)[None, :, None]
            j = b[k:k + step, None, None] * FAN + np.arange(FAN)[None, None, :]
            i, j = (x.ravel() for x in np.broadcast_arrays(i, j))
            ok = (i < size) & (j < size) & (i < j if level == 0 else i <= j)
            i, j = i[ok], j[ok]
            if level:
                work.append((level - 1, i, j))
                continue
            ok = forest.root[i] != forest.root[j]
            i, j = i[ok], j[ok]
            hit = differ(fps[i], fps[j]) <= bits
            forest.link(i[hit], j[hit])
    return forest.root


def small_nodes_links(node: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (index pairs) inside many small nodes at once; ``node`` is sorted."""
    found = []
    for step in range(1, SMALL_NODE):
        i = np.flatnonzero(node[step:] == node[:-step])
        if not len(i):
            break
        i = i[differ(fps[i], fps[i + step]) <= bits]
        found.append((i, i + step))
    if not found:
        return np.empty(0, int), np.empty(0, int)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


# --- the whole index ------------------------------------------------------------------------------------------------

def gray_rank(fp: Column) -> Column:
    """Rank of a fingerprint read as a Gray code (the prefix exclusive-or of its bits)."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def upper_nodes(fps: DataFrame, bits: int) -> DataFrame:
    """(node, shared, fp): every fingerprint under each of its shared masked bit patterns."""
    fields = bits + 2
    edges = [round(64 * k / fields) for k in range(fields + 1)]
    masks = [sum(1 << b for b in range(a, z)) for a, z in zip(edges[:-1], edges[1:], strict=True)]
    signed = [m - (1 << 64) if m >> 63 else m for m in (masks[a] | masks[b] for a, b in combinations(range(fields), 2))]
    nodes = F.array(*(F.struct(F.lit(k).alias("node"), F.col("fp").bitwiseAND(F.lit(m)).alias("shared")) for k, m in enumerate(signed)))
    return fps.select("fp", F.inline(nodes))


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b): edges between distinct fingerprints that span what the links within ``bits`` bits connect."""
    spark = fps.sparkSession
    dealt = upper_nodes(fps.select("fp"), bits)
    hot = materialize(dealt.groupBy("node", "shared").count().filter(F.col("count") > HOT_NODE), "simhash-hot")
    cold = dealt
    runs = None
    if not hot.isEmpty():
        # runs inside a hot node, dealt by hash; every two runs meet in one task, a run alone in (x, x)
        member = dealt.join(hot.withColumn("n", F.ceil(F.col("count") / (HOT_NODE // 2)).cast("int")), ["node", "shared"])
        run = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
        member = member.select("node", "shared", "fp", "n", run.alias("run"))
        other = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
        runs = member.select("node", "shared", "fp", "run", other.alias("other")).select(
            "node", "shared", F.least("run", "other").alias("x"), F.greatest("run", "other").alias("y"), "fp")
        cold = dealt.join(hot, ["node", "shared"], "left_anti")
    rows = cold.select("node", "shared", F.lit(0).alias("x"), F.lit(0).alias("y"), "fp")
    rows = rows.unionByName(runs) if runs is not None else rows
    size = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (rows.repartition(size, "node", "shared", "x", "y").withColumn("gray", gray_rank(F.col("fp")))
            .withColumn("gray", F.col("gray").bitwiseXOR(F.lit(-(1 << 63))))
            .sortWithinPartitions("node", "shared", "x", "y", "gray").select("node", "shared", "x", "y", "fp"))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def done(block: np.ndarray) -> pa.RecordBatch:
            """Edges of whole nodes; block: rows of (node, shared, x, y, fp)."""
            new = np.concatenate([[True], (block[1:, :4] != block[:-1, :4]).any(axis=1)])
            number = np.cumsum(new)
            fps = np.ascontiguousarray(block[:, 4]).view(np.uint64)
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(block)))
            a, b = small_nodes_links(np.where(np.repeat(sizes, sizes) <= SMALL_NODE, number, -np.arange(1, len(block) + 1)), fps, bits)
            ends = [(fps[a], fps[b])]
            for s, z in zip(starts[sizes > SMALL_NODE], sizes[sizes > SMALL_NODE], strict=True):
                own = fps[s:s + z]
                root = node_links(own, bits)
                linked = np.flatnonzero(root != np.arange(z))
                ends.append((own[linked], own[root[linked]]))
            u, v = (np.concatenate([e[k] for e in ends]).view(np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["a", "b"])

        for batch in batches:
            block = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in ("node", "shared", "x", "y", "fp")])
            if not len(block):
                continue
            last = np.flatnonzero((block[:, :4] != block[-1, :4]).any(axis=1))
            whole = int(last[-1]) + 1 if len(last) else 0
            if whole or held and (held[-1][-1, :4] != block[0, :4]).any():
                yield done(np.concatenate([*held, block[:whole]]))
                held = []
            held.append(block[whole:])
        if held:
            yield done(np.concatenate(held))

    return map_arrow(rows, searched, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root): root is the smallest fingerprint that the edges reach; fingerprints without edges are left out."""
    edges = materialize(edges.select("a", "b").filter("a != b"), "simhash-edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(down.select("a", F.col("m").alias("b"))).filter("a != b").distinct())
        edges = materialize(small, "simhash-edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    root = edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))
    return root.unionByName(root.select(F.col("root").alias("fp"), "root").distinct())


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS, text: str = "text") -> DataFrame:
    """(doc_id, tie, fp, root, component_id): component_id is the smallest doc_id of the document's component."""
    rows = materialize(fingerprints(docs, words, text), "simhash-fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    linked = components(links(distinct, bits))
    root = distinct.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = root.groupBy("root").agg(F.min("least").alias("component_id"))
    # one row a fingerprint on the right; a fingerprint that a third of all rows share is split by the skew join
    return rows.join(root.join(least, "root").select("fp", "root", "component_id"), "fp").select(
        "doc_id", "tie", "fp", "root", "component_id")


def documents_by_component(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """(doc_id, fingerprint, component_id), the fingerprint as 16 lower-case hexadecimal digits."""
    found = near_duplicates(docs, words, bits)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
