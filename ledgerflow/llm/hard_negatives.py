"""Hard negatives by secondary sort: each anchor's scored rows arrive in descending order of score, and one pass over
that stream opens a window at every positive and emits the negatives that fall into it.

For each anchor the positives are its ``positives`` best rows of the same label; a positive's negatives are the first
``negatives`` rows of another label whose score lies between ``low`` and ``high`` percent of the positive's score.

Scores are taken block against block: rows and anchors are dealt by hash into blocks of bounded size, every pair of
blocks is one task's group (an integer matrix product). A block sends an anchor's rows on only where they can matter:
first its best rows of the same label, from which the positives follow; then, with the positives known, the first rows
inside each positive's window. What is left out is beaten inside its own block by rows that are sent, so nothing is lost.

What is sent is keyed (anchor, descending score, same label first, id, label, vector hash), dealt by anchor and sorted
inside the partitions (``repartition`` + ``sortWithinPartitions``, the DataFrame form of
repartitionAndSortWithinPartitions: the sort spills, no anchor is ever held). The stream holds one anchor's open windows.

Defined results: rows with a null id, label or vector or a null, NaN or infinite component take no part; rows equal in
id, label and vector count once; rows that share an id otherwise are rows of their own, ties between them by label, then
by the vector's hash. A shorter vector scores as if filled with zeros. Scores that leave 64 bits are held at its limits.
An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_arrow, ship
from ledgerflow.session import materialize

SCALE = 256
ANCHOR_EVERY, SHIFT_EVERY, LABELS = 50, 7, 10      # of the registered query
POSITIVES, NEGATIVES, LOW, HIGH = 5, 3, 50, 95

BLOCK_ROWS, BLOCK_BYTES = 4096, 32 << 20
_AT_ONCE = 2_000_000                                # scores held at a time
_LONG = np.iinfo(np.int64)
_SENT = "a_id long, a_label long, a_tie long, score long, other boolean, id long, label long, tie long"


def prepare(table: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
            scale: float = SCALE) -> DataFrame:
    """(id, label, q): rows that take part, components as floor(scale * x)."""
    x = F.col(vector)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * float(scale)))
    return (table.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False)))
            .select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), q.alias("q")))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _products(a: np.ndarray, b: np.ndarray):
    """Function (i, j) -> exact scores of a[i:j] with all of b: as doubles where they hold every integer, else as
    Python integers."""
    peak = [int(max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))) for m in (a, b)]
    if peak[0] * peak[1] * a.shape[1] < 1 << 53:
        a, b = a.astype(np.float64), b.T.astype(np.float64)
        return lambda i, j: a[i:j] @ b
    a, b = a.astype(object), b.T.astype(object)
    return lambda i, j: np.clip(a[i:j] @ b, _LONG.min, _LONG.max)


def _first(scores: np.ndarray, fits: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of the first k columns of every row by score, ties by column, among those that fit."""
    left = fits.copy()
    low = -math.inf if scores.dtype != object else _LONG.min - 1
    held = np.where(left, scores, low)
    at = np.arange(len(scores))
    for _ in range(k):
        best = held.argmax(axis=1)
        there = left[at, best]
        if not there.any():
            return
        yield at[there], best[there]
        held[at, best], left[at, best] = low, False


def _share(s, percent: int, up: bool = False):
    """floor (or ceiling) of percent * s / 100 without leaving 64 bits."""
    p = -percent if up else percent
    out = p * (s // 100) + (p * (s % 100)) // 100
    return -out if up else out


def _scored(positives: int, negatives: int, low: int, high: int, known: bool):
    """Group function (rows of a block, anchors of a block) -> what the block sends on: its best rows of the anchors' own
    labels or, with the positives ``known``, its first rows in every positive's window."""
    def group(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: dict[str, list] = {f.split()[0]: [] for f in _SENT.split(", ")}
        if rows.num_rows and anchors.num_rows:
            rows = rows.sort_by([("id", "ascending"), ("label", "ascending"), ("tie", "ascending")])
            sizes = [np.diff(t["q"].combine_chunks().offsets.to_numpy()).max(initial=1) for t in (rows, anchors)]
            r, a = (_matrix(t["q"], int(max(sizes))) for t in (rows, anchors))
            r_key, a_key = ([t[c].to_numpy() for c in ("id", "label", "tie")] for t in (rows, anchors))
            opened = anchors["scores"].to_pylist() if known else None
            product = _products(a, r)
            step = max(1, _AT_ONCE // len(r))
            for i in range(0, len(a), step):
                scores = product(i, i + step)
                mine = [c[i:i + step, None] for c in a_key]
                same = r_key[1] == mine[1]
                if known:
                    found = set()
                    for nth in range(positives):
                        s = np.array([p[nth] if nth < len(p) else 0 for p in opened[i:i + step]], dtype=object)
                        there = np.array([nth < len(p) for p in opened[i:i + step]])
                        lo, hi = ([int(_share(int(v), e, e == low)) for v in s] for e in (low, high))
                        if scores.dtype != object:
                            lo, hi = np.array(lo, dtype=np.float64), np.array(hi, dtype=np.float64)
                        else:
                            lo, hi = np.array(lo, dtype=object), np.array(hi, dtype=object)
                        fits = (scores >= lo[:, None]) & (scores <= hi[:, None])
                        for x, y in _first(scores, fits.astype(bool) & ~same & there[:, None], negatives):
                            found.update(zip(x.tolist(), y.tolist(), strict=True))
                    found = sorted(found)
                else:
                    own = same & (r_key[0] == mine[0]) & (r_key[2] == mine[2])
                    found = [p for x, y in _first(scores, same & ~own, positives) for p in zip(x.tolist(), y.tolist(), strict=True)]
                for x, y in found:
                    for name, v in zip(("a_id", "a_label", "a_tie"), a_key, strict=True):
                        out[name].append(int(v[i + x]))
                    for name, v in zip(("id", "label", "tie"), r_key, strict=True):
                        out[name].append(int(v[y]))
                    out["score"].append(int(scores[x, y]))
                    out["other"].append(known)
        types = {"other": pa.bool_()}
        return pa.table({k: pa.array(v, types.get(k, pa.int64())) for k, v in out.items()})
    return group


def windows(positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH):
    """Batch function over records sorted by anchor and descending score: opens a window at each of an anchor's first
    positives, emits the first negatives inside. State: the open windows of one anchor."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        anchor, opened = None, []
        for batch in batches:
            out = []
            for a_id, a_label, a_tie, score, other, one in zip(*(batch[c].to_pylist() for c in ("a_id", "a_label", "a_tie", "score", "other", "id")), strict=True):
                if (a_id, a_label, a_tie) != anchor:
                    anchor, opened, seen = (a_id, a_label, a_tie), [], 0
                if not other:
                    if seen < positives:
                        opened.append([_share(score, low, True), _share(score, high), 0, one, score])
                    seen += 1
                    continue
                opened = [w for w in opened if score >= w[0] and w[2] < negatives]      # later scores are no higher
                for w in opened:
                    if score <= w[1]:
                        w[2] += 1
                        out.append((a_id, w[3], w[2], one, w[4], score))
            columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
    return stream


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among ``rows``
    (id, label, q)."""
    ship(rows.sparkSession)
    table = rows.dropDuplicates().select("id", "label", "q", F.xxhash64("q").alias("tie"), is_anchor.alias("anchor"))
    table = materialize(table, "negatives-rows")
    n, n_anchors, width = table.agg(F.count("*"), F.coalesce(F.count_if("anchor"), F.lit(0)), F.coalesce(F.max(F.size("q")), F.lit(1))).first()
    held = max(64, min(block_rows, BLOCK_BYTES // (8 * max(1, width))))
    n_rows, n_cols = max(1, math.ceil(n / held)), max(1, math.ceil(n_anchors / held))
    dealt = lambda blocks, seed: F.pmod(F.xxhash64("id", "label", "tie", F.lit(seed)), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = table.select(dealt(n_rows, 0).alias("r"), every(n_cols).alias("c"), "id", "label", "tie", "q").groupBy("r", "c")
    anchors = table.filter("anchor").select(*(F.col(c).alias(c) for c in ("id", "label", "tie", "q")))
    blocks = lambda found: found.select("*", dealt(n_cols, 1).alias("c")).select("*", every(n_rows).alias("r")).groupBy("r", "c")

    key = ["a_id", "a_label", "a_tie"]
    first = left.cogroup(blocks(anchors)).applyInArrow(_scored(positives, negatives, low, high, False), _SENT)
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "id", "label", "tie"))
    best = materialize(first.withColumn("nth", nth).filter(F.col("nth") <= positives).drop("nth"), "negatives-positives")
    scores = best.groupBy(*key).agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
    scores = scores.withColumnsRenamed({"a_id": "id", "a_label": "label", "a_tie": "tie"})
    second = left.cogroup(blocks(anchors.join(scores, ["id", "label", "tie"]))).applyInArrow(_scored(positives, negatives, low, high, True), _SENT)
    keyed = best.unionByName(second).repartition(*key)
    keyed = keyed.sortWithinPartitions(*key, F.desc("score"), "other", "id", "label", "tie")
    return map_arrow(keyed, windows(positives, negatives, low, high),
                     "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def shifted_labels(rows: DataFrame) -> DataFrame:
    """Rows whose id ``SHIFT_EVERY`` divides take the next label."""
    moved = F.pmod(F.col("label") + 1, F.lit(LABELS))
    return rows.withColumn("label", F.when(F.col("id") % SHIFT_EVERY == 0, moved).otherwise(F.col("label")))


HARD_NEGATIVES_SQL = f"""
with e as (select vec_id, case when vec_id % {SHIFT_EVERY} = 0 then (label + 1) % {LABELS} else label end as label,
    list_transform(embedding, lambda x: floor({SCALE} * x::double)) as q from embeddings
    where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_dot_product(a.q, b.q)::bigint as score
    from e a join e b on a.vec_id <> b.vec_id where a.vec_id % {ANCHOR_EVERY} = 0),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES})
select p.anchor_id, positive_id, cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
    vec_id as negative_id, positive_score, score as negative_score
from p join s on s.anchor_id = p.anchor_id and not same
    and {LOW} * positive_score <= 100 * score and 100 * score <= {HIGH} * positive_score
qualify rank <= {NEGATIVES}
"""
