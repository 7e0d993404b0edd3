"""Quality classifier: an interpolated modified Kneser-Ney model of characters, trained on trusted text.

Trusted documents are those that ``labels`` calls of quality 1. One in ``FOLDS`` of them, by a hash of the id, is kept
from training and sets the thresholds (a document that the model has seen looks better than it is); the whole text of
all others is counted. The model is of order ``ORDER`` over characters (white
space is one blank, digits are one digit; every text is led by ``ORDER - 1`` pads). Characters rather than words,
because a word table of web size is larger than the text it came from while character n-grams stay far below it.

Counts are never gathered. Documents lie in blocks; a block asks for the distinct n-grams that its texts hold. One table,
dealt over the cluster by gram, has the counts of all orders of the n-grams that any block asks for and of their ends;
joined with their contexts' totals it gives each gram's probability before interpolation and the weight of the lower
order. The orders are then joined from the lowest up (an unseen gram takes its context's weight times the lower order's
probability, at last 1 / vocabulary), and every block gets the answers to its own questions. These joins are merge joins
at every size: a small input would send the tables through the driver. What a block holds is bounded by its own text;
tables that are used up are removed from the shared folder.

A document's perplexity is exp of its mean negative log probability a character. Such a mean varies less the longer the
document is; how much less is learned from the kept-back documents: of each language their median is the centre, and a
least-squares fit of the squared distances from it gives the variance a + b / length. Distances are measured in that
spread, and two quantiles of them, exactly over steps of ``STEP``, are the thresholds: the upper one of the kept-back
documents, the lower one of all trusted ones (the model has seen most, so theirs are the lowest). Nothing is added to
them but what a quantile of few documents lacks: below ``ENOUGH`` documents a language takes spread and quantiles
of all languages' distances together (each from its own centre), and if these are too few as well, at least Student's
quantile. A centre of n documents widens the spread by sqrt(1 + 1 / n). Documents whose language has no kept-back one
use centre, spread and quantiles of all of them.

``ORDER`` reaches over the blank, so that a word is judged by the end of the one before it. Loops of words stand out as
their mean hardly comes nearer the centre with length, while the spread that prose is allowed shrinks; a loop whose own
mean lies near the centre is kept, as no word order beyond four characters is seen. One order more takes twice the disk
and time for no better verdicts (README).

Defined results: a null text counts as empty; an empty text has no perplexity and is rejected; a null language is a
language of its own. A null id is never trusted. Ties and repeated rows give one row each (a label repeated counts once;
contradicting labels: trusted if any says so). With nothing to train on, or nothing kept back, nothing is rejected but empty texts. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import discard, map_arrow, ship, texts_of
from ledgerflow.session import fresh_dir, materialize

ORDER = 5
BLOCK_BYTES = 32 << 20
GROUP_CHARS = 500_000
DENSE = 1 << 23
STEP = 0.005
LOW_QUANTILE = 0.01
HIGH_QUANTILE = 0.99
ENOUGH = 100
LEAST_SPREAD = 1e-3
FOLDS = 5
PAD = "\x00"


# --- n-grams of a group of texts ------------------------------------------------------------------------------------

def _char_classes(codes: np.ndarray) -> np.ndarray:
    """White space to one blank, digits to 0; runs of blanks are shortened by the caller."""
    space = (codes == 32) | ((codes >= 9) & (codes <= 13)) | (codes == 0) | (codes == 0x85) | (codes == 0xA0) | (codes == 0x3000)
    digit = (codes >= 48) & (codes <= 57)
    return np.where(space, 32, np.where(digit, 48, codes)).astype(np.uint32)


def _ranks(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, place of each key among them), by a table while the keys' range allows one."""
    if size > DENSE:
        places, distinct = pd.factorize(keys)
        return distinct, places
    there = np.zeros(size, bool)
    there[keys] = True
    distinct = np.flatnonzero(there)
    rank = np.empty(size, np.int32)
    rank[distinct] = np.arange(len(distinct), dtype=np.int32)
    return distinct, rank[keys]


class Grams:
    """All n-grams of a group of texts: ``grams`` distinct strings, ``which`` one of them for each character, by text."""

    def __init__(self, texts: list[str], order: int):
        codes = _char_classes(np.frombuffer("\x01".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32))
        edge = np.cumsum([0] + [len(t) + 1 for t in texts])
        text = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(edge))[: len(codes)]
        keep = np.ones(len(codes), bool)
        keep[edge[1:-1] - 1] = False                                   # the joining character
        blank = codes == 32
        keep[1:] &= ~(blank[1:] & blank[:-1])
        codes, text = codes[keep], text[keep]
        sizes = np.bincount(text, minlength=len(texts))
        pads = order - 1
        total = len(codes) + pads * len(texts)
        padded = np.zeros(total, np.uint32)
        at = np.arange(len(codes)) + pads * (text + 1)
        padded[at] = codes
        del codes, text, keep, blank
        alphabet, one = _ranks(padded, 0x110000)
        k = len(alphabet)
        rank, steps = one, []
        for n in range(2, order + 1):
            keys = rank[:-1].astype(np.int64)
            keys *= k
            keys += one[n - 1:]
            distinct, rank = _ranks(keys, (len(steps[-1]) if steps else k) * k)
            steps.append(distinct)
        at -= pads
        self.which = rank[at].astype(np.int32, copy=False)
        del keys, rank, one, at, padded
        self.sizes = sizes
        used = np.bincount(self.which, minlength=len(steps[-1]))
        chars = np.empty((len(steps[-1]), order), np.uint32)
        place = np.arange(len(steps[-1]))
        for n in range(order - 1, 0, -1):
            step = steps[n - 1][place]
            chars[:, n], place = alphabet[step % k], step // k
        chars[:, 0] = alphabet[place]
        flat = chars.tobytes().decode("utf-32-le", "surrogatepass")
        self.grams = [flat[i:i + order] for i in range(0, len(flat), order)]
        self.counts = used                                             # 0: a gram across two texts' edge


def text_slices(column: pa.ChunkedArray) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of neighbouring rows of about GROUP_CHARS characters."""
    a, n = 0, 0
    sizes = pc.fill_null(pc.utf8_length(column), 0).to_pylist()
    for z, size in enumerate(sizes):
        if z > a and n + size > GROUP_CHARS:
            yield a, texts_of(column.slice(a, z - a))
            a, n = z, 0
        n += size
    if a < len(sizes):
        yield a, texts_of(column.slice(a))


# --- model ----------------------------------------------------------------------------------------------------------

def count_table(every: DataFrame, order: int) -> DataFrame:
    """(gram, n, c) of all orders 1 to ``order``: every gram that any text holds, with its count in the training texts
    (``every``: grams of the highest order), at the lower orders the number of different characters before it."""
    longer = every.select("gram", (F.col("c") > 0).alias("seen"))
    if order > 2:
        ends = F.explode(F.array(*(F.substring("gram", order - n + 1, n) for n in range(2, order))))
        ends = longer.select(ends.alias("gram"), "seen").groupBy("gram").agg(F.max("seen").alias("seen"))
        longer = longer.unionByName(ends)
    lower = longer.select(F.substring("gram", 2, order).alias("gram"), F.col("seen").cast("long").alias("c"))
    counts = lower.groupBy("gram").agg(F.sum("c").alias("c")).unionByName(every) if order > 1 else every
    return counts.select("gram", F.length("gram").alias("n"), "c")


def discounts(counts: DataFrame) -> DataFrame:
    """(n, d1, d2, d3): each order's discounts from its counts of counts."""
    n = [F.sum((F.col("c") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    got = counts.filter("c > 0").groupBy("n").agg(*n)
    y = F.when(F.col("n1") + 2 * F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)

    def d(k: int) -> Column:
        ratio = F.when(F.col(f"n{k}") > 0, F.col(f"n{k + 1}") / F.col(f"n{k}")).otherwise(F.lit(0.0))
        return F.least(F.lit(float(k) - 0.01), F.greatest(F.lit(0.1), k - (k + 1) * y * ratio)).alias(f"d{k}")

    return got.select("n", d(1), d(2), d(3))


def own_and_weight(counts: DataFrame, order: int) -> DataFrame:
    """(gram, n, own, weight): a gram's probability before interpolation and the weight that its context gives the lower
    order (an unseen context: all of it)."""
    found = {d["n"]: d for d in discounts(counts).collect()}           # three numbers an order
    each = [F.when(F.col("c") == 1, d["d1"]).when(F.col("c") == 2, d["d2"]).otherwise(d["d3"]) for _, d in sorted(found.items())]
    taken = F.coalesce(F.lit(None).cast("double"), *(F.when(F.col("n") == n, e) for n, e in zip(sorted(found), each, strict=True)))
    rows = counts.select("gram", "n", "c", F.expr("substring(gram, 1, n - 1)").alias("context"), taken.alias("d"))
    context = rows.filter("c > 0").groupBy("context").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("weight"))
    rows = rows.join(context.hint("merge"), "context", "left")
    own = F.when(F.col("c") > 0, (F.col("c") - F.col("d")) / F.col("total")).otherwise(F.lit(0.0))
    return rows.select("gram", "n", own.alias("own"), F.coalesce("weight", F.lit(1.0)).alias("weight"))


def probabilities(parts: DataFrame, order: int, vocabulary: int) -> DataFrame:
    """(gram, logp) of all grams of the highest order."""
    found = parts.filter("n = 1").select("gram", (F.col("own") + F.col("weight") / vocabulary).alias("p"))
    for n in range(2, order + 1):
        one = parts.filter(F.col("n") == n).withColumn("short", F.substring("gram", 2, order))
        lower = found.select(F.col("gram").alias("short"), F.col("p").alias("q"))
        found = one.join(lower.hint("merge"), "short").select("gram", (F.col("own") + F.col("weight") * F.col("q")).alias("p"))
    return found.select("gram", F.log("p").cast("float").alias("logp"))


# --- blocks of documents --------------------------------------------------------------------------------------------

def _bucketed(df: DataFrame, key: str) -> str:
    """Name of a table in the shared folder that holds ``df`` in buckets of ``key``."""
    spark = df.sparkSession
    name = f"kn_{key}_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.format("parquet").option("compression", "zstd").option("path", fresh_dir(spark, f"kn-{key}"))
     .bucketBy(buckets, key).saveAsTable(name))
    return name


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with the block of each row: runs of neighbours of a partition, ended at BLOCK_BYTES."""
    number, size = TaskContext.get().partitionId() << 33, 0
    for batch in batches:
        blocks = []
        for n in pc.fill_null(pc.binary_length(batch["text"]), 0).to_pylist():
            if size and size + n > BLOCK_BYTES:
                number, size = number + 1, 0
            size += n
            blocks.append(number)
        yield batch.add_column(0, "block", pa.array(blocks, pa.int64()))


def in_blocks(docs: DataFrame, text: str, lang: str) -> str:
    """Name of a bucketed table (block, doc_id, tie, lang, text) in the shared folder; a block holds at most BLOCK_BYTES
    of text or one text."""
    body = F.col(text).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("tie"), F.col(lang).cast("string").alias("lang"), body.alias("text"))
    return _bucketed(map_arrow(rows, _numbered, "block long, doc_id long, tie long, lang string, text string"), "block")


def block_grams(table: str, trusted: DataFrame, order: int) -> DataFrame:
    """(block, gram, c): the distinct n-grams of each block and how often its training texts have them."""
    def grams(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        ids = set(right.column("doc_id").to_pylist())
        doc_ids, found = left.column("doc_id").to_pylist(), {}
        for a, texts in text_slices(left.column("text")):
            g = Grams(texts, order)
            trained = np.repeat([i in ids for i in doc_ids[a:a + len(texts)]], g.sizes)
            for gram, n, c in zip(g.grams, g.counts.tolist(), np.bincount(g.which[trained], minlength=len(g.grams)).tolist(), strict=True):
                if n:
                    found[gram] = found.get(gram, 0) + c
        return pa.table({"block": pa.array([key[0].as_py()] * len(found), pa.int64()), "gram": pa.array(found.keys(), pa.string()),
                         "c": pa.array(found.values(), pa.int64())})

    spark = trusted.sparkSession
    ids = spark.table(table).select(F.col("block").alias("b"), F.col("doc_id").alias("i")).join(trusted, F.col("i") == F.col("doc_id"))
    ids = ids.select(F.col("b").alias("block"), F.col("i").alias("doc_id"))
    return spark.table(table).groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(grams, "block long, gram string, c long")


def scored(blocks: DataFrame, answers: DataFrame, order: int) -> DataFrame:
    """(doc_id, tie, lang, n_chars, log_perplexity); answers: (block, gram, logp)."""
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        logp = dict(zip(right.column("gram").to_pylist(), right.column("logp").to_pylist(), strict=True))
        chars, mean = np.zeros(len(left), np.int64), np.full(len(left), np.nan)
        for a, texts in text_slices(left.column("text")):
            g, z = Grams(texts, order), a + len(texts)
            each = np.array([logp.get(x, 0.0) for x in g.grams])[g.which]
            owner = np.repeat(np.arange(z - a), g.sizes)
            chars[a:z] = g.sizes
            mean[a:z] = -np.bincount(owner, each, z - a) / np.maximum(g.sizes, 1)
        return pa.table({"doc_id": left.column("doc_id"), "tie": left.column("tie"), "lang": left.column("lang"),
                         "n_chars": pa.array(chars), "log_perplexity": pa.array([m if n else None for m, n in zip(mean.tolist(), chars, strict=True)], pa.float64())})

    schema = "doc_id long, tie long, lang string, n_chars long, log_perplexity double"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema)


# --- operator -------------------------------------------------------------------------------------------------------

def quantiles(values: DataFrame, shares: dict[str, float]) -> DataFrame:
    """(key, n, and a column for each of ``shares``) of rows (key, x)."""
    cells = values.select("key", F.floor(F.col("x") / STEP).alias("step")).filter("step is not null").groupBy("key", "step").count()
    upto = Window.partitionBy("key").orderBy("step")          # steps of a bounded range, not rows
    share = F.sum("count").over(upto.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("count").over(Window.partitionBy("key"))
    found = cells.withColumn("share", share).groupBy("key").agg(
        *(F.min(F.when(F.col("share") >= q, F.col("step"))).alias(c) for c, q in shares.items()), F.sum("count").alias("n"))
    # a lower bound is its step's lower edge, an upper one the upper edge, the median the middle
    edge = lambda q: 0.0 if q < 0.5 else 1.0 if q > 0.5 else 0.5
    return found.select("key", "n", *(((F.col(c) + edge(q)) * STEP).alias(c) for c, q in shares.items()))


def student(share: float, n: Column) -> Column:
    """About Student's quantile for n documents (n - 1 degrees of freedom), without bound for one."""
    z = NormalDist().inv_cdf(share)
    return F.when(n > 1, z * (1 + (z * z + 1) / (4 * (n - 1)))).otherwise(F.lit(float("inf")))


def _by_lang(rows: DataFrame, of: DataFrame, how: str) -> DataFrame:
    return rows.join(of.withColumnRenamed("lang", "of_lang"), F.col("lang").eqNullSafe(F.col("of_lang")), how).drop("of_lang")


def spreads(distances: DataFrame, *keys: str) -> DataFrame:
    """(keys, a, b): the variance a + b / n_chars of rows (n_chars, d), by least squares weighed with the length."""
    w, u, r = F.col("n_chars").cast("double"), 1 / F.col("n_chars"), F.col("d") * F.col("d")
    s = distances.groupBy(*keys).agg(F.sum(w).alias("w"), F.sum(w * u).alias("u"), F.sum(w * u * u).alias("uu"),
                                     F.sum(w * r).alias("r"), F.sum(w * u * r).alias("ur"))
    w, u, uu, r, ur = (F.col(c) for c in ("w", "u", "uu", "r", "ur"))
    det = w * uu - u * u
    b = F.when(det > 1e-9 * w * uu, (w * ur - u * r) / det).otherwise(r / u)
    a = F.when(det > 1e-9 * w * uu, (uu * r - u * ur) / det).otherwise(F.lit(0.0))
    # a negative part means that the other one alone fits best
    both = F.when(b < 0, F.struct((r / w).alias("a"), F.lit(0.0).alias("b"))).when(
        a < 0, F.struct(F.lit(0.0).alias("a"), (ur / uu).alias("b"))).otherwise(F.struct(a.alias("a"), b.alias("b")))
    return s.select(*keys, both.alias("fit")).select(*keys, "fit.a", "fit.b")


def spread(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(LEAST_SPREAD), F.sqrt(a + b / F.greatest(F.col("n_chars"), F.lit(1))))


def _key(kind: str, lang: Column | None = None) -> Column:
    return F.struct(F.lit(kind).alias("kind"), (F.lit(None).cast("string") if lang is None else lang).alias("lang"))


def thresholds(scores: DataFrame) -> DataFrame | None:
    """(kind, lang, centre, a, b, low, high) of the trusted rows (lang, n_chars, log_perplexity, kept_back): centre,
    variance, and the bounds of the distance from the centre in spreads. The row of kind ``other`` is for languages
    that have no row of kind ``lang``. None if no row is kept back."""
    rows = scores.filter("kept_back is not null and n_chars > 0")
    held = rows.filter("kept_back").select(F.explode(F.array(_key("lang", F.col("lang")), _key("other"))).alias("key"), F.col("log_perplexity").alias("x"))
    centres = materialize(quantiles(held, {"centre": 0.5}).select("key.*", "centre", "n"), "kn-centres")        # a row a language
    one = centres.filter("kind = 'other'").first()
    if one is None:
        return None
    langs = centres.filter("kind = 'lang'").drop("kind")
    rows = _by_lang(rows, langs, "left").select("lang", "n_chars", "kept_back", "n", (F.col("log_perplexity") - F.col("centre")).alias("d"),
                                                (F.col("log_perplexity") - one["centre"]).alias("apart"))
    rows = materialize(rows, "kn-distances")
    kept = rows.filter("kept_back")
    together = spreads(kept).first()                  # two numbers
    strange = spreads(kept.drop("d").withColumnRenamed("apart", "d")).first()
    enough = F.col("n") >= ENOUGH
    lit = lambda fit: (F.lit(fit["a"]), F.lit(fit["b"]))
    langs = _by_lang(langs, spreads(kept, "lang"), "inner")
    langs = materialize(langs.select("lang", "centre", "n", *(F.when(enough, F.col(c)).otherwise(together[c]).alias(c) for c in ("a", "b"))), "kn-spreads")
    # each distance counts for its language, if that has enough of them, for all languages together and for others
    found = _by_lang(rows, langs.select("lang", "a", "b"), "left")
    counts = F.array(F.struct(_key("lang", F.col("lang")).alias("key"), F.when(enough, F.col("d") / spread(F.col("a"), F.col("b"))).alias("x")),
                     F.struct(_key("together").alias("key"), (F.col("d") / spread(*lit(together))).alias("x")),
                     F.struct(_key("other").alias("key"), (F.col("apart") / spread(*lit(strange))).alias("x")))
    found = found.select("kept_back", F.explode(counts).alias("one")).select("kept_back", "one.*")
    shares = {"low": LOW_QUANTILE, "high": HIGH_QUANTILE}
    low = quantiles(found, shares).select("key", F.when(F.col("n") < ENOUGH, F.least("low", -student(1 - LOW_QUANTILE, F.col("n")))).otherwise(F.col("low")).alias("low"))
    high = quantiles(found.filter("kept_back"), shares).select(
        "key", F.when(F.col("n") < ENOUGH, F.greatest("high", student(HIGH_QUANTILE, F.col("n")))).otherwise(F.col("high")).alias("high"))
    bounds = materialize(low.join(high, "key").select("key.*", "low", "high"), "kn-quantiles")
    all_of = bounds.filter("kind = 'together'").first()
    per_lang = _by_lang(langs, bounds.filter("kind = 'lang'").drop("kind"), "left")
    wider = F.sqrt(1 + 1 / F.col("n"))
    per_lang = per_lang.select(F.lit("lang").alias("kind"), "lang", "centre", "a", "b",
                               *((F.coalesce(c, F.lit(all_of[c])) * wider).alias(c) for c in ("low", "high")))
    last = bounds.filter("kind = 'other'").select("kind", "lang", F.lit(one["centre"]).alias("centre"), F.lit(strange["a"]).alias("a"),
                                                  F.lit(strange["b"]).alias("b"), "low", "high")
    return per_lang.unionByName(last)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER) -> DataFrame:
    """(doc_id, tie, lang, n_chars, perplexity, least, most, trusted, kept) for every row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    table = in_blocks(docs, text, lang)
    trusted = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    trusted = trusted.withColumn("kept_back", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)) == 0)
    # one shuffle by gram; the table's buckets then serve the counts and the answers
    found = block_grams(table, trusted.filter("not kept_back").select("doc_id"), order)
    size = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = _bucketed(found.repartition(size, "gram").sortWithinPartitions("gram"), "gram")
    every = spark.table(asked).groupBy("gram").agg(F.sum("c").alias("c"))
    counts = materialize(count_table(every, order), "kn-counts")
    vocabulary = counts.filter("n = 1 and c > 0").count() + 1
    parts = materialize(own_and_weight(counts, order), "kn-parts")
    discard(counts)
    answers = spark.table(asked).select("block", "gram").join(probabilities(parts, order, vocabulary).hint("merge"), "gram")
    scores = materialize(scored(spark.table(table), answers, order), "kn-scores")
    discard(parts)
    for name in (table, asked):
        used = spark.table(name)
        spark.sql(f"DROP TABLE IF EXISTS {name}")     # the catalog's entry; the files lie in the shared folder
        discard(used)
    scores = scores.join(trusted, "doc_id", "left")
    names = ("centre", "a", "b", "low", "high")
    bounds = None if vocabulary == 1 else thresholds(scores)
    if bounds is None:
        out = scores.withColumns({"centre": F.lit(0.0), "a": F.lit(0.0), "b": F.lit(0.0), "low": F.lit(float("-inf")), "high": F.lit(float("inf"))})
    else:
        bounds = materialize(bounds, "kn-bounds")     # a row a language
        one = bounds.filter("kind = 'other'").first()
        per_lang = bounds.filter("kind = 'lang'").select("lang", *(F.col(c).alias(f"l_{c}") for c in names))
        out = _by_lang(scores, per_lang, "left").withColumns({c: F.coalesce(f"l_{c}", F.lit(one[c])) for c in names})
    out = out.withColumns({c: F.col("centre") + F.col(c) * spread(F.col("a"), F.col("b")) for c in ("low", "high")})
    inside = (F.col("log_perplexity") >= F.col("low")) & (F.col("log_perplexity") <= F.col("high"))
    return out.select("doc_id", "tie", "lang", "n_chars", F.exp("log_perplexity").alias("perplexity"),
                      F.exp("low").alias("least"), F.exp("high").alias("most"),
                      F.col("kept_back").isNotNull().alias("trusted"), F.coalesce(inside, F.lit(False)).alias("kept"))


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")
