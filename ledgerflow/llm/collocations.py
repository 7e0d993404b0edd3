"""Phrase collocations by prefix-free parsing: count phrases inside distinct chunks of text, weighted by how often each
chunk occurs.

Texts, lower-cased in A-Z, are split at punctuation and line ends into pieces and those at blanks into words; phrases do
not cross pieces. A word whose hash is divisible by ``TRIGGER`` starts a chunk, as does the first word of a piece: the
cut depends on the words alone, so equal passages give equal chunks wherever they stand. A chunk runs to the next start
and takes ``MOST - 1`` more words of its piece with it, so every phrase lies whole in the chunk that owns its first word
and is counted there only; the owned length is part of the chunk. The dictionary is the distinct chunks of a language
with their frequencies (one aggregation, combined before the shuffle).

Phrases are counted over the dictionary in three passes, each phrase at its chunk's frequency: words; pairs of words
that are each frequent; longer phrases whose pairs are all frequent. A phrase is never more frequent than its parts, so
the passes leave out nothing that can reach ``least``. What is known to be frequent goes to the tasks as a bitmap of
fixed size (``BITS``): a collision only lets a phrase be counted in vain.

Scores and shares are decimal integers, exact beyond 64 bits. The best phrases of a language come from a window whose
group limit is applied before the shuffle.

Defined results: a null text is empty, a null language ``und``; languages without a candidate give no rows; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import LOWER, UPPER, map_arrow, whole_text
from ledgerflow.session import materialize

MOST = 4
LEAST = 30
BEST = 2000
TRIGGER = 16
BITS = 1 << 27                  # a power of two
SHARE = 80                      # per cent of a phrase's occurrences that a longer one must cover to replace it
SCORE = 2_000_000
PART_CHARS = 4_000_000
_BUCKET_BITS = 32768            # of one bitmap of Spark's bitmap functions
_SEED = 42                      # of Spark's xxhash64
_TURN = 7
PIECES, WORDS = r"[.,;:!?\x0A-\x0D]", r"[^\x20\x09]+"
#: Bytes of a text: A-Z lower-cased, what ends a piece to a line feed, a tab to a blank.
_BYTES = bytes(10 if re.match(PIECES, chr(b)) else 32 if b == 9 else ord(chr(b).lower()) if b < 128 else b for b in range(256))


class _Flat:
    """The words of an array of strings in one run: ``words``, ``row`` of each, ``code`` of each among ``distinct``."""

    def __init__(self, strings: pa.Array):
        split = pc.split_pattern(strings, " ")
        words = split.flatten()
        there = pc.binary_length(words).to_numpy() > 0
        self.row = np.repeat(np.arange(len(strings)), np.diff(split.offsets.to_numpy()))[there]
        self.words = words.filter(pa.array(there))
        encoded = self.words.dictionary_encode()
        self.code, self.distinct = encoded.indices.to_numpy(), encoded.dictionary
        self.first = np.ones(len(self.row), bool)                    # of its row
        self.first[1:] = self.row[1:] != self.row[:-1]

    def hashes(self, seed: int) -> np.ndarray:
        return np.array([xxhash.xxh64_intdigest(w, seed) for w in self.distinct.cast(pa.binary()).to_pylist()], dtype=np.uint64)

    def phrases(self, at: np.ndarray, k: int) -> pa.Array:
        return pc.binary_join_element_wise(*(self.words.take(pa.array(at + j)) for j in range(k)), " ")


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    for lang in pc.unique(batch["lang"]).to_pylist():
        yield lang, batch.filter(pc.equal(batch["lang"], lang)).drop_columns("lang")


def _parts(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about PART_CHARS characters."""
    upto = np.cumsum(pc.utf8_length(batch[text]).to_numpy())
    edges = np.unique(np.searchsorted(upto, np.arange(PART_CHARS, (upto[-1] if len(upto) else 0) + PART_CHARS, PART_CHARS), side="left") + 1)
    a = 0
    for z in [*edges[edges < len(upto)].tolist(), len(upto)]:
        if z > a:
            yield batch.slice(a, z - a)
        a = z


def parse(trigger: int = TRIGGER, most: int = MOST):
    """Batch function (lang, text) -> (lang, chunk, own, n): chunks of the texts, ``own`` words of each its own."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, "text"):
                for lang, texts in _by_lang(part):
                    pieces = b"\n".join(texts["text"].cast(pa.binary()).to_pylist()).translate(_BYTES).split(b"\n")
                    flat = _Flat(pa.array(pieces, pa.binary()).cast(pa.string()))
                    if not len(flat.row):
                        continue
                    starts = np.flatnonzero(flat.first | (flat.hashes(_SEED) % np.uint64(trigger) == 0)[flat.code])
                    ends = np.append(starts[1:], len(flat.row))
                    sizes = np.minimum(ends + most - 1, np.searchsorted(flat.row, flat.row[starts], side="right")) - starts
                    offsets = np.concatenate([[0], np.cumsum(sizes)])
                    taken = flat.words.take(pa.array(np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])))
                    chunks = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), taken), " ")
                    found = pa.table({"chunk": chunks, "own": pa.array(ends - starts, pa.int32())})
                    found = found.group_by(["chunk", "own"], use_threads=False).aggregate([([], "count_all")])
                    yield from _rows(lang, chunk=found["chunk"], own=found["own"], n=found["count_all"])
    return stream


def _rows(lang: str, **columns) -> Iterator[pa.RecordBatch]:
    table = pa.table(columns)
    yield from table.add_column(0, "lang", pa.array([lang] * len(table), pa.string())).to_batches()


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", trigger: int = TRIGGER, most: int = MOST) -> DataFrame:
    """(lang, chunk, own, n): distinct chunks with their frequencies, written."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), whole_text(text).alias("text"))
    chunks = map_arrow(rows, parse(trigger, most), "lang string, chunk string, own int, n long")
    return materialize(chunks.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("n")), "phrase-chunks")


def bitmap(frequent: DataFrame, bits: int = BITS) -> np.ndarray:
    """Bits at the hashes of (lang, phrase), phrases of one or two words: at most ``bits`` / 8 bytes, put together from
    Spark's bitmaps."""
    words = F.split("phrase", " ")
    h = [F.xxhash64("lang", F.get(words, i)) for i in (0, 1)]
    turned = F.shiftleft(h[0], _TURN).bitwiseOR(F.shiftrightunsigned(h[0], 64 - _TURN)).bitwiseXOR(h[1])
    place = F.when(F.size(words) == 1, h[0]).otherwise(turned).bitwiseAND(F.lit(bits - 1).cast("long")) + 1
    parts = frequent.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(-(-bits // _BUCKET_BITS) * (_BUCKET_BITS // 8), dtype=np.uint8)
    for bucket, data in parts.toLocalIterator():
        at = (bucket - 1) * (_BUCKET_BITS // 8)       # buckets count from 1, as values do
        out[at:at + len(data)] = np.frombuffer(data, dtype=np.uint8)
    return out


def _known(bits: int, held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(bits - 1)
    return (held[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _counted(grams: Callable):
    """Batch function over the dictionary -> (lang, phrase, n): ``grams(flat, seed, own, n)`` gives phrases and counts;
    ``own`` tells of each word whether it is the chunk's own, ``n`` how often the chunk occurs."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, "chunk"):
                for lang, chunks in _by_lang(part):
                    flat = _Flat(chunks["chunk"])
                    at = np.arange(len(flat.row)) - np.flatnonzero(flat.first)[np.cumsum(flat.first) - 1]
                    own = at < chunks["own"].to_numpy()[flat.row]
                    seed = xxhash.xxh64_intdigest(lang.encode(), _SEED)
                    for phrases, n in grams(flat, seed, own, chunks["n"].to_numpy()[flat.row]):
                        yield from _rows(lang, phrase=phrases, n=pa.array(n, pa.int64()))
    return stream


def _words(flat: _Flat, seed: int, own: np.ndarray, n: np.ndarray):
    counts = np.zeros(len(flat.distinct), np.int64)
    np.add.at(counts, flat.code[own], n[own])
    there = np.flatnonzero(counts)
    yield flat.distinct.take(pa.array(there)), counts[there]


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of one of each key, sum of its n)."""
    order = np.argsort(keys, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
    return order[heads], np.add.reduceat(n[order], heads)


def _pairs(bits: int, frequent):
    def grams(flat: _Flat, seed: int, own: np.ndarray, n: np.ndarray):
        fine = _known(bits, frequent.value, flat.hashes(seed))[flat.code]
        at = np.flatnonzero(own[:-1] & ~flat.first[1:] & fine[:-1] & fine[1:])
        if len(at):
            one, counts = _added(flat.code[at].astype(np.int64) * len(flat.distinct) + flat.code[at + 1], n[at])
            yield flat.phrases(at[one], 2), counts
    return grams


def _longer(bits: int, frequent, most: int):
    def grams(flat: _Flat, seed: int, own: np.ndarray, n: np.ndarray):
        h = flat.hashes(seed)[flat.code]
        turned = (h << np.uint64(_TURN)) | (h >> np.uint64(64 - _TURN))
        fine = np.zeros(len(h) + most, bool)                        # of the pair that starts at a word
        fine[:max(0, len(h) - 1)] = ~flat.first[1:] & _known(bits, frequent.value, turned[:-1] ^ h[1:])
        at = np.flatnonzero(own & fine[:len(h)])
        for k in range(3, most + 1):
            at = at[fine[at + k - 2]]
            if len(at):
                found = pa.table({"phrase": flat.phrases(at, k), "n": n[at]}).group_by("phrase", use_threads=False).aggregate([("n", "sum")])
                yield found["phrase"], found["n_sum"].to_numpy()
    return grams


def phrase_counts(chunks: DataFrame, least: int = LEAST, most: int = MOST, bits: int = BITS) -> DataFrame:
    """(lang, phrase, k, n): phrases of one to ``most`` words that occur at least ``least`` times, written by pass."""
    spark = chunks.sparkSession

    def counted(grams: Callable, name: str) -> DataFrame:
        rows = map_arrow(chunks, _counted(grams), "lang string, phrase string, n long")
        total = rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        return materialize(total.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("k"), "n"), name)

    words = counted(_words, "phrase-words")
    pairs = counted(_pairs(bits, spark.sparkContext.broadcast(bitmap(words, bits))), "phrase-pairs")
    longer = counted(_longer(bits, spark.sparkContext.broadcast(bitmap(pairs, bits)), most), "phrase-longer")
    return words.unionByName(pairs).unionByName(longer)


def _part(first: int, last: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, last), " ")


def collocations(docs: DataFrame, least: int = LEAST, most: int = MOST, best: int = BEST, share: int = SHARE,
                 trigger: int = TRIGGER, bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of every language's ``best`` phrases."""
    chunks = dictionary(docs, trigger=trigger, most=most)
    total = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("n")).cast("long").alias("n"))
    counts = phrase_counts(chunks, least, most, bits)
    known = counts.select("lang", "phrase", F.col("n").alias("f"))
    phrases = counts.filter("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"))

    # contained in a longer candidate that occurs nearly as often
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))
    covers = phrases.filter("k > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    covers = covers.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    kept = phrases.join(covers, ["lang", "phrase"], "left")
    kept = kept.filter(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * share)).drop("longer")

    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = kept.select("lang", "phrase", "k", "a", cut)
    cuts = cuts.withColumn("left", _part(1, F.col("cut"))).withColumn("right", F.array_join(F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut")), " "))
    for side, out in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(out)), ["lang", side])
    scored = cuts.select("lang", "phrase", "a", "cut", "l", "r", F.expr(f"cast(cast(a as decimal(20,0)) * {SCORE} div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as long)").alias("score"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    out = lowest.select("lang", "phrase", "a", "m.l", "m.r", "m.score").withColumn("rank", rank).filter(F.col("rank") <= best)
    return out.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _sql() -> str:
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"""
with p as (select row_number() over () as r, lang, w from (select lang, regexp_extract_all(piece, '{WORDS}') as w from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({lower}, '{PIECES}')) as piece from documents)) where len(w) > 0),
g as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase from (
    select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from p cross join range(1, {MOST + 1}) s(k) where len(w) >= k)),
f as (select lang, k, phrase, count(*) as f from g group by all),
t as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= {LEAST}),
x as (select lang, array_to_string(w[i:i + m - 1], ' ') as phrase, max(a) as longer from (
    select lang, w, a, m, unnest(range(1, k - m + 2)) as i from c cross join range(2, {MOST}) s(m) where m < k) group by 1, 2),
s as (select c.lang, c.phrase, a, cut, l.f as l, r.f as r, ({SCORE}::hugeint * a) // (l.f + r.f) as score
    from (select *, unnest(range(1, k)) as cut from c) c left join x on x.lang = c.lang and x.phrase = c.phrase
    join f l on l.lang = c.lang and l.phrase = array_to_string(w[1:cut], ' ')
    join f r on r.lang = c.lang and r.phrase = array_to_string(w[cut + 1:], ' ')
    where longer is null or 100 * longer < {SHARE} * a),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
select lang, rank, phrase, a, l, r, n, score::bigint as score from (
    select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from b) join t using (lang)
where rank <= {BEST}
"""


COLLOCATIONS_SQL = _sql()
