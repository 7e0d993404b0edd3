"""Benchmark decontamination by winnowing, in DataFrame operations only.

A test item's windows are its runs of ``WINDOW`` words (an item of fewer words is one window of all of them). Of every
window of t words the least hash of its k-grams is kept, the rightmost of equal ones, with k = ceil(t / 2); the same
rule picks fingerprints from the texts, so a text that holds a window has kept the window's own fingerprint, at the same
place: no shared run of t words can be missed. Text and test fingerprints are joined on the hash, and each common one
is extended to the test window around it by comparing the words, so only true occurrences count.

Texts are cut into segments of ``SEGMENT`` words that overlap by t - 1 (every window lies in one of them), so very long
texts give many rows of bounded size. A hash and its place share one 64-bit number: the least number of a window is the
least hash, rightmost. Test windows are told apart by their words, not by item: an item repeated many times is one class.

The test windows are broadcast while there are at most ``BROADCAST`` of them (10 words each); beyond, both sides are
shuffled by hash and the texts' side carries only the words around a fingerprint.

Defined results: null or wordless texts and items have no words and no windows; rows are told apart by (doc_id, hash of
the text), rows equal in both get equal results; of items with one id the windows are put together, a null item id
counts as an item of empty name; empty tables give no rows or no hits; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import LOWER, UPPER, lower_ascii
from ledgerflow.session import materialize

WINDOW = 10
SEGMENT = 1024
BROADCAST = 200_000
_BITS = 11                                   # of a place inside a segment: SEGMENT + WINDOW < 2 ** 11
_PLACES = (1 << _BITS) - 1
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ("missing", "id", "tie")


def words_of(text: str = "text") -> Column:
    return F.array_remove(F.split(lower_ascii(text), SEPARATORS), "")


def numbered_grams(words: str, t: int) -> tuple[Column, Column]:
    """The hashes of the array ``words`` (to be column _hashes) and, for each of its k-grams, the hash's upper bits with
    the places from it to the end below."""
    k = (t + 1) // 2
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    starts = F.sequence(F.lit(0), F.size(words) - k)

    def gram(i: Column) -> Column:
        h = F.xxhash64(*(F.get(F.col("_hashes"), i + j) for j in range(k)))
        return h.bitwiseAND(F.lit(~_PLACES).cast("long")).bitwiseOR((F.lit(_PLACES) - i).cast("long"))

    return hashes, F.transform(starts, gram)


def place(number: str) -> Column:
    return (F.lit(_PLACES) - F.col(number).bitwiseAND(F.lit(_PLACES).cast("long"))).cast("int")


def fingerprints(rows: DataFrame, words: str, t: int) -> DataFrame:
    """``rows`` with (t, hash, place) of every fingerprint of the array ``words`` for windows of t words."""
    w = t - (t + 1) // 2 + 1
    hashes, grams = numbered_grams(words, t)
    rows = rows.filter(F.size(words) >= t).withColumn("_hashes", hashes).withColumn("_grams", grams).drop("_hashes")
    least = F.transform(F.sequence(F.lit(1), F.size("_grams") - (w - 1)), lambda j: F.array_min(F.slice("_grams", j, w)))
    kept = rows.withColumn("_kept", F.array_distinct(least)).drop("_grams")
    # explode would add a filter on the array's size, which repeats everything above under the projections
    kept = kept.withColumn("_number", F.explode_outer("_kept")).drop("_kept")
    return kept.withColumn("t", F.lit(t)).withColumn("hash", F.shiftright("_number", _BITS)).withColumn("place", place("_number")).drop("_number")


def test_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: (t, hash, place, words, window_id) of every different window, (window_id, class), and
    (class, item) for classes of items with the same words."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(text).alias("words")).filter(F.size("words") > 0)
    rows = materialize(rows, "test-items")
    classes = materialize(rows.select("words").distinct().withColumn("class", F.monotonically_increasing_id()), "test-classes")
    members = materialize(rows.join(classes, "words").select("class", "item").distinct(), "test-members")
    t = F.least(F.size("words"), F.lit(window))
    cut = classes.select("class", "words", t.alias("t"))
    cut = cut.select("class", "t", F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - F.col("t") + 1), lambda j: F.slice("words", j, F.col("t")))).alias("words"))
    cut = materialize(cut.distinct(), "test-cut")
    named = materialize(cut.select("t", "words").distinct().withColumn("window_id", F.monotonically_increasing_id()), "test-windows")
    lengths = [r[0] for r in named.select("t").distinct().collect()]      # at most ``window``
    known = [fingerprints(named.filter(F.col("t") == n).drop("t"), "words", n) for n in sorted(lengths)]
    known = reduce(DataFrame.unionByName, known) if known else fingerprints(named.drop("t"), "words", window)
    return (materialize(known, "test-fingerprints"), materialize(cut.join(named, ["t", "words"]).select("window_id", "class"), "test-in-class"), members)


def segments(rows: DataFrame, words: str = "words", length: int = SEGMENT, window: int = WINDOW) -> DataFrame:
    """``rows`` with column ``words`` cut: (base, words) for each segment."""
    parts = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(words) - 1, F.lit(0)) / length).cast("int")),
                        lambda i: F.struct((i * length).alias("base"), F.slice(words, i * length + 1, length + window - 1).alias("words")))
    rest = [c for c in rows.columns if c != words]
    return rows.select(*rest, F.explode_outer(parts).alias("part")).select(*rest, "part.base", "part.words")


def matches(texts: DataFrame, known: DataFrame, window: int = WINDOW, broadcast: int = BROADCAST) -> DataFrame:
    """(key, start, t, window_id): every occurrence of a test window in ``texts`` (key, words)."""
    small = known.count() <= broadcast
    lengths = sorted(r[0] for r in known.select("t").distinct().collect())
    cut = segments(texts, window=window)
    found = [fingerprints(cut, "words", t) for t in lengths]
    if not small:     # the words around a fingerprint are all that its windows need
        around = lambda f: f.withColumn("from", F.greatest(F.col("place") - window, F.lit(0))).withColumn(
            "words", F.slice("words", F.col("from") + 1, 2 * window)).withColumn(
            "base", F.col("base") + F.col("from")).withColumn("place", F.col("place") - F.col("from")).drop("from")
        found = [around(f) for f in found]
    found = reduce(DataFrame.unionByName, found)
    test = known.select("t", "hash", F.col("place").alias("offset"), F.col("words").alias("window"), "window_id")
    both = found.join(F.broadcast(test) if small else test, ["t", "hash"])
    at = F.col("place") - F.col("offset")
    both = both.filter(at >= 0).filter(F.slice("words", at + 1, F.col("t")) == F.col("window"))
    return both.select(*KEY, (F.col("base") + at).alias("start"), "t", "window_id").distinct()


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    body = F.col(text).cast("string")
    return docs.select(F.col("doc_id").isNull().alias("missing"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                       F.xxhash64(body).alias("tie"), body.alias("text"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast: int = BROADCAST) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``."""
    known, in_class, members = test_windows(items, window=window)
    rows = keyed(docs).select(*KEY, words_of().alias("words"))
    heads = rows.select(*KEY, F.size("words").cast("long").alias("n_words"))
    if not known.take(1):
        out = heads.withColumns({"n_hit": F.lit(0).cast("long"), "items": F.lit(None).cast("array<string>")})
    else:
        found = materialize(matches(rows, known, window, broadcast), "test-hits")
        spans = found.select(*KEY, "start", (F.col("start") + F.col("t")).alias("end")).distinct()
        before = F.max("end").over(Window.partitionBy(*KEY).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
        new = F.greatest(F.col("end") - F.greatest(F.col("start"), F.coalesce(before, F.col("start"))), F.lit(0))
        hit = spans.withColumn("new", new).groupBy(*KEY).agg(F.sum("new").cast("long").alias("n_hit"))
        named = found.select(*KEY, "window_id").distinct().join(in_class, "window_id").select(*KEY, "class").distinct()
        named = named.join(members, "class").groupBy(*KEY).agg(F.array_sort(F.collect_set("item")).alias("items"))
        out = heads.join(hit.join(named, list(KEY)), list(KEY), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(F.when(~F.col("missing"), F.col("id")).alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def _sql_words(table: str, key: str) -> str:
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    return f"select {key}, list_filter(regexp_split_to_array({lower}, '{SEPARATORS}'), lambda x: x <> '') as w from {table}"


WINNOWING_SQL = f"""
with d as (select row_number() over () as r, * from ({_sql_words('documents', 'doc_id')})),
i as (select *, least({WINDOW}, len(w)) as t from ({_sql_words('benchmark', 'item_id')}) where len(w) > 0),
iw as (select distinct item_id, t, array_to_string(w[j:j + t - 1], ' ') as g from (select *, unnest(range(1, len(w) - t + 2)) as j from i)),
ts as (select distinct t from i),
dw as (select r, j, t, array_to_string(w[j:j + t - 1], ' ') as g from
    (select r, w, t, unnest(range(1, len(w) - t + 2)) as j from d cross join ts where len(w) >= t)),
h as (select r, j, t, item_id from dw join iw using (t, g)),
p as (select r, count(distinct x) as n_hit from (select r, unnest(range(j, j + t)) as x from (select distinct r, j, t from h)) group by r),
q as (select r, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids from (select distinct r, item_id from h) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from d left join p using (r) left join q using (r)
"""
