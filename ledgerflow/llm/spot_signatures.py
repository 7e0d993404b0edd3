"""Document fingerprints by SpotSigs, in DataFrame operations only.

A text is lower-cased and cut into runs of letters and digits. Every common word (an anchor) with the ``CHAIN`` content
words that follow it, common words skipped, is a spot; a chain that the text's end cuts short counts with the words it
has, an anchor without any counts not at all. The signature is the set of the spots' 64-bit hashes; a text without a
spot has one hash of all its words instead, so that it equals only itself. The fingerprint names the set: SHA-256 of
its hashes in ascending order, in decimal, joined by blanks.

Spots are found without a loop over the words: if word i is the k-th anchor (from 0), i - k content words come before
it, so its chain is the slice of the content words from there.

Likeness is the Jaccard coefficient of two sets. ``near_pairs`` finds all pairs of different signatures of at least
``threshold``: sets go to partitions of length whose bounds grow by 1 / threshold, so partners are in the same or the
next partition; inside, two sets meet only through their rarest spots (a set of n, rarest first, needs its first
n - ceil(threshold n) + 1); pairs whose lengths rule the threshold out are pruned before the sets are compared.

``edited_and_next`` pairs every document with the next one in descending order of doc_id. Order is settled over small
rows (id, hash of the text, copies): a range sort, a window per range, and the ranges' first rows for the borders.

Defined results: a null text counts as empty, whose signature is the hash of no words; null ids come last in descending
order; equal ids follow in the order of the text's hash, rows equal in both are each other's next; the last document's
next is the first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import whole_text
from ledgerflow.session import materialize

CHAIN = 2

# Common words of four languages.
ANCHORS = ("a an and are as at be but by for from had has have he in is it its not of on or she that the their they this to was "
           "were which will with "
           "au aux avec ce ces dans de des du elle en est et il la le les leur mais ne ou par pas pour que qui se son sur un une "
           "als am auch auf aus bei das dem den der des die ein eine einer er es für ich im ist mit nicht sich sie sind und "
           "von war wie zu zum zur "
           "al como con del el en es esta fue ha las lo los más no para pero por su sus una y").split()


def signature(df: DataFrame, text: str, out: str, chain: int = CHAIN) -> DataFrame:
    """``df`` with the set of spots of column ``text`` as ``out``, in ascending order."""
    common = sorted(set(ANCHORS))
    is_anchor = lambda w: w.isin(*common)
    df = df.withColumn("_words", F.filter(F.split(F.lower(whole_text(text)), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    df = df.withColumn("_content", F.filter("_words", lambda w: ~is_anchor(w)))
    df = df.withColumn("_anchors", F.filter(F.transform("_words", lambda w, i: F.when(is_anchor(w), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull()))

    def spot(x: Column, k: Column) -> Column:
        at = x["i"] - k
        words = [F.get("_content", at + j) for j in range(chain)]
        return F.when(words[0].isNotNull(), F.xxhash64(x["w"], *words))

    df = df.withColumn("_spots", F.array_sort(F.array_distinct(F.array_compact(F.transform("_anchors", spot)))))
    alone = F.array(F.xxhash64(F.lit("no spot"), F.array_join("_words", " ")))
    return df.withColumn(out, F.when(F.size("_spots") > 0, F.col("_spots")).otherwise(alone)).drop("_words", "_content", "_anchors", "_spots")


def fingerprint(sig: str) -> Column:
    return F.sha2(F.array_join(F.col(sig).cast("array<string>"), " "), 256)


def likeness(a: str, b: str) -> Column:
    """Jaccard coefficient of two sets, never empty."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def fingerprints(docs: DataFrame, text: str = "text", chain: int = CHAIN) -> DataFrame:
    """(doc_id, signature, fingerprint) for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return signature(rows, "text", "signature", chain).select("doc_id", "signature", fingerprint("signature").alias("fingerprint"))


def near_pairs(found: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, likeness): pairs of different fingerprints, a < b, of at least ``threshold``. ``found``: fingerprints()."""
    sets = materialize(found.dropDuplicates(["fingerprint"]).select("fingerprint", "signature"), "spot-sets")
    size = F.size("signature")
    part = F.floor(F.log(size.cast("double")) / -F.log(F.lit(threshold)) + 1e-9).cast("int")
    spots = sets.select("fingerprint", size.alias("n"), part.alias("part"), F.explode("signature").alias("spot"))
    often = spots.groupBy("spot").agg(F.count("*").alias("often"))
    rank = F.row_number().over(Window.partitionBy("fingerprint").orderBy("often", "spot"))
    needed = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    keys = materialize(spots.join(often.filter("often > 1"), "spot").withColumn("rank", rank).filter(F.col("rank") <= needed)
                       .select("fingerprint", "n", "part", "spot"), "spot-keys")
    left = keys.select(F.col("fingerprint").alias("a"), F.col("n").alias("n_a"), "spot", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = keys.select(F.col("fingerprint").alias("b"), F.col("n").alias("n_b"), "spot", "part")
    near = left.join(right, ["part", "spot"]).filter((F.col("a") != F.col("b")) & (F.least("n_a", "n_b") >= F.lit(threshold) * F.greatest("n_a", "n_b") - 1e-9))
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    named = lambda c: sets.select(F.col("fingerprint").alias(c), F.col("signature").alias(f"sig_{c}"))
    pairs = near.join(named("a"), "a").join(named("b"), "b").select("a", "b", likeness("sig_a", "sig_b").alias("likeness"))
    return pairs.filter(F.col("likeness") >= F.lit(threshold) - 1e-12)


KEY = ("missing", "id", "tie")


def next_keys(rows: DataFrame) -> DataFrame:
    """(missing, id, tie, copies, next_missing, next_id, next_tie): of every different key the one that follows it."""
    order = [F.col("missing").asc(), F.col("id").desc(), F.col("tie").asc()]
    small = rows.groupBy(*KEY).agg(F.count("*").alias("copies")).repartitionByRange(*order)
    small = materialize(small.withColumn("range", F.spark_partition_id()), "spot-order")
    key = F.struct(*KEY)
    within = Window.partitionBy("range").orderBy(*order)
    small = small.withColumn("nth", F.row_number().over(within)).withColumn("next", F.lead(key).over(within))
    heads = small.filter("nth = 1").select("range", key.alias("head"))            # a row for each range
    first = F.first("head").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("range", F.coalesce(F.lead("head").over(Window.orderBy("range")), first).alias("border"))
    return small.join(heads, "range").withColumn("next", F.coalesce("next", "border")).select(
        *KEY, "copies", *(F.col("next")[k].alias(f"next_{k}") for k in KEY))


def edited_and_next(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text, edited, following, times): the last floor(n / 2) code points are replaced by the first as many of the
    next document's text, ``following``. A row stands for ``times`` rows alike: of rows equal in id and text one is kept,
    reduced before the shuffle. All but one of them are followed by their like, the last one by the next key."""
    body = F.col(text).cast("string")
    rows = docs.select(F.col("doc_id").isNull().alias("missing"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                       F.xxhash64(body).alias("tie"), F.coalesce(body, F.lit("")).alias("text"))
    keyed = rows.groupBy(*KEY).agg(F.first("text").alias("text")).join(next_keys(rows.select(*KEY)), list(KEY))
    follow = keyed.select(*(F.col(k).alias(f"next_{k}") for k in KEY), F.col("text").alias("following"))
    both = keyed.drop("tie").join(follow, [f"next_{k}" for k in KEY])
    last = F.explode(F.when(F.col("copies") > 1, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))).alias("last")
    both = both.select("missing", "id", "text", "following", "copies", last)
    both = both.select("missing", "id", "text", F.when(F.col("last"), F.col("following")).otherwise(F.col("text")).alias("following"),
                       F.when(F.col("last"), F.lit(1).cast("long")).otherwise(F.col("copies") - 1).alias("times"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("following", F.lit(1), half))
    return both.select(F.when(~F.col("missing"), F.col("id")).alias("doc_id"), "text", edited.alias("edited"), "following", "times")


def compare_with_edited(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row."""
    rows = edited_and_next(docs)
    for column, out in (("text", "own_sig"), ("edited", "edited_sig"), ("following", "next_sig")):
        rows = signature(rows, column, out)
    found = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                        fingerprint("own_sig").alias("fingerprint"), fingerprint("edited_sig").alias("edited_fingerprint"),
                        likeness("own_sig", "edited_sig").alias("near_edited"), likeness("own_sig", "next_sig").alias("near_next"), "times")
    return found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times", "col")
