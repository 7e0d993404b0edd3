"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Targets: the sources, in code point order with null last, weigh 5, 2, 1, 5, 2, 1, ... and share ``TOTAL_SHARE`` of all
words. A target stops at ``MAX_COPIES`` times its source's size and the excess is shared again by weight until none
is above: each target is min(cap, level * weight), with the level found from running sums over the sources in the
order of cap / weight.

Rates: of all rates between 0 and ``MAX_COPIES`` that meet the sources' targets in words, take those of least relative
entropy (to one copy each, with the bound's own entropy term). They are exponentially tilted by the document's size,
rate = M / (1 + (M - 1) exp(-lambda * size / mean size)), with one lambda for each source, the root of the convex
dual's gradient. Newton steps find all lambdas at once: every iteration is one aggregation over (source, size, number
of documents) - equal documents have equal rates, so the histogram loses nothing - joined to the lambdas so far. A step
that leaves the bracket known so far is replaced by its middle. Sources whose target is their cap or zero take M or
no copies of everything.

Rounding: documents of one source and size are interchangeable. In descending size order each such cell gets a whole
number of copies so that the words taken so far follow the sum of rates: the ``EXACT_CELLS`` largest cells of a source
one after the other, each making up for what the ones before have left, the cells below by differences of the rounded
running sum of copies. A cell's copies go to its hash buckets the same way, and inside a bucket to its documents in hash order;
so a cell with a third of all rows is split by 256. Nothing is random: reruns agree.

Defined results: a null text has size 0; documents of size 0 are never taken; a null source is a source of its own;
ties and repeated rows are told apart by nothing, each row gets its own copies and which of equal rows gets more is
without effect; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import WORD
from ledgerflow.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MAX_COPIES = 2
EXACT_CELLS = 512
BUCKETS = 256
NEWTON_STEPS = 40
TOLERANCE = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = TOTAL_SHARE,
                   most: float = MAX_COPIES) -> DataFrame:
    """(src, source_size, target) from one row (src, source_size) per source, src: struct(missing, name)."""
    order = Window.orderBy("src")
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1))
    ranked = ranked.withColumn("cap", most * F.col("source_size")).withColumn("fill", F.col("cap") / F.col("weight"))
    every = Window.partitionBy()
    upto = Window.orderBy("fill", "src")
    ranked = (ranked.withColumn("budget", share * F.sum("source_size").over(every))
              .withColumn("capped", F.coalesce(F.sum("cap").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("open", F.sum("weight").over(upto.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open")))
    # the first source, in fill order, that the level leaves below its cap sets the level of all that follow
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "src", "level"))).over(every)["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return ranked.select("src", "source_size", target.alias("target"))


def _rate(scaled: Column, tilt: Column, most: float) -> Column:
    return most / (1 + (most - 1) * F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), tilt * scaled))))


def balance(cells: DataFrame, targets: DataFrame, most: float = MAX_COPIES) -> DataFrame:
    """(src, tilt) that meets every source's target. ``cells``: (src, size, n), size > 0; ``targets``: one row a source."""
    scale = cells.groupBy("src").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = materialize(targets.join(scale, "src").filter((F.col("target") > 0) & (F.col("target") < most * F.col("source_size")))
                        .select("src", "target", "mean", F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"),
                                F.lit(None).cast("double").alias("high"), F.lit(False).alias("done")), "mix-dual")
    for _ in range(NEWTON_STEPS):
        scaled = F.col("size") / F.col("mean")
        rate = _rate(scaled, F.col("tilt"), most)
        sums = (cells.join(state.filter(~F.col("done")).select("src", "mean", "tilt"), "src").groupBy("src")
                .agg(F.sum(rate * F.col("size") * F.col("n")).alias("got"),
                     F.sum(rate * (1 - rate / most) * scaled * F.col("size") * F.col("n")).alias("slope")))
        above = F.col("got") > F.col("target")
        low = F.when(above, F.col("low")).otherwise(F.col("tilt"))
        high = F.when(above, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") + F.least(F.lit(4.0), F.greatest(F.lit(-4.0), (F.col("target") - F.col("got")) / F.greatest(F.col("slope"), F.lit(1e-300))))
        inside = F.coalesce(F.col("newton") > F.col("low"), F.lit(True)) & F.coalesce(F.col("newton") < F.col("high"), F.lit(True))
        done = F.abs(F.col("got") - F.col("target")) <= TOLERANCE * F.col("target")
        nxt = (state.filter(~F.col("done")).join(sums, "src")
               .select("src", "target", "mean", "tilt", low.alias("low"), high.alias("high"), newton.alias("newton"), done.alias("done"))
               .select("src", "target", "mean", F.when(F.col("done"), F.col("tilt")).when(inside, F.col("newton"))
                       .otherwise((F.col("low") + F.col("high")) / 2).alias("tilt"), "low", "high", "done"))
        state = materialize(nxt.unionByName(state.filter("done")), "mix-dual")
        if state.filter(~F.col("done")).isEmpty():
            break
    return state.select("src", "mean", "tilt")


def _whole(wanted: str, over) -> Column:
    """Differences of the rounded running sum."""
    upto = F.sum(wanted).over(over.rowsBetween(Window.unboundedPreceding, 0))
    return (F.floor(upto + 0.5 + 1e-9) - F.floor(upto - F.col(wanted) + 0.5 + 1e-9)).cast("long")


def cell_copies(cells: DataFrame, targets: DataFrame, tilts: DataFrame, most: int = MAX_COPIES) -> DataFrame:
    """(src, size, n, rate, copies): whole copies of each cell."""
    rate = F.when(F.col("target") <= 0, F.lit(0.0)).when(F.col("tilt").isNull(), F.lit(float(most))).otherwise(
        _rate(F.col("size") / F.col("mean"), F.col("tilt"), most))
    rated = (cells.join(targets, "src").join(tilts, "src", "left").withColumn("rate", rate)
             .withColumn("nth", F.row_number().over(Window.partitionBy("src").orderBy(F.desc("size")))))
    # the largest cells, one after the other; z: what the cells before have left, in words
    head = (rated.filter(F.col("nth") <= EXACT_CELLS).groupBy("src")
            .agg(F.sort_array(F.collect_list(F.struct("nth", "size", "n", "rate"))).alias("c")))
    zero = F.struct(F.lit(0.0).alias("left"), F.array().cast("array<bigint>").alias("copies"))

    def step(z: Column, c: Column) -> Column:
        wanted = c["n"] * c["rate"] + z["left"] / c["size"]
        got = F.greatest(F.lit(0).cast("long"), F.least((c["n"] * most).cast("long"), F.floor(wanted + 0.5).cast("long")))
        return F.struct((z["left"] + (c["n"] * c["rate"] - got) * c["size"]).alias("left"), F.array_append(z["copies"], got).alias("copies"))

    head = head.select("src", "c", F.aggregate("c", zero, step).alias("z"))
    left = head.select("src", F.col("z")["left"].alias("left"))
    head = head.select("src", F.explode(F.arrays_zip("c", F.col("z")["copies"].alias("copies"))).alias("e"))
    head = head.select("src", F.col("e.c.size").alias("size"), F.col("e.c.n").alias("n"), F.col("e.c.rate").alias("rate"), F.col("e.copies").alias("copies"))
    tail = rated.filter(F.col("nth") > EXACT_CELLS).join(left, "src").withColumn(
        "wanted", F.col("n") * F.col("rate") + F.when(F.col("nth") == EXACT_CELLS + 1, F.col("left") / F.col("size")).otherwise(0.0))
    tail = tail.withColumn("copies", _whole("wanted", Window.partitionBy("src").orderBy("nth")))
    copies = F.greatest(F.lit(0).cast("long"), F.least(most * F.col("n"), F.col("copies")))
    return head.unionByName(tail.select("src", "size", "n", "rate", copies.alias("copies")))


def mix(docs: DataFrame, text: str = "text", source: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, rate) for every row; ``keep``: also of src (struct of missing
    and name) and tie (hash of the text)."""
    src = F.struct(F.col(source).isNull().alias("missing"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("name"))
    body = F.col(text).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), src.alias("src"),
                       F.coalesce(F.regexp_count(body, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.xxhash64("doc_id", body).alias("order"), F.xxhash64(body).alias("tie"))
    rows = rows.withColumn("bucket", F.pmod(F.col("order"), F.lit(BUCKETS)).cast("int"))
    rows = materialize(rows, "mix-sizes")
    fine = materialize(rows.groupBy("src", "size", "bucket").agg(F.count("*").alias("n")), "mix-cells")
    every = fine.groupBy("src", "size").agg(F.sum("n").alias("n"))
    targets = materialize(source_targets(every.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))), "mix-targets")
    cells = every.filter(F.col("size") > 0)
    plan = cell_copies(cells, targets, balance(cells, targets))
    # a cell's copies to its buckets: all get the whole part of a document's share, the rest follows the running sum
    ahead = Window.partitionBy("src", "size").orderBy("bucket")
    share = fine.join(plan.withColumnRenamed("n", "n_cell"), ["src", "size"]).withColumn("base", F.floor(F.col("copies") / F.col("n_cell")))
    share = share.withColumn("wanted", F.col("n") * (F.col("copies") - F.col("base") * F.col("n_cell")) / F.col("n_cell"))
    share = share.withColumn("more", _whole("wanted", ahead)).select("src", "size", "bucket", "rate", "base", "more")
    share = fine.select("src", "size", "bucket").join(share, ["src", "size", "bucket"], "left").join(targets, "src")
    nth = F.row_number().over(Window.partitionBy("src", "size", "bucket").orderBy("order", F.col("doc_id").asc_nulls_first()))
    ranked = rows.withColumn("nth", nth).join(share, ["src", "size", "bucket"])
    copies = F.coalesce(F.col("base") + F.when(F.col("nth") <= F.col("more"), 1).otherwise(0), F.lit(0)).cast("long")
    return (ranked.select("doc_id", "size", "source_size", "target", copies.alias("copies"), F.coalesce("rate", F.lit(0.0)).alias("rate"), *keep)
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "rate", *keep))
