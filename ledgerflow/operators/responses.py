"""Raw API responses as a table: outcome classification, retry worklist, payload normalisation, page flattening.

The original client made these decisions per request inside a driver-side event loop. Here every attempt is a row
of a response table ``(feed, key, attempt, status, payload, received_at)`` (status null = connection error or
timeout), and each decision is a column expression or a grouped aggregation that Spark distributes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow import schemas
from ledgerflow.functions.payload import bound, json_shape_ok, keyed_entry, parse
from ledgerflow.operators.sequence import with_neighbours

# Retry policy of each feed.
RETRY_STATUSES = {"activity": (420, 429), "details": (403, 420, 429), "reviews": (403, 420, 429)}
ATTEMPTS_PER_ROUND = {"activity": 5, "reviews": 3, "details": 1}
MAX_RETRY_ROUNDS = 3


def body_outcome(feed: Column, payload: Column, key: Column) -> Column:
    """Outcome of a 200 response by what its feed needs in the body.

    activity: an object under ``response``, else drop. reviews: an object under ``query_summary``, else error.
    details: under the item's key an object whose ``success`` is true and which has a ``data`` object -> ok,
    ``success`` false -> absent (the catalogue does not show the item; nothing to retry), else error.
    Any other feed: a JSON object, else error.
    """
    asked = (F.when(feed == "activity", "response").when(feed == "reviews", "query_summary")
             .when(feed == "details", key.cast("string")))

    def judged(body: Column) -> Column:      # the payload as a map, parsed once
        entry = F.try_element_at(body, asked)
        details = bound(F.from_json(entry, "struct<success:boolean,data:string>", {"mode": "PERMISSIVE"}), lambda e: (
            F.when(~e["success"], "absent").when(e["success"] & json_shape_ok(e["data"]), "ok").otherwise("error")))
        return (F.when(feed == "details", details)
                .when(feed.isin("activity", "reviews") & json_shape_ok(entry), "ok")
                .when(feed == "activity", "drop").when(feed == "reviews", "error")
                .otherwise(F.when(body.isNotNull(), "ok").otherwise("error")))

    return bound(F.from_json(payload, "map<string,string>"), judged)


def outcome(feed: Column, status: Column, payload: Column, key: Column) -> Column:
    """'ok' | 'absent' | 'retry' | 'drop' | 'error' for one attempt.

    200 -> by the body (:func:`body_outcome`); retry statuses per feed -> retry; connection error (null status) ->
    retry for activity, error for others (the original did not handle it); anything else -> drop.
    """
    retry_any = F.lit(False)
    for f, codes in RETRY_STATUSES.items():
        retry_any = retry_any | ((feed == f) & status.isin(*codes))
    is_act = feed == "activity"
    return (F.when(status.isNull(), F.when(is_act, "retry").otherwise("error"))
            .when(status == 200, body_outcome(feed, payload, key))
            .when(retry_any, "retry")
            .otherwise("drop"))


def classify(raw: DataFrame, feed: str = "feed", status: str = "status", payload: str = "payload",
             name: str = "outcome", key: str = "key") -> DataFrame:
    return raw.withColumn(name, outcome(F.col(feed), F.col(status), F.col(payload), F.col(key)))


def outcome_counts(classified: DataFrame, by: tuple[str, ...] = ("feed", "outcome")) -> DataFrame:
    """Run counters (valid / failed / totals) as one grouped count."""
    return classified.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def retry_worklist(attempts: DataFrame, key, attempt: str = "attempt", outcome_col: str = "outcome",
                   feed: str | None = "feed", max_rounds: int = MAX_RETRY_ROUNDS,
                   attempts_per_round: int | None = None) -> DataFrame:
    """Keys to re-issue: no attempt succeeded, the latest attempt says retry, and retry rounds remain.

    Grouped aggregation per key (partial aggregation; a key with many attempts still leaves each map task as one
    row): ``n`` attempts, final outcome = 'ok' if any attempt was ok, else the latest attempt's outcome.
    Rounds used = ceil(n / attempts per round); re-issue while rounds used <= ``max_rounds`` (the initial round
    plus ``max_rounds`` retry rounds in total).
    """
    keys = [key] if isinstance(key, str) else list(key)
    group = keys + ([feed] if feed and feed not in keys else [])
    best = F.max(F.struct((F.col(outcome_col) == "ok").alias("ok"), F.col(attempt).alias("a"),
                          F.col(outcome_col).alias("o")))
    agg = attempts.groupBy(*group).agg(best.alias("__b"), F.count(F.lit(1)).alias("n"))
    if attempts_per_round is not None:
        per_round = F.lit(attempts_per_round)
    elif feed:
        per_round = F.coalesce(*[F.when(F.col(feed) == f, F.lit(n)) for f, n in ATTEMPTS_PER_ROUND.items()],
                               F.lit(1))
    else:
        per_round = F.lit(1)
    rounds = F.ceil(F.col("n") / per_round)
    return (agg.where((F.col("__b.o") == "retry") & (rounds <= max_rounds))
            .select(*group, F.col("__b.o").alias(outcome_col), "n"))


def normalize(raw: DataFrame, feed: str, key: str = "key", payload: str = "payload",
              observed: str = "received_at", requested: str = "requested_at") -> DataFrame:
    """Typed feed rows from ok responses of one feed.

    activity: ``response.player_count`` (missing -> 0); details: ``<key>.data``, stamped with the time of the change
    that the worklist asked for (column ``requested``), so that the fetch covers it; reviews: ``query_summary``.
    Bodies that lack what the feed needs give no row (:func:`body_outcome`).
    """
    ok = classify(raw, payload=payload, key=key).where((F.col("feed") == feed) & (F.col("outcome") == "ok"))
    if feed == "activity":
        body = parse(payload, "struct<response:struct<player_count:bigint>>")
        return ok.select(F.col(key).cast("int").alias("appid"),
                         F.coalesce(body["response"]["player_count"], F.lit(0).cast("bigint")).alias("player_count"),
                         F.col(observed).alias("extracted_at"))
    if feed == "details":
        data_t = StructType([f for f in schemas.DETAILS.fields if f.name not in ("appid", "extracted_at",
                                                                                  "extracted_at_game")])
        entry = keyed_entry(payload, F.col(key), StructType().add("success", "boolean").add("data", data_t))
        rows = ok.select(F.col(key).cast("int").alias("appid"), entry.alias("__e"), F.col(observed),
                         *([F.col(requested)] if requested in raw.columns else []))
        listed = F.col(requested) if requested in rows.columns else F.lit(None).cast("timestamp")
        return rows.select("appid", listed.alias("extracted_at"),
                           *[F.col(f"__e.data.{f.name}").alias(f.name) for f in data_t.fields],
                           F.col(observed).alias("extracted_at_game"))
    if feed == "reviews":
        body = parse(payload, "struct<query_summary:struct<review_score:int,review_score_desc:string,"
                              "total_positive:bigint,total_negative:bigint,total_reviews:bigint>>")
        return ok.select(F.col(key).cast("int").alias("appid"), body["query_summary"].alias("__q"),
                         F.col(observed).alias("extracted_at")).select("appid", "__q.*", "extracted_at")
    raise ValueError(f"unknown feed {feed!r}")


def flatten_pages(pages: DataFrame, payload: str = "payload", extracted_at=None) -> DataFrame:
    """Catalogue pages (one JSON response per row) -> one row per item, all stamped with one extraction time.

    Each page is parsed where it lies (no concatenation on the driver); ``extracted_at`` defaults to the
    query's ``current_timestamp()``, which Spark evaluates once per query.
    """
    stamp = F.current_timestamp() if extracted_at is None else F.lit(extracted_at).cast("timestamp")
    apps = F.explode(parse(payload, schemas.CATALOG_PAGE)["response"]["apps"]).alias("__a")
    return pages.select(apps).select("__a.*", stamp.alias("extracted_at"))


def page_chain(pages: DataFrame, payload: str = "payload", start: str | None = None, chain: str | None = None) -> DataFrame:
    """Catalogue pages linked by their cursor: one row per page with ``status``.

    A page asks for the items after a start, and says in ``last_appid`` where the next one is to start and in
    ``have_more_results`` whether one follows. (chain, first_appid, last_appid, n_apps, start, status), status by the
    first that holds: ``malformed`` (no page), ``overlap`` (it begins at or before the end of the page before it), ``gap``
    (its start is not that end; only where ``start`` names a column of the cursors asked with), ``after_end`` (the page
    before said that none follows), ``unended`` (the last page says that more follow), else ``ok``. ``chain``: a column that
    tells catalogues apart (null: one of its own). Pages are few beside their items: a chain's pages meet by their cursor.
    """
    body = parse(payload, schemas.CATALOG_PAGE)["response"].alias("r")
    name = F.coalesce(F.col(chain).cast("string"), F.lit("")) if chain else F.lit("")
    rows = pages.select(name.alias("chain"), body, (F.col(start).cast("long") if start else F.lit(None).cast("long")).alias("start"),
                        F.xxhash64(payload).alias("page"))
    ids = F.col("r.apps.appid")
    last = F.coalesce(F.col("r.last_appid"), F.array_max(ids)).cast("long")
    rows = rows.select("chain", F.array_min(ids).cast("long").alias("first_appid"), last.alias("last_appid"),
                       F.coalesce(F.size("r.apps"), F.lit(0)).alias("n_apps"), "start",
                       F.coalesce("r.have_more_results", F.lit(False)).alias("more"), F.lit(True).alias("there"), "page")
    whole = F.col("last_appid").isNotNull()
    nb = with_neighbours(rows.where(whole), "chain", ["last_appid", "first_appid", "page"], ["last_appid", "more", "there"], prev="p_", nxt="n_")
    begins = F.least(F.col("first_appid"), F.col("start") + 1)
    status = (F.when(begins <= F.col("p_last_appid"), "overlap")
              .when(F.col("p_there") & (F.col("start") != F.col("p_last_appid")), "gap")
              .when(F.col("p_there") & ~F.col("p_more"), "after_end")
              .when(F.col("n_there").isNull() & F.col("more"), "unended").otherwise("ok"))
    cols = ["chain", "first_appid", "last_appid", "n_apps", "start"]
    return nb.select(*cols, status.alias("status")).unionByName(rows.where(~whole).select(*cols, F.lit("malformed").alias("status")))


def chain_complete(checked: DataFrame) -> DataFrame:
    """(chain, pages, complete) of :func:`page_chain`: complete when every page of a chain is ``ok``."""
    return checked.groupBy("chain").agg(F.count(F.lit(1)).alias("pages"), F.every(F.col("status") == "ok").alias("complete"))
