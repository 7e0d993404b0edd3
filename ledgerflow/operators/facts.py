"""Fact builders: rating fact, activity snapshot fact, price presentation view. Stateless, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import hour_of, ratio_pct, ratio_pct_parity, to_major_units


def rating(df: DataFrame, positive: str = "total_positive", total: str = "total_reviews",
           observed: str = "extracted_at", score: str = "review_score", day: str = "extracted_at_Date",
           keep: tuple[str, ...] = ("appid", "review_score_desc"), parity: bool = False) -> DataFrame:
    """Rows with ``total > 0``; score = positive share in percent; the UTC day of the observation.

    Default rounds once (2 places) and avoids the original's double noise (0.57 -> 56.99999999999999);
    ``parity=True`` reproduces ``round(p/n, 4) * 100``.
    """
    pct = ratio_pct_parity(positive, total) if parity else ratio_pct(positive, total, 2)
    return df.where(F.col(total) > 0).select(
        *keep, pct.alias(score), F.col(total), F.col(observed), F.to_date(observed).alias(day))


def snapshot(df: DataFrame, observed: str = "extracted_at", hour: str = "snapshot_hour",
             day: str = "snapshot_date") -> DataFrame:
    """Activity fact: hour and day of the observation, raw observation time dropped."""
    cols = [c for c in df.columns if c != observed]
    return df.select(*cols, hour_of(observed).alias(hour), F.to_date(observed).alias(day))


def price_view(df: DataFrame, key: str = "appid", version: str = "extracted_at_game",
               minor_cols: tuple[str, ...] = ("initial_price", "final_price"),
               keep: tuple[str, ...] = ("is_free", "short_description", "header_image", "release_date", "currency",
                                        "discount_percent", "metacritic_score", "coming_soon", "is_current"),
               day: str = "extracted_date") -> DataFrame:
    """Presentation view of the price history: minor -> major units, the extraction day; a pure projection."""
    return df.select(key, F.to_date(version).alias(day), *[c for c in keep if c in df.columns],
                     *[to_major_units(c).alias(c) for c in minor_cols])


def price_view_sql(table: str, key: str = "appid", version: str = "extracted_at_game",
                   minor_cols: tuple[str, ...] = ("initial_price", "final_price"),
                   keep: tuple[str, ...] = ("is_free", "short_description", "header_image", "release_date", "currency",
                                            "discount_percent", "metacritic_score", "coming_soon", "is_current"),
                   day: str = "extracted_date") -> str:
    """:func:`price_view` as the text of a view over a stored dimension: nothing is copied."""
    prices = [f"{c} / 100 AS {c}" for c in minor_cols]
    return f"SELECT {', '.join([key, f'to_date({version}) AS {day}', *keep, *prices])} FROM {table}"
