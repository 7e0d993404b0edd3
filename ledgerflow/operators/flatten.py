"""Flatten nested records: lift struct fields, join arrays of labels into text, drop the consumed structs.

Everything happens in ONE ``select`` so the result does not depend on the order of the steps (a chain of
``withColumn`` calls that overwrites a struct before reading its sibling field gives a different answer).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import LABEL_SEPARATOR, join_labels


@dataclass(frozen=True)
class FlattenSpec:
    lift: dict[str, str] = field(default_factory=dict)     # output column -> dotted path ("price_overview.final")
    join: dict[str, str] = field(default_factory=dict)     # output column -> path to array<string> ("genres.description")
    drop: tuple[str, ...] = ()                             # top-level columns removed after lifting
    sep: str = LABEL_SEPARATOR


# The catalogue details record and the flat names its history table uses.
DETAILS_SPEC = FlattenSpec(
    lift={
        "currency": "price_overview.currency",
        "initial_price": "price_overview.initial",
        "final_price": "price_overview.final",
        "discount_percent": "price_overview.discount_percent",
        "metacritic_score": "metacritic.score",
        "coming_soon": "release_date.coming_soon",
        "release_date": "release_date.date",
    },
    join={"genres": "genres.description", "categories": "categories.description"},
    drop=("price_overview", "metacritic"),
)


def flatten(df: DataFrame, spec: FlattenSpec) -> DataFrame:
    """Apply ``spec``. A null struct gives null lifted fields; a null/empty array gives '' (never null).

    Output order: untouched columns in their original order (a replaced column keeps its position), then new ones.
    Nested-schema pruning lets the parquet scan read only the lifted leaves.
    """
    produced = {**{k: F.col(v) for k, v in spec.lift.items()},
                **{k: join_labels(F.col(v), spec.sep) for k, v in spec.join.items()}}
    out = []
    for c in df.columns:
        if c in spec.drop and c not in produced:
            continue
        out.append(produced.pop(c).alias(c) if c in produced else F.col(c))
    out.extend(expr.alias(name) for name, expr in produced.items())
    return df.select(*out)


def flatten_details(df: DataFrame) -> DataFrame:
    return flatten(df, DETAILS_SPEC)
