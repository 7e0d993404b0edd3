"""Small helpers that the operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerflow

#: A word, everywhere in this folder unless an operator says otherwise: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: What the operators lower-case: ASCII letters only.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_shipped: set[str] = set()


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def whole_text(text: str = "text") -> Column:
    """The text, a null one read as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def lower_ascii(text: str = "text") -> Column:
    return F.translate(whole_text(text), UPPER, LOWER)


def texts_of(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def in_parts(texts: list[str], chars: int = 4_000_000) -> Iterator[list[str]]:
    """The texts in runs of about ``chars`` characters, so that what is made of them stays small."""
    held: list[str] = []
    size = 0
    for t in texts:
        if held and size + len(t) > chars:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(ledgerflow.__file__).resolve().parent
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp()), f"{top.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow by a function of this package."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def discard(written: DataFrame) -> None:
    """Remove the folders of a table that this run has written and no later step reads."""
    spark = written.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in written.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
