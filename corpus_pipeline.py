"""A training corpus from raw documents: quality, near duplicates, repeated passages, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; ``run`` writes every stage's
rows as Parquet in the shared folder and reads them again for the next one. All stages but the last return the columns
of ``documents``. Rows may repeat after the mix: a document taken twice is there twice.

Defined results, for every stage: a null text counts as empty and has no words (the quality stage rejects it, later
stages keep it); null ids, languages and sources are values of their own; rows equal in id and text are one document to
the near-duplicate stage, whose least row (language, source, length) stays, and copies of one document to the mix; empty
tables give no rows; columns beside those of ``documents`` are not read. The module docstrings of ``ledgerflow.llm``
say the same of each operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import kn_quality, sentencepiece_codec, simhash_gray, source_mix, suffix_dedup
from ledgerflow.llm.common import read_documents
from ledgerflow.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: A repeated passage: about 50 words, of four letters and a blank each.
PASSAGE = suffix_dedup.Shape(length=250, window=160)


def _with_tie(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS).withColumn("tie", F.xxhash64(F.col("text").cast("string")))


def _join(docs: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """Join on (doc_id, tie), null ids included."""
    found = found.withColumnsRenamed({"doc_id": "found_id", "tie": "found_tie"})
    on = docs["doc_id"].eqNullSafe(found["found_id"]) & (docs["tie"] == found["found_tie"])
    return docs.join(found, on, how)


def _first_of(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of each key, the least by the other columns; many rows of one key meet as one from each task."""
    rest = [c for c in ("lang", "source", "n_chars", "text") if c not in keys]
    return rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("one")).select(*keys, "one.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier, trained on the trusted rows of ``docs``, does not reject."""
    verdict = kn_quality.classify(docs, kn_quality.read_labels(spark, sf_dir))
    # rows equal in id and text but not in language may differ in their verdict: the language is part of the key
    kept = verdict.filter("kept").select("doc_id", "tie", "lang").distinct()
    docs, kept = _with_tie(docs), kept.withColumnRenamed("lang", "found_lang")
    kept = kept.withColumnsRenamed({"doc_id": "found_id", "tie": "found_tie"})
    on = docs["doc_id"].eqNullSafe(kept["found_id"]) & (docs["tie"] == kept["found_tie"]) & docs["lang"].eqNullSafe(kept["found_lang"])
    return docs.join(kept, on, "left_semi").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component (four-word shingles, four bits): that of the least doc_id, of equal ids that of
    the least text hash."""
    found = simhash_gray.near_duplicates(docs, words=4, bits=4)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "tie")).alias("one"))
    kept = _join(_with_tie(docs), first.select("one.doc_id", "one.tie"), "left_semi")
    # rows equal in id and text are one group's too; the rest of their columns decides
    return _first_of(kept, "doc_id", "tie").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeats of ``PASSAGE`` cover; rows left without a word go."""
    out = suffix_dedup.dedup(docs, with_text=True, carry=COLUMNS[2:], shape=PASSAGE)
    chars = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    out = out.withColumn("n_chars", chars)
    return out.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*COLUMNS)


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it."""
    rows = _with_tie(docs).withColumn("src", F.struct(F.col("source").isNull().alias("missing"), F.coalesce("source", F.lit("")).alias("name")))
    mixed = source_mix.mix(docs, keep=("tie", "src"))
    # copies are told apart by nothing but (id, text, source): their sum goes to the first of such rows
    total = mixed.groupBy("doc_id", "tie", "src").agg(F.sum("copies").alias("copies")).filter("copies > 0")
    total = total.withColumnsRenamed({"doc_id": "found_id", "tie": "found_tie", "src": "found_src"})
    first = _first_of(rows, "doc_id", "tie", "src")
    on = (first["doc_id"].eqNullSafe(total["found_id"]) & (first["tie"] == total["found_tie"]) & (first["src"] == total["found_src"]))
    taken = first.join(total, on)
    return taken.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded again."""
    return sentencepiece_codec.encode_decode(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("source_weights", source_weights), ("token_ids", token_ids)]

#: SQL has no form for fingerprints, byte spans or token ids; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select(*COLUMNS)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
