"""Token ids of documents in ORC files: ids as integer run-length encoded lists, row indexes, Bloom filters on ids.

``write`` deals the documents out in ranges of (doc_id, hash of the text), encodes each range in that order and writes
one file per range. Each row holds its range, its place in it and the tokens before it in the range; ranges are few, so
the global start is the running sum of the ranges' totals plus the place's own sum: no task sees all rows. ``read``
reads the files back, stripe by stripe in parallel; a filter on doc_id prunes files and stripes by the column
statistics, row groups by the row index and the Bloom filter.

The vocabulary drops white space before it splits the text, so a text's ids are those of its parts between ASCII
blanks, one after the other; each distinct part is encoded once per cache life (a full cache is emptied between two
parts of a batch). Texts in ASCII are lower-cased before
the cache, as the vocabulary does itself, unless they may hold an added token.

Defined results: a null text is one of no tokens (the end id only). Null ids come first, ties in the order of the
text's hash; rows alike in both are interchangeable and are numbered as they come. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import in_parts, map_arrow, texts_of, vocabulary
from ledgerflow.session import fresh_dir

END_ID = 1
CACHE_PARTS = 800_000
LONG_PART = 64
# The pattern of the vocabulary, and the characters that its classes are plain for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = "[!-~À-ÖØ-öø-ÿ]*"
ORC_OPTIONS = {"compression": "zstd", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
               "orc.row.index.stride": "2000", "orc.stripe.size": str(32 << 20), "orc.create.index": "true"}
PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]

_encoders: dict[str, PartEncoder] = {}


class Lazy(dict):
    """Values made by ``make`` when first asked for; those of keys of over ``LONG_PART`` characters are not kept."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= LONG_PART:
            self[key] = value
        return value


class PartEncoder:
    """Ids (little-endian unsigned 32-bit) of a text's parts between blanks, one encoder per Python worker.

    A part of plain characters (``PLAIN``: in them lower-casing is one for one, normalisation changes nothing, and what
    is a letter or a digit is beyond doubt) is split by the vocabulary's own pattern and its pieces go to the
    vocabulary's model; any other part goes through the whole library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or steps[1]["content"] != " ":
            raise ValueError(f"{path}: only vocabularies that normalise white space and case are supported")
        split, *then = spec["pre_tokenizer"]["pretokenizers"]
        if split["behavior"] != "Removed" or not split["invert"] or "[^\\s" not in split["pattern"]["Regex"]:
            raise ValueError(f"{path}: white space must be dropped before the text is split")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens must not reach across white space")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        marks = {t["content"][:2] for t in spec["added_tokens"]}
        if not all(m.startswith("<") for m in marks):
            raise ValueError(f"{path}: added tokens must start with <")
        self.marked = re.compile("|".join(map(re.escape, sorted(marks))) or "(?!)").search
        in_bytes = [t["type"] for t in then] == ["ByteLevel"] and not then[0]["use_regex"] and not then[0]["add_prefix_space"]
        self.known = known = in_bytes and split["pattern"]["Regex"] == PATTERN and spec["model"]["type"] == "BPE" and not spec["model"]["dropout"]
        self.plain = re.compile(PLAIN if known else "(?!)").fullmatch
        self.pieces = re.compile(PATTERN.replace("\\p{L}", LETTERS).replace("\\p{N}", "0-9")).findall
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.in_bytes = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.words = Lazy(self._word)
        self.cache = Lazy(self._part)

    def _word(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.in_bytes))]
        return PACK[len(ids)](*ids) if len(ids) < len(PACK) else np.array(ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        if self.known and part.isascii() and part.isalpha():
            return self.words[part.lower()]
        if self.plain(part) and not ("<" in part and self.marked(part)):
            part = part.lower()
            return self.words[part] if part.isalpha() else b"".join(map(self.words.__getitem__, self.pieces(part)))
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) + len(self.words) > CACHE_PARTS:
            self.cache.clear()
            self.words.clear()
        out, get = [], self.cache.__getitem__
        for t in texts:
            if t.isascii() and not self.marked(t):
                t = t.lower()
            out.append(b"".join(map(get, t.replace("\n", " ").replace("\t", " ").split(" "))))
        return out


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, text: str = "text") -> None:
    """Write the ids of every text, each followed by ``end_id``, as ORC files in ascending doc_id order."""
    path = path or vocabulary("word_bpe_49k.json")
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoders.get(path) or _encoders.setdefault(path, PartEncoder(path))
        part, place, before = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            rows = [np.frombuffer(x + end, "<i4") for part_of in in_parts(texts_of(batch.column("text"))) for x in own.encode(part_of)]
            sizes = np.array([len(r) for r in rows], np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                             pa.array(np.concatenate(rows) if rows else [], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([part] * len(rows), pa.int32()), pa.array(range(place, place + len(rows)), pa.int64()),
                 pa.array(before + offsets[:-1], pa.int64()), pa.array(sizes, pa.int64()), lists],
                ["doc_id", "part", "place", "before", "n_tokens", "ids"])
            place, before = place + len(rows), before + int(offsets[-1])

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
            .withColumn("tie", F.xxhash64("text")).repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "tie")
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "text"))
    out = map_arrow(rows, encoded, "doc_id long, part int, place long, before long, n_tokens long, ids array<int>")
    out.write.options(**ORC_OPTIONS).orc(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts the ids of all documents before."""
    rows = spark.read.schema("doc_id long, part int, place long, before long, n_tokens long, ids array<int>").orc(folder)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))   # one row per file
    ahead = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("ahead"))
    # a row for each range that ``write`` dealt, so its bound is spark.sql.shuffle.partitions: the ids need no shuffle
    return (rows.join(F.broadcast(ahead), "part").select("doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "ids"))


def lookup(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """Rows of a few documents; files, stripes and row groups that cannot hold them are skipped."""
    return spark.read.orc(folder).filter(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def with_crc(rows: DataFrame, ids: str = "ids") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = lists.offsets.to_numpy()
            values = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crc = [zlib.crc32(values[4 * a:4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")),
                                              pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = rows.select("doc_id", "start", "n_tokens", F.col(ids).alias("ids"))
    return map_arrow(rows, summed, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``docs`` under the shared folder, read the files back and digest them."""
    folder = fresh_dir(docs.sparkSession, "token-ids")
    write(docs, folder, path)
    return with_crc(read(docs.sparkSession, folder))
