"""Token counts of whole texts by a byte-level BPE vocabulary, huge texts in overlapping chunks.

A text is encoded in *units*. A unit starts at a space that has a non-space character on either side. The byte-level
pre-tokenizer never joins what stands before such a space with what follows it (its white-space alternatives fail on
a single space before a non-space character, and every other alternative takes that space as its first character
only), merges stay inside a pre-token, and added tokens contain no space. So a unit's tokens do not depend on what
surrounds it, and the library encodes each distinct unit once per cache life.

A text of more than ``chunk_chars`` characters is encoded in chunks that overlap, each with its tokens' offsets. Two
chunks are resynchronised inside their overlap: the seam is the first unit start at which both have a token end and from
which both have the same tokens up to the next unit start. Three characters decide whether a place starts a unit, and
either chunk sees all three, so the seam is proven for the whole text. Tokens before it are taken from the left chunk,
those from it on from the right one, which is then the left one of the next pair: a chunk is encoded once. Where no seam
is found (a long run without spaces), the overlap is doubled and the left chunk made longer by it, up to the text's end.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows, null ids and ties give one row each;
an empty table gives no rows; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Encoding

from ledgerflow.llm.common import in_parts, map_arrow, texts_of, vocabulary, whole_text

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024
CACHE_UNITS = 400_000
PART_CHARS = 1_000_000
ROWS = 1_000                       # of a batch turned into strings at once
LONG_UNIT = 64
UNIT_START = re.compile(r" (?=\S)(?<=\S )")      # the space first: the search then leaps from one to the next

_counters: dict[str, UnitCounter] = {}


class UnitCounter:
    """Counts of a tokenizer file, one per Python worker; the cache is emptied when it is full."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        added = all(" " not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])
                    for t in spec["added_tokens"])
        if not (plain and added and spec["normalizer"] is None):
            raise ValueError(f"{path}: unit boundaries are proven for plain byte-level vocabularies only")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.first: dict[str, int] = {}   # units at a text's or chunk's start, without a space
        self.later: dict[str, int] = {}   # units after a space, kept without it

    def learn(self, units: set[str], cache: dict[str, int], prefix: str) -> list[str]:
        """Put counts of units that the cache lacks into it; the long ones of these, which are not to stay."""
        new = list(units.difference(cache))
        if len(cache) + len(new) > CACHE_UNITS:
            held = {u: cache[u] for u in units if u in cache}
            cache.clear()
            cache.update(held)
        found = self.tokenizer.encode_batch_fast([prefix + u for u in new], add_special_tokens=False)
        cache.update((u, len(e)) for u, e in zip(new, found, strict=True))
        return [u for u in new if len(u) > LONG_UNIT]

    def counts(self, texts: list[str]) -> list[int]:
        """For each text the tokens of all its units."""
        split = [UNIT_START.split(t) for t in texts]
        heads = [s.pop(0) for s in split]
        long_first = self.learn(set(heads), self.first, "")
        long_later = self.learn(set().union(*split), self.later, " ")
        get = self.later.__getitem__
        result = [self.first[h] + sum(map(get, s)) for h, s in zip(heads, split, strict=True)]
        for long, cache in ((long_first, self.first), (long_later, self.later)):
            for u in long:
                del cache[u]
        return result

    def chunk(self, text: str, start: int, end: int) -> tuple[int, Encoding]:
        """The start and the tokens, with their offsets, of text[start:end]."""
        return start, self.tokenizer.encode(text[start:end], add_special_tokens=False)

    @staticmethod
    def upto(chunk: tuple[int, Encoding], low: int, high: int) -> dict[int, int]:
        """Of the token ends from ``low`` to ``high``: how many tokens the chunk has up to there."""
        start, e = chunk
        place = lambda k: start + e.token_to_chars(k)[1]
        found = {}
        for k in range(bisect_left(range(len(e)), low, key=place), len(e)):
            at = place(k)
            if at > high:
                break
            found[at] = k + 1
        return found

    def seam(self, text: str, left: tuple, right: tuple, low: int, high: int) -> tuple[int, int, int] | None:
        """(tokens of the left chunk before the seam, tokens of the right one before it, its offset), for chunks that both
        hold text[low:high]."""
        upto = [self.upto(c, low, high) for c in (left, right)]
        ids = [c[1].ids for c in (left, right)]
        starts = [low + m.start() for m in UNIT_START.finditer(text[low:high])]
        for p, q in zip(starts, starts[1:], strict=False):
            if all(z in u for z in (p, q) for u in upto):
                if ids[0][upto[0][p]:upto[0][q]] == ids[1][upto[1][p]:upto[1][q]]:
                    return upto[0][p], upto[1][p], p
        return None

    def spliced(self, text: str, chunk_chars: int, overlap_chars: int) -> tuple[int, int, int]:
        """Tokens of a huge text, chunks encoded and widenings that it took."""
        size, end, tokens, widened = len(text), min(len(text), chunk_chars), 0, 0
        left, taken, chunks = self.chunk(text, 0, end), 0, 1          # ``taken``: tokens of ``left`` before its seam
        seam, overlap = 0, overlap_chars
        while end < size:
            low = max(seam, end - overlap)
            high = min(size, max(low + chunk_chars, end + overlap))
            right = self.chunk(text, low, high)
            chunks += 1
            found = self.seam(text, left, right, low, end)
            if found is None:
                widened, overlap = widened + 1, 2 * overlap
                end = min(size, end + overlap)
                left = self.chunk(text, seam, end)                        # a seam is where a text may as well begin
                taken, chunks = 0, chunks + 1
                continue
            tokens += found[0] - taken
            left, end, taken, seam, overlap = right, high, found[1], found[2], overlap_chars
        return tokens + len(left[1]) - taken, chunks, widened


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 1024, chunk_chars: int = CHUNK_CHARS,
                 overlap_chars: int = OVERLAP_CHARS, text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, n_chunks, n_widened) for every row of ``docs``."""
    path = path or vocabulary("byte_bpe_50k.json")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(path) or _counters.setdefault(path, UnitCounter(path))
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            texts = texts_of(batch.column("text"))
            short = [i for i, t in enumerate(texts) if len(t) <= chunk_chars]
            result = [(0, 1, 0)] * len(texts)
            counts = [n for part in in_parts([texts[i] for i in short], PART_CHARS) for n in counter.counts(part)]
            for i, n in zip(short, counts, strict=True):
                result[i] = (n, 1, 0)
            for i, t in enumerate(texts):
                if len(t) > chunk_chars:
                    result[i] = counter.spliced(t, chunk_chars, overlap_chars)
            cols = [pa.array([r[k] for r in result], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *cols],
                                             ["doc_id", "n_bytes", "n_tokens", "n_chunks", "n_widened"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.select("doc_id", F.octet_length(whole_text()).cast("long").alias("n_bytes"), "text")
    out = map_arrow(rows, counted, "doc_id long, n_bytes long, n_tokens long, n_chunks long, n_widened long")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks",
                      "n_widened")
