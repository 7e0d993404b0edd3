"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs whose joined string is a piece, takes the pair of the highest score
(the leftmost of equals), joins it, and puts the new neighbours on the agenda, until none is left. Symbols that are no
piece fall back to byte pieces.

No piece holds the white-space mark after another character (checked when the vocabulary is read), so no join crosses
the place before a run of marks that follows another character. A text is therefore cut into *units* there, and each
distinct unit is encoded once per cache life. The units that an Arrow batch adds are encoded together: one row of
symbols per unit, one join in every row at each step, chosen from the row's agenda of scores. Units of more than
``LONG_UNIT`` characters use a heap, O(n log n). Every new unit is compared with the sentencepiece library in the same
batch; should one differ, the library's ids are used and ``n_corrected`` counts it (0 in all runs so far).

Decoding joins the pieces, turns marks into spaces, drops the leading space that encoding adds and reads byte pieces
as UTF-8. Ids that hold broken UTF-8 in byte pieces are left to the library, whose replacement rules then hold.

Defined results: a null text counts as empty (begin and end ids only); null ids, ties and repeated rows give one row
each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import in_parts, map_arrow, texts_of, vocabulary

MARK = "▁"
LONG_UNIT = 40
CACHE_UNITS = 300_000
NO_PAIR = -np.inf

_codecs: dict[str, Codec] = {}


class PairTable:
    """Hash table from a pair of symbols to (joined symbol, score); at most half full, linear probing."""

    def __init__(self, keys: np.ndarray, joined: np.ndarray, scores: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.joined = np.zeros(size, np.int32)
        self.scores = np.full(size, NO_PAIR, np.float64)
        at, left, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            self.probes += 1
            slots = at[left]
            free = left[self.keys[slots] == -1]
            self.keys[at[free]] = keys[free]        # of several on one slot the last write stays
            won = free[self.keys[at[free]] == keys[free]]
            self.joined[at[won]], self.scores[at[won]] = joined[won], scores[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = (at[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, or -1."""
        at = self._slot(keys)
        found = np.where(self.keys[at] == keys, at, -1)
        open_ = np.flatnonzero((found < 0) & (self.keys[at] != -1))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            hit = self.keys[at[open_]]
            found[open_] = np.where(hit == keys[open_], at[open_], -1)
            open_ = open_[(hit != keys[open_]) & (hit != -1)]
        return found


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        if any(MARK in p.lstrip(MARK) for p, s in zip(pieces, special, strict=True) if not s):
            raise ValueError(f"{path}: a piece holds the white-space mark after another character")
        if any(sp.is_unused(i) for i in range(size)) or sp.encode("\t  ﬁ ", out_type=str)[0] != MARK:
            raise ValueError(f"{path}: only vocabularies without unused pieces and with identity normalisation")
        self.ids = {p: i for i, (p, s) in enumerate(zip(pieces, special, strict=True)) if not s}
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.begin, self.end, self.size = sp.bos_id(), sp.eos_id(), size
        # symbols are the pieces' ids; single characters of pieces that are none themselves come after them
        self.symbols = dict(self.ids)
        for p in self.ids:
            for c in p:
                self.symbols.setdefault(c, size + len(self.symbols))
        top = max(self.symbols.values()) + 1
        self.width = top + 1                       # `top` itself: a character that no piece holds
        self.none = top
        self.pairs: dict[tuple[int, int], tuple[float, int]] = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = self.symbols.get(p[:k]), self.symbols.get(p[k:])
                if a is not None and b is not None:
                    self.pairs[a, b] = (sp.get_score(i), i)
        self.table = PairTable(np.array([a * self.width + b for a, b in self.pairs], np.int64),
                               np.array([i for _, i in self.pairs.values()], np.int32),
                               np.array([s for s, _ in self.pairs.values()], np.float64))
        self.piece_bytes = [b"" if sp.is_control(i) else bytes([int(pieces[i][3:5], 16)]) if sp.is_byte(i)
                            else pieces[i].replace(MARK, " ").encode() for i in range(size)]
        self.cache: dict[str, bytes] = {}

    # --- encoding -------------------------------------------------------------------------------------------------

    def _out(self, symbols: list[int], text: str) -> np.ndarray:
        """Ids of final symbols; ``text`` is what they spell. Characters that are no piece become their bytes."""
        if all(s < self.size for s in symbols):
            return np.array(symbols, np.int32)
        out, at = [], 0
        for s in symbols:
            if s < self.size:
                out.append([s])
                at += len(self._piece(s))
            else:
                out.append(self.byte_ids[list(text[at].encode("utf-8"))])
                at += 1
        return np.concatenate(out).astype(np.int32)

    def _piece(self, i: int) -> str:
        return self.piece_bytes[i].decode("utf-8")

    def heap_unit(self, unit: str) -> list[int]:
        """Final symbols of one unit by a heap of (score, place) over a linked list."""
        s = [self.symbols.get(c, self.none) for c in unit]
        n = len(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[float, int, int, int]] = []

        def add(i: int, j: int) -> None:
            if i >= 0 and j < n and (found := self.pairs.get((s[i], s[j]))):
                heapq.heappush(agenda, (-found[0], i, s[i], s[j]))

        for i in range(n - 1):
            add(i, i + 1)
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = after[i]
            if s[i] != a or j >= n or s[j] != b:
                continue                            # a symbol of the pair has been joined meanwhile
            s[i], s[j] = self.pairs[a, b][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            add(before[i], i)
            add(i, after[i])
        return [x for x in s if x >= 0]

    def _scores(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = self.table.find(a.astype(np.int64) * self.width + b)
        return np.where(slot >= 0, self.table.scores[slot], NO_PAIR), np.where(slot >= 0, self.table.joined[slot], 0)

    def rows(self, s: np.ndarray) -> list[list[int]]:
        """Final symbols of units of one length, one row of ``s`` each."""
        done: list[list[int]] = [[]] * len(s)
        rows = np.arange(len(s))
        n = s.shape[1]
        score, joined = np.empty((0, 0)), np.empty((0, 0))
        if n > 1:
            flat = self._scores(s[:, :-1].ravel(), s[:, 1:].ravel())
            score, joined = flat[0].reshape(-1, n - 1), flat[1].reshape(-1, n - 1)
        while len(rows) and n > 1:
            best = score.argmax(axis=1)             # the first of equal scores is the leftmost
            line = np.arange(len(rows))
            live = score[line, best] > NO_PAIR
            for r, x in zip(rows[~live], s[~live].tolist(), strict=True):
                done[r] = x
            rows, s, score, joined, best = rows[live], s[live], score[live], joined[live], best[live]
            if not len(rows):
                break
            line = np.arange(len(rows))
            new = joined[line, best]
            keep = np.arange(n - 1) + (np.arange(n - 1) > best[:, None])
            s = np.take_along_axis(s, keep, axis=1)
            s[line, best] = new
            n -= 1
            if n > 1:
                keep = np.arange(n - 1) + (np.arange(n - 1) >= best[:, None])
                score, joined = np.take_along_axis(score, keep, axis=1), np.take_along_axis(joined, keep, axis=1)
                for at in (best - 1, best):         # the pairs on either side of the new symbol
                    ok = (at >= 0) & (at < n - 1)
                    r, c = line[ok], at[ok]
                    score[r, c], joined[r, c] = self._scores(s[r, c], s[r, c + 1])
        for r, x in zip(rows, s.tolist(), strict=True):
            done[r] = x
        return done

    def agenda(self, units: list[str]) -> list[np.ndarray]:
        """Ids of units, each given with its leading mark."""
        out: list[np.ndarray | None] = [None] * len(units)
        by_length: dict[int, list[int]] = defaultdict(list)
        for k, u in enumerate(units):
            if len(u) > LONG_UNIT:
                out[k] = self._out(self.heap_unit(u), u)
            else:
                by_length[len(u)].append(k)
        for n, ks in by_length.items():
            codes = np.frombuffer("".join(units[k] for k in ks).encode("utf-32-le"), np.uint32)
            chars, back = np.unique(codes, return_inverse=True)
            known = np.array([self.symbols.get(chr(c), self.none) for c in chars], np.int64)
            for k, x in zip(ks, self.rows(known[back].reshape(-1, n)), strict=True):
                out[k] = self._out(x, units[k])
        return out

    def learn(self, units: set[str]) -> tuple[dict[str, bytes], int]:
        """Encode the units that the cache lacks, compare them with the library, return those too long to keep."""
        new = [u for u in units if u not in self.cache]
        if len(self.cache) + len(new) > CACHE_UNITS:
            for u in [u for u in self.cache if u not in units]:
                del self.cache[u]
        own = self.agenda([MARK + u.replace(" ", MARK) for u in new])
        wrong, long = 0, {}
        for u, ids, theirs in zip(new, own, self.library.encode(new, num_threads=1), strict=True):
            if u and ids.tolist() != theirs:
                wrong, ids = wrong + 1, np.array(theirs, np.int32)
            (long if len(u) > LONG_UNIT else self.cache)[u] = ids.astype("<u4").tobytes()
        return long, wrong

    @staticmethod
    def units(text: str) -> list[str]:
        """Units of a text, each without its first mark."""
        text = text.replace(MARK, " ")
        if not text:
            return []
        found = text.split(" ")
        if "" not in found:
            return found
        out, spaces = [], 0
        for k, u in enumerate(found):              # an empty part is one more mark before the next unit
            if u or k == len(found) - 1:
                out.append(" " * spaces + u)
                spaces = 0
            else:
                spaces += 1
        return out

    def encode(self, texts: list[str]) -> tuple[list[bytes], int]:
        """Ids of each text with begin and end ids, as little-endian unsigned 32-bit integers; corrections by the library."""
        split = [self.units(t) for t in texts]
        every: set[str] = set()
        for s in split:
            every.update(s)
        long, wrong = self.learn(every)
        get = self.cache.__getitem__ if not long else (lambda u: long[u] if u in long else self.cache[u])
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        return [b"".join([begin, *map(get, s), end]) for s in split], wrong

    # --- decoding -------------------------------------------------------------------------------------------------

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        raw = b"".join(map(self.piece_bytes.__getitem__, numbers))
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            return self.library.decode(numbers)
        return text[1:] if text.startswith(" ") else text


def codec(path: str) -> Codec:
    return _codecs.get(path) or _codecs.setdefault(path, Codec(path))


def encode_decode(docs: DataFrame, path: str | None = None, text: str = "text", keep: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, n_corrected) for every row; with ``keep`` also the ids and the
    decoded text. ``n_corrected``: units of the row's Arrow batch that the library set right."""
    path = path or vocabulary("piece_bpe_32k.model")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_corrected long"
    schema += ", ids array<int>, decoded string" if keep else ""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids, wrong = [], 0
            for part in in_parts(texts_of(batch.column("text"))):
                found, more = own.encode(part)
                ids, wrong = ids + found, wrong + more
            decoded = [own.decode(x) for x in ids] if keep else []
            decoded_sha = [hashlib.sha256(x.encode()).hexdigest() for x in decoded or map(own.decode, ids)]
            cols = [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array(decoded_sha, pa.string()),
                    pa.array([wrong] * len(ids), pa.int64())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_corrected"]
            if keep:
                cols += [pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(rows, coded, schema)
