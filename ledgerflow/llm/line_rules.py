"""Line-first quality rules: every line is judged on its own, failing lines go, and a document that loses too much
of its text goes as a whole.

A line with at least one word fails if it
* repeats an earlier line of the document (``repeat``),
* ends without a sentence mark or closing quote or bracket and has no sentence end inside either (``end``),
* has three or more separators and one for every four words, as menus and link rows do (``navigation``),
* holds a phrase of cookie, account or script notices (``boilerplate``),
* has more than one symbol of ``[#*$%&|<>]`` for every two words (``symbols``), or
* has at least one exclamation mark for every two words, in three words or more (``shouting``).
Lines without a word neither fail nor count.

Before that a document fails as a whole (``base_failed``) with fewer than ``MIN_WORDS`` words, or if more than half of
its words stand in three-word windows that it holds twice or more. ``kept``: not base_failed, and the failing lines
have at most ``MAX_LOST_PERCENT`` of the code points that its words have.

Defined results: a null text counts as empty and is not kept; null ids, ties and repeated rows give one row each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import map_arrow, texts_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 30

# Marks that end a sentence or close it, separators of menus, symbols, phrases of notices.
END_MARKS = ".!?:;…\"'”»)]"
INNER_ENDS = (". ", "! ", "? ")
SEPARATORS = "|•›»"
SYMBOLS = "#*$%&|<>"
PHRASES = ("accept cookies", "all rights reserved", "click here", "cookie policy", "enable javascript", "log in",
           "lorem ipsum", "powered by", "privacy policy", "read more", "share this", "sign in", "sign up", "subscribe",
           "terms of use", "terms of service")

SPACES = " \t\n\x0b\x0c\r"
_NOTICE = re.compile("|".join(map(re.escape, PHRASES)))
_LOWER = {c: c + 32 for c in range(65, 91)}
_SYMBOL_BYTES = SYMBOLS.encode()
_CONTINUATION = bytes(range(0x80, 0xC0))


def _count(line: str, marks: str) -> int:
    return sum(map(line.count, marks))


def line_fault(line: str, n_words: int) -> str | None:
    """Name of the first rule that a line with ``n_words`` words fails (but for ``repeat``, which needs its text)."""
    if line.rstrip(SPACES)[-1] not in END_MARKS and not any(e in line for e in INNER_ENDS):
        return "end"
    n = _count(line, SEPARATORS)
    if n >= 3 and 4 * n >= n_words:
        return "navigation"
    if 2 * _count(line, SYMBOLS) > n_words:
        return "symbols"
    if n_words >= 3 and 2 * line.count("!") >= n_words:
        return "shouting"
    if _NOTICE.search(line.translate(_LOWER)):
        return "boilerplate"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a three-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    v = len(number)
    pairs = ids[:-2] * v + ids[1:-1]
    if v > 2_000_000:   # the key of three numbers would not fit
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs * v + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    found = np.zeros(n, bool)
    twice = np.concatenate([order[1:][same], order[:-1][same]])
    for k in range(3):
        found[twice + k] = True
    return int(found.sum())


def clean_text(text: str) -> dict:
    """All that the operator knows of one text; ``text`` is what its passing lines leave."""
    raw = text.encode("utf-8")
    words = raw.split()
    chars = lambda ws: sum(map(len, ws)) - sum(len(w) - len(w.translate(None, _CONTINUATION)) for w in ws)
    if raw.isascii():
        chars = lambda ws: sum(map(len, ws))
    n_chars, n_dup, lost, seen, passed = chars(words), 0, 0, set(), []
    for line in text.split("\n"):
        own = line.encode("utf-8").split()
        if own:
            repeat = line in seen
            n_dup += repeat
            seen.add(line)
            if repeat or line_fault(line, len(own)):
                lost += chars(own)
                continue
        passed.append(line)
    n_repeat = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * len(words)
    return {"n_words": len(words), "word_chars": n_chars, "n_symbols": len(raw) - len(raw.translate(None, _SYMBOL_BYTES)),
            "n_dup_lines": n_dup, "n_repeat_words": n_repeat, "base_failed": failed,
            "kept": not failed and 100 * lost <= MAX_LOST_PERCENT * n_chars, "lost_chars": lost,
            "text": "\n".join(passed)}


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, lost_chars long, text string")


def clean_lines(docs: DataFrame, text: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: its measures, the verdict and (``with_text``) the cleaned text."""
    names = [c.split()[0] for c in SCHEMA.split(", ")][: None if with_text else -1]
    schema = ", ".join(SCHEMA.split(", ")[: len(names)])

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [clean_text(t) for t in texts_of(batch.column("text"))]
            cols = [pa.array([f[n] for f in found],
                             pa.string() if n == "text" else pa.bool_() if n in ("kept", "base_failed") else pa.int64())
                    for n in names[1:]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_arrow(rows, cleaned, schema)


def _sql_list(marks: str) -> str:
    return "(" + " + ".join(f"(length(l) - length(replace(l, '{m.replace(chr(39), chr(39) * 2)}', '')))" for m in marks) + ")"


#: The same over the view ``documents``, for DuckDB.
LINE_RULES_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
k AS (SELECT rid, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT rid, i, a || ' ' || lead(a) OVER o || ' ' || lead(a, 2) OVER o AS key FROM k
      WINDOW o AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, key) AS c FROM g WHERE key IS NOT NULL) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + j) AS n FROM r, (VALUES (0), (1), (2)) AS v(j) GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
lw AS (SELECT rid, l, i, len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')) AS n,
              length(regexp_replace(l, '[\\x20\\x09-\\x0D]', '', 'g')) AS c,
              row_number() OVER (PARTITION BY rid, l ORDER BY i) AS nth FROM ln),
lf AS (SELECT rid, nth > 1 AS dup, c,
              nth > 1
              OR NOT contains('{END_MARKS.replace("'", "''")}', right(rtrim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1))
                 AND NOT (contains(l, '. ') OR contains(l, '! ') OR contains(l, '? '))
              OR ({_sql_list(SEPARATORS)} >= 3 AND 4 * {_sql_list(SEPARATORS)} >= n)
              OR 2 * {_sql_list(SYMBOLS)} > n
              OR (n >= 3 AND 2 * {_sql_list('!')} >= n)
              OR regexp_matches(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{"|".join(PHRASES)}') AS bad
       FROM lw WHERE n > 0),
la AS (SELECT rid, count(*) FILTER (WHERE dup) AS n_dup, coalesce(sum(c) FILTER (WHERE bad), 0) AS lost FROM lf GROUP BY rid),
m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
             coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_chars
      FROM w LEFT JOIN la USING (rid) LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost_chars <= {MAX_LOST_PERCENT} * word_chars AS kept, lost_chars FROM b
"""
