"""Line-first cleaning: rules judge each line, failing lines are removed, and a
document that loses more than half of its words is rejected.

Words are runs of characters other than space and U+0009 to U+000D; lines end
at a line feed. A line with words fails when one of these holds:

- punctuation: at least ``LONG_LINE`` words and no sentence mark in it; or at
  least five words of which 30 % end in an exclamation or question mark;
- symbols: at least one of ``#*$%&|<>`` for every three words (three or more);
- navigation: at least three separators, with three words or fewer between two
  on average;
- shouting: at least five words, 70 % of them in capitals;
- boilerplate: at most 25 words, with one of the fixed phrases;
- repetition: at least ten words, of which 30 % or fewer are different;
- duplicate: equal to an earlier line of the document.

A document also fails (base_failed) with under 50 words, or when over half of
its words lie in three-word windows found twice or more in it.

Everything is a map over the documents, with no shuffle; a text is read whole,
its words a megabyte at a time.

Defined cases: a null or empty text has no words and fails; equal rows get
equal rows; null doc_ids are kept; further columns are left out by ``judge``; an
empty table gives no row. Each document is judged alone, so there are no ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import as_array, bytes_of, word_blocks

SYMBOLS = b"#*$%&|<>"
LONG_LINE = 40
LEAST_WORDS = 50
MOST_LOST = 0.5
SENTENCE_MARKS = tuple(c.encode() for c in ".!?;:…。！？।؟")
SEPARATORS = tuple(c.encode() for c in "|»›•·>/")
#: Phrases of page furniture, in lower case.
BOILERPLATE = tuple(s.encode() for s in (
    "all rights reserved", "privacy policy", "cookie policy", "we use cookies", "accept cookies", "terms of use",
    "terms of service", "terms and conditions", "click here", "read more", "sign in", "sign up", "log in",
    "subscribe to our", "enable javascript", "javascript is disabled", "back to top", "skip to content",
    "share this", "follow us on", "powered by", "lorem ipsum", "copyright ©", "alle rechte vorbehalten",
    "tous droits réservés", "todos los derechos reservados"))
RULES = ("punctuation", "symbols", "navigation", "shouting", "boilerplate", "repetition", "duplicate")

_NOT_WORDS = bytes(range(128, 192)) + b"\x20\x09\x0a\x0b\x0c\x0d"  # UTF-8 continuation bytes, white space


class _Line:
    """Counts over one line, filled a block of words at a time."""

    def __init__(self) -> None:
        self.n = self.upper = self.shout = 0
        self.different: set[bytes] = set()

    def add(self, words: list[bytes]) -> None:
        self.n += len(words)
        self.upper += sum(map(bytes.isupper, words))
        self.shout += sum(w[-1] in b"!?" for w in words)
        self.different.update(words)

    def failed(self, line: bytes) -> str | None:
        """The first rule that the line fails."""
        n = self.n
        if n >= 5 and 10 * self.shout >= 3 * n:
            return "punctuation"
        if n >= LONG_LINE and not any(m in line for m in SENTENCE_MARKS):
            return "punctuation"
        symbols = len(line) - len(line.translate(None, SYMBOLS))
        separators = sum(map(line.count, SEPARATORS))
        if separators >= 3 and n - separators <= 3 * (separators + 1):
            return "navigation"
        if symbols >= 3 and 3 * symbols >= n:
            return "symbols"
        if n >= 5 and 10 * self.upper >= 7 * n:
            return "shouting"
        if n <= 25:
            lower = line.lower()
            if any(p in lower for p in BOILERPLATE):
                return "boilerplate"
        if n >= 10 and 10 * len(self.different) <= 3 * n:
            return "repetition"
        return None


def repeated_words(ids: np.ndarray, different: int) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(ids) < 4:
        return 0
    base = np.int64(different + 1)
    if different < 1 << 20:
        window = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    else:
        pair = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1].astype(np.int64)
        window = pair[:-1] * base + ids[2:]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    again = np.zeros(len(window), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    inside = np.zeros(len(ids), bool)
    for k in range(3):
        inside[k:k + len(window)] |= again
    return int(inside.sum())


def measure(raw: np.ndarray, start: int, end: int) -> tuple[dict, list[bytes]]:
    """Counts of one text, and the lines that stay."""
    text = raw[start:end].tobytes()
    known: dict[bytes, int] = {}
    parts, failed, seen, kept = [], dict.fromkeys(RULES, 0), set(), []
    n_words = kept_words = n_lines = duplicates = at = 0
    while at <= len(text):
        stop = text.find(b"\n", at)
        stop = len(text) if stop < 0 else stop
        line, counts = text[at:stop], _Line()
        for words in word_blocks(raw, start + at, start + stop):
            parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
            counts.add(words)
        at = stop + 1
        if not counts.n:
            kept.append(line)
            continue
        n_lines += 1
        n_words += counts.n
        rule = counts.failed(line)
        if line in seen:
            duplicates += 1
            rule = rule or "duplicate"
        seen.add(line)
        if rule:
            failed[rule] += 1
        else:
            kept.append(line)
            kept_words += counts.n
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    repeat = repeated_words(ids, len(known))
    base_failed = n_words < LEAST_WORDS or 100 * repeat > 50 * n_words
    return {"n_words": n_words, "word_chars": len(text.translate(None, _NOT_WORDS)),
            "n_symbols": len(text) - len(text.translate(None, SYMBOLS)), "n_dup_lines": duplicates,
            "n_repeat_words": repeat, "base_failed": base_failed,
            "kept": not base_failed and kept_words >= (1 - MOST_LOST) * n_words,
            "n_lines": n_lines, "n_removed_lines": sum(failed.values()), "n_kept_words": kept_words,
            **{f"lines_{rule}": failed[rule] for rule in RULES}}, kept


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_removed_lines", "n_kept_words", *(f"lines_{r}" for r in RULES))


def clean(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the counts, base_failed, kept, counts by rule, and
    clean_text (the lines that stay; null if the text is)."""
    schema = (f"doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}, base_failed boolean, kept boolean, "
              f"{', '.join(f'{c} long' for c in _MORE)}, clean_text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = as_array(batch.column(1))
            raw, off = bytes_of(text)
            size = max(1, 16_000_000 * batch.num_rows // max(1, int(off[-1] - off[0])))
            for k in range(0, batch.num_rows, size):
                rows = range(k, min(batch.num_rows, k + size))
                got = [measure(raw, off[i], off[i + 1]) for i in rows]
                columns = [pa.array([m[c] for m, _ in got], pa.int64()) for c in _COUNTS]
                columns += [pa.array([m[c] for m, _ in got], pa.bool_()) for c in ("base_failed", "kept")]
                columns += [pa.array([m[c] for m, _ in got], pa.int64()) for c in _MORE]
                lines = [b"\n".join(lines).decode("utf-8", "replace") if text[i].is_valid else None
                         for i, (_, lines) in zip(rows, got, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(k, len(got)), *columns, pa.array(lines, pa.string())],
                    ["doc_id", *_COUNTS, "base_failed", "kept", *_MORE, "clean_text"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def judge(docs: DataFrame) -> DataFrame:
    """clean() with the cleaned text as its checksum only."""
    return clean(docs).withColumn("clean_crc32", F.crc32(F.col("clean_text").cast("binary"))).drop("clean_text")
