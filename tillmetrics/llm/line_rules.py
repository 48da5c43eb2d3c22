"""Line-first cleaning: rules judge lines, and the text that they remove judges documents.

Each line passes or fails on its own: closing punctuation, navigation, boilerplate and
symbol rules. Failed lines go. A document that loses more than ``MOST_LOST`` of the
characters of its words, or nothing of which is left, is rejected; the cleaned text of the
others joins the lines that stay. Before that, two rules look at the whole text: too few
words, and too many words in windows of five that occur twice or more.

All numbers of a document come from one pass over its whole text. Rows are judged alone, so
nothing is shuffled, no row depends on another, and a lost task is simply run again.

Defined results: text null or empty: no words, base_failed, not kept, cleaned text empty.
Rows are kept as they are, repeated ones and null ids too; an empty table gives no rows.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import query, sliced, table

LEAST_WORDS = 10
#: Percent of the words that may lie in repeated windows.
MOST_REPEATED = 20
WINDOW = 5
#: Share of the characters in words that the line rules may remove.
MOST_LOST = 0.5

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
CLOSING = (b".", b"!", b"?", b":", b";", b'"', b"'", b")", b"\xe2\x80\x9d", b"\xc2\xbb", b"\xe2\x80\xa6")
#: A line without closing punctuation passes if it has at least so many words.
LONG_LINE = 8
#: A line is navigation if at least this share of its words are separators or links.
MOST_LINKS = 0.15
SEPARATOR = re.compile(rb"^(\||>|>>|/|\xc2\xbb|\xc2\xb7|\xe2\x80\xa2|-|http\S*|www\.\S*)$")
#: A line is noise if it has more than so many symbols or exclamation marks for each word.
MOST_SYMBOLS = 0.5
BOILERPLATE = re.compile(
    rb"all rights reserved|copyright (\(c\)|\xc2\xa9|\d{4})|privacy policy|terms of (use|service)|cookie|javascript|"
    rb"licen[sc]ed under|creative commons|sign (in|up)\b|log ?in\b|subscribe|click here|read more|lorem ipsum|powered by"
)

COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_lines_removed long, lost double"
)


def line_passes(line: bytes, words: list[bytes]) -> bool:
    """Rules for one line with at least one word."""
    low = line.lower()
    if len(words) < LONG_LINE and not line.rstrip(b" \t\r\v\f").endswith(CLOSING):
        return False
    if (b"|" in line or b">" in line or b"/" in line or b"http" in low) and sum(
        1 for w in words if SEPARATOR.match(w)
    ) >= MOST_LINKS * len(words):
        return False
    marks = len(line) - len(line.translate(None, SYMBOLS + b"!"))
    return marks <= max(1, MOST_SYMBOLS * len(words)) and not BOILERPLATE.search(low)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found twice or more."""
    windows = list(zip(*(words[k:] for k in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered, reached = 0, 0
    for at, w in enumerate(windows):
        if seen[w] > 1:
            covered += at + WINDOW - max(at, reached)
            reached = at + WINDOW
    return covered


def characters(data: bytes) -> int:
    return len(data) - len(data.translate(None, bytes(range(0xC0, 0x100)))) + len(data.translate(None, bytes(range(0x80, 0x100))))


def judge(text: str | None) -> tuple[tuple, str]:
    """The numbers and verdicts of one text, and its cleaned text."""
    words_of, stay = [], []
    kept_chars = dup_lines = removed = lines = 0
    known = set()
    for line in (text or "").encode().split(b"\n"):
        words = line.split()
        if not words:
            continue
        lines += 1
        if line in known:
            dup_lines += 1
        known.add(line)
        words_of.extend(words)
        if line_passes(line, words):
            stay.append(line)
            kept_chars += characters(b"".join(words))
        else:
            removed += 1
    chars = characters(b"".join(words_of))
    symbols = sum(line.count(s) for s in (bytes([c]) for c in SYMBOLS) for line in [(text or "").encode()])
    n, repeats = len(words_of), repeated_words(words_of)
    failed = n < LEAST_WORDS or 100 * repeats > MOST_REPEATED * n
    lost = 1 - kept_chars / chars if chars else 0.0
    kept = not failed and lost <= MOST_LOST
    return (n, chars, symbols, dup_lines, repeats, failed, kept, lines, removed, lost), b"\n".join(stay).decode()


def _judged(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                found = [judge(t) for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                columns = [part.column(part.schema.get_field_index("doc_id")), *map(pa.array, zip(*(row for row, _ in found)))]
                names = [c.split()[0] for c in COLUMNS.split(", ")]
                if with_text:
                    columns.append(pa.array([t for _, t in found]))
                    names.append("cleaned")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def line_first_cleaning(documents: DataFrame, with_text: bool = True) -> DataFrame:
    """Per row: measures, verdicts and, with ``with_text``, the text that is left."""
    return documents.select("doc_id", "text").mapInArrow(_judged(with_text), COLUMNS + ", cleaned string" * with_text)


@query("op4_line_rules")
def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_first_cleaning(table(spark, sf_dir, "documents"), with_text=False)
