"""Text handling with the white space and line rules of the script scanner."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters cut from both ends of a line, and the marks that end a line.
WHITE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
OTHER_LINE_ENDS = ("\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029")

# Text between single quotes; a doubled quote reads as two texts side by side.
QUOTED_TEXT = "'[^']*+'"


def _line_feeds(content: Column) -> Column:
    """Line ends as a text file reader sees them."""
    return F.when(F.contains(content, F.lit("\r")), F.regexp_replace(content, r"\r\n?", "\n")).otherwise(content)


def file_lines(content: Column) -> Column:
    """Lines as a text file reader sees them; the usual case splits on one plain character."""
    return F.split(_line_feeds(content), "\n")


def count_file_lines(content: Column) -> Column:
    """Line feeds plus one."""
    plain = _line_feeds(content)
    return F.length(plain) - F.length(F.replace(plain, F.lit("\n"), F.lit(""))) + 1


def one_line_end(content: Column) -> Column:
    """Every kind of line end replaced by a line feed.

    Plain searches for each mark decide whether there is anything to replace: together they
    take a third of the time of one regular expression.
    """
    unusual = F.lit(False)
    for mark in OTHER_LINE_ENDS:
        unusual = unusual | F.contains(content, F.lit(mark))
    return F.when(unusual, F.regexp_replace(content, rf"\r\n|[{''.join(OTHER_LINE_ENDS)}]", "\n")).otherwise(content)


def strip(col: Column) -> Column:
    return F.regexp_replace(col, rf"^[{WHITE}]++|[{WHITE}]++\z", "")


def has_keyword(text: Column, keyword: Column | str, case_sensitive: bool = False) -> Column:
    word = F.lit(keyword) if isinstance(keyword, str) else keyword
    if case_sensitive:
        return F.contains(text, word)
    return F.contains(F.lower(text), F.lower(word))


def lead(words: str) -> str:
    """A regular expression of a phrase and the white space behind it.

    Words follow each other, ``A|B`` is one of several, ``[X Y]`` may be missing.
    """

    def run(text: str) -> str:
        return "".join((f"(?:{w})" if "|" in w else w) + r"\s++" for w in text.split())

    parts = re.findall(r"\[[^\]]*\]|\S+", words)
    return "".join(f"(?:{run(p[1:-1])})?" if p[0] == "[" else run(p) for p in parts)


def phrase(words: str) -> str:
    """The same without white space behind its last word, which must not be optional."""
    return lead(words).removesuffix(r"\s++")
