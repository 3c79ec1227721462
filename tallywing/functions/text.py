"""Splitting text at any of a set of delimiter characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def delimiter_class(delimiters: str) -> str:
    """The inside of a regex character class matching any character of ``delimiters``, or a line feed."""
    out = []
    for ch in sorted(set(delimiters) | {"\n"}):
        if ch == "\n":
            out.append(r"\n")
        elif ch == "\r":
            out.append(r"\r")
        elif ch == "\t":
            out.append(r"\t")
        elif ch.isascii() and not ch.isalnum() and ch != " ":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)


def tokens(text: Column, delimiters: str) -> Column:
    """Array of the pieces of ``text`` between runs of delimiters; never an empty piece."""
    return F.regexp_extract_all(text, F.lit(f"[^{delimiter_class(delimiters)}]+"), F.lit(0))
