"""Fields of quoted CSV text, by position, in one pass over the text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A quoted text, with quotes inside doubled, up to the next comma or the end.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"(?=,|\z)'
#: A field: such a text at its very start, else whatever precedes the next comma. The usual field is settled by its first
#: part alone.
_FIELD = rf'[^,"]*+(?:(?<![^,]){_QUOTED}|"[^,]*+)?+'


def record(positions: Sequence[int], last: int) -> str:
    """A pattern of a whole record that has fields up to position ``last``, with a group for each of ``positions``.

    Fields between the wanted ones are passed over by a repetition, what follows the last one is taken as a whole. No part
    of the pattern gives back what it has taken, so the time is linear in the length of the text.
    """
    out, at = "", 0
    for position in sorted(positions):
        out += _skipped(position - at) + rf"({_FIELD})"
        at = position
        if position < last:
            out, at = out + ",", position + 1
        else:
            at = position + 1
    if at <= last:
        out += _skipped(last - at) + _FIELD
    return rf"(?s)\A{out}(?:,.*+)?+\z"


def _skipped(n: int) -> str:
    return rf'(?:[^,"]*+,|{_FIELD},){{{n}}}+' if n else ""


def wanted_fields(text: Column, positions: Sequence[int], last: int) -> Column:
    """An array of the fields of a line at ``positions`` (ascending, below 100 of them), as they stand, quotes and all.

    A line that does not reach position ``last`` gives one element, itself. The fields are put side by side with line feeds
    between, which a line of a text file never holds.
    """
    groups = "\n".join(f"${i + 1}" for i in range(len(positions)))
    return F.split(F.regexp_replace(text, record(positions, last), groups), "\n", -1)


def field(text: Column, position: int) -> Column:
    """The field at ``position``, unquoted; blank where the text has no such field. The text may hold line breaks."""
    return unquoted(F.regexp_extract(text, record([position], position), 1))


def unquoted(raw: Column) -> Column:
    """What a field says: without its quotes, and with doubled quotes single."""
    inner = F.replace(F.substr(raw, F.lit(2), F.length(raw) - 2), F.lit('""'), F.lit('"'))
    return F.when(raw.startswith('"') & raw.rlike(rf"(?s)\A{_QUOTED}\z"), inner).otherwise(raw)
