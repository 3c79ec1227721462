"""Rows that a job leaves out, counted by the rule they fall to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class Drops:
    """Counts taken along while a job runs, without a pass of their own; they are there once it is done.

    A rule met in several places (two kinds of input, say) adds up. Tasks that are run again do not count twice.
    """

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def keep(self, df: DataFrame, **rules: Column) -> DataFrame:
        """The rows for which every rule holds (NULL is no). A row counts for the first rule that it breaks."""
        holds = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
        before, counts = F.lit(True), []
        for name, rule in holds.items():
            counts.append(F.count_if(before & ~rule).alias(name))
            before = before & rule
        seen = Observation()
        self._seen.append(seen)
        return df.observe(seen, *counts).filter(before)

    def counts(self) -> dict[str, int]:
        """To be asked for after the job's result was written; it waits for that."""
        out: dict[str, int] = {}
        for seen in self._seen:
            for name, n in seen.get.items():
                out[name] = out.get(name, 0) + n
        return out


def kept(df: DataFrame, drops: Drops | None, **rules: Column) -> DataFrame:
    """As ``Drops.keep``; without ``drops`` plain filters, which Spark may move towards the scan."""
    if drops is not None:
        return drops.keep(df, **rules)
    for rule in rules.values():
        df = df.filter(rule)
    return df
