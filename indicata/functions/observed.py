"""Counts of what a run drops, collected while it runs.

Spark fills an observed metric as the rows pass, in the run that writes the
result: no job of its own.  A range sort samples its input, so everything below a
sort would pass twice; the jobs put their counters below a shuffle or a written table.
If an executor is lost, rows that are read again are counted again: the counts are a report,
not part of the result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class RunCounts:
    """Named counts over frames of one job; ``get`` after the job has run."""

    def __init__(self) -> None:
        self._observed: list[Observation] = []

    def watch(self, df: DataFrame, **conditions: Column) -> DataFrame:
        """``df``, counting the rows that meet each condition."""
        seen = Observation(f"counts-{uuid.uuid4().hex[:12]}")
        self._observed.append(seen)
        return df.observe(seen, *(F.count(F.when(c, 1)).alias(name) for name, c in conditions.items()))

    def get(self) -> dict[str, int]:
        """All counts; counters of the same name are added up."""
        out: dict[str, int] = {}
        for seen in self._observed:
            for name, n in seen.get.items():
                out[name] = out.get(name, 0) + n
        return out


def watch(counts: RunCounts | None, df: DataFrame, **conditions: Column) -> DataFrame:
    return df if counts is None else counts.watch(df, **conditions)
