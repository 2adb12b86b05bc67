"""Numbers of a step, taken while its frames are written: no scan of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .tables import append_rows

SCHEMA = "run_at string, month string, step string, counter string, value long"


class Counters:
    """Counts watched on frames. A frame that is watched has to be written before `values` is asked for; rows
    that the optimizer proves absent count as 0."""

    def __init__(self) -> None:
        self._watched: list[tuple[Observation, tuple[str, ...]]] = []

    def watch(self, df: DataFrame, **counts: Column) -> DataFrame:
        """The same rows; each condition is counted as they pass, `None` counts every row."""
        seen = Observation()
        self._watched.append((seen, tuple(counts)))
        return df.observe(seen, *[(F.count(F.lit(1)) if c is None else F.count_if(c)).alias(n) for n, c in counts.items()])

    def values(self) -> dict[str, int]:
        """The sum of each counter over the frames that were watched under its name."""
        out: dict[str, int] = {}
        for seen, names in self._watched:
            got = seen.get
            for n in names:
                out[n] = out.get(n, 0) + (got.get(n) or 0)
        return out


def append_counters(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Append (run_at, month, step, counter, value) rows of one run."""
    if rows:
        append_rows(spark.createDataFrame(rows, SCHEMA), path)
