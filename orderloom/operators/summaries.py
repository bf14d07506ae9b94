"""Many global summaries of one table from a single scan.

A summary is a set of aggregates over all rows and, if its results aren't these
themselves, how they follow from them. Taken one by one, each summary scans the table;
together they are one aggregate, in which equal aggregates are computed once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Summary(NamedTuple):
    """Aggregates by name, and the results by name as columns of the aggregates."""

    aggregates: Mapping[str, Column]
    results: Callable[[Mapping[str, Column]], Mapping[str, Column]] = lambda found: found

    @classmethod
    def of_conditions(cls, conditions: Mapping[str, Column]) -> Summary:
        """Counts of the rows for which each condition holds."""
        return cls({name: F.count_if(condition) for name, condition in conditions.items()})


def summarise(df: DataFrame, summaries: Mapping[str, Summary]) -> DataFrame:
    """(profile, measure, value): a row per result of each summary, as a double, from one scan of ``df``."""
    places: dict[str, str] = {}  # text of an aggregate -> its column
    wanted: list[Column] = []
    cells = []
    for profile, summary in summaries.items():
        found = {}
        for name, aggregate in summary.aggregates.items():
            text = str(aggregate)
            if text not in places:
                places[text] = f"_a{len(places)}"
                wanted.append(aggregate.alias(places[text]))
            found[name] = F.col(places[text])
        for measure, value in summary.results(found).items():
            cells.append(F.struct(F.lit(profile).alias("profile"), F.lit(measure).alias("measure"), value.cast("double").alias("value")))
    return df.agg(*wanted).select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
