"""Size and ts range of the rows at hand, and what follows for the file layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvloom.functions.buckets import DAY_MS
from kvloom.model import RunOptions
from kvloom.plans.progress import Slice


@dataclass(frozen=True)
class Extent:
    """Number of the source rows, the ts that cut them, months and years they touch."""

    rows: int
    edges: tuple[int, ...] = ()
    months: int = 1
    years: int = 1

    @staticmethod
    def of(rows: DataFrame, slices: int = 1) -> Extent:
        """Measured in one pass. Quantiles and counted months, not the range of ts, so that a
        stray ts changes neither the slices nor the number of files."""
        steps = [i / slices for i in range(1, slices)]
        edges = F.percentile_approx("ts", steps, max(10_000, 20 * slices)) if steps else F.array()
        found = rows.agg(
            F.count("*").alias("rows"),
            edges.alias("edges"),
            *[
                F.approx_count_distinct(F.floor(F.col("ts") / (days * DAY_MS))).alias(name)
                for name, days in (("months", 30), ("years", 365))
            ],
        ).first()
        return Extent(found["rows"], tuple(found["edges"] or ()), found["months"], found["years"])

    def cut(self) -> tuple[Slice, ...]:
        """Ranges of ts with about equally many rows; the outer two are open."""
        edges = sorted(set(self.edges))
        bounds = zip([None, *edges], [*edges, None])
        return tuple(Slice(i, low, high) for i, (low, high) in enumerate(bounds))

    def files_per_directory(self, options: RunOptions) -> int:
        """Files that a history directory needs if they are filled evenly.

        Entity types are not counted: where one of them has nearly all rows,
        dividing by their number would make the files too large.
        """
        if not self.rows:
            return 1
        by_strategy = {"INDEFINITE": 1, "YEARS": self.years}
        directories = max(1, by_strategy.get(options.partitioning, self.months))
        return max(1, self.rows // (directories * options.rows_per_file))
