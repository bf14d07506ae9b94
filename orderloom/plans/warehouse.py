"""Build and open the stored warehouse.

Every table is written once and read back by its consumers: the dedup behind
staging would otherwise run again in each of them. Stored tables also outlive
the executors that wrote them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from orderloom.functions.text import column
from orderloom.operators.checks import repeated_combinations
from orderloom.operators.dedup import HASH_ROWS, key_hash, repeated_key_hashes
from orderloom.plans import dimensions, fact, quality
from orderloom.plans import vocabulary as v
from orderloom.plans.staging import line_key, staged_lines
from orderloom.sources import schemas, tables

SALE_MONTH = "sale_month"
LAYERS = {
    "raw": {"order_lines": schemas.RAW},
    "seeds": {"state_to_region": schemas.REGIONS},
    "staging": {"stg_orders": schemas.STAGING},
    "marts": {
        "fct_sales": schemas.FACT,
        "dim_date": schemas.DIM_DATE,
        "dim_product": schemas.DIM_PRODUCT,
        "dim_geography": schemas.DIM_GEOGRAPHY,
        "dim_order_status": schemas.DIM_ORDER_STATUS,
    },
}


class Warehouse:
    """The layers raw, seeds, staging and marts below ``base``, each table built on first use."""

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        raw: Callable[[], DataFrame],
        regions: Callable[[], DataFrame] | None = None,
        calendar: tuple[str, str] | None = (v.CALENDAR_START, v.CALENDAR_END),
        fact_by_month: bool = False,
        broadcast_rows: int = HASH_ROWS,
        buckets: int | None = None,
        fact_by_place: bool = False,
        render: Callable[[DataFrame], DataFrame] | None = None,
        raw_in_steps: bool = False,
    ) -> None:
        """``calendar`` is (first day, day after the last); None takes whole years around the data.

        Lines outside the calendar are dropped from the fact and reported by the
        row-count check. ``fact_by_month`` stores the fact in one folder per month,
        for reports that read few months. It costs one more shuffle of the fact.
        More than ``broadcast_rows`` hashes of repeated lines are not broadcast. The raw
        lines are stored in ``buckets`` by the hash of (order, sku), by default as many
        as Spark shuffles into; a bucket should fit a task. ``fact_by_place`` stores the
        fact in the order of place and day, so that reports on a city skip most of it; it
        costs a shuffle and a sort of the fact. With ``render``, ``raw`` gives narrower rows
        that hold the hash of (order, sku); it makes the raw lines of them where they are stored.
        ``raw_in_steps`` stores these rows for a moment before they are dealt by their hash, so
        that the shuffles behind them don't take room beside that one.
        """
        self.spark = spark
        self.base = base.rstrip("/")
        self.rows_written: dict[str, int] = {}
        self._opened = False
        self._read: dict[str, tuple[str, DataFrame]] = {}  # by table, the version that was read last
        self._raw_rows = raw
        self._region_rows = regions or (lambda: dimensions.state_regions(spark))
        self._calendar = calendar
        self._fact_by_month = fact_by_month
        self._broadcast_rows = broadcast_rows
        self._buckets = buckets
        self._fact_by_place = fact_by_place
        self._render = render
        self._raw_in_steps = raw_in_steps

    @classmethod
    def open(cls, spark: SparkSession, base: str) -> Warehouse:
        """The warehouse stored at ``base``, to read: nothing is loaded or built, a missing table is an error."""

        def refuse() -> DataFrame:
            raise ValueError(f"the warehouse at {base} was opened to be read")

        warehouse = cls(spark, base, raw=refuse, regions=refuse)
        warehouse._opened = True
        return warehouse

    def path(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}"

    def _stored(
        self,
        layer: str,
        name: str,
        schema: StructType,
        build: Callable[[], DataFrame],
        partition_by: str | None = None,
        cluster_by: str | None = None,
        order_by: Sequence[str] = (),
        finish: Callable[[DataFrame], DataFrame] | None = None,
        in_steps: bool = False,
    ) -> DataFrame:
        path = self.path(layer, name)
        if not self._opened and name not in self.rows_written:
            measures = quality.row_conditions(name)
            self.rows_written[name] = tables.overwrite(build(), path, partition_by, cluster_by, self._buckets, measures, order_by, finish=finish, in_steps=in_steps)
        version = tables.current(self.spark, path)
        if self._read.get(name, (None,))[0] != version or version is None:
            self._read[name] = version, tables.read(self.spark, path, schema)
        return self._read[name][1]

    def measured(self) -> dict[str, dict[str, int]]:
        """By table, what was counted while it was written: failures of the checks on single rows, and its rows."""
        found = {}
        for layer, members in LAYERS.items():
            for name in members:
                commit = tables.commit_of(self.spark, self.path(layer, name))
                if commit is not None and name in quality.NOT_NULL:
                    found[name] = {**commit.measures, quality.ROWS + name: commit.rows}
        return found

    def suite(self, fulfilments: Sequence[str], **more) -> DataFrame:
        """The quality suite; checks on single rows and row counts come from the writes. ``more`` as for :func:`quality.suite`."""
        return quality.suite(self.lines(), self.staging(), self.star(), fulfilments, measured=self.measured(), **more)

    def lines(self) -> DataFrame:
        """Raw lines with the hash of their (order, sku), and stored by it."""
        return self._stored("raw", "order_lines", schemas.RAW_LINES, self._hashed_lines, cluster_by=schemas.KEY_HASH, finish=self._render, in_steps=self._raw_in_steps)

    def _hashed_lines(self) -> DataFrame:
        rows = self._raw_rows()
        return rows if self._render else rows.withColumn(schemas.KEY_HASH, key_hash(line_key()))

    def raw(self) -> DataFrame:
        return self.lines().select(*map(column, schemas.RAW.names))

    def regions(self) -> DataFrame:
        return self._stored("seeds", "state_to_region", schemas.REGIONS, self._unique_regions)

    def _unique_regions(self) -> DataFrame:
        rows = self._region_rows()
        twice = repeated_combinations(rows, ["country", "state"]).limit(1).count()
        if twice:
            raise ValueError("the region lookup lists a (country, state) twice, which would multiply places")
        return rows

    def repeated_lines(self) -> DataFrame:
        """Key hashes of the repeated (order, sku) pairs, eight bytes each."""
        return self._stored(
            "staging", "repeated_lines", schemas.KEY_HASHES, lambda: repeated_key_hashes(self.lines(), line_key())
        )

    def staging(self) -> DataFrame:
        return self._stored(
            "staging", "stg_orders", schemas.STAGING, lambda: self._addressed(staged_lines(self.lines(), self.repeated_lines(), self._broadcast_rows))
        )

    @staticmethod
    def _addressed(staging: DataFrame) -> DataFrame:
        """Staging lines; one whose whole address reads UNKNOWN stops the build.

        That word stands for a missing address, so such a line would double the
        place of all lines without one, and the fact rows that refer to it.
        """
        literal = F.lit(True)
        for c in dimensions.PLACE:
            literal = literal & (F.col(c) == v.UNKNOWN_PLACE)
        refused = F.raise_error(F.concat(F.lit("an address that reads UNKNOWN in every field is refused; order "), F.coalesce("order_id", F.lit("?"))))
        country = F.when(F.coalesce(literal, F.lit(False)), refused.cast("string")).otherwise(F.col("ship_country"))
        return staging.withColumn("ship_country", country)

    def products(self) -> DataFrame:
        return self._stored(
            "marts", "dim_product", schemas.DIM_PRODUCT, lambda: dimensions.products(self.staging())
        )

    def places(self) -> DataFrame:
        return self._stored(
            "marts",
            "dim_geography",
            schemas.DIM_GEOGRAPHY,
            lambda: dimensions.places(self.staging(), self.regions()),
        )

    def dates(self) -> DataFrame:
        def build() -> DataFrame:
            if self._calendar is None:
                return dimensions.calendar_covering(self.staging(), "order_date")
            return dimensions.calendar(self.spark, *self._calendar)

        return self._stored("marts", "dim_date", schemas.DIM_DATE, build)

    def statuses(self) -> DataFrame:
        return self._stored(
            "marts", "dim_order_status", schemas.DIM_ORDER_STATUS, lambda: dimensions.order_statuses(self.spark)
        )

    def _fact_rows(self) -> DataFrame:
        rows = fact.fact_by_key(self.staging(), self.dates(), self.places(), self.statuses())
        if self._fact_by_month:
            return rows.withColumn(SALE_MONTH, (F.col("date_key") / 100).cast("int"))
        return rows

    def fact(self) -> DataFrame:
        month = SALE_MONTH if self._fact_by_month else None
        schema = schemas.FACT if month is None else StructType([*schemas.FACT.fields, StructField(month, IntegerType())])
        order = fact.PLACE_ORDER if self._fact_by_place else ()
        moves = bool(month or order)
        build = (lambda: fact.packed(self._fact_rows())) if moves else self._fact_rows
        stored = self._stored("marts", "fct_sales", schema, build, month, order_by=order, finish=fact.unpacked if moves else None)
        return stored.select(*schemas.FACT.names)

    def star(self) -> fact.Star:
        rows, commit = self.fact(), tables.commit_of(self.spark, self.path("marts", "fct_sales"))
        return fact.Star(rows, self.dates(), self.products(), self.places(), self.statuses(), commit.ordered_by[:1] == ["geography_key"])

    def build(self) -> dict[str, int]:
        """Build every table; returns the rows written per table."""
        self.raw()
        self.regions()
        self.staging()
        self.star()
        return dict(self.rows_written)

    def publish(self, prefix: str = "") -> None:
        """Build every table and give each its name, ``<prefix><layer>.<table>``."""
        self.build()
        placed = {
            layer: {name: (self.path(layer, name), schema.names) for name, schema in group.items()}
            for layer, group in LAYERS.items()
        }
        tables.publish(self.spark, self.base, placed, prefix)
