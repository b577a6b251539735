"""The layered build over the derived sources, as lazily composed DataFrames.

``Layers(spark, sf_dir)`` exposes raw (``bronze``), clean (``silver``) and
star-schema (``gold``) tables for one input directory. Nothing is computed
until a report is acted on; Catalyst optimises across layer boundaries (column
pruning reaches the parquet scans, filters are pushed down).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strataflow.operators import gold, silver
from strataflow.session import configure
from strataflow.sources import driver_tables as src

LOOKBACK_DAYS = 3


@dataclass
class Layers:
    spark: SparkSession
    sf_dir: str
    run_date: dt.date = src.RUN_DATE
    lookback_days: int = LOOKBACK_DAYS
    _memo: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        configure(self.spark)

    def _get(self, key, build):
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    # raw ---------------------------------------------------------------
    def bronze(self, entity: str, snapshot: str = "all") -> DataFrame:
        makers = {
            "business": lambda: src.business_bronze(self.spark, self.sf_dir, snapshot),
            "reviews": lambda: src.reviews_bronze(self.spark, self.sf_dir),
            "users": lambda: src.users_bronze(self.spark, self.sf_dir, snapshot),
            "checkins": lambda: src.checkins_bronze(self.spark, self.sf_dir),
            "tips": lambda: src.tips_bronze(self.spark, self.sf_dir),
        }
        return self._get(("bronze", entity, snapshot), makers[entity])

    def window(self, entity: str, snapshot: str = "all") -> DataFrame:
        return silver.read_window(self.bronze(entity, snapshot), self.run_date, self.lookback_days)

    # clean -------------------------------------------------------------
    def silver(self, name: str, snapshot: str = "all") -> DataFrame:
        makers = {
            "business": lambda: silver.clean_business(self.window("business", snapshot)),
            "business_categories": lambda: silver.business_categories(self.window("business", snapshot)),
            "reviews": lambda: silver.clean_reviews(self.window("reviews")),
            "users": lambda: silver.clean_users(self.window("users", snapshot)),
            "checkin_events": lambda: silver.checkin_events(self.window("checkins")),
            "tips": lambda: silver.clean_tips(self.window("tips")),
        }
        return self._get(("silver", name, snapshot), makers[name])

    # star schema -------------------------------------------------------
    @property
    def date_start(self) -> dt.date:
        return self._bounds()[0]

    @property
    def date_end(self) -> dt.date:
        return self._bounds()[1]

    def _bounds(self) -> tuple[dt.date, dt.date]:
        """The calendar covers every event of the input: two scalars from the tables."""
        return self._get("bounds", lambda: src.event_bounds(self.spark, self.sf_dir))

    def dim_date(self) -> DataFrame:
        return self._get(("gold", "dim_date"), lambda: gold.dim_date(self.spark, self.date_start, self.date_end))

    def dates(self) -> DataFrame:
        """dim_date, broadcast when its bounds prove it small."""
        return gold.bounded_dates(self.dim_date(), self.date_start, self.date_end)

    def primary_category(self, snapshot: str = "all") -> DataFrame:
        return silver.primary_category(self.silver("business_categories", snapshot))

    def dim_business(self, snapshot: str = "all") -> DataFrame:
        return self._get(("gold", "dim_business", snapshot), lambda: gold.dim_business(
            self.silver("business", snapshot), self.primary_category(snapshot)))

    def dim_user(self, snapshot: str = "all") -> DataFrame:
        return self._get(("gold", "dim_user", snapshot), lambda: gold.dim_user(self.silver("users", snapshot)))

    def fact_reviews(self) -> DataFrame:
        return self._get(("gold", "fact_reviews"), lambda: gold.fact_reviews(
            self.silver("reviews"), self.dim_date(), self.date_start, self.date_end))

    def fact_checkins(self) -> DataFrame:
        return self._get(("gold", "fact_checkins"), lambda: gold.fact_checkins(
            self.silver("checkin_events"), self.dim_date(), self.date_start, self.date_end))
