"""The registry of queries: a function over a Model, and the SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import compare
from ..sources import shared
from . import sql, star

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


class Model:
    """The model's tables over one folder. Those named in keep are written when first used and read again: a query that uses one several times scans its sources once."""

    def __init__(self, spark: SparkSession, d: str, keep: tuple[str, ...] = ()):
        self.spark, self.d, self.keep = spark, d, keep

    def _own(self, name: str, frame: DataFrame) -> DataFrame:
        return shared.written(frame, name) if name in self.keep else frame

    def table(self, name: str) -> DataFrame:
        return star.table(self.spark, self.d, name)

    @cached_property
    def hospitals(self):
        return star.hospitals(self.spark, self.d)

    @cached_property
    def rates(self):
        return self._own("rates", star.rates(self.spark, self.d))

    @cached_property
    def snapshots(self):
        return self._own("snapshots", star.snapshots(self.rates))

    @cached_property
    def fact(self):
        return star.fact(self.rates)

    @cached_property
    def bridge(self):
        return self._own("bridge", star.bridge(self.rates))

    @cached_property
    def coded_rates(self):
        """Rates with their item's comparable codes as an array."""
        return star.rates(self.spark, self.d, star.with_codes)

    @cached_property
    def current_rates(self):
        """Those of current snapshots, with is_current: lines of other snapshots leave before all joins."""
        current = self.snapshots.filter("is_current").select("snapshot_id")
        return star.rates(self.spark, self.d, star.with_codes, current).withColumn("is_current", F.lit(True))

    @cached_property
    def spine(self):
        return star.spine(self.coded_rates.join(self.snapshots.select("snapshot_id", "is_current"), "snapshot_id"))

    @cached_property
    def current_spine(self):
        return star.spine(self.current_rates)

    @cached_property
    def ranked(self):
        """What statistics are made of: current, context-aligned rows with a price that may be ranked, in one pass over the rates, with no more columns than that takes."""
        own = star.with_contract(star.spine(self.current_rates, compare.RANKED_KINDS))
        return self._own("ranked", compare.ranking_rows(own, compare.RANKED_KINDS).select(*star.RANKED))

    @cached_property
    def reps(self):
        return self._own("reps", compare.contract_representatives(self.ranked))

    @cached_property
    def amounts(self):
        return self._own("amounts", compare.hospital_amounts(self.ranked, self.reps))


#: For queries over the market's statistics: what they are made of is a thin table, written once. Rates are read where they are used, with the columns used there: all of them as a table cost more than they save.
RANKED = ("snapshots", "bridge", "ranked")
#: For those that use contracts and votes several times.
MARKET = (*RANKED, "reps", "amounts")


def query(name: str, oracle: str, model: bool = False, keep: tuple[str, ...] = ()):
    """Register a function of a Model under the name; oracle is its SQL, on the model's tables if asked for; keep: tables to write once."""

    def add(run: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
        _queries[name] = lambda spark, d: run(Model(spark, d, keep))
        _oracles[name] = sql.model(oracle) if model else oracle
        return run

    return add


def r4(x, digits: int = 4):
    return F.round((F.col(x) if isinstance(x, str) else x).cast("double"), digits)
