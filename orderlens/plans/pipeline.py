"""Batch pipeline: raw -> clean -> lines -> orders -> metrics / quality / profiles."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from orderlens.functions.text import norm_key, strip_ws
from orderlens.operators import clean, derived, lines as lines_op, orders as orders_op
from orderlens.operators.common import parts_of
from orderlens.operators.running import read_bytes
from orderlens.params import TESTBED, Params
from orderlens.session import materialize_parts, observed
from orderlens.sources.testbed import Testbed

#: Bytes of the raw sales' tables for each part that is shuffled at a time, and the most parts.
PART_BYTES = 32 << 20
MOST_PARTS = 8


@dataclass
class Pipeline:
    """Lazily built stages over three raw DataFrames (nothing runs until an action)."""

    sales_raw: DataFrame
    buyers_raw: DataFrame
    products_raw: DataFrame
    params: Params = Params()
    flags: str = "robust"
    materialize: bool = False
    #: Parts in which the large stages are shuffled, one after another; 0: by the bytes of the sales (``parts``).
    batches: int = 0
    #: Rows of every stage written so far, and of the raw tables behind them, counted by the writes themselves.
    rows: dict[str, int] = field(default_factory=dict)

    @classmethod
    def from_testbed(cls, spark: SparkSession, sf_dir: str, params: Params = TESTBED,
                     materialize: bool = False) -> "Pipeline":
        tb = Testbed(spark, sf_dir)
        return cls(tb.sales_raw(), tb.buyers_raw(), tb.products_raw(), params, materialize=materialize)

    @cached_property
    def parts(self) -> int:
        """Parts in which sales, lines and orders are shuffled and written, so that the disk holds the shuffles of one part
        beside the stage tables; one where the tables are small."""
        if not self.materialize:
            return 1
        return self.batches or max(1, min(MOST_PARTS, -(-read_bytes(self.sales_raw) // PART_BYTES)))

    def _keep(self, df: DataFrame, name: str, partition_by=(), raw: Observation | None = None) -> DataFrame:
        return self._keep_parts([df], name, partition_by, [raw] if raw is not None else ())[0]

    def _keep_parts(self, parts: list[DataFrame], name: str, partition_by=(), raw=()) -> tuple[DataFrame, list[DataFrame]]:
        """Stage tables are written once (shared checkpoint folder) when
        ``materialize`` is set, so each downstream branch scans Parquet
        (pruned to the columns it needs) instead of recomputing the stage.
        The write counts the stage's rows, and those of the ``raw`` table it reads.  Gives the table and its parts."""
        if not self.materialize:
            return parts[0], parts
        seen = [Observation() for _ in parts]
        counted = [df.observe(s, F.count(F.lit(1)).alias("rows")) for df, s in zip(parts, seen)]
        out = materialize_parts(counted, name, partition_by, release=self.parts > 1)
        self.rows[name] = sum(observed(s).get("rows") or 0 for s in seen)
        if raw:
            self.rows[f"{name}:raw"] = sum(observed(s).get("rows") or 0 for s in raw)
        return out

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """A small table of results, written: what was shuffled for it goes before the next one is worked out."""
        return self._keep(df, name)

    def _counted(self, raw: DataFrame) -> tuple[DataFrame, Observation | None]:
        """A raw table whose rows the write of the stage behind it counts.  They are counted in tasks ahead of a shuffle:
        a task that runs again after a lost executor counts its rows again (those of stages are never counted twice)."""
        if not self.materialize:
            return raw, None
        seen = Observation()
        return raw.observe(seen, F.count(F.lit(1)).alias("rows")), seen

    def stage_rows(self) -> dict[str, int]:
        """Rows of all stages (written where they are not yet)."""
        if not self.materialize:
            raise ValueError("stages are counted while they are written: materialize the pipeline")
        for stage in (self.sales, self.products, self.buyers, self.lines, self.orders):
            assert stage is not None
        of = {"sales_raw": "sales_dedup:raw", "buyers_raw": "buyers_clean:raw", "products_raw": "products_clean:raw",
              "sales_clean": "sales_dedup", "buyers_clean": "buyers_clean", "products_clean": "products_clean",
              "final_line": "line_fact", "order_level": "order_level"}
        return {stage: self.rows[table] for stage, table in of.items()}

    @cached_property
    def _sales(self):
        # duplicates share their order id; a quarter of the parts will do, as no other large table is on the disk yet
        raw, seen = zip(*map(self._counted, parts_of(self.sales_raw, strip_ws("order_id"), -(-self.parts // 4))))
        keep = (lambda *d: self._keep_parts([*d], "sales_dedup", raw=seen)[0]) if self.materialize else None
        return clean.clean_sales([*raw], self.params, keep=keep)

    @property
    def sales(self) -> DataFrame:
        return self._sales[0]

    @property
    def sales_audit(self) -> DataFrame:
        return self._sales[1]

    @cached_property
    def products(self) -> DataFrame:
        # read by the line join, the product rules, profiles and the audit: written once
        raw, seen = self._counted(self.products_raw)
        return self._keep(clean.clean_products(raw, self.params, self.flags), "products_clean", raw=seen)

    @cached_property
    def buyers(self) -> DataFrame:
        raw, seen = self._counted(self.buyers_raw)
        return self._keep(clean.clean_buyers(raw, self.sales, self.params), "buyers_clean", raw=seen)

    @property
    def line_values(self) -> DataFrame:
        """Line fact with company time, money, holiday flag and whether PR1-PR3 keep the line: one table,
        behind both ``lines`` and ``prepared_lines``."""
        return self._line_values[0]

    @cached_property
    def _line_values(self) -> tuple[DataFrame, list[DataFrame]]:
        return self._keep_parts(self._joined_lines(), "line_fact")

    def _joined_lines(self) -> list[DataFrame]:
        """The line fact in parts: all lines of a buyer are in one."""
        parts = zip(*[parts_of(df, norm_key("buyer_id"), self.parts) for df in (self.buyers, self.sales)])
        return [orders_op.add_line_values(lines_op.build_lines(b, s, self.products), self.params) for b, s in parts]

    @property
    def line_amounts(self) -> DataFrame:
        """Every line with the columns that pricing reads.  Where the whole line fact is not written yet it is not written
        for them: the joins then carry, shuffle and store these columns only."""
        return self._line_amounts[0]

    @cached_property
    def _line_amounts(self) -> tuple[DataFrame, list[DataFrame]]:
        read = orders_op.LINE_AMOUNT_COLUMNS
        if "_line_values" in self.__dict__:
            whole, parts = self._line_values
            return whole.select(*read), [df.select(*read) for df in parts]
        return self._keep_parts([df.select(*read) for df in self._joined_lines()], "line_amounts")

    @property
    def lines(self) -> DataFrame:
        """J2 line fact: read by the line rules, profiles and key diagnostics."""
        return self.line_values.drop("order_datetime_company", "line_base_revenue", "line_cogs", "is_black_friday", "_usable")

    @cached_property
    def prepared_lines(self) -> DataFrame:
        """Lines that PR1-PR3 keep, with company time, money and holiday flag."""
        return orders_op.usable_lines(self.line_values)

    @cached_property
    def order_lines(self) -> DataFrame:
        """``prepared_lines`` with the columns that pricing reads."""
        return orders_op.usable_lines(self.line_amounts)

    @cached_property
    def payback_curve(self) -> DataFrame:
        """Q3d, at most one row for each order rank of the curve: Q3e reads it too."""
        return self._keep(derived.payback_curve(self.orders, self.params), "payback_curve")

    @cached_property
    def priced_lines(self) -> DataFrame:
        return self._priced(self.order_lines)

    def _priced(self, lines: DataFrame) -> DataFrame:
        return orders_op.apply_discounts(orders_op.flag_first_orders(lines), self.params, "max")

    @cached_property
    def max_amount_lines(self) -> DataFrame:
        """PR10 lines: the running scan over all lines is done once for PR10, Q2g and its summary."""
        # the scan ranges, stores and deals its rows again: only the columns that PR10 reads go through it
        read = self.order_lines.select(*orders_op.PR10_COLUMNS)
        return self._keep(orders_op.lines_max_amount_from_prepared(read, self.params), "lines_max_amount")

    @cached_property
    def orders(self) -> DataFrame:
        """Order-level table; with ``materialize`` it is written once to the
        shared checkpoint folder and every metric reads it from there."""
        # first orders and the roll-up are by buyer, so each part of the lines gives its own orders
        parts = [orders_op.roll_up_orders(self._priced(orders_op.usable_lines(df)), self.params) for df in self._line_amounts[1]]
        # partitioned by year: the metrics' year windows become partition pruning
        return self._keep_parts(parts, "order_level", ["year"])[0]


def lines_max_amount(p: Pipeline) -> DataFrame:
    """PR10 line table of a pipeline."""
    return p.max_amount_lines
