"""Bottleneck class of a query, as ordered predicates over its own columns."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NORMAL = "normal_queries"
CPU = "cpu_bound_queries"
IO = "io_bound_queries"
NETWORK = "network_bound_queries"
QUEUE = "queue_wlm_bound_queries"

# Statement types that move data in or out of the warehouse.
TRANSFER_TYPES = ("copy", "unload")


@dataclass(frozen=True)
class ClassThresholds:
    """Fixed values of the class rules; durations in ms, volumes in MB."""

    network_exec_ms: float = 500
    cpu_ratio: float = 20.0
    cpu_exec_ms: float = 1000
    io_scanned_mb: float = 2000
    io_ratio: float = 0.061
    io_exec_ms: float = 1000
    queue_ms: float = 1000
    # structural counts, not scaled by a sensitivity run
    min_operators: int = 1
    max_complexity: int = 4

    def scaled(self, factor: float) -> "ClassThresholds":
        """The same rules with every measured threshold multiplied by ``factor``."""
        measured = [f.name for f in fields(self) if f.name not in ("min_operators", "max_complexity")]
        return replace(self, **{n: getattr(self, n) * factor for n in measured})


def _number(name: str, strict: bool) -> Column:
    col = F.col(name)
    return col if strict else F.coalesce(col, F.lit(0))


@dataclass(frozen=True)
class Measures:
    """The quantities the rules look at. ``strict`` leaves NULLs to propagate."""

    strict: bool = False

    @property
    def exec_ms(self) -> Column:
        return _number("execution_duration_ms", self.strict)

    @property
    def queue_ms(self) -> Column:
        return _number("queue_duration_ms", self.strict)

    @property
    def scanned(self) -> Column:
        return _number("mbytes_scanned", self.strict)

    @property
    def spilled(self) -> Column:
        return _number("mbytes_spilled", self.strict)

    @property
    def joins(self) -> Column:
        return _number("num_joins", self.strict)

    @property
    def scans(self) -> Column:
        return _number("num_scans", self.strict)

    @property
    def aggs(self) -> Column:
        return _number("num_aggregations", self.strict)

    @property
    def cached(self) -> Column:
        col = F.col("was_cached")
        return col if self.strict else F.coalesce(col, F.lit(False))

    @property
    def transfer(self) -> Column:
        kind = F.col("query_type")
        if not self.strict:
            kind = F.lower(F.coalesce(kind, F.lit("")))
        return kind.isin(*TRANSFER_TYPES)

    @property
    def complexity(self) -> Column:
        return self.scans + self.joins + self.aggs

    @property
    def scan_ratio(self) -> Column:
        """Execution ms per scanned MB; zero when nothing was scanned."""
        per_mb = self.exec_ms.cast("double") / (self.scanned + 1)
        return F.when(self.scanned > 0, per_mb).otherwise(F.lit(0.0))


def class_conditions(t: ClassThresholds = ClassThresholds(), strict: bool = False) -> dict[str, Column]:
    """Each class's own rule, without the first-match order between classes."""
    m = Measures(strict)
    live = ~m.cached
    return {
        NETWORK: live & m.transfer & (m.exec_ms > t.network_exec_ms),
        CPU: live
        & ~m.transfer
        & ((m.joins > t.min_operators) | (m.aggs > t.min_operators))
        & (m.scanned > 0)
        & (m.scan_ratio > t.cpu_ratio)
        & (m.exec_ms > t.cpu_exec_ms),
        IO: live
        & ~m.transfer
        & (m.scanned >= t.io_scanned_mb)
        & (m.scan_ratio < t.io_ratio)
        & ((m.spilled > 0) | (m.scans > 1))
        & (m.exec_ms > t.io_exec_ms),
        QUEUE: live
        & (m.queue_ms >= m.exec_ms)
        & (m.queue_ms > t.queue_ms)
        & (m.exec_ms > 0)
        & (m.complexity < t.max_complexity),
    }


def query_class(t: ClassThresholds = ClassThresholds(), strict: bool = False) -> Column:
    """Name of the first class whose rule holds, else the normal class."""
    chain = F
    for name, rule in class_conditions(t, strict).items():
        chain = chain.when(rule, F.lit(name))
    return chain.otherwise(F.lit(NORMAL))


def with_class(df: DataFrame, t: ClassThresholds = ClassThresholds(), strict: bool = False) -> DataFrame:
    return df.withColumn("query_class", query_class(t, strict))
