"""The class rules at each of their boundaries."""

import pytest
from pyspark.sql import functions as F

from logsight.functions.classify import query_class

COLUMNS = (
    "query_type string, execution_duration_ms long, mbytes_scanned double, mbytes_spilled double, num_joins long,"
    " num_aggregations long, num_scans long, queue_duration_ms long, was_cached boolean"
)
NORMAL, CPU, IO = "normal_queries", "cpu_bound_queries", "io_bound_queries"
NET, QUEUE = "network_bound_queries", "queue_wlm_bound_queries"

BASE = dict(kind="select", exec=0, scanned=0.0, spilled=0.0, joins=0, aggs=0, scans=0, queue=0, cached=False)
CPU_BASE = dict(exec=50_000, scanned=100.0, joins=2)
IO_BASE = dict(exec=1001, scanned=1_000_000.0, spilled=1.0)
QUEUE_BASE = dict(exec=10, queue=1001)

CASES = [
    (dict(kind="copy", exec=500), NORMAL),
    (dict(kind="copy", exec=501), NET),
    (dict(kind="UNLOAD", exec=501), NET),
    (dict(kind="copy", exec=501, cached=True), NORMAL),
    (dict(kind="copy", exec=400, queue=2000), QUEUE),
    (CPU_BASE, CPU),
    ({**CPU_BASE, "joins": 1}, NORMAL),
    ({**CPU_BASE, "joins": 1, "aggs": 2}, CPU),
    ({**CPU_BASE, "scanned": 0.0}, NORMAL),
    ({**CPU_BASE, "exec": 1000, "scanned": 1.0}, NORMAL),
    ({**CPU_BASE, "exec": 1001, "scanned": 1.0}, CPU),
    ({**CPU_BASE, "exec": 2000, "scanned": 99.0}, NORMAL),  # ratio exactly 20
    ({**CPU_BASE, "exec": 2001, "scanned": 99.0}, CPU),
    ({**CPU_BASE, "cached": True}, NORMAL),
    ({**CPU_BASE, "kind": "copy", "exec": 501}, NET),
    (IO_BASE, IO),
    ({**IO_BASE, "spilled": 0.0}, NORMAL),
    ({**IO_BASE, "spilled": 0.0, "scans": 2}, IO),
    ({**IO_BASE, "exec": 1000}, NORMAL),
    ({**IO_BASE, "exec": 1001, "scanned": 1999.0}, NORMAL),
    ({**IO_BASE, "exec": 6100, "scanned": 99_999.0}, NORMAL),  # ratio exactly 0.061
    ({**IO_BASE, "exec": 6099, "scanned": 99_999.0}, IO),
    (QUEUE_BASE, QUEUE),
    ({**QUEUE_BASE, "queue": 1000}, NORMAL),
    ({**QUEUE_BASE, "exec": 0}, NORMAL),
    ({**QUEUE_BASE, "exec": 1001}, QUEUE),
    ({**QUEUE_BASE, "exec": 1002}, NORMAL),
    ({**QUEUE_BASE, "scans": 3}, QUEUE),
    ({**QUEUE_BASE, "scans": 4}, NORMAL),
    ({**QUEUE_BASE, "cached": True}, NORMAL),
    ({**QUEUE_BASE, "kind": None, "scanned": None, "spilled": None, "joins": None, "cached": None}, QUEUE),
    ({k: None for k in BASE}, NORMAL),
]


def test_truth_table(spark):
    rows = [tuple({**BASE, **case}.values()) for case, _ in CASES]
    found = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + COLUMNS)
    got = {r["i"]: r["c"] for r in found.select("i", query_class().alias("c")).collect()}
    wrong = [(case, want, got[i]) for i, (case, want) in enumerate(CASES) if got[i] != want]
    assert wrong == []


@pytest.mark.parametrize("kind,cached,want", [("COPY", False, NORMAL), ("copy", False, NET), ("copy", None, NORMAL)])
def test_strict_form(spark, kind, cached, want):
    row = {**BASE, "kind": kind, "exec": 600, "cached": cached}
    df = spark.createDataFrame([tuple(row.values())], COLUMNS)
    assert df.select(query_class(strict=True).alias("c")).first()["c"] == want
