"""Benchmark the headline queries.

Runs each query on local[$BENCH_CPUS] over $BENCH_SF_DIR (default sf0.1): one
warm-up, then the median of $BENCH_RUNS runs (default 3; the long builds in HEAVY
run once after their warm-up). A run executes the whole plan into Spark's no-op
sink (nothing is collected to the driver). Landing the raw tables, which every
query needs once per application, has a line of its own.
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridops.operators import kpis  # noqa: E402
from gridops.operators.quality import run_checks  # noqa: E402
from gridops.plans import suite  # noqa: E402
from gridops.plans.graph import ModelGraph  # noqa: E402
from gridops.plans.registry import QUERIES  # noqa: E402
from gridops.session import local_session  # noqa: E402
from gridops.sources import landing  # noqa: E402


def _graph(spark, sf, materialize=False):
    return ModelGraph(spark, sf, materialize=materialize)


def _land(spark, sf):
    """Land the raw tables afresh, as the first query of an application does."""
    landing._LANDED.clear()
    for name in ModelGraph.RAW:
        landing.landed(spark, sf, name)
    return spark.range(1)


_BUILT: dict = {}


def _build(spark, sf):
    """Materialise every model (each written once, downstream reads the written
    upstream); returns a trivial frame so the timing loop stays uniform."""
    g = _graph(spark, sf, True)
    _BUILT[sf] = suite.tables(g)
    return spark.range(1)


def _built(spark, sf):
    if sf not in _BUILT:
        _build(spark, sf)
    return _BUILT[sf]


BENCH = {
    "land_raw_tables": lambda s, sf: _land(s, sf),
    "kpi_generation_potential": lambda s, sf: QUERIES["kpi_generation_potential"](s, sf),
    "kpi_grid_stability": lambda s, sf: QUERIES["kpi_grid_stability"](s, sf),
    "kpi_grid_stability_selfjoin": lambda s, sf: (
        lambda g: kpis.kpi_grid_stability_selfjoin(g.fact_hourly_weather, g.dim_hour, g.params)
    )(_graph(s, sf)),
    "kpi_maintenance": lambda s, sf: QUERIES["kpi_maintenance"](s, sf),
    "kpi_dust_risk": lambda s, sf: QUERIES["kpi_dust_risk"](s, sf),
    "maintenance_windows": lambda s, sf: QUERIES["maintenance_windows"](s, sf),
    "fact_hourly_weather": lambda s, sf: QUERIES["fact_hourly_weather"](s, sf),
    # build: every model written once as a table; then the suite runs over the built tables
    "build_models": lambda s, sf: _build(s, sf),
    "quality_suite_folded": lambda s, sf: run_checks(_built(s, sf), suite.CHECKS, fold=True),
    "quality_suite_per_check": lambda s, sf: run_checks(_built(s, sf), suite.CHECKS, fold=False),
}
HEAVY = {"land_raw_tables", "build_models", "quality_suite_folded", "quality_suite_per_check"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = set(sys.argv[1:])
    spark = local_session(cpus, app="gridops-bench", extra={"spark.sql.shuffle.partitions": str(cpus)})
    results = {}
    for name, build in BENCH.items():
        if only and name not in only:
            continue
        times = []
        for i in range((1 if name in HEAVY else runs) + 1):
            t0 = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run is the warm-up
                times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
        print(f"# {name}: {results[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "median_sec_total",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
