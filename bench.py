"""Benchmark: the lineage reports and key operators at one scale factor.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (default 3). Steps:

1. derive the 38 P2P tables from the driver tables and write them as Parquet
   into a fresh folder under the session's ``spark.checkpoint.dir``
   (timed as ``derive_p2p``);
2. build each headline query's DataFrame (driver-side plan construction,
   reported separately as ``build_sec``), then execute it ``BENCH_RUNS`` times
   with a ``noop`` sink (the whole plan executes, nothing is collected) and
   keep the median.

Prints one JSON line: {"metric", "value" (sum of execution medians), "unit",
"queries", "build_sec", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from procura.plans.blocks import inspection_pending  # noqa: E402
from procura.plans.drilldown import drill_document  # noqa: E402
from procura.plans.reports import DEFAULT_AS_OF, report_blanket, report_standard, report_union  # noqa: E402
from procura.queries import EXCLUDED_SRNS  # noqa: E402
from procura.session import checkpoint_dir, get_spark  # noqa: E402
from procura.sources.derived import derived_tables  # noqa: E402
from procura.sources.tables import TABLES, load_tables  # noqa: E402


def _sf_of(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_spark(cpus, app="procura-bench")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="procura-bench-"))  # one machine: the folder is shared
    out_dir = f"{checkpoint_dir(spark).rstrip('/')}/procura-bench-p2p-{uuid.uuid4().hex[:8]}"

    t0 = time.time()
    derived = derived_tables(spark, sf_dir)
    for name in TABLES:
        derived[name].write.mode("overwrite").parquet(f"{out_dir}/{name}.parquet")
    derive_sec = time.time() - t0

    t = load_tables(spark, out_dir, empty_as_null=False)
    as_of = DEFAULT_AS_OF
    headline = {
        "report_blanket": lambda: report_blanket(t, as_of, excluded_srns=EXCLUDED_SRNS),
        "report_standard": lambda: report_standard(t, as_of),
        "report_union": lambda: report_union(t, as_of, excluded_srns=EXCLUDED_SRNS),
        "report_union_legacy": lambda: report_union(t, as_of, variant="legacy", excluded_srns=EXCLUDED_SRNS),
        "block_inspection_pending": lambda: inspection_pending(t, as_of),
        "drill_document": lambda: drill_document(t, lambda x: report_union(x, as_of, excluded_srns=EXCLUDED_SRNS), {"PO Number": "4000030"}),
        "drill_down_union": lambda: report_union(t, as_of, excluded_srns=EXCLUDED_SRNS).where(F.col("`PO Type (Blanket/Standard)`") == "BLANKET"),
    }
    timings: dict[str, float] = {}
    fastest: dict[str, float] = {}
    build_sec: dict[str, float] = {}
    rows: dict[str, int] = {}
    frames = {}
    for name, build in headline.items():
        s = time.time()
        frames[name] = build()
        build_sec[name] = round(time.time() - s, 3)
        samples = []
        for _ in range(runs):
            s = time.time()
            frames[name].write.format("noop").mode("overwrite").save()
            samples.append(time.time() - s)
        timings[name] = round(statistics.median(samples), 3)
        fastest[name] = round(min(samples), 3)
    for name in ("report_blanket", "report_standard", "report_union"):
        rows[name] = frames[name].count()

    print(json.dumps({
        "metric": "p2p_lineage_reports_median_sec_sum",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "queries_min": fastest,
        "build_sec": build_sec,
        "derive_p2p_sec": round(derive_sec, 3),
        "rows": rows,
        "sf": _sf_of(sf_dir),
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
