"""Benchmark: the full build and the marts at one scale factor.

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf", ...}.

* ``build_star``   -- raw scrape view -> bronze -> silver -> snapshots -> star, every
                      table written as parquet and read back (the production flow);
* ``dm_*`` -- marts over the written star tables (views);
* ``e2e_dm_property_type`` -- the registered lazy query, raw tables to mart in one plan
  (reported separately under ``lazy_end_to_end``, not in ``value``).

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lodgelake import queries as registry  # noqa: E402
from lodgelake.plans.build import build  # noqa: E402
from lodgelake.session import ensure_checkpoint_dir, local_session  # noqa: E402
from lodgelake.sources.scrape_view import raw_sources  # noqa: E402


def timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus)
    shared = ensure_checkpoint_dir(spark)
    root = f"{shared}/bench-{uuid.uuid4().hex}"

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    model, times["build_star"] = timed(
        lambda: build(spark, raw_sources(spark, sf_dir), f"bench_{uuid.uuid4().hex}", root, calendar_bounds="data"))
    for name in ["dm_property_type", "dm_listing_neighbourhood", "dm_host_neighbourhood"]:
        result, times[name] = timed(lambda n=name: getattr(model, n).collect())
        rows[name] = len(result)
    result, e2e = timed(lambda: registry.queries()["dm_property_type"](spark, sf_dir).collect())
    rows["e2e_dm_property_type"] = len(result)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "rows": rows,
        "lazy_end_to_end": {"e2e_dm_property_type": round(e2e, 3)},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
