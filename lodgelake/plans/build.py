"""Full build (entry point A): write every table layer in dependency order.

Each table-materialised relation of ``RentalModel`` is written once as a catalog table of this run and read back, so
every downstream relation starts from files (lineage cut, restartable after executor loss) and no table is recomputed
per consumer.  Row counts and quality violations are observed by the writes.  Marts stay views (lazy
DataFrames over the written star tables) unless ``plans.refresh`` stores them.

Layout choices for scale:

* the bronze scrape (the monthly landing table) is partitioned by ``source_month``, so a monthly run prunes whole
  directories (``silver_airbnb_clean(months=...)``);
* facts, host versions and property versions are partitioned by ``month`` and sorted by their join key inside a
  file, so a panel of some months lists only those months' files on both sides of its joins;
* every other table is written as the plan produces it (AQE-sized partitions);
  ``maxRecordsPerFile`` bounds file sizes.
"""

from __future__ import annotations

import threading
import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from lodgelake.plans import checks
from lodgelake.plans.model import TABLES, WAVES, RentalModel
from lodgelake.session import shuffles_freed
from lodgelake.sources.sinks import checked_name, create_database, layer_of, publish_views, write_table

#: table -> (partition columns, sort columns inside a file)
LAYOUT = {
    "airbnb": (["source_month"], []),
    "fact_listings": (["month"], ["host_id", "listing_id"]),
    "dim_host": (["month"], ["host_id"]),
    "dim_property": (["month"], ["listing_id"]),
}
MAX_RECORDS_PER_FILE = 5_000_000
#: Tables written at the same time.
THREADS = 4


def run_table(database: str, run_id: str, name: str) -> str:
    return f"{database}_{layer_of(name)}__{run_id}.{name}"


def build(spark: SparkSession, sources: dict[str, DataFrame], database: str, root: str, run_id: str | None = None,
          tables=TABLES, check_calendar: tuple[str, str] | None = None, **model_kw) -> RentalModel:
    """Write ``tables`` of a run, publish them as views of ``database``'s layers; returns the model over them.

    Re-running with the same ``run_id`` resumes: a table that the catalog has is read instead of recomputed, and
    one whose write failed is written again, to a new folder.  ``model.observed`` holds the metrics of the
    tables that were written.
    """
    run_id = checked_name(run_id or uuid.uuid4().hex[:12])
    root = root.rstrip("/")
    done: dict[str, str] = {}
    observed: dict[str, dict] = {}
    # two tables of a wave may need the same one that is not in ``tables``: it is written by the first
    locks: dict[str, threading.Lock] = defaultdict(threading.Lock)

    def materialize(name: str, df: DataFrame) -> DataFrame:
        with locks[name]:
            return written(name, df)

    def written(name: str, df: DataFrame) -> DataFrame:
        table = run_table(checked_name(database), run_id, name)
        if spark.catalog.tableExists(table):
            out = spark.table(table).select(*df.columns)
        else:
            create_database(spark, table.split(".")[0], f"{root}/{run_id}/{layer_of(name)}")
            suburbs = spark.table(done["dim_suburb"]) if "dim_suburb" in done else None
            rows = checks.checked(name, df, suburbs, check_calendar)
            partition_by, sort_by = LAYOUT.get(name, ([], []))
            out, observed[name] = write_table(rows, table, f"{root}/{run_id}/{layer_of(name)}/{name}", partition_by, sort_by,
                                              MAX_RECORDS_PER_FILE, checks.metrics(rows))
        done[name] = table
        return out

    model = RentalModel(spark, sources, materialize=materialize, **model_kw)
    with shuffles_freed(spark), ThreadPoolExecutor(max_workers=THREADS) as pool:
        for wave in WAVES:
            # the tables of a wave are independent jobs: Spark shares the executors among them
            list(pool.map(lambda name: getattr(model, name), [name for name in wave if name in tables]))
    publish_views(spark, database, root, done)
    model.observed = observed
    model.tables = done
    return model
