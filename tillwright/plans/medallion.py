"""The whole job: flat files to bronze, silver, quality gate, gold and views.

Each stage reads tables and writes tables, so a lost executor costs the tasks it ran and a failed
stage can be run again from the tables before it.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions.bands import SegmentThresholds
from tillwright.functions.money import STANDARD_COST_FACTOR
from tillwright.operators import colocated
from tillwright.operators.audit import row_counts
from tillwright.operators.dedup import latest_per_key
from tillwright.operators.joins import SALT
from tillwright.plans import gold, quality, refresh, silver, views
from tillwright.schemas import FILE_NAMES, SOURCES
from tillwright.session import remove, tidy
from tillwright.sources.flat_files import read_flat_file, readable, stamp, unreadable
from tillwright.sources.lake import Lake

GOLD_TABLES = (
    "gold_fact_sales", "gold_sales_daily", "gold_sales_by_category", "gold_customer_summary"
)
#: Customers stored in the buckets of a co-located fact.
CUSTOMERS_BESIDE = "customers_beside_fact"
# The business key of each silver table.
BUSINESS_KEYS = {
    "customer_dim": "customer_id",
    "item_dim": "item_id",
    "store_dim": "store_id",
    "time_dim": "date_id",
    "transactions": "transaction_id",
}


@dataclass
class RunResult:
    rows: dict[str, int] = field(default_factory=dict)
    failed_checks: list = field(default_factory=list)


def load_bronze(
    lake: Lake,
    raw_dir: str,
    table: str,
    batch_ts: datetime.datetime | None = None,
    batch_date: datetime.date | None = None,
    append: bool = False,
    keep_corrupt: bool = False,
    quarantine: bool = False,
) -> int:
    """One source file into its bronze table; returns the rows loaded.

    By default the table is replaced. With `append` the batch becomes its `_batch_date` partition:
    other days stay, and a load of the same day again takes the place of the first. With `quarantine` only
    lines that can be read go to bronze; the others go to `quarantine_<table>`, as text, with the file and
    the reason, and take the place of what an earlier load of the batch put there.
    """
    file_name = FILE_NAMES[table]
    rows = read_flat_file(
        lake.spark, f"{raw_dir.rstrip('/')}/{file_name}", SOURCES[table], keep_corrupt or quarantine
    )
    batch_ts = batch_ts or datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
    batch_date = batch_date or batch_ts.date()
    if quarantine:
        bad = stamp(unreadable(rows), file_name, batch_ts, batch_date)
        lake.replace_partition(bad, f"quarantine_{table}", "_batch_date", batch_date)
        rows = readable(rows)
    stamped = stamp(rows, file_name, batch_ts, batch_date)
    if append:
        return lake.replace_partition(stamped, f"bronze_{table}", "_batch_date", batch_date)
    return lake.write(stamped, f"bronze_{table}", dense=table == refresh.LINES)


def load_all_bronze(
    lake: Lake, raw_dir: str, batch_ts: datetime.datetime, append: bool = False, quarantine: bool = False
) -> dict[str, int]:
    """The five source files of one batch."""
    return lake.side_by_side({
        f"bronze_{table}": partial(load_bronze, lake, raw_dir, table, batch_ts, append=append, quarantine=quarantine)
        for table in SOURCES
    })


def _refinements(as_of, cost_factor) -> dict[str, Callable[[DataFrame], DataFrame]]:
    return {
        "customer_dim": lambda df: silver.silver_customer(df, as_of),
        "item_dim": silver.silver_item,
        "store_dim": lambda df: silver.silver_store(df, as_of),
        "time_dim": silver.silver_calendar,
        "transactions": lambda df: silver.silver_transactions(df, cost_factor),
    }


def batch_sources(
    as_of: datetime.date | str | None = None, cost_factor: str | float = STANDARD_COST_FACTOR, dedup: bool = False
) -> list[refresh.Source]:
    """The five tables as daily batches refresh them."""
    return [
        refresh.Source(table, BUSINESS_KEYS[table], refine, dedup)
        for table, refine in _refinements(as_of, cost_factor).items()
    ]


def build_silver(
    lake: Lake,
    as_of: datetime.date | str | None = None,
    cost_factor: str | float = STANDARD_COST_FACTOR,
    dedup: bool = False,
) -> dict[str, int]:
    """The five silver tables. With `dedup` the last loaded row of each business key stays."""
    refine = _refinements(as_of, cost_factor)

    def load(table: str) -> int:
        bronze = lake.read(f"bronze_{table}")
        if dedup:
            bronze = latest_per_key(bronze, [BUSINESS_KEYS[table]], ["_ingested_at"])
        ready = refine[table](bronze).withColumn("_updated_at", F.current_timestamp())
        return lake.write(ready, f"silver_{table}", dense=table == refresh.LINES)

    return lake.side_by_side({f"silver_{table}": partial(load, table) for table in refine})


def silver_tables(lake: Lake) -> dict[str, DataFrame]:
    """Silver tables under the names the quality rules use."""
    return {
        "customers": refresh.read_sized(lake, "silver_customer_dim"),
        "items": refresh.read_sized(lake, "silver_item_dim"),
        "stores": refresh.read_sized(lake, "silver_store_dim"),
        "calendar": refresh.read_sized(lake, "silver_time_dim"),
        "txns": refresh.read_sized(lake, "silver_transactions"),
    }


def build_gold(
    lake: Lake,
    as_of: datetime.date | str | None = None,
    thresholds: SegmentThresholds = SegmentThresholds(),
    partition_by: tuple[str, ...] = (),
    colocate: int = 0,
) -> dict[str, int]:
    """The fact is joined and written once; the summaries read the written table.

    With `colocate` the fact is stored in that many buckets by customer, and the customers beside it in
    the same buckets (`CUSTOMERS_BESIDE`), so that :func:`fact_with_customers` moves no row of either.
    """
    tables = silver_tables(lake)
    dimensions = {key: tables[name] for key, name in gold.DIMENSION_OF.items()}
    created = refresh.created_now()
    stamped = [
        part.withColumn("_gold_created_at", created) for part in gold.star_join_parts(tables["txns"], dimensions)
    ]
    if colocate:
        layout = colocated.plan_layout(tables["txns"], "customer_id", colocate)
        rows = {"gold_fact_sales": colocated.store_lines(lake, stamped, "gold_fact_sales", layout, partition_by)}
        rows[CUSTOMERS_BESIDE] = colocated.store_lookup(lake, tables["customers"], CUSTOMERS_BESIDE, "gold_fact_sales")
    else:
        rows = {"gold_fact_sales": lake.write(stamped, "gold_fact_sales", partition_by=partition_by, dense=True)}
    written = lake.read("gold_fact_sales")
    summaries = {
        "gold_sales_daily": gold.gold_sales_daily(written, stored=True),
        "gold_sales_by_category": gold.gold_sales_by_category(written, stored=True),
        "gold_customer_summary": gold.gold_customer_summary(written, as_of, thresholds),
    }
    # One after the other: each shuffles a row for every customer of a group, and its files go before the next.
    return rows | {name: lake.write(df, name) for name, df in summaries.items()}


def fact_with_customers(lake: Lake, how: str = "left") -> DataFrame:
    """The stored fact with all silver columns of its customers, joined bucket by bucket without an exchange.

    Attributes that the fact holds already come from the fact, as of its write. Needs a job with `colocate`.
    """
    fact, layout = lake.read("gold_fact_sales"), colocated.stored_layout(lake, "gold_fact_sales")
    customers = lake.read(CUSTOMERS_BESIDE)
    keys = (layout.key, SALT)
    more = [c for c in customers.columns if c in keys or c not in fact.columns]
    return colocated.join_layout(layout, fact, customers.select(*more), how)


STAGES = ("bronze", "silver", "checks", "gold", "views")
LEDGER = "job_ledger"


def finished_stages(lake: Lake, batch_ts: datetime.datetime) -> set[str]:
    """Stages that earlier runs of this batch finished, by the ledger."""
    if not lake.spark.catalog.tableExists(lake.name(LEDGER)):
        return set()
    own = lake.read(LEDGER).where(F.col("batch") == batch_ts.isoformat())
    return {r["stage"] for r in own.select("stage").distinct().collect()}


def _line_checks(lake: Lake, batch_ts: datetime.datetime) -> DataFrame:
    """How many lines of each source of a batch could not be read."""
    own = F.col("_batch_date") == F.lit(batch_ts.date())
    return reduce(DataFrame.unionByName, [
        quality.readable_lines(
            f"bronze_{table}", lake.read(f"bronze_{table}").where(own), lake.read(f"quarantine_{table}").where(own)
        )
        for table in SOURCES
    ])


def run_medallion(
    lake: Lake,
    raw_dir: str,
    as_of: datetime.date | str | None = None,
    gate: bool = True,
    batch_ts: datetime.datetime | None = None,
    dedup: bool = False,
    thresholds: SegmentThresholds = SegmentThresholds(),
    rules: tuple[quality.Rule, ...] = quality.STANDARD_RULES,
    partition_by: tuple[str, ...] = (),
    catalog_views: bool = True,
    append: bool = False,
    quarantine: bool = False,
    resume: bool = False,
    colocate: int = 0,
    clear_raw: bool = False,
) -> RunResult:
    """Runs every stage. A failed check stops the job before gold, unless `gate` is off.

    With `append` the files are one more batch: bronze keeps the batches of other days, and of each
    business key silver takes the rows of its newest batch, all of them; with `dedup` the latest one.
    Only partitions that the batch changes are made again (:mod:`tillwright.plans.refresh`); tables are
    partitioned by batch then, and `partition_by` must be left empty.

    With `quarantine` lines that cannot be read are kept apart, and their number is one more check.

    A ledger notes each stage of a batch as it ends. With `resume` and the `batch_ts` of the run that
    failed, the stages it finished are passed over; a stage that failed, the checks included, runs again.

    `colocate` stores the fact in that many buckets by customer (see :func:`build_gold`); not with `append`.

    With `clear_raw` the source files are removed once all of them are in bronze. Shuffle files go with the
    step that made them (:func:`session.tidy`).
    """
    if append and colocate:
        raise ValueError("with append=True the fact is partitioned by batch and not co-located")
    if append and partition_by:
        raise ValueError("with append=True the tables are partitioned by batch")
    if resume and batch_ts is None:
        raise ValueError("resume needs the batch_ts of the run to go on with")
    lake.create()
    _open_ledger(lake)
    batch_ts = batch_ts or datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
    result = RunResult()

    def bronze() -> None:
        result.rows.update(load_all_bronze(lake, raw_dir, batch_ts, append, quarantine))
        if clear_raw:
            for table in SOURCES:
                remove(lake.spark, f"{raw_dir.rstrip('/')}/{FILE_NAMES[table]}")

    def refined() -> None:
        if append:
            result.rows.update(refresh.refresh_silver(lake, batch_sources(as_of, dedup=dedup), batch_ts.date()))
        else:
            result.rows.update(build_silver(lake, as_of, dedup=dedup))

    def checks() -> None:
        found = quality.report(silver_tables(lake), rules)
        if quarantine:
            found = found.unionByName(_line_checks(lake, batch_ts))
        lake.write(found, "quality_report")
        result.failed_checks = quality.enforce(lake.read("quality_report"), blocking=gate)

    def summed() -> None:
        if append:
            days = refresh.gold_days(lake)
            result.rows.update(refresh.refresh_gold(lake, silver_tables(lake), as_of, thresholds, days))
        else:
            result.rows.update(build_gold(lake, as_of, thresholds, partition_by, colocate))

    def shown() -> None:
        if catalog_views:
            views.create_catalog_views(lake.spark, lake.database)

    done = finished_stages(lake, batch_ts) if resume else set()
    with tidy(lake.spark):
        for stage, run in zip(STAGES, (bronze, refined, checks, summed, shown), strict=True):
            if stage not in done:
                run()
                _note(lake, batch_ts, stage)
    return result


def _note(lake: Lake, batch_ts: datetime.datetime, stage: str) -> None:
    lake.spark.sql(f"INSERT INTO {lake.name(LEDGER)} VALUES ('{batch_ts.isoformat()}', '{stage}', current_timestamp())")


def _open_ledger(lake: Lake) -> None:
    place = f" LOCATION '{lake.root.rstrip('/')}/{LEDGER}'" if lake.root else ""
    columns = "batch string, stage string, finished_at timestamp"
    lake.spark.sql(f"CREATE TABLE IF NOT EXISTS {lake.name(LEDGER)} ({columns}) USING {lake.fmt}{place}")


def layer_audit(lake: Lake, layer: str) -> DataFrame:
    """Row counts of one layer ("bronze", "silver" or "gold"), from its written tables."""
    if layer == "gold":
        names = GOLD_TABLES
    else:
        names = tuple(f"{layer}_{table}" for table in SOURCES)
    return row_counts({name: lake.read(name) for name in names})


def reconciliation(lake: Lake) -> DataFrame:
    """Rows and revenue per gold table; the revenue must be the same in all four."""
    revenue_column = {
        "gold_fact_sales": "total_amount",
        "gold_sales_daily": "total_revenue",
        "gold_sales_by_category": "total_revenue",
        "gold_customer_summary": "total_spend",
    }
    parts = [
        lake.read(name).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.round(F.sum(F.col(column).cast("decimal(38,2)")).cast("double"), 2).alias("revenue"),
        )
        for name, column in revenue_column.items()
    ]
    return reduce(DataFrame.unionByName, parts)
