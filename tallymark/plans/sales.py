"""The sales job: totals per product of a period, appended to a summary table and a detail table."""

from __future__ import annotations

import datetime
import logging
import uuid
from collections.abc import Callable, Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallymark.operators.aggregates import period_statistics, summary_statistics, total_by
from tallymark.operators.audit import AuditTrail, counted
from tallymark.operators.filters import Day, in_period, with_value
from tallymark.operators.joins import totals_per_period
from tallymark.operators.quality import require_columns
from tallymark.operators.reconcile import bag_diff
from tallymark.plans.session import build_session
from tallymark.sources.catalog import partition_spec
from tallymark.sources.ledger import Ledger
from tallymark.sources.readers import read_table
from tallymark.sources.scope import held, temp_view
from tallymark.sources.writers import append_by_name, fit_to_table, replace_partition, writing

log = logging.getLogger(__name__)

# The names of the tables and the messages of the validating form.
SOURCE, SUMMARY, DETAIL = "sales_table", "summary_table", "detailed_sales_summary"
DATES_MISSING = "Start date and end date must be provided"
DATES_INVERTED = "Start date must be less than or equal to end date"

PERIODS = pa.schema([("range_id", pa.int32()), ("s", pa.date32()), ("e", pa.date32())])


def sales_totals(
    sales: DataFrame,
    start: Day,
    end: Day,
    *,
    product: str = "product_id",
    amount: str = "sales",
    date: str = "sale_date",
    scale: int | None = None,
    as_text: bool | None = None,
) -> DataFrame:
    """``product_id, total_sales`` of the period. All-NULL products stay in, with a NULL total."""
    inside = in_period(require_columns(sales, product, amount, date), date, start, end, as_text=as_text)
    rows = inside.select(F.col(product).alias("product_id"), F.col(amount).alias("sales"))
    return total_by(rows, ["product_id"], "sales", scale=scale)


def detail_rows(totals: DataFrame) -> DataFrame:
    """The totals that the detail table takes: all that are not NULL."""
    return with_value(totals, "total_sales")


def load_gaps(summary: DataFrame, detail: DataFrame) -> DataFrame:
    """Rows that one of the two tables lacks (``surplus`` > 0: the detail); empty after complete loads.

    This is what a failure between the two writes of a load leaves behind.
    """
    return bag_diff(detail_rows(summary), detail)


def load_targets(
    totals: DataFrame,
    summary: str,
    detail: str,
    *,
    partition: Mapping[str, str] | None = None,
    allow_narrowing: bool = False,
) -> None:
    """Write all totals to the summary and the non-NULL ones to the detail.

    Two writes are not one transaction: if the second fails, the summary already holds its rows. With ``partition`` they
    replace that partition of both tables instead of being appended, so the load can simply be run again.
    """
    for table, rows in ((summary, totals), (detail, detail_rows(totals))):
        if partition:
            replace_partition(rows, table, allow_narrowing=allow_narrowing, **partition)
        else:
            append_by_name(rows, table, allow_narrowing=allow_narrowing)


def process_sales_data(
    start_date: str,
    end_date: str,
    spark: SparkSession | None = None,
    *,
    source: str = SOURCE,
    summary: str = SUMMARY,
    detail: str = DETAIL,
    scale: int | None = None,
    as_text: bool | None = None,
    period_column: str | None = None,
    hold: str = "checkpoint",
    allow_narrowing: bool = False,
    audit: AuditTrail | None = None,
) -> bool:
    """Load summary and detail for one period; True when both are written, an exception otherwise.

    The source is read once: the totals are held (see :func:`tallymark.sources.scope.held`) and appended twice. They are
    counted while they are computed. An empty source, an empty period or an inverted one loads nothing and succeeds.

    By default a second run appends the rows a second time. Where the targets are partitioned by ``period_column``, which
    then holds ``start/end``, a second run replaces the rows of the first.
    """
    session = spark or build_session()
    totals = sales_totals(read_table(session, source), start_date, end_date, scale=scale, as_text=as_text)
    partition = {period_column: f"{start_date}/{end_date}"} if period_column else {}
    for target in (summary, detail):
        fit_to_table(totals, target, allow_narrowing=allow_narrowing, given=partition)  # raises before anything runs
    if audit:
        totals = audit.step(totals, "summary", n_without_total=F.count_if(F.col("total_sales").isNull()))
    totals, seen = counted(totals, n_detail=F.count("total_sales"))
    with held(totals, hold) as rows:
        load_targets(rows, summary, detail, partition=partition, allow_narrowing=allow_narrowing)
    figures = seen.get
    log.info("%s to %s: %d products, %d with a total", start_date, end_date, figures["n_rows"], figures["n_detail"])
    return True


def process_sales_data_optimized(start_date: str, end_date: str, spark: SparkSession | None = None, **options) -> bool:
    """The same load without a cache: the totals go through a scratch table, which is dropped at the end."""
    return process_sales_data(start_date, end_date, spark, **{**options, "hold": "table"})


def validate_date_format(text: str | None) -> bool:
    """Whether ``text`` is a calendar date in the form ``yyyy-MM-dd``, months and days with two digits."""
    try:
        return datetime.datetime.strptime(text, "%Y-%m-%d").strftime("%Y-%m-%d") == text
    except (TypeError, ValueError):
        return False


def check_period(start: str | None, end: str | None) -> None:
    """Raise ``ValueError`` unless both are ``yyyy-MM-dd`` dates in order."""
    if not start or not end:
        raise ValueError(DATES_MISSING)
    for day in (start, end):
        if not validate_date_format(day):
            raise ValueError(f"Not a date in the form yyyy-MM-dd: {day!r}")
    if start > end:
        raise ValueError(DATES_INVERTED)


def process_sales_data_with_validation(
    start_date: str | None, end_date: str | None, spark: SparkSession | None = None, **options
) -> bool:
    """:func:`process_sales_data` after :func:`check_period`; nothing is read or written when the check fails."""
    check_period(start_date, end_date)
    return process_sales_data(start_date, end_date, spark, **options)


def sales_totals_sql(
    spark: SparkSession,
    start: str,
    end: str,
    source: str = SOURCE,
    *,
    scale: int | None = None,
    as_text: bool | None = None,
) -> DataFrame:
    """:func:`sales_totals` as SQL. Values are bound as parameters, never pasted into the text.

    With ``scale`` SQL filters and the total is :func:`exact_sum`, which has no short form in SQL.
    """
    text_dates = isinstance(spark.table(source).schema["sale_date"].dataType, StringType)
    cast = "TRY_CAST" if text_dates else "CAST"
    day, low, high = (
        ("sale_date", ":start", ":end")
        if (text_dates if as_text is None else as_text)
        else (f"{cast}(sale_date AS DATE)", "CAST(:start AS DATE)", "CAST(:end AS DATE)")
    )
    args = {"source": source, "start": start, "end": end}
    inside = f"FROM IDENTIFIER(:source) WHERE {day} BETWEEN {low} AND {high}"
    if scale is None:
        return spark.sql(f"SELECT product_id, SUM(sales) AS total_sales {inside} GROUP BY product_id", args=args)
    return total_by(spark.sql(f"SELECT product_id, sales {inside}", args=args), ["product_id"], "sales", scale=scale)


def process_sales_data_sql_approach(
    start_date: str,
    end_date: str,
    spark: SparkSession | None = None,
    *,
    source: str = SOURCE,
    summary: str = SUMMARY,
    detail: str = DETAIL,
    scale: int | None = None,
    as_text: bool | None = None,
    period_column: str | None = None,
    hold: str = "checkpoint",
    allow_narrowing: bool = False,
    audit: AuditTrail | None = None,
) -> bool:
    """:func:`process_sales_data` written in SQL: totals under a session name, two ``INSERT … SELECT``, the name dropped.

    The same options, checks before anything runs, and results. The name is new for each run, so that runs in one session
    do not meet.
    """
    session = spark or build_session()
    totals = sales_totals_sql(session, start_date, end_date, source, scale=scale, as_text=as_text)
    partition = {period_column: f"{start_date}/{end_date}"} if period_column else {}
    fitted = {t: fit_to_table(totals, t, allow_narrowing=allow_narrowing, given=partition).schema for t in (summary, detail)}
    if audit:
        totals = audit.step(totals, "summary", n_without_total=F.count_if(F.col("total_sales").isNull()))
    verb = "INSERT OVERWRITE" if partition else "INSERT INTO"
    spec = partition_spec(partition) if partition else ""
    with held(totals, hold) as rows, temp_view(rows, f"temp_sales_summary_{uuid.uuid4().hex}") as name:
        for target, condition in ((summary, "TRUE"), (detail, "total_sales IS NOT NULL")):
            columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fitted[target])
            with writing(session, target):
                session.sql(
                    f"{verb} TABLE IDENTIFIER(:target) {spec} SELECT {columns} FROM {name} WHERE {condition}",
                    args={"target": target},
                )
    return True


def periods_frame(spark: SparkSession, periods: Iterable[tuple[int, Day, Day]]) -> DataFrame:
    """``range_id, s, e`` from the periods a caller asks for."""
    day = datetime.date.fromisoformat
    rows = [(i, day(str(start)), day(str(end))) for i, start, end in periods]
    columns = [list(column) for column in zip(*rows, strict=True)] or [[], [], []]
    # through Arrow, so that the few rows are part of the plan and not a job of their own
    return spark.createDataFrame(pa.table(columns, schema=PERIODS))


def sales_totals_per_period(
    sales: DataFrame,
    periods: DataFrame,
    *,
    product: str = "product_id",
    amount: str = "sales",
    date: str = "sale_date",
    scale: int | None = None,
) -> DataFrame:
    """``range_id, product_id, total_sales`` for many periods from one read of the sales."""
    rows = require_columns(sales, product, amount, date).select(
        F.col(product).alias("product_id"), F.col(amount).alias("sales"), F.col(date).alias("sale_date")
    )
    return totals_per_period(rows, periods, keys=["product_id"], value="sales", date="sale_date", scale=scale)


def run_job(job: Callable[..., bool], *args, **options) -> bool:
    """``job``'s own result, or False after logging what went wrong; for callers that want a status, not an exception."""
    try:
        return job(*args, **options)
    except Exception:
        log.exception("%s failed", getattr(job, "__name__", job))
        return False


def process_sales_data_function(start_date: str, end_date: str, spark: SparkSession | None = None, **options) -> bool:
    """:func:`process_sales_data` with a status instead of exceptions."""
    return run_job(process_sales_data, start_date, end_date, spark, **options)


def get_sales_statistics(
    start_date: str, end_date: str, spark: SparkSession, source: str = SOURCE, *, scale: int | None = None
) -> dict[str, float]:
    """``total_records``, ``unique_products`` and ``total_sales_amount`` of a period, from one job."""
    inside = in_period(read_table(spark, source), "sale_date", start_date, end_date)
    return period_statistics(inside, "product_id", "sales", scale=scale).first().asDict()


def get_sales_summary_stats(totals: DataFrame, *, scale: int | None = None) -> dict[str, float] | None:
    """The figures of :func:`summary_statistics`, or None when there is nothing to sum up."""
    figures = summary_statistics(totals, scale=scale).first()
    return figures and figures.asDict()


class SalesDataProcessor:
    """The job bound to a session, with a status instead of exceptions."""

    def __init__(self, spark_session: SparkSession | None = None, **options):
        self.spark = spark_session or build_session("SalesDataProcessor")
        self._owns_session = spark_session is None
        self._options = options

    def process_sales_data(self, start_date: str, end_date: str) -> bool:
        if not start_date or not end_date:
            log.error(DATES_MISSING)
            return False
        return run_job(process_sales_data, start_date, end_date, self.spark, **self._options)

    def close(self) -> None:
        """Stop the session if this object started it."""
        if self._owns_session:
            self.spark.stop()


def process_sales_data_published(
    start_date: str,
    end_date: str,
    spark: SparkSession,
    *,
    ledger: Ledger,
    run_id: str,
    source: str = SOURCE,
    summary: str = SUMMARY,
    detail: str = DETAIL,
    scale: int | None = None,
    as_text: bool | None = None,
    allow_narrowing: bool = False,
) -> bool:
    """Load summary and detail so that both become visible at once (:mod:`tallymark.sources.ledger`).

    The detail is made of the staged summary: a run that is resumed with its ``run_id`` after a failure between the two
    writes gives tables that agree, also where the source has changed meanwhile. A later run of the period replaces it.
    """
    about = {"job": "process_sales_data", "scope": f"{start_date}/{end_date}", "run_id": run_id}
    totals = sales_totals(read_table(spark, source), start_date, end_date, scale=scale, as_text=as_text)
    for target in (summary, detail):
        fit_to_table(totals, target, allow_narrowing=allow_narrowing, given=["run_id"])
    ledger.stage(totals, summary, **about, allow_narrowing=allow_narrowing)
    ledger.stage(detail_rows(ledger.staged(summary, run_id)), detail, **about, allow_narrowing=allow_narrowing)
    ledger.publish(**about)
    return True
