"""Snapshot and version reads."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from daymark.showcase.registry import query
from daymark.showcase.roles import EVENT_RUN, RUN
from daymark.sources import snapshots as S
from daymark.sources import versions as V
from daymark.sources.registry import Source, load

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice", "actual_date")
ORDERS = """SELECT o_orderkey, o_custkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS actual_date
    FROM orders WHERE {}"""
DAY = "CAST(o_orderdate AS DATE)"


def daily(t):
    return t.orders.withColumn("actual_date", F.col("o_orderdate").cast("date")).select(*ORDER_COLUMNS)


def _orders(condition: str) -> str:
    return ORDERS.format(condition)


@query("SELECT o_orderkey, o_totalprice FROM orders")
def snap_full(t):
    return S.full(t.orders).select("o_orderkey", "o_totalprice")


@query(_orders(f"{DAY} = (SELECT max({DAY}) FROM orders WHERE {DAY} <= DATE '{RUN}')"))
def snap_last(t):
    return S.last(daily(t), RUN)


@query(_orders(f"{DAY} = (SELECT max({DAY}) FROM orders WHERE {DAY} <= DATE '1998-03-31')"))
def snap_last_months_back(t):
    return S.last(daily(t), RUN, months_back=3)


@query(
    _orders(
        f"{DAY} = (SELECT min({DAY}) FROM orders WHERE {DAY} BETWEEN DATE '1998-06-01' AND DATE '1998-06-30')"
    )
)
def snap_first_in_month(t):
    return S.first_in_month(daily(t), RUN)


@query(_orders(f"{DAY} = DATE '{RUN}'"))
def snap_exact(t):
    return S.exact(daily(t), RUN)


@query(_orders(f"{DAY} <= DATE '{RUN}'"))
def snap_until(t):
    return S.until(daily(t), RUN)


@query(_orders(f"{DAY} < DATE '{RUN}'"))
def snap_before(t):
    return S.until(daily(t), RUN, inclusive=False)


@query(_orders(f"{DAY} > DATE '1998-02-15' AND {DAY} <= DATE '{RUN}'"))
def snap_months(t):
    return S.month_period(daily(t), RUN, 4)


@query(_orders(f"{DAY} >= DATE '1998-06-01' AND {DAY} <= DATE '{RUN}'"))
def snap_current_month(t):
    return S.month_period(daily(t), RUN, 0)


@query(_orders(f"{DAY} >= DATE '1998-04-01' AND {DAY} < DATE '1998-06-01'"))
def snap_prev_months(t):
    return S.month_period(daily(t), RUN, 2, include_current_month=False)


@query(
    f"""SELECT event_id, user_id, value FROM events
        WHERE CAST(ts AS DATE) > DATE '{EVENT_RUN}' - 5 AND CAST(ts AS DATE) <= DATE '{EVENT_RUN}'"""
)
def snap_days(t):
    events = t.events.withColumn("day", F.col("ts").cast("date"))
    return S.day_period(events, EVENT_RUN, 5, "day").select("event_id", "user_id", "value")


@query(_orders(f"{DAY} BETWEEN DATE '1997-11-01' AND DATE '1998-02-28'"))
def snap_range_month(t):
    return S.date_range(daily(t), "1997-11-17", "1998-02-03", level="month")


@query(_orders(f"{DAY} BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"))
def snap_range_year(t):
    return S.date_range(daily(t), "1996-05-05", "1997-05-05", level="year")


@query(_orders(f"{DAY} BETWEEN DATE '1996-05-05' AND DATE '1996-05-25'"))
def snap_range_day(t):
    return S.date_range(daily(t), "1996-05-05", "1996-05-25")


@query(
    f"""WITH intervals AS (
            SELECT o_custkey, o_orderkey, {DAY} AS valid_from,
                   coalesce(lead({DAY}) OVER (PARTITION BY o_custkey ORDER BY {DAY}, o_orderkey), DATE '9999-12-31')
                       AS valid_to
            FROM orders)
        SELECT o_custkey, o_orderkey, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to
        FROM intervals WHERE valid_from <= DATE '{RUN}' AND DATE '{RUN}' < valid_to"""
)
def asof_interval(t):
    following = F.lead("valid_from").over(Window.partitionBy("o_custkey").orderBy("valid_from", "o_orderkey"))
    intervals = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("valid_from"))
    intervals = intervals.withColumn("valid_to", F.coalesce(following, F.lit("9999-12-31").cast("date")))
    return S.valid_at(intervals, RUN, "valid_from", "valid_to")


CALENDAR = """
    SELECT d AS cdate_date,
           CASE WHEN d = max(d) OVER (PARTITION BY year(d), month(d)) THEN 'M'
                WHEN day(d) = 15 THEN 'H' ELSE '' END AS pflag
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM {orders})"""
CALENDAR_SQL = CALENDAR.replace("{orders}", "orders")


@query(
    f"""WITH calendar AS ({CALENDAR_SQL}),
        month_days AS (
            SELECT cdate_date, row_number() OVER (ORDER BY cdate_date) AS n FROM calendar
            WHERE cdate_date BETWEEN DATE '1998-04-01' AND DATE '1998-04-30')
        {_orders(f"{DAY} = (SELECT cdate_date FROM month_days WHERE n = 7)")}"""
)
def business_day_nth(t):
    return S.on_business_day(daily(t), t.sql(CALENDAR), RUN, months_back=2, nth=7)


@query(
    f"""WITH calendar AS ({CALENDAR_SQL})
        {_orders(f"{DAY} = (SELECT max(cdate_date) FROM calendar WHERE cdate_date BETWEEN DATE '1998-05-01' "
                 "AND DATE '1998-05-31')")}"""
)
def business_day_past_last(t):
    """A number past the last business day means the last one."""
    return S.on_business_day(daily(t), t.sql(CALENDAR), RUN, months_back=1, nth=99)


@query(
    f"""WITH calendar AS ({CALENDAR_SQL})
        {_orders(f"{DAY} = (SELECT cdate_date FROM calendar WHERE pflag = 'M' AND cdate_date BETWEEN "
                 "DATE '1998-05-01' AND DATE '1998-05-31')")}"""
)
def business_day_end(t):
    return S.on_business_day(daily(t), t.sql(CALENDAR), RUN)


@query(
    f"""WITH calendar AS ({CALENDAR_SQL})
        {_orders(f"{DAY} = (SELECT cdate_date FROM calendar WHERE pflag = 'H' AND cdate_date BETWEEN "
                 "DATE '1998-05-01' AND DATE '1998-05-31')")}"""
)
def business_day_half(t):
    return S.on_business_day(daily(t), t.sql(CALENDAR), RUN, nth="half")


@query(
    _orders(f"{DAY} = (SELECT max({DAY}) FROM orders WHERE {DAY} BETWEEN DATE '1998-05-01' AND DATE '1998-05-31')")
)
def month_end_snapshot(t):
    return S.previous_month_end(daily(t), RUN)


@query(_orders(f"{DAY} <= DATE '{RUN}' AND o_totalprice > 300000 AND o_orderstatus = 'F'"))
def read_with_filters(t):
    rows = t.orders.withColumn("actual_date", F.col("o_orderdate").cast("date"))
    rows = S.where_all(S.until(rows, RUN), "o_totalprice > 300000", F.col("o_orderstatus") == "F")
    return rows.select(*ORDER_COLUMNS)


@query(
    f"""SELECT bbn, version_id, status, CAST(amount AS DOUBLE) AS amount, CAST(actual_date AS VARCHAR) AS actual_date
        FROM (SELECT *, row_number() OVER (PARTITION BY bbn ORDER BY actual_date DESC, version_id) AS rn
              FROM versions WHERE actual_date <= DATE '{RUN}')
        WHERE rn = 1 AND status <> 'F'""",
    roles=("versions",),
)
def scd2_asof_read(t):
    return V.versions_as_of(
        t.role("versions"), ["bbn"], RUN, deleted=F.col("status") == "F", tie_break=["version_id"]
    )


@query(
    f"""SELECT bbn, version_id, status, CAST(amount AS DOUBLE) AS amount, CAST(actual_date AS VARCHAR) AS actual_date
        FROM (SELECT *, row_number() OVER (PARTITION BY bbn ORDER BY actual_date DESC, version_id) AS rn
              FROM versions WHERE actual_date <= DATE '{RUN}')
        WHERE rn = 1""",
    roles=("versions",),
)
def scd2_asof_read_with_deleted(t):
    return V.versions_as_of(
        t.role("versions"), ["bbn"], RUN, deleted=F.col("status") == "F", keep_deleted=True, tie_break=["version_id"]
    )


# every order opens a version that ends with the customer's next one; a last version with status F is a tombstone
VALIDITY = """
    SELECT bbn, version_id, actual_date AS row_eff_start_date,
           CASE WHEN following IS NOT NULL THEN following WHEN status = 'F' THEN NULL ELSE DATE '9999-12-31' END
               AS row_eff_end_date,
           CASE WHEN following IS NULL THEN 'Y' ELSE 'N' END AS current_row_flag
    FROM (SELECT bbn, version_id, status, actual_date,
                 lead(actual_date) OVER (PARTITION BY bbn ORDER BY actual_date, version_id) AS following
          FROM versions)"""
VALIDITY_COLUMNS = """bbn, version_id, CAST(row_eff_start_date AS VARCHAR) AS row_eff_start_date,
    CAST(row_eff_end_date AS VARCHAR) AS row_eff_end_date, current_row_flag"""


def _validity(t):
    return t.spark.sql(VALIDITY.replace("versions", "{versions}"), versions=t.role("versions"))


@query(f"SELECT {VALIDITY_COLUMNS} FROM ({VALIDITY}) WHERE current_row_flag = 'Y'", roles=("versions",))
def scd2_current(t):
    return V.current(_validity(t))


@query(
    f"""SELECT {VALIDITY_COLUMNS} FROM ({VALIDITY})
        WHERE current_row_flag = 'Y' AND row_eff_end_date IS NOT NULL""",
    roles=("versions",),
)
def scd2_live(t):
    return V.live(_validity(t))


@query(
    f"""SELECT bbn, CASE WHEN upper(trim(phone)) IN ('NAN', 'NA', 'N/A', 'N.A.', 'N.A', 'NONE') THEN NULL
                ELSE CASE WHEN length(regexp_replace(phone, '\\D', '', 'g')) = 11
                     THEN '63' || substr(regexp_replace(phone, '\\D', '', 'g'), 2) END END AS phone,
               name
        FROM (SELECT CAST(c_custkey AS VARCHAR) AS bbn, ' 0917-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone,
                     c_name AS name, DATE '{RUN}' - c_nationkey AS actual_date, c_acctbal FROM customer)
        WHERE actual_date > DATE '1998-05-15' AND actual_date <= DATE '{RUN}' AND bbn <> ''"""
)
def source_read(t):
    """A read from its declaration: trailing month, cleaned text, normalised phone, filter."""
    rows = t.sql(
        f"""SELECT CAST(c_custkey AS STRING) AS bbn, ' 0917-' || lpad(CAST(c_custkey AS STRING), 7, '0') AS phone,
                   c_name || ' ' AS name, DATE '{RUN}' - c_nationkey AS actual_date FROM {{customer}}"""
    )
    spec = Source("customers", 1, filters=("bbn <> ''",), mobile=("phone",))
    return load(spec, lambda _: rows, RUN).select("bbn", "phone", "name")
