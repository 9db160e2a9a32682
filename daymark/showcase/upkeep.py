"""Versioned tables, contracts, quality checks and sinks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from daymark.operators import contract as C
from daymark.operators import quality, reconcile, scd
from daymark.operators.sequence import number_weighted
from daymark.showcase.registry import query
from daymark.showcase.roles import RUN
from daymark.shared import scratch_path, settle
from daymark.sinks import files, tables
from daymark.sources import snapshots as S
from daymark.sources import versions as V

NOW = dt.datetime(1998, 6, 15, 10, 30, 0)
USER = "nightly"

# --- versioned tables -----------------------------------------------------------------------------------

# The table before the run: tombstones, rows opened on the run date, rows without a hash, and history.
TARGET_ROWS = """
    SELECT CAST(c_custkey AS STRING) AS bbn, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
           CASE WHEN c_nationkey = 10 THEN DATE '1998-06-15' ELSE DATE '1998-01-01' + c_nationkey END AS row_eff_start_date,
           CASE WHEN c_acctbal < 500 THEN NULL ELSE DATE '9999-12-31' END AS row_eff_end_date, 'Y' AS current_row_flag,
           c_nationkey AS nation
    FROM {customer}
    UNION ALL
    SELECT CAST(c_custkey AS STRING), 'OLD', CAST(1 AS DECIMAL(18,2)), DATE '1997-01-01', DATE '1998-01-01' + c_nationkey, 'N', c_nationkey
    FROM {customer} WHERE c_nationkey < 5"""
# The source of the run: one segment has new balances, one nation is gone, one nation has new customers.
SOURCE = """
    SELECT CAST(c_custkey AS STRING) AS bbn, c_mktsegment AS segment,
           CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS DECIMAL(18,2)) AS balance
    FROM {customer} WHERE c_nationkey <> 3
    UNION ALL
    SELECT 'N' || CAST(c_custkey AS STRING), c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) FROM {customer} WHERE c_nationkey = 4"""
HASH = "md5(concat_ws(chr(31), coalesce(CAST(balance AS VARCHAR), '__NULL__'), coalesce(bbn, '__NULL__'), coalesce(segment, '__NULL__')))"


def _text(sql: str) -> str:
    return sql.replace("{customer}", "customer")


TARGET_CTES = f"""target AS (SELECT * EXCLUDE (nation), CASE WHEN nation = 11 THEN NULL ELSE {HASH} END AS row_hash_value,
        'loader' AS ctrl_create_user_id, TIMESTAMP '1998-01-01 08:00:00' AS ctrl_create_ts,
        'loader' AS ctrl_last_update_user_id, TIMESTAMP '1998-01-01 08:00:00' AS ctrl_last_update_ts
    FROM ({_text(TARGET_ROWS)})),
    source AS (SELECT *, {HASH} AS row_hash_value FROM ({_text(SOURCE)}))"""


def _target(t):
    rows = t.sql(TARGET_ROWS)
    hashed = rows.withColumn(scd.HASH, F.when(F.col("nation") != 11, scd.row_hash(["balance", "bbn", "segment"])))
    stamped = scd.with_control_columns(hashed, "loader", dt.datetime(1998, 1, 1, 8, 0, 0))
    return stamped.drop("nation")


SHOWN = """bbn, segment, CAST(balance AS DOUBLE) AS balance, CAST(row_eff_start_date AS VARCHAR) AS row_eff_start_date,
    CAST(row_eff_end_date AS VARCHAR) AS row_eff_end_date, current_row_flag, row_hash_value, ctrl_create_user_id,
    CAST(ctrl_create_ts AS VARCHAR) AS ctrl_create_ts, ctrl_last_update_user_id, CAST(ctrl_last_update_ts AS VARCHAR) AS ctrl_last_update_ts"""
# case by case: what the current row of a key and the source's row of that key lead to
STEP_CTES = f"""{TARGET_CTES},
    both_sides AS (
        SELECT t.bbn AS t_bbn, s.bbn AS s_bbn, t.* EXCLUDE (bbn), s.segment AS s_segment, s.balance AS s_balance,
               s.row_hash_value AS s_hash, t.row_eff_end_date IS NULL AS tomb,
               t.row_hash_value IS NOT NULL AND t.row_hash_value = s.row_hash_value AS same
        FROM (SELECT * FROM target WHERE current_row_flag = 'Y') t FULL JOIN source s ON t.bbn = s.bbn),
    step AS (
        SELECT t_bbn AS bbn, segment, balance, row_eff_start_date, row_eff_end_date, 'Y' AS current_row_flag, row_hash_value,
               ctrl_create_user_id, ctrl_create_ts, ctrl_last_update_user_id, ctrl_last_update_ts, 'unchanged' AS scd_action
        FROM both_sides WHERE t_bbn IS NOT NULL AND (tomb AND s_bbn IS NULL OR NOT tomb AND s_bbn IS NOT NULL AND same)
        UNION ALL
        SELECT t_bbn, segment, balance, row_eff_start_date, CASE WHEN NOT tomb THEN DATE '{RUN}' END, 'N', row_hash_value,
               ctrl_create_user_id, ctrl_create_ts, '{USER}', TIMESTAMP '{NOW}', 'closed'
        FROM both_sides WHERE t_bbn IS NOT NULL AND row_eff_start_date < DATE '{RUN}'
          AND (tomb AND s_bbn IS NOT NULL OR NOT tomb AND (s_bbn IS NULL OR NOT same))
        UNION ALL
        SELECT s_bbn, s_segment, s_balance, DATE '{RUN}', DATE '9999-12-31', 'Y', s_hash, '{USER}', TIMESTAMP '{NOW}', '{USER}',
               TIMESTAMP '{NOW}', 'inserted'
        FROM both_sides WHERE s_bbn IS NOT NULL AND (t_bbn IS NULL OR tomb OR NOT same)
        UNION ALL
        SELECT t_bbn, segment, balance, DATE '{RUN}', NULL, 'Y', row_hash_value, '{USER}', TIMESTAMP '{NOW}', '{USER}',
               TIMESTAMP '{NOW}', 'deleted'
        FROM both_sides WHERE t_bbn IS NOT NULL AND s_bbn IS NULL AND NOT tomb)"""


@query(f"SELECT bbn, {HASH} AS row_hash_value FROM ({_text(SOURCE)})")
def row_hash(t):
    return scd.with_row_hash(t.sql(SOURCE)).select("bbn", scd.HASH)


@query(f"WITH {STEP_CTES} SELECT {SHOWN}, scd_action FROM step WHERE scd_action <> 'unchanged'")
def scd2_changes(t):
    return scd.scd2_changes(_target(t), t.sql(SOURCE), ["bbn"], RUN, user=USER, now=NOW)


MERGED = f"WITH {STEP_CTES} SELECT {SHOWN} FROM step UNION ALL SELECT {SHOWN} FROM target WHERE current_row_flag = 'N'"


@query(MERGED)
def scd2_merge(t):
    return scd.scd2_merge(_target(t), t.sql(SOURCE), ["bbn"], RUN, user=USER, now=NOW)


@query(MERGED)
def scd2_idempotent(t):
    """Applying the same source a second time changes nothing."""
    once = scd.scd2_merge(_target(t), t.sql(SOURCE), ["bbn"], RUN, user=USER, now=NOW)
    return scd.scd2_merge(once, t.sql(SOURCE), ["bbn"], RUN, user="second", now=dt.datetime(1998, 6, 15, 12, 0))


@query(MERGED)
def scd2_types_differ(t):
    """A source with doubles where the table holds decimals changes nothing that is equal."""
    source = t.sql(SOURCE).withColumn("balance", F.col("balance").cast("double"))
    return scd.scd2_merge(_target(t), source, ["bbn"], RUN, user=USER, now=NOW)


SCD1_MERGED = f"""WITH {TARGET_CTES}, held AS (SELECT * FROM target WHERE current_row_flag = 'Y')
        SELECT coalesce(s.bbn, t.bbn) AS bbn, CAST(CASE WHEN upd THEN s.balance ELSE t.balance END AS DOUBLE) AS balance,
               CASE WHEN upd THEN s.row_hash_value ELSE t.row_hash_value END AS row_hash_value,
               coalesce(t.ctrl_create_user_id, '{USER}') AS ctrl_create_user_id,
               CASE WHEN upd THEN '{USER}' ELSE t.ctrl_last_update_user_id END AS ctrl_last_update_user_id,
               CAST(CASE WHEN upd THEN TIMESTAMP '{NOW}' ELSE t.ctrl_last_update_ts END AS VARCHAR) AS ctrl_last_update_ts
        FROM (SELECT t.bbn AS tk, s.bbn AS sk, s.bbn IS NOT NULL AND (t.row_hash_value IS NULL OR t.row_hash_value <> s.row_hash_value) AS upd
              FROM held t FULL JOIN source s ON t.bbn = s.bbn) k LEFT JOIN held t ON k.tk = t.bbn LEFT JOIN source s ON k.sk = s.bbn"""


@query(SCD1_MERGED)
def scd1_merge(t):
    held = _target(t).where("current_row_flag = 'Y'").drop(*scd.VERSION_COLUMNS)
    merged = scd.scd1_merge(held, t.sql(SOURCE), ["bbn"], user=USER, now=NOW)
    return merged.select(
        "bbn", "balance", scd.HASH, scd.CREATE_USER, scd.UPDATE_USER, scd.UPDATE_TS
    )


# orders as versions, with two kinds of damage: several current rows, and equal content in adjoining intervals
DAMAGED = """
    SELECT CAST(o_custkey AS STRING) AS bbn, o_orderstatus AS status, md5(o_orderstatus) AS row_hash_value,
           CAST(o_orderdate AS DATE) AS row_eff_start_date,
           CASE WHEN following IS NULL THEN DATE '9999-12-31' WHEN o_totalprice > 480000 THEN NULL ELSE following END AS row_eff_end_date,
           CASE WHEN following IS NULL OR o_totalprice > 400000 THEN 'Y' ELSE 'N' END AS current_row_flag, o_orderkey AS version_id
    FROM (SELECT *, lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS following
          FROM {orders})"""
DAMAGED_SQL = DAMAGED.replace("{orders}", "orders")
RANK = """CASE WHEN row_eff_end_date = DATE '9999-12-31' THEN 0 ELSE 1 END, row_eff_start_date, status, row_hash_value,
    row_eff_end_date NULLS FIRST, current_row_flag, version_id"""


@query(
    f"""WITH damaged AS ({DAMAGED_SQL}),
        chained AS (SELECT DISTINCT a.bbn, a.row_hash_value FROM damaged a JOIN damaged b ON a.bbn = b.bbn
            AND a.row_hash_value = b.row_hash_value AND a.row_eff_end_date = b.row_eff_start_date AND b.row_eff_end_date IS NOT NULL),
        marked AS (SELECT d.*, c.bbn IS NOT NULL AND row_eff_end_date IS NOT NULL AS broken
            FROM damaged d LEFT JOIN chained c ON d.bbn = c.bbn AND d.row_hash_value = c.row_hash_value),
        seen AS (SELECT *, max(row_eff_end_date) OVER (PARTITION BY bbn, row_hash_value ORDER BY row_eff_start_date, row_eff_end_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM marked WHERE broken),
        chains AS (SELECT *, sum(CASE WHEN reached IS NULL OR row_eff_start_date > reached THEN 1 ELSE 0 END) OVER (
            PARTITION BY bbn, row_hash_value ORDER BY row_eff_start_date, row_eff_end_date ROWS UNBOUNDED PRECEDING) AS chain FROM seen),
        spans AS (SELECT bbn, row_hash_value, chain, min(row_eff_start_date) AS from_date, max(row_eff_end_date) AS to_date FROM chains GROUP BY ALL),
        first_rows AS (SELECT * FROM chains QUALIFY row_number() OVER (PARTITION BY bbn, row_hash_value, chain ORDER BY {RANK}) = 1),
        whole AS (
            SELECT bbn, status, row_hash_value, row_eff_start_date, row_eff_end_date, current_row_flag, version_id FROM marked WHERE NOT broken
            UNION ALL SELECT f.bbn, status, f.row_hash_value, from_date, to_date, current_row_flag, version_id
            FROM first_rows f JOIN spans s ON f.bbn = s.bbn AND f.row_hash_value = s.row_hash_value AND f.chain = s.chain),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY bbn, current_row_flag ORDER BY {RANK}) AS current_rank FROM whole)
        SELECT bbn, status, row_hash_value, CAST(row_eff_start_date AS VARCHAR) AS row_eff_start_date,
               CAST(row_eff_end_date AS VARCHAR) AS row_eff_end_date, current_row_flag, version_id
        FROM ranked WHERE current_row_flag = 'N' OR current_rank = 1"""
)
def scd2_repair(t):
    return scd.scd2_repair(t.sql(DAMAGED), ["bbn"])


# the same content in adjoining intervals, then other content, then the first content again
RETURNING = """
    SELECT CAST(c_custkey AS STRING) AS bbn, segment AS status, md5(segment) AS row_hash_value, CAST(from_date AS DATE) AS row_eff_start_date,
           CAST(to_date AS DATE) AS row_eff_end_date, flag AS current_row_flag, c_custkey * 10 + n AS version_id
    FROM {customer} LATERAL VIEW inline(array(struct(1, 'A', '1998-01-01', '1998-02-01', 'N'), struct(2, 'A', '1998-02-01', '1998-03-01', 'N'),
        struct(3, 'B', '1998-03-01', '1998-06-01', 'N'), struct(4, 'A', '1998-06-01', '9999-12-31', 'Y'))) v AS n, segment, from_date, to_date, flag
    WHERE c_nationkey < 12 OR n <> 2"""


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS bbn, status, md5(status) AS row_hash_value, start_ AS row_eff_start_date, end_ AS row_eff_end_date,
           flag AS current_row_flag, c_custkey * 10 + n AS version_id
       FROM customer, LATERAL (VALUES (1, 'A', '1998-01-01', CASE WHEN c_nationkey < 12 THEN '1998-03-01' ELSE '1998-02-01' END, 'N'),
           (3, 'B', '1998-03-01', '1998-06-01', 'N'), (4, 'A', '1998-06-01', '9999-12-31', 'Y')) v (n, status, start_, end_, flag)"""
)
def scd2_repair_returning(t):
    """A chain becomes one row; the same content after a gap stays a version of its own."""
    return scd.scd2_repair(t.sql(RETURNING), ["bbn"])


APPEND_SOURCE = """
    SELECT CAST(c_custkey AS STRING) AS bbn, CASE WHEN c_acctbal > 5000 THEN ' F' ELSE 'O ' END AS status FROM {customer}
    UNION ALL SELECT 'N' || CAST(c_custkey AS STRING), 'n/a' FROM {customer} WHERE c_acctbal < 0"""


@query(
    f"""WITH latest AS (SELECT bbn, status FROM (SELECT *, row_number() OVER (PARTITION BY bbn ORDER BY actual_date DESC, version_id DESC) AS rn
                FROM versions WHERE actual_date <= DATE '{RUN}') WHERE rn = 1),
        incoming AS (SELECT bbn, CASE WHEN trim(status) = 'n/a' THEN '' ELSE trim(status) END AS status FROM ({_text(APPEND_SOURCE)}))
        SELECT i.bbn, i.status, (SELECT max(version_id) FROM versions) + row_number() OVER (ORDER BY i.bbn) AS version_id, '{RUN}' AS actual_date
        FROM incoming i LEFT JOIN latest l ON i.bbn = l.bbn WHERE l.bbn IS NULL OR l.status <> i.status""",
    roles=("versions",),
)
def scd2_append(t):
    """New and changed keys of an append-only table, with ids that go on from the highest one."""
    # two orders of a customer on one day: the one with the higher id is the later version
    versions = t.role("versions")
    last_of_day = versions.groupBy("bbn", "actual_date").agg(F.max("version_id").alias("version_id"))
    history = versions.join(last_of_day, ["bbn", "actual_date", "version_id"]).select("bbn", "status", "version_id", "actual_date")
    return scd.scd2_append(history, t.sql(APPEND_SOURCE), ["bbn"], RUN, id_column="version_id")


def _append_sql(after: str) -> str:
    return f"""WITH latest AS (SELECT bbn, status FROM (SELECT *, row_number() OVER (PARTITION BY bbn ORDER BY actual_date DESC, version_id DESC) AS rn
                FROM versions WHERE actual_date <= DATE '{RUN}') WHERE rn = 1),
        incoming AS (SELECT bbn, CASE WHEN trim(status) = 'n/a' THEN '' ELSE trim(status) END AS status FROM ({_text(APPEND_SOURCE)})),
        appended AS (SELECT i.bbn, i.status, (SELECT max(version_id) FROM versions WHERE actual_date <= DATE '{RUN}') + row_number() OVER (ORDER BY i.bbn) AS version_id,
            '{RUN}' AS actual_date FROM incoming i LEFT JOIN latest l ON i.bbn = l.bbn WHERE l.bbn IS NULL OR l.status <> i.status) {after}"""


def _append_state(t):
    """History up to the run, one row a day, and its state."""
    versions = t.role("versions").where(F.col("actual_date") <= RUN)
    last_of_day = versions.groupBy("bbn", "actual_date").agg(F.max("version_id").alias("version_id"))
    last = versions.join(last_of_day, ["bbn", "actual_date", "version_id"]).select("bbn", "status", "version_id", "actual_date")
    # the highest id may stand on a row that a later one of its day replaced
    return settle(scd.latest_state(last, ["bbn"], "version_id"))


@query(_append_sql("SELECT * FROM appended"), roles=("versions",))
def scd2_append_indexed(t):
    """New and changed keys told by the stored state of the history, which isn't read."""
    return scd.scd2_append_indexed(_append_state(t), t.sql(APPEND_SOURCE), ["bbn"], RUN, id_column="version_id")


NEXT_DAY = """SELECT CAST(c_custkey AS STRING) AS bbn, CASE WHEN c_acctbal > 9000 THEN 'P' WHEN c_acctbal > 5000 THEN 'F' ELSE 'O' END AS status FROM {customer}"""


@query(
    _append_sql(
        """SELECT bbn, 'P' AS status, (SELECT max(version_id) FROM appended) + row_number() OVER (ORDER BY bbn) AS version_id, '1998-06-16' AS actual_date
           FROM (SELECT CAST(c_custkey AS VARCHAR) AS bbn FROM customer WHERE c_acctbal > 9000)"""
    ),
    roles=("versions",),
)
def scd2_append_indexed_again(t):
    """With the state carried on, the next day's source brings only what it changes."""
    state = _append_state(t)
    fresh = settle(scd.scd2_append_indexed(state, t.sql(APPEND_SOURCE), ["bbn"], RUN, id_column="version_id"))
    after = settle(scd.next_state(state, fresh, ["bbn"], "version_id"))
    return scd.scd2_append_indexed(after, t.sql(NEXT_DAY), ["bbn"], "1998-06-16", id_column="version_id")


@query(
    f"""WITH old AS (SELECT CAST(c_custkey AS VARCHAR) AS bbn, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer),
        source AS ({_text(SOURCE)})
        SELECT o.bbn, o.segment, CAST(o.balance AS DOUBLE) AS balance, '1998-01-01' AS row_eff_start_date,
               CASE WHEN s.bbn IS NOT NULL AND s.balance = o.balance THEN '9999-12-31' ELSE '{RUN}' END AS row_eff_end_date,
               CASE WHEN s.bbn IS NOT NULL AND s.balance = o.balance THEN 'Y' ELSE 'N' END AS current_row_flag
        FROM old o LEFT JOIN source s ON o.bbn = s.bbn
        UNION ALL SELECT s.bbn, s.segment, CAST(s.balance AS DOUBLE), '{RUN}', '9999-12-31', 'Y' FROM source s LEFT JOIN old o ON o.bbn = s.bbn
        WHERE o.bbn IS NULL OR s.balance <> o.balance
        UNION ALL SELECT o.bbn, o.segment, CAST(o.balance AS DOUBLE), '{RUN}', NULL, 'Y' FROM old o WHERE o.bbn NOT IN (SELECT bbn FROM source)"""
)
def scd2_migrate(t):
    """A table without versions becomes a versioned one and takes in the source."""
    old = t.sql(
        "SELECT CAST(c_custkey AS STRING) AS bbn, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM {customer}"
    )
    return scd.migrate_to_scd2(old, t.sql(SOURCE), ["bbn"], RUN, initial_date="1998-01-01").drop(scd.HASH)


# --- contracts and quality ---------------------------------------------------------------------------------

ORDERS = C.TableContract.load(
    {
        "name": "orders_hist_daily",
        "columns": [
            {"name": "o_orderkey", "data_type": "bigint", "is_pkey": True},
            {"name": "customer", "data_type": "string"},
            {"name": "o_totalprice", "data_type": "decimal(18,2)"},
            {"name": "o_orderstatus", "data_type": "string", "domain": ["F", "O"]},
            {"name": "load_date", "data_type": "date"},
            {"name": "actual_date", "data_type": "date", "is_partition_col": True},
        ],
        "meta": {"rename_columns_if_exists": {"o_custkey": "customer", "gone": "x"}, "fill_inexisting_columns_with_date": True},
    }
)


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice, o_orderstatus FROM orders")
def conform_schema(t):
    """Declared columns that exist, in declared order and type."""
    return C.conform(t.orders, ORDERS)


@query(
    f"""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, o_totalprice, o_orderstatus, '{RUN}' AS load_date, '{RUN}' AS actual_date
        FROM orders"""
)
def rename_and_fill(t):
    filled = C.apply_meta(t.orders, ORDERS, RUN)
    return C.conform(filled, ORDERS, strict=True)


LINES = C.TableContract.load(
    {
        "name": "lines",
        "columns": [
            {"name": "l_orderkey", "data_type": "bigint", "is_pkey": True},
            {"name": "l_linenumber", "data_type": "int", "is_pkey": True},
            {"name": "l_returnflag", "data_type": "string", "domain": ["A", "N"]},
            {"name": "note", "data_type": "int"},
        ],
    }
)


@query(
    f"""WITH rows_ AS (SELECT l_orderkey, CASE WHEN l_quantity > 1 THEN l_linenumber END AS l_linenumber, l_returnflag,
                         CASE WHEN l_discount > 0.09 THEN 'many' ELSE '1' END AS note FROM lineitem),
        keyed AS (SELECT *, CAST(l_orderkey AS VARCHAR) || '|' || coalesce(CAST(l_linenumber AS VARCHAR), '') AS row_key FROM rows_)
        SELECT 'lines' AS table_name, check_name, column_name, row_key, value, '{RUN}' AS actual_date FROM (
            SELECT 'key_present' AS check_name, 'l_linenumber' AS column_name, row_key, NULL AS value FROM keyed WHERE l_linenumber IS NULL
            UNION ALL SELECT 'domain', 'l_returnflag', row_key, l_returnflag FROM keyed WHERE l_returnflag NOT IN ('A', 'N')
            UNION ALL SELECT 'type', 'note', row_key, note FROM keyed WHERE TRY_CAST(note AS INTEGER) IS NULL
            UNION ALL SELECT 'key_unique', 'l_orderkey|l_linenumber', row_key, CAST(count(*) AS VARCHAR) FROM keyed
                      GROUP BY l_orderkey, l_linenumber, row_key HAVING count(*) > 1)"""
)
def dq_errors(t):
    rows = t.lineitem.select(
        "l_orderkey",
        F.when(F.col("l_quantity") > 1, F.col("l_linenumber")).alias("l_linenumber"),
        "l_returnflag",
        F.when(F.col("l_discount") > 0.09, "many").otherwise("1").alias("note"),
    )
    return quality.check_table(rows, LINES, RUN)


# --- sinks: written to the shared folder and read back --------------------------------------------------------


def _table(t, name: str, contract: C.TableContract) -> str:
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    tables.create_table(t.spark, table, contract, scratch_path(t.spark, name))
    return table


DAILY = C.TableContract.from_ddl(
    "daily", "o_orderkey bigint, o_totalprice double, o_orderstatus string, day date", keys=("o_orderkey",), partitions=("day",),
    write_ordered_by=("o_orderkey",),
)
# one partition a month keeps the files few; the column stands for the snapshot date
MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"


def _monthly(t):
    return t.orders.withColumn("day", F.trunc(F.col("o_orderdate").cast("date"), "month"))


PRICED = C.TableContract.load(
    {
        "name": "priced",
        "columns": [
            {"name": "l_orderkey", "data_type": "bigint", "is_pkey": True},
            {"name": "l_linenumber", "data_type": "int", "is_pkey": True},
            {"name": "l_returnflag", "data_type": "string", "domain": ["A", "N"]},
            {"name": "l_extendedprice", "data_type": "double"},
        ],
    }
)


@query(
    """WITH rows_ AS (SELECT l_orderkey, CASE WHEN l_quantity > 1 THEN l_linenumber END AS l_linenumber, l_returnflag, l_extendedprice FROM lineitem),
        judged AS (SELECT *, concat_ws(', ', CASE WHEN l_linenumber IS NULL THEN 'key_present:l_linenumber' END,
                                         CASE WHEN l_returnflag NOT IN ('A', 'N') THEN 'domain:l_returnflag' END) AS failed FROM rows_)
        SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice, failed,
               CASE WHEN failed = '' THEN (SELECT count(*) FROM judged WHERE failed = '') ELSE (SELECT count(*) FROM judged WHERE failed <> '') END AS told
        FROM judged"""
)
def write_checked(t):
    """Passing rows in the table, failing ones beside it with what they fail, each with the number that the write told of its kind."""
    rows = t.lineitem.select("l_orderkey", F.when(F.col("l_quantity") > 1, F.col("l_linenumber")).cast("int").alias("l_linenumber"), "l_returnflag", "l_extendedprice")
    table = _table(t, "priced", PRICED)
    beside = f"{table}_rejected"
    path = scratch_path(t.spark, "rejected")
    t.spark.sql(f"CREATE TABLE {beside} (l_orderkey BIGINT, l_linenumber INT, l_returnflag STRING, l_extendedprice DOUBLE, failed_checks ARRAY<STRING>) USING parquet LOCATION '{path}'")
    told = tables.write_checked(rows, table, PRICED, beside)
    good = t.spark.table(table).select("*", F.lit("").alias("failed"), F.lit(told["rows"]).cast("long").alias("told"))
    bad = t.spark.table(beside).withColumn("failed", F.concat_ws(", ", "failed_checks")).drop("failed_checks").withColumn("told", F.lit(told["rejected"]).cast("long"))
    return good.unionByName(bad)


@query(
    f"""SELECT o_orderkey, CASE WHEN {MONTH} = DATE '1998-06-01' THEN 0 ELSE o_totalprice END AS o_totalprice, o_orderstatus,
              CAST({MONTH} AS VARCHAR) AS day FROM orders"""
)
def write_dynamic_overwrite(t):
    """A rerun of one snapshot replaces that snapshot only."""
    table = _table(t, "dynamic", DAILY)
    monthly = _monthly(t)
    tables.write_table(monthly, table, DAILY)
    rerun = S.exact(monthly, "1998-06-01", "day").withColumn("o_totalprice", F.lit(0.0))
    tables.write_table(rerun, table, DAILY)
    return t.spark.table(table)


@query(f"SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE {MONTH} = (SELECT max({MONTH}) FROM orders WHERE {MONTH} <= DATE '{RUN}')")
def read_last_partition(t):
    """The latest snapshot of a partitioned table, its date taken from the partition names."""
    table = _table(t, "partitions", DAILY)
    tables.write_table(_monthly(t), table, DAILY)
    return S.last_of_table(t.spark, table, RUN).drop("day")


@query(f"SELECT o_orderkey, o_totalprice, o_orderstatus, CAST({MONTH} AS VARCHAR) AS day FROM orders WHERE {MONTH} = DATE '1998-05-01'")
def month_end_of_table(t):
    """The last snapshot of the month before the run's, its date taken from the partition names."""
    table = _table(t, "partitions", DAILY)
    tables.write_table(_monthly(t), table, DAILY)
    return S.previous_month_end_of_table(t.spark, table, RUN)


# a line stands for as many numbers as its quantity says
WEIGHTED = "SELECT o_orderkey AS k, o_custkey % 4 AS weight FROM"


@query(f"SELECT k, weight, 1000 + coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS first FROM ({WEIGHTED} orders)")
def seq_weighted(t):
    """First numbers of rows that are fanned out later, from keys and weights alone."""
    return number_weighted(t.sql(f"{WEIGHTED} {{orders}}"), ["k"], "weight", 1000, partitions=6)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS day FROM orders WHERE o_orderstatus <> 'P'")
def write_parts(t):
    """Several frames into one table, an empty one among them."""
    table = _table(t, "parts", DAILY)
    parts = [_monthly(t).where(F.col("o_orderstatus") == s) for s in ("F", "none", "O")]
    tables.write_parts(parts, table, contract=DAILY)
    return t.spark.table(table)


@query("SELECT concat_ws('|', CAST(o_orderkey AS VARCHAR), o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE '' END) || chr(13) AS line FROM orders")
def write_text(t):
    path = scratch_path(t.spark, "text")
    note = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    files.write_text(t.orders.select("o_orderkey", "o_orderstatus", note.alias("note")), path)
    return t.spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"))


@query("SELECT user_id, event_type, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def write_parquet(t):
    path = scratch_path(t.spark, "parquet")
    rows = t.events.select("user_id", "event_type", "value", F.col("ts").cast("date").alias("day"))
    files.write_parquet(rows, path, ["day"])
    return t.spark.read.parquet(path)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def save_and_copy(t):
    """A table saved at a path, copied, and the copy checked row by row against it."""
    saved, copied = f"saved_{uuid.uuid4().hex[:12]}", f"copied_{uuid.uuid4().hex[:12]}"
    rows = t.orders.select("o_orderstatus", "o_orderkey", "o_totalprice")
    tables.save_table(rows, saved, scratch_path(t.spark, "saved"), ["o_orderstatus"], cut_lineage=True)
    tables.copy_table(t.spark, saved, copied, scratch_path(t.spark, "copied"))
    return t.spark.table(copied)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS day FROM orders")
def compact_table(t):
    table = _table(t, "compact", DAILY)
    tables.write_table(_monthly(t), table, DAILY, clustered=False)
    tables.compact(t.spark, table, scratch_path(t.spark, "compacted"), ["day", "o_orderkey"])
    return t.spark.table(table)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS day FROM orders")
def copy_in_place(t):
    """A table whose files were copied, checked and taken into use where they are now."""
    table = _table(t, "moved", DAILY)
    tables.write_table(_monthly(t), table, DAILY)
    tables.copy_in_place(t.spark, table, scratch_path(t.spark, "moved-to"))
    return t.spark.table(table)


@query(
    f"""SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS day
        FROM orders WHERE {MONTH} <> DATE '1998-06-01'"""
)
def write_empty_rerun(t):
    """A rerun without rows takes its partition away and leaves the others alone."""
    table = _table(t, "rerun", DAILY)
    monthly = _monthly(t)
    tables.write_table(monthly, table, DAILY)
    tables.write_table(monthly.where("o_orderkey < 0"), table, DAILY, replacing={"day": "1998-06-01"})
    return t.spark.table(table)


@query("SELECT count(*) AS written, count(*) AS stored FROM lineitem")
def write_with_metrics(t):
    """The row count comes with the write, without a second pass."""
    contract = C.TableContract.from_ddl("lines", "l_orderkey bigint, l_quantity double")
    table = _table(t, "metrics", contract)
    metrics = tables.write_with_metrics(t.lineitem, table, contract=contract)
    return t.spark.table(table).agg(F.lit(metrics["rows"]).alias("written"), F.count(F.lit(1)).alias("stored"))


VERSIONED = C.TableContract.from_ddl(
    "versioned",
    """bbn string, segment string, balance decimal(18,2), row_eff_start_date date, row_eff_end_date date, row_hash_value string,
    ctrl_create_user_id string, ctrl_create_ts timestamp, ctrl_last_update_user_id string, ctrl_last_update_ts timestamp,
    current_row_flag string""",
    keys=("bbn",),
    partitions=("current_row_flag",),
    write_ordered_by=("bbn",),
)


@query(MERGED)
def scd2_written(t):
    """The merge applied to a stored table: history is appended to, only current rows are rewritten."""
    table = _table(t, "versioned", VERSIONED)
    tables.write_table(_target(t), table, VERSIONED)
    held = S.where_all(t.spark.table(table), "current_row_flag = 'Y'")
    tables.write_scd2_step(scd.scd2_step(held, t.sql(SOURCE), ["bbn"], RUN, user=USER, now=NOW), table)
    return t.spark.table(table)


@query(MERGED)
def scd2_rerun_written(t):
    """A run that broke off after it had closed rows in the history, and was repeated."""
    table = _table(t, "versioned", VERSIONED)
    tables.write_table(_target(t), table, VERSIONED)
    held = S.where_all(t.spark.table(table), "current_row_flag = 'Y'")
    step = scd.scd2_step(held, t.sql(SOURCE), ["bbn"], RUN, user=USER, now=NOW)
    tables.write_table(step.where("scd_action = 'closed'").drop("scd_action"), table, mode="append")
    tables.write_scd2_step(step, table)
    return t.spark.table(table)


FLAT = C.TableContract.from_ddl(
    "flat",
    """bbn string, segment string, balance decimal(18,2), row_hash_value string, ctrl_create_user_id string, ctrl_create_ts timestamp,
    ctrl_last_update_user_id string, ctrl_last_update_ts timestamp""",
    keys=("bbn",),
)


@query(SCD1_MERGED)
def scd1_written(t):
    """The merge put in the place of the table that it read."""
    table = _table(t, "flat", FLAT)
    tables.write_table(_target(t).where("current_row_flag = 'Y'").drop(*scd.VERSION_COLUMNS), table, FLAT)
    tables.write_scd1(scd.scd1_merge(t.spark.table(table), t.sql(SOURCE), ["bbn"], user=USER, now=NOW), table)
    return t.spark.table(table).select("bbn", "balance", scd.HASH, scd.CREATE_USER, scd.UPDATE_USER, scd.UPDATE_TS)


SEGMENTED = C.TableContract.from_ddl(
    "segmented",
    """bbn string, balance decimal(18,2), row_hash_value string, ctrl_create_user_id string, ctrl_create_ts timestamp,
    ctrl_last_update_user_id string, ctrl_last_update_ts timestamp, segment string""",
    keys=("bbn",),
    partitions=("segment",),
)
# every BUILDING customer of an even nation moves to a segment of its own, all MACHINERY customers to none
MOVED = "CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey % 2 = 0 THEN 'A/B: c' WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END"
MOVING = f"SELECT CAST(c_custkey AS STRING) AS bbn, {MOVED} AS segment, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM {{customer}} WHERE c_nationkey <> 3"


@query(
    f"""SELECT bbn, segment, balance, CASE WHEN moved THEN '{USER}' ELSE 'loader' END AS ctrl_last_update_user_id, 'loader' AS ctrl_create_user_id
        FROM (SELECT CAST(c_custkey AS VARCHAR) AS bbn, CASE WHEN c_nationkey <> 3 THEN {MOVED} ELSE c_mktsegment END AS segment,
                CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance,
                c_nationkey <> 3 AND (c_nationkey = 11 OR c_mktsegment IS DISTINCT FROM {MOVED}) AS moved FROM customer)"""
)
def scd1_written_partitioned(t):
    """Customers change their segment, which is the partition: each is in the table once, whatever a segment's name holds."""
    table = _table(t, "segmented", SEGMENTED)
    tables.write_table(_target(t).where("current_row_flag = 'Y'").drop(*scd.VERSION_COLUMNS), table, SEGMENTED)
    changes = scd.scd1_changes(t.spark.table(table), t.sql(MOVING), ["bbn"], ["segment"], user=USER, now=NOW)
    tables.write_scd1_changes(changes, table, ["bbn"])
    return t.spark.table(table).select("bbn", "segment", "balance", scd.UPDATE_USER, scd.CREATE_USER)


BY_MONTH = C.TableContract.from_ddl(
    "by_month",
    """bbn string, segment string, balance decimal(18,2), row_eff_start_date date, row_eff_end_date date, row_hash_value string,
    ctrl_create_user_id string, ctrl_create_ts timestamp, ctrl_last_update_user_id string, ctrl_last_update_ts timestamp,
    current_row_flag string, row_eff_start_month date""",
    keys=("bbn",),
    partitions=("current_row_flag", "row_eff_start_month"),
    write_ordered_by=("bbn",),
)


def _merged_by_month(t) -> str:
    table = _table(t, "by_month", BY_MONTH)
    tables.write_table(V.with_start_month(_target(t)), table, BY_MONTH)
    held = V.current(t.spark.table(table)).drop(V.START_MONTH)
    tables.write_scd2_months(V.with_start_month(scd.scd2_step(held, t.sql(SOURCE), ["bbn"], RUN, user=USER, now=NOW)), table)
    return table


@query(MERGED)
def scd2_written_months(t):
    """The merge applied to a table partitioned by current flag and month of start: only months that lose or gain rows are written."""
    return t.spark.table(_merged_by_month(t)).drop(V.START_MONTH)


@query(f"WITH merged AS ({MERGED}) SELECT bbn, balance, current_row_flag FROM merged WHERE row_eff_start_date <= '1998-01-20' AND '1998-01-20' < row_eff_end_date")
def asof_months(t):
    """Versions valid on a day, from the months up to that day's."""
    return V.valid_in_months(t.spark.table(_merged_by_month(t)), "1998-01-20").select("bbn", "balance", "current_row_flag")


@query(f"WITH {STEP_CTES} SELECT {SHOWN}, scd_action FROM step")
def scd2_step_bucketed(t):
    """The step over current rows that are stored in buckets by key: only the source is shuffled."""
    table = f"bucketed_{uuid.uuid4().hex[:12]}"
    tables.save_bucketed(_target(t).where("current_row_flag = 'Y'"), table, scratch_path(t.spark, "bucketed"), ["bbn"], 8)
    return scd.scd2_step(t.spark.table(table), t.sql(SOURCE), ["bbn"], RUN, user=USER, now=NOW, buckets=8)


@query(f"WITH {STEP_CTES} SELECT {SHOWN} FROM step WHERE scd_action <> 'closed'")
def scd2_bucketed_written(t):
    """Current rows after the step, stored in buckets again without moving between them."""
    table = f"bucketed_{uuid.uuid4().hex[:12]}"
    tables.save_bucketed(_target(t).where("current_row_flag = 'Y'"), table, scratch_path(t.spark, "bucketed"), ["bbn"], 8)
    step = scd.scd2_step(t.spark.table(table), t.sql(SOURCE), ["bbn"], RUN, user=USER, now=NOW, buckets=8)
    now_current = step.where(F.col(scd.ACTION) != scd.CLOSED).drop(scd.ACTION)
    tables.replace_bucketed(now_current, table, scratch_path(t.spark, "bucketed"), ["bbn"], 8)
    return t.spark.table(table)


@query(
    """SELECT CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS day, count(*) AS "rows", 1 AS files, 1 AS fewer, 1 AS in_order
       FROM orders GROUP BY ALL"""
)
def compact_files(t):
    """What compaction leaves of a table written by many tasks: one sorted file a month, where there were several."""
    table = _table(t, "compact", DAILY)
    tables.write_table(_monthly(t), table, DAILY, clustered=False, tasks=4)
    before = settle(tables.file_stats(t.spark.table(table), ["day"], ["o_orderkey"]).groupBy("day").agg(F.count(F.lit(1)).alias("before")))
    tables.compact(t.spark, table, scratch_path(t.spark, "compacted"), ["o_orderkey"])
    at = Window.partitionBy("day", "file").orderBy("place")
    rows = t.spark.table(table).select(F.col("day").cast("string").alias("day"), "o_orderkey", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    rows = rows.withColumn("falls", F.coalesce(F.lag("o_orderkey").over(at) > F.col("o_orderkey"), F.lit(False)))
    found = rows.groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("file").alias("files"), (~F.max("falls")).alias("in_order"))
    # a single row stands in a single file, so a month that had one can't have fewer, but no more either
    fewer = F.greatest("before", F.lit(2)) > F.col("files")
    return found.join(before, "day").select("day", "rows", "files", fewer.alias("fewer"), "in_order")


# lines as two systems hold them: in some months one lacks a line, holds one twice, or has another quantity
OURS = "SELECT l_orderkey, l_linenumber, l_quantity, trunc(l_shipdate, 'month') AS month FROM {lineitem}"
THEIRS = """SELECT l_orderkey, l_linenumber, CASE WHEN month(l_shipdate) = 3 AND l_orderkey % 5 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
        trunc(l_shipdate, 'month') AS month FROM {lineitem} WHERE NOT (year(l_shipdate) = 1995 AND l_linenumber = 2)
    UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, trunc(l_shipdate, 'month') FROM {lineitem} WHERE year(l_shipdate) = 1996 AND l_linenumber = 1"""
HELD_SQL = """ours AS (SELECT l_orderkey, l_linenumber, l_quantity, date_trunc('month', l_shipdate)::DATE AS month FROM lineitem),
    theirs AS (SELECT l_orderkey, l_linenumber, CASE WHEN month(l_shipdate) = 3 AND l_orderkey % 5 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
            date_trunc('month', l_shipdate)::DATE AS month FROM lineitem WHERE NOT (year(l_shipdate) = 1995 AND l_linenumber = 2)
        UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, date_trunc('month', l_shipdate)::DATE FROM lineitem
        WHERE year(l_shipdate) = 1996 AND l_linenumber = 1)"""
DIFFERENCE_SQL = f"""WITH {HELD_SQL}
    SELECT l_orderkey, l_linenumber, l_quantity, CAST(month AS VARCHAR) AS month, CASE WHEN sum(n) > 0 THEN 'left_only' ELSE 'right_only' END AS side,
           CAST(abs(sum(n)) AS BIGINT) AS copies
    FROM (SELECT *, 1 AS n FROM ours UNION ALL SELECT *, -1 FROM theirs) GROUP BY l_orderkey, l_linenumber, l_quantity, month HAVING sum(n) <> 0"""


@query(DIFFERENCE_SQL)
def reconcile_digest(t):
    """Differences of two tables by month: months whose digests agree are not compared row by row."""
    return reconcile.difference_by_digest(t.sql(OURS), t.sql(THEIRS), ["month"])


@query(DIFFERENCE_SQL)
def reconcile_digest_groups(t):
    """The same without a column to go by: rows are dealt to groups by a hash."""
    return reconcile.difference_by_digest(t.sql(OURS), t.sql(THEIRS))


@query(f"WITH {HELD_SQL} SELECT month::VARCHAR AS month FROM (SELECT DISTINCT month FROM ({DIFFERENCE_SQL.split(HELD_SQL)[1].strip()}))")
def reconcile_months(t):
    """The months that differ, from digests alone."""
    found = reconcile.differing_groups(t.sql(OURS), t.sql(THEIRS), ["month"])
    return t.spark.createDataFrame(found, "month date")


@query("SELECT l_orderkey, l_quantity, l_returnflag FROM lineitem")
def delimited_table(t):
    """Rows through a table over pipe-delimited text."""
    contract = C.TableContract.from_ddl("lines", "l_orderkey bigint, l_quantity double, l_returnflag string")
    table = f"delimited_{uuid.uuid4().hex[:12]}"
    tables.create_delimited_table(t.spark, table, contract, scratch_path(t.spark, "delimited"))
    tables.write_table(t.lineitem, table, contract, clustered=False)
    return t.spark.table(table)
