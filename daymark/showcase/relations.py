"""Rules, joins, roll-ups, dedup, numbering and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from daymark.functions import codes
from daymark.functions.bounds import day
from daymark.functions.pricing import AUTO_RATES
from daymark.operators import dedup, joins, reconcile, rollups
from daymark.operators.rules import OPERATORS, RulesDisabledError, apply_rules, condition, predicate, to_sql
from daymark.operators.sequence import number_rows
from daymark.showcase import fixed
from daymark.showcase.registry import query
from daymark.showcase.roles import RUN
from daymark.sources.snapshots import latest_date

# --- rules ----------------------------------------------------------------------------------------

FLAT = {
    "enabled": True,
    "rules": [
        {"field": "o_totalprice", "operator": "BETWEEN", "value": [100000, 300000]},
        {"field": "o_orderpriority", "operator": "IN", "value": ["1-URGENT", "2-HIGH"]},
        {"field": "c_mktsegment", "operator": "!= (IGNORE CASE TRIM)", "value": "building"},
        {"field": "c_name", "operator": "IS NOT BLANK"},
    ],
}
NESTED = {
    "logic": "OR",
    "rules": [
        {
            "logic": "AND",
            "rules": [
                {"field": "o_orderstatus", "operator": "=", "value": "F"},
                {
                    "logic": "OR",
                    "rules": [
                        {"field": "c_acctbal", "operator": "<", "value": 0},
                        {"field": "o_totalprice", "operator": ">=", "value": 450000},
                    ],
                },
            ],
        },
        {"field": "base.c_name", "operator": "RLIKE (IGNORE CASE)", "value": r"customer#0+1\d$"},
        {"enabled": False, "field": "no_such_column", "operator": "IS NULL"},
        {"enabled": False, "logic": "AND", "rules": [{"field": "gone", "operator": "="}]},
    ],
}
ORDERS_CUSTOMERS = "FROM orders JOIN customer ON o_custkey = c_custkey"


def _orders_customers(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))


@query(
    f"""SELECT o_orderkey, c_custkey {ORDERS_CUSTOMERS}
        WHERE o_totalprice BETWEEN 100000 AND 300000 AND o_orderpriority IN ('1-URGENT', '2-HIGH')
          AND c_mktsegment <> 'BUILDING' AND trim(c_name) <> ''"""
)
def rules_flat(t):
    return apply_rules(_orders_customers(t), FLAT).select("o_orderkey", "c_custkey")


NESTED_SQL = f"""SELECT o_orderkey, c_custkey {ORDERS_CUSTOMERS}
    WHERE (o_orderstatus = 'F' AND (c_acctbal < 0 OR o_totalprice >= 450000))
       OR regexp_matches(c_name, '(?i)customer#0+1[0-9]$')"""


@query(NESTED_SQL)
def rules_nested(t):
    return apply_rules(_orders_customers(t).alias("base"), NESTED).select("o_orderkey", "c_custkey")


@query(NESTED_SQL)
def rules_as_sql_text(t):
    """The same tree as text inside a SQL statement."""
    rows = _orders_customers(t)
    return t.spark.sql(f"SELECT o_orderkey, c_custkey FROM {{rows}} AS base WHERE {to_sql(NESTED)}", rows=rows)


# one rule per operator, over a text with case, blanks and NULLs
MATRIX_VALUES = {
    "=": "High", "!=": "High", "= (TRIM)": "High", "!= (TRIM)": "High",
    "= (IGNORE CASE)": "high", "!= (IGNORE CASE)": "high",
    "= (IGNORE CASE TRIM)": "high", "!= (IGNORE CASE TRIM)": "high",
    "IN": ["High", "low"], "NOT IN": ["High", "low"], ">": "High", ">=": "High", "<": "High", "<=": "High",
    "IS NULL": None, "IS NOT NULL": None, "IS BLANK": None, "IS NOT BLANK": None, "BETWEEN": ["A", "I"],
    "LIKE": "%ig%", "NOT LIKE": "%ig%", "RLIKE": r"^H\w+$", "NOT RLIKE": r"^H\w+$",
    "RLIKE (IGNORE CASE)": r"^\s*h\w+\s*$", "NOT RLIKE (IGNORE CASE)": r"^\s*h\w+\s*$",
}
MATRIX_SQL = {
    "=": "x = 'High'", "!=": "x <> 'High'", "= (TRIM)": "trim(x) = 'High'", "!= (TRIM)": "trim(x) <> 'High'",
    "= (IGNORE CASE)": "upper(x) = 'HIGH'", "!= (IGNORE CASE)": "upper(x) <> 'HIGH'",
    "= (IGNORE CASE TRIM)": "upper(trim(x)) = 'HIGH'", "!= (IGNORE CASE TRIM)": "upper(trim(x)) <> 'HIGH'",
    "IN": "x IN ('High', 'low')", "NOT IN": "x NOT IN ('High', 'low')", ">": "x > 'High'", ">=": "x >= 'High'",
    "<": "x < 'High'", "<=": "x <= 'High'", "IS NULL": "x IS NULL", "IS NOT NULL": "x IS NOT NULL",
    "IS BLANK": "x IS NULL OR trim(x) = ''", "IS NOT BLANK": "x IS NOT NULL AND trim(x) <> ''",
    "BETWEEN": "x BETWEEN 'A' AND 'I'", "LIKE": "x LIKE '%ig%'", "NOT LIKE": "x NOT LIKE '%ig%'",
    "RLIKE": "regexp_matches(x, '^H\\w+$')", "NOT RLIKE": "NOT regexp_matches(x, '^H\\w+$')",
    "RLIKE (IGNORE CASE)": "regexp_matches(x, '(?i)^\\s*h\\w+\\s*$')",
    "NOT RLIKE (IGNORE CASE)": "NOT regexp_matches(x, '(?i)^\\s*h\\w+\\s*$')",
}
MATRIX_INPUT = """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 'High'
           WHEN '3-MEDIUM' THEN CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN '  ' ELSE 'medium' END
           WHEN '4-NOT SPECIFIED' THEN ' High ' ELSE CASE o_orderstatus WHEN 'F' THEN 'HIGH' ELSE 'low' END END AS x
    FROM {orders}"""


def _flag_name(operator: str) -> str:
    return f"op_{OPERATORS.index(operator):02d}"


@query(
    "SELECT o_orderkey, "
    + ", ".join(f"CAST({MATRIX_SQL[o]} AS INTEGER) AS {_flag_name(o)}" for o in OPERATORS)
    + f" FROM ({MATRIX_INPUT.replace('{orders}', 'orders')})"
)
def rules_operator_matrix(t):
    flags = [
        condition({"field": "x", "operator": o, "value": MATRIX_VALUES[o]}).cast("int").alias(_flag_name(o))
        for o in OPERATORS
    ]
    return t.sql(MATRIX_INPUT).select("o_orderkey", *flags)


@query("SELECT o_orderkey FROM orders")
def rules_empty(t):
    """No active rule: every row passes."""
    tree = {"rules": [{"enabled": False, "field": "o_orderkey", "operator": "IS NULL"}]}
    return apply_rules(t.orders, tree).select("o_orderkey")


@query("SELECT o_orderkey, 'refused' AS outcome FROM orders")
def rules_disabled(t):
    """A rule set that is switched off must not let rows through."""
    try:
        predicate({"enabled": False, "rules": []})
        outcome = "passed"
    except RulesDisabledError:
        outcome = "refused"
    return t.orders.select("o_orderkey", F.lit(outcome).alias("outcome"))


@query("SELECT c_custkey FROM customer WHERE c_nationkey IN (0, 3)")
def rules_mixed_list(t):
    """A list that mixes numbers and texts, on a number column."""
    return apply_rules(
        t.customer, {"rules": [{"field": "c_nationkey", "operator": "IN", "value": [0, "3"]}]}
    ).select("c_custkey")


# --- joins ------------------------------------------------------------------------------------------


@query(
    """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey"""
)
def enrich_left(t):
    nations = t.nation.where("n_regionkey <> 2").withColumnRenamed("n_nationkey", "c_nationkey")
    joined = joins.enrich(t.customer, nations, ["c_nationkey"])
    regions = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    return joins.enrich(joined, regions, ["n_regionkey"]).select("c_custkey", "n_name", "r_name")


@query(
    """SELECT c_custkey, s_name FROM customer LEFT JOIN (SELECT s_nationkey, min(s_name) AS s_name FROM supplier GROUP BY 1)
       ON c_nationkey = s_nationkey"""
)
def enrich_without_fan_out(t):
    """Many suppliers per nation, still one row per customer."""
    suppliers = t.supplier.select(F.col("s_nationkey").alias("c_nationkey"), "s_name")
    return joins.enrich(t.customer, suppliers, ["c_nationkey"]).select("c_custkey", "s_name")


@query(
    """SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, r.rows_per_line
       FROM lineitem l LEFT JOIN (SELECT l_orderkey, l_linenumber, count(*) AS rows_per_line FROM lineitem
                                  WHERE l_returnflag = 'R' GROUP BY 1, 2) r
       ON l.l_orderkey = r.l_orderkey AND l.l_linenumber = r.l_linenumber"""
)
def enrich_composite_key(t):
    returned = t.lineitem.where("l_returnflag = 'R'").groupBy("l_orderkey", "l_linenumber")
    right = returned.agg(F.count(F.lit(1)).alias("rows_per_line"))
    joined = joins.enrich(t.lineitem, right, ["l_orderkey", "l_linenumber"], one_per_key=False)
    return joined.select("l_orderkey", "l_linenumber", "l_quantity", "rows_per_line")


@query("SELECT o_orderkey, scai97 AS flag FROM orders JOIN scpf ON '7' || o_orderkey || '01' = trim(scab) || trim(scan) || trim(scas)", roles=("scpf",))
def join_computed_key(t):
    right = t.role("scpf").select(joins.joined_key("scab", "scan", "scas").alias("account"), F.col("scai97").alias("flag"))
    left = t.orders.select("o_orderkey", F.concat(F.lit("7"), F.col("o_orderkey").cast("string"), F.lit("01")).alias("account"))
    return left.join(right, "account").select("o_orderkey", "flag")


@query(
    """SELECT a.bbnumber, a.accountnumber, c.card_generalstatus_code AS status
       FROM (SELECT DISTINCT bbnumber, accountnumber, credit_card_card_no FROM df_customer_account) a
       LEFT JOIN df_cards_accounts c ON a.credit_card_card_no = c.card_number""",
    roles=("df_customer_account", "df_cards_accounts"),
)
def join_mostly_missing_key(t):
    """Most accounts have no card; their rows must not meet in one task."""
    left = t.role("df_customer_account").select("bbnumber", "accountnumber", F.col("credit_card_card_no").alias("card")).distinct()
    right = t.role("df_cards_accounts").select(F.col("card_number").alias("card"), F.col("card_generalstatus_code").alias("status"))
    return joins.enrich_known(left, right, "card", ["bbnumber", "accountnumber"]).select("bbnumber", "accountnumber", "status")


@query("SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def join_inner(t):
    return _orders_customers(t).where("c_acctbal > 0").select("o_orderkey", "c_mktsegment")


URGENT = "o_orderpriority = '1-URGENT' AND o_totalprice > 250000"


@query(f"SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND {URGENT})")
def anti_not_exists(t):
    held = t.orders.where(URGENT).select(F.col("o_custkey").alias("c_custkey"))
    return joins.exclude(t.customer, held, ["c_custkey"]).select("c_custkey")


@query(f"SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE {URGENT}) ON o_custkey = c_custkey WHERE o_custkey IS NULL")
def anti_left_null(t):
    held = t.orders.where(URGENT).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(held, "c_custkey", "left_anti")


@query(
    f"""SELECT c_custkey FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (
            SELECT bbn FROM prior_offers WHERE expiry_date > DATE '{RUN}' AND actual_date < DATE '{RUN}')""",
    roles=("prior_offers",),
)
def anti_active_window(t):
    customers = t.customer.select("c_custkey", F.col("c_custkey").cast("string").alias("bbn"))
    return joins.exclude_active(customers, t.role("prior_offers"), RUN, include_run_date=False).select("c_custkey")


@query(f"SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND {URGENT})")
def semi_exists(t):
    held = t.orders.where(URGENT).select(F.col("o_custkey").alias("c_custkey"))
    return joins.require(t.customer, held, ["c_custkey"]).select("c_custkey")


@query(
    "SELECT c_custkey, al_ratecode, term, CAST(rate_factor AS DOUBLE) AS rate_factor FROM customer CROSS JOIN (VALUES "
    + fixed.AUTO_RATES
    + ") AS rates(al_ratecode, term, rate_factor)"
)
def rate_fan_out(t):
    rates = [{"al_ratecode": c, "term": n, "rate_factor": f} for c, n, f in AUTO_RATES]
    return joins.fan_out(t.customer.select("c_custkey"), rates)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(CAST(o_totalprice AS DECIMAL(18,2))) * 1.5 FROM orders)")
def scalar_subquery(t):
    """A one-value relation used in a predicate, without a join."""
    mean = t.orders.agg((F.avg(F.col("o_totalprice").cast("decimal(18,2)")) * 1.5).alias("mean")).scalar()
    return t.orders.where(F.col("o_totalprice") > mean).select("o_orderkey", "o_totalprice")


@query("""SELECT event_id FROM events a WHERE EXISTS (SELECT 1 FROM events b WHERE a.user_id = b.user_id
          AND a.event_type = b.event_type AND CAST(a.ts AS DATE) + 1 = CAST(b.ts AS DATE))""")
def semi_adjacent(t):
    """Rows whose key and kind occur again on the following day: existence only, no pairs."""
    keys = ["user_id", "event_type", "d"]
    left = t.events.select("event_id", "user_id", "event_type", F.date_add(F.col("ts").cast("date"), 1).alias("d"))
    right = t.events.select("user_id", "event_type", F.col("ts").cast("date").alias("d"))
    return joins.require(left, right, keys).select("event_id")


# --- roll-ups ---------------------------------------------------------------------------------------


@query(
    """SELECT o_custkey, CASE WHEN sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS any_f,
              CASE WHEN sum(CASE WHEN o_totalprice > 490000 THEN 1 ELSE 0 END) > 0 THEN 1 ELSE 0 END AS any_large
       FROM orders GROUP BY 1"""
)
def any_flags(t):
    conditions = {"any_f": F.col("o_orderstatus") == "F", "any_large": F.col("o_totalprice") > 490000}
    return rollups.any_flags(t.orders, ["o_custkey"], conditions)


@query(
    """SELECT c_nationkey, max(coalesce(any_f, 0)) AS any_f FROM customer LEFT JOIN (
           SELECT o_custkey, max(CASE WHEN o_totalprice > 499000 THEN 1 ELSE 0 END) AS any_f FROM orders WHERE o_orderstatus = 'F'
           GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1"""
)
def flag_rollup(t):
    per_customer = rollups.any_flags(
        t.orders.where("o_orderstatus = 'F'"), ["o_custkey"], {"any_f": F.col("o_totalprice") > 499000}
    ).withColumnRenamed("o_custkey", "c_custkey")
    return rollups.roll_up_flags(t.customer.join(per_customer, "c_custkey", "left"), ["c_nationkey"], ["any_f"])


@query("SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey")
def distinct_keys(t):
    return dedup.distinct_keys(t.orders.where("o_orderstatus = 'O'"), ["o_custkey"])


@query("SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(t):
    return t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()


@query(
    """SELECT l_orderkey, CAST(round(avg(CAST(l_extendedprice AS DECIMAL(18,2))), 4) AS DOUBLE) AS balance FROM lineitem
       WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-06-01' GROUP BY 1"""
)
def average_in_window(t):
    lines = t.lineitem.select(
        "l_orderkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.col("l_shipdate").cast("date").alias("d")
    )
    averaged = rollups.average_between(lines, ["l_orderkey"], "price", "d", day("1998-03-01"), day("1998-06-01"), "balance")
    return averaged.select("l_orderkey", F.round("balance", 4).cast("double").alias("balance"))


@query("SELECT o_custkey, max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS largest_open FROM orders GROUP BY 1")
def max_per_key(t):
    return t.orders.groupBy("o_custkey").agg(
        rollups.max_where("o_totalprice", F.col("o_orderstatus") == "O").alias("largest_open")
    )


@query(
    """SELECT user_id, max(CASE WHEN event_type = 'click' THEN value END) AS click, max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
              max(CASE WHEN event_type = 'view' AND value < 20 THEN value END) AS small_view FROM events GROUP BY 1"""
)
def pivot_max(t):
    kind = F.col("event_type")
    picks = {"click": kind == "click", "purchase": kind == "purchase", "small_view": (kind == "view") & (F.col("value") < 20)}
    return rollups.pivot_max(t.events, ["user_id"], "value", picks)


@query(
    """SELECT o_custkey, coalesce(max(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN o_orderkey END),
              max(CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN o_orderkey END),
              max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END)) AS pick FROM orders GROUP BY 1"""
)
def priority_coalesce(t):
    urgent, high, open_ = (F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH", F.col("o_orderstatus") == "P")
    key = "o_orderkey"
    pick = rollups.first_present(
        rollups.max_where(key, urgent & open_), rollups.max_where(key, high & open_), rollups.max_where(key, urgent)
    )
    return t.orders.groupBy("o_custkey").agg(pick.alias("pick"))


@query(
    """SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS total_f FROM orders GROUP BY 1"""
)
def filtered_sum(t):
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    return t.orders.groupBy("o_custkey").agg(rollups.sum_where(amount, F.col("o_orderstatus") == "F").alias("total_f"))


@query(
    """SELECT o_custkey, CAST(CAST(max(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(o_orderdate AS DATE) END) AS DATE) AS VARCHAR) AS latest
       FROM orders GROUP BY 1"""
)
def latest_conditional_date(t):
    when = F.col("o_orderdate").cast("date")
    wanted = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return t.orders.groupBy("o_custkey").agg(rollups.max_where(when, wanted).alias("latest"))


@query("SELECT coalesce(max(CASE WHEN o_orderdate > DATE '2050-01-01' THEN o_orderkey END), 0) AS none, max(o_orderkey) AS top FROM orders")
def global_max_default(t):
    none = rollups.max_where("o_orderkey", F.col("o_orderdate") > F.lit("2050-01-01").cast("timestamp_ntz"))
    return t.orders.agg(F.coalesce(none, F.lit(0)).alias("none"), F.max("o_orderkey").alias("top"))


# --- dedup ------------------------------------------------------------------------------------------


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
       FROM orders) WHERE rn = 1"""
)
def dedup_latest(t):
    best = dedup.first_per_key(t.orders, ["o_custkey"], [F.col("o_totalprice").desc(), "o_orderkey"])
    return best.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
       FROM lineitem) WHERE rn = 1"""
)
def dedup_no_order(t):
    """No order is stated: the smallest row wins, so reruns agree."""
    return dedup.any_per_key(t.lineitem, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_keys(t):
    return dedup.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


# --- numbering ----------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS sequence FROM lineitem")
def seq_global(t):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return number_rows(t.lineitem.select(*order), order).select("l_orderkey", "l_linenumber", "l_partkey", "sequence")


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS bbn, 'ALPTB0698B' || lpad(CAST(row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR))
              + (SELECT coalesce(max(CAST(right(offer_code, 7) AS INTEGER)), 0) FROM prior_offers
                 WHERE offer_code LIKE 'ALPTB0698%') AS VARCHAR), 7, '0') AS offer_code
       FROM customer""",
    roles=("prior_offers",),
)
def seq_continue(t):
    """Codes go on after the highest one of the month."""
    own = t.role("prior_offers").where("offer_code LIKE 'ALPTB%'")
    customers = t.customer.select(F.col("c_custkey").cast("string").alias("bbn"))
    numbered = number_rows(customers, ["bbn"], codes.last_sequence(own, RUN))
    return numbered.select("bbn", codes.build_code("AL", "PTB", RUN, "sequence").alias("offer_code"))


# --- set operations and reconciliation ------------------------------------------------------------------


@query(f"""SELECT o_custkey, o_orderstatus FROM orders WHERE {URGENT} UNION SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 400000""")
def union_distinct(t):
    columns = ["o_custkey", "o_orderstatus"]
    return t.orders.where(URGENT).select(*columns).unionByName(t.orders.where("o_totalprice > 400000").select(*columns)).distinct()


CHANGED = """SELECT o_custkey, CASE WHEN o_totalprice > 450000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority
    FROM {orders} WHERE o_totalprice > 5000"""
CHANGED_SQL = CHANGED.replace("{orders}", "orders")
COUNTED = """SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS n FROM ({}) GROUP BY ALL"""


@query(
    f"""SELECT * EXCLUDE (n), CASE WHEN n > 0 THEN 'left_only' ELSE 'right_only' END AS side, CAST(abs(n) AS BIGINT) AS copies
        FROM (SELECT o_custkey, o_orderstatus, o_orderpriority, sum(n) AS n
              FROM (SELECT o_custkey, o_orderstatus, o_orderpriority, 1 AS n FROM orders UNION ALL
                    SELECT o_custkey, o_orderstatus, o_orderpriority, -1 AS n FROM ({CHANGED_SQL})) GROUP BY 1, 2, 3)
        WHERE n <> 0"""
)
def reconcile_diff(t):
    return reconcile.difference(t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority"), t.sql(CHANGED))


@query(
    f"""(SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders EXCEPT ALL {CHANGED_SQL})
        UNION ALL ({CHANGED_SQL} EXCEPT ALL SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders)"""
)
def reconcile_rows(t):
    return reconcile.difference_rows(t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority"), t.sql(CHANGED))


@query("SELECT count(*) AS compared, 0 AS differing FROM lineitem")
def reconcile_equal(t):
    """A table and a shuffled copy of itself."""
    copy = t.lineitem.repartition(5, "l_partkey")
    differing = reconcile.difference(t.lineitem, copy).agg(F.coalesce(F.sum("copies"), F.lit(0)).cast("int").alias("n")).scalar()
    return t.lineitem.agg(F.count(F.lit(1)).alias("compared")).withColumn("differing", differing)


@query("SELECT CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS snapshot, count(*) AS orders FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1998-06-15'")
def latest_snapshot_date(t):
    daily = t.orders.withColumn("actual_date", F.col("o_orderdate").cast("date"))
    found = latest_date(daily, RUN)
    return daily.where(F.col("actual_date") <= day(RUN)).agg(
        F.lit(str(found)).alias("snapshot"), F.count(F.lit(1)).alias("orders")
    )
