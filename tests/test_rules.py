import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daymark.operators import rules
from daymark.plans.contracts import STAGING_BASE
from daymark.plans.rulesets import AL_PTB, RULESETS, STAFF_ACCOUNT_NAMES

TEXTS = ["High", "high", " High ", "low", "", "  ", None]


def passing(spark, tree, values=TEXTS, data_type="string"):
    rows = spark.createDataFrame([(v,) for v in values], f"x {data_type}")
    return [r["x"] for r in rules.apply_rules(rows, tree).collect()]


def leaf(operator, value=None):
    return {"rules": [{"field": "x", "operator": operator, "value": value}]}


@pytest.mark.parametrize(
    ("operator", "value", "expected"),
    [
        ("=", "High", ["High"]),
        ("!=", "High", ["high", " High ", "low", "", "  "]),
        ("= (TRIM)", "High", ["High", " High "]),
        ("!= (TRIM)", "High", ["high", "low", "", "  "]),
        ("= (IGNORE CASE)", "hIGH", ["High", "high"]),
        ("!= (IGNORE CASE)", "hIGH", [" High ", "low", "", "  "]),
        ("= (IGNORE CASE TRIM)", "hIGH", ["High", "high", " High "]),
        ("!= (IGNORE CASE TRIM)", "hIGH", ["low", "", "  "]),
        ("IN", ["High", "low"], ["High", "low"]),
        ("NOT IN", ["High", "low"], ["high", " High ", "", "  "]),
        (">", "High", ["high", "low"]),
        (">=", "High", ["High", "high", "low"]),
        ("<", "High", [" High ", "", "  "]),
        ("<=", "High", ["High", " High ", "", "  "]),
        ("IS NULL", None, [None]),
        ("IS NOT NULL", None, ["High", "high", " High ", "low", "", "  "]),
        ("IS BLANK", None, ["", "  ", None]),
        ("IS NOT BLANK", None, ["High", "high", " High ", "low"]),
        ("BETWEEN", ["H", "I"], ["High"]),
        ("LIKE", "%ig%", ["High", "high", " High "]),
        ("NOT LIKE", "%ig%", ["low", "", "  "]),
        ("RLIKE", r"^H\w+$", ["High"]),
        ("NOT RLIKE", r"^H\w+$", ["high", " High ", "low", "", "  "]),
        ("RLIKE (IGNORE CASE)", r"^h\w+$", ["High", "high"]),
        ("NOT RLIKE (IGNORE CASE)", r"^h\w+$", [" High ", "low", "", "  "]),
    ],
)
def test_every_operator(spark, operator, value, expected):
    tree = leaf(operator, value)
    assert passing(spark, tree) == expected
    rows = spark.createDataFrame([(v,) for v in TEXTS], "x string")
    assert [r["x"] for r in rows.where(rules.to_sql(tree)).collect()] == expected


def test_all_operators_are_covered():
    assert len(rules.OPERATORS) == 25


def test_errors_and_switches(spark):
    with pytest.raises(ValueError, match="unsupported operator"):
        passing(spark, leaf("~"))
    with pytest.raises(ValueError, match="unsupported operator"):
        rules.to_sql(leaf("~"))
    with pytest.raises(ValueError, match="group logic"):
        rules.compile_rules({"logic": "XOR", "rules": [{"field": "x", "operator": "IS NULL"}]})
    for run in (rules.predicate, rules.to_sql):
        with pytest.raises(rules.RulesDisabledError):
            run({"enabled": False, "rules": []})
    assert passing(spark, {"rules": []}) == TEXTS
    assert rules.to_sql({"rules": [{"logic": "OR", "rules": []}]}) == "TRUE"


def test_escaped_patterns():
    text = json.dumps(leaf("RLIKE", r"EMP NO\\."))
    assert rules.load_rules(text, sql_escaped=True)["rules"][0]["value"] == r"EMP NO\."
    assert rules.load_rules(text)["rules"][0]["value"] == r"EMP NO\\."


@pytest.mark.parametrize("name", RULESETS)
def test_shipped_rules_compile(spark, name):
    base = spark.createDataFrame([], STAGING_BASE.struct_type).alias("base")
    assert rules.apply_rules(base, RULESETS[name]).count() == 0
    assert base.where(rules.to_sql(RULESETS[name])).count() == 0


def test_staff_accounts_are_left_out(one):
    names = ["ACME EMPLOYEES OF 2020", "acme emp no. 7", "Emp-7 Fund", "Emperor Cruz", "Ana Cruz"]
    hit = rules.condition({"field": "x", "operator": "NOT RLIKE (IGNORE CASE)", "value": STAFF_ACCOUNT_NAMES})
    assert one(names, hit) == [False, False, False, True, True]
    assert AL_PTB["rules"][-1]["value"] == STAFF_ACCOUNT_NAMES


LEAVES = st.one_of(
    st.builds(lambda o, v: {"field": "n", "operator": o, "value": v}, st.sampled_from(["=", "!=", ">", ">=", "<", "<="]), st.integers(-3, 3)),
    st.builds(lambda o, v: {"field": "n", "operator": o, "value": v}, st.sampled_from(["IN", "NOT IN"]), st.lists(st.integers(-3, 3), min_size=1, max_size=3)),
    st.builds(lambda a, b: {"field": "n", "operator": "BETWEEN", "value": [a, b]}, st.integers(-3, 3), st.integers(-3, 3)),
    st.builds(lambda o: {"field": "s", "operator": o}, st.sampled_from(["IS NULL", "IS NOT NULL", "IS BLANK", "IS NOT BLANK"])),
    st.builds(lambda o, v: {"field": "s", "operator": o, "value": v}, st.sampled_from(["=", "!= (IGNORE CASE TRIM)", "LIKE", "NOT LIKE"]), st.sampled_from(["a", "%'b%", "\\\\", "it's"])),
    st.builds(lambda v: {"field": "n", "operator": "=", "value": v, "enabled": False}, st.integers(0, 3)),
)
TREES = st.recursive(LEAVES, lambda inner: st.builds(lambda l, r: {"logic": l, "rules": r}, st.sampled_from(["AND", "OR"]), st.lists(inner, max_size=4)), max_leaves=10)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TREES)
def test_column_and_sql_text_agree(spark, tree):
    tree = {"rules": [tree]}
    data = [(n, s) for n in (None, -2, 0, 1, 3) for s in (None, "", " ", "a", "A ", "it's", "x'b", "\\")]
    rows = spark.createDataFrame(data, "n int, s string")
    both = rows.select(
        F.coalesce(rules.predicate(tree), F.lit(False)).alias("c"), F.coalesce(F.expr(rules.to_sql(tree)), F.lit(False)).alias("t")
    )
    assert both.where("c <> t").count() == 0
