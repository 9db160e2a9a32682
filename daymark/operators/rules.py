"""JSON rule trees as filter predicates.

A tree is ``{"enabled": true, "logic": "AND", "rules": [leaf | group, ...]}``; a leaf is
``{"field", "operator", "value"}``. A tree compiles either to a Column or to the text of the same
predicate for use inside a SQL statement. Comparisons keep SQL's three-valued logic.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from decimal import Decimal
from functools import reduce
from operator import and_, or_
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tree = Mapping[str, Any]


class RulesDisabledError(RuntimeError):
    """A whole rule set is switched off; going on would publish unfiltered rows."""


def _contains(column: Column, values: list) -> Column:
    return column.isin(*values)


def _like(column: Column, pattern: str) -> Column:
    return column.like(pattern)


def _rlike(column: Column, pattern: str) -> Column:
    return column.rlike(pattern)


def _rlike_any_case(column: Column, pattern: str) -> Column:
    return column.rlike(f"(?i){pattern}")


def _is_blank(column: Column, _: Any) -> Column:
    return column.isNull() | (F.trim(column) == "")


def _plain(column: Column) -> Column:
    return column


def _upper(column: Column) -> Column:
    return F.upper(column)


def _trim(column: Column) -> Column:
    return F.trim(column)


def _upper_trim(column: Column) -> Column:
    return F.upper(F.trim(column))


def _equals(view: Callable[[Column], Column], any_case: bool) -> Callable[[Column, Any], Column]:
    return lambda column, value: view(column) == (value.upper() if any_case else value)


# Conditions by operator; "NOT x" and "!=" forms below are the negation of one of these.
POSITIVE: dict[str, Callable[[Column, Any], Column]] = {
    "=": _equals(_plain, any_case=False),
    "= (TRIM)": _equals(_trim, any_case=False),
    "= (IGNORE CASE)": _equals(_upper, any_case=True),
    "= (IGNORE CASE TRIM)": _equals(_upper_trim, any_case=True),
    "IN": _contains,
    ">": lambda column, value: column > value,
    ">=": lambda column, value: column >= value,
    "<": lambda column, value: column < value,
    "<=": lambda column, value: column <= value,
    "IS NULL": lambda column, _: column.isNull(),
    "IS BLANK": _is_blank,
    "BETWEEN": lambda column, value: column.between(value[0], value[1]),
    "LIKE": _like,
    "RLIKE": _rlike,
    "RLIKE (IGNORE CASE)": _rlike_any_case,
}
NEGATED: dict[str, str] = {
    "!=": "=",
    "!= (TRIM)": "= (TRIM)",
    "!= (IGNORE CASE)": "= (IGNORE CASE)",
    "!= (IGNORE CASE TRIM)": "= (IGNORE CASE TRIM)",
    "NOT IN": "IN",
    "IS NOT NULL": "IS NULL",
    "IS NOT BLANK": "IS BLANK",
    "NOT LIKE": "LIKE",
    "NOT RLIKE": "RLIKE",
    "NOT RLIKE (IGNORE CASE)": "RLIKE (IGNORE CASE)",
}
OPERATORS = tuple([*POSITIVE, *NEGATED])


def _unsupported(rule: Tree) -> ValueError:
    return ValueError(f"unsupported operator {rule['operator']!r} for field {rule['field']!r}")


def condition(rule: Tree) -> Column:
    """One leaf as a Column."""
    name, column, value = rule["operator"], F.col(rule["field"]), rule.get("value")
    if name in NEGATED:
        return ~POSITIVE[NEGATED[name]](column, value)
    if name in POSITIVE:
        return POSITIVE[name](column, value)
    raise _unsupported(rule)


def _active(tree: Tree) -> list[Tree]:
    return [item for item in tree.get("rules", []) if item.get("enabled", True)]


def _logic(tree: Tree) -> str:
    name = tree.get("logic", "AND").upper()
    if name not in ("AND", "OR"):
        raise ValueError(f"unsupported group logic {name!r}, expected AND or OR")
    return name


def compile_rules(tree: Tree) -> Column | None:
    """A group as a Column; None when no rule in it is active."""
    parts = [compile_rules(item) if "rules" in item else condition(item) for item in _active(tree)]
    parts = [part for part in parts if part is not None]
    if not parts:
        return None
    return reduce(and_ if _logic(tree) == "AND" else or_, parts)


def predicate(tree: Tree) -> Column:
    """The whole tree as a filter predicate: TRUE when nothing is active, an error when switched off."""
    if not tree.get("enabled", True):
        raise RulesDisabledError("rules are switched off as a whole; refusing to pass every row")
    compiled = compile_rules(tree)
    return F.lit(True) if compiled is None else compiled


def apply_rules(df: DataFrame, tree: Tree) -> DataFrame:
    return df.where(predicate(tree))


# --- the same predicates as SQL text -------------------------------------------------------------


def _literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, (int, Decimal)):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _identifier(field: str) -> str:
    return ".".join(f"`{part}`" for part in field.split("."))


SQL_TEMPLATES: dict[str, str] = {
    "=": "{f} = {v}",
    "= (TRIM)": "trim({f}) = {v}",
    "= (IGNORE CASE)": "upper({f}) = upper({v})",
    "= (IGNORE CASE TRIM)": "upper(trim({f})) = upper({v})",
    "IN": "{f} IN ({list})",
    ">": "{f} > {v}",
    ">=": "{f} >= {v}",
    "<": "{f} < {v}",
    "<=": "{f} <= {v}",
    "IS NULL": "{f} IS NULL",
    "IS BLANK": "({f} IS NULL OR trim({f}) = '')",
    "BETWEEN": "{f} BETWEEN {low} AND {high}",
    "LIKE": "{f} LIKE {v}",
    "RLIKE": "{f} RLIKE {v}",
    "RLIKE (IGNORE CASE)": "{f} RLIKE {any_case}",
}


def condition_sql(rule: Tree) -> str:
    name, value = rule["operator"], rule.get("value")
    template = SQL_TEMPLATES.get(NEGATED.get(name, name))
    if template is None:
        raise _unsupported(rule)
    items = value if isinstance(value, (list, tuple)) else []
    text = template.format(
        f=_identifier(rule["field"]),
        v=_literal(value) if not items else "",
        list=", ".join(_literal(item) for item in items),
        low=_literal(items[0]) if items else "",
        high=_literal(items[-1]) if items else "",
        any_case=_literal(f"(?i){value}"),
    )
    return f"NOT ({text})" if name in NEGATED else text


def _group_sql(tree: Tree) -> str | None:
    parts = [_group_sql(item) if "rules" in item else condition_sql(item) for item in _active(tree)]
    parts = [part for part in parts if part is not None]
    if not parts:
        return None
    return "(" + f" {_logic(tree)} ".join(f"({part})" for part in parts) + ")"


def to_sql(tree: Tree) -> str:
    """The predicate as text, to be placed in a WHERE clause handed to ``spark.sql``."""
    if not tree.get("enabled", True):
        raise RulesDisabledError("rules are switched off as a whole; refusing to pass every row")
    return _group_sql(tree) or "TRUE"


# --- loading --------------------------------------------------------------------------------------


def _unescape_patterns(tree: dict) -> dict:
    if "rules" in tree:
        return {**tree, "rules": [_unescape_patterns(item) for item in tree["rules"]]}
    if "RLIKE" in tree.get("operator", "") and isinstance(tree.get("value"), str):
        return {**tree, "value": re.sub(r"\\\\", r"\\", tree["value"])}
    return tree


def load_rules(source: str | Path | Mapping, sql_escaped: bool = False) -> dict:
    """A rule tree from a dict, JSON text or a file path.

    ``sql_escaped`` is for files whose regular expressions were written for a SQL string literal and
    so carry one more level of backslashes than a pattern needs.
    """
    if isinstance(source, Mapping):
        tree = dict(source)
    elif isinstance(source, str) and source.lstrip().startswith("{"):
        tree = json.loads(source)
    else:
        tree = json.loads(Path(source).read_text(encoding="utf-8"))
    return _unescape_patterns(tree) if sql_escaped else tree
