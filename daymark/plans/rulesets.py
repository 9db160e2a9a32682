"""Eligibility rules of the six offer tables.

Fields, operators and values are fixed values; they can be replaced by any other tree when a job runs.
"""

from __future__ import annotations

from typing import Any


def _rule(field: str, operator: str, value: Any = None) -> dict:
    return {"field": field, "operator": operator} | ({} if value is None else {"value": value})


def _zero(*fields: str) -> list[dict]:
    return [_rule(field, "=", 0) for field in fields]


def _all(*rules: dict) -> dict:
    return {"logic": "AND", "rules": list(rules)}


def _any(*rules: dict) -> dict:
    return {"logic": "OR", "rules": list(rules)}


def _tree(version: str, group: dict) -> dict:
    return {"enabled": True, "version": version, **group}


# Fixed value: names of group accounts kept for the staff of a company.
STAFF_ACCOUNT_NAMES = (
    r"(EMPLOYEES OF|EMPLOY|EMP NO |EMP NO\.|EMP, NO\.|EMP NO,|EMP\. NO,|EMP |EMP-|EMP\.|EMP\(|EMP #|EMP#|EMP#\(|EMP,"
    r"|EMP\. # |EMP, \(|EP # |,, EMP)"
)

_NOT_WEALTH = _rule("client_segment_name", "!= (IGNORE CASE TRIM)", "WEALTH")
_NAMED = _rule("full_name", "IS NOT BLANK")
_KNOWN = _rule("bbn", "IS NOT NULL")

AL_STP = _tree(
    "1",
    _all(
        *_zero("is_with_al_flag", "is_with_salad_flag", "is_with_csl_flag"),
        _any(
            _all(
                *_zero("is_payroll_acct_flag", "is_acct_payroll_like_flag"),
                _rule("depo_mob_count", ">=", 3),
            ),
            _all(
                _any(_rule("is_payroll_acct_flag", "=", 1), _rule("is_acct_payroll_like_flag", "=", 1)),
                _rule("depo_mob_count", ">=", 3),
            ),
        ),
        _rule("age", "BETWEEN", [21, 62]),
        _rule("adb_3m_avg", ">=", 100000),
        _rule("deposit_ob", ">=", 10000),
        *_zero(
            "is_with_pl_acct_woff_flag", "is_non_indiv_flag", "is_dosri_flag", "is_enfis_flag", "is_risk_industry_flag"
        ),
        _rule("b_score_cc_value", ">=", 581),
        *_zero("is_with_pl_flag"),
        _NOT_WEALTH,
        _rule("is_with_al_application_6m_flag", "!=", 1),
        _rule("is_with_cc_application_flag", "!=", 1),
        _NAMED,
    ),
)


def _card_branch(payroll: int, months: int) -> dict:
    return _all(
        _KNOWN,
        *_zero("is_non_indiv_flag", "is_dosri_flag", "is_enfis_flag", "is_dnc_flag", "is_risk_industry_flag"),
        _rule("client_segment_name", "!=", "WEALTH"),
        *_zero("is_card_canc_12m_flag", "is_with_credit_card_flag", "is_with_cc_application_flag"),
        _rule("is_with_cc_propensity_flag", "=", 1),
        _rule("age", "BETWEEN", [21, 62]),
        _rule("is_payroll_acct_flag", "=", payroll),
        _rule("depo_mob_count", ">=", months),
        _rule("adb_3m_avg", ">=", 31250),
        *_zero("is_with_pl_acct_woff_flag"),
    )


CC_STP = _tree("3", _any(_card_branch(payroll=1, months=12), _card_branch(payroll=0, months=3)))


def _home_branch(score_rule: dict) -> dict:
    return _all(
        _KNOWN,
        *_zero("is_non_indiv_flag", "is_dosri_flag", "is_enfis_flag", "is_dnc_flag", "is_risk_industry_flag"),
        _rule("client_segment_name", "!=", "wealth"),
        _rule("age", "BETWEEN", [21, 55]),
        *_zero("is_with_salad_flag", "is_with_csl_flag", "is_with_pl_acct_woff_flag"),
        _rule("adb_3m_avg", ">=", 125000),
        score_rule,
    )


HL_STP = _tree(
    "3",
    _any(_home_branch(_rule("b_score_cc_value", "<=", 0)), _home_branch(_rule("b_score_cc_value", ">=", 581))),
)

AL_PTB = _tree(
    "2",
    _all(
        *_zero(
            "is_non_indiv_flag", "is_with_al_application_12m_flag", "is_dosri_flag", "is_no_segment_flag",
            "is_with_al_flag",
        ),
        _NOT_WEALTH,
        _rule("age", "BETWEEN", [20, 64]),
        _NAMED,
        _rule("full_name", "NOT RLIKE (IGNORE CASE)", STAFF_ACCOUNT_NAMES),
    ),
)

CC_PTB = _tree(
    "1",
    _all(
        _rule("base.bbn", "IS NOT BLANK"),
        *_zero("is_non_indiv_flag"),
        _rule("is_with_cc_propensity_flag", "=", 1),
        *_zero("is_dosri_flag", "is_with_credit_card_flag", "is_with_cc_application_flag"),
        _NOT_WEALTH,
        _rule("age", "BETWEEN", [21, 62]),
    ),
)

HL_PTB = _tree(
    "1",
    _all(
        _KNOWN,
        _rule("is_non_indiv_flag", "IN", [0, "0"]),
        *_zero("is_with_hl_application_flag", "is_dosri_flag", "is_no_segment_flag", "is_with_hl_flag"),
        _rule("client_segment_name", "!=", "wealth"),
        _rule("age", "BETWEEN", [21, 65]),
    ),
)

RULESETS = {
    "dm_casa_to_al_cross_sell_stp_offers": AL_STP,
    "dm_casa_to_cc_cross_sell_stp_offers": CC_STP,
    "dm_casa_to_hl_cross_sell_stp_offers": HL_STP,
    "dm_casa_to_al_cross_sell_ptb_offers": AL_PTB,
    "dm_casa_to_cc_cross_sell_ptb_offers": CC_PTB,
    "dm_casa_to_hl_cross_sell_ptb_offers": HL_PTB,
}
