"""Configuration: funds, presets and how they, scenarios and the user's wishes make a run. Presets are a JSON file."""

from __future__ import annotations

import json
from dataclasses import dataclass

from tidemark.plans.scenarios import Scenario

# Modes of decision, fixed values: label, cutoff of the day's news.
MODES = {"strict_lag": None, "night_partial": "21:30", "same_day_close": None}
# Scenarios: which day's news and how long a quote takes, fixed values.
SCENARIOS = {"legacy": {}, "cmf_date_news": {"news_reference": "quote_date", "quote_lag_days": 1}, "decision_date_news": {"news_reference": "decision_date", "quote_lag_days": 1}}


@dataclass(frozen=True)
class Fund:
    key: str
    run_fm: str
    label: str
    horizon: int
    preferred: tuple[str, ...]
    scenario: str = "legacy"
    folder: str = ""


# Funds, fixed values.
FUNDS = {
    f.key: f
    for f in (
        Fund("crecimiento_balanceado", "10063", "Crecimiento Balanceado", 4, ("SIMPLE", "APV", "IT")),
        Fund("crecimiento_balanceado_dia", "10063", "Crecimiento Balanceado - DIA", 4, ("SIMPLE", "APV", "IT"), "decision_date_news"),
        Fund("national_equity", "8305", "National Equity", 2, ("F1", "SIMPLE", "APV", "IT")),
        Fund("national_equity_dia", "8305", "National Equity - DIA", 2, ("F1", "SIMPLE", "APV", "IT"), "decision_date_news"),
        Fund("toesca_equity", "9936", "Toesca Equity", 2, ("F1", "SIMPLE", "APV", "IT")),
        Fund("toesca_equity_dia", "9936", "Toesca Equity - DIA", 2, ("F1", "SIMPLE", "APV", "IT"), "decision_date_news"),
        Fund("ahorro_uf_itau", "10243", "Ahorro UF Itaú", 1, ("SIMPLE", "APV", "F4", "F5", "IT")),
    )
}
DEFAULTS = {"decision_mode": "strict_lag", "decision_time": None, "probability_threshold": 0.5, "target_threshold": 0.0, "strict_return_lag": False, "tune": False, "tune_iter": 15}


def mode(name: str) -> dict:
    if name not in MODES:
        raise ValueError(f"unknown decision mode: {name}")
    return {"decision_mode": name, "decision_time": MODES[name]}


def selected(names: list[str] | None) -> list[str]:
    """Fund keys in order, each once; ``all`` or nothing means all of them."""
    names = [n.strip().lower() for n in names or ["all"]]
    if "all" in names:
        return list(FUNDS)
    if bad := [n for n in names if n not in FUNDS]:
        raise ValueError(f"unknown funds: {bad}; there are {sorted(FUNDS)}")
    return list(dict.fromkeys(names))


def load_presets(path: str | None) -> dict:
    """``{presets: {fund: {...}}, scenarios: {fund: {scenario: {...}}}, models: {fund: {...}}}``; missing parts are empty."""
    if not path:
        return {"presets": {}, "scenarios": {}, "models": {}}
    with open(path, encoding="utf-8") as f:
        return {"presets": {}, "scenarios": {}, "models": {}} | json.load(f)


def runtime(fund: str, presets: dict, scenario: str | None = None, overrides: dict | None = None, use_presets: bool = True, use_models: bool = True) -> dict:
    """Defaults, then the fund's preset, the scenario's, the model's parameters, and what the user asks for."""
    c = DEFAULTS | (presets["presets"].get(fund, {}) if use_presets else {})
    name = scenario or FUNDS[fund].scenario
    if name not in SCENARIOS:
        raise ValueError(f"unknown scenario: {name}")
    if name != "legacy" and use_presets:
        c |= {"decision_mode": "same_day_close", "decision_time": None} | presets["scenarios"].get(fund, {}).get(name, {})
    c["scenario"] = name
    if use_models and fund in presets["models"]:
        c["params"] = presets["models"][fund] | c.get("params", {})
    elif not use_models:
        c.pop("params", None)
    c |= {k: v for k, v in (overrides or {}).items() if v is not None}
    if c["decision_mode"] != "night_partial":
        c["decision_time"] = None
    return c


def scenario_of(fund: str, c: dict, holidays: tuple[str, ...] = ()) -> Scenario:
    name = c["scenario"]
    if name == "legacy":
        return Scenario()
    s = SCENARIOS[name]
    return Scenario(name, s["news_reference"], int(c.get("quote_lag_days", s["quote_lag_days"])), int(c.get("horizon_business_days", FUNDS[fund].horizon)), c.get("weekmask", "1111100"), tuple(sorted(c.get("holidays", holidays))), c["decision_mode"], c["decision_time"])


def option_by_terms(options: list[tuple[str, str]], code: str | None = None, terms: list[str] = []) -> tuple[str, str]:  # noqa: B006
    """One of ``(code, label)``: by code, else the only one whose label has all terms."""
    from tidemark.functions.text import match_term

    if code:
        found = [o for o in options if o[0] == code]
    else:
        found = [o for o in options if all(match_term(t) in match_term(o[1]) for t in terms)]
    if len({o[0] for o in found}) != 1:
        raise ValueError(f"{len(found)} options fit: {found[:5]}")
    return found[0]
