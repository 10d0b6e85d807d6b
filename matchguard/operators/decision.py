"""Heuristic rules and policies as column expressions (D-6 to D-8)."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the heuristic rules: teleport share, burst kills, burst window, headshot streak.
TELEPORT, BURST_KILLS, BURST_WINDOW, HEADSHOT_STREAK = 0.80, 2.0, 200.0, 5.0
HEURISTIC_VERSION = "v1.0-heuristic"


@dataclass(frozen=True)
class Rule:
    name: str
    min_score: float
    max_score: float
    action: str
    priority: str
    reason: str = ""
    min_headshot_zscore: float | None = None


@dataclass(frozen=True)
class Policy:
    version: str
    default_action: str
    rules: tuple[Rule, ...]


def make_policy(data: dict) -> Policy:
    """D-8: checks a policy's parts; max_score defaults to 1.01."""
    if not isinstance(data, dict) or not str(data.get("version") or "").strip() or not data.get("rules"):
        raise ValueError("a policy needs a version and rules")
    rules = []
    for r in data["rules"]:
        low, high = float(r.get("min_score", 0.0)), float(r.get("max_score", 1.01))
        if not str(r.get("name") or "").strip():
            raise ValueError("a rule needs a name")
        if not (math.isfinite(low) and math.isfinite(high) and 0 <= low < high <= 1.01):
            raise ValueError(f"rule {r['name']}: 0 <= min_score < max_score <= 1.01")
        z = r.get("min_headshot_zscore")
        rules.append(Rule(r["name"], low, high, r["action"], r["priority"], r.get("reason", ""), None if z is None else float(z)))
    return Policy(str(data["version"]), data.get("default_action", "CLEAR"), tuple(rules))


def load_policy(path: str) -> Policy:
    import yaml

    with open(path, encoding="utf-8") as f:
        return make_policy(yaml.safe_load(f))


#: The five-rule and the three-rule policy.
FIVE_RULES = make_policy({
    "version": "v1", "default_action": "CLEAR",
    "rules": [
        {"name": "auto_clear", "min_score": 0.0, "max_score": 0.30, "action": "CLEAR", "priority": "LOW"},
        {"name": "watchlist_monitoring", "min_score": 0.30, "max_score": 0.60, "action": "WATCHLIST", "priority": "MEDIUM"},
        {"name": "escalate_human_review", "min_score": 0.60, "max_score": 0.85, "action": "ESCALATE_TO_MODERATOR", "priority": "HIGH"},
        {"name": "auto_suspend_aimbot", "min_score": 0.85, "max_score": 1.01, "min_headshot_zscore": 3.0, "action": "SUSPEND_ACCOUNT", "priority": "URGENT"},
        {"name": "critical_permanent_ban", "min_score": 0.85, "max_score": 1.01, "action": "PERMANENT_BAN", "priority": "CRITICAL"},
    ],
})
THREE_RULES = make_policy({
    "version": "v1.0-rf-policy", "default_action": "CLEAR",
    "rules": [
        {"name": "watch_low_risk", "min_score": 0.30, "max_score": 0.60, "action": "WATCHLIST", "priority": "MEDIUM"},
        {"name": "escalate_high_risk", "min_score": 0.60, "max_score": 0.80, "action": "ESCALATE_TO_MODERATOR", "priority": "HIGH"},
        {"name": "suspend_critical_risk", "min_score": 0.80, "max_score": 1.01, "min_headshot_zscore": 2.5, "action": "SUSPEND_ACCOUNT", "priority": "CRITICAL"},
    ],
})


def _outcome(action: str, priority: str, reason: Column | str, rule: str, version: str) -> Column:
    return F.struct(F.lit(action).alias("action"), F.lit(priority).alias("priority"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"), F.lit(rule).alias("policy_rule"), F.lit(version).alias("policy_version"))


def heuristic_rules(teleport: Column, kills: Column, burst: Column, streak: Column) -> Column:
    """D-6: the first heuristic that holds, or null."""
    single = lambda c: (c if isinstance(c, Column) else F.lit(c)).cast("float")  # noqa: E731  features and bounds are single precision
    teleport, kills, burst, streak = (single(c) for c in (teleport, kills, burst, streak))
    ban = lambda rule, text: _outcome("PERMANENT_BAN", "CRITICAL", text, rule, HEURISTIC_VERSION)
    return (
        F.when(teleport > single(TELEPORT), ban("heuristic_teleport_hack", "impossible movement"))
        .when((kills >= BURST_KILLS) & (burst > 0) & (burst < BURST_WINDOW), ban("heuristic_burst_aimbot", "kills within an impossible time"))
        .when(streak >= HEADSHOT_STREAK, ban("heuristic_headshot_streak", "impossible headshot streak"))
    )


def heuristics_by_position(features: Column) -> Column:
    """The positional form: needs ten features; the eleventh is optional."""
    at = lambda i: F.coalesce(F.get(features, F.lit(i)).cast("float"), F.lit(0.0).cast("float"))
    return F.when(F.size(features) >= 10, heuristic_rules(at(9), at(0), at(8), at(10)))


def headshot_z(evidence: Column) -> Column:
    """The headshot item's z, 0 without one."""
    return F.coalesce(F.get(F.filter(evidence, lambda e: e["feature"] == "headshot_ratio"), F.lit(0))["z_score"].cast("double"), F.lit(0.0))


def policy_decision(score: Column, z: Column, policy: Policy) -> Column:
    """D-7: the first rule whose range holds the score and whose z condition holds."""
    # bounds are single precision, as scores are
    s, out = score.cast("float"), None
    for r in policy.rules:
        hit = (s >= F.lit(r.min_score).cast("float")) & (s < F.lit(r.max_score).cast("float"))
        if r.min_headshot_zscore is not None:
            hit = hit & (z >= r.min_headshot_zscore)
        value = _outcome(r.action, r.priority, r.reason or r.name, r.name, policy.version)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(_outcome(policy.default_action, "LOW", "no rule applies", "default_action", policy.version))


def decide(score: Column, evidence: Column, policy: Policy, features: Column | None = None, policy_z: str = "top2", all_evidence: Column | None = None) -> Column:
    """Heuristics first, then the policy. ``policy_z="all"`` reads the z from ``all_evidence``."""
    z = headshot_z(all_evidence if policy_z == "all" and all_evidence is not None else evidence)
    ruled = policy_decision(score, z, policy)
    return ruled if features is None else F.coalesce(heuristics_by_position(features), ruled)
