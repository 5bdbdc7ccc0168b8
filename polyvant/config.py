"""Limits and vocabularies of the delivery checks: plain values, passed as a parameter and never changed."""

from __future__ import annotations

from dataclasses import dataclass, field

HOUR_US = 3_600_000_000

# Accepted spellings of each canonical field, in registry order. Dashes, underscores, dots, spaces and
# case never matter.
FIELD_ALIASES: dict[str, tuple[str, ...]] = {
    "task_id": ("task_id",),
    "operator_id": ("operator_id",),
    "environment_id": ("environment_id",),
    "environment_l1": ("environment_l1", "environment_category", "l1"),
    "environment_l2": ("environment_l2", "facility_type", "venue", "l2"),
    "environment_l3": ("environment_l3", "scene", "l3"),
    "task_difficulty": ("task_difficulty", "difficulty"),
    "skill_group": ("skill_group",),
    "business_size": ("business_size", "business_type"),
    "worker_type": ("worker_type", "operator_type", "workforce_composition"),
    "human_interaction": ("human_interaction", "interaction"),
    "start_time_unix": ("start_time_unix",),
    "end_time_unix": ("end_time_unix",),
}

# Canonical value and the tokens that mean it.
DIFFICULTY = {"easy": ("easy", "e", "1", "simple"), "medium": ("medium", "med", "2"), "hard": ("hard", "h", "3", "difficult", "skilled")}
BUSINESS_SIZE = {"small": ("small", "sm", "s"), "medium": ("medium", "med", "m", "mediumsizedbusiness", "mediumbusiness"), "large": ("large", "lg", "l", "big")}
WORKER_TYPE = {"real": ("real", "employee", "internal", "realworker", "realemployee"), "contractor": ("contractor", "contract", "external", "contractworker", "contractors")}
TRUE_TOKENS = ("true", "yes", "y", "1", "t")
FALSE_TOKENS = ("false", "no", "n", "0", "f")

# The environment vocabulary.
ENVIRONMENT_NAMES = {
    "RT001": "Retail",
    "FS001": "Fashion",
    "RP001": "Repair",
    "FB001": "Food and beverage",
    "CN001": "Construction",
    "FP001": "Food processing",
    "FC001": "Factory",
    "HP001": "Hospitality",
    "AT001": "Automotive",
    "SR001": "Sports and recreation",
    "AD001": "Administrative",
    "HC001": "Healthcare",
    "CL001": "Cleaning",
    "LT001": "Laboratory",
    "AG001": "Agriculture",
    "BP001": "Beauty and personal care",
    "EN001": "Entertainment",
    "LD001": "Laundry",
    "WH001": "Warehouse",
}

#: Severity as a bit: a group's labels are OR-ed, so its severest label and whether labels differ are one number.
DIFFICULTY_BIT = {"easy": 1, "medium": 2, "hard": 4}


def _caps(hard: float, medium: float, easy: float) -> dict[str, float]:
    return {"hard": hard, "medium": medium, "easy": easy}


@dataclass(frozen=True)
class Limits:
    """Thresholds. Shares are percentages, caps are hours; caps are exceeded only by more, floors only by less."""

    l1_single_pct: float = 20.0
    l1_top5_pct: float = 60.0
    l1_top10_pct: float = 85.0
    l1_min_distinct: int = 15
    easy_max_pct: float = 30.0
    hard_min_pct: float = 5.0
    medium_target_pct: float = 40.0
    task_share_pct: dict[str, float] = field(default_factory=lambda: _caps(6.0, 4.0, 1.5))
    task_max_h: float = 200.0
    task_env_max_h: dict[str, float] = field(default_factory=lambda: _caps(40.0, 20.0, 10.0))
    factory_h: float = 1.0
    factory_dynamic_h: float = 2.0
    factory_words: tuple[str, ...] = ("factory", "manufactur", "industrial")
    op_task_env_max_h: dict[str, float] = field(default_factory=lambda: _caps(10.0, 2.0, 1.0))
    env_op_max_h: float = 40.0
    business_max_h: dict[str, float] = field(default_factory=lambda: {"small": 500.0, "medium": 2000.0, "large": 5000.0})
    real_min_pct: float = 70.0
    contractor_max_pct: float = 30.0
    interaction_min_pct: float = 5.0
    duration_abs_s: float = 1.0
    duration_rel: float = 0.02


def microseconds(hours: float) -> int:
    return round(hours * HOUR_US)
