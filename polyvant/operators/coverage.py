"""Which fields of the registry the sidecars of a delivery carry, and episode identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.flatten import fields, resolve
from ..profiles import PROFILES, Profile

# The fields of each section. Handheld and glove fields are asked for only where a sidecar has any.
REGISTRY: dict[str, dict[str, tuple[str, ...]]] = {
    "required": {
        "Episode": ("episode_uuid", "operator_id", "operator_consent", "operator_job", "start_time_unix", "end_time_unix", "task_id", "task_description", "skill_group", "task_difficulty"),
        "Environment & Location": ("city", "state_province", "country", "location", "environment_l1", "environment_l2", "environment_l3", "environment_id"),
        "Ego Device": ("device_kit_id", "device_id", "device_generation", "firmware_version"),
        "Operator & Physical": ("age_range", "gender", "handedness"),
    },
    "optional": {
        "Environment & Location": ("business_id", "business_name"),
        "Operator & Physical": ("role_experience", "task_experience", "collection_hours_today", "collection_experience_days", "hand_size_cm"),
    },
    "handheld": {"Handheld": ("handheld_device_id", "handheld_device_generation", "handheld_device_urdf")},
    "glove": {"Glove": ("glove_device_id", "glove_generation", "glove_firmware_version", "glove_hand_model", "glove_tracking_method", "glove_tactile_resolution", "glove_sampling_rate_hz")},
}
# Other accepted spellings.
SPELLINGS = {"episode_uuid": ("session_uuid", "uuid"), "task_description": ("instruction", "description"), "location": ("geo_hash",), "operator_consent": ("consent",)}


def _names(field: str, profile: Profile) -> tuple[str, ...]:
    return (field, *SPELLINGS.get(field, ()), *profile.aliases.get(field, ()))


def episode_id(leaves: Column, stem: Column, source: Column, profile: Profile = PROFILES["generic"]) -> Column:
    """The declared uuid, else the stem, else the source."""
    return F.coalesce(resolve(leaves, _names("episode_uuid", profile)), F.when(stem != "", stem), source)


def field_coverage(episodes: DataFrame, profile: Profile = PROFILES["generic"]) -> DataFrame:
    """(tier, section, field, asked, present): in how many episodes a field is asked for, and in how many it is
    present. One pass over the sidecars, one row for each field."""
    asked = [(tier, section, f) for tier, sections in REGISTRY.items() for section, names in sections.items() for f in names]
    used = ("handheld", "glove")
    d = episodes.select(fields(F.col("meta_json"), profile, {f: _names(f, profile) for _, _, f in asked}, prefixes=used).alias("x"))
    d = d.select(*(F.coalesce(F.col(f"x.has_{t}"), F.lit(False)).alias(f"_{t}") for t in used), *(F.col("x").getField(f).isNotNull().alias(f) for _, _, f in asked))
    counts = d.agg(*(F.count_if(F.col(f)).alias(f) for _, _, f in asked), F.count(F.lit(1)).alias("_all"), *(F.count_if(f"_{t}").alias(f"_{t}") for t in used))
    rows = F.explode(F.array(*(F.struct(F.lit(t).alias("tier"), F.lit(s).alias("section"), F.lit(f).alias("field"), F.col(f"_{t}" if t in used else "_all").alias("asked"), F.col(f).alias("present")) for t, s, f in asked)))
    return counts.select(rows.alias("r")).select("r.*")
