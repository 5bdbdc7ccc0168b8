"""How a source's sidecars are shaped and spelled. Profiles are values: two in one session never mix."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from .config import FIELD_ALIASES


def _same(raw: Any) -> Any:
    return raw


def first_chunk(raw: Any) -> Any:
    """The payload of an array of chunk records: the first one's data.metadata, else metadata, else itself. An
    empty array stays what it is, and is an error for its episode."""
    head = raw[0] if isinstance(raw, list) and raw else raw
    if not isinstance(head, dict):
        return head
    for holder in (head.get("data", head), head):
        if isinstance(holder, dict) and isinstance(holder.get("metadata"), dict):
            return holder["metadata"]
    return head


@dataclass(frozen=True)
class Profile:
    name: str
    unwrap: Callable[[Any], Any] = _same
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    sidecar: str | None = None  # an exact base name

    def spellings(self) -> dict[str, tuple[str, ...]]:
        """The registry's aliases, then the profile's own, without repeats."""
        return {f: tuple(dict.fromkeys((*names, *self.aliases.get(f, ())))) for f, names in {**{k: () for k in self.aliases}, **FIELD_ALIASES}.items()}


PROFILES = {
    p.name: p
    for p in (
        Profile("generic"),
        Profile("chunk-array-v1", first_chunk, {"start_time_unix": ("episode_start_time",), "environment_l1": ("environment_label",)}),
        Profile("paired-site-v1", aliases={"environment_id": ("factory_id",), "operator_id": ("worker_id",)}),
        Profile("rich-sidecar-v1", aliases={"environment_l1": ("environment",)}, sidecar="episode_metadata.json"),
    )
}


def get(name: str) -> Profile:
    if name not in PROFILES:
        raise KeyError(f"unknown profile '{name}'; known: {', '.join(PROFILES)}")
    return PROFILES[name]
