"""Export parameters as a checked value."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from tallyloom.operators.export import NO_UPPER_BOUND


@dataclass(frozen=True)
class Source:
    """Where a role's rows come from; recorded in the manifest. ``revision`` is the one asked for, ``resolved`` the one found."""

    location: str = ""
    split: str = "train"
    revision: str | None = None
    resolved: str | None = None
    config: str | None = None


@dataclass(frozen=True)
class Recipe:
    recipe_id: str
    min_chars: int = 1
    max_chars: int = NO_UPPER_BOUND
    max_sft_rows: int | None = None
    max_dpo_rows: int | None = None
    policy_version: str = "v1"
    sources: Mapping[str, Source] = field(default_factory=dict)
    path: str | None = None

    def __post_init__(self) -> None:
        if not isinstance(self.recipe_id, str) or not self.recipe_id:
            raise ValueError("recipe_id must be a non-empty string")
        if self.min_chars > self.max_chars:
            raise ValueError(f"min_chars ({self.min_chars}) must not exceed max_chars ({self.max_chars})")
        for cap in (self.max_sft_rows, self.max_dpo_rows):
            if cap is not None and cap < 0:
                raise ValueError("a row cap must not be negative")

    @classmethod
    def from_mapping(cls, recipe: Mapping[str, Any], path: str | None = None) -> Recipe:
        """A recipe from a parsed configuration mapping with ``schema_version: 1``; ``path`` says where it was read."""
        if not isinstance(recipe, Mapping):
            raise ValueError("a recipe must be a mapping")
        if recipe.get("schema_version") != 1:
            raise ValueError("unsupported schema_version (expected 1)")
        sources = recipe.get("sources")
        if not isinstance(sources, Mapping) or not {"sft", "dpo"} <= set(sources):
            raise ValueError("sources.sft and sources.dpo are required")
        filters, limits = recipe.get("filters") or {}, recipe.get("limits") or {}

        def cap(name: str) -> int | None:
            return None if limits.get(name) is None else int(limits[name])

        def source(entry: Mapping[str, Any] | None) -> Source:
            entry = entry or {}
            location = entry.get("location") or entry.get("hf_path") or ""
            revision, resolved, config = (None if entry.get(k) in (None, "") else str(entry[k]) for k in ("revision", "revision_resolved", "config"))
            return Source(str(location), str(entry.get("split", "train")), revision, resolved, config)

        return cls(
            recipe_id=recipe.get("recipe_id"),
            min_chars=int(filters.get("min_chars", 1)),
            max_chars=int(filters.get("max_chars", NO_UPPER_BOUND)),
            max_sft_rows=cap("max_sft_rows"),
            max_dpo_rows=cap("max_dpo_rows"),
            policy_version=str(recipe.get("filter_policy_version", "v1")),
            sources={role: source(sources[role]) for role in ("sft", "dpo")},
            path=path,
        )
