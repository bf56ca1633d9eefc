"""Column-role profile: the one piece of metadata that drives every
profile-driven transform (typing, validation, deduplication, gold)."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Iterable

from strata.constants import ROLES


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    role: str
    reason: str = ""
    stats: dict = field(default_factory=dict, compare=False, hash=False)

    def __post_init__(self):
        if self.role not in ROLES:
            raise ValueError(f"unknown role {self.role!r} for column {self.name!r}")


@dataclass(frozen=True)
class Profile:
    """Ordered column → role map (bronze column order)."""

    columns: tuple[ColumnSpec, ...]

    # -- construction -------------------------------------------------
    @classmethod
    def of(cls, roles: dict[str, str] | Iterable[tuple[str, str]]) -> "Profile":
        items = roles.items() if isinstance(roles, dict) else roles
        return cls(tuple(ColumnSpec(n, r) for n, r in items))

    @classmethod
    def from_dict(cls, d: dict) -> "Profile":
        """Accepts ``{col: {"role": .., "reason": .., "stats": {..}}}``."""
        return cls(tuple(ColumnSpec(n, v["role"], v.get("reason", ""), v.get("stats") or {})
                         for n, v in d.items()))

    @classmethod
    def from_json(cls, text: str) -> "Profile":
        return cls.from_dict(json.loads(text))

    def to_dict(self) -> dict:
        return {c.name: {"role": c.role, "reason": c.reason, "stats": c.stats} for c in self.columns}

    def to_json(self) -> str:
        return json.dumps(self.to_dict(), indent=2, default=str)

    def with_roles(self, overrides: dict[str, str]) -> "Profile":
        return Profile(tuple(ColumnSpec(c.name, overrides.get(c.name, c.role),
                                        "user override" if c.name in overrides else c.reason, c.stats)
                             for c in self.columns))

    # -- queries --------------------------------------------------------
    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def role_of(self, name: str) -> str:
        for c in self.columns:
            if c.name == name:
                return c.role
        raise KeyError(name)

    def by_role(self, *roles: str) -> list[str]:
        return [c.name for c in self.columns if c.role in roles]

    @property
    def required(self) -> list[str]:
        """Columns whose missing value rejects the row (date, id, dimension)."""
        return self.by_role("date", "id", "dimension")

    @property
    def measures(self) -> list[str]:
        return self.by_role("measure")

    def dedup_keys(self) -> list[str]:
        """All id columns; else dimensions then dates; else every column."""
        ids = self.by_role("id")
        if ids:
            return ids
        keys = self.by_role("dimension") + self.by_role("date")
        return keys or self.names
