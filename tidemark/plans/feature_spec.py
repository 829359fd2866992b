"""Declarative description of a feature set."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

ITEMS = "items"            # distinct items
FLAG_COUNT = "flag_count"  # distinct items with a flag
FLAG_SHARE = "flag_share"  # the same over distinct items
DAYS_FIRST = "days_first"  # days since the first release
DAYS_LAST = "days_last"    # days since the last release
AVG0 = "avg0"              # average over credit rows, NULL as 0
SUM0 = "sum0"              # sum over credit rows, NULL as 0

KINDS = (ITEMS, FLAG_COUNT, FLAG_SHARE, DAYS_FIRST, DAYS_LAST, AVG0, SUM0)


@dataclass(frozen=True)
class Feature:
    """One output column. ``arg`` is a SQL predicate or an item column."""

    name: str
    kind: str
    arg: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown feature kind {self.kind!r}")


@dataclass(frozen=True)
class FeatureSpec:
    """Features of ``entity`` over the items credited to it.

    ``months=None`` looks at all history before the reference date, otherwise at
    the trailing window. Flags are predicates over the credit rows, or over the
    tags of the item when ``tag`` names the tag id.
    """

    name: str
    entity: str
    item: str
    release: str
    features: tuple[Feature, ...]
    tag: str | None = None
    months: int | None = None
    ref: str = "dtRef"

    @property
    def predicates(self) -> list[str]:
        flags = [f.arg for f in self.features if f.kind in (FLAG_COUNT, FLAG_SHARE)]
        return list(dict.fromkeys(flags))

    @property
    def measures(self) -> list[str]:
        return list(dict.fromkeys(f.arg for f in self.features if f.kind in (AVG0, SUM0)))

    def windowed(self, years: int) -> FeatureSpec:
        """The same features over the last ``years``, with suffixed names."""
        suffix = f"{years:02d}Years"
        return replace(
            self,
            name=f"{self.name}_{years:02d}_years",
            months=12 * years,
            features=tuple(replace(f, name=f.name + suffix) for f in self.features),
        )


def text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def tag_flags(match_col: str, names: Mapping[str, str], kind: str = FLAG_SHARE) -> tuple[Feature, ...]:
    """One flag per output name: ``match_col`` equals the mapped value."""
    return tuple(Feature(name, kind, f"{match_col} = {text(value)}") for name, value in names.items())
