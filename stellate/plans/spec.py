"""How star tables are described: column kinds and table kinds."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

# Gives a source column by name, or NULL when the source table does not have it.
Getter = Callable[[str], Column]


@dataclass(frozen=True)
class Source:
    """A source column under a new name."""

    column: str


@dataclass(frozen=True)
class Calc:
    """An expression over source columns."""

    build: Callable[[Getter], Column]
    columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Label:
    """Label of an option-set code column; the set is named after the column unless given."""

    column: str
    option_set: str | None = None


@dataclass(frozen=True)
class Iso:
    """Three-letter code of a country name."""

    column: str


@dataclass(frozen=True)
class Fk:
    """Surrogate key of ``dimension`` found by a source column (or an expression of it)."""

    dimension: str
    column: str
    derive: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class CompositeFk:
    """Surrogate key of a distinct dimension with the same source columns."""

    dimension: str


@dataclass(frozen=True)
class ViaFact:
    """Column of the last row of another fact with the same key."""

    fact: str
    key: str


ColumnSpec = Source | Calc | Label | Iso | Fk | CompositeFk | ViaFact


@dataclass(frozen=True)
class Table:
    name: str
    source: str | None
    columns: Mapping[str, ColumnSpec] = field(default_factory=dict)
    pk: str | None = None
    # Column other tables find this one by.
    natural: str | None = None

    def declared(self) -> list[str]:
        """Column names of the finished table."""
        return [*([self.pk] if self.pk else []), *self.columns]


@dataclass(frozen=True)
class Dimension(Table):
    """One row per source row."""


@dataclass(frozen=True)
class PhaseDimension(Table):
    """Referenced phases only, one row per name."""

    referenced_in: tuple[str, str] = ("", "")


@dataclass(frozen=True)
class DistinctDimension(Table):
    """One row per distinct combination of source columns."""


@dataclass(frozen=True)
class DelimitedDimension(Table):
    """One row per distinct part of a delimited text column."""

    column: str = ""
    out: str = ""

    def declared(self) -> list[str]:
        return [self.pk, self.out]


@dataclass(frozen=True)
class OptionDimension(Table):
    """One row per option-set code."""

    option_set: str = ""
    label: str = ""
    code: str = "option_code"

    def declared(self) -> list[str]:
        return [self.pk, self.label, self.code]


@dataclass(frozen=True)
class DateDimension(Table):
    first_year: int = 0
    last_year: int = 0

    def declared(self) -> list[str]:
        return [self.pk, "full_date", "year", "quarter"]


@dataclass(frozen=True)
class Fact(Table):
    """One row per source row; with ``infill``, a copy for every reporting year it spans."""

    infill: bool = False


@dataclass(frozen=True)
class Bridge(Table):
    """One row per source row whose keys all resolve."""


@dataclass(frozen=True)
class DelimitedBridge(Table):
    """One row per source row and part of its delimited column; ``columns`` has two keys,
    the second of which is looked up by the part."""

    column: str = ""


@dataclass(frozen=True)
class Branch:
    """One source of a union bridge. ``country`` says how the country column is read:
    "id", "name", "label" (of ``option_set``) or "locations" (free text)."""

    table: str
    entity: str
    country_column: str
    country: str
    option_set: str | None = None
    constants: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class CountryBridge(Table):
    """Entity and country pairs from several sources, without repeats."""

    entity_key: str = ""
    entity_table: str = ""
    constants: tuple[str, ...] = ()
    branches: tuple[Branch, ...] = ()

    def declared(self) -> list[str]:
        return [self.entity_key, "country_key", *self.constants]
