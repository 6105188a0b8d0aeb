"""Column and row cleanup."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stellate.functions import codes, text

# Rows read first to settle most columns before the full pass of ``drop_empty_columns``.
PROBE_ROWS = 1000


def col(name: str) -> Column:
    """A column by its exact name, whatever characters the name has."""
    return F.col(f"`{name}`")


def col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column, or NULL when the table does not have it."""
    return col(name) if name in df.columns else F.lit(None).cast(dtype)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the named columns; absent names are ignored."""
    return df.drop(*names)


def empty_columns(
    df: DataFrame, preserve: Iterable[str] = (), among: Iterable[str] | None = None
) -> list[str]:
    """Columns without any value, of all columns or of the named ones.

    The NULL flags of a few rows settle nearly all columns, and reading them stops at the first
    partitions. Only columns that are NULL in all of those rows are counted over the whole table,
    so the full pass reads little more than empty column chunks.
    """
    checked = [c for c in df.columns if c not in set(preserve)]
    if among is not None:
        checked = [c for c in checked if c in set(among)]
    if not checked:
        return []
    flags = df.select(*(col(c).isNotNull().alias(str(i)) for i, c in enumerate(checked)))
    seen = [any(values) for values in zip(*flags.take(PROBE_ROWS))]
    undecided = [c for c, has_value in zip(checked, seen or [False] * len(checked)) if not has_value]
    if not undecided:
        return []
    counts = df.agg(*(F.count(col(c)).alias(str(i)) for i, c in enumerate(undecided))).first()
    return [c for c, n in zip(undecided, counts) if n == 0]


Into = Mapping[str, Iterable[str]]


def drop_empty_columns(
    df: DataFrame,
    preserve: Iterable[str] = (),
    among: Iterable[str] | None = None,
    into: Into | None = None,
) -> DataFrame:
    """Drop columns without any value. ``into`` only matters to ``EmptyWhenWritten``."""
    return df.drop(*empty_columns(df, preserve, among))


class EmptyWhenWritten:
    """Takes the place of ``drop_empty_columns`` in a job that writes its table anyway.

    No column is dropped and nothing is read beforehand. The values of each column are counted where
    the plan passes the call, while the table is written; afterwards ``left_out`` names the columns of
    the written table to leave out. ``into`` says what a column has become there: its new name, or all
    columns that are made from it and go with it.
    """

    def __init__(self) -> None:
        self.passed: list[tuple[Observation, list[str], dict[str, list[str]]]] = []

    def __call__(
        self,
        df: DataFrame,
        preserve: Iterable[str] = (),
        among: Iterable[str] | None = None,
        into: Into | None = None,
    ) -> DataFrame:
        checked = [c for c in df.columns if c not in set(preserve)]
        if among is not None:
            checked = [c for c in checked if c in set(among)]
        seen = Observation()
        counts = [F.count(col(c)).alias(f"c{i}") for i, c in enumerate(checked)]
        self.passed.append((seen, checked, {c: list(names) for c, names in (into or {}).items()}))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)

    @property
    def rows(self) -> int:
        """Rows of the first table that was passed."""
        return self.passed[0][0].get["rows"]

    def left_out(self) -> set[str]:
        gone: set[str] = set()
        for seen, checked, into in self.passed:
            found = seen.get
            for i, c in enumerate(checked):
                if not found[f"c{i}"]:
                    gone.update(into.get(c, [c]))
        return gone


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; unknown names are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    """Remove a prefix from every column name that starts with it."""
    return rename_columns(
        df, {c: c.removeprefix(prefix) for c in df.columns if c.startswith(prefix)}
    )


def update_columns(df: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """Replace the values of columns the table has; changes to absent columns are ignored."""
    return df.withColumns({n: c for n, c in changes.items() if n in df.columns})


def replace_values(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    return update_columns(df, {column: codes.replace_values(col(column), mapping)})


def replace_codes(df: DataFrame, column: str, mapping: Mapping[int, int]) -> DataFrame:
    """Replace known codes; other values stay, and so does the type of the column."""
    if column not in df.columns:
        return df
    kind = df.schema[column].dataType.simpleString()
    return update_columns(df, {column: codes.replace_codes(col(column), mapping, kind)})


def normalize_text(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Normalize whitespace in the named columns, or in every text column."""
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return update_columns(df, {c: text.normalize_whitespace(col(c)) for c in columns})


def cast_codes(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Cast option-set code columns to integers."""
    return update_columns(df, {c: codes.as_code(col(c)) for c in columns})


def keep_active(df: DataFrame, state: str = "statecode") -> DataFrame:
    """Keep rows in state 0; a table without the column keeps all rows."""
    return df.filter(col(state) == 0) if state in df.columns else df


def drop_codes(option_set: DataFrame, removed: Iterable[int], code: str = "code") -> DataFrame:
    """Remove option-set rows by code; rows without a code stay."""
    return option_set.filter(~codes.is_in(col(code), removed))


def relabel(option_set: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    return replace_values(option_set, "label", labels)


def clean_table(
    df: DataFrame,
    renames: Mapping[str, str] | None = None,
    values: Mapping[str, Mapping] | None = None,
    text_columns: Iterable[str] = (),
    preserve: Iterable[str] = ("valid_to",),
    drop: Callable[..., DataFrame] = drop_empty_columns,
) -> DataFrame:
    """Generic cleanup: empty columns, renames, whitespace, values - in that order."""
    df = drop(df, preserve, into={c: [n] for c, n in (renames or {}).items()})
    df = rename_columns(df, renames or {})
    df = normalize_text(df, text_columns)
    for column, mapping in (values or {}).items():
        df = replace_values(df, column, mapping)
    return df
