"""Clean layer to star schema."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass, field

from threading import BoundedSemaphore, Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from stellate.config.optionsets import PREFIX
from stellate.functions import codes
from stellate.operators import bridges, contract, dimensions, keys, lookups, quality, temporal
from stellate.operators.cleanup import col, col_or_null
from stellate.operators.joins import left_lookup
from stellate.plans import spec as kinds
from stellate.plans import star_map
from stellate.plans.silver import ROW_ID, SOURCE_ROW_ID
from stellate.sources.layers import Layer, row_counts
from stellate.sources.staging import stage, staging_run

# Facts and bridges written at once: each fills the executors by itself, and the shuffles of all that run are on disk.
LARGE_AT_ONCE = 2

METADATA = "_etl_metadata"
SYNC_LOG = "_sync_log"
# Source columns that give the load order, as far as a table has them.
ORDER = (SOURCE_ROW_ID, ROW_ID, "valid_from")


@dataclass
class Star:
    """Reads source tables, saves finished ones and remembers both for later tables.

    ``source`` gives a clean-layer table or None; ``save`` writes a finished table and returns
    a reader of it. ``stored`` says of which source tables the frame reads Parquet files as they are.
    """

    spark: SparkSession
    source: Callable[[str], DataFrame | None]
    save: Callable[[str, DataFrame], DataFrame]
    iso: DataFrame | None = None
    stored: Callable[[str], bool] = lambda name: False
    done: dict[str, DataFrame] = field(default_factory=dict)
    # Distinct dimensions with the source columns they came from.
    combinations: dict[str, DataFrame] = field(default_factory=dict)
    # Written key maps: one aggregate for all tables that look a dimension up.
    key_maps: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    locks: dict[tuple[str, str], Lock] = field(default_factory=dict)

    def option_set(self, name: str) -> DataFrame | None:
        return self.source(PREFIX + name)

    def key_map(self, name: str, natural: str | None = None) -> tuple[DataFrame, str]:
        """The key map of a finished dimension, written when it is first asked for."""
        table = star_map.TABLES[name]
        wanted = (name, natural or table.natural)
        with self.locks.setdefault(wanted, Lock()):
            if wanted not in self.key_maps:
                self.key_maps[wanted] = stage(keys.key_map(self.done[name], wanted[1], table.pk), f"keys-{name}")
        return self.key_maps[wanted], wanted[1]

    def located(self, table: kinds.Table, df: DataFrame) -> DataFrame:
        """The table's source with the places of its rows; written first if it is not stored as it is."""
        if not self.stored(table.source):
            df = stage(needed(df, table), table.source)
        return keys.with_location(df)


def source_columns(columns: Iterable[kinds.ColumnSpec]) -> list[str]:
    """Source columns that the described columns are made from."""
    names: list[str] = []
    for c in columns:
        match c:
            case kinds.Calc():
                names.extend(c.columns)
            case kinds.CompositeFk(dimension):
                names.extend(source_columns(star_map.TABLES[dimension].columns.values()))
            case kinds.ViaFact():
                pass
            case _:
                names.append(c.column)
    return list(dict.fromkeys(names))


def evaluate(
    star: Star, df: DataFrame, columns: Mapping[str, kinds.ColumnSpec], keep: Mapping[str, Column]
) -> DataFrame:
    """The described columns, plus the kept ones.

    One projection computes all plain columns and the probes of all lookups, so nothing but
    needed columns enters the joins; then each lookup is one left join.
    """

    def get(name: str) -> Column:
        return col_or_null(df, name)

    plain: dict[str, Column] = dict(keep)
    lookups_left: dict[str, kinds.ColumnSpec] = {}
    for out, c in columns.items():
        match c:
            case kinds.Source(column):
                plain[out] = get(column)
            case kinds.Calc(build):
                plain[out] = build(get)
            case kinds.CompositeFk(dimension):
                used = source_columns(star_map.TABLES[dimension].columns.values())
                plain.update({f"__{out}_{n}": get(n) for n in used})
                lookups_left[out] = c
            case kinds.Label(column) | kinds.Iso(column) | kinds.Fk(_, column):
                if column not in df.columns:
                    plain[out] = F.lit(None)
                    continue
                probe = get(column)
                if isinstance(c, kinds.Label):
                    probe = lookups.option_code(df, column)
                elif isinstance(c, kinds.Fk) and c.derive:
                    probe = c.derive(probe)
                plain[f"__{out}"] = probe
                lookups_left[out] = c
    result = df.select(*(c.alias(n) for n, c in plain.items()))

    for out, c in lookups_left.items():
        probe = col(f"__{out}")
        match c:
            case kinds.Label(column, option_set):
                labels = star.option_set(option_set or column)
                result = lookups.option_label(result, f"__{out}", labels, out)
            case kinds.Iso():
                result = lookups.iso_code(result, probe, out, star.iso)
            case kinds.Fk(dimension):
                key_map, natural = star.key_map(dimension)
                pk = star_map.TABLES[dimension].pk
                result = left_lookup(result, probe, key_map.withColumnRenamed(pk, out), natural)
            case kinds.CompositeFk(dimension):
                result = composite_key(star, result, dimension, out)
    via = {out: c for out, c in columns.items() if isinstance(c, kinds.ViaFact)}
    for fact, key in {(c.fact, c.key) for c in via.values()}:
        outs = [out for out, c in via.items() if (c.fact, c.key) == (fact, key)]
        pk = star_map.TABLES[fact].pk
        result = keys.fk_via_fact(result, star.done[fact], key, outs, pk)
    return result.select(*(col(n) for n in (*keep, *columns)))


def composite_key(star: Star, df: DataFrame, dimension: str, out: str) -> DataFrame:
    """Key of a distinct dimension. Several source combinations can give the same values; the
    last of them wins. That is settled among the dimension's rows, so the wide side is joined
    once, by its source columns, whatever number of labels the dimension has."""
    table = star_map.TABLES[dimension]
    rows = star.combinations[dimension]
    sources = source_columns(table.columns.values())
    values = {c: col(c) for c in table.columns}
    settled = keys.fk_composite(rows.drop(table.pk), values, rows, table.pk, out)
    right = settled.select(out, *(col(f"__source_{n}").alias(f"__match_{n}") for n in sources))
    condition = F.lit(True)
    for n in sources:
        condition = condition & col(f"__{out}_{n}").eqNullSafe(col(f"__match_{n}"))
    return df.join(right, condition, "left").drop(*(f"__match_{n}" for n in sources))


def numbered(df: DataFrame, table: kinds.Table, extra: Sequence[str] = ()) -> DataFrame:
    """The source columns the table needs, with its key in load order; a hash settles ties.

    Rows are numbered before they meet the lookups: what is sorted and written is narrow, and
    the joins run once.
    """
    order = [c for c in (*ORDER, *extra) if c in df.columns]
    needed = dict.fromkeys((*order, *extra, *source_columns(table.columns.values())))
    narrow = df.select(*(col(c) for c in needed if c in df.columns))
    tied = narrow.withColumn("__tie", F.xxhash64(*(f"`{c}`" for c in narrow.columns)))
    return keys.surrogate_key(tied, table.pk, [*order, "__tie"])


def needed(df: DataFrame, table: kinds.Table) -> DataFrame:
    """The source columns that the order and the columns of a table are made from."""
    names = dict.fromkeys((*ORDER, "valid_from", "valid_to", *source_columns(table.columns.values())))
    return df.select(*(col(c) for c in names if c in df.columns))


def wide_columns(df: DataFrame, columns: Mapping[str, kinds.ColumnSpec]) -> dict[str, kinds.ColumnSpec]:
    """Columns that are only copied or computed from one row, and hold or read texts."""
    text = {f.name for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))}
    plain = {n: c for n, c in columns.items() if isinstance(c, (kinds.Source, kinds.Calc))}
    return {n: c for n, c in plain.items() if text.intersection(source_columns([c]))}


def rows_in_place(
    star: Star,
    table: kinds.Table,
    located: DataFrame,
    columns: Mapping[str, kinds.ColumnSpec],
    expand: Callable[[DataFrame], DataFrame] = lambda df: df,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Rows of a table with its key in load order, without moving its texts.

    What is ranged, sorted, written and joined has the order, the sources of the lookups and the place
    of the row. The texts stay in the files and come in at the end, by the place. ``expand`` may
    repeat rows; ``extra`` names the columns that tell the copies apart.
    """
    wide = wide_columns(located, columns)
    narrow = {n: c for n, c in columns.items() if n not in wide}
    rows = expand(located)
    order = [c for c in (*ORDER, *extra) if c in rows.columns]
    places = (keys.FILE, keys.ROW)
    used = dict.fromkeys((*order, *extra, *source_columns(narrow.values()), *places))
    keyed = keys.surrogate_key(rows.select(*(col(c) for c in used if c in rows.columns)), table.pk, [*order, *places])
    kept = {c: col(c) for c in (table.pk, *places)}
    found = evaluate(star, keyed, narrow, kept)
    values = {n: evaluate_plain(located, c).alias(n) for n, c in wide.items()}
    # The lookups keep every row, so the rows are counted before them.
    return keys.attach_stored(found, located, values, keyed.count()).select(col(table.pk), *(col(n) for n in columns))


def evaluate_plain(df: DataFrame, spec: kinds.Source | kinds.Calc) -> Column:
    match spec:
        case kinds.Source(column):
            return col_or_null(df, column)
        case kinds.Calc(build):
            return build(lambda name: col_or_null(df, name))


def dimension_rows(star: Star, table: kinds.Dimension, df: DataFrame) -> DataFrame:
    if wide_columns(df, table.columns):
        return rows_in_place(star, table, star.located(table, df), table.columns)
    return evaluate(star, numbered(df, table), table.columns, {table.pk: col(table.pk)})


def distinct_dimension_rows(
    star: Star, table: kinds.DistinctDimension, df: DataFrame
) -> DataFrame:
    sources = source_columns(table.columns.values())
    combinations = dimensions.distinct_rows(df, sources)
    kept = {f"__source_{n}": col(n) for n in sources}
    rows = evaluate(star, combinations, table.columns, kept)
    keyed = keys.surrogate_key(rows, table.pk, [*table.columns, *kept])
    star.combinations[table.name] = keyed
    return keyed


def phase_dimension_rows(star: Star, table: kinds.PhaseDimension, df: DataFrame) -> DataFrame:
    source, column = table.referenced_in
    named = star.source(source)
    if named is None:
        return contract.empty_table(star.spark, table.declared())
    referenced = dimensions.referenced_values(named, column, "phase_name")
    order = [c for c in ORDER if c in df.columns] or ["vin_rdstageid"]
    rows = dimensions.phase_rows(df, referenced, "vin_rdstageid", "vin_name", order)
    return keys.surrogate_key(rows, table.pk, ["sort_order", "phase_name"])


def fact_rows(star: Star, table: kinds.Fact, df: DataFrame) -> DataFrame:
    columns = dict(table.columns)
    if not table.infill:
        if not wide_columns(df, columns):
            return evaluate(star, numbered(df, table), columns, {table.pk: col(table.pk)})
        return rows_in_place(star, table, star.located(table, df), columns)
    # Originals and copies carry one date, so the date dimension is joined once for both.
    date = columns["date_key"]
    columns["is_active_flag"] = kinds.Source("__active")
    columns["date_key"] = kinds.Fk(date.dimension, "__date")
    extra = ["__year", "__active", "__date"]

    def expand(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({c: col_or_null(rows, c) for c in ("valid_from", "valid_to")})
        rows = rows.withColumn("__active", codes.is_null_flag(col("valid_to")))
        rows = temporal.year_infill(rows, flag="__active", out="__year")
        first_day = F.concat(F.col("__year").cast("string"), F.lit("-01-01"))
        return rows.withColumn("__date", F.coalesce(first_day, date.derive(col("valid_from"))))

    if not wide_columns(df, columns):
        return evaluate(star, numbered(expand(df), table, extra), columns, {table.pk: col(table.pk)})
    return rows_in_place(star, table, star.located(table, df), columns, expand, extra)


def bridge_keys(star: Star, table: kinds.Table) -> dict[str, tuple[str, DataFrame, str]]:
    return {out: (c.column, *star.key_map(c.dimension)) for out, c in table.columns.items()}


def country_branch(star: Star, table: kinds.CountryBridge, branch: kinds.Branch) -> DataFrame:
    df = star.source(branch.table)
    if df is None or branch.entity not in df.columns or branch.country_column not in df.columns:
        return contract.empty_table(star.spark, table.declared())
    entity = (branch.entity, *star.key_map(table.entity_table))
    geography = star.done["dim_geography"]
    by_name = star.key_map("dim_geography", "country_name")
    match branch.country:
        case "locations":
            df = lookups.parse_locations(
                df, branch.entity, col(branch.country_column), geography,
                "country_key", "country_name",
            )
            keyed = bridges.attach_key(df, *entity, table.entity_key)
            return keyed.select(table.entity_key, "country_key")
        case "id":
            country = (branch.country_column, *star.key_map("dim_geography"))
        case "name":
            country = (branch.country_column, *by_name)
        case "label":
            options = star.option_set(branch.option_set)
            if options is None:
                return contract.empty_table(star.spark, table.declared())
            by_code = bridges.attach_key(
                lookups.option_labels(options), "label", *by_name, "country_key"
            ).select("code", "country_key")
            df = df.select(
                col(branch.entity), lookups.option_code(df, branch.country_column).alias("__code")
            )
            country = ("__code", by_code, "code")
    pairs = {table.entity_key: entity, "country_key": country}
    return bridges.bridge(df, pairs, branch.constants, distinct=True)


def table_rows(star: Star, table: kinds.Table) -> DataFrame:
    """Rows of one star table; without its source table, an empty one."""
    match table:
        case kinds.DateDimension():
            days = temporal.date_dimension(star.spark, table.first_year, table.last_year)
            return keys.surrogate_key(days, table.pk, ["full_date"], bounded=True)
        case kinds.OptionDimension():
            df = star.option_set(table.option_set)
        case kinds.CountryBridge():
            return bridges.union_bridge(
                [country_branch(star, table, branch) for branch in table.branches]
            )
        case _:
            df = star.source(table.source)
    if df is None:
        return contract.empty_table(star.spark, table.declared())
    match table:
        case kinds.OptionDimension():
            rows = dimensions.option_rows(df, table.label, table.code)
            return keys.surrogate_key(rows, table.pk, [table.code])
        case kinds.DelimitedDimension():
            rows = dimensions.delimited_values(df, table.column, table.out)
            return keys.surrogate_key(rows, table.pk, [table.out])
        case kinds.DistinctDimension():
            return distinct_dimension_rows(star, table, df)
        case kinds.PhaseDimension():
            return phase_dimension_rows(star, table, df)
        case kinds.Fact():
            return fact_rows(star, table, df)
        case kinds.Bridge():
            return bridges.bridge(df, bridge_keys(star, table))
        case kinds.DelimitedBridge():
            pairs = bridge_keys(star, table)
            entity, part = ((out, *source) for out, source in pairs.items())
            return bridges.delimited_bridge(df, entity, part)
    return dimension_rows(star, table, df)


def needs(table: kinds.Table) -> set[str]:
    """Tables that must be finished before this one."""
    needed = set()
    for c in table.columns.values():
        if isinstance(c, (kinds.Fk, kinds.CompositeFk)):
            needed.add(c.dimension)
        elif isinstance(c, kinds.ViaFact):
            needed.add(c.fact)
    if isinstance(table, kinds.CountryBridge):
        needed |= {table.entity_table, "dim_geography"}
    return needed


def build(
    star: Star, parallel: int = 6, only: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Build and save all tables, or the named ones, several at a time.

    Tables are listed after those they refer to, so each waits for tables that have started.
    """
    chosen = set(star_map.TABLES if only is None else only)
    started: dict[str, Future] = {}
    large = BoundedSemaphore(LARGE_AT_ONCE)

    def finish(table: kinds.Table) -> None:
        for name in needs(table):
            started[name].result()
        wide = isinstance(table, (kinds.Fact, kinds.Bridge, kinds.CountryBridge, kinds.DelimitedBridge))
        with large if wide else nullcontext():
            rows = contract.conform(table_rows(star, table), table.declared())
            star.done[table.name] = star.save(table.name, rows)

    with ThreadPoolExecutor(parallel) as pool:
        # Facts have the largest sources and wait for most tables, so their sources come first.
        for source in dict.fromkeys(t.source for n, t in star_map.TABLES.items() if n in chosen and isinstance(t, kinds.Fact)):
            pool.submit(star.source, source)
        for name, table in star_map.TABLES.items():
            if name in chosen:
                started[name] = pool.submit(finish, table)
        for result in started.values():
            result.result()
    return {name: star.done[name] for name in started}


@dataclass(frozen=True)
class StarReport:
    row_counts: DataFrame
    fk_integrity: DataFrame
    metadata: DataFrame


def star_layer(
    spark: SparkSession,
    clean_folder: str,
    star_folder: str | None = None,
    iso: DataFrame | None = None,
    parallel: int = 6,
) -> StarReport:
    """Build the star schema from a clean layer, next to it unless a folder is given.

    Returns the row counts, the foreign-key report and the metadata of the finished layer. Readers see
    the new star when all tables stand; a failed run leaves the old one.
    """
    clean = Layer(spark, clean_folder)
    layer = Layer(spark, star_folder or clean.beside("star"))
    if layer.same_place(clean):
        raise ValueError(f"the star layer would overwrite the clean layer {clean.folder}")
    tables = {name: clean.read(name) for name in clean.tables()}
    with layer.rebuild() as run:
        with staging_run(spark):
            done = build(Star(spark, tables.get, run.write, iso, tables.__contains__), parallel)
        log = tables.get(SYNC_LOG)
        if log is not None:
            entries = quality.last_sync(log).where("last_sync_date IS NOT NULL").select(
                F.lit("last_sync_date").alias("key"),
                F.col("last_sync_date").cast("string").alias("value"),
            )
        else:
            entries = spark.createDataFrame([], "key string, value string")
        metadata = run.write(METADATA, contract.metadata_upsert(None, entries))
    return StarReport(
        row_counts(done), quality.fk_integrity(done, star_map.foreign_keys()), metadata
    )
