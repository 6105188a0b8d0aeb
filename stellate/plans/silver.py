"""Raw layer to clean layer: one function per registered table, generic cleanup for the rest."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.config import candidates as candidate_values
from stellate.config import developers as developer_values
from stellate.config import diseases as disease_values
from stellate.config import optionsets
from stellate.config import priorities as priority_values
from stellate.config import trials as trial_values
from stellate.functions import classify, codes, text
from stellate.operators import cleanup
from stellate.operators.cleanup import col
from stellate.operators.lookups import left_enrich, lookup_name, resolve_country
from stellate.operators.temporal import YearlyGroup, scd2_expand
from stellate.sources.layers import Layer, nan_to_null

Frames = Mapping[str, DataFrame]
Cleaned = tuple[DataFrame, dict[str, DataFrame]]
# How a job gets rid of columns without values: at once, or when its table is written.
Drop = Callable[..., DataFrame]

ROW_ID, SOURCE_ROW_ID = "row_id", "source_row_id"
VALIDITY = ("valid_from", "valid_to")


def keep_row_order(df: DataFrame) -> DataFrame:
    """The raw row number survives as ``source_row_id``: it decides which row is the last one."""
    return cleanup.rename_columns(df, {ROW_ID: SOURCE_ROW_ID})


def trimmed(
    df: DataFrame, dropped, renamed, preserve=("valid_to",), drop: Drop = cleanup.drop_empty_columns
) -> DataFrame:
    df = keep_row_order(df) if ROW_ID in dropped else df
    df = cleanup.drop_columns(df, dropped)
    df = drop(df, preserve, into={c: [n] for c, n in renamed.items()})
    return cleanup.rename_columns(df, renamed)


def removed_codes(option_sets: Frames, removed: Mapping[str, list[int]]) -> dict[str, DataFrame]:
    return {
        name: cleanup.drop_codes(option_sets[name], gone)
        for name, gone in removed.items()
        if name in option_sets
    }


def normalize_inclusion(df: DataFrame) -> DataFrame:
    """All yearly inclusion columns as codes; a yes of 2019 overrules a no of 2021."""
    v = candidate_values
    df = cleanup.update_columns(
        df,
        {c: codes.map_strict(col(c), v.INCLUSION_ANSWERS) for c in v.INCLUSION_ANSWER_COLUMNS},
    )
    df = cleanup.replace_codes(df, "new_2024includeinpipeline", v.INCLUSION_CODES_2024)
    first, second = "vin_2019pcrpipelineinclusion", "new_includeinpipeline2021"
    if first in df.columns and second in df.columns:
        code = codes.as_code(col(second))
        overruled = (col(first) == v.INCLUDED) & (code == v.EXCLUDED)
        df = df.withColumn(second, codes.override_when(code, overruled, v.INCLUDED))
    return df


def standardize_stage(c):
    """Mapped stage; otherwise the text before the product suffix, mapped again."""
    mapped = codes.replace_values(c, candidate_values.STAGES)
    return codes.replace_values(text.before_first(mapped), candidate_values.STAGES)


def candidates(
    df: DataFrame, option_sets: Frames = {}, lookups: Frames = {}, drop: Drop = cleanup.drop_empty_columns
) -> Cleaned:
    v = candidate_values
    df = cleanup.keep_active(df)
    # Every row survives the expansion, so columns that pass through it are checked before it.
    yearly = [*v.STAGE_BY_YEAR, *v.INCLUSION_BY_YEAR, v.STAGE_ID_2025]
    dropped = [c for c in v.DROPPED if c not in yearly]
    df = cleanup.drop_columns(keep_row_order(df), [*dropped, *VALIDITY])
    df = normalize_inclusion(drop(df, preserve=yearly, into={c: [n] for c, n in v.RENAMED.items()}))
    histories = [
        YearlyGroup("new_currentrdstage", v.STAGE_BY_YEAR),
        YearlyGroup("includeinpipeline", v.INCLUSION_BY_YEAR, "bigint"),
    ]
    unsure = [h.out for h in histories]
    if drop is cleanup.drop_empty_columns:
        # A history has a value if any of its yearly columns has one. Only a history without any needs
        # a look behind the lookup of 2025.
        direct = [c for h in histories for c in h.dates if c in df.columns]
        empty = set(cleanup.empty_columns(df, among=direct))
        unsure = [h.out for h in histories if empty.issuperset(c for c in h.dates if c in direct)]
    if "vin_rdstageproducts" in lookups and v.STAGE_ID_2025 in df.columns:
        df = lookup_name(
            df,
            col(v.STAGE_ID_2025),
            lookups["vin_rdstageproducts"],
            "vin_rdstageproductid",
            text.before_last(F.col("vin_name")),
            "stage_2025",
        )
    df = scd2_expand(df.drop(v.STAGE_ID_2025), histories)
    df = drop(df, among=unsure, into={"includeinpipeline": ["includeinpipeline", "include_in_pipeline"]})
    df = cleanup.update_columns(
        df, {"new_ctregistrylink": text.registry_link(col("new_ctregistrylink"))}
    )
    df = cleanup.rename_columns(df, v.RENAMED)
    df = cleanup.update_columns(
        df,
        {
            "new_currentrdstage": standardize_stage(col("new_currentrdstage")),
            "pressuretype": codes.replace_values(col("pressuretype"), v.PRESSURE_TYPES),
            "product": codes.replace_values(col("product"), v.PRODUCT_TYPES),
        },
    )
    for name, mapping in {
        "approvalstatus": v.APPROVAL_STATUS_CODES,
        "approvingauthority": v.APPROVING_AUTHORITY_CODES,
        "indicationtype": v.INDICATION_TYPE_CODES,
        "preclinicalresultsstatus": v.PRECLINICAL_RESULT_CODES,
    }.items():
        df = cleanup.replace_codes(df, name, mapping)
    if "includeinpipeline" in df.columns:
        flag = codes.member_flag(col("includeinpipeline"), [v.INCLUDED])
        df = df.withColumn("include_in_pipeline", flag)
    return df, removed_codes(option_sets, v.OPTION_CODES_REMOVED)


def clinical_trials(
    df: DataFrame, option_sets: Frames = {}, lookups: Frames = {}, drop: Drop = cleanup.drop_empty_columns
) -> Cleaned:
    v = trial_values
    # These labels are never NULL, so their columns stay even when the source has no value.
    labelled = ("vin_ctphase", "new_age", "new_sex")
    into = {c: [n] for c, n in v.RENAMED.items()}
    df = drop(cleanup.drop_columns(keep_row_order(df) if ROW_ID in v.DROPPED else df, v.DROPPED), ("valid_to", *labelled), into=into)
    df = classify.apply(
        df,
        {
            "vin_ctphase": classify.phase,
            "new_age": classify.age_group,
            "new_sex": classify.sex,
            "new_studytype": classify.study_type,
        },
    )
    df = cleanup.replace_codes(df, "vin_ctstatus", v.STATUS_CODES)
    df = cleanup.rename_columns(df, v.RENAMED)
    return df, removed_codes(option_sets, v.OPTION_CODES_REMOVED)


def diseases(
    df: DataFrame, option_sets: Frames = {}, lookups: Frames = {}, drop: Drop = cleanup.drop_empty_columns
) -> Cleaned:
    v = disease_values
    df = trimmed(df, v.DROPPED, v.RENAMED, drop=drop)
    primary, secondary = "disease_filter", "secondary_disease_name"
    df = cleanup.update_columns(
        df,
        {
            primary: text.strip(col(primary)),
            secondary: text.sentinel_to_null(text.strip(col(secondary)), v.NO_SECONDARY),
        },
    )
    if primary in df.columns and secondary in df.columns:
        df = df.withColumn(primary, text.collapse_to_parent(col(primary), col(secondary)))
    areas = {
        name: cleanup.relabel(frame, v.HEALTH_AREA_LABELS)
        for name, frame in option_sets.items()
        if name == v.HEALTH_AREA_OPTIONS
    }
    return df, areas


def priorities(
    df: DataFrame, option_sets: Frames = {}, lookups: Frames = {}, drop: Drop = cleanup.drop_empty_columns
) -> Cleaned:
    v = priority_values
    return cleanup.replace_values(trimmed(df, v.DROPPED, v.RENAMED, drop=drop), "author", v.AUTHORS), {}


def developers(
    df: DataFrame, option_sets: Frames = {}, lookups: Frames = {}, drop: Drop = cleanup.drop_empty_columns
) -> Cleaned:
    v = developer_values
    if "accounts" not in lookups or "vin_countries" not in lookups:
        return trimmed(df, v.DROPPED, v.RENAMED, drop=drop), {}
    # Raw columns are settled before any join; countries are resolved on the few accounts, so the
    # developers themselves are joined once.
    source = "__account"
    df = df.withColumn(source, cleanup.col_or_null(df, "_vin_developer_value"))
    df = trimmed(df, v.DROPPED, v.RENAMED, preserve=("valid_to", source), drop=drop)
    accounts = lookups["accounts"]
    accounts = accounts.select(
        col("accountid"),
        cleanup.col_or_null(accounts, "name").alias("org_name"),
        text.numeric_text_to_null(
            cleanup.col_or_null(accounts, "vin_organisationtype").cast("string")
        ).alias("org_type"),
        cleanup.col_or_null(accounts, "address1_country").alias("__country"),
    )
    accounts = resolve_country(accounts, col("__country"), lookups["vin_countries"], "country_name")
    added = ["org_name", "org_type", "country_name"]
    df = left_enrich(df, col(source), accounts, "accountid", {c: c for c in added}).drop(source)
    return drop(df, among=added), {}


@dataclass(frozen=True)
class Registered:
    transform: Callable[..., Cleaned]
    option_sets: tuple[str, ...] = ()
    lookups: tuple[str, ...] = ()


REGISTRY = {
    "vin_candidates": Registered(
        candidates, tuple(candidate_values.OPTION_CODES_REMOVED), ("vin_rdstageproducts",)
    ),
    "vin_clinicaltrials": Registered(clinical_trials, tuple(trial_values.OPTION_CODES_REMOVED)),
    "vin_diseases": Registered(diseases, (disease_values.HEALTH_AREA_OPTIONS,)),
    "vin_rdpriorities": Registered(priorities),
    "vin_developers": Registered(developers, (), ("accounts", "vin_countries")),
}


def clean_layer(
    spark: SparkSession, raw_folder: str, clean_folder: str, parallel: int = 4
) -> list[str]:
    """Build the clean layer from the raw one and return the names of the tables written.

    Empty data tables are skipped. Option sets are copied, or replaced by the version a
    registered table cleaned, and get their clean-layer name. A table is read once, to write it: its
    rows and the values of its columns are counted on the way, and an empty table or column is left
    out of the layer. Readers see the new layer when all tables stand; errors are raised and leave the
    layer as it was.
    """
    raw, clean = Layer(spark, raw_folder), Layer(spark, clean_folder)
    data_tables, option_sets = raw.data_tables(), raw.option_sets()
    with clean.rebuild() as run, ThreadPoolExecutor(parallel) as pool:

        def clean_data(table: str) -> dict[str, DataFrame] | None:
            df, counted = nan_to_null(raw.read(table)), cleanup.EmptyWhenWritten()
            entry, sets = REGISTRY.get(table), {}
            if entry is None:
                df = cleanup.clean_table(df, preserve=VALIDITY, drop=counted)
            else:
                option_frames, lookups = raw.read_optional(entry.option_sets), raw.read_optional(entry.lookups)
                df, sets = entry.transform(df, option_frames, lookups, counted)
                df = cleanup.cast_codes(df, optionsets.CODE_COLUMNS)
            run.write(table, df)
            run.leave_out(table, counted.left_out())
            if not counted.rows:
                run.forget(table)
                return None
            return sets

        results = dict(zip(data_tables, pool.map(clean_data, data_tables)))
        written = [t for t, sets in results.items() if sets is not None]
        cleaned = {n: df for sets in results.values() for n, df in (sets or {}).items()}

        def copy_options(table: str) -> str:
            name = optionsets.RENAMED_TABLES.get(table, table)
            run.write(name, cleaned[table] if table in cleaned else raw.read(table))
            return name

        return written + list(pool.map(copy_options, option_sets))
