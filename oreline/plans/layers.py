"""Both subject areas from source files to checked gold tables.

Each layer reads what the one before has stored and writes to its own path, so a run can start
again at any layer and a lost executor costs one layer at most.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreline.operators.quality import ContractBroken, enforce_contract, row_count_contract
from oreline.operators.reshape import with_content_id, with_row_id
from oreline.plans import admissions, trips
from oreline.schemas import HOSPITAL_SCHEMA, REPORT_ROWS, TRIP_TEXT_SCHEMA
from oreline.sources.readers import CORRUPT_COLUMN, count_csv, read_csv, read_path, read_table
from oreline.sources.sinks import publish_all, register_view, write_all, write_json_records
from oreline.streaming.landing import (
    BATCH,
    append_new_files,
    batch_counts,
    batches,
    reload_files,
)


@dataclass(frozen=True)
class LayerConfig:
    """Where a subject area is read from and kept.

    ``expected`` adds row counts to the built-in rules, per table: a number, or a frame that must
    be as long. ``stable_ids`` gives admissions an id made from the row, equal in every run, at
    the price of a shuffle; by default it is a position. Either way the id is text. Source lines
    that do not fit the schema are kept as they came unless ``keep_corrupt`` is off: trips in a
    bronze column, admissions in ``bronze/corrupt``. ``max_files`` bounds the files that one
    batch takes from a landing folder, and ``archive`` is where files go once taken in. ``catalog`` names a database whose tables
    ``<catalog>.<layer>_<name>`` are kept instead of paths under ``base``.
    ``band_after_round`` and ``brief_gold`` give admissions as the scheduled job does: bills banded
    once rounded, and the shorter gold tables.
    """

    source: str
    base: str
    fmt: str = "parquet"
    stable_ids: bool = False
    keep_corrupt: bool = True
    max_files: int | None = None
    archive: str | None = None
    catalog: str | None = None
    band_after_round: bool = False
    brief_gold: bool = False
    expected: Mapping[str, int | DataFrame] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"


    def table(self, name: str) -> str:
        return f"{self.catalog}.{name.replace('/', '_')}"


# The landing table is fed file by file, so it is always kept by path.
_BY_PATH = ("bronze/trips",)


def _stored(spark: SparkSession, cfg: LayerConfig, table: str) -> DataFrame:
    if cfg.catalog and table not in _BY_PATH:
        return read_table(spark, cfg.table(table))
    return read_path(spark, cfg.path(table), cfg.fmt)


def _write(cfg: LayerConfig, layer: str, frames: Mapping[str, DataFrame]) -> dict[str, int]:
    named = {f"{layer}/{name}": df for name, df in frames.items()}
    if cfg.catalog:
        return publish_all(named, cfg.table, cfg.fmt)
    return write_all(named, cfg.base, cfg.fmt)


def register_views(
    spark: SparkSession, cfg: LayerConfig, tables: Sequence[str]
) -> dict[str, DataFrame]:
    """A session view ``<layer>_<name>`` of each stored table."""
    return {
        t: register_view(_stored(spark, cfg, t), t.replace("/", "_")) for t in tables
    }


def _checked(
    spark: SparkSession, cfg: LayerConfig, rules: Mapping[str, int | DataFrame]
) -> DataFrame:
    rules = {**rules, **cfg.expected}
    return row_count_contract({t: _stored(spark, cfg, t) for t in rules}, rules)


def _keys(stays: DataFrame, *columns: str, most: int | None = None) -> DataFrame:
    """Distinct keys of a gold table, as many as it must have rows."""
    keys = stays.select(*columns).distinct()
    return keys.limit(most) if most else keys


# Admissions


def admissions_bronze(spark: SparkSession, cfg: LayerConfig) -> dict[str, int]:
    """Source rows get their key once, in the bronze table ``keyed``; the others are cut from it.

    It holds what the two tables hold together, in the same place, and goes with them.
    """
    rows = read_csv(spark, cfg.source, HOSPITAL_SCHEMA, cfg.keep_corrupt)
    give_id = with_content_id if cfg.stable_ids else with_row_id
    key = F.col(admissions.KEY).cast("string")
    written = _write(cfg, "bronze", {"keyed": give_id(rows, admissions.KEY).withColumn(admissions.KEY, key)})
    keyed = _stored(spark, cfg, "bronze/keyed")
    frames = {
        "patients": admissions.bronze_patients(keyed),
        "admissions": admissions.bronze_admissions(keyed),
    }
    if cfg.keep_corrupt:
        broken = keyed.where(F.col(CORRUPT_COLUMN).isNotNull())
        frames["corrupt"] = broken.select(admissions.KEY, CORRUPT_COLUMN)
    return {**written, **_write(cfg, "bronze", frames)}


def admissions_silver(spark: SparkSession, cfg: LayerConfig) -> dict[str, int]:
    return _write(
        cfg,
        "silver",
        {
            "patients": admissions.silver_patients(_stored(spark, cfg, "bronze/patients")),
            "admissions": admissions.silver_admissions(
                _stored(spark, cfg, "bronze/admissions"), cfg.band_after_round
            ),
        },
    )


def admissions_gold(spark: SparkSession, cfg: LayerConfig) -> dict[str, int]:
    stays = _stored(spark, cfg, "silver/admissions")
    patients = _stored(spark, cfg, "silver/patients")
    gold = admissions.gold_tables(stays, patients)
    if cfg.brief_gold:
        gold = {name: admissions.brief(name, wide) for name, wide in gold.items()}
    return _write(cfg, "gold", gold)


def admissions_checks(spark: SparkSession, cfg: LayerConfig) -> DataFrame:
    """All nine tables: bronze against the source, silver against bronze, gold against its keys."""
    source = count_csv(spark, cfg.source, HOSPITAL_SCHEMA)
    stays = _stored(spark, cfg, "silver/admissions")
    rules: dict[str, int | DataFrame] = {
        "bronze/patients": source,
        "bronze/admissions": source,
        "silver/patients": _stored(spark, cfg, "bronze/patients"),
        "silver/admissions": _stored(spark, cfg, "bronze/admissions"),
        "gold/admission_summary": _keys(stays, "medical_condition", "admission_type"),
        "gold/hospital_revenue": _keys(stays, "hospital", most=REPORT_ROWS),
        "gold/doctor_performance": _keys(stays, "doctor", most=REPORT_ROWS),
        "gold/disease_trends": admissions.disease_keys(
            stays, _stored(spark, cfg, "silver/patients")
        ),
        "gold/insurance_analysis": _keys(stays, "insurance_provider"),
    }
    return _checked(spark, cfg, rules)


def run_admissions(spark: SparkSession, cfg: LayerConfig) -> dict[str, int]:
    """Bronze, silver, gold, checks, in that order. Rows per table; raises if a check fails."""
    rows = {
        **admissions_bronze(spark, cfg),
        **admissions_silver(spark, cfg),
        **admissions_gold(spark, cfg),
    }
    enforce_contract(admissions_checks(spark, cfg))
    return rows


# Trips


def _landing(cfg: LayerConfig) -> dict:
    return {
        "keep_corrupt": cfg.keep_corrupt,
        "fmt": cfg.fmt,
        "max_files": cfg.max_files,
        "archive": cfg.archive,
    }


def _bronze_rows(spark: SparkSession, cfg: LayerConfig) -> dict[str, int]:
    """Rows of bronze, its footers read; none before the first file."""
    if batches(spark, cfg.path("bronze/trips")).isEmpty():
        return {"bronze/trips": 0}
    return {"bronze/trips": _stored(spark, cfg, "bronze/trips").count()}


def trips_reload(spark: SparkSession, cfg: LayerConfig) -> dict[str, int]:
    """Bronze written anew from all source files, archived ones included; batches of other jobs and
    those whose files are gone stay. Later files are appended as before."""
    reload_files(spark, cfg.source, TRIP_TEXT_SCHEMA, cfg.path("bronze/trips"), **_landing(cfg))
    return _bronze_rows(spark, cfg)


def trips_bronze(spark: SparkSession, cfg: LayerConfig) -> dict[str, int]:
    """Source files not seen before are appended to bronze; stored rows stay as they are."""
    append_new_files(spark, cfg.source, TRIP_TEXT_SCHEMA, cfg.path("bronze/trips"), **_landing(cfg))
    return _bronze_rows(spark, cfg)


def trips_silver(spark: SparkSession, cfg: LayerConfig) -> dict[str, int]:
    """Silver rebuilt from all of bronze."""
    bronze = _stored(spark, cfg, "bronze/trips").drop(CORRUPT_COLUMN, BATCH)
    return _write(cfg, "silver", {"trips": trips.silver_trips(bronze)})


def trips_gold(spark: SparkSession, cfg: LayerConfig) -> dict[str, int]:
    return _write(cfg, "gold", trips.gold_tables(_stored(spark, cfg, "silver/trips")))


def trips_checks(spark: SparkSession, cfg: LayerConfig) -> DataFrame:
    """Bronze holds every row of its ledger, silver every bronze row, gold a row per key.

    The ledger knows the rows of each batch from the files it took, so nothing that has landed is
    read again, archived or not. A batch that is short raises, whatever another one has too much.
    """
    silver = _stored(spark, cfg, "silver/trips")
    counts = batch_counts(spark, cfg.path("bronze/trips"), cfg.fmt)
    held = counts.agg(F.sum("expected").alias("all"), F.sum("stored").alias("stored")).first()
    if held["all"] == held.stored:  # else the rule below says it
        wrong = counts.where("NOT ok").orderBy(BATCH).limit(20).collect()
        if wrong:
            said = "; ".join(f"{r[BATCH]}: {r.stored} rows, not {r.expected}" for r in wrong)
            raise ContractBroken(f"bronze/trips: {said}")
    bronze = _stored(spark, cfg, "bronze/trips")
    rules: dict[str, int | DataFrame] = {
        "silver/trips": bronze,
        **{f"gold/{name}": keys for name, keys in trips.gold_keys(silver).items()},
        "bronze/trips": held["all"],
    }
    return _checked(spark, cfg, rules)


def run_trips(spark: SparkSession, cfg: LayerConfig) -> dict[str, int]:
    """New files to bronze, then silver, gold, checks. Rows per table; raises if a check fails."""
    rows = {
        **trips_bronze(spark, cfg),
        **trips_silver(spark, cfg),
        **trips_gold(spark, cfg),
    }
    enforce_contract(trips_checks(spark, cfg))
    return rows


# Cleaning job


def clean_file(spark: SparkSession, source: str, target: str) -> DataFrame:
    """A delimited export cleaned and written as JSON records; the counts of before and after.

    Every column is read as text, so what cannot be read as a number is seen by the cleaning.
    """
    exported = spark.read.options(header="true", escape='"', ignoreLeadingWhiteSpace="false",
                                  ignoreTrailingWhiteSpace="false").csv(source)
    write_json_records(trips.clean_trips(exported), target)
    return trips.cleaning_counts(exported)
