"""The periodic loads: stage, fact, dimensions, checks, and only then publication.

A load writes its tables under a version of its own and checks them there. If a check finds bad
rows it raises and the published tables stay as they were; otherwise the version becomes
the current one, by one small row appended to the list of versions. Readers take the last.
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar import contracts as c
from lakestar.operators import quality
from lakestar.operators.upsert import from_state
from lakestar.plans import lodging, music
from lakestar.sources.files import read_table, stage
from lakestar.sources.sinks import write_clustered, write_table


def run_load(
    raw_events: DataFrame, raw_songs: DataFrame, root: str, how: str = "left", resolution: str = "millis",
    strict: bool = True,
) -> dict[str, DataFrame]:
    """Load the star from raw events and songs; returns the written tables and the ``findings``.

    Raw rows are staged once as typed parquet; every table then scans only the
    columns it uses. Running the load again publishes the same tables again. Bad rows
    raise ``QualityError`` before anything is published; with ``strict=False`` they are only
    reported. The cadence is the caller's.
    """
    spark: SparkSession = raw_events.sparkSession
    version = new_version()
    events = stage(raw_events, c.STAGING_EVENTS, f"{root}/{version}/staging_events")
    songs = stage(raw_songs, c.STAGING_SONGS, f"{root}/{version}/staging_songs")
    users = from_state(music.user_state(events, ["ts", "session_id", "item_in_session"]), ["user_id"], c.USERS.columns)
    built = {
        c.SONGPLAYS: music.songplays(events, songs, how, ambiguous="first", resolution=resolution),
        c.USERS: users,
        c.SONGS: music.songs(songs),
        c.ARTISTS: music.artists(songs),
        c.TIME: music.time_dimension(events, resolution),
    }
    return _publish(spark, _write_and_check(spark, built, f"{root}/{version}"), root, version, strict)


QUESTION_TABLES = (c.SESSION_ITEM, c.USER_SESSION, c.USER_SONG)


def run_question_load(
    raw_events: DataFrame, root: str, order: list[str] | None = None, strict: bool = True,
    layouts: tuple[c.Contract, ...] = QUESTION_TABLES,
) -> dict[str, DataFrame]:
    """Load the one-table-per-question layouts, each clustered by its key, so that a point lookup reads little."""
    spark: SparkSession = raw_events.sparkSession
    version = new_version()
    tables, findings = {}, []
    for contract in layouts:
        df = music.question_table(raw_events, contract, order or ["ts"])
        write_clustered(df, contract, f"{root}/{version}/{contract.name}")
        tables[contract.name] = read_table(spark, f"{root}/{version}/{contract.name}", contract)
        findings += [quality.not_empty(tables[contract.name], contract.name), quality.contract_findings(tables[contract.name], contract)]
    return _publish(spark, {**tables, "findings": reduce(DataFrame.unionByName, findings)}, root, version, strict)


def run_lodging_load(
    detailed: DataFrame, summary: DataFrame, raw_calendar: DataFrame, raw_neighbourhoods: DataFrame,
    raw_reviews: DataFrame, root: str, strict: bool = True,
) -> dict[str, DataFrame]:
    """Load the lodging tables from their files; returns the written tables and the ``findings``.

    The bookings fact is built from the written dimensions, not from the raw files again.
    Checks and publication are those of ``run_load``.
    """
    spark: SparkSession = detailed.sparkSession
    version = new_version()
    place = f"{root}/{version}"
    dimensions = {
        c.LISTING: lodging.listing(detailed, summary),
        c.CALENDAR: lodging.calendar(raw_calendar),
        c.NEIGHBOURHOODS: lodging.neighbourhoods(raw_neighbourhoods),
        c.REVIEWS: lodging.reviews(raw_reviews),
    }
    tables = _write_and_check(spark, dimensions, place)
    fact = {c.BOOKINGS: lodging.bookings(tables["calendar"], tables["listing"], tables["reviews"])}
    bookings = _write_and_check(spark, fact, place)
    findings = tables.pop("findings").unionByName(bookings.pop("findings"))
    return _publish(spark, {**tables, **bookings, "findings": findings}, root, version, strict)


def new_version() -> str:
    """A folder name that sorts by time."""
    return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _publish(spark: SparkSession, built: dict[str, DataFrame], root: str, version: str, strict: bool) -> dict[str, DataFrame]:
    """Evaluate the findings once, stop on bad rows, then make the version the current one."""
    rows = built["findings"].collect()  # a row per check
    findings = spark.createDataFrame(rows, built["findings"].schema)
    if strict:
        quality.assert_clean(findings)
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").parquet(f"{root}/published")
    return {**built, "findings": findings}


def published(spark: SparkSession, root: str, contract: c.Contract) -> DataFrame:
    """A table of the version published last."""
    version = spark.read.parquet(f"{root}/published").agg(F.max("version")).first()[0]
    return read_table(spark, f"{root}/{version}/{contract.name}", contract)


def _write_and_check(spark: SparkSession, built: dict[c.Contract, DataFrame], root: str) -> dict[str, DataFrame]:
    tables, written = {}, {}
    for contract, df in built.items():
        written[contract.name] = write_table(df, contract, f"{root}/{contract.name}")
        tables[contract.name] = read_table(spark, f"{root}/{contract.name}", contract)
    return {**tables, "findings": check_tables(list(built), tables, written)}


def check_tables(contracts: list[c.Contract], tables: dict[str, DataFrame], written: dict[str, int]) -> DataFrame:
    """Row parity, emptiness, contract and reference checks over written tables."""
    findings = []
    for contract in contracts:
        table = tables[contract.name]
        findings.append(quality.row_parity(written[contract.name], table, contract.name))
        findings += [quality.not_empty(table, contract.name), quality.contract_findings(table, contract)]
        for column, (parent, parent_column) in contract.references.items():
            findings.append(quality.references(table, column, tables[parent], parent_column, contract.name))
    return reduce(DataFrame.unionByName, findings)
