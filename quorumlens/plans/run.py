"""One complete run: carry, score, merge, filter, cap, count."""

from __future__ import annotations

import re
import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlens.operators import carry, corroborate, documents, intervals, networks, reports, safety
from quorumlens.operators.corroborate import Rules
from quorumlens.sinks import publish, writers
from quorumlens.sources.reference_tables import require_complete_allowlist
from quorumlens.sources.registry import TIERS


@dataclass
class RunTables:
    """Inputs of a run.

    ``allow_sources`` names the configured allowlists (allow_source); ``allowed`` must have ``allow_source`` and a network
    of each.  State and labels may be absent on a first run.  With ``ranges``, networks are counted and their history goes
    on; ``status`` (source, status, records) says how the sources were read.
    """

    fresh: DataFrame
    sources: DataFrame
    allowed: DataFrame
    allow_sources: DataFrame
    state: DataFrame | None = None
    labels: DataFrame | None = None
    ranges: DataFrame | None = None
    status: DataFrame | None = None


@dataclass
class RunResult:
    """``name``: the run's folders (see sinks.publish).  ``watched``: observations collected and carried."""

    name: str
    observations: DataFrame
    judged: DataFrame
    published: DataFrame
    counts: DataFrame
    state: DataFrame
    manifest: DataFrame
    watched: dict[str, int]


def judge(
    observations: DataFrame,
    sources: DataFrame,
    allowed: DataFrame,
    as_of,
    state: DataFrame | None = None,
    labels: DataFrame | None = None,
    tiers: tuple[str, ...] = TIERS,
    rules: Rules = Rules(),
) -> DataFrame:
    """Scored rows of all tiers with ``allowlisted``, ``drop_reason`` and ``benign_capped``.

    The profiles, one row an indicator, are kept on the executors' disks until the session ends (``run`` frees them): the
    allowlist lookup reads their addresses alone, and its answer joins them where they lie, dealt by indicator.
    Filtering comes after scoring, so restricted sources still corroborate.
    """
    profile = corroborate.profiles(observations, sources, as_of, rules).persist(StorageLevel.DISK_ONLY)
    return judge_profiles(profile, allowed, state, labels, tiers, rules)


def judge_profiles(
    profile: DataFrame,
    allowed: DataFrame,
    state: DataFrame | None = None,
    labels: DataFrame | None = None,
    tiers: tuple[str, ...] = TIERS,
    rules: Rules = Rules(),
) -> DataFrame:
    """``judge`` from profiles that were kept."""
    flagged = intervals.flag_overlap(profile, allowed)
    scored = corroborate.score(flagged, tiers, rules)
    if state is not None:
        scored = carry.merge_first_seen(scored, state)
    judged = safety.with_drop_reason(scored, rules)
    if labels is None:
        return judged.withColumn("benign_capped", F.lit(False))
    return safety.cap_benign(judged, labels, where=F.col("drop_reason").isNull())


def published_of(judged: DataFrame) -> DataFrame:
    return safety.publishable(safety.kept(judged))


def run(
    tables: RunTables,
    as_of,
    folder: str,
    tiers: tuple[str, ...] = TIERS,
    rules: Rules = Rules(),
    force: bool = False,
) -> RunResult:
    """Score, guard, write the published forms, document and next state under ``folder``, publish, then count statistics.

    Nothing is published without a complete allowlist.  The judged table feeds many outputs, so it is written once, by
    tier, and read back; a lost executor then costs a re-read.  All that a run writes lies in folders of its own until the
    last step makes it the published one (``sinks.publish``); a run that fails before leaves the last one as it was.
    """
    allowed = require_complete_allowlist(tables.allow_sources, tables.allowed)
    spark = tables.fresh.sparkSession
    last = publish.published_run(spark, folder)
    name = f"{re.sub('[^0-9]', '', str(as_of))[:14]}-{time.time_ns()}"
    observations = corroborate.complete(tables.fresh)
    if tables.state is not None:
        carried = carry.carried_observations(tables.fresh, tables.state, tables.sources, as_of)
        observations = observations.unionByName(carried, allowMissingColumns=True)
    counted, watch = reports.watched(observations)
    profile = corroborate.profiles(counted, tables.sources, as_of, rules).persist(StorageLevel.DISK_ONLY)
    judged = judge_profiles(profile, allowed, tables.state, tables.labels, tiers, rules)
    judged.write.partitionBy("tier").parquet(f"{folder}/judged/run={name}")
    profile.unpersist()
    judged = spark.read.schema(judged.schema).parquet(f"{folder}/judged/run={name}")
    counts = reports.run_counts(judged)
    if tables.state is not None:
        new = counts.filter("tier = 'primary'").first()
        old = tables.state.filter("band = 'high'").count()
        safety.check_churn(new.high if new else 0, old, force)
    published = published_of(judged)
    forms = f"{folder}/forms/run={name}"
    writers.write_all(published, forms)
    writers.write_schema(published, forms)
    before = None if last is None else published_of(publish.of_run(spark, folder, "judged", last))
    manifest = documents.manifest(judged, tables.sources, as_of, tables.status, before, tiers)
    manifest = writers.write_document(manifest, f"{forms}/manifest", "tier")
    state = carry.build_state(safety.kept(judged), observations)
    state.write.parquet(f"{folder}/state/run={name}")
    state = spark.read.schema(state.schema).parquet(f"{folder}/state/run={name}")
    publish.record_run(documents.history_line(manifest), folder)
    publish.publish(spark, folder, name)
    # Statistics over all sources come after: a failure here costs no list.
    history = None
    if tables.ranges is not None:
        publish.record_networks(networks.daily_networks(observations, tables.ranges, as_of), folder)
        history = networks.merge_history(None, publish.network_history(spark, folder), as_of)
    found = documents.insights(observations, judged, tables.sources, as_of, tables.ranges, history)
    writers.write_document(found, f"{forms}/insights")
    return RunResult(name, observations, judged, published, counts, state, manifest, watch.get)


def latest_state(spark: SparkSession, folder: str) -> DataFrame | None:
    """The state of the run that was published last under ``folder``; None before the first."""
    name = publish.published_run(spark, folder)
    return None if name is None else publish.of_run(spark, folder, "state", name)
