"""The batch pipeline: parsed records to links, memberships and the star; and the small pieces of control around it."""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.score import LinkRules
from ..operators import dedup, resolve, validate
from ..operators.gold import Star, to_gold
from ..session import keep

#: Columns that both parsers give and the pipeline carries.
OBSERVATION = "schema_version source_system source_record_key source_revision_key source_observation_id raw_record_hash event_time_utc source_updated_at_utc latitude longitude depth_km magnitude magnitude_type event_type_code place_name source_status tsunami_flag alert_level significance max_intensity_code determining_agency_code catalog_release catalog_release_at_utc catalog_era bronze_manifest_id raw_object_uri raw_sha256 raw_record_locator ingest_run_id processed_at_utc is_in_study_area quality_status quality_flags".split()


@dataclass(frozen=True)
class Integrated:
    observations: DataFrame
    rejects: DataFrame
    links: DataFrame
    memberships: DataFrame
    star: Star


def integrate(parsed: list[DataFrame], run_id: str, updated_at: Column, regions: DataFrame | None = None, rules: LinkRules | None = None, allow_rejects: bool = False) -> Integrated:
    """parse results (with reject_reasons) -> validation -> revisions -> resolution -> star.

    Any reject blocks the run unless allowed: publishing part of the input silently would be worse.
    """
    rows = parsed[0].select(*OBSERVATION, "reject_reasons")
    for p in parsed[1:]:
        rows = rows.unionByName(p.select(*OBSERVATION, "reject_reasons"))
    fine, rejected = validate.split(keep(rows, "parsed"))
    checked, more = validate.split(keep(validate.validate(fine, run_id), "validated"))
    rejects = rejected.unionByName(more)
    if not allow_rejects and not rejects.isEmpty():
        raise ValueError("the run has rejects")
    observations = keep(dedup.classify_revisions(checked), "observations")
    now = dedup.current(observations)
    links, members = resolve.resolve(now, rules)
    links, members = keep(links, "links"), keep(members, "members")
    named = links.withColumnsRenamed({"l_source_observation_id": "left_observation_id", "r_source_observation_id": "right_observation_id"})
    spark = rows.sparkSession
    regions = regions if regions is not None else spark.createDataFrame([], "source_observation_id string, region_key string, region_name string, region_category string")
    return Integrated(observations, rejects, named, members, to_gold(observations, members, named, regions, run_id, updated_at))


def reconciles(result: Integrated) -> dict[str, bool]:
    """The identities of a run: valid = current + duplicates + superseded, memberships = current, events = primaries."""
    m = dedup.metrics(result.observations).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("input_count", "current_count", "duplicate_count", "superseded_count"))).first()
    members = result.memberships.agg(F.count("*"), F.count_if(F.col("membership_status") == "PRIMARY"), F.count_distinct("canonical_event_id")).first()
    return {"revisions": m.input_count == m.current_count + m.duplicate_count + m.superseded_count, "memberships": members[0] == m.current_count, "one primary": members[1] == members[2]}


def dataset_id(payload: dict) -> str:
    """A content-addressed id: SHA-256 of the payload as JSON with sorted keys. Secrets and local paths are refused."""
    text = json.dumps(payload, sort_keys=True, separators=(",", ":"))
    for bad in ("password", "secret", "access_key", "/home/", "/users/"):
        if bad in text.lower():
            raise ValueError(f"a dataset's identity must not hold {bad}")
    return f"ds_{hashlib.sha256(text.encode()).hexdigest()}"


#: States of a dataset and of an experiment, and what may follow each.
TRANSITIONS = {"BUILDING": {"VALIDATED", "FAILED"}, "VALIDATED": {"EXPORTED", "FAILED"}, "EXPORTED": set(), "FAILED": set(), "IMPORT_VALIDATING": {"CANDIDATE", "REJECTED"}, "CANDIDATE": {"APPROVED", "REJECTED"}, "APPROVED": set(), "REJECTED": set()}


def advance(state: str, to: str) -> str:
    if to not in TRANSITIONS.get(state, set()):
        raise ValueError(f"{state} cannot become {to}")
    return to


def refuse_provisional(namespace: str) -> str:
    """Provisional data may be looked at, but no model is built on it."""
    if namespace.startswith(("provisional", "current_month")):
        raise ValueError(f"{namespace} is provisional")
    return namespace


@contextlib.contextmanager
def whole_run_lease(path: str, owner: str) -> Iterator[None]:
    """One run at a time on this host's control plane: an exclusive lock with the owner's name, without expiry."""
    with Path(path).open("a+") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError as e:
            f.seek(0)
            raise RuntimeError(f"held by {f.read().strip()}") from e
        f.seek(0)
        f.truncate()
        f.write(f"{owner} {os.getpid()}\n")
        f.flush()
        yield


def run_phases(phases: list[tuple[str, object]], state: dict) -> list[tuple[str, str]]:
    """Runs named phases in order on a shared state; the first failure ends the run and is reported with its phase."""
    done = []
    for name, phase in phases:
        try:
            phase(state)
        except Exception as e:
            raise RuntimeError(f"phase {name}: {e}") from e
        done.append((name, "DONE"))
    return done


def markdown_report(title: str, df: DataFrame, most: int = 200) -> str:
    """A small result as a Markdown table; fails above `most` rows."""
    rows = validate.bounded(df, most, df.columns[0])
    cells = lambda values: "| " + " | ".join("" if v is None else str(v) for v in values) + " |"
    return "\n".join([f"# {title}", "", cells(df.columns), cells("---" for _ in df.columns), *map(cells, rows)])
