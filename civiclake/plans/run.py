"""The whole run: bronze to silver to gold, each table written once and read by the steps after it.

Silver and gold are worked out anew and replace what was there, a step's tables all at once, so running a step again changes
nothing and a step that dies leaves the former tables. ``incremental`` brings them up to date with what is new alone.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from civiclake import rules
from civiclake.plans import reports, star
from civiclake.plans.silver import KEY, silver
from civiclake.session import pin_settings
from civiclake.sources.tables import Draft, Store, slices


def _write_all(draft: Draft, tables: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Write tables that do not need each other as jobs at the same time, so one's last tasks leave no cores idle."""
    inherit = inheritable_thread_target(draft.spark)
    with ThreadPoolExecutor(len(tables)) as pool:
        jobs = {
            name: pool.submit(inherit(lambda name=name, table=table: draft.write(table(), name)))
            for name, table in tables.items()
        }
    return {name: job.result() for name, job in jobs.items()}


def _silver(draft: Draft, bronze: DataFrame) -> DataFrame:
    """Slice by slice of the keys, since all raw rows are shuffled on the way."""
    for number, rows in enumerate(slices(bronze, KEY)):
        draft.write(silver(rows), "request_cleaned", "append" if number else "overwrite")
    return draft.read("request_cleaned")


def _star(
    draft: Draft,
    agency_types: dict[str, list] = rules.AGENCY_TYPES,
    categories: list[tuple[str, str]] = rules.COMPLAINT_CATEGORIES,
) -> dict[str, DataFrame]:
    cleaned = draft.read("request_cleaned")
    dims = _write_all(draft, {
        "date": lambda: star.date(cleaned),
        "agency": lambda: star.agency(cleaned, agency_types),
        "location": lambda: star.location(cleaned),
        "complaint": lambda: star.complaint(cleaned, categories),
        "status": lambda: star.status(draft.spark),
    })
    fact = star.requests(cleaned, dims["agency"], dims["location"], dims["complaint"], dims["status"])
    return {**dims, "requests": draft.write(fact, "requests")}


def _rollups(draft: Draft) -> dict[str, DataFrame]:
    facts, complaint, date, location, cleaned = (
        draft.read(name) for name in ("requests", "complaint", "date", "location", "request_cleaned")
    )
    return _write_all(draft, {
        "aggregation_complaint_by_year": lambda: reports.complaint_by_year(facts, complaint, date),
        "aggregation_channel_by_borough": lambda: reports.channel_by_borough_of(cleaned, location),
    })


def _switched(store: Store, step: Callable[[Draft], object]):
    """What the step returns, once its tables have taken the place of the former ones, all at once."""
    pin_settings(store.spark)
    draft = store.draft()
    result = step(draft)
    draft.publish()
    return result


def build_silver(store: Store, bronze: DataFrame) -> DataFrame:
    return _switched(store, lambda draft: _silver(draft, bronze))


def build_star(store: Store, **rule_tables) -> dict[str, DataFrame]:
    """Dimensions and fact of the stored silver rows."""
    return _switched(store, lambda draft: _star(draft, **rule_tables))


def build_rollups(store: Store) -> dict[str, DataFrame]:
    """The two roll-up tables of the stored star."""
    return _switched(store, _rollups)


def build(store: Store, bronze: DataFrame, **rule_tables) -> dict[str, DataFrame]:
    """Everything from bronze rows. Readers see all tables of the former build until the last one is written."""
    return _switched(store, lambda draft: {
        "request_cleaned": _silver(draft, bronze), **_star(draft, **rule_tables), **_rollups(draft),
    })
