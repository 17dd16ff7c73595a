"""Roll-ups and reports over the star. The two roll-ups are tables, which have no order; ``by_year_order`` and
``by_borough_order`` sort them for reading. Reports come sorted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.operators.clean import require
from civiclake.operators.lookups import fits_broadcast, join_back
from civiclake.operators.rollups import mean_measure, share_of_parent, star_sums, top_k, top_k_per_group


def complaint_by_year(
    requests: DataFrame, complaint: DataFrame, date: DataFrame, shuffle: bool = False
) -> DataFrame:
    """Requests and mean hours (of those that took any) per category, complaint type and year."""
    hours = F.when(F.col("resolution_hours") > 0, F.col("resolution_hours"))
    dims = {"complaint_key": complaint, "date_key": date.select("date_key", "year")}
    return star_sums(requests, dims, measure=hours, shuffle=shuffle).select(
        "category", "complaint_type", "year", F.col("row_count").alias("request_count"),
        mean_measure(1).alias("avg_resolution_hours"),
    )


def by_year_order(rollup: DataFrame) -> DataFrame:
    return rollup.orderBy("year", F.desc("request_count"), "category", "complaint_type")


def channel_by_borough(requests: DataFrame, silver: DataFrame, location: DataFrame) -> DataFrame:
    """Requests per borough and channel, and their percent of the borough. The channel comes back from silver."""
    facts = require(requests.select("request_id", "location_key"), ["location_key"])
    rows = join_back(facts, require(silver, ["channel"]), "request_id", ["channel"])
    places = require(location.select("location_key", "borough"), ["borough"])
    return _shares(star_sums(rows, {"location_key": places}, ["channel"]))


def channel_by_borough_of(silver: DataFrame, location: DataFrame, shuffle: bool = False) -> DataFrame:
    """The same roll-up without a join of fact and silver, both as large as the data: silver's own area columns say
    which location a request has. Each silver row counts; ``channel_by_borough`` takes one silver row per ``request_id``,
    so the two differ where the contract's rule of unique ids is broken. ``shuffle`` takes the locations for a large table."""
    grain = ["borough", "incident_zip", "city"]
    rows = require(silver, ["request_id", "borough", "channel"])
    place = location.select(*[F.col(name).alias(f"_{name}") for name in grain])
    match = F.col("borough") == F.col("_borough")
    for name in grain[1:]:
        match = match & F.col(name).eqNullSafe(F.col(f"_{name}"))
    if not shuffle and fits_broadcast(place):
        known = rows.join(F.broadcast(place), match, "left_semi").withColumn("row_count", F.lit(1))
    else:
        per_place = rows.groupBy(*grain, "channel").agg(F.count(F.lit(1)).alias("row_count"))
        known = per_place.join(place.hint("merge"), match, "left_semi")
    return _shares(known.groupBy("borough", "channel").agg(F.sum("row_count").alias("row_count")))


def _shares(counts: DataFrame) -> DataFrame:
    totals = counts.select("borough", "channel", F.col("row_count").alias("request_count"))
    return share_of_parent(totals, "borough", "request_count", "pct_of_borough_total")


def by_borough_order(rollup: DataFrame) -> DataFrame:
    return rollup.orderBy("borough", F.desc("request_count"), "channel")


def slowest_agencies(requests: DataFrame, agency: DataFrame, k: int = 10) -> DataFrame:
    """The k agencies with the longest mean time to close."""
    dims = {"agency_key": agency.select("agency_key", "agency_code", "agency_name")}
    sums = star_sums(require(requests, ["resolution_hours"]), dims, measure=F.col("resolution_hours"))
    means = sums.select(
        "agency_code", "agency_name", F.col("row_count").alias("total_requests"), mean_measure(0).alias("avg_hours")
    )
    return top_k(means, "avg_hours", ["agency_code", "agency_name"], k)


def count_by_borough_year(requests: DataFrame, location: DataFrame, date: DataFrame) -> DataFrame:
    dims = {"location_key": location.select("location_key", "borough"), "date_key": date.select("date_key", "year")}
    counts = star_sums(requests, dims).select("borough", "year", F.col("row_count").alias("request_count"))
    return counts.orderBy("borough", "year")


def _type_counts(requests: DataFrame, complaint: DataFrame, location: DataFrame) -> DataFrame:
    dims = {
        "location_key": location.select("location_key", "borough"),
        "complaint_key": complaint.select("complaint_key", "complaint_type"),
    }
    return star_sums(requests, dims).select("borough", "complaint_type", F.col("row_count").alias("total"))


def top_types_in_borough(requests: DataFrame, complaint: DataFrame, location: DataFrame, borough: str,
                         k: int = 10) -> DataFrame:
    """The k most frequent complaint types of one borough."""
    counts = _type_counts(requests, complaint, location.where(F.col("borough") == borough))
    return top_k(counts.select("complaint_type", "total"), "total", ["complaint_type"], k)


def top_types_per_borough(requests: DataFrame, complaint: DataFrame, location: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent complaint types of every borough."""
    return top_k_per_group(_type_counts(requests, complaint, location), "borough", "total", ["complaint_type"], k)
