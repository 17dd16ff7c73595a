"""Roll-ups and reports against brute force on small stars."""

from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from conftest import plan_of, values

from civiclake import schemas
from civiclake.operators.rollups import share_of_parent, top_k, top_k_per_group
from civiclake.plans import reports


def half_up(fraction: Fraction, digits: int) -> float:
    exact = Decimal(fraction.numerator) / Decimal(fraction.denominator)
    return float(exact.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


@pytest.fixture(scope="module")
def star(spark):
    facts, silver = [], []
    for i in range(900):
        place = None if i % 11 == 0 else 1 if i % 3 == 0 else 2 + i % 4          # place 1 holds a third
        hours = None if i % 5 == 0 else (i * 7) % 40
        facts.append((i, 20150101 + 10000 * (i % 3), 1 + i % 2, place, 1 + i % 6, 1, hours))
        silver.append((i, None if i % 4 == 0 else "PHONE" if i % 3 == 0 else f"C{i % 5}", place))
    areas = {1: ("A", "1", "x"), 2: ("A", None, "x"), 3: ("B", "1", None), 4: ("B", "2", "y"), 5: ("C", "3", "z")}
    tables = {
        "requests": spark.createDataFrame(facts, schemas.REQUESTS),
        "date": spark.createDataFrame([(20150101 + 10000 * y, 2015 + y) for y in range(2)], "date_key int, year int"),
        "agency": spark.createDataFrame([(1, "P", "p"), (2, "Q", None)],
                                        "agency_key long, agency_code string, agency_name string"),
        "location": spark.createDataFrame([(k, *area) for k, area in areas.items()],
                                          "location_key long, borough string, incident_zip string, city string"),
        "complaint": spark.createDataFrame([(k, f"t{k}", "even" if k % 2 == 0 else "odd") for k in range(1, 6)],
                                           "complaint_key long, complaint_type string, category string"),
        "silver": spark.createDataFrame(
            [(i, channel, *areas.get(place, ("UNSPECIFIED", None, None))) for i, channel, place in silver],
            "request_id long, channel string, borough string, incident_zip string, city string"),
    }
    return {name: table.cache() for name, table in tables.items()}


def rows(table):
    return [row.asDict() for row in table.collect()]


def lookup(table, key):
    return {row[key]: row for row in rows(table)}


def test_complaint_by_year(star):
    types, days = lookup(star["complaint"], "complaint_key"), lookup(star["date"], "date_key")
    counts, hours = Counter(), defaultdict(list)
    for fact in rows(star["requests"]):
        if fact["complaint_key"] in types and fact["date_key"] in days:
            kind = types[fact["complaint_key"]]
            group = (kind["category"], kind["complaint_type"], days[fact["date_key"]]["year"])
            counts[group] += 1
            hours[group] += [fact["resolution_hours"]] if (fact["resolution_hours"] or 0) > 0 else []
    expected = {g: (n, half_up(Fraction(sum(hours[g]), len(hours[g])), 1)) for g, n in counts.items()}
    result = reports.complaint_by_year(star["requests"], star["complaint"], star["date"])
    assert {(r.category, r.complaint_type, r.year): (r.request_count, r.avg_resolution_hours)
            for r in result.collect()} == expected
    ordered = [(r.year, -r.request_count) for r in reports.by_year_order(result).collect()]
    assert ordered == sorted(ordered)


def channel_shares(star):
    areas = lookup(star["location"], "location_key")
    channels = {row["request_id"]: row["channel"] for row in rows(star["silver"])}
    counts = Counter()
    for fact in rows(star["requests"]):
        if fact["location_key"] in areas and channels[fact["request_id"]] is not None:
            counts[areas[fact["location_key"]]["borough"], channels[fact["request_id"]]] += 1
    totals = Counter()
    for (borough, _), n in counts.items():
        totals[borough] += n
    return {group: (n, half_up(Fraction(100 * n, totals[group[0]]), 1)) for group, n in counts.items()}


def test_channel_by_borough_both_ways(star):
    expected = channel_shares(star)
    joined = reports.channel_by_borough(star["requests"], star["silver"], star["location"])
    direct = reports.channel_by_borough_of(star["silver"], star["location"])
    for result in (joined, direct):
        got = {(r.borough, r.channel): (r.request_count, r.pct_of_borough_total) for r in result.collect()}
        assert got == expected
    sums = defaultdict(float)
    for (borough, _), (_, share) in expected.items():
        sums[borough] += share
    assert all(abs(total - 100) < 0.3 for total in sums.values())


def test_slowest_agencies(star):
    result = reports.slowest_agencies(star["requests"], star["agency"], 1).collect()
    means = {}
    for key, code in ((1, "P"), (2, "Q")):
        hours = [f["resolution_hours"] for f in rows(star["requests"])
                 if f["agency_key"] == key and f["resolution_hours"] is not None]
        means[code] = (half_up(Fraction(sum(hours), len(hours)), 0), len(hours))
    best = min(means, key=lambda code: (-means[code][0], code))
    assert [(r.agency_code, r.avg_hours, r.total_requests) for r in result] == [(best, *means[best])]


def test_counts_and_top_types(star):
    areas, types = lookup(star["location"], "location_key"), lookup(star["complaint"], "complaint_key")
    days = lookup(star["date"], "date_key")
    per_year, per_type = Counter(), Counter()
    for fact in rows(star["requests"]):
        if fact["location_key"] in areas:
            borough = areas[fact["location_key"]]["borough"]
            if fact["date_key"] in days:
                per_year[borough, days[fact["date_key"]]["year"]] += 1
            if fact["complaint_key"] in types:
                per_type[borough, types[fact["complaint_key"]]["complaint_type"]] += 1
    result = reports.count_by_borough_year(star["requests"], star["location"], star["date"]).collect()
    assert [(r.borough, r.year, r.request_count) for r in result] == [(*k, n) for k, n in sorted(per_year.items())]
    ranked = {b: sorted(((n, t) for (o, t), n in per_type.items() if o == b), key=lambda p: (-p[0], p[1]))
              for b in ("A", "B", "C")}
    for borough in "ABC":
        top = reports.top_types_in_borough(star["requests"], star["complaint"], star["location"], borough, 3).collect()
        assert [(r.total, r.complaint_type) for r in top] == ranked[borough][:3]
    all_tops = reports.top_types_per_borough(star["requests"], star["complaint"], star["location"], 2)
    assert values(all_tops, "borough", "place", "total", "complaint_type") == sorted(
        (b, i + 1, n, t) for b in "ABC" for i, (n, t) in enumerate(ranked[b][:2]))


def test_share_of_parent_keeps_a_null_parent(spark):
    counts = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), (None, "x", 5)], "p string, c string, n long")
    assert values(share_of_parent(counts, "p", "n", "pct"), "p", "c", "pct") == [
        (None, "x", 100.0), ("a", "x", 33.3), ("a", "y", 66.7)]


def test_top_k_plans(spark):
    counts = spark.range(10).selectExpr("id % 3 as g", "id", "id % 5 as n")
    assert "TakeOrderedAndProject" in plan_of(top_k(counts, "n", ["id"], 2))
    plan = plan_of(top_k_per_group(counts, "g", "n", ["id"], 2))
    assert plan.count("WindowGroupLimit") == 2, "groups are cut before the shuffle"


def all_reports(star):
    return [
        reports.complaint_by_year(star["requests"], star["complaint"], star["date"]),
        reports.count_by_borough_year(star["requests"], star["location"], star["date"]),
        reports.channel_by_borough(star["requests"], star["silver"], star["location"]),
        reports.channel_by_borough_of(star["silver"], star["location"]),
        reports.slowest_agencies(star["requests"], star["agency"]),
        reports.top_types_per_borough(star["requests"], star["complaint"], star["location"]),
    ]


def test_small_dimensions_join_without_a_shuffle(star):
    for report in all_reports(star)[:2]:
        plan = plan_of(report)
        assert "SortMergeJoin" not in plan
        assert plan.count("partial_count(1)") == 1 and plan.index("partial_count(1)") < plan.rindex("BroadcastHashJoin")
        below = plan[plan.index("partial_count(1)"):]
        assert "Exchange hashpartitioning" not in below, "facts do not move before they are summed"


def test_large_dimensions_give_the_same(star, nothing_is_small):
    large = all_reports(star)
    for report in large[:2]:
        plan = plan_of(report)
        assert "BroadcastHashJoin" not in plan and plan.rindex("SortMergeJoin") < plan.index("partial_count(1)")
    results = [values(report) for report in large]
    nothing_is_small()
    assert results == [values(report) for report in all_reports(star)]
