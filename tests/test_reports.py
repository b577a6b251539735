"""Rising-star rules and report semantics on hand-written facts."""

import datetime as dt

from strataflow.functions.columns import round_half_up
from strataflow.plans import reports

AS_OF = dt.date(2024, 6, 1)


def facts(spark, rows):
    return spark.createDataFrame(
        [(f"{b}-{i}", b, "u", s, ts) for i, (b, s, ts) in enumerate(rows)],
        "review_id string, business_id string, user_id string, review_stars double, reviewed_at timestamp")


def recent(n, stars, when=dt.datetime(2024, 3, 1)):
    return [(None, stars, when)] * n


def hist(n, stars):
    return [(None, stars, dt.datetime(2020, 1, 1))] * n


def build(spark, spec):
    rows = []
    for b, parts in spec.items():
        rows += [(b, s, t) for (_, s, t) in parts]
    return facts(spark, rows)


def test_rising_star_rules(spark):
    spec = {
        "ok": recent(10, 5.0) + hist(3, 4.0),
        "nine": recent(9, 5.0) + hist(3, 1.0),
        "nohist": recent(10, 5.0),
        "strong": recent(10, 4.5) + hist(2, 3.0),
        "major": recent(10, 5.0) + hist(2, 3.0),
        "edge": recent(10, 5.0, dt.datetime(2023, 6, 1)) + hist(2, 1.0),
    }
    out = {r.business_id: r for r in reports.rising_star_candidates(build(spark, spec), AS_OF).collect()}
    assert set(out) == {"ok", "strong", "major", "edge"}
    assert out["ok"].rating_improvement == 1.0 and out["ok"].review_count_recent == 10
    dims = spark.createDataFrame([(b, b, "c", "s", "p") for b in spec],
                                 "business_id string, name string, city string, state string, primary_category string")
    tiers = {r.business_id: r.improvement_tier for r in reports.rising_stars(build(spark, spec), dims, AS_OF).collect()}
    assert tiers["ok"] == "Improvement" and tiers["strong"] == "Strong improvement"
    assert tiers["major"] == "Major improvement"


def test_round_half_up(spark):
    df = spark.createDataFrame([(2.125,), (1.005,), (2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got[:2] == [2.13, 1.0] and got[3] is None
    assert df.select(round_half_up("x", 0)).collect()[2][0] == 3.0


def test_trends_and_elite_split(spark):
    from strataflow.operators.gold import dim_date
    dates = dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 3, 31))
    ids = {r.full_date: r.date_id for r in dates.collect()}
    fact = spark.createDataFrame(
        [("r1", "b", "u1", ids[dt.date(2024, 1, 5)], 5.0, 2, 10), ("r2", "b", "u2", ids[dt.date(2024, 1, 9)], 2.0, 0, 20),
         ("r3", "c", "u1", ids[dt.date(2024, 3, 1)], 4.0, 1, 30), ("r4", "c", "u3", None, 1.0, 0, 40)],
        "review_id string, business_id string, user_id string, date_id string, review_stars double, "
        "useful_votes long, review_length_chars int")
    t = {r.year_month: r for r in reports.review_trends(fact, dates).collect()}
    assert set(t) == {"2024-01", "2024-03"}                        # no date -> not in the inner join
    assert (t["2024-01"].total_reviews, t["2024-01"].avg_rating, t["2024-01"].avg_review_length) == (2, 3.5, 15.0)
    users = spark.createDataFrame([("u1", "A", True, 3), ("u2", "B", False, 0), ("u3", "C", False, 1)],
                                  "user_id string, name string, is_elite boolean, fan_count long")
    e = {r.is_elite: r for r in reports.elite_behaviour(fact, users).collect()}
    assert e[True].total_reviews == 2 and e[True].avg_stars_given == 4.5 and e[True].avg_useful_votes == 1.5
    assert e[False].total_reviews == 2 and e[False].avg_review_length_chars == 30.0
    top = reports.active_reviewers(fact, users, limit=1).collect()
    assert [(r.user_id, r.reviews_written) for r in top] == [("u1", 2)]
