"""Batting rates from summed counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from sabermill.functions.rates import quotient, rate


@dataclass(frozen=True)
class RunWeights:
    """Run weights of the on-base events in wOBA."""

    walk: str = "0.69"
    hit_by_pitch: str = "0.72"
    single: str = "0.888"
    double: str = "1.271"
    triple: str = "1.616"
    home_run: str = "2.101"


def _weight(value: str) -> Column:
    return F.lit(value).cast("decimal(6,3)")


def singles(hits: Column, doubles: Column, triples: Column, home_runs: Column) -> Column:
    return hits - doubles - triples - home_runs


def times_on_base() -> Column:
    return F.col("hits") + F.col("walks") + F.col("hit_by_pitch")


def on_base_chances() -> Column:
    return F.col("at_bats") + F.col("walks") + F.col("hit_by_pitch") + F.col("sacrifice_flies")


def batting_average() -> Column:
    return rate(F.col("hits"), F.col("at_bats"), 3)


def on_base_percentage() -> Column:
    return rate(times_on_base(), on_base_chances(), 3)


def slugging_percentage() -> Column:
    return rate(F.col("total_bases"), F.col("at_bats"), 3)


def on_base_plus_slugging() -> Column:
    """Both parts unrounded, one rounding of the sum."""
    total = quotient(times_on_base(), on_base_chances()) + quotient(
        F.col("total_bases"), F.col("at_bats")
    )
    return F.when((F.col("at_bats") > 0) & (on_base_chances() > 0), F.round(total, 3))


def woba(weights: RunWeights = RunWeights()) -> Column:
    """All walks count in the denominator, intentional ones too."""
    events = {
        "walks": weights.walk,
        "hit_by_pitch": weights.hit_by_pitch,
        "singles": weights.single,
        "doubles": weights.double,
        "triples": weights.triple,
        "home_runs": weights.home_run,
    }
    terms = [_weight(w) * F.col(name).cast("decimal(19,0)") for name, w in events.items()]
    value = terms[0]
    for term in terms[1:]:
        value = value + term
    return rate(value, on_base_chances(), 3, scale=3)


def isolated_power() -> Column:
    """Difference of the two rounded rates."""
    gap = F.col("slugging_percentage") - F.col("batting_average")
    return F.when(F.col("at_bats") > 0, F.round(gap, 3))


def per_plate_appearance(count: str) -> Column:
    return rate(F.col(count), F.col("plate_appearances"), 3)


def babip() -> Column:
    in_play = (
        F.col("at_bats") - F.col("strikeouts") - F.col("home_runs") + F.col("sacrifice_flies")
    )
    return rate(F.col("hits") - F.col("home_runs"), in_play, 3)
