"""Batted-ball flags and their per-player aggregates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sabermill.functions.rates import mean, rate

# What counts as a hard hit and as a barrel.
HARD_HIT_SPEED = 95
BARREL_SPEED = 98
BARREL_ANGLES = (26, 30)
# What the metrics read of a batted ball.
MEASURES = ["exit_velocity", "launch_angle", "expected_batting_avg", "expected_woba"]


def hard_hit() -> Column:
    return F.col("exit_velocity") >= HARD_HIT_SPEED


def barrel() -> Column:
    return (F.col("exit_velocity") >= BARREL_SPEED) & F.col("launch_angle").between(*BARREL_ANGLES)


def totals() -> list[Column]:
    """Aggregates that combine before the shuffle; every input row has an exit velocity."""
    return [
        F.count(F.lit(1)).alias("total_batted_balls"),
        F.count_if(barrel()).alias("barrels"),
        F.count_if(hard_hit()).alias("hard_hits"),
        F.max("exit_velocity").alias("max_exit_velocity"),
        *[
            column
            for source in MEASURES
            for column in (
                F.sum(source).alias(f"{source}_sum"),
                F.count(source).alias(f"{source}_n"),
            )
        ],
    ]


def _average(source: str, places: int) -> Column:
    return mean(F.col(f"{source}_sum"), F.col(f"{source}_n"), places).alias(f"avg_{source}")


def summary() -> list[Column]:
    """The published columns over ``totals``."""
    balls = F.col("total_batted_balls")
    return [
        balls,
        F.col("barrels"),
        rate(F.col("barrels"), balls, 3).alias("barrel_pct"),
        F.col("hard_hits"),
        rate(F.col("hard_hits"), balls, 3).alias("hard_hit_pct"),
        _average("exit_velocity", 1),
        _average("launch_angle", 1),
        F.col("max_exit_velocity"),
        _average("expected_batting_avg", 3),
        _average("expected_woba", 3),
    ]
