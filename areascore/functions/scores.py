"""Scores on a 0-100 scale, built from exact decimals.

Each component falls back to its own default when the indicator is missing; a component that is
floored with ``greatest`` turns a NULL that survives into zero, because ``greatest`` skips NULLs.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from areascore.functions.numbers import RATIO, ratio, zero_if_null

SCORE = "decimal(14,2)"
NEUTRAL = 50

# The key indicators whose presence makes up completeness.
KEY_INDICATORS = (
    "revenu_median_uc",
    "taux_pauvrete_60",
    "taux_chomage_pct",
    "population_totale",
    "part_logements_avant_1971_pct",
    "taux_passoires_energetiques_pct",
    "nb_equipements_total",
    "nb_medecins_generalistes",
    "taux_vacance_logements_pct",
    "ratio_interdecile_d9d1",
)

# Upper bounds and labels of the score bands.
SCORE_BANDS = ((30, "0-30 Fragile"), (45, "30-45 Faible"), (55, "45-55 Moyen"), (65, "55-65 Correct"))
TOP_BAND = "65+ Favorable"


def _floor_at_zero(value: Column) -> Column:
    return F.greatest(F.lit(0).cast(RATIO), value.cast(RATIO))


def _cap_at_hundred(value: Column) -> Column:
    return F.least(F.lit(100).cast(RATIO), value.cast(RATIO))


def penalty(value: Column, default: int, points: int | Decimal, per: int = 1) -> Column:
    """``100 - value * points / per``, never below zero."""
    return _floor_at_zero(100 - (F.coalesce(value, F.lit(default)) * points / per).cast(RATIO))


def between(value: Column, default: int, low: int, step: int) -> Column:
    """``(value - low) / step`` held within 0 and 100."""
    return _cap_at_hundred(_floor_at_zero((F.coalesce(value, F.lit(default)) - low) / step))


def blend(*parts: tuple[Column, str]) -> Column:
    """Weighted sum of components, rounded once at the end."""
    total = None
    for component, weight in parts:
        term = component.cast(RATIO) * F.lit(Decimal(weight))
        total = term if total is None else total + term
    return F.round(total, 2).cast(SCORE)


def energy_component(sieve_rate: Column) -> Column:
    return penalty(sieve_rate, default=20, points=Decimal("2.5"))


def building_age_component(old_share: Column) -> Column:
    """Not floored: a share above 100 % would give a negative component."""
    return (100 - F.coalesce(old_share, F.lit(50))).cast(RATIO)


def vacancy_component(vacant: Column, dwellings: Column) -> Column:
    """A known stock with unknown vacancy gives 0; an unknown stock gives the neutral 50."""
    loss = F.when(dwellings > 0, ratio(vacant, dwellings) * 500).otherwise(F.lit(NEUTRAL))
    return _floor_at_zero(100 - loss)


def environment_score(
    sieve_rate: Column, old_share: Column, vacant: Column, dwellings: Column
) -> Column:
    return blend(
        (energy_component(sieve_rate), "0.40"),
        (building_age_component(old_share), "0.35"),
        (vacancy_component(vacant, dwellings), "0.25"),
    )


def unemployment_component(rate: Column) -> Column:
    return penalty(rate, default=10, points=100, per=30)


def income_component(median_income: Column) -> Column:
    return between(median_income, default=20000, low=10000, step=200)


def poverty_component(rate: Column) -> Column:
    return penalty(rate, default=15, points=2)


def social_score(unemployment: Column, median_income: Column, poverty: Column) -> Column:
    return blend(
        (unemployment_component(unemployment), "0.35"),
        (income_component(median_income), "0.35"),
        (poverty_component(poverty), "0.30"),
    )


def health_access(doctors: Column, in_zone: Column) -> Column:
    """Full marks from three doctors; none counts 0 inside the rural zone and 30 elsewhere."""
    known = zero_if_null(doctors)
    return (
        F.when(known >= 3, F.lit(100).cast(RATIO))
        .when(known > 0, (known.cast("decimal(20,0)") * 100 / 3).cast(RATIO))
        .when(F.coalesce(in_zone, F.lit(False)), F.lit(0).cast(RATIO))
        .otherwise(F.lit(30).cast(RATIO))
    )


def education_access(primary: Column, secondary: Column) -> Column:
    return _cap_at_hundred((zero_if_null(primary) + zero_if_null(secondary)) * 50)


def governance_score(
    presence_rank: Column, doctors: Column, in_zone: Column, primary: Column, secondary: Column
) -> Column:
    """``presence_rank`` is the percentile rank between 0 and 1."""
    return blend(
        (presence_rank * 100, "0.40"),
        (health_access(doctors, in_zone), "0.35"),
        (education_access(primary, secondary), "0.25"),
    )


def composite_score(social: Column, environment: Column, governance: Column) -> Column:
    def known(score: Column) -> Column:
        return F.coalesce(score, F.lit(NEUTRAL))

    return blend((known(social), "0.50"), (known(environment), "0.25"), (known(governance), "0.25"))


def completeness(*indicators: Column) -> Column:
    """Percentage of the indicators that are known, without decimals."""
    known = sum((c.isNotNull().cast("int") for c in indicators), F.lit(0))
    share = (known.cast("decimal(5,0)") / len(indicators)).cast(RATIO)
    return F.round(share * 100, 0).cast("decimal(5,0)")


def score_band(score: Column) -> Column:
    bands = F.when(score < SCORE_BANDS[0][0], SCORE_BANDS[0][1])
    for upper, name in SCORE_BANDS[1:]:
        bands = bands.when(score < upper, name)
    return bands.otherwise(TOP_BAND)
