"""Numeric columns: guarded ratios, normal probabilities, risk classes, and the rounding that results are shown with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(c: Column, digits: int = 4) -> Column:
    """Half up by floor, the same on every engine; a millionth of the last digit absorbs the noise of sums."""
    scale = F.lit(float(10**digits))
    return F.floor(c * scale + F.lit(0.500001)).cast("double") / scale


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is 0."""
    return F.try_divide(a, F.nullif(b, F.lit(0.0)))


def change(now: Column, before: Column) -> Column:
    return ratio(now, before) - 1


def no_nan(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, by the rational approximation 7.1.26 of Abramowitz and Stegun."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + 0.3275911 * x)
    poly = ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t
    erf = 1.0 - poly * F.exp(-x * x)
    return F.when(z >= 0, 0.5 * (1.0 + erf)).otherwise(0.5 * (1.0 - erf))


def below(threshold: Column, middle: Column, p10: Column, p90: Column) -> Column:
    """Probability to be below a threshold, from a forecast and its 10-90 interval."""
    sigma = F.greatest((p90 - p10) / F.lit(2.563), F.lit(1e-6))
    return normal_cdf((threshold - middle) / sigma)


def shortfall(reference: Column, share: float, middle: Column, p10: Column, p90: Column) -> Column:
    return F.when(reference.isNotNull(), below(reference * (1 - share), middle, p10, p90))


def alert_level(probability: Column) -> Column:
    """Right-closed classes of a probability."""
    return F.when(probability <= 0.25, "bajo").when(probability <= 0.5, "medio").when(probability <= 0.75, "alto").when(probability <= 1, "critico")


def water_level(percent: Column, below_40: Column, below_25: Column, below_15: Column) -> Column:
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(yes(percent < 15) | yes(below_15 >= 0.5), "critico")
        .when(yes(percent < 25) | yes(below_25 >= 0.5), "alto")
        .when(yes(percent < 40) | yes(below_40 >= 0.5), "medio")
        .otherwise("bajo")
    )


def purchase_action(probability: Column, expected_change: Column) -> Column:
    """The texts of the three actions."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(yes(probability >= 0.7) | yes(expected_change >= 0.15), "Adelantar compras y diversificar origen.")
        .when(yes(probability >= 0.45) | yes(expected_change >= 0.08), "Solicitar cotizaciones alternas y monitorear diariamente.")
        .otherwise("Mantener compra normal y revisar en el siguiente corte.")
    )


def price_per_kg(unit_price: Column, unit: Column, weight: Column) -> Column:
    return rounded(F.when(F.lower(unit) == "kg", unit_price).otherwise(ratio(unit_price, weight)))
