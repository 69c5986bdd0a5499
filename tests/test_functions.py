"""Golden values of column functions."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cosecha.functions import dates, numbers, text


def one(spark, c, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(c.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "slug", "product"),
    [("  Nuevo León ", "nuevo_leon", "nuevo_leon"), ("Tomate", "tomate", "tomate_rojo"), ("Chile Jalapeño", "chile_jalapeno", "chile_verde"), ("a--B  c!", "a_b_c", "a_b_c"), ("", "", ""), ("¿?", "", "")],
)
def test_slug_and_product(spark, given, slug, product):
    assert one(spark, text.slug(F.lit(given))) == slug
    assert one(spark, text.product(F.lit(given))) == product


def test_null_keys(spark):
    assert one(spark, text.slug(F.lit(None))) == ""
    assert one(spark, text.product_or_null(F.lit(None))) is None
    assert one(spark, text.truthy(F.lit(None))) is False
    assert one(spark, text.truthy(F.lit(" Si "))) is True


def test_papaya_is_not_papa(spark):
    assert one(spark, text.crop(F.lit("Papaya Maradol por kg"))) is None
    assert one(spark, text.crop(F.lit("Papa blanca 1 kg"))) == "papa"
    assert one(spark, text.crop(F.lit("Jitomate saladette"))) == "tomate"
    assert one(spark, text.crop(F.lit("Chile Jalapeño"))) == "chile_jalapeno"
    assert one(spark, text.crop(F.lit("Detergente"))) is None


def test_numbers_in_text(spark):
    assert one(spark, text.number(F.lit(" 1,234.50 "))) == 1234.5
    assert one(spark, text.number(F.lit("-"))) is None
    price, unit = text.price_and_unit(F.lit("desde $ 12.50 / kg"))
    assert (one(spark, price), one(spark, unit)) == (12.5, "kg")
    assert one(spark, text.weight_kg(F.lit("Bolsa 900 g"))) == 0.9
    assert one(spark, text.weight_kg(F.lit("Arpilla 1.5 kg"))) == 1.5


def test_labels_and_names(spark):
    assert one(spark, text.unit_of_label(F.lit("Maiz (grano) (Ton)"))) == "Ton"
    assert one(spark, text.label_without_unit(F.lit("Maiz (grano) (Ton)"))) == "Maiz (grano)"
    assert one(spark, text.year_of_name(F.lit("papa_2024_febrero.csv"))) == 2024
    assert one(spark, text.month_of_name(F.lit("papa_2024_febrero.csv"))) == 2
    assert one(spark, text.product_of_name(F.lit("papa_2024_febrero.csv"))) == "papa"
    assert one(spark, text.terms(F.lit("a| b ||"))) == ["a", "b"]
    assert one(spark, text.decoded(F.lit("Presa&nbsp; El&nbsp;Ni&ntilde;o "))) == "Presa El Niño"
    assert one(spark, text.money(F.lit(1234.5))) == "$1,234.50/kg"
    assert one(spark, text.percent(F.lit(0.123))) == "+12.3%"
    assert one(spark, text.percent(F.lit(None).cast("double"))) == "s/d"


def test_dates(spark):
    d = F.lit(dt.date(2024, 2, 21))
    assert one(spark, dates.decena_of(d)) == 3
    assert one(spark, dates.decena_end(F.lit(2024), F.lit(2), F.lit(3))) == dt.date(2024, 2, 29)
    assert one(spark, dates.decena_end(F.lit(2024), F.lit(13), F.lit(1))) is None
    assert one(spark, dates.week_start(F.lit(dt.date(2024, 1, 7)))) == dt.date(2024, 1, 1)
    assert one(spark, dates.available_on(d, F.lit("Mensual"))) == dt.date(2024, 3, 7)
    assert one(spark, dates.any_date(F.lit("no"), F.lit("05/03/2024"))) == dt.date(2024, 3, 5)
    assert one(spark, dates.long_date(F.lit("Situación al 30 de abril de 2026"))) == dt.date(2026, 4, 30)
    assert one(spark, dates.month_code(F.lit("2026M01"))) == dt.date(2026, 1, 1)


def test_normal_probability(spark):
    for z in (-2.5, -0.3, 0.0, 1.2):
        assert one(spark, numbers.normal_cdf(F.lit(z))) == pytest.approx(0.5 * (1 + math.erf(z / math.sqrt(2))), abs=2e-7)


@pytest.mark.parametrize(("row", "level"), [((35.0, 0.9, 0.1, 0.0), "medio"), ((22.0, 1.0, 0.8, 0.1), "alto"), ((12.0, 1.0, 1.0, 0.8), "critico"), ((80.0, 0.0, 0.0, 0.0), "bajo")])
def test_water_level(spark, row, level):
    assert one(spark, numbers.water_level(*map(F.lit, row))) == level


def test_ratio_of_zero(spark):
    assert one(spark, numbers.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, numbers.rounded(F.lit(0.00005))) == 0.0001
