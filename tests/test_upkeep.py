"""Orders, catalogues, streams, decoders, reports and windows on small tables."""

import datetime as dt
import html
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cosecha.functions import numbers, text
from cosecha.operators import orders
from cosecha.plans import catalog, models, pages, prices, production, retail, run, trees, water
from cosecha.sources import files, records
from cosecha.streaming import buckets, incremental

D = lambda m, d: dt.date(2026, m, d)


def texts(spark, column, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return [r["x"] for r in spark.createDataFrame(rows, "i int, t string").select("i", column(F.col("t")).alias("x")).orderBy("i").collect()]


def test_references(spark):
    values = [
        "&ntilde;&#241;&#xF1;&hellip;", "&amp;amp;", "&amp;lt;b&gt;", "a & b && c", "&", "&;", "&#;", "&#x;", "&unknown;x", "&eacute and &copy2", "&#128;&#x92;", "&#0;", "&#55296;", "&#1114112;", "&NotEqualTilde;",
        "&#65;&#66", "x&lt;y&lt;", "", None, "plain", "&#x1F600;!", "&quot;q&quot;", "&acE;",
    ]
    assert texts(spark, text.unescaped, values) == [None if v is None else html.unescape(v) for v in values]


def test_bytes_read_in_the_wrong_encoding(spark):
    for good in ("añejo", "précio – 5 €", "“Zürich” §", "ÁÉÍÓÚ Ñ", "plain", "naïve café™"):
        wrong = good.encode().decode("cp1252", "replace")
        if "�" not in wrong:
            assert texts(spark, text.repaired, [wrong, good]) == [good, good]
        assert texts(spark, text.repaired, [good.encode().decode("latin-1")]) == [good]
    assert texts(spark, text.repaired, ["Ñandú y aÃ±ejo", None, ""]) == ["Ñandú y añejo", None, ""]


def test_weights_and_crops(spark):
    assert texts(spark, text.weight_kg, ["2 kilos", "1,5 kg", "900 gramos", "900 Gr", "1.5KG", "250 gms", "250 grs", "3 g", "nada", None]) == [None, 5.0, None, 0.9, 1.5, 0.25, 0.25, 0.003, None, None]
    assert texts(spark, lambda c: text.crop(c, text.CROP_PARTS), ["Papaya", "papa"]) == ["papa", "papa"] and texts(spark, text.crop, ["Papaya", "papa"]) == [None, "papa"]


def test_prices_that_are_no_numbers(spark):
    node = lambda name, price: {"name": name, "price": price}
    body = json.dumps([node("a", True), node("b", "$1,200.50"), node("c", 3), node("d", False)])
    got = retail.product_nodes(spark.createDataFrame([(1, body)], "page_id long, html string")).collect()
    assert sorted((r["nombre"], list(r["actuales"])) for r in got) == [("b", [1200.5]), ("c", [3.0])]


def test_long_row_spans(spark):
    rows_ = "".join(f"<tr><td>{i}</td></tr>" for i in range(1499))
    page = f'<table><tr><th>a</th><th>b</th></tr><tr><td rowspan="1500">x</td><td>first</td></tr>{rows_}</table>'
    got = pages.tables(spark.createDataFrame([(1, page)], "page_id long, html string")).where("not head").collect()
    assert len(got) == 1500 and all(r["cells"][0] == "x" and len(r["cells"]) == 2 for r in got)


def test_numbers_of_rows(spark):
    rng = np.random.default_rng(1)
    data = [(int(g), int(x), i) for i, (g, x) in enumerate(zip(np.r_[np.zeros(300), rng.integers(1, 5, 100)], rng.integers(0, 50, 400), strict=True))]
    df = spark.createDataFrame(data, "g int, x int, i int").repartition(7)
    got = {r["i"]: r["numero"] for r in orders.numbered(df, [F.col("x"), F.col("i")]).collect()}
    assert got == {i: n for n, (_, _, i) in enumerate(sorted(data, key=lambda r: (r[1], r[2])), 1)}
    got = {r["i"]: r["n"] for r in orders.numbered(df, [F.col("x").desc(), F.col("i")], "n", ["g"]).collect()}
    want = {}
    for group in range(5):
        want |= {r[2]: n for n, r in enumerate(sorted((r for r in data if r[0] == group), key=lambda r: (-r[1], r[2])), 1)}
    assert got == want
    assert orders.numbered(df.limit(0), [F.col("x")]).count() == 0


def test_catalogue_of_snapshots(spark):
    cols = "presa string, estado string, anio int, mes int, decena int"
    first = [("a", "X", 2020, 12, 3), ("a", "X", 2020, 12, 3), ("a", "Y", 2021, 1, 1), ("b", None, 1999, 1, 1)]
    second = [("a", "Z", 2021, 1, 1), ("a", "W", 2019, 5, 2), ("c", "Q", 2022, 7, 1)]
    made = lambda rows_: catalog.snapshot(spark.createDataFrame(rows_, cols))
    merged = catalog.merged(made(first).union(made(second)))
    again = catalog.merged(merged.union(made(second)))
    want = {r["presa"]: (r["periodos"], r["primero"], r["ultimo"]) for r in catalog.catalogue(spark.createDataFrame(first + second, cols)).collect()}
    for m in (merged, again):
        assert {r["presa"]: (r["periodos"], r["primero"], r["ultimo"]) for r in catalog.of_snapshots(m).collect()} == want
    assert {r["presa"]: r["estado"] for r in catalog.of_snapshots(merged).collect()} == {"a": "Z", "b": None, "c": "Q"}


def test_facts_of_parts(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 37).alias("k"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("fecha"))
    for name, part in (("a", df.where("id < 300")), ("b", df.where("id >= 300"))):
        facts = files.write_table(part, f"file://{tmp_path}/{name}", "fecha", ["k"], errors=F.col("id") % 10 == 0)
        assert facts.first()["filas"] == part.count()
    whole = files.table_facts(spark, [f"file://{tmp_path}/{n}" for n in "ab"]).first()
    assert (whole["filas"], whole["errores"], whole["distintos_k"], whole["fecha_max"]) == (1000, 100, 37, D(1, 9))


def test_files_that_fail(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "good.csv").write_text("a,b\n1,x\n2,ñ\n")
    (tmp_path / "d" / "cut.csv").write_text("a,b\n3,y\n4")
    (tmp_path / "d" / "latin.csv").write_bytes("a,b\n5,ñ\n6,z\n".encode("latin-1"))
    (tmp_path / "empty.csv").write_text("")
    good, bad = files.read_lines(spark, f"file://{tmp_path}", "a int, b string")
    assert sorted((r["a"], r["b"]) for r in good.collect()) == [(1, "x"), (2, "ñ"), (3, "y"), (6, "z")]
    assert sorted((r["archivo"], r["error"]) for r in bad.collect()) == [("cut.csv", "registro"), ("empty.csv", "vacio"), ("latin.csv", "codificacion")]


def events(spark, rows_):
    return spark.createDataFrame([(dt.datetime(2026, *t), k, v) for t, k, v in rows_], "ts timestamp, event_type string, value double")


@pytest.mark.parametrize("kind", ["decena", "semana"])
def test_streamed_buckets(spark, tmp_path, kind):
    """Batch after batch, with late rows, a restart from the checkpoint each time; every bucket once, then its state is gone."""
    batches = [
        [((1, 3, 5), "a", 1.0), ((1, 9, 5), "a", None), ((1, 12, 1), "b", 2.0)],
        [((1, 8, 23), "a", 4.0), ((1, 14, 3), "a", 5.0), ((1, 22, 1), "b", 1.0)],
        [((2, 20, 1), "b", 7.0), ((2, 11, 2), "a", -1.0)],
        [((6, 1, 1), "z", 0.0)],
        [((6, 2, 1), "z", 0.0)],
    ]
    root, done = f"file://{tmp_path}", []
    stream = lambda: spark.readStream.schema("ts timestamp, event_type string, value double").parquet(f"{root}/in")
    for batch in batches:
        done += batch
        events(spark, batch).coalesce(1).write.mode("append").parquet(f"{root}/in")
        buckets.run_to(buckets.streamed(stream(), kind), f"{root}/out", f"{root}/checkpoint")
    got = sorted(map(tuple, spark.read.schema(buckets.SUMS).parquet(f"{root}/out").collect()))
    want = sorted(map(tuple, buckets.bucketed(events(spark, done), kind).where("fin < date '2026-05-01'").collect()))
    assert got == want and len(got) > 3


def test_newest_row_of_a_batch(spark, tmp_path):
    root, cols = f"file://{tmp_path}", "k string, p int, v int, seq int"
    spark.createDataFrame([("a", 1, 9, 1), ("a", 1, 2, 5), ("b", 1, 3, 1)], cols).write.parquet(f"{root}/in")
    incremental.upsert_stream(spark.readStream.schema(cols).parquet(f"{root}/in"), f"{root}/t", ["k", "p"], f"{root}/c", "p", "seq").awaitTermination()
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{root}/t").collect()) == [("a", 2), ("b", 3)]


def test_load_window(spark):
    history = spark.createDataFrame([(D(2, 1),), (D(5, 1),)], "fecha date")
    there = spark.createDataFrame([(D(4, 20),)], "fecha date")
    assert water.load_window(history, D(6, 1)) == (D(2, 1), D(6, 1))
    assert water.load_window(history, D(6, 1), D(1, 1), there) == (D(3, 11), D(6, 1))
    assert water.load_window(history, D(6, 1), D(5, 5), there) == (D(5, 5), D(6, 1))
    assert water.load_window(history, D(6, 1), None, there.limit(0)) == (D(2, 1), D(6, 1))
    with pytest.raises(ValueError, match="no history"):
        water.load_window(history.limit(0), D(6, 1))
    with pytest.raises(ValueError, match="before the history"):
        water.load_window(history, D(1, 1))
    with pytest.raises(ValueError, match="empty"):
        water.load_window(history, D(3, 1), D(4, 1))


def test_report(spark):
    cols = "cultivo string, semana date, mediana double, mercados long, precio_uno double, precio_dos double, cambio double, cambio_uno double, cambio_dos double, spread_uno double, spread_dos double"
    week = spark.createDataFrame([("papa", D(1, 5), 9.0, 1, None, None, None, None, None, None, None), ("papa", D(1, 12), 1234.5, 2, 20.0, None, 0.125, -0.5, None, 0.3, None), ("chile_verde", D(1, 12), None, None, None, None, None, None, None, None, None)], cols)
    alert = spark.createDataFrame([(28, "papa", "m", 0.9), (28, "otro", "m", 1.0), (7, "chile_verde", "m", 1.0)], "horizonte int, cultivo string, mercado string, prob_10 double")
    told = json.loads(run.report(week, alert).first()["reporte"])
    assert told["por_omision"] == "papa" and sorted(told["cultivos"]) == ["chile_verde", "papa"]
    papa = told["cultivos"]["papa"]
    assert papa["semana"] == "12/01/2026 a 18/01/2026" and papa["etiqueta"] == "Papa" and papa["ultima"]["mercados"] == 2
    assert papa["tarjetas"] == {
        "precio_mercados": "$1,234.50/kg", "precio_uno": "$20.00/kg", "precio_dos": "s/d", "cambio_mercados": "+12.5%", "cambio_uno": "-50.0%", "cambio_dos": "s/d", "spread_uno": "+30.0%", "spread_dos": "s/d", "mercados_cubiertos": "2",
    }
    assert told["cultivos"]["chile_verde"]["etiqueta"] == "Chile verde" and set(told["cultivos"]["chile_verde"]["tarjetas"].values()) == {"s/d"}


def test_normal_distribution(spark):
    """The polynomial against the error function."""
    rows_ = [(float(z),) for z in np.linspace(-6, 6, 121)]
    got = spark.createDataFrame(rows_, "z double").select("z", numbers.below(F.col("z"), F.lit(0.0), F.lit(-1.2815), F.lit(1.2815)).alias("p")).collect()
    assert all(abs(r["p"] - 0.5 * (1 + math.erf(r["z"] / math.sqrt(2)))) < 2e-4 for r in got)


def test_trees_of_classes(spark):
    rng = np.random.default_rng(3)
    x, k = rng.normal(size=600), rng.choice(list("ab"), 600)
    y = (x + (k == "b") > 0.5).astype(float)
    rows_ = [(1, bool(i % 4 == 0), i, float(x[i]), str(k[i]), float(y[i])) for i in range(600)]
    df = spark.createDataFrame(rows_, "horizonte int, prueba boolean, i int, x double, k string, y double")
    fit = trees.boosted(df, [trees.Fit("c", 1, "y", classes=True)], ["x"], ["k"], ["i"], trees=12, depth=3, rate=0.4)["c"]
    again = trees.Model.from_json(fit.to_json())
    told = trees.predicted(df.where("prueba"), {1: again}, "p").collect()
    assert all(0 < r["p"] < 1 for r in told) and np.mean([(r["p"] > 0.5) == (r["y"] > 0.5) for r in told]) > 0.93
    assert {n for n, _ in fit.importances()} <= {"x", "k_a", "k_b"}


def test_all_analyses(spark, tmp_path):
    """Every table is made, by forecasts of trees or of the simple methods, and published."""
    from cosecha.queries import _annual_records
    from cosecha.sources.driver import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    got = run.analyses(t.wholesale(), t.retail(), t.dams(), t.weather(), t.progress(), t.annual(), _annual_records(t), folder=f"file://{tmp_path}/models", trees=2, depth=2)
    assert {"water_methods", "price_methods", "production_forecast", "price_report", "price_importances", "price_top"} <= set(got)
    assert {r["horizonte"] for r in got["price_methods"].collect()} == {7, 14, 28} and {r["horizonte"] for r in got["water_methods"].collect()} == {3, 6, 9}
    assert json.loads(got["price_report"].first()["reporte"])["cultivos"]
    assert len(trees.read_models(f"file://{tmp_path}/models/agua", spark)) == 6
    for name in ("water_alerts", "price_alerts", "price_top", "production_top_volume"):
        assert got[name].count() > 0


def test_forced_methods(spark):
    cols = "cultivo string, mercado string, fecha date, precio double, lag_7 double, media_28 double, objetivo_7 double"
    f = spark.createDataFrame([("c", "m", D(1, 1) + dt.timedelta(i), float(i), float(i), float(i), float(i + 1)) for i in range(40)], cols)
    r = prices.train(f, (7,), forced="arboles", least=1, trees=2, depth=1)
    assert [(c["metodo"], c["motivo"]) for c in r.choice.collect()] == [("arboles", "forzado")]
    with pytest.raises(ValueError, match="no such method"):
        prices.train(f, (7,), forced="otro", least=1, trees=1, depth=1)
    with pytest.raises(ValueError, match="labelled rows"):
        production.nowcast(spark.createDataFrame([], "cultivo string, estado string, anio int, corte date, final double"), forced="arboles")


def test_overrides_of_work(spark):
    config = spark.createDataFrame([("uno", "si", "propia"), ("dos", "si", " "), ("tres_x", "si", None), ("no", "no", "x")], "producto_canonico string, activo string, busqueda string")
    got = records.work_list(config, {"uno": "del mapa", "dos": "del mapa"}, "busqueda").collect()
    assert {r["producto_canonico"]: r["consulta"] for r in got} == {"uno": "propia", "dos": "del mapa", "tres_x": "tres x"}


def test_bands_are_exact_quantiles(spark):
    rng = np.random.default_rng(7)
    miss = rng.normal(size=501)
    rows_ = [(7, True, float(m), 0.0) for m in miss]
    target = spark.createDataFrame(rows_, "horizonte int, prueba boolean, objetivo double, precio double")
    choice = spark.createDataFrame([(7, "persistencia")], "horizonte int, metodo string")
    r = models.bands(target, choice, {"persistencia": F.col("precio")}).first()
    assert (r["r10"], r["r90"]) == pytest.approx((np.quantile(miss, 0.1), np.quantile(miss, 0.9)), abs=1e-12)
