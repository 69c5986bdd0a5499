"""Typed records, configuration tables and retail nodes on small tables."""

import datetime as dt
import json

from pyspark.sql import functions as F

from cosecha.functions import text
from cosecha.plans import retail, run
from cosecha.sources import records


def test_weather_payload(spark):
    payload = {"properties": {"parameter": {"PRECTOTCORR": {"20260101": 2.0, "20260102": -999.0}, "T2M": {"20260103": 20.0}}}}
    got = {r["fecha"]: (r["lluvia"], r["temperatura"], r["maxima"]) for r in records.weather_rows(spark.createDataFrame([(1, json.dumps(payload)), (2, None)], "presa long, json string")).collect()}
    assert got == {dt.date(2026, 1, 1): (2.0, None, None), dt.date(2026, 1, 2): (None, None, None), dt.date(2026, 1, 3): (None, 20.0, None)}


def test_dam_record(spark):
    record = {"CveCONAGUAPresa": " ABC ", "nombreComun": "El&nbsp;Ni&ntilde;o  ", "anio": "2026", "cveMes": "4", "cveDecena": "3", "porcAlmacen": "81.5", "NAME": "1,234.5", "NAMO": "-"}
    r = records.dam_records(spark.createDataFrame([(json.dumps([record]),)], "json string")).first()
    assert (r["presa"], r["nombre_presa"], r["fecha"], r["pct"], r["name"], r["namo"]) == ("ABC", "El Niño", dt.date(2026, 4, 30), 81.5, 1234.5, None)


def test_row_without_time_wins(spark):
    day = dt.date(2026, 1, 10)
    one = spark.createDataFrame([("A", day, 1.0, 1.0)], "presa string, fecha date, pct double, hm3 double")
    two = spark.createDataFrame([("A", day, 2.0, 1.0, dt.datetime(2026, 1, 11)), ("B", None, 2.0, 1.0, None)], "presa string, fecha date, pct double, hm3 double, extraido timestamp")
    assert [r["pct"] for r in records.dam_history([one, two]).collect()] == [1.0]


def test_progress_and_annual_files(spark):
    p = spark.createDataFrame([("Papa", "X", "2026", "2", "100", "avance_2026_febrero.csv"), ("Papa", "X", "2026", "2", "120", "avance_2026_marzo.csv"), (None, "X", "2026", "13", "1", "maiz_2026.csv")], "`Producto canonico` string, Entidad string, anio string, `Mes corte` string, `Superficie sembrada (ha)` string, source_file string")
    got = records.progress_history(p).collect()
    assert [(r["cultivo"], r["corte"], r["sembrada"]) for r in got] == [("papa", dt.date(2026, 2, 28), 120.0)]
    a = spark.createDataFrame([(None, "X", "10", "cebolla_2024.csv")], "producto_canonico string, entidad string, produccion string, source_file string")
    assert [(r["cultivo"], r["anio"], r["produccion"]) for r in records.annual_history(a).collect()] == [("cebolla", 2024, 10.0)]


def test_crop_resolution(spark):
    names = spark.createDataFrame([("Papa alfa", "papa"), ("Maiz grano", "maiz")], "nombre string, cultivo string")
    r = spark.createDataFrame([("cebolla", None, None, "f.csv"), (None, "PAPA Alfa", None, "f.csv"), (None, "?", "Maíz grano (Ton)", "f.csv"), (None, None, None, "limon_2024.csv")], "cultivo string, nombre string, etiqueta string, source_file string")
    assert sorted(x["cultivo"] for x in records.resolved_crops(r, names, "nombre", "etiqueta").collect()) == ["cebolla", "limon", "maiz", "papa"]


def test_numbers_only_if_most_are(spark):
    df = spark.createDataFrame([("1,000", "x"), ("2", "3"), ("-", "y"), ("", None)], "a string, b string")
    out = records.numbers_if_most(df, ["a", "b"])
    assert dict(out.dtypes) == {"a": "double", "b": "string"} and [r["a"] for r in out.collect()] == [1000.0, 2.0, None, None]


def test_configuration(spark):
    t = spark.createDataFrame([("Si", "Tomate", "a | b", None, "7"), ("no", "Papa", "", "x", None), ("1", "Chile Jalapeño", None, "chile", "z")], "activo string, producto_canonico string, terminos_busqueda_walmart string, cultivo_avance_agricola string, sniim_id_producto string")
    got = {r["producto_canonico"]: r for r in records.product_config(t).collect()}
    assert set(got) == {"tomate_rojo", "chile_verde"} and got["tomate_rojo"]["terminos_busqueda_walmart"] == ["a", "b"]
    assert got["chile_verde"]["sniim_id_producto"] is None and got["chile_verde"]["sniim_id_precios_por"] == 2
    work = {r["producto_canonico"]: r["consulta"] for r in records.work_list(t, {"tomate_rojo": "Jitomate"}, "cultivo_avance_agricola").collect()}
    assert work == {"tomate_rojo": "Jitomate", "chile_verde": "chile"}
    good, bad = records.query_config(spark.createDataFrame([("x", "2026", "4", "3"), ("x", "2026", "13", "a")], "activo string, anio string, mes string, decena string"))
    assert good.count() == 1 and bad.first()["errors"] == ["mes", "decena"]


def test_planting_rows(spark):
    t = spark.createDataFrame([("siembra", "Papa", "SONORA", "2024", "5"), ("siembra", "Papa", "Estados", "2024", "5"), ("siembra", "Otro", "Sonora", "2024", "5"), ("siembra", "Papa", "Sonora", "2020", "5")], "tipo string, cultivo string, estados string, anio string, jan string")
    assert [(r["tipo"], r["cultivo"], r["estado"], r["anio"], r["m01"], r["m02"]) for r in records.planting_history(t, [2023, 2024], {"papa": "papa"}).collect()] == [("SIEMBRA", "papa", "Sonora", 2024, 5.0, None)]


def test_retail_nodes(spark):
    data = {"a": [{"name": "Papa blanca 900 g", "price": "18", "offers": [{"highPrice": 20}]}, {"name": "PAPA Blanca 900 g", "price": 17}, {"title": "Puré de papa", "price": 9.5, "salesUnitType": "EACH"}], "b": {"name": "sin precio"}}
    html = f'<html><script type="application/ld+json">{json.dumps(data)}</script><script type="application/ld+json">not json</script></html>'
    page = spark.createDataFrame([(1, html), (2, None), (3, json.dumps([{"productName": "Jitomate por kg", "price": 30}]))], "page_id long, html string")
    nodes = retail.product_nodes(page)
    assert nodes.count() == 3
    got = {r["nombre"]: r for r in retail.offers(nodes, spark.createDataFrame([(1, "papa"), (3, "papa")], "page_id long, cultivo_pedido string")).collect()}
    assert set(got) == {"PAPA Blanca 900 g", "Puré de papa"} and not got["Puré de papa"]["fresco"] and got["PAPA Blanca 900 g"]["fresco"]
    assert got["PAPA Blanca 900 g"]["precio_kg"] == 18.8889 and got["PAPA Blanca 900 g"]["unidad"] == "g_pack" and got["Puré de papa"]["unidad"] is None
    best = {r["cultivo"]: r["nombre"] for r in retail.best_per_crop(retail.offers(nodes)).collect()}
    assert best == {"papa": "PAPA Blanca 900 g", "tomate": "Jitomate por kg"}


def test_prices_of_offers(spark):
    ranged = {"@type": "AggregateOffer", "lowPrice": 3, "highPrice": 20, "offers": [{"price": 2.5}]}
    sold = [{"sellers": [{"commertialOffer": {"Price": 18, "ListPrice": 24, "PriceWithoutDiscount": 23}}]}]
    rows = [
        {"name": "Tomate por kg", "offers": ranged},
        {"name": "Tomate en malla", "offers": ranged},
        {"name": "Limon por kilo", "items": sold, "offers": ranged},
        {"name": "Mango", "offers": {"price": "$1,059.50", "highPrice": "1069"}, "salesUnitType": "EACH_WEIGHT"},
        {"name": "Cebolla bolsa", "price": 10, "listPrice": 10, "category": {"path": [{"name": "Verduras"}]}, "priceInfo": {"linePrice": "$10.00/pza"}},
        {"name": "Refresco", "price": 10, "brand": "otra", "category": {"path": [{"name": "Bebidas"}]}},
    ]
    page = spark.createDataFrame([(1, json.dumps(rows))], "page_id long, html string")
    got = {r["nombre"]: (r["precio"], r["antes"], r["unidad"], r["promocion"], r["fresco"]) for r in retail.offers(retail.product_nodes(page)).collect()}
    assert got == {
        "Tomate por kg": (20, None, "kg", False, True), "Tomate en malla": (2.5, None, "malla", False, True), "Limon por kilo": (18, 24, "kg", True, True),
        "Mango": (1059.5, 1069, "kg", True, True), "Cebolla bolsa": (10, None, "pza", False, True), "Refresco": (10, None, None, False, False),
    }


def test_cards_and_runs(spark, tmp_path):
    week = spark.createDataFrame([("papa", dt.date(2026, 1, 5), 10.0, None, 2), ("papa", dt.date(2026, 1, 12), 11.0, 0.1, 2)], "cultivo string, semana date, mediana double, cambio double, mercados int")
    assert json.loads(run.cards(week).first()["tarjeta"]) == {"semana": "2026-01-12", "mediana": 11.0, "cambio": 0.1, "mercados": 2}
    rows = spark.range(3).withColumn("x", F.lit("a"))
    for _ in range(2):
        records.write_run(rows, rows.limit(0), rows.limit(1), str(tmp_path), "2026-01-01", "s")
    records.write_run(rows, rows, rows, str(tmp_path), "2026-01-02", "s")
    assert spark.read.parquet(str(tmp_path / "data")).count() == 6


def test_request_ranges(spark):
    t = spark.createDataFrame([
        ("si", "serie_presa", "X", None, "2005", "1", "1", None, None), ("si", "serie_presa", None, None, "2005", "1", "1", None, None), ("si", "presas_estado", None, "Sonora", "2020", "12", "3", "2021", None),
        ("si", "presas_periodo", None, None, "2020", "1", "1", None, "2019"), ("no", "otra", None, None, None, None, None, None, None), ("si", "otra", None, None, "2020", "13", "4", None, None),
    ], "activo string, tipo_consulta string, id_conagua string, estado string, anio string, mes string, decena string, anio_inicial string, anio_final string")
    good, bad = records.request_ranges(t)
    assert [(r["desde"], r["hasta"]) for r in good.collect()] == [(1999, 2005)]
    assert sorted(r["errors"] for r in bad.collect()) == [["anio_final"], ["anio_inicial"], ["presa"], ["tipo_consulta", "mes", "decena"]]


def test_proxy_defaults(spark):
    every = records.proxy_config(spark)
    assert every.count() == 21 and every.where("fuente = 'fred'").count() == 10
    blank = spark.createDataFrame([(None, None)], "activo string, serie string")
    assert records.proxy_config(spark, blank).count() == 21
    own = records.proxy_config(spark, spark.createDataFrame([("x", "Maize"), (None, None)], "activo string, serie string")).collect()
    assert [(r["activo"], r["serie"], r["moneda"]) for r in own] == [(True, "Maize", None)]


def test_dam_records_decode_all_texts_at_once(spark):
    """One decoder for the eight texts of a record, with their results as before; a field that is missing or blank is null."""
    record = {"CveCONAGUAPresa": " A&ntilde;o&nbsp;", "nombreEstado": "M&eacute;xico", "nombreOficial": " ", "nombreUso": "a  b", "porcAlmacen": "1,000.5", "anio": "2020", "cveMes": "2", "cveDecena": "3"}
    out = records.dam_records(spark.createDataFrame([(json.dumps([record, {}]),)], "json string"))
    a, b = sorted(out.collect(), key=lambda r: r["presa"] is None)
    assert (a["presa"], a["estado"], a["nombre_oficial"], a["uso_principal"], a["pct"], str(a["fecha"])) == ("Año", "México", None, "a b", 1000.5, "2020-02-29")
    assert all(v is None for v in b)
    decoders = lambda df: df._jdf.queryExecution().analyzed().toJSON().count("expressions.ArrayJoin")
    one = spark.createDataFrame([("x",)], "x string").select(text.decoded(F.col("x")))
    assert decoders(out) == decoders(one) > 0
