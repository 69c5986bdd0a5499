"""Retail offers from pages whose data have no fixed shape: product-like nodes anywhere in embedded JSON, their prices,
units and ranks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cosecha.functions import numbers, text
from cosecha.operators import rows

NODE = "page_id long, nombre string, marca string, tipo_venta string, precio_texto string, categorias array<string>, actuales array<double>, anteriores array<double>, enlace string"
NAMES = ("name", "productName", "title")

# Fields of current and of former prices, in lower case, of products, plain offers and sellers' offers
NOW = {
    "product": ("price", "currentprice", "spotprice", "pricevalue", "bestprice", "sellprice", "sellingprice", "pricewithtax"),
    "offer": ("price", "pricevalue", "bestprice", "lowprice"),
    "seller": ("price", "pricevalue", "bestprice"),
}
BEFORE = {
    "product": ("oldprice", "listprice", "pricewithoutdiscount", "highprice", "wasprice"),
    "offer": ("oldprice", "highprice", "listprice", "pricewithoutdiscount"),
    "seller": ("listprice", "highprice", "wasprice", "pricewithoutdiscount"),
}
WEIGHED = ("por kg", "por kilo")
FRESH_BRAND, FRESH_CATEGORIES = "frutas y verduras frescas", ("frutas y verduras", "frutas", "verduras")
FRESH_TERMS = ("por pieza", "por kilo", "manojo", "malla", "bolsa")
BY_WEIGHT = "EACH_WEIGHT"

_FIRST_NUMBER = re.compile(r"\d+(?:\.\d+)?")


def _number(value) -> float | None:
    """A number, or the first one in a text with thousands commas."""
    if isinstance(value, bool):
        return None
    if isinstance(value, int | float):
        return float(value)
    found = _FIRST_NUMBER.search(str(value).replace(",", "")) if value is not None else None
    return float(found[0]) if found else None


def _dicts(value) -> list[dict]:
    return [x for x in (value if isinstance(value, list) else [value]) if isinstance(x, dict)]


def _prices(node: dict, weighed: bool) -> tuple[list[float], list[float]]:
    """(current prices, former prices) of a product, its offers and its sellers' offers.

    The range of an aggregate offer is no promotion: of goods that are weighed its high end is the price of a kilo and
    its low end the least amount that can be bought, of other goods the low end is the price.
    """
    sources, now = [("product", node)], []
    for offer in _dicts(node.get("offers")):
        if str(offer.get("@type", "")).lower() != "aggregateoffer":
            sources.append(("offer", offer))
            continue
        low, high = offer.get("lowPrice"), offer.get("highPrice")
        now.append(next((x for x in ((high, low) if weighed else (low, high)) if x is not None), None))
        if not weighed:
            now += [inner.get(k) for inner in _dicts(offer.get("offers")) for k in ("price", "priceValue", "bestPrice")]
    for item in _dicts(node.get("items")):
        for seller in _dicts(item.get("sellers")):
            sources += [("seller", x) for k in ("commertialOffer", "commercialOffer") for x in _dicts(seller.get(k))][:1]
    told = [(kind, str(k).lower(), v) for kind, held in sources for k, v in held.items()]
    now += [v for kind, k, v in told if k in NOW[kind]]
    before = [v for kind, k, v in told if k in BEFORE[kind]]
    return tuple([p for p in map(_number, values) if p is not None] for values in (now, before))


def _nodes(value):
    """Every object inside a JSON value, itself included."""
    stack = [value]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            yield x
            stack.extend(reversed(x.values()))
        elif isinstance(x, list):
            stack.extend(reversed(x))


def product_nodes(pages: DataFrame) -> DataFrame:
    """Objects with a name and a price in a page's JSON scripts; of equal names on a page the first by price, name and all
    that is read stays, also where several rows are one page.

    The depth is unknown, so the walk is Python, in Arrow batches; everything after it is columns.
    """
    script = r"(?is)<script[^>]*(?:application/(?:ld\+)?json|id=\"?(?:__NEXT_DATA__|data))[^>]*>(.*?)</script>"
    bodies = F.when(F.trim("html").rlike(r"^[\[{]"), F.array(F.trim("html"))).otherwise(F.regexp_extract_all("html", F.lit(script), F.lit(1)))
    own = pages.select("page_id", F.explode(bodies).alias("json"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for page_id, body in zip(part["page_id"], part["json"], strict=True):
                try:
                    value = json.loads(body)
                except ValueError:
                    continue
                for node in _nodes(value):
                    name = next((str(node[k]) for k in NAMES if node.get(k)), None)
                    if not name:
                        continue
                    now, before = _prices(node, any(w in name.lower() for w in WEIGHED))
                    if now:
                        brand, info, path = node.get("brand"), node.get("priceInfo"), node.get("category")
                        info = info if isinstance(info, dict) else {}
                        names = [str(x["name"]) for x in _dicts(path.get("path")) if x.get("name")] if isinstance(path, dict) else None
                        line = info.get("linePrice") or info.get("itemPrice")
                        out.append((page_id, name, brand.get("name") if isinstance(brand, dict) else brand, node.get("salesUnitType"), line, names, now, before, node.get("url") or node.get("link")))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in NODE.split(", ")])

    found = own.mapInPandas(run, NODE).withColumn("clave", text.spaced(F.col("nombre")))
    rest = [F.col("enlace"), F.col("marca"), F.col("tipo_venta"), F.col("precio_texto"), F.array_join("categorias", " > "), F.array_max("anteriores")]
    return rows.best(found.where("clave <> ''"), ["page_id", "clave"], [F.array_min("actuales"), F.col("nombre"), *[c.asc_nulls_last() for c in rest]])


def _has(key: Column, *terms: str) -> Column:
    return F.exists(F.array(*map(F.lit, terms)), lambda t: F.contains(key, t))


def unit_of_title(name: Column) -> Column:
    """kg, pieza, rollo, malla or g_pack, from a title alone; else null."""
    key = text.spaced(name)
    out = F.when(_has(key, *WEIGHED), "kg").when(_has(key, "pieza"), "pieza").when(_has(key, "rollo"), "rollo").when(_has(key, "malla", "enmallado"), "malla")
    return out.when(text.weight_kg(name).isNotNull(), "g_pack")


def unit_of_item(name: Column, price_text: Column, sale: Column) -> Column:
    """The unit in the price's text, kg for what is sold by weight, else what the title tells; else null."""
    key = text.spaced(name)
    out = F.when(sale == BY_WEIGHT, "kg").when(_has(key, "por kilo"), "kg").when(_has(key, "por pieza"), "pieza")
    for word in ("manojo", "malla", "bolsa"):
        out = out.when(_has(key, word), word)
    out = out.when(F.lower(name).rlike(r"\b\d+(?:\.\d+)?\s*g(?:r|rs|ms)?\b"), "g_pack")
    return F.coalesce(text.price_and_unit(price_text)[1], out)


def fresh(name: Column, brand: Column, categories: Column, sale: Column) -> Column:
    """Fresh produce by brand, category, sale by weight or the terms of its title."""
    listed = F.exists(categories, lambda c: text.spaced(c).isin(*FRESH_CATEGORIES))
    told = [text.spaced(brand) == FRESH_BRAND, listed, sale == BY_WEIGHT, _has(text.spaced(name), *FRESH_TERMS)]
    out = F.lit(False)
    for t in told:
        out = out | F.coalesce(t, F.lit(False))
    return out


def offers(nodes: DataFrame, configured: DataFrame | None = None) -> DataFrame:
    """Current and old price (kept only if higher), unit, weight, price per kg, promotion and freshness of each node.

    Nodes that tell how they are sold or their categories follow the rules of items; those with no more than a title
    follow the rules of titles, and count as fresh.  ``configured`` (page_id, cultivo_pedido and, if there, consulta), a
    table of settings: offers of another crop than the one asked for go.
    """
    item = F.col("tipo_venta").isNotNull() | F.col("precio_texto").isNotNull() | F.col("categorias").isNotNull()
    now, high = F.array_min("actuales"), F.array_max("anteriores")
    unit = F.when(item, unit_of_item(F.col("nombre"), F.col("precio_texto"), F.col("tipo_venta"))).otherwise(unit_of_title(F.col("nombre")))
    is_fresh = ~item | fresh(F.col("nombre"), F.col("marca"), F.col("categorias"), F.col("tipo_venta"))
    out = nodes.withColumns({"precio": now, "antes": F.when(high > now, high), "unidad": unit, "kg": text.weight_kg(F.col("nombre")), "cultivo": text.crop(F.col("nombre")), "fresco": is_fresh})
    out = out.withColumns({"promocion": F.col("antes").isNotNull(), "precio_kg": numbers.price_per_kg(F.col("precio"), F.col("unidad"), F.col("kg"))})
    if configured is not None:
        out = out.join(F.broadcast(configured), "page_id", "left").where("cultivo is null or cultivo_pedido is null or cultivo = cultivo_pedido")
    return out.drop("actuales", "anteriores")


def records(offer: DataFrame, asked: DataFrame, base: str, fallback: str) -> DataFrame:
    """Offers as the records of a run: page, query, product as written, as asked for and as inferred, and all that was read.

    ``asked`` (page_id, cultivo_pedido, consulta) says what each page was fetched for, told twice or once; offers of no
    crop, or of another than the one asked for, go.
    """
    out = offer.join(asked.select("page_id", "cultivo_pedido", "consulta").distinct(), "page_id", "left")
    out = out.where("cultivo is null or cultivo_pedido is null or cultivo = cultivo_pedido")
    out = out.select(
        "page_id", text.source_page([F.coalesce("enlace", F.lit(""))], base, fallback).alias("pagina"), "consulta", F.col("nombre").alias("producto_crudo"), F.coalesce("cultivo_pedido", "cultivo").alias("producto"),
        F.col("cultivo").alias("inferido"), "precio", "antes", "promocion", "unidad", "precio_kg", F.col("kg").alias("peso_kg"), "tipo_venta", "marca", F.array_join("categorias", " > ").alias("categoria"), "fresco",
    )
    return out.where("producto is not null")


def unique_offers(record: DataFrame) -> DataFrame:
    """One record for each product, name and price: fresh first, then with a price per kg, then by page."""
    order = [F.col("fresco").desc(), F.col("precio_kg").asc_nulls_last(), F.col("page_id")]
    return rows.best(record.withColumn("__clave", text.spaced(F.col("producto_crudo"))), ["producto", "__clave", "precio"], order).drop("__clave")


def best_per_crop(offer: DataFrame, preferred: DataFrame | None = None) -> DataFrame:
    """One offer for each crop: fresh first, then by kg, with a price per kg, promotions, asked by a preferred term, price.

    ``preferred`` (cultivo, termino), a table of settings, goes with the column ``consulta``: crops without terms have
    no preference.  Ties fall to name and page.
    """
    unit = F.when(F.col("unidad") == "kg", 0).when(F.col("precio_kg").isNotNull(), 1).otherwise(2)
    relevant = F.lit(0)
    if preferred is not None:
        terms = preferred.groupBy("cultivo").agg(F.collect_set(text.spaced(F.col("termino"))).alias("__terms"))
        offer = offer.join(F.broadcast(terms), "cultivo", "left")
        relevant = F.when(F.col("__terms").isNull() | F.array_contains("__terms", text.spaced(F.col("consulta"))), 0).otherwise(1)
    order = [F.col("fresco").desc(), unit, F.col("promocion").desc(), relevant, F.coalesce(F.nullif("precio_kg", F.lit(0.0)), F.nullif("precio", F.lit(0.0)), F.lit(999999.0)), F.col("nombre"), F.col("page_id")]
    return rows.best(offer.where("cultivo is not null"), ["cultivo"], order).drop("__terms")
