"""Raw web pages as a table: classes of pages, embedded JSON offers, and HTML tables as rows of cells."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cosecha.functions import text
from cosecha.operators import rows

OFFERS = "struct<props:struct<items:array<struct<type:string,id:bigint,name:string,brand:string,price:double,priceMax:double,unit:string>>>>"


# What blocked pages and pages without records say
BLOCKED = "captcha|access denied|robot check|(?s)verifica tu identidad.*no eres un robot"
NO_RECORDS = "sin registros|no se encontraron|no records|no hay registros|no existen registros"


def product_of_page(html: Column) -> Column:
    """The product that a report is about: the value behind its label, else the first filled cell of the row below a header
    cell that says so; null if there is none."""
    shown = lambda cell: text.blank_to_null(text.decoded(F.regexp_replace(cell, "<[^>]*>", " ")))
    labelled = F.regexp_extract(html, r'(?is)Producto</td>.*?Calidad</td>.*?<td[^>]*class="DatTAB2"[^>]*>\s*&nbsp;&nbsp;(.*?)</td>', 1)
    below = F.regexp_extract(html, r"(?is)<t[dh][^>]*>\s*Producto\s*</t[dh]>.*?</tr>\s*<tr[^>]*>(.*?)</tr>", 1)
    cells = F.transform(F.regexp_extract_all(below, F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), shown)
    return F.coalesce(shown(labelled), F.try_element_at(F.filter(cells, lambda x: x.isNotNull()), F.lit(1)))


def classified(pages: DataFrame) -> DataFrame:
    """What kind of page each is, with its title, the product that it is about, and its host."""
    low = F.lower("html")
    kind = F.when(F.col("html").isNull() | (F.trim("html") == ""), "vacia").when(low.rlike(BLOCKED), "bloqueada").when(low.rlike(NO_RECORDS), "sin_registros").otherwise("contenido")
    title = text.decoded(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    return pages.select("page_id", kind.alias("clase"), title.alias("titulo"), product_of_page(F.col("html")).alias("producto"), F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("sitio"))


def offers(pages: DataFrame) -> DataFrame:
    """Products of the JSON in a page's data script: name, brand, crop, price now and before, unit, price per kg."""
    body = F.regexp_extract("html", r'(?s)<script id="data"[^>]*>(.*?)</script>', 1)
    item = F.explode(F.from_json(body, OFFERS)["props"]["items"]).alias("i")
    out = pages.select("page_id", item).where("i.type = 'Product'").select("page_id", F.col("i.id").alias("id"), F.col("i.name").alias("nombre"), F.col("i.brand").alias("marca"), F.col("i.price").alias("precio"), F.when(F.col("i.priceMax") > F.col("i.price"), F.col("i.priceMax")).alias("antes"), F.col("i.unit").alias("unidad"))
    return out.withColumns({"cultivo": text.crop(F.col("nombre")), "clave": text.slug(F.col("nombre")), "promocion": F.col("antes").isNotNull()})


def best_offers(offer: DataFrame) -> DataFrame:
    """One offer per key: promotions first, then the price, then the id."""
    return rows.best(offer, ["clave"], [F.col("promocion").desc(), F.col("precio").asc_nulls_last(), F.col("id")])


_PLAIN_START, _PLAIN_END = re.compile("<(t[rdh]|table|thead|tbody)>"), re.compile("</(t[rdh]|table|thead|tbody)>")
COLUMN_SPAN, ROW_SPAN = 1000, 65_534  # the most columns and rows that a cell may span, as in HTML itself


class _Cells(HTMLParser):
    """(table, row, head, cells) of all tables of a page, those inside others included; a cell stands in every column
    and row that it spans.  ``head``: the row lies in a table head, or has header cells only."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, int, bool, list[str]]] = []
        self.open: list[dict] = []
        self.tables = 0

    def updatepos(self, i, j):
        """Lines are not counted."""
        return j

    def parse_starttag(self, i):
        """As the parser does, in one step for the plain tags of tables."""
        if found := _PLAIN_START.match(self.rawdata, i):
            self.handle_starttag(found[1], ())
            return found.end()
        return super().parse_starttag(i)

    def parse_endtag(self, i):
        if self.cdata_elem is None and (found := _PLAIN_END.match(self.rawdata, i)):
            self.handle_endtag(found[1])
            return found.end()
        return super().parse_endtag(i)

    def _cell(self) -> None:
        t = self.open[-1] if self.open else None
        if t and t["text"] is not None:
            t["cells"].append((" ".join("".join(t["text"]).split()), *t["span"]))
            t["text"] = None

    def _row(self) -> None:
        self._cell()
        t = self.open[-1] if self.open else None
        if not t or not t["cells"]:
            return
        out, below, own = [], {}, iter(t["cells"])
        cell = next(own, None)
        while cell or len(out) in t["below"]:
            if len(out) in t["below"]:
                text, rest = t["below"][len(out)]
                if rest > 1:
                    below[len(out)] = (text, rest - 1)
                out.append(text)
                continue
            text, columns, rest = cell
            for _ in range(columns):
                if rest > 1:
                    below[len(out)] = (text, rest - 1)
                out.append(text)
            cell = next(own, None)
        self.rows.append((t["table"], t["row"], t["in_head"] or t["headers"], out))
        t.update(row=t["row"] + 1, cells=[], below=below, headers=True)

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append({"table": self.tables, "row": 0, "cells": [], "text": None, "span": (1, 1), "below": {}, "in_head": False, "headers": True})
            self.tables += 1
        elif not self.open:
            return
        elif tag in ("thead", "tbody"):
            self._row()
            self.open[-1].update(in_head=tag == "thead", below={})
        elif tag == "tr":
            self._row()
        elif tag in ("td", "th"):
            self._cell()
            spans = dict(attrs)
            number = lambda name, most: max(1, min(most, int(v))) if (v := (spans.get(name) or "").strip()).isdecimal() else 1
            span = (number("colspan", COLUMN_SPAN), number("rowspan", ROW_SPAN)) if spans else (1, 1)
            self.open[-1].update(text=[], span=span, headers=self.open[-1]["headers"] and tag == "th")

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self._cell()
        elif tag in ("tr", "thead") and self.open:
            self._row()
            if tag == "thead":
                self.open[-1].update(in_head=False, below={})
        elif tag == "table" and self.open:
            self._row()
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1]["text"] is not None:
            self.open[-1]["text"].append(data)


def tables(pages: DataFrame) -> DataFrame:
    """(page_id, table_no, row_no, head, cells) of every row of every table in the pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cells = _Cells()
                cells.feed(page or "")
                cells.close()
                out += [(page_id, *r) for r in cells.rows]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), ROW.types, strict=True)], schema=ROW)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "html").mapInArrow(run, "page_id long, table_no int, row_no int, head boolean, cells array<string>")


ROW = pa.schema([("page_id", pa.int64()), ("table_no", pa.int32()), ("row_no", pa.int32()), ("head", pa.bool_()), ("cells", pa.list_(pa.string()))])

# Names of report columns
REPORT_ALIASES = {
    "superficie_ha_sembrada": "superficie_sembrada_ha", "superficie_ha_cosechada": "superficie_cosechada_ha", "superficie_ha_siniestrada": "superficie_siniestrada_ha",
}


def report_table(cells: DataFrame, terms: Sequence[str] = (), aliases: Mapping[str, str] = REPORT_ALIASES) -> DataFrame:
    """Of each page the largest table, as (page_id, row_no, column, value); with ``terms`` the one with the most columns
    of these names, of equals the largest; of equals the first.

    Leading header rows are joined to one name for each column, each text once; without any the first row is the header.
    A column without a name is ``numero``; of columns with one name the first stays; blank rows go, blank cells are null.
    """
    # a table is one row, as its page was, so all of it meets in one shuffle by page
    row = F.struct("row_no", "head", "cells")
    table = cells.repartition("page_id").groupBy("page_id", "table_no").agg(F.array_sort(F.collect_list(row)).alias("r"))
    wide = lambda part: F.array_max(F.transform(part, lambda x: F.size(x["cells"])))
    first = F.array_min(F.transform(F.filter("r", lambda x: ~x["head"]), lambda x: x["row_no"]))
    table = table.withColumn("body", F.greatest(F.coalesce(first, F.size("r")), F.lit(1)))
    head = F.filter("r", lambda x: x["row_no"] < F.col("body"))
    table = table.withColumns({"area": (F.size("r") - F.col("body")) * wide("r"), "head": head, "r": F.filter("r", lambda x: x["row_no"] >= F.col("body"))})

    def column(at: Column) -> Column:
        cell = F.filter(F.transform("head", lambda x: F.get(x["cells"], at)), lambda x: x.isNotNull())
        texts = F.filter(F.array_distinct(cell), lambda x: (x != "") & ~F.lower(x).startswith("unnamed:"))
        return F.concat_ws(" ", texts)

    table = table.withColumn("columns", F.transform(F.sequence(F.lit(0), wide("head") - 1), column)).where("size(columns) > 0")
    # a lambda's expressions run as often as they stand there: a name is made once, and looked up after it
    named = F.transform("columns", lambda c: F.struct(c.alias("text"), text.slug(c).alias("name")))
    known = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair]) if aliases else None
    other = lambda c: F.try_element_at(known, c["name"]) if aliases else F.lit(None).cast("string")
    table = table.withColumn("columns", F.transform(named, lambda c: F.when(c["text"] == "", "numero").otherwise(F.coalesce(other(c), F.nullif(c["name"], F.lit("")), F.lit("columna")))))
    hits = F.size(F.filter(F.array_distinct("columns"), lambda c: c.isin(*terms))) if terms else F.lit(0)
    order = F.struct(hits.alias("hits"), F.col("area"), (-F.col("table_no")).alias("first"))
    top = table.groupBy("page_id").agg(F.max_by(F.struct("columns", "r"), order).alias("t")).select("page_id", "t.columns", F.explode("t.r").alias("x"))
    own = F.transform("columns", lambda c, at: F.struct(c.alias("column"), at.alias("at"), F.nullif(F.trim(F.get(F.col("x.cells"), at)), F.lit("")).alias("value")))
    own = F.filter(own, lambda v: (v["at"] < F.size("x.cells")) & (F.array_position("columns", v["column"]) == v["at"] + 1))
    found = top.select("page_id", F.col("x.row_no").alias("row_no"), own.alias("own")).where(F.exists("own", lambda v: v["value"].isNotNull()))
    return found.select("page_id", "row_no", F.inline("own")).select("page_id", "row_no", "column", "value")


def numeric_columns(report: DataFrame) -> DataFrame:
    """Adds ``number`` where every known value of the page's column is one; other columns stay texts."""
    n = text.number(F.col("value"))
    bad = F.count_if(F.col("value").isNotNull() & n.isNull()).over(Window.partitionBy("page_id", "column"))
    return report.withColumn("number", F.when(bad == 0, n))
