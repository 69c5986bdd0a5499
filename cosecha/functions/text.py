"""Text columns: slugs, canonical products, parsed labels, file names, prices and weights."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from html import entities

from pyspark.sql import Column
from pyspark.sql import functions as F

def _folding() -> tuple[str, str]:
    """Letters that come apart into one ASCII letter and marks, in Latin script, and those letters."""
    import unicodedata

    pairs = []
    for code in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)):
        base = "".join(x for x in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(x))
        if len(base) == 1 and base.isascii():
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _folding()
MARKS = r"[\u0300-\u036f]"

# Synonyms of canonical products
PRODUCT_SYNONYMS = {"tomate": "tomate_rojo", "tomate_rojo_202": "tomate_rojo", "chile_jalapeno": "chile_verde"}

# Months as they are written
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")

# Texts that mean yes
TRUTHY = ("1", "true", "t", "yes", "y", "si", "s", "x")

# The bytes 80 to 9F of Windows-1252, and the same as Latin-1 reads them
WINDOWS, CONTROLS = (lambda p: ("".join(a for a, _ in p), "".join(b for _, b in p)))([(x, chr(i)) for i in range(0x80, 0xA0) if (x := bytes([i]).decode("cp1252", "ignore"))])

# UTF-8 that was read as Latin-1
MOJIBAKE = {"Ã¡": "á", "Ã©": "é", "Ã­": "í", "Ã³": "ó", "Ãº": "ú", "Ã±": "ñ", "Ã‘": "Ñ", "Ã¼": "ü", "Â°": "°"}

SPACES = r"[\s ]+"


def plain(c: Column) -> Column:
    """Latin letters without accents, whether written as one character or with marks of their own; full-width ones too."""
    return F.replace(F.regexp_replace(F.translate(c, ACCENTED, PLAIN), MARKS, ""), F.lit("ß"), F.lit("ss"))


def _squeezed(c: Column, by: str) -> Column:
    return F.trim(F.regexp_replace(F.lower(plain(F.trim(c))), "[^a-z0-9]+", by), F.lit(by))


def slug(c: Column) -> Column:
    """Key form: no accents, lower case, one underscore between words; '' for null."""
    return F.coalesce(_squeezed(c.cast("string"), "_"), F.lit(""))


def spaced(c: Column) -> Column:
    """Like slug, with blanks."""
    return F.coalesce(_squeezed(c.cast("string"), " "), F.lit(""))


def product(c: Column) -> Column:
    """Slug of a product with its synonyms resolved."""
    known = F.create_map(*[F.lit(x) for pair in PRODUCT_SYNONYMS.items() for x in pair])
    # the slug stands in an array, so that it is made once and not for each synonym
    return F.get(F.transform(F.array(slug(c)), lambda key: F.coalesce(F.try_element_at(known, key), key)), 0)


def product_or_null(c: Column) -> Column:
    return F.get(F.transform(F.array(product(c)), lambda key: F.nullif(key, F.lit(""))), 0)


@functools.cache
def _named_references() -> tuple[tuple[str, str], ...]:
    """All names of HTML with their characters; those with a semicolon, and the old ones that may go without."""
    return tuple(sorted(entities.html5.items()))


def _code_point(number: Column) -> Column:
    """The character of a number; numbers that are none, and those of Windows-1252, as browsers take them."""
    windows = F.translate(F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"), CONTROLS, WINDOWS)
    none = number.isNull() | (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    return F.when(none, F.lit("\ufffd")).otherwise(windows)


def unescaped(c: Column) -> Column:
    """Character references resolved once: named, decimal and hexadecimal; what is no reference stays.

    The text is cut at its ampersands; the start of each part is looked up, so a text is read once whatever it holds.
    """
    known = lambda pairs: F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    # maps are searched from their start: by first letter they are short
    letters = sorted({n[0] for n, _ in _named_references()})
    names = F.create_map(*[x for a in letters for x in (F.lit(a), known(p for p in _named_references() if p[0][0] == a and p[0][-1] == ";"))])
    short_names = known(p for p in _named_references() if p[0][-1] != ";")
    old_names = "|".join(sorted((n for n, _ in _named_references() if n[-1] != ";"), key=lambda n: (-len(n), n)))  # the longest first

    def resolved(part: Column, i: Column) -> Column:
        decimal, hexa = F.regexp_extract(part, r"^#([0-9]{1,8})(?![0-9])", 1), F.regexp_extract(part, r"^#[xX]([0-9a-fA-F]{1,6})(?![0-9a-fA-F])", 1)
        whole, old = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]*;)", 1), F.regexp_extract(part, f"^({old_names})", 1)
        after = lambda head, extra: F.regexp_replace(F.substring(part, F.length(head) + extra, F.length(part)), "^;", "")
        out = F.when(i == 0, part)
        out = out.when(decimal != "", F.concat(_code_point(decimal.cast("bigint")), after(decimal, 2)))
        out = out.when(hexa != "", F.concat(_code_point(F.conv(hexa, 16, 10).cast("bigint")), after(hexa, 3)))
        rest = lambda head: F.substring(part, F.length(head) + 1, F.length(part))
        named = F.try_element_at(F.try_element_at(names, F.substring(F.nullif(whole, F.lit("")), 1, 1)), whole)
        short = F.try_element_at(short_names, F.nullif(old, F.lit("")))
        return out.otherwise(F.coalesce(F.concat(named, rest(whole)), F.concat(short, rest(old)), F.concat(F.lit("&"), part)))

    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(F.split(c, "&", -1), resolved), "")).otherwise(c)


def decoded(c: Column) -> Column:
    """Character references resolved, white space collapsed and trimmed."""
    return F.trim(F.regexp_replace(unescaped(c), SPACES, " "))


def repaired(c: Column) -> Column:
    """Text whose UTF-8 was taken for Latin-1 or Windows-1252: its bytes are read again where they are UTF-8.

    Text in which only some letters are so has the usual pairs replaced.
    """
    latin = F.translate(c, WINDOWS, CONTROLS)
    fits = latin.rlike(r"^[\x00-\xFF]*$") & latin.rlike(r"[\xC2-\xF4][\x80-\xBF]")
    read = F.encode(F.when(fits, latin), "ISO-8859-1").cast("string")
    pairs = c
    for bad, good in MOJIBAKE.items():
        pairs = F.replace(pairs, F.lit(bad), F.lit(good))
    return F.coalesce(F.try_validate_utf8(read), pairs)


def truthy(c: Column) -> Column:
    """Yes-or-no text; null is no."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(*TRUTHY), F.lit(False))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def number(c: Column) -> Column:
    """A number written with thousands commas; null if it is none."""
    return F.regexp_replace(F.trim(c), ",", "").try_cast("double")


def has_word(c: Column, term: str) -> Column:
    """The term as a whole word, not inside another."""
    escaped = "".join(f"\\{x}" if not x.isalnum() else x for x in term)
    return F.coalesce(c.rlike(rf"(?<![a-z0-9]){escaped}(?![a-z0-9])"), F.lit(False))


def terms(c: Column) -> Column:
    """Parts of a list that is written with bars."""
    return F.filter(F.transform(F.split(c, r"\|"), lambda t: F.trim(t)), lambda t: t != "")


def unit_of_label(c: Column) -> Column:
    """What the last parenthesis holds."""
    return F.trim(F.try_element_at(F.regexp_extract_all(c, F.lit(r"\(([^()]*)\)"), F.lit(1)), F.lit(-1)))


def label_without_unit(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s*\([^()]*\)\s*$", ""))


def year_of_name(c: Column) -> Column:
    return F.regexp_extract(c, r"(20\d{2})", 1).try_cast("int")


def month_number(c: Column) -> Column:
    """1-12 from a number or a month's name."""
    key = slug(c)
    out = F.when(key.rlike(r"^\d{1,2}$") & key.try_cast("int").between(1, 12), key.try_cast("int"))
    for i, name in enumerate(MONTHS, 1):
        out = out.when(key == name, F.lit(i))
    return out


def month_of_name(c: Column) -> Column:
    """The month in a file's name: its last part that is one."""
    parts = F.split(slug(F.regexp_replace(c, r"\.[A-Za-z0-9]+$", "")), "_")
    found = F.filter(F.transform(parts, month_number), lambda m: m.isNotNull())
    return F.try_element_at(found, F.lit(-1))


def product_of_name(c: Column) -> Column:
    """The product in a file's name, without year, month and ending."""
    months = "|".join(MONTHS)
    return product(F.regexp_replace(slug(F.regexp_replace(c, r"\.[A-Za-z0-9]+$", "")), rf"_(20\d{{2}})(_(\d{{1,2}}|{months}))?(_.*)?$|_({months})(_.*)?$", ""))


def weight_kg(c: Column) -> Column:
    """Kilograms in a title such as '900 g' or '1.5 kg', whatever its accents and case; words for units do not count."""
    low = F.lower(plain(c))
    kilos = F.regexp_extract(low, r"(\d+(?:\.\d+)?)\s*kg\b", 1).try_cast("double")
    return F.coalesce(kilos, F.regexp_extract(low, r"(\d+(?:\.\d+)?)\s*g(?:r|rs|ms)?\b", 1).try_cast("double") / 1000)


def price_and_unit(c: Column) -> tuple[Column, Column]:
    """Both parts of '$ 12.50 / kg'."""
    pattern = r"\$\s*([\d,]+(?:\.\d+)?)\s*(?:/\s*([A-Za-z]+))?"
    return number(F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))), F.lower(F.nullif(F.regexp_extract(c, pattern, 2), F.lit("")))


def header_value(page: Column, name: str) -> Column:
    """What follows 'name:' in a page's text, without tags."""
    text = F.regexp_replace(F.regexp_replace(page, r"<[^>]*>", "\n"), r"[ \t ]+", " ")
    return blank_to_null(F.regexp_extract(text, rf"(?i){name}\s*:?\s*\n*\s*([^\n]+)", 1))


def money(c: Column, unit: str = "kg") -> Column:
    return F.coalesce(F.concat(F.lit("$"), F.format_number(c, 2), F.lit(f"/{unit}")), F.lit("s/d"))


def percent(c: Column, signed: bool = True) -> Column:
    return F.when(c.isNotNull(), F.format_string("%+.1f%%" if signed else "%.1f%%", c * 100)).otherwise("s/d")


def whole(c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string("%.0f", c)).otherwise("s/d")


# Crops in the order they are tried, with parts of names and whole words that tell them
CROP_RULES = (
    ("aguacate", ("aguacate",), ()),
    ("tomate", ("jitomate",), ("tomate",)),
    ("elote", ("elote",), ()),
    ("zanahoria", ("zanahoria",), ()),
    ("cebolla", ("cebolla",), ()),
    ("chile_jalapeno", ("jalape",), ()),
    ("limon", ("limon",), ()),
    ("platano", ("platano",), ()),
    ("mango", ("mango",), ()),
    ("papa", (), ("papa",)),
)


#: The same where papa may stand inside a word.
CROP_PARTS = (*CROP_RULES[:-1], ("papa", ("papa",), ()))


def crop(title: Column, rules: Sequence[tuple[str, Sequence[str], Sequence[str]]] = CROP_RULES) -> Column:
    """The crop that a product's title names, by the first rule that fits; by CROP_RULES papaya is not papa."""
    key, out = spaced(title), None
    for name, parts, whole_words in rules:
        hit = F.lit(False)
        for p in parts:
            hit = hit | F.contains(key, F.lit(p))
        for w in whole_words:
            hit = hit | has_word(key, w)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def of_state(state: Column, asked: str | None) -> Column:
    """Whether a state is the one asked for, whatever its accents and case; all are if none is asked for."""
    return F.lit(True) if not asked else slug(state) == slug(F.lit(asked))


def display(key: Column) -> Column:
    """A key as it is shown: blanks for underscores, first letter in upper case."""
    words = F.trim(F.replace(key, F.lit("_"), F.lit(" ")))
    return F.concat(F.upper(F.substring(words, 1, 1)), F.lower(F.substring(words, 2, 1 << 20)))


def display_state(state: Column, names: Mapping[str, str], drop: Sequence[str] = ()) -> Column:
    """A state's full name by its slug, else its words with capitals; '' for headers that pose as states."""
    key, out = slug(state), F.initcap(F.lower(F.trim(state)))
    for k, name in names.items():
        out = F.when(key == k, F.lit(name)).otherwise(out)
    return F.when(key.isin(*drop), F.lit("")).otherwise(out) if drop else out


def reference_label(kind: Column) -> Column:
    """How references of a comparison are shown."""
    return F.when(kind == "anio_anterior", "Anio anterior").when(kind == "promedio_5_anios", "Promedio 5 anios").otherwise("Sin referencia")


def source_page(candidates: Sequence[Column], base: str, fallback: str) -> Column:
    """The first candidate that is an absolute address or a path of the site, as an address."""
    found = [F.when(c.startswith("http"), c).when(c.startswith("/"), F.concat(F.lit(base), c)) for c in candidates]
    return F.coalesce(*found, F.lit(fallback))
