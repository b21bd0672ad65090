"""Names, sizes and quantities as column expressions."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dims

_DASHES = "‐‑‒–—―−"
_FANCY = _DASHES + "‘’“”× "
_PLAIN = "-------" + "''\"\"x "


def let(value: Column, use) -> Column:
    """use(value) with `value` computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _forms(s: pa.Array, form: str) -> pa.Array:
    return pa.array([x if x is None else unicodedata.normalize(form, x) for x in s.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _nfkc(s: pa.Array) -> pa.Array:
    return _forms(s, "NFKC")


@F.arrow_udf(T.StringType())
def _nfkd(s: pa.Array) -> pa.Array:
    return _forms(s, "NFKD")


def _normal(c: Column, udf) -> Column:
    """Texts of ASCII only, which are most, have one form and never leave the JVM's side."""
    return F.coalesce(udf(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def nfkc(c: Column) -> Column:
    return _normal(c, _nfkc)


def nfkd(c: Column) -> Column:
    return _normal(c, _nfkd)


def _tidy(s: Column) -> Column:
    s = F.trim(F.regexp_replace(F.translate(s, _FANCY, _PLAIN), r"(?U)\s+", " "))
    return F.nullif(F.btrim(s, F.lit(" ,;:-–")), F.lit(""))


def clean_text(c: Column) -> Column:
    """Text for people: compatibility forms, dashes and quotes unified, white space and
    punctuation at the ends dropped; null where nothing is left."""
    return _tidy(nfkc(c.cast("string")))


def name_key(c: Column, cleaned: bool = False) -> Column:
    """Identity of a name: lower case, units of packing and punctuation dropped, sizes joined."""
    s = F.lower(c if cleaned else clean_text(c))
    s = F.regexp_replace(s, "&", " and ")
    s = F.regexp_replace(s, r"\b(pcs|pieces|pack|packs|qty)\b", " ")
    s = F.regexp_replace(s, r"[^a-z0-9.]+", " ")
    s = F.regexp_replace(s, r"(?<=\d)\s+x\s+(?=\d)", "x")
    s = F.regexp_replace(s, r"\b(\d+)\.0\b", "$1")
    return F.nullif(F.trim(F.regexp_replace(s, r"\s+", " ")), F.lit(""))


def clean_size(c: Column) -> Column:
    s = clean_text(F.replace(c.cast("string"), F.lit("³"), F.lit("")))
    low = F.lower(s)
    return F.when(low.isin("true", "all", "all sizes"), "All").when(low == "false", None).otherwise(s)


def _number(s: Column) -> Column:
    return s.try_cast("double")


def qty_number(c: Column) -> Column:
    return let(clean_text(c), lambda s: F.when(s.rlike(r"^\d+(\.\d+)?$"), _number(s)))


def qty_text(c: Column) -> Column:
    """Display form: whole numbers without a fraction; a midnight date is a mangled range."""
    date = r"^(\d{4})-(\d{2})-(\d{2})[ T]00:00:00$"

    def shown(s):
        n = _number(s)
        whole = F.when(n == F.floor(n), F.floor(n).cast("string")).otherwise(n.cast("string"))
        ranged = F.concat_ws("-", F.regexp_extract(s, date, 2).try_cast("int").cast("string"), F.regexp_extract(s, date, 3).try_cast("int").cast("string"))
        return F.when(s.rlike(date), ranged).when(s.rlike(r"^\d+(\.\d+)?$"), whole).otherwise(s)

    return let(clean_text(c), shown)


_PART = r"(?i)(HFSB\d)-(\d{4})-(\d+)((?:-[A-Z]{2,3}\d*)*)"


def part_number(c: Column) -> Column:
    """struct(full, base, machining) of an extrusion part number in the text, or null."""
    series, profile, length, rest = (F.regexp_extract(c, _PART, i) for i in (1, 2, 3, 4))
    base = F.concat_ws("-", F.upper(series), profile, length)
    machining = F.nullif(F.upper(F.btrim(rest, F.lit("-"))), F.lit(""))
    return F.when(c.rlike(_PART), F.struct(F.concat_ws("-", base, machining).alias("full"), base.alias("base"), machining.alias("machining")))


def is_affiliate_label(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?i)^\W*\[?\s*af+i?l+i?ate\s+link\s*\]?\W*$"), F.lit(False))


def slug(c: Column) -> Column:
    ascii_only = F.regexp_replace(nfkd(F.coalesce(c, F.lit(""))), r"[^\x00-\x7F]", "")
    s = F.lower(F.btrim(F.regexp_replace(ascii_only, "[^A-Za-z0-9]+", "-"), F.lit("-")))
    return F.when(s == "", "item").otherwise(s)


def mapped(c: Column, table: dict[str, str], default: Column) -> Column:
    pairs = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.coalesce(F.try_element_at(pairs, c), default)


def category(c: Column, cleaned: bool = False) -> Column:
    s = c if cleaned else clean_text(c)
    return mapped(F.coalesce(F.lower(s), F.lit("")), dims.CATEGORIES, s)


def role(slot: Column) -> Column:
    return mapped(F.lower(F.trim(F.coalesce(slot, F.lit("")))), dims.ROLES, F.lit("unknown"))


def is_drop_row(component: Column, cleaned: bool = False) -> Column:
    """Separators, footers and empty names."""
    s = component if cleaned else clean_text(component)
    return s.isNull() | (F.upper(s) == "OR") | s.rlike(r"(?i)^\W*as an (amazon|aliexpress)")


def tokens(key: Column) -> Column:
    return F.filter(F.split(F.coalesce(key, F.lit("")), " "), lambda x: x != "")


def spec_tokens(key: Column) -> Column:
    """Tokens with a digit, as a sorted set."""
    return F.array_sort(F.array_distinct(F.filter(tokens(key), lambda x: x.rlike("[0-9]"))))


def words_with_space(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\S+\s*"), F.lit(0))


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays; two empty ones are alike."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def fixed(x: Column, places: int) -> Column:
    """A number with that many places, half to even."""
    return F.format_string(f"%.{places}f", F.bround(x, places))
