"""Fields of foreign records: aliases, dates, nested values, products, bounded lists. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: fixed values: date notations, in the order in which they are tried
DATE_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy", "dd MMM yyyy"]


def filled(x: Column) -> Column:
    """The trimmed text, or null where nothing is left."""
    return F.nullif(F.trim(x.cast("string")), F.lit(""))


def first_filled(*aliases: Column, prefix: str = "") -> Column:
    """The first alias that is not empty and begins with `prefix`."""
    return F.coalesce(*(F.when(filled(x).startswith(prefix), filled(x)) for x in aliases))


def tri_state(*aliases: Column) -> Column:
    """Whether the first filled alias says yes; anything else, and silence, is no."""
    return F.coalesce(F.lower(first_filled(*aliases)).isin("known", "true", "yes"), F.lit(False))


def parsed_time(x: Column, formats: list[str] | None = None) -> Column:
    """A timestamp by the first notation that fits; null if none does."""
    return F.coalesce(*(F.try_to_timestamp(F.trim(x), F.lit(f)) for f in formats or DATE_FORMATS))


def id_year(x: Column) -> Column:
    """The year in the middle of an id such as AB-2021-77."""
    return F.split_part(x, F.lit("-"), F.lit(2)).try_cast("int")


def in_language(values: Column, lang: str = "en") -> Column:
    """The value of the first (lang, value) entry of a language."""
    return F.get(F.filter(values, lambda v: v["lang"] == lang), F.lit(0))["value"]


def by_precedence(*versions: Column) -> Column:
    """The first entry of the first version that has entries."""
    return F.coalesce(*(F.get(v, F.lit(0)) for v in versions))


def product_of(cpe: Column) -> Column:
    """vendor:product of a colon-separated platform name of five components or more."""
    parts = F.split(cpe, ":")
    return F.when(F.size(parts) >= 5, F.concat_ws(":", parts[3], parts[4]))


def products_of(cpes: Column, most: int = 5) -> Column:
    """Distinct product components, in order of appearance."""
    names = F.transform(cpes, lambda c: F.get(F.split(c, ":"), F.lit(4)))
    return F.slice(F.array_distinct(F.filter(names, lambda n: n.isNotNull() & ~n.isin("", "*", "-"))), 1, most)


def namespaced(x: Column, space: str = "sw:", most: int = 60) -> Column:
    return F.concat(F.lit(space), F.substring(F.lower(F.trim(x)), 1, most))


def codes_within(pattern: str, *fields: Column) -> Column:
    """Distinct codes anywhere inside nested values, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.to_json(F.struct(*fields)), F.lit(pattern), F.lit(0))))


def joined(*parts: Column, by: str = " | ") -> Column:
    """The parts that are filled, one after another."""
    return F.concat_ws(by, *(filled(p) for p in parts))


def merged_ids(*ids: Column) -> Column:
    """Distinct ids of scalars and arrays given as arrays, in order, without nulls."""
    return F.array_distinct(F.filter(F.concat(*(F.coalesce(i, F.array().cast("array<string>")) for i in ids)), lambda x: x.isNotNull() & (x != "")))


def bounded_list(values: Column, most: int = 20, chars: int = 200) -> Column:
    """At most so many entries of at most so many characters."""
    return F.transform(F.slice(values, 1, most), lambda x: F.substring(x.cast("string"), 1, chars))


def display_name(key: Column) -> Column:
    return F.initcap(F.translate(key, "_:", "  "))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def uuid5(name: Column, space: str = "6ba7b8119dad11d180b400c04fd430c8") -> Column:
    """The name-based UUID of version 5; the name space of URLs unless another is given (32 hexadecimal digits)."""
    digest = F.sha1(F.concat(F.unhex(F.lit(space)), F.encode(name, "utf-8")))
    variant = F.element_at(F.array(*(F.lit(d) for d in "89ab")), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def bullets(items: Column, mark: str = "- ") -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit(mark), x.cast("string"))), "\n")


def confidence_label(x: Column) -> Column:
    return F.when(x >= 0.80, "HIGH").when(x >= 0.65, "MEDIUM").otherwise("LOW")


def mentioned(entity: Column, mentions: Column) -> Column:
    """Whether a mention contains the entity or is contained in it, in lower case."""
    return F.exists(mentions, lambda m: F.lower(m).contains(F.lower(entity)) | F.lower(entity).contains(F.lower(m)))
