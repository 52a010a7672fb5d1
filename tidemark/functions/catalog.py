"""Cleaning rules for product catalog fields, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.literals import literal_json
from tidemark.functions.text import strip

# Fixed value: category levels kept.
CATEGORY_LEVELS = 5


def parse_loose_json(c: Column) -> Column:
    """JSON text as VARIANT; single-quoted text and Python literals (tuples, None, escapes) are accepted as well, anything else is
    null. Only texts that are no JSON meet Python."""
    known = F.coalesce(F.try_parse_json(c), F.when(F.contains(c, F.lit("'")), F.from_json(c, "variant")))
    return F.coalesce(known, F.try_parse_json(literal_json(F.when(known.isNull(), c))))


def _path(variant: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(variant, path, kind)


def _truthy_text(item: Column, path: str) -> Column:
    """Display text of a variant field, or null when the field is missing or falsy."""
    text = _path(item, path, "string")
    kind = F.schema_of_variant(_path(item, path, "variant"))
    number = text.try_cast("double")
    return (F.when(kind == "STRING", F.when(text != "", text))
            .when(kind == "BOOLEAN", F.when(text == "true", F.lit("True")))
            .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.when(number != 0, text))
            .when(kind != "VOID", F.when(~text.isin("[]", "{}"), text)))


def specification_text(c: Column) -> Column:
    """``key: value`` pairs of a specification field, joined with ``, ``.

    ``=>`` is read as ``:``. The list is the field ``product_specification`` of
    an object, or the value itself when it is a list. Undecodable text and
    values that hold no list give an empty string.
    """
    root = parse_loose_json(F.replace(c, F.lit("=>"), F.lit(":")))
    items = F.coalesce(_path(root, "$.product_specification", "array<variant>"), _path(root, "$", "array<variant>"))

    def one(item: Column) -> Column:
        key, value = _truthy_text(item, "$.key"), _truthy_text(item, "$.value")
        return F.when(key.isNotNull() & value.isNotNull(), F.concat(key, F.lit(": "), value)).otherwise(value)

    texts = F.filter(F.transform(items, one), lambda t: t.isNotNull())
    return F.coalesce(F.array_join(texts, ", "), F.lit(""))


def specification_unusable(c: Column) -> Column:
    """True for a specification that decodes to a bare null, number or boolean, which has no items to read."""
    kind = F.schema_of_variant(parse_loose_json(F.replace(c, F.lit("=>"), F.lit(":"))))
    return F.coalesce(~kind.rlike("^(OBJECT|ARRAY|STRING)"), F.lit(False))


def category_path(c: Column) -> Column:
    """First list element of a category field, split into at most five levels."""
    listed = F.get(F.from_json(c, "array<string>"), 0)
    lone = F.substring(_lone_string(c), 1, 1)
    raw = F.coalesce(listed, F.when(lone != "", lone), c)
    flat = F.replace(F.replace(raw, F.lit(">>"), F.lit(",")), F.lit("  "), F.lit(" "))
    bare = F.replace(F.replace(flat, F.lit("'"), F.lit("")), F.lit('"'), F.lit(""))
    levels = F.transform(F.split(strip(bare), ","), strip)
    return F.array_join(F.slice(levels, 1, CATEGORY_LEVELS), ", ")


def _lone_string(c: Column) -> Column:
    """The text of a field that holds exactly one quoted string."""
    root = parse_loose_json(c)
    return F.when(F.schema_of_variant(root) == "STRING", _path(root, "$", "string"))


def image_urls(c: Column) -> Column:
    """List of image URLs; a lone quoted string counts as a list of one, broken text as an empty list."""
    lone = _lone_string(c)
    return F.coalesce(F.from_json(c, "array<string>"), F.when(lone.isNotNull(), F.array(lone)),
                      F.array().cast("array<string>"))


def price_number(c: Column) -> Column:
    """The price as a whole number when it consists of digits only, else null."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("bigint"))


def price_variant(number: Column, raw: Column) -> Column:
    """One value for the JSON sink: the whole number if there is one, else the raw text."""
    return F.coalesce(number.cast("variant"), raw.cast("variant"))


def embedding_text(name: Column, brand: Column, category: Column, description: Column, specs: Column) -> Column:
    """Sentence that is embedded for a product; empty description and specifications leave no space behind."""
    def present(c: Column) -> Column:
        return F.when(c != "", c)

    return F.concat_ws(
        " ", F.concat(name, F.lit(".")), F.concat(F.lit("Brand: "), brand, F.lit(".")),
        F.concat(F.lit("Category: "), category, F.lit(".")), present(strip(description)), present(specs))
