"""Semi-structured documents: JSON text at the boundary, Variant inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def path_text(doc: Column, *keys: str | int) -> Column:
    """Text of a nested value; null if a key is missing or the value is JSON null."""
    return F.get_json_object(doc, _path(keys))


def _path(keys) -> str:
    return "$" + "".join(f"[{k}]" if isinstance(k, int) else f".{k}" for k in keys)


def path_number(doc: Column, *keys: str | int, scale: int | None = None) -> Column:
    """Exact number of a nested value, null if it is none; rounded half up if ``scale`` is given."""
    found = path_text(doc, *keys).try_cast("decimal(38,18)")
    return found if scale is None else F.round(found, scale)


def present(doc: Column, *keys: str | int) -> Column:
    """True if the path exists, also where it holds JSON null."""
    return F.try_variant_get(F.try_parse_json(doc), _path(keys), "variant").isNotNull()


def kind(doc: Column, *keys: str | int) -> Column:
    """object, array, string, number, boolean or null; SQL null if the path is missing or the text isn't JSON."""
    v = F.try_variant_get(F.try_parse_json(doc), _path(keys), "variant")
    s = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit(None).cast("string"))
        .when(s.startswith("OBJECT"), "object")
        .when(s.startswith("ARRAY"), "array")
        .when(s == "STRING", "string")
        .when(s == "BOOLEAN", "boolean")
        .when(s == "VOID", "null")
        .otherwise("number")
    )


def canonical(doc: Column) -> Column:
    """Key order, white space and number spelling made equal, so equal documents have equal text.

    Numbers with an exponent are doubles and equal only such; others are exact.
    """
    return F.to_json(F.try_parse_json(doc))


def differs(a: Column, b: Column) -> Column:
    """Null-safe inequality of documents by value."""
    return ~canonical(a).eqNullSafe(canonical(b))


def is_empty(doc: Column) -> Column:
    """SQL null, JSON null or an object without keys."""
    c = canonical(doc)
    return c.isNull() | c.isin("{}", "null")


def elements(doc: Column, *keys: str | int, item: str = "string") -> Column:
    """A nested array as ``array<item>``; null if it isn't one."""
    return F.from_json(path_text(doc, *keys), f"array<{item}>")


def merge_maps(left: Column, right: Column) -> Column:
    """Union of two maps, the right side wins."""
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(F.map_concat(kept, right))


def flexible_string(raw: Column) -> Column:
    """A JSON string or array of strings as one string, parts joined by " / "; other text as it is."""
    trimmed = F.trim(raw)
    array = F.array_join(F.from_json(trimmed, "array<string>"), " / ")
    text = F.try_variant_get(F.try_parse_json(trimmed), "$", "string")
    return F.when(trimmed.startswith("["), F.coalesce(array, raw)).when(trimmed.startswith('"'), F.coalesce(text, raw)).otherwise(raw)


def stem_value(features: Column, stem: str, key: str) -> Column:
    """Text of a stem's scalar in any of the layouts that occur: nested under ``scalars``, bare, or flat at the top."""
    root = ("mix",) if stem == "mix" else ("demucs", stem)
    return F.coalesce(
        path_text(features, *root, "scalars", key), path_text(features, *root, key), path_text(features, stem, key)
    )


def deep_merge(left: Column, right: Column, ddl: str) -> Column:
    """Documents of two levels merged key by key, the right side wins; ``ddl`` is the type of the inner values."""
    kind = f"map<string,map<string,{ddl}>>"
    a, b = F.from_json(left, kind), F.from_json(right, kind)
    both = F.map_zip_with(F.coalesce(a, F.create_map().cast(kind)), F.coalesce(b, F.create_map().cast(kind)), lambda _, x, y: merge_maps(x, y))
    return F.to_json(both)
