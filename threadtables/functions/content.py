"""Access to a note's content: a JSON object whose values are plain or wrapped as {"value": X}.

`parse` reads the JSON text once into a map of key -> VARIANT, which knows the JSON type that a map of strings loses: the
number 0 counts as empty, the string "0" does not. Every other function here takes that map and turns only the values it
asks for into an entry (text, kind, truthy), since that costs more than the parsing itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text of the JSON values other than strings that count as empty.
_FALSY_TEXT = ["0", "0.0", "false", "[]", "{}"]

_STRINGS = "array<string>"


def parse(content: Column) -> Column:
    """JSON text -> map<string, variant> in key order; NULL for anything but an object."""
    return F.from_json(content, "map<string,variant>")


def _once(value: Column, f) -> Column:
    """f(value), with the value computed once however often `f` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _unwrapped(v: Column) -> Column:
    value = F.coalesce(F.try_variant_get(v, "$.value", "variant"), v)
    return F.when(~F.is_variant_null(v), value)


def _typed(v: Column) -> Column:
    return F.when(v.isNotNull(), F.named_struct(F.lit("text"), v.cast("string"), F.lit("kind"), F.schema_of_variant(v)))


def _shown(t: Column) -> Column:
    # whole floats keep their `.0`, booleans are capitalised
    text, kind = t["text"], t["kind"]
    return (
        F.when(kind == "STRING", text).when(kind.startswith("DECIMAL") & kind.endswith(",0)"), F.concat(text, F.lit(".0")))
        .when(kind == "BOOLEAN", F.initcap(text)).otherwise(text)
    )


def _entry(t: Column) -> Column:
    text, kind = t["text"], t["kind"]
    filled = F.when(kind == "STRING", text != "").otherwise(F.coalesce(~text.isin(_FALSY_TEXT), F.lit(False)))
    return F.when(t.isNotNull(), F.named_struct(F.lit("text"), _shown(t), F.lit("kind"), kind, F.lit("truthy"), filled))


def entries(parsed: Column) -> Column:
    """The whole map with an entry, struct<text,kind,truthy>, for each value.

    A null value has a NULL entry; {"value": null} has an entry with NULL text.
    """
    # one pass per step, so that no step repeats the expression before it
    values = F.transform_values(parsed, lambda _, v: _unwrapped(v))
    typed = F.transform_values(values, lambda _, v: _typed(v))
    return F.transform_values(typed, lambda _, t: _entry(t))


def _typed_value(parsed: Column, key: Column) -> Column:
    return _once(_once(F.try_element_at(parsed, key), _unwrapped), _typed)


def entry(parsed: Column, key: str) -> Column:
    """The entry of one key, as in `entries`; NULL without the key."""
    return _once(_typed_value(parsed, F.lit(key)), _entry)


def has_key(parsed: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(parsed, key), F.lit(False))


def content_value(parsed: Column, key: str, default: str | None = "") -> Column:
    """Text of a key. A missing or null key gives the default; {"value": null} gives NULL."""
    return _once(_typed_value(parsed, F.lit(key)), lambda t: F.when(t.isNull(), F.lit(default)).otherwise(_shown(t)))


def truthy(parsed: Column, key: str) -> Column:
    """False for missing, null, "", 0, false, [] and {}; never NULL."""
    return F.coalesce(entry(parsed, key)["truthy"], F.lit(False))


def truthy_text(parsed: Column, key: str) -> Column:
    """Text of a key, NULL when it is falsy: ready for concat_ws, which skips NULL."""
    return _once(entry(parsed, key), lambda e: F.when(e["truthy"], e["text"]))


def _present(parsed: Column, keys: list[str]) -> Column:
    """Those of the keys that the map has, in the given order: a look into a set for each, not through the map."""
    listed = F.array(*[F.lit(k) for k in keys]).cast(_STRINGS)
    return F.array_intersect(listed, F.coalesce(F.map_keys(parsed), F.array().cast(_STRINGS)))


def any_truthy(parsed: Column, keys: list[str]) -> Column:
    return F.exists(_present(parsed, keys), lambda k: F.coalesce(_once(_typed_value(parsed, k), _entry)["truthy"], F.lit(False)))


def truthy_blocks(parsed: Column, labels: dict[str, str], separator: str) -> Column:
    """The truthy texts of the given keys in order, each after its label, joined by the separator."""
    # one expression over a constant list: sixteen written out would make a method too large to be compiled
    listed = F.map_from_arrays(*(F.array(*map(F.lit, x)).cast(_STRINGS) for x in (labels, labels.values())))

    def block(k: Column) -> Column:
        return _once(_once(_typed_value(parsed, k), _entry), lambda e: F.when(e["truthy"], F.concat(F.element_at(listed, k), e["text"])))

    return F.array_join(F.transform(_present(parsed, list(labels)), block), separator)


def shown_values(parsed: Column, keys: list[str]) -> Column:
    """The given keys as they are shown: map<string, struct<text,kind>> of those that are there, NULL for a null value.
    One pass for all, where several values of a content are asked for."""
    values = F.transform_values(F.map_filter(parsed, lambda k, _: k.isin(keys)), lambda _, v: _unwrapped(v))
    typed = F.transform_values(values, lambda _, v: _typed(v))
    return F.transform_values(typed, lambda _, t: F.when(
        t.isNotNull(), F.named_struct(F.lit("text"), _shown(t), F.lit("kind"), t["kind"])))


def shown_text(shown: Column, key: str, default: str = "") -> Column:
    """As `content_value`, from the `shown_values`."""
    return F.when(F.try_element_at(shown, F.lit(key)).isNull(), F.lit(default)).otherwise(F.try_element_at(shown, F.lit(key))["text"])


def shown_list(shown: Column, key: str) -> Column:
    """A list of the `shown_values` as array<string>, NULL when it is missing or not a list."""
    return _list(F.try_element_at(shown, F.lit(key)))


def _list(e: Column) -> Column:
    return F.when(e["kind"].startswith("ARRAY"), F.from_json(e["text"], _STRINGS))


def string_list(parsed: Column, key: str) -> Column:
    """array<string> of a list value, empty when it is missing or not a list."""
    return F.coalesce(_once(_typed_value(parsed, F.lit(key)), _list), F.array().cast(_STRINGS))


def list_or_text(parsed: Column, key: str, separator: str = ", ") -> Column:
    """A list joined with the separator; a plain value as text."""
    listed = _once(_typed_value(parsed, F.lit(key)), lambda t: F.array_join(_list(t), separator))
    return F.coalesce(listed, content_value(parsed, key))


def values_except(parsed: Column, keys: list[str]) -> Column:
    """map<string,string> of the texts of all other keys, '' for null."""
    rest = F.map_filter(parsed, lambda k, _: ~k.isin(keys))
    values = F.transform_values(rest, lambda _, v: _unwrapped(v))
    typed = F.transform_values(values, lambda _, v: _typed(v))
    return F.transform_values(typed, lambda _, t: F.coalesce(_shown(t), F.lit("")))


def pick(values: Column, keys: list[str]) -> Column:
    """The given keys of a map<string,string> in the given order; '' for a missing one."""
    listed = F.array(*[F.lit(k) for k in keys]).cast(_STRINGS)
    return F.map_from_arrays(listed, F.transform(listed, lambda k: F.coalesce(F.try_element_at(values, k), F.lit(""))))
