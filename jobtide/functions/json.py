"""Reading JSON text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Path = str | list[str | int]


def _expression(path: Path) -> str:
    steps = [path] if isinstance(path, str) else path
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else f".{s}" for s in steps)


def json_text(document: Column, path: Path) -> Column:
    """Scalar at a path as unquoted text; null where the key is missing."""
    return F.get_json_object(document, _expression(path))


# How zero, false, an empty array and an empty object read once quotes are gone.
EMPTY_VALUE = r"^(?:-?0+(?:\.0+)?(?:[eE][+-]?\d+)?|false|\[\s*\]|\{\s*\})$"


def truthy_text(document: Column, name: str) -> Column:
    """The member as text; null if it is missing or empty: "", 0, false, [] or {}, but not the text "0"."""
    value = json_text(document, name)
    # Only values that look empty are looked at again, with their type.
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(document), f"$.{name}", "variant"))
    looks_empty = F.rlike(value, F.lit(EMPTY_VALUE))
    return F.when(value == "", None).when(looks_empty, F.when(kind == "STRING", value)).otherwise(value)


def json_array_size(document: Column, path: Path) -> Column:
    return F.json_array_length(json_text(document, path))


def first_present(document: Column, keys: list[str]) -> Column:
    """Value of the first key that exists, even when its value is empty."""
    present = F.json_object_keys(document)
    value = F.lit(None).cast("string")
    for key in reversed(keys):
        value = F.when(F.array_contains(present, key), json_text(document, key)).otherwise(value)
    return value


def json_elements(array_text: Column) -> Column:
    """A JSON array as an array of its elements, each kept as JSON text."""
    return F.from_json(array_text, "array<string>")
