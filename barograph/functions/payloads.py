"""JSON text to and from typed structs, and UTF-8 bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barograph.schema import ENVELOPE


def json_text(struct: Column) -> Column:
    return F.to_json(struct)


def utf8(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def text_of(payload: Column) -> Column:
    return payload.cast("string")


def decode_json(text: Column, layout: T.StructType = ENVELOPE) -> Column:
    """Parse by declared layout, permissively.

    Malformed text gives a struct of NULLs, NULL or empty text a NULL struct, a
    field of the wrong kind only a NULL in that field.
    """
    return F.from_json(text, layout)


def leaf_columns(layout: T.StructType, path: str = "") -> dict[str, Column]:
    """Every leaf of a layout that may hold structs, by its own name."""
    leaves: dict[str, Column] = {}
    for part in layout.fields:
        if isinstance(part.dataType, T.StructType):
            leaves.update(leaf_columns(part.dataType, f"{path}{part.name}."))
        else:
            leaves[part.name] = F.col(path + part.name)
    return leaves


def pruned(layout: T.StructType, names: set[str]) -> T.StructType:
    """The layout with the named leaves alone, and the structs that hold them."""
    kept = []
    for part in layout.fields:
        if isinstance(part.dataType, T.StructType):
            inner = pruned(part.dataType, names)
            if inner.fields:
                kept.append(T.StructField(part.name, inner, part.nullable))
        elif part.name in names:
            kept.append(part)
    return T.StructType(kept)
