"""Records out of pages, nested objects to dotted columns, fixed column list.

All three are projections Spark fuses into the scan's codegen stage: no
shuffle, no Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import c, q


def record_explode(pages: DataFrame, array_field: str, keep: list[str] | None = None) -> DataFrame:
    """One row per element of the page's record array; an empty array gives none.

    ``keep`` lists page-level columns carried next to each record.
    """
    keep = keep or []
    return pages.select(*[c(k) for k in keep], F.inline(c(array_field)))


def leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    """(path, type) of every leaf of a nested schema, a path being its field names from the top.

    Structs recurse; arrays, maps and scalars are leaves (lists stay one value).
    """
    out = []
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            out.extend(leaves(f.dataType, (*path, f.name)))
        else:
            out.append(((*path, f.name), f.dataType))
    return out


def _at(path: tuple[str, ...]) -> F.Column:
    # field by field, so a dot inside a name is part of the name
    col = F.col(q(path[0]))
    for p in path[1:]:
        col = col.getField(p)
    return col


def record_flatten(records: DataFrame, json_lists: bool = True) -> DataFrame:
    """Nested struct columns -> top-level columns named ``a.b.c``.

    With ``json_lists`` an array of structs becomes its JSON text (a list of
    objects is kept as one text value, as in the declared tables).
    """
    cols = []
    for path, dtype in leaves(records.schema):
        col = _at(path)
        if json_lists and isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
            col = F.to_json(col)
        cols.append(col.alias(".".join(path)))
    return records.select(*cols)


def conform_columns(df: DataFrame, schema: T.StructType | list[str]) -> DataFrame:
    """Exactly the listed columns, in order: missing -> typed null, extra -> dropped."""
    if isinstance(schema, T.StructType):
        fields = [(f.name, f.dataType) for f in schema.fields]
    else:
        fields = [(n, T.StringType()) for n in schema]
    have = set(df.columns)
    return df.select(
        *[c(n) if n in have else F.lit(None).cast(t).alias(n) for n, t in fields]
    )


def union_pages(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by column name; absent columns become null; duplicates kept."""
    if not frames:
        raise ValueError("no frames to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
