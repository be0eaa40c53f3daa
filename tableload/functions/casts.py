"""Scalar rules as built-in Column expressions (JVM-side, codegen'd).

Checks that must fail a load (bad list text, over-long text) are written with
``raise_error`` inside the expression, so they run inside the same scan that
loads the data: no extra pass, no driver round trip.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ObjectSpec


def q(name: str) -> str:
    """Backtick-quote a column name (dotted names are literal, not fields)."""
    return "`" + name.replace("`", "``") + "`"


def c(name: str) -> Column:
    return F.col(q(name))


# ----------------------------------------------------------------- dates/time


def parse_date(ds: str | Column) -> Column:
    """ISO date text -> date."""
    return F.to_date(ds if isinstance(ds, Column) else F.lit(ds))


def day_start(ds: str | Column) -> Column:
    """Midnight of ``ds`` as ``timestamp_ntz``."""
    return parse_date(ds).cast("timestamp_ntz")


def end_of_day(ds: str | Column) -> Column:
    """Exclusive upper bound of the day: next midnight.

    The reference uses 23:59:59.999999 and whole seconds; ``< next midnight``
    is the same set of records without losing the last fraction of a second.
    """
    return F.date_add(parse_date(ds), 1).cast("timestamp_ntz")


def to_epoch(ts_ntz: Column, zone: str = "UTC") -> Column:
    """Wall clock in ``zone`` -> epoch seconds (fractions dropped).

    ``unix_timestamp`` on a ``timestamp_ntz`` reads it as UTC whatever the
    session zone, so shifting the wall clock to UTC first makes this
    independent of the session.
    """
    if zone.upper() == "UTC":
        return F.unix_timestamp(ts_ntz)
    return F.unix_timestamp(F.convert_timezone(F.lit(zone), F.lit("UTC"), ts_ntz))


def to_int(x: Column) -> Column:
    """Truncate to a whole number (epoch seconds as bigint)."""
    return x.cast("bigint")


def epoch_zero() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds -> ``timestamp_ntz`` (UTC wall clock), session-independent."""
    return F.timestamp_add("SECOND", seconds, epoch_zero())


# ----------------------------------------------------------------- links


def strip_prefix(url: Column, domain: str | Column) -> Column:
    """Remove the host part from a next-page link (a fixed domain or a per-row one)."""
    return F.replace(url, domain if isinstance(domain, Column) else F.lit(domain), F.lit(""))


def link_param(url: Column, name: str) -> Column:
    """One query parameter of a link (``start_time``, ``cursor``); null if absent."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


# ----------------------------------------------------------------- text forms


def strict_cast(x: Column, to: str, label: str) -> Column:
    """Cast that fails the load on a value that does not convert.

    ``try_cast`` parses by the ANSI rules and gives null instead of raising,
    so a null out of a non-null value is a bad value: the check holds whether
    or not the session runs in ANSI mode (where a plain cast with ANSI off
    would turn ``12.5`` into 12 and ``abc`` into null, silently).
    """
    out = x.try_cast(to)
    return F.when(
        x.isNotNull() & out.isNull(),
        F.raise_error(F.concat(F.lit(f"bad {to} value in {label}: "), F.substring(x.cast("string"), 1, 200))),
    ).otherwise(out)


def int_text(x: Column, label: str = "value", to: str = "bigint") -> Column:
    """Integer text, also as pandas writes nullable ints (``123.0``) -> bigint.

    A value with a real fraction (``12.5``) fails the load.
    """
    return strict_cast(F.regexp_replace(x, r"\.0*$", ""), to, label)


def array_text(x: Column) -> Column:
    """List -> JSON text for the stage."""
    return F.to_json(x)


# fixed values: the tokens of a Python literal, its strings' pieces, and words that JSON spells otherwise.
# Possessive loops: the matcher neither backtracks nor recurses, however long a string is.
_STRING = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'""" + "|" + r'''"[^"\\]*+(?:\\.[^"\\]*+)*+"'''
_TOKEN = rf"(?s)({_STRING}|[A-Za-z]+|[+-]?[0-9.][0-9A-Za-z.+-]*|[\[\]{{}}:,]|\s+)"
_PIECE = r"(?s)(\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\.|[^\\]++)"
_WORDS = {"None": "null", "True": "true", "False": "false", "null": "null", "true": "true", "false": "false"}
# signs of Python's form: they decide which form is tried first (a failed parse is slow), not what comes out
_PYTHON = r"'|None|True|False|[0-9]\.0*[,\]]"
_SAME_ESCAPES = ("\\\\", '\\"', "\\n", "\\r", "\\t", "\\b", "\\f", "\\/")


def _once(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use(x)`` with ``x`` computed once a row, however often ``use`` names it."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def _string_json(token: Column) -> Column:
    """A quoted Python string as a JSON string; null if it holds an escape that neither has."""

    def piece(p: Column) -> Column:
        code = F.substring(p, 3, 8)
        return (
            F.when(~p.startswith("\\"), F.replace(p, F.lit('"'), F.lit('\\"')))
            .when(p.isin(*_SAME_ESCAPES), p)
            .when(p == "\\'", F.lit("'"))
            .when(p.startswith("\\x"), F.concat(F.lit("\\u00"), code))
            .when(p.startswith("\\u"), p)
            .when(p.startswith("\\U"), F.decode(F.unhex(code), "UTF-32"))
        )

    def quoted(body: Column) -> Column:
        # most strings hold no escape and are one piece
        pieces = F.transform(F.regexp_extract_all(body, F.lit(_PIECE), F.lit(1)), piece)
        return F.when(~body.contains("\\"), F.replace(body, F.lit('"'), F.lit('\\"'))).otherwise(_joined(pieces))

    body = F.substring(token, F.lit(2), F.char_length(token) - 2)
    return F.concat(F.lit('"'), _once(body, quoted), F.lit('"'))


def _joined(parts: Column) -> Column:
    """The parts as one text; null if one of them is null (``array_join`` would skip it)."""
    return _once(parts, lambda a: F.when(~F.exists(a, lambda p: p.isNull()), F.array_join(a, "")))


def python_json(x: Column, whole: bool = False) -> Column:
    """Text of a Python list or dict, as pandas writes one into a CSV cell -> JSON text; null if it is neither.

    Strings in either quote with Python's escapes, ``None``, ``True``, ``False``;
    with ``whole``, numbers like ``123.0`` lose their fraction. JSON text comes
    out as it is. Built-in expressions only: the text is cut into tokens in
    one pass and each is spelled anew.
    """
    tokens = F.regexp_extract_all(x, F.lit(_TOKEN), F.lit(1))

    def spelled(t: Column) -> Column:
        word = F.create_map(*[F.lit(v) for pair in _WORDS.items() for v in pair])
        number = F.regexp_replace(t, r"^([+-]?[0-9]+)\.0*$", "$1") if whole else t
        return (
            F.when(t.rlike("^['\"]"), _string_json(t))
            .when(t.rlike("^[A-Za-z]"), F.try_element_at(word, t))
            .when(t.rlike("^[0-9.+-]"), number)
            .otherwise(t)
        )

    # what no token covers is not a literal
    return _once(tokens, lambda a: F.when(F.array_join(a, "") == x, _joined(F.transform(a, spelled))))


def text_array(x: Column, element: str, label: str) -> Column:
    """List text -> typed array, as JSON or as Python writes it; text that is neither fails the load."""
    kind = f"array<{element}>"
    bad = F.raise_error(F.concat(F.lit(f"bad list text in {label}: "), F.substring(x, 1, 200)))
    as_json = F.from_json(x, kind)
    as_python = F.from_json(python_json(x, whole=element == "bigint"), kind)
    parsed = F.when(x.rlike(_PYTHON), F.coalesce(as_python, as_json)).otherwise(F.coalesce(as_json, as_python))
    return F.coalesce(parsed, F.when(x.isNotNull(), bad).cast(kind))


def json_text(x: Column) -> Column:
    """Text of a list of objects: JSON as it is, Python's form as JSON; other text stays."""
    as_json = _once(python_json(x), lambda y: F.when(F.try_parse_json(y).isNotNull(), y))
    # JSON comes out of ``python_json`` as it is, so text that holds Python's signs need not be tried as JSON
    return F.when(~x.rlike(_PYTHON) & F.try_parse_json(x).isNotNull(), x).otherwise(F.coalesce(as_json, x))


def length_rule(x: Column, label: str, max_len: int) -> Column:
    """Keep ``x``; fail the load if it is longer than the declared length."""
    return F.when(
        F.char_length(x) > max_len,
        F.raise_error(
            F.concat(
                F.lit(f"value too long for {label} (max {max_len}): "),
                F.char_length(x).cast("string"),
                F.lit(" characters"),
            )
        ),
    ).otherwise(x)


def stage_text(x: Column, kind: str) -> Column:
    """Typed or wire value -> its text form in the CSV stage (lossless)."""
    if kind.startswith("array<"):
        return array_text(x)
    return x.cast("string")


def typed_value(x: Column, kind: str, label: str, max_len: int | None = None) -> Column:
    """Stage text -> declared type (``typed_load`` for one column)."""
    if kind == "bigint":
        out = int_text(x, label)
    elif kind == "int":
        out = int_text(x, label, "int")
    elif kind == "double":
        out = strict_cast(x, "double", label)
    elif kind == "boolean":
        out = strict_cast(x, "boolean", label)
    elif kind == "ntz":
        out = strict_cast(x, "timestamp_ntz", label)
    elif kind == "epoch":
        out = from_epoch(int_text(x, label))
    elif kind.startswith("array<"):
        out = text_array(x, kind[len("array<") : -1], label)
    elif kind == "json":
        out = json_text(x)
    else:
        out = x
    if max_len is not None and kind in ("string", "json"):
        out = length_rule(out, label, max_len)
    return out


def wire_value(x: Column, kind: str) -> Column:
    """Wire value (page JSON) -> declared type, without a stage in between.

    Scalars arrive as text and are cast by the rules of the typed load; lists
    are typed on the wire.
    """
    return x if kind.startswith("array<") else typed_value(x, kind, "wire value")


def table_columns_from_wire(spec: ObjectSpec) -> list[Column]:
    return [wire_value(c(col.name), col.kind).alias(col.name) for col in spec.columns]


def typed_columns(spec: ObjectSpec) -> list[Column]:
    """Select list that casts an all-text frame to the declared table schema."""
    return [typed_value(c(col.name), col.kind, col.name, col.max_len).alias(col.name) for col in spec.columns]


def text_columns(spec: ObjectSpec) -> list[Column]:
    """Select list that turns a conformed frame into stage text, in order."""
    return [stage_text(c(col.name), col.kind).alias(col.name) for col in spec.columns]


def length_violations(df, limits: dict[str, int]):
    """Report, per limited column, how many values exceed the limit.

    One pass, partial aggregation on each task: a single output row per column.
    """
    aggs = []
    for name, n in limits.items():
        aggs.append(F.count_if(F.char_length(c(name)) > n).alias(f"{name}__over"))
        aggs.append(F.max(F.char_length(c(name))).alias(f"{name}__max"))
    row = df.agg(*aggs)
    stacked = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(n).cast("bigint").alias("max_len"),
            F.col(f"`{name}__over`").cast("bigint").alias("n_over"),
            F.col(f"`{name}__max`").cast("bigint").alias("longest"),
        )
        for name, n in limits.items()
    ]
    return row.select(F.inline(F.array(*stacked)))
