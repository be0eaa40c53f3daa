"""Object specs: the fixed column contract of each loaded object.

A spec is an ordered list of flat (possibly dotted) column names, each with a
*kind* that fixes three things at once:

* the wire type used when reading page JSON (explicit schema, never inferred;
  text for every scalar),
* the declared table type after ``typed_load``,
* the text form used in the CSV stage.

Kinds:

``bigint``   ids and counts; text may be ``123`` or ``123.0``
``int``      32-bit whole numbers, same text rule
``double``   double
``string``   text, optional length rule
``json``     a list of objects kept as its JSON text (wire string: Spark keeps
             the raw JSON of a non-string token when the field is a string)
``ntz``      ISO date-time text on the wire, ``timestamp_ntz`` in the table
``epoch``    epoch seconds on the wire, ``timestamp_ntz`` in the table
``boolean``  boolean
``array<bigint>``, ``array<string>``  lists; JSON text in the stage
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

KINDS = (
    "bigint",
    "int",
    "double",
    "string",
    "json",
    "ntz",
    "epoch",
    "boolean",
    "array<bigint>",
    "array<string>",
)

# scalars are read as text, whatever token the page holds (123, "123", 123.0), and cast by the typed load
_WIRE = {k: T.StringType() for k in KINDS if not k.startswith("array<")} | {
    "array<bigint>": T.ArrayType(T.LongType()),
    "array<string>": T.ArrayType(T.StringType()),
}

_TABLE = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "json": T.StringType(),
    "ntz": T.TimestampNTZType(),
    "epoch": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
    "array<bigint>": T.ArrayType(T.LongType()),
    "array<string>": T.ArrayType(T.StringType()),
}


@dataclass(frozen=True)
class Col:
    name: str
    kind: str
    max_len: int | None = None

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r} for column {self.name!r}")


@dataclass(frozen=True)
class ObjectSpec:
    """One loaded object: its record array name, columns, key and clock."""

    name: str
    columns: tuple[Col, ...]
    key: str = "id"
    time_column: str | None = "updated_at"
    link_field: str = "next_page"
    extra_wire: tuple[tuple[str, T.DataType], ...] = field(default_factory=tuple)
    # optional storage partition: (column name, stable source column, date pattern),
    # e.g. ("created_month", "created_at", "yyyy-MM"); the table then carries the
    # derived column last and a daily merge rewrites only the partitions it touches
    partition: tuple[str, str, str] | None = None
    # optional storage bucketing by the key: a big day's merge then shuffles
    # only the day, never the target
    buckets: int | None = None
    # page field with the link (or cursor) that a page answers; the pages then
    # carry no number and are ordered by their links
    request_field: str | None = None

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def kind(self, name: str) -> str:
        for c in self.columns:
            if c.name == name:
                return c.kind
        raise KeyError(name)

    def table_schema(self) -> T.StructType:
        """Flat declared schema, in contract order (the CSV is positional)."""
        return T.StructType([T.StructField(c.name, _TABLE[c.kind], True) for c in self.columns])

    def stored_schema(self) -> T.StructType:
        """Table schema as stored: the contract, plus the partition column if any."""
        schema = self.table_schema()
        if self.partition:
            schema = schema.add(self.partition[0], T.StringType(), True)
        return schema

    def with_partition(self, name: str, source: str, pattern: str) -> "ObjectSpec":
        if source not in self.names:
            raise ValueError(f"partition source {source!r} is not a {self.name} column")
        return replace(self, partition=(name, source, pattern))

    def with_custom_fields(self, parent: str, fields: dict[str, tuple[str, int | None]]) -> "ObjectSpec":
        """Add one tenant's own fields, ``parent.name`` columns of (kind, max length), in order.

        They are configuration of the caller: the shipped specs hold the
        columns every tenant has.
        """
        own = tuple(Col(f"{parent}.{name}", kind, max_len) for name, (kind, max_len) in fields.items())
        return replace(self, columns=self.columns + own)

    def with_buckets(self, n: int) -> "ObjectSpec":
        if n < 1:
            raise ValueError("bucket count must be positive")
        return replace(self, buckets=n)

    def with_links(self, request_field: str = "request") -> "ObjectSpec":
        """The same object landed without page numbers, in the order of its links."""
        return replace(self, request_field=request_field)

    def text_schema(self) -> T.StructType:
        """All-text schema of the CSV stage, same order."""
        return T.StructType([T.StructField(c.name, T.StringType(), True) for c in self.columns])

    def record_schema(self) -> T.StructType:
        """Nested wire schema of one record, built from the dotted names.

        A name that is also the prefix of other names (``photo`` next to
        ``photo.url``) is read as its JSON text, which may be an object or a
        plain value (``wire_records`` takes it apart).
        """
        tree: dict = {}
        leaves: dict[tuple[str, ...], T.DataType] = {}
        for c in self.columns:
            parts = tuple(c.name.split("."))
            leaves[parts] = _WIRE[c.kind]
            node = tree
            for p in parts[:-1]:
                node = node.setdefault(p, {})
            node.setdefault(parts[-1], {})
        for name, dtype in self.extra_wire:
            parts = tuple(name.split("."))
            leaves[parts] = dtype
            node = tree
            for p in parts[:-1]:
                node = node.setdefault(p, {})
            node.setdefault(parts[-1], {})

        def build(node: dict, prefix: tuple[str, ...]) -> T.StructType:
            fields = []
            for key, child in node.items():
                path = prefix + (key,)
                if child and path not in leaves:
                    fields.append(T.StructField(key, build(child, path), True))
                else:
                    fields.append(T.StructField(key, leaves[path], True))
            return T.StructType(fields)

        return build(tree, ())

    def text_or_object(self) -> dict[str, T.StructType]:
        """Columns that are a value or an object on the wire, with the object's schema."""
        out = {}
        for name in self.names:
            inner = [c for c in self.columns if c.name.startswith(name + ".")]
            if inner:
                out[name] = T.StructType([T.StructField(c.name[len(name) + 1 :], _WIRE[c.kind], True) for c in inner])
        return out

    def header_schema(self) -> T.StructType:
        """A landed page without its records: the link, the stop flag and the page's place.

        ``page`` is the sequence number the lander writes with each page; a
        spec with a ``request_field`` has the link that the page answers instead.
        """
        place = T.StructField(self.request_field, T.StringType(), True) if self.request_field else T.StructField("page", T.LongType(), True)
        return T.StructType([T.StructField(self.link_field, T.StringType(), True), T.StructField("end_of_stream", T.BooleanType(), True), place])

    def envelope_schema(self) -> T.StructType:
        """One landed page: the record array and the header."""
        return T.StructType([T.StructField(self.name, T.ArrayType(self.record_schema()), True), *self.header_schema().fields])


def parse_columns(text: str) -> tuple[Col, ...]:
    """Read ``name kind [max_len]`` lines into columns."""
    cols = []
    for line in text.strip().splitlines():
        parts = line.split()
        if not parts:
            continue
        max_len = int(parts[2]) if len(parts) > 2 else None
        cols.append(Col(parts[0], parts[1], max_len))
    return tuple(cols)


# ---------------------------------------------------------------------------
# The three support-desk objects. Names and order must equal the
# reference's column lists (the CSV stage is loaded by position); kinds follow
# the declared table types; the number is the declared varchar length. Element
# types of the arrays are our reading of the names.
# ---------------------------------------------------------------------------

TICKET_COLUMNS = parse_columns(
    """
url string 64
id bigint
external_id string
created_at ntz
updated_at ntz
type string 64
subject string 256
raw_subject string 256
description string
priority string 64
status string 64
recipient string 64
requester_id bigint
submitter_id bigint
assignee_id bigint
organization_id bigint
group_id bigint
collaborator_ids array<bigint>
follower_ids array<bigint>
email_cc_ids array<bigint>
forum_topic_id string 256
problem_id bigint
has_incidents boolean
is_public boolean
due_at ntz
tags array<string>
custom_fields json 2000
sharing_agreement_ids array<bigint>
fields json 2000
followup_ids array<bigint>
ticket_form_id bigint
brand_id bigint
allow_channelback boolean
allow_attachments boolean
generated_timestamp epoch
via.channel string 64
via.source.rel string 64
satisfaction_rating.score string 64
via.source.from.address string 64
via.source.from.name string 64
via.source.to.name string 64
via.source.to.address string 64
via.source.from.ticket_id bigint
via.source.from.subject string 256
via.source.from.channel string 64
satisfaction_rating.id bigint
satisfaction_rating.comment string
satisfaction_rating.reason string 256
satisfaction_rating.reason_id string 256
"""
)

ORGANIZATION_COLUMNS = parse_columns(
    """
url string 256
id bigint
name string 256
shared_tickets boolean
shared_comments boolean
external_id bigint
created_at ntz
updated_at ntz
domain_names array<string>
details string 256
notes string
group_id bigint
tags array<string>
deleted_at ntz
"""
)

USER_COLUMNS = parse_columns(
    """
id bigint
url string 128
name string 128
email string 128
created_at ntz
updated_at ntz
time_zone string 128
iana_time_zone string 128
phone string 64
shared_phone_number string 64
locale_id bigint
locale string 64
organization_id bigint
role string
verified boolean
external_id bigint
tags array<string>
alias string
active boolean
shared boolean
shared_agent boolean
last_login_at ntz
two_factor_auth_enabled boolean
signature string 256
details string 256
notes string
role_type bigint
custom_role_id bigint
moderator boolean
ticket_restriction string 128
only_private_comments boolean
restricted_agent boolean
suspended boolean
default_group_id bigint
report_csv boolean
photo.url string 256
photo.id bigint
photo.file_name string 256
photo.content_url string 256
photo.mapped_content_url string 256
photo.content_type string 128
photo.size bigint
photo.width bigint
photo.height bigint
photo.inline boolean
photo.deleted boolean
photo.thumbnails json 1024
user_fields.agent_ooo boolean
photo string 256
permanently_deleted boolean
"""
)

TICKETS = ObjectSpec("tickets", TICKET_COLUMNS, link_field="after_cursor", time_column="generated_timestamp")
ORGANIZATIONS = ObjectSpec("organizations", ORGANIZATION_COLUMNS)
USERS = ObjectSpec("users", USER_COLUMNS)

OBJECTS: dict[str, ObjectSpec] = {
    "tickets": TICKETS,
    "organizations": ORGANIZATIONS,
    "users": USERS,
}

# The demo table (three text columns) and its literal rows.
DEMO_COLUMNS = ("col_1", "col_2", "col_3")
DEMO_LITERAL_ROWS = (
    ("hard-coded-value-1", "hard-coded-value-2", "hard-coded-value-3"),
    ("hard-coded-value-4", "hard-coded-value-5", "hard-coded-value-6"),
    ("hard-coded-value-7", "hard-coded-value-8", "hard-coded-value-9"),
)
DEMO_PARAMS = {"value_1": "parameter-value-1", "value_2": "parameter-value-2"}


def object_spec(name: str) -> ObjectSpec:
    """Accept only known objects (raises, unlike a built-but-unraised error)."""
    try:
        return OBJECTS[name]
    except KeyError:
        raise ValueError(f"object not defined: {name!r}; known: {sorted(OBJECTS)}") from None
