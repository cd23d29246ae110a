"""Declared schemas. Nothing in the package infers one."""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------- raw posts

# Identifiers are read as text and cast later, so that a quoted number is a
# good value instead of a corrupt record.
_HASHTAGS = "array<struct<text: string, indices: array<int>>>"

INGEST_SCHEMA = f"""
    created_at string, id string, id_str string, text string, lang string,
    user struct<id: string, name: string>,
    entities struct<hashtags: {_HASHTAGS}>,
    _corrupt string
"""

_USER = (
    "struct<id: string, name: string, screen_name: string, location: string, url: string, description: string,"
    " followers_count: int, friends_count: int, favourites_count: int, statuses_count: int, time_zone: string,"
    " created_at: string, lang: string>"
)
_PLACE = (
    "struct<id: string, place_type: string, name: string, country_code: string,"
    " bounding_box: struct<coordinates: array<array<array<double>>>>>"
)

# The members that the detail tables read; others are skipped by the parser.
WIDE_SCHEMA = f"""
    id string, id_str string, user {_USER}, place {_PLACE},
    coordinates struct<coordinates: array<double>>,
    entities struct<urls: array<struct<url: string>>, user_mentions: array<struct<screen_name: string>>>,
    retweet_count int, favorite_count int,
    truncated boolean, is_quote_status boolean, possibly_sensitive boolean,
    timestamp_ms string, _corrupt string
"""

# ---------------------------------------------------------------- tables


@dataclass(frozen=True)
class TableSpec:
    """Columns of a table and the rules the audit checks."""

    name: str
    columns: dict[str, str]
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.columns.items())


_POS = "struct<block: bigint, row: bigint>"

# Widths and keys are fixed values of the data model.
STAGING = {
    spec.name: spec
    for spec in (
        TableSpec(
            "lang_stage",
            {
                "src_file": "string",
                "lang_id": "bigint",
                "short_code": "string",
            },
            required=("lang_id", "short_code"),
            max_length={"short_code": 50},
        ),
        TableSpec(
            "users_stage",
            {
                "src_file": "string",
                "name": "string",
                "user_ext_id": "bigint",
            },
            required=("name", "user_ext_id"),
            max_length={"name": 255},
        ),
        TableSpec(
            "posts_stage",
            {
                "src_file": "string",
                "text": "string",
                "user_ext_id": "bigint",
                "post_ext_id": "bigint",
                "lang": "string",
                "lang_id": "bigint",
                "ingest_ts": "timestamp",
                "created_at": "timestamp",
                "tags": "array<string>",
                "pos": _POS,
            },
            required=("text", "user_ext_id", "post_ext_id"),
            max_length={"text": 1024, "lang": 50},
        ),
        TableSpec(
            "post_tag_stage",
            {
                "src_file": "string",
                "post_ext_id": "bigint",
                "tag_id": "bigint",
            },
            required=("post_ext_id", "tag_id"),
        ),
        TableSpec(
            "tags_stage",
            {
                "src_file": "string",
                "tag_id": "bigint",
                "name": "string",
            },
            required=("tag_id", "name"),
            max_length={"name": 255},
        ),
    )
}

MAIN = {
    spec.name: spec
    for spec in (
        TableSpec(
            "languages",
            {
                "lang_id": "bigint",
                "short_code": "string",
                "name": "string",
            },
            key=("lang_id",),
            required=("lang_id",),
            max_length={"short_code": 50, "name": 255},
        ),
        TableSpec(
            "users",
            {
                "user_id": "bigint",
                "user_ext_id": "bigint",
                "name": "string",
            },
            key=("user_id",),
            required=("user_id", "user_ext_id", "name"),
            max_length={"name": 255},
        ),
        TableSpec(
            "posts",
            {
                "post_id": "bigint",
                "created_at": "timestamp",
                "post_ext_id": "bigint",
                "text": "string",
                "user_id": "bigint",
                "lang_id": "bigint",
                "ingest_ts": "timestamp",
            },
            key=("post_id",),
            required=("post_id", "post_ext_id", "text", "user_id"),
            max_length={"text": 1024},
            references={"user_id": ("users", "user_id")},
        ),
        TableSpec(
            "tags",
            {
                "tag_id": "bigint",
                "name": "string",
            },
            key=("tag_id",),
            required=("tag_id",),
            max_length={"name": 255},
        ),
        TableSpec(
            "post_tag",
            {
                "post_tag_id": "bigint",
                "post_ext_id": "bigint",
                "post_id": "bigint",
                "tag_id": "bigint",
            },
            key=("post_tag_id",),
            required=("post_tag_id", "post_id", "tag_id"),
            references={"post_id": ("posts", "post_id"), "tag_id": ("tags", "tag_id")},
        ),
    )
}

# Lines set aside by a staging load.
REJECTS = TableSpec(
    "rejects",
    {
        "src_file": "string",
        "pos": _POS,
        "reason": "string",
        "value": "string",
    },
    required=("reason",),
)

# Files taken in by a load, with what became of each attempt.
LEDGER = TableSpec(
    "ledger",
    {
        "path": "string",
        "src_file": "string",
        "modified": "timestamp",
        "size": "bigint",
        "attempt": "int",
        "outcome": "string",
        "reason": "string",
    },
    required=("path", "src_file", "attempt", "outcome"),
)

# What the audits of a load found.
AUDITS = TableSpec(
    "audits",
    {
        "audit": "string",
        "n": "bigint",
    },
    required=("audit", "n"),
)

# Which keys a load added to a table: one bit per run of 2^shift keys.
KEY_INDEX = TableSpec(
    "key_index",
    {
        "t": "string",
        "shift": "int",
        "number": "bigint",
        "bits": "binary",
    },
    required=("t", "shift", "number", "bits"),
)

TIMINGS = TableSpec(
    "timings",
    {
        "id": "string",
        "profile_id": "string",
        "parent_id": "string",
        "name": "string",
        "duration_ms": "decimal(18,3)",
        "start_ms": "decimal(18,3)",
        "is_root": "boolean",
        "depth": "smallint",
        "custom": "string",
    },
    key=("id",),
    required=("id", "profile_id", "name", "duration_ms", "start_ms", "is_root", "depth"),
    max_length={"name": 200},
)

PROFILES = TableSpec(
    "profiles",
    {
        "id": "string",
        "root_id": "string",
        "started": "timestamp",
        "duration_ms": "decimal(18,1)",
        "user": "string",
        "machine": "string",
    },
    key=("id",),
    required=("id", "started", "duration_ms"),
    max_length={"user": 100, "machine": 100},
)
