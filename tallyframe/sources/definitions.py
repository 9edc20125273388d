"""Table definitions: columns plus the rules their rows must keep."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


@dataclass(frozen=True)
class ColumnDef:
    name: str
    type: DataType
    required: bool = False
    max_length: int | None = None
    default: Column | None = None


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableDef:
    """Columns, keys and checks of one table. Checks are named conditions; NULL passes."""

    name: str
    columns: tuple[ColumnDef, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: Mapping[str, Column] = field(default_factory=dict)
    generated: str | None = None

    def schema(self) -> StructType:
        return StructType([StructField(c.name, c.type, True) for c in self.columns])

    def required(self) -> list[str]:
        return list(dict.fromkeys([*self.primary_key, *[c.name for c in self.columns if c.required]]))

    def max_lengths(self) -> dict[str, int]:
        return {c.name: c.max_length for c in self.columns if c.max_length is not None}

    def defaults(self) -> dict[str, Column]:
        return {c.name: c.default.cast(c.type) for c in self.columns if c.default is not None}


# --- checks ---------------------------------------------------------------


def one_of(name: str, *values: str) -> Column:
    return F.col(name).isin(*values)


def after_day(name: str, day: dt.date) -> Column:
    return F.col(name) > F.lit(day)


def after(end: str, start: str) -> Column:
    """The end is open or lies after the start."""
    return F.col(end).isNull() | (F.col(end) > F.col(start))


def differ(left: str, right: str) -> Column:
    return F.col(left) != F.col(right)


# --- the social-media tables ----------------------------------------------


def _key(name: str) -> ColumnDef:
    return ColumnDef(name, LongType(), required=True)


def _link(name: str) -> ColumnDef:
    return ColumnDef(name, LongType(), required=True)


def _text(name: str, length: int | None = None, required: bool = True) -> ColumnDef:
    return ColumnDef(name, StringType(), required, length)


def _moment(name: str, required: bool = False, now: bool = False) -> ColumnDef:
    default = F.current_timestamp() if now else None
    return ColumnDef(name, TimestampNTZType(), required, default=default)


def _to(parent: str, column: str, parent_column: str | None = None) -> ForeignKey:
    return ForeignKey((column,), parent, (parent_column or column,))


def social_tables() -> dict[str, TableDef]:
    """The thirteen tables, parents before children.

    Names, lengths, allowed values and the year-2000 bound are fixed values.
    """
    start = dt.date(2000, 1, 1)
    tables = [
        TableDef(
            "user",
            (
                _key("user_id"),
                _text("user_name", 50),
                _text("email_info", 100),
                _text("phone_number", 20, required=False),
                _text("password", 255),
                _moment("creation_time", now=True),
            ),
            ("user_id",),
            (("user_name",), ("email_info",), ("phone_number",)),
            checks={"creation_time after the first day": after_day("creation_time", start)},
            generated="user_id",
        ),
        TableDef(
            "media_type",
            (_key("media_type_id"), _text("media_type_name", 20)),
            ("media_type_id",),
            (("media_type_name",),),
            checks={"media_type_name is listed": one_of("media_type_name", "image", "video", "gif")},
            generated="media_type_id",
        ),
        TableDef(
            "visibility_setting",
            (_key("visibility_setting_id"), _text("visibility_type", 20)),
            ("visibility_setting_id",),
            (("visibility_type",),),
            checks={"visibility_type is listed": one_of("visibility_type", "public", "followers", "private")},
            generated="visibility_setting_id",
        ),
        TableDef(
            "hashtag",
            (_key("hashtag_id"), _text("hashtag_name", 50)),
            ("hashtag_id",),
            (("hashtag_name",),),
            generated="hashtag_id",
        ),
        TableDef(
            "share_platform",
            (_key("share_platform_id"), _text("platform_name", 50)),
            ("share_platform_id",),
            (("platform_name",),),
            generated="share_platform_id",
        ),
        TableDef(
            "profile",
            (
                _key("profile_id"),
                _link("user_id"),
                _text("first_name", 50),
                _text("last_name", 50),
                _text("bio", required=False),
                ColumnDef("birth_date", DateType()),
                _text("location", 50, required=False),
            ),
            ("profile_id",),
            (("user_id",),),
            (_to("user", "user_id"),),
            generated="profile_id",
        ),
        TableDef(
            "post",
            (
                _key("post_id"),
                _link("user_id"),
                _link("visibility_setting_id"),
                _moment("creation_time", now=True),
                _moment("deleted_at"),
                _text("description", required=False),
            ),
            ("post_id",),
            (),
            (_to("user", "user_id"), _to("visibility_setting", "visibility_setting_id")),
            {
                "deleted_at after creation_time": after("deleted_at", "creation_time"),
                "creation_time after the first day": after_day("creation_time", start),
            },
            "post_id",
        ),
        TableDef(
            "follow",
            (
                _link("follower_user_id"),
                _link("following_user_id"),
                _moment("follow_time", required=True, now=True),
                _moment("removal_time"),
            ),
            ("follower_user_id", "following_user_id"),
            (),
            (_to("user", "follower_user_id", "user_id"), _to("user", "following_user_id", "user_id")),
            {
                "follower_user_id differs from following_user_id": differ("follower_user_id", "following_user_id"),
                "follow_time after the first day": after_day("follow_time", start),
                "removal_time after follow_time": after("removal_time", "follow_time"),
            },
        ),
        TableDef(
            "comment",
            (
                _key("comment_id"),
                _link("post_id"),
                _link("user_id"),
                _text("comment_text"),
                _moment("creation_time", required=True, now=True),
                _moment("deleted_at"),
            ),
            ("comment_id",),
            (),
            (_to("post", "post_id"), _to("user", "user_id")),
            {
                "creation_time after the first day": after_day("creation_time", start),
                "deleted_at after creation_time": after("deleted_at", "creation_time"),
            },
            "comment_id",
        ),
        TableDef(
            "like",
            (
                _key("like_id"),
                _link("post_id"),
                _link("user_id"),
                _moment("liked_at", required=True, now=True),
                _moment("unliked_at"),
            ),
            ("like_id",),
            (("post_id", "user_id"),),
            (_to("post", "post_id"), _to("user", "user_id")),
            {"liked_at after the first day": after_day("liked_at", start), "unliked_at after liked_at": after("unliked_at", "liked_at")},
            "like_id",
        ),
        TableDef(
            "share",
            (
                _key("share_id"),
                _link("post_id"),
                _link("user_id"),
                _link("share_platform_id"),
                _moment("shared_at", required=True, now=True),
            ),
            ("share_id",),
            (),
            (_to("post", "post_id"), _to("user", "user_id"), _to("share_platform", "share_platform_id")),
            {"shared_at after the first day": after_day("shared_at", start)},
            "share_id",
        ),
        TableDef(
            "post_media",
            (
                _key("post_media_id"),
                _link("post_id"),
                _link("media_type_id"),
                _moment("uploaded_at", required=True, now=True),
                _moment("removed_at"),
            ),
            ("post_media_id",),
            (),
            (_to("post", "post_id"), _to("media_type", "media_type_id")),
            {
                "uploaded_at after the first day": after_day("uploaded_at", start),
                "removed_at after uploaded_at": after("removed_at", "uploaded_at"),
            },
            "post_media_id",
        ),
        TableDef(
            "post_hashtag",
            (_link("post_id"), _link("hashtag_id")),
            ("post_id", "hashtag_id"),
            (),
            (_to("post", "post_id"), _to("hashtag", "hashtag_id")),
        ),
    ]
    return {table.name: table for table in tables}
