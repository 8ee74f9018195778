"""The eight tables of a question-and-answer dump.

Each column names the XML attribute it comes from and the rule that turns the
attribute text into a value (``functions.lenient``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# rule -> type of the column
TYPES: dict[str, T.DataType] = {
    "id": T.LongType(),  # whole number, 0 if absent or bad
    "id?": T.LongType(),  # whole number, NULL if absent, 0 if bad
    "int": T.IntegerType(),
    "int?": T.IntegerType(),
    "text": T.StringType(),  # '' if absent
    "time": T.TimestampNTZType(),  # the year 1 if absent or bad
    "time?": T.TimestampNTZType(),  # NULL if absent or bad
    "flag": T.BooleanType(),  # false unless the text is "true"
}


@dataclass(frozen=True)
class Field:
    column: str
    attribute: str
    rule: str
    required: bool = False

    @property
    def type(self) -> T.DataType:
        return TYPES[self.rule]


@dataclass(frozen=True)
class Entity:
    file: str  # part of the dump's file name
    fields: tuple[Field, ...]
    update: tuple[str, ...] = ()  # columns a later row of a known id overwrites

    @property
    def columns(self) -> list[str]:
        return [f.column for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.column for f in self.fields if f.required]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.column, f.type) for f in self.fields])


# The dump's attributes, the tables' columns and the load order.
ENTITIES: dict[str, Entity] = {
    "users": Entity(
        "Users",
        (
            Field("id", "Id", "id"),
            Field("reputation", "Reputation", "int", required=True),
            Field("display_name", "DisplayName", "text", required=True),
            Field("about_me", "AboutMe", "text"),
            Field("website_url", "WebsiteUrl", "text"),
            Field("location", "Location", "text"),
            Field("creation_date", "CreationDate", "time", required=True),
            Field("last_access_date", "LastAccessDate", "time"),
            Field("views", "Views", "int"),
            Field("up_votes", "UpVotes", "int"),
            Field("down_votes", "DownVotes", "int"),
            Field("account_id", "AccountId", "id"),
        ),
        update=("reputation", "display_name"),
    ),
    "posts": Entity(
        "Posts",
        (
            Field("id", "Id", "id"),
            Field("post_type_id", "PostTypeId", "int", required=True),
            Field("accepted_answer_id", "AcceptedAnswerId", "id?"),
            Field("creation_date", "CreationDate", "time", required=True),
            Field("score", "Score", "int"),
            Field("view_count", "ViewCount", "int?"),
            Field("body", "Body", "text"),
            Field("owner_user_id", "OwnerUserId", "id?"),
            Field("last_editor_user_id", "LastEditorUserId", "id?"),
            Field("last_edit_date", "LastEditDate", "time?"),
            Field("last_activity_date", "LastActivityDate", "time?"),
            Field("title", "Title", "text"),
            Field("tags", "Tags", "text"),
            Field("answer_count", "AnswerCount", "int"),
            Field("comment_count", "CommentCount", "int"),
            Field("favorite_count", "FavoriteCount", "int"),
            Field("closed_date", "ClosedDate", "time?"),
            Field("parent_id", "ParentId", "id?"),
            Field("community_owned_date", "CommunityOwnedDate", "time?"),
        ),
        update=("score", "view_count", "answer_count"),
    ),
    "comments": Entity(
        "Comments",
        (
            Field("id", "Id", "id"),
            Field("post_id", "PostId", "id", required=True),
            Field("user_id", "UserId", "id?"),
            Field("score", "Score", "int"),
            Field("text", "Text", "text", required=True),
            Field("creation_date", "CreationDate", "time", required=True),
        ),
    ),
    "badges": Entity(
        "Badges",
        (
            Field("id", "Id", "id"),
            Field("user_id", "UserId", "id", required=True),
            Field("name", "Name", "text", required=True),
            Field("date", "Date", "time", required=True),
            Field("class", "Class", "int"),
            Field("tag_based", "TagBased", "flag"),
        ),
    ),
    "post_history": Entity(
        "PostHistory",
        (
            Field("id", "Id", "id"),
            Field("post_id", "PostId", "id", required=True),
            Field("user_id", "UserId", "id?"),
            Field("post_history_type_id", "PostHistoryTypeId", "int", required=True),
            Field("revision_guid", "RevisionGUID", "text"),
            Field("creation_date", "CreationDate", "time", required=True),
            Field("text", "Text", "text"),
            Field("comment", "Comment", "text"),
        ),
    ),
    "post_links": Entity(
        "PostLinks",
        (
            Field("id", "Id", "id"),
            Field("creation_date", "CreationDate", "time", required=True),
            Field("post_id", "PostId", "id", required=True),
            Field("related_post_id", "RelatedPostId", "id", required=True),
            Field("link_type_id", "LinkTypeId", "int", required=True),
        ),
    ),
    "tags": Entity(
        "Tags",
        (
            Field("id", "Id", "id"),
            Field("tag_name", "TagName", "text", required=True),
            Field("count", "Count", "int"),
            Field("excerpt_post_id", "ExcerptPostId", "id?"),
            Field("wiki_post_id", "WikiPostId", "id?"),
        ),
    ),
    "votes": Entity(
        "Votes",
        (
            Field("id", "Id", "id"),
            Field("post_id", "PostId", "id", required=True),
            Field("vote_type_id", "VoteTypeId", "int", required=True),
            Field("user_id", "UserId", "id?"),
            Field("creation_date", "CreationDate", "time", required=True),
            Field("bounty_amount", "BountyAmount", "int?"),
        ),
    ),
}

# post_type_id.
QUESTION, ANSWER = 1, 2

# The foreign keys, as (child table, column, parent table).
FOREIGN_KEYS: tuple[tuple[str, str, str], ...] = (
    ("badges", "user_id", "users"),
    ("posts", "owner_user_id", "users"),
    ("posts", "last_editor_user_id", "users"),
    ("posts", "accepted_answer_id", "posts"),
    ("posts", "parent_id", "posts"),
    ("comments", "post_id", "posts"),
    ("comments", "user_id", "users"),
    ("post_history", "post_id", "posts"),
    ("post_history", "user_id", "users"),
    ("post_links", "post_id", "posts"),
    ("post_links", "related_post_id", "posts"),
    ("votes", "post_id", "posts"),
    ("votes", "user_id", "users"),
)

# The keys that loading repairs; the others are only audited.
REPAIRED_KEYS: dict[str, str] = {
    column: parent for child, column, parent in FOREIGN_KEYS if child == "posts"
}
