"""Record shapes and allowed values of the event domain."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# The contract of the event domain.
EVENT_TYPES = ("page_view", "video_play", "video_pause", "add_to_cart", "purchase")
SOURCES = ("web", "mobile", "api", "system")
REQUIRED_FIELDS = ("event_id", "event_type", "user_id", "event_ts", "source", "payload")
REJECT_COLUMNS = ("event_id", "event_type", "user_id", "event_ts", "source", "reject_reason")
EVENT_CATEGORIES = (
    ("page_view", "engagement"),
    ("video_play", "engagement"),
    ("add_to_cart", "commerce"),
    ("purchase", "commerce"),
)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Nested event: payload values arrive as text, whatever their JSON type was.
EVENT_SCHEMA = T.StructType(
    _strings("event_id", "event_type", "user_id", "event_ts", "source")
    + [T.StructField("payload", T.MapType(T.StringType(), T.StringType()))]
)

# Flat event: no payload, a session and a typed amount. JSON readers make every
# field nullable, so "required" is enforced by the quality rules.
FLAT_EVENT_SCHEMA = T.StructType(
    _strings("event_id", "event_type", "user_id", "event_ts", "source", "session_id")
    + [T.StructField("amount", T.DoubleType())]
)

USER_SCHEMA = T.StructType(_strings("user_id", "plan", "region"))

# Keyed stream event, as published with the user as message key.
KEYED_EVENT_SCHEMA = T.StructType(
    _strings("event_id", "event_type", "user_id") + [T.StructField("round", T.IntegerType())] + _strings("event_ts")
)

MINIMAL_FIELDS = ("event_id", "event_type", "user_id")


@dataclass(frozen=True)
class Contract:
    """What a valid event looks like; every part may be replaced for another domain."""

    event_types: tuple[str, ...] = EVENT_TYPES
    sources: tuple[str, ...] = SOURCES
    required: tuple[str, ...] = REQUIRED_FIELDS
    entity_col: str = "user_id"

    def with_(self, **changes: object) -> "Contract":
        return replace(self, **changes)


DEFAULT_CONTRACT = Contract()

# Entity-keyed events name the entity freely and may leave it out.
ENTITY_CONTRACT = Contract(
    required=("event_id", "event_type", "event_ts", "source", "payload"), entity_col="entity_id"
)
