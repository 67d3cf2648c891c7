"""Code lists of the feeds, and lenient parsing of feed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

# Feed names and the integer codes stored for them.
SCHEDULE_RELATIONSHIP = {"scheduled": 0, "added": 1, "unscheduled": 2, "canceled": 3, "skipped": 4}
CONGESTION_LEVEL = {
    "unknown": 0, "smooth": 1, "low": 1, "moderate": 2, "medium": 2, "severe": 3, "heavy": 3,
}
OCCUPANCY_STATUS = {
    "empty": 0, "many_seats_available": 1, "few_seats_available": 2, "standing_room_only": 3,
    "crushed_standing_room_only": 4, "full": 5, "not_accepting_passengers": 6,
}


def lookup(key: Column, table: dict) -> Column:
    """Value for ``key``, null when it is not in ``table``."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def to_code(value: Column, table: dict[str, int]) -> Column:
    """Integer code of a feed value: whole numbers pass, names are case-blind, others are null."""
    text = value.cast("string")
    return F.coalesce(text.try_cast("int"), lookup(F.lower(text), table))


# Epoch seconds of the first and the last day that a stored instant can have (years 1 to 9999).
FIRST_SECOND, LAST_SECOND = -62135596800, 253402300799


# Enum codes of nested feed messages by the message and field that hold them.
MESSAGE_ENUMS = {
    "trip.schedule_relationship": {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED"},
    "stop_time_update.schedule_relationship": {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA"},
    "vehicle.current_status": {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"},
    "vehicle.congestion_level": {
        0: "UNKNOWN_CONGESTION_LEVEL", 1: "RUNNING_SMOOTHLY", 2: "STOP_AND_GO", 3: "CONGESTION", 4: "SEVERE_CONGESTION"},
}


def with_names(value: Column, kind: DataType, enums: dict[str, dict[int, str]], path: str = "") -> Column:
    """A nested message with names for its enum codes, at any depth.

    ``enums`` is keyed by the last two names of a field's path. The code 0 and
    codes without a name are null, as are missing messages; lists stay lists.
    """
    if isinstance(kind, StructType):
        fields = [with_names(value[f.name], f.dataType, enums, f"{path}.{f.name}").alias(f.name) for f in kind]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda item: with_names(item, kind.elementType, enums, path))
    table = enums.get(".".join(path.split(".")[-2:]))
    return value if table is None else F.when(value != 0, lookup(value.cast("int"), table))


def instant(seconds: Column) -> Column:
    """Epoch seconds as an instant; null when outside the years 1 to 9999."""
    inside = seconds.between(FIRST_SECOND, LAST_SECOND)
    micros = (F.when(inside, seconds).cast("double") * 1_000_000).cast("bigint")
    return F.timestamp_micros(micros)


def _epoch(text: Column) -> Column:
    return F.when(text.rlike("^[+-]?[0-9]+(\\.[0-9]+)?$"), text.try_cast("double"))


def parse_time(value: Column) -> Column:
    """ISO text (``Z`` or an offset) or epoch seconds as text or number; else null."""
    text = value.cast("string")
    iso = F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_timestamp(text))
    return F.coalesce(iso, instant(_epoch(text)))


def wild_time(value: Column) -> Column:
    """Whether a value is a number of seconds that is no instant."""
    seconds = _epoch(value.cast("string"))
    return F.coalesce(~seconds.between(FIRST_SECOND, LAST_SECOND), F.lit(False))
