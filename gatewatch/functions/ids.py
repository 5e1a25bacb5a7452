"""Event identifiers derived from the record itself, stable across replays."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def hashed_event_id(time: Column, user: Column, computer: Column) -> Column:
    """First 32 hex digits of the SHA-256 of ``time|user|computer``."""
    return F.substring(F.sha2(F.concat_ws("|", time, user, computer), 256), 1, 32)


def joined_event_id(*parts: Column) -> Column:
    """``time-user-computer``, with a line number as a fourth part if given."""
    return F.concat_ws("-", *parts)
