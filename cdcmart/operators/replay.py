"""Reading a change log again from a chosen position."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.specs import OFFSET

EARLIEST = "earliest"
LATEST = "latest"
# Kafka's JSON codes for the two ends of a partition.
_ENDS = {EARLIEST: -2, LATEST: -1}


def parse_position(text: str) -> str | int:
    """``earliest``, ``latest`` or a non-negative offset."""
    word = str(text).lower()
    if word in _ENDS:
        return word
    if word.isdigit():
        return int(word)
    raise ValueError(f"{text!r} is neither 'earliest', 'latest' nor an offset")


def starting_offsets(topic: str, position: str | int, partitions: Iterable[int] = (0,)) -> str:
    """The ``startingOffsets`` option of the Kafka source for a position."""
    if position in _ENDS:
        return str(position)
    return json.dumps({topic: {str(p): int(position) for p in partitions}})


def replay_from(changes: DataFrame, position: str | int, offset: str = OFFSET) -> DataFrame:
    """Changes at or after a position of an already stored log."""
    if position == EARLIEST:
        return changes
    if position == LATEST:
        raise ValueError("a stored log has no events after its latest offset")
    return changes.where(F.col(offset) >= int(position))
