"""What a catalogue entry is."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Entry(NamedTuple):
    """A query and, where plain SQL can say it, the SQL of its result."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
