"""Which posts a subscription asks for."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def tracks(text: Column, phrases: Iterable[str]) -> Column:
    """Any phrase matches; a phrase matches when all of its words occur, in any order and case.
    A phrase without words asks for nothing."""
    lowered = F.lower(text)
    hits = [
        reduce(lambda a, b: a & b, [F.contains(lowered, F.lit(word)) for word in phrase.lower().split()])
        for phrase in phrases
        if phrase.split()
    ]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def inside_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    """``box`` is west, south, east, north."""
    west, south, east, north = box
    return F.coalesce(lon.between(west, east) & lat.between(south, north), F.lit(False))


def subscribed(
    *,
    text: Column,
    user_id: Column | None = None,
    lon: Column | None = None,
    lat: Column | None = None,
    lang: Column | None = None,
    filter_level: Column | None = None,
    phrases: Iterable[str] = (),
    users: Iterable = (),
    box: tuple[float, float, float, float] | None = None,
    only_lang: str | None = None,
    only_level: str | None = None,
) -> Column:
    """Phrases, followed users and the box are alternatives; language and level narrow them."""
    wanted = tracks(text, phrases)
    users = list(users)
    if users:
        wanted = wanted | F.coalesce(user_id.isin(users), F.lit(False))
    if box:
        wanted = wanted | inside_box(lon, lat, box)
    if only_lang is not None:
        wanted = wanted & (lang == only_lang)
    if only_level is not None:
        wanted = wanted & (filter_level == only_level)
    return wanted
