"""Text columns: tags, keys, request strings."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A tag written in a text ends at the first of these signs.
TAG_END_SIGNS = "'.?,:!…💕"

PREVIEW_CHARS = 250

# Unicode white space, the characters with that property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def trim_all(value: Column) -> Column:
    """trim every Unicode white space, not only the blank."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def normalise_tag(tag: Column) -> Column:
    """F1 + F2: the spelling under which a tag is stored."""
    return F.lower(trim_all(tag))


def extract_tags(text: Column, keep_empty: bool = False) -> Column:
    """Tags written in ``text``, in order, as an array.

    A tag is a white-space separated token that starts with ``#`` and is not
    alone, without the sign and cut at the first end sign. One scan of the text
    does the split, the filter and the cut. ``keep_empty`` keeps the empty tag
    that a token such as ``#'x`` leaves behind.
    """
    size = "*" if keep_empty else "+"
    pattern = rf"(?U)(?:^|\s)#(?=\S)([^\s{TAG_END_SIGNS}]{size})\S*"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def contains_text(text: Column, part: Column, ignore_case: bool = True) -> Column:
    """substring test."""
    return F.contains(F.lower(text), F.lower(part)) if ignore_case else F.contains(text, part)


def dictionary_key(kind: str, value: Column) -> Column:
    """``kind:value``, the key form of the dictionaries."""
    return F.concat(F.lit(f"{kind}:"), value)


def preview(value: Column, chars: int = PREVIEW_CHARS) -> Column:
    """The first characters of a line for display."""
    return F.substring(value, 1, chars)


def joined(values: Column | Iterable[Column], separator: str = ",") -> Column:
    """an array column, or several columns, as one list text."""
    if isinstance(values, Column):
        return F.array_join(values, separator)
    return F.concat_ws(separator, *values)


def form_text(value: Column) -> Column:
    """a request string without its leading ``&`` and with ``#`` escaped."""
    return F.replace(F.regexp_replace(value, "^&", ""), F.lit("#"), F.lit("%23"))


def percent_encode(value: Column) -> Column:
    """percent-encode as UTF-8, leaving only ``A-Z a-z 0-9 - _ . ~``."""
    encoded = F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def utf8_bytes(value: Column) -> Column:
    """text to UTF-8 bytes."""
    return F.encode(value, "UTF-8")


def utf8_text(value: Column) -> Column:
    """UTF-8 bytes to text."""
    return F.decode(value, "UTF-8")


def is_blank(value: Column) -> Column:
    """null or empty."""
    return value.isNull() | (value == "")
