"""URL filters (13): all wildcard rules at once, as one bit-parallel automaton.

A rule is a glob over the canonical URL: the host, A-Z in lower case, and the path.
``*`` stands for any run of characters but a slash, ``**`` for any run at all, ``?``
for one character but a slash; a backslash takes the next character as it is. Every
literal character of every rule is one bit of a state of several 64-bit words. A
step shifts all bits by one and keeps those whose character is the URL's (Shift-And);
a wildcard run is a bit that keeps itself. So a URL takes one pass, however many
rules there are, and a batch of URLs takes each step together.

Which rule decides is settled by rank: host rules first, longest first; then globs,
longest first; on ties those that block. A URL no rule fits is allowed.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.columns import only

ALLOW, BLOCK = "allow", "block"

#: Words of state in work at a time.
_WORDS_AT_ONCE = 1 << 20


class HostRule(NamedTuple):
    """Fits a host and all its subdomains (any host, if empty) where the path starts so."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


class Glob(NamedTuple):
    pattern: str
    verdict: str


#: The rules of the query: hosts first, then globs for what those leave open.
HOST_RULES = (
    HostRule("com", "/", ALLOW),
    HostRule("example.com", "/en/", BLOCK),
    HostRule("www.example.com", "/en/", ALLOW),
    HostRule("net", "/es/", BLOCK),
    HostRule("net", "/fr/", BLOCK),
)
GLOBS = (
    Glob("adult-**", BLOCK),
    Glob("*.adult-**", BLOCK),
    Glob("ads-**", BLOCK),
    Glob("*.ads-**", BLOCK),
    Glob("casino-**", BLOCK),
    Glob("*.casino-**", BLOCK),
    Glob("spam-**", BLOCK),
    Glob("*.spam-**", BLOCK),
    Glob("*-bets.**", BLOCK),
    Glob("*-pills.**", BLOCK),
    Glob("*/**.exe", BLOCK),
)

_ANY = np.ones(256, bool)
_NO_SLASH = _ANY.copy()
_NO_SLASH[ord("/")] = False
_LATER = np.zeros(256, bool)
_LATER[0x80:0xC0] = True


class _Pattern:
    """States of one rule: which bytes lead to each from the one before, and which keep it."""

    def __init__(self) -> None:
        self.enter: list[np.ndarray] = [np.zeros(256, bool)]
        self.stay: list[np.ndarray] = [np.zeros(256, bool)]

    def literal(self, text: str) -> _Pattern:
        for byte in text.encode():
            only_it = np.zeros(256, bool)
            only_it[byte] = True
            self.enter.append(only_it)
            self.stay.append(np.zeros(256, bool))
        return self

    def run(self, allowed: np.ndarray) -> _Pattern:
        self.stay[-1] = self.stay[-1] | allowed
        return self

    def one(self) -> _Pattern:
        self.enter.append(_NO_SLASH & ~_LATER)
        self.stay.append(_LATER)  # the further bytes of one character
        return self


def parse_glob(pattern: str) -> _Pattern:
    found, at = _Pattern(), 0
    while at < len(pattern):
        sign = pattern[at]
        if sign == "*":
            double = pattern.startswith("**", at)
            found.run(_ANY if double else _NO_SLASH)
            at += 2 if double else 1
        elif sign == "?":
            found.one()
            at += 1
        else:
            at += sign == "\\" and at + 1 < len(pattern)
            found.literal(pattern[at])
            at += 1
    return found


def _of_host_rule(rule: HostRule) -> list[_Pattern]:
    if not rule.host:
        return [_Pattern().run(_NO_SLASH).literal(rule.path).run(_ANY)]
    below = _Pattern().run(_NO_SLASH).literal(f".{rule.name}").run(_ANY)
    return [_Pattern().literal(rule.name).run(_ANY), below]


class Automaton:
    """Masks of all rules, packed into words of 64 states; rules in the order of their rank."""

    def __init__(self, hosts: tuple[HostRule, ...], globs: tuple[Glob, ...]) -> None:
        hosts = sorted(hosts, key=lambda rule: (-len(rule.name), rule.verdict != BLOCK, rule.name))
        globs = sorted(globs, key=lambda glob: (-len(glob.pattern), glob.verdict != BLOCK, glob.pattern))
        patterns, self.rules, self.globs, self.verdicts = [], [], [], []
        for rule in hosts:
            for pattern in _of_host_rule(rule):
                patterns.append(pattern)
                self._add(rule.name, None, rule.verdict)
        for glob in globs:
            patterns.append(parse_glob(glob.pattern))
            self._add(None, glob.pattern, glob.verdict)
        self._add(None, None, ALLOW)
        sizes = np.array([len(pattern.enter) for pattern in patterns], np.int64)
        firsts = np.cumsum(sizes) - sizes
        self.width = max(1, -(-int(sizes.sum()) // 64))
        self.start = self._packed(firsts)
        self.final = firsts + sizes - 1
        self.enter = self._masks([row for pattern in patterns for row in pattern.enter])
        self.stay = self._masks([row for pattern in patterns for row in pattern.stay])

    def sent(self) -> dict:
        """Plain arrays and lists, for executors without this package."""
        return vars(self)

    @staticmethod
    def given(parts: dict) -> Automaton:
        automaton = Automaton.__new__(Automaton)
        vars(automaton).update(parts)
        return automaton

    def _add(self, rule: str | None, glob: str | None, verdict: str) -> None:
        self.rules.append(rule)
        self.globs.append(glob)
        self.verdicts.append(verdict)

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        words = np.zeros(self.width, np.uint64)
        np.bitwise_or.at(words, bits >> 6, np.uint64(1) << (bits & 63).astype(np.uint64))
        return words

    def _masks(self, rows: list[np.ndarray]) -> np.ndarray:
        """For each byte, the words of the states it leads to or keeps."""
        table = np.zeros((self.width * 64, 256), bool)
        if rows:
            table[: len(rows)] = rows
        packed = np.ascontiguousarray(np.packbits(table.T, axis=1, bitorder="little"))
        return packed.view(np.dtype("<u8")).astype(np.uint64)

    def fits(self, urls: list[bytes]) -> np.ndarray:
        """For each URL the place of the first rule, by rank, that fits it whole; the number of
        rules if none does."""
        n = len(urls)
        sizes = np.array([len(url) for url in urls], np.int64)
        order = np.argsort(-sizes, kind="stable")
        data = np.frombuffer(b"".join(urls), np.uint8)
        begins = (np.cumsum(sizes) - sizes)[order]
        shorter = -sizes[order]
        state = np.tile(self.start, (n, 1))
        for at in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(shorter, -at, side="left"))  # URLs of more than ``at`` bytes
            now = state[:live]
            byte = data[begins[:live] + at]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.enter[byte]) | (now & self.stay[byte])
        found = np.full(n, len(self.final))
        if len(self.final):
            ends = (state[:, self.final >> 6] >> (self.final & 63).astype(np.uint64)) & np.uint64(1)
            found[order] = np.where(ends.any(axis=1), ends.argmax(axis=1), len(self.final))
        return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The canonical URL's two parts: after the first ``://`` the host up to a slash, ``?`` or
    ``#``, A-Z in lower case, then the path up to ``?`` or ``#``; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, part), F.lit("")) for part in (1, 2))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def judge(
    pages: DataFrame,
    hosts: tuple[HostRule, ...] = HOST_RULES,
    globs: tuple[Glob, ...] = GLOBS,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per row of ``pages``: ``id_col, host, path, rule, verdict, wildcard``.

    ``rule`` names the host rule that fits, ``wildcard`` the glob that decided where none
    does. A URL that is null or has no ``://`` has an empty host and path, which only
    rules that fit the empty text match. Repeated rows and ids are judged each; a URL
    of any length is read to its end. An empty table gives an empty result; further
    columns are not looked at. The masks take 64 bytes per literal character of the
    rules and are broadcast: their size is that of the rules, not of the data.
    """
    sent = pages.sparkSession.sparkContext.broadcast(Automaton(hosts, globs).sent())
    read = only(pages, id_col, url_col)
    host, path = host_and_path(F.col(url_col).cast("string"))
    parts = read.select(F.col(id_col).alias("page"), host.alias("host"), path.alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton.given(sent.value)
        rows = max(1, _WORDS_AT_ONCE // max(automaton.width, len(automaton.final)))
        rules = pa.array(automaton.rules, pa.string())
        verdicts, names = pa.array(automaton.verdicts, pa.string()), pa.array(automaton.globs, pa.string())
        for whole in batches:
            for begin in range(0, whole.num_rows, rows):
                batch = whole.slice(begin, rows)
                pairs = zip(batch.column("host").cast(pa.binary()), batch.column("path").cast(pa.binary()), strict=True)
                place = pa.array(automaton.fits([host.as_py() + path.as_py() for host, path in pairs]))
                columns = [*batch.columns, *(column.take(place) for column in (rules, verdicts, names))]
                yield pa.record_batch(columns, names=["page", "host", "path", "rule", "verdict", "wildcard"])

    kind = read.schema[id_col].dataType.simpleString()
    judged = parts.mapInArrow(run, f"page {kind}, host string, path string, rule string, verdict string, wildcard string")
    return judged.withColumnRenamed("page", id_col)
