"""BPE encoding and decoding (2): merges by rank over a linked list of symbols.

Works from the tokenizer's own file: its vocabulary, ranked merges, byte alphabet
and added tokens. A piece's symbols form a doubly linked list; a heap holds the
rank and place of each pair that may merge. The lowest rank, then the leftmost
place, merges next; entries whose symbols have since changed are skipped when
they come up. A piece of n bytes takes n log n steps, however long. Short
pieces repeat, so a task remembers those it has met, up to a bound.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession


from postmill.llm.columns import only

#: How byte-level tokenizers of this kind cut text into pieces. ``cut``
#: does the same for whole texts at once.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OTHER, LETTER, NUMBER, BLANK = 0, 1, 2, 3

#: Pieces of more bytes are not remembered; so many are at most, then all are forgotten.
#: With its entry a piece takes 150 bytes or so, a process 45 MB; tasks that follow in the
#: same process find what earlier ones have met.
REMEMBERED_BYTES, REMEMBERED_PIECES = 48, 300_000
#: About so many ids of one text are turned into numbers and bytes at a time.
_IDS_AT_ONCE = 1 << 18


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself where it can be printed, the
    others, in order, the characters from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(byte if byte in printable else next(others)) for byte in range(256)]


def character_classes() -> bytes:
    """For each code point: letter, number, blank or other, as the pattern has them."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    classes = np.zeros(0x110000, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\s+")):
        for found in regex.finditer(pattern, every):
            classes[[ord(sign) for sign in found[0]]] = kind
    return classes.tobytes()


def cut(text: str, classes: np.ndarray) -> list[str]:
    """The pieces of a text, by comparing every character with its neighbours.

    A piece is a run of one class; a space goes to the run after it; of other
    blanks before a run the last stands alone. An apostrophe that begins a run
    and is followed by one of a few endings makes a piece with it.
    """
    n = len(text)
    if n < 2:
        return [text] if text else []
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    kind = classes[points]
    begins = np.ones(n + 1, dtype=bool)
    changed = kind[1:] != kind[:-1]
    blank = kind == BLANK
    # A run of blanks before something else gives up its last one ...
    last = blank[:-1] & ~blank[1:]
    begins[1:n] = changed
    begins[: n - 1] |= last
    # ... which, if it is a space, belongs to what follows.
    begins[1:n] &= ~(last & (points[:-1] == 0x20))
    if "'" in text:
        for at in np.flatnonzero(points == 0x27).tolist():
            if at and (kind[at - 1] == OTHER or points[at - 1] == 0x20):
                continue
            after = text[at + 1 : at + 3]
            size = 2 if after in ("re", "ve", "ll") else 1 if after[:1] in ("s", "t", "m", "d") and after else 0
            if size:
                begins[at + 1] = False
                begins[at + 2 : at + 1 + size] = False
                begins[at + 1 + size] = True
    bounds = np.flatnonzero(begins).tolist()
    return [text[i:j] for i, j in zip(bounds, bounds[1:], strict=False)]


class Tokenizer:
    """A byte-level BPE tokenizer as its file describes it."""

    def __init__(self, definition: str, classes: bytes) -> None:
        parts = json.loads(definition)
        vocab: dict[str, int] = parts["model"]["vocab"]
        alphabet = byte_alphabet()
        byte_of = {sign: byte for byte, sign in enumerate(alphabet)}
        self.first = [vocab[sign] for sign in alphabet]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(parts["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((vocab[left], vocab[right]), (rank, vocab[left + right]))
        self.added = {token["content"]: token["id"] for token in parts["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes_of = [b""] * size
        for token, number in vocab.items():
            self.bytes_of[number] = bytes(byte_of[sign] for sign in token)
        for token, number in self.added.items():
            self.bytes_of[number] = token.encode()
        self.classes = np.frombuffer(classes, dtype=np.uint8)
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.known: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """The ids of one piece."""
        symbols = [self.first[byte] for byte in data]
        n = len(symbols)
        if n < 2:
            return symbols
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        merges = self.merges
        heap = []
        for at in range(n - 1):
            found = merges.get((symbols[at], symbols[at + 1]))
            if found:
                heap.append((found[0], at, found[1]))
        heapq.heapify(heap)
        while heap:
            rank, at, merged = heapq.heappop(heap)
            right = after[at]
            if symbols[at] < 0 or right < 0:
                continue  # swallowed meanwhile, or nothing to its right any more
            found = merges.get((symbols[at], symbols[right]))
            if not found or found[0] != rank:
                continue  # the pair at this place has changed
            symbols[at], symbols[right] = merged, -1
            beyond = after[at] = after[right]
            if beyond >= 0:
                before[beyond] = at
                found = merges.get((merged, symbols[beyond]))
                if found:
                    heapq.heappush(heap, (found[0], at, found[1]))
            left = before[at]
            if left >= 0:
                found = merges.get((symbols[left], merged))
                if found:
                    heapq.heappush(heap, (found[0], left, found[1]))
        return [symbol for symbol in symbols if symbol >= 0]

    def _piece(self, piece: str) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            data = piece.encode()
            ids = np.array(self.merge(data), dtype="<u4").tobytes()
            if len(data) <= REMEMBERED_BYTES:
                if len(self.known) >= REMEMBERED_PIECES:
                    self.known.clear()
                self.known[piece] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        known = self.known
        pieces = cut(text, self.classes)
        try:
            return b"".join([known[piece] for piece in pieces])
        except KeyError:
            return b"".join([self._piece(piece) for piece in pieces])

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit numbers."""
        if self.special is None:
            return self._plain(text)
        parts, end = [], 0
        for match in self.special.finditer(text):
            parts += [self._plain(text[end : match.start()]), np.array([self.added[match[0]]], "<u4").tobytes()]
            end = match.end()
        return b"".join([*parts, self._plain(text[end:])])

    def decode(self, ids: bytes) -> bytes:
        """The bytes the ids stand for; what is no UTF-8 in them becomes U+FFFD."""
        numbers, bytes_of = np.frombuffer(ids, dtype="<u4"), self.bytes_of
        parts = (
            b"".join([bytes_of[number] for number in numbers[begin : begin + _IDS_AT_ONCE].tolist()])
            for begin in range(0, len(numbers), _IDS_AT_ONCE)
        )
        return b"".join(parts).decode("utf-8", "replace").encode()




def _held(definition: str, classes: bytes) -> Tokenizer:
    """The process's own tokenizer. A worker serves many tasks, but each brings its own
    copy of this module; so what earlier ones have met is kept beside ``sys``."""
    store = sys.__dict__.setdefault("_byte_level_tokenizer", {})
    name = (hashlib.sha256(definition.encode()).hexdigest(), REMEMBERED_PIECES)
    if name not in store:
        store.clear()
        store[name] = Tokenizer(definition, classes)
    return store[name]


def read_definition(path: str) -> str:
    """The tokenizer's file, on the driver."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(
    docs: DataFrame, definition: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_tokens``, ``ids`` (array of int, unless
    ``with_ids`` is off), ``ids_sha256``, ``decoded_sha256``, of the whole text.

    The tokenizer's definition, a few megabytes whatever the data, is broadcast;
    rows stay where they are. A null text counts as empty and has no ids. An
    empty table gives an empty result; further columns are not looked at.
    """
    given = docs.sparkSession.sparkContext.broadcast((definition, character_classes()))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _held(*given.value)
        for whole in batches:
            for begin in range(0, whole.num_rows, 256):
                yield batch_of(tokenizer, whole.slice(begin, 256))

    def batch_of(tokenizer: Tokenizer, batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, ids_sha, decoded_sha, lists = [], [], [], []
        for text in batch.column(1):
            ids = tokenizer.encode(text.as_py() or "")
            counts.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            decoded_sha.append(hashlib.sha256(tokenizer.decode(ids)).hexdigest())
            if with_ids:
                lists.append(np.frombuffer(ids, dtype="<u4").astype(np.int32))
        columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)]
        names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns, names = [*columns, pa.array(lists, pa.list_(pa.int32()))], [*names, "ids"]
        return pa.record_batch(columns, names=names)

    read = only(docs, id_col, text_col)
    schema = f"`{id_col}` {read.schema[id_col].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return read.mapInArrow(each, schema + (", ids array<int>" if with_ids else ""))


def decode(encoded: DataFrame, definition: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text`` of each row of ids; null ids give an empty text."""
    given = encoded.sparkSession.sparkContext.broadcast((definition, character_classes()))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _held(*given.value)
        for batch in batches:
            texts = [tokenizer.decode(np.array(ids.as_py() or [], dtype="<u4").tobytes()).decode() for ids in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    read = only(encoded, id_col, ids_col)
    return read.mapInArrow(each, f"`{id_col}` {read.schema[id_col].dataType.simpleString()}, text string")
