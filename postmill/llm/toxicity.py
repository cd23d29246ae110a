"""Toxicity (1): a linear-chain conditional random field over words.

Two labels, toxic and not. A word's features are the word in lower case and its
beginnings of three to six letters, hashed; a line is one chain. Forward-backward
gives each word's marginal. Words of 0.5 or more next to each other are a span;
a document's score is that of its likeliest word.

Labels are of documents, so words are labelled first: a feature belongs to toxic
text if the documents that have it are toxic far more often than others, by the
likelihood ratio; a word of a toxic document with such a feature is a toxic one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.columns import only

#: At most so many labelled documents, those with the smallest hash of their id, fit the field.
MAX_TRAINING_DOCS = 4_000
#: Likelihood ratio, and share of toxic documents among those with it, that make a feature toxic.
LEAST_RATIO, LEAST_SHARE = 25.0, 0.9
#: Chains are cut to so many words for training only, and so many without a toxic word are used.
TRAINING_CHAIN, CLEAN_CHAINS = 128, 40_000
ROUNDS = 30
FEATURE_BITS = 20
_PLACES = (1 << FEATURE_BITS) - 1
TOXIC_FROM = 0.7
#: A task remembers so many words, then forgets all.
REMEMBERED_WORDS = 1_000_000
#: So many texts, of so many characters together, are scored at a time, or one.
_TEXTS_AT_ONCE, _CHARS_AT_ONCE = 2_000, 8_000_000

_WORD = re.compile(r"\w+")


def features(word: str) -> tuple[int, ...]:
    """Places of a word's five features: its first 3, 4, 5 and 6 bytes in lower case, and
    all of them. Each checksum goes on from the one before."""
    low = word.lower().encode("utf-8", "surrogatepass")
    three = crc32(low[:3])
    four = crc32(low[3:4], three)
    five = crc32(low[4:5], four)
    six = crc32(low[5:6], five)
    whole = crc32(low[6:] + b"\n", six)
    return three & _PLACES, (four ^ 1) & _PLACES, (five ^ 2) & _PLACES, (six ^ 3) & _PLACES, whole & _PLACES


class Chains:
    """Chains of words, the longest first, so that at each step the chains that still run
    are the first ones."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.starts = (np.cumsum(lengths) - lengths)[self.order]
        longest = int(self.lengths[0]) if len(lengths) else 0
        self.running = np.searchsorted(-self.lengths, -np.arange(longest), side="left")

    def odds(self, factors: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward odds of toxic at every word. ``factors`` are the odds by the
        word alone, ``moves[i, j]`` the factor from label i to j; the start moves as from 0."""
        ahead, back = np.empty_like(factors), np.ones_like(factors)
        (m00, m01), (m10, m11) = moves
        now = np.zeros(len(self.starts))
        for step, n in enumerate(self.running):
            at, now = self.starts[:n] + step, now[:n]
            now = np.minimum(factors[at] * (m01 + now * m11) / (m00 + now * m10), 1e12)
            ahead[at] = now
        last = len(self.running) - 1
        for step in range(last - 1, -1, -1):
            at = self.starts[: self.running[step + 1]] + step
            next_one = factors[at + 1] * back[at + 1]
            back[at] = (m10 + m11 * next_one) / (m00 + m01 * next_one)
        return ahead, back


class Field:
    """Weights of the features, the bias, and the moves between labels."""

    def __init__(self, weights: np.ndarray, bias: float, moves: np.ndarray) -> None:
        self.weights, self.bias, self.moves = weights, bias, moves
        self.flat = weights.tolist()
        self.known: dict[str, float] = {}

    def marginals(self, chains: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Probability of toxic at every word, chain after chain, and the chains' lengths."""
        lengths = np.array([len(chain) for chain in chains], dtype=np.int64)
        known, flat = self.known, self.flat
        every = set().union(*chains)
        if len(known) + len(every) > REMEMBERED_WORDS:
            known.clear()
        for word in every - known.keys():
            a, b, c, d, e = features(word)
            known[word] = self.bias + flat[a] + flat[b] + flat[c] + flat[d] + flat[e]
        values = [known[word] for chain in chains for word in chain]
        factors = np.exp(np.clip(np.array(values, dtype=float), -30, 30))
        ahead, back = Chains(lengths).odds(factors, self.moves)
        odds = ahead * back
        return odds / (1 + odds), lengths


def _chains_of(text: str) -> list[list[str]]:
    return [_WORD.findall(line) for line in text.split("\n")]


def label_words(texts: list[str], toxic: np.ndarray) -> tuple[list[list[str]], list[list[int]]]:
    """Chains and their words' labels, from documents' labels."""
    size = 1 << FEATURE_BITS
    places: dict[str, int] = {}
    per_text = [[places.setdefault(word, len(places)) for word in _WORD.findall(text)] for text in texts]
    table = np.array([features(word) for word in places], dtype=np.int64).reshape(-1, 5)
    owner = np.repeat(np.arange(len(texts)), [len(own) for own in per_text])
    words = np.array([word for own in per_text for word in own], dtype=np.int64)
    # Copies of a text must not make its words look frequent: a word counts once
    # between the same two neighbours.
    n = len(places) + 1
    around = np.concatenate([[n - 1], words, [n - 1]])
    context = (around[:-2] * n + around[1:-1]) * np.int64(1_000_003) + around[2:] if len(words) else words
    new = np.sort(np.unique(context, return_index=True)[1])
    with_it = np.zeros((2, size))
    for begin in range(0, len(texts), 250):  # few texts at a time, for the driver's memory
        low, high = np.searchsorted(owner[new], [begin, begin + 250])
        part = new[low:high]
        seen = np.unique(owner[part][:, None] * size + table[words[part]])
        toxic_text = toxic[seen // size]
        for label in (0, 1):
            with_it[label] += np.bincount(seen[toxic_text == label] % size, minlength=size)
    n_toxic, n_clean = float(toxic.sum()), float((1 - toxic).sum())
    t, c = with_it[1], with_it[0]

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    rate = n_toxic / max(n_toxic + n_clean, 1)
    ratio = 2 * (part(t, (t + c) * rate) + part(c, (t + c) * (1 - rate)))
    belongs = (ratio > LEAST_RATIO) & (t > LEAST_SHARE * (t + c))
    toxic_word = dict(zip(places, belongs[table].any(axis=1).tolist(), strict=True))
    chains, labels = [], []
    for text, label in zip(texts, toxic, strict=True):
        for chain in _chains_of(text):
            for begin in range(0, len(chain), TRAINING_CHAIN):
                chains.append(chain[begin : begin + TRAINING_CHAIN])
                labels.append([int(label and toxic_word[word]) for word in chains[-1]])
    return chains, labels


def train(chains: list[list[str]], labels: list[list[int]]) -> Field:
    """Maximum likelihood with a small ridge, by Adam over all chains at once."""
    marked = [i for i, label in enumerate(labels) if any(label)]
    plain = [i for i, label in enumerate(labels) if label and not any(label)]
    rng = np.random.default_rng(1)
    used = marked + sorted(rng.permutation(plain)[:CLEAN_CHAINS].tolist())
    chains, labels = [chains[i] for i in used], [labels[i] for i in used]
    size = 1 << FEATURE_BITS
    if not marked:
        return Field(np.zeros(size), -10.0, np.ones((2, 2)))
    vocabulary = {word: i for i, word in enumerate(dict.fromkeys(word for chain in chains for word in chain))}
    table = np.array([features(word) for word in vocabulary])
    words = np.array([vocabulary[word] for chain in chains for word in chain])
    y = np.array([one for label in labels for one in label], dtype=float)
    lengths = np.array([len(chain) for chain in chains])
    runs = Chains(lengths)
    ends = np.zeros(len(words), dtype=bool)
    ends[np.cumsum(lengths) - 1] = True
    inner = np.flatnonzero(~ends)  # words with one after them
    pairs = (y[inner] * 2 + y[inner + 1]).astype(int)
    seen_moves = np.bincount(pairs, minlength=4)
    theta = np.concatenate([np.zeros(size), [-4.0], np.zeros(4)])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        moves = np.exp(theta[-4:].reshape(2, 2))
        factors = np.exp(np.clip(theta[:size][table].sum(1)[words] + theta[size], -30, 30))
        ahead, back = runs.odds(factors, moves)
        p = ahead * back / (1 + ahead * back)
        here, there = ahead[inner], factors[inner + 1] * back[inner + 1]
        joint = np.stack([np.full_like(here, moves[0, 0]), moves[0, 1] * there, here * moves[1, 0], here * moves[1, 1] * there])
        joint /= joint.sum(0)
        wrong = np.bincount(words, weights=p - y, minlength=len(vocabulary))
        gradient = np.concatenate([
            np.bincount(table.ravel(), weights=np.repeat(wrong, table.shape[1]), minlength=size),
            [wrong.sum()],
            joint.sum(1) - seen_moves,
        ])
        gradient += 0.02 * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta -= 0.25 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-3)
    return Field(theta[:size], float(theta[size]), np.exp(theta[-4:].reshape(2, 2)))


def held_out(id_col: str):
    """Rows kept from learning: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_docs: int = MAX_TRAINING_DOCS,
) -> Field:
    """The field, from at most ``max_docs`` labelled documents that are not held out.

    A document labelled twice is toxic if one of its labels is. Null ids and labels
    are left out. Without a toxic document nothing is ever toxic. The driver holds
    the texts of these documents, a bounded sample.
    """
    known = only(labels, id_col, label_col).where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    chosen = (
        known.where(~held_out(id_col))
        .groupBy(id_col)
        .agg(F.max(label_col).cast("int").alias("_y"))
        .orderBy(F.xxhash64(F.col(id_col), F.lit(1)), id_col)
        .limit(max_docs)
    )
    texts = only(docs, id_col, text_col).join(F.broadcast(chosen), id_col)
    rows = texts.select(F.coalesce(text_col, F.lit("")).alias("t"), "_y").toPandas().sort_values(["t", "_y"])
    return train(*label_words(rows["t"].tolist(), rows["_y"].to_numpy(dtype=np.int64).clip(0, 1)))


def score(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``score`` and ``spans`` (array of begin, end
    and probability; offsets count code points, the end is not in it).

    Rows stay where they are; only the field, of fixed size, is sent. Null and
    empty texts, and texts without words, score 0. Repeated rows score alike. An
    empty table gives an empty result; further columns are not looked at.
    """
    given = docs.sparkSession.sparkContext.broadcast((field.weights.astype(np.float32), field.bias, field.moves))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Field(*given.value)
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            begin = held = 0
            for end, text in enumerate(texts, 1):
                held += len(text)
                if end == len(texts) or end - begin >= _TEXTS_AT_ONCE or held >= _CHARS_AT_ONCE:
                    scores, spans = _scored(own, texts[begin:end])
                    yield pa.record_batch(
                        [batch.column(0).slice(begin, end - begin), pa.array(scores, pa.float64()), pa.array(spans, _SPANS)],
                        names=[id_col, "score", "spans"],
                    )
                    begin, held = end, 0

    read = only(docs, id_col, text_col)
    kind = read.schema[id_col].dataType.simpleString()
    return read.mapInArrow(each, f"`{id_col}` {kind}, score double, spans array<struct<begin:int,end:int,p:double>>")


_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))


def _scored(field: Field, texts: list[str]) -> tuple[list[float], list[list[dict]]]:
    per_text = [_chains_of(text) for text in texts]
    p, lengths = field.marginals([chain for chains in per_text for chain in chains])
    n_chains = np.array([len(chains) for chains in per_text])
    chain_ends = np.cumsum(lengths)
    ends = chain_ends[np.cumsum(n_chains) - 1]
    begins = np.concatenate([[0], ends[:-1]])
    starts_line = set((chain_ends - lengths).tolist())
    scores, spans = [], []
    for text, begin, end in zip(texts, begins.tolist(), ends.tolist(), strict=True):
        own = p[begin:end]
        top = float(own.max()) if end > begin else 0.0
        found: list[dict] = []
        if top >= 0.5:
            places = [match.span() for line in _lines(text) for match in _WORD.finditer(text, *line)]
            last = -2
            for word in np.flatnonzero(own >= 0.5).tolist():
                at, chance = places[word], float(own[word])
                if word == last + 1 and begin + word not in starts_line:
                    found[-1]["end"], found[-1]["p"] = at[1], max(found[-1]["p"], chance)
                else:
                    found.append({"begin": at[0], "end": at[1], "p": chance})
                last = word
        scores.append(min(max(top, 0.0), 1.0))
        spans.append(found)
    return scores, spans


def _lines(text: str) -> Iterator[tuple[int, int]]:
    begin = 0
    for line in text.split("\n"):
        yield begin, begin + len(line)
        begin += len(line) + 1


def tag(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fit and score: ``id_col``, ``held_out``, ``score``, ``predicted``, ``spans``."""
    scored = score(docs, fit(docs, labels, id_col, text_col), id_col, text_col)
    return scored.select(
        id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "spans"
    )
