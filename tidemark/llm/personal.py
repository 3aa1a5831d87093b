"""Personal data: patterns, and a skip-chain conditional random field that keeps a document's labels consistent."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, Scratch
from tidemark.session import session_settings

KINDS = ("email", "ip", "card", "phone")
#: Documents that the weights are fitted on (about; by a hash of the id), and the tokens that one may have.
MAX_TRAINING, MAX_TRAINING_TOKENS = 20_000, 200
#: Least marginal of a kind for a token to be added.
THRESHOLD = 0.8
#: Log weight of two linked tokens having the same kind. It is given, not fitted: the sample's labels come
#: from patterns, which look at a word alone, and would teach that what they miss is no entity.
AGREEMENT = 4.0
ROUNDS = 20
#: Texts go to Python in batches of so many rows; tokens go through inference in groups of about so many.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000}
GROUP_TOKENS = 20_000

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Words that the field labels have a digit or an at sign; the others are no entity.
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_NO_DIGIT = re.compile(r"[^0-9]+")

#: Digits of neighbours that can be one span: cards and phones are written in groups, the other kinds are not.
_MOST_DIGITS = (0, 0, 19, 15)

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with the letters before it, from the last match on, and the domain behind it."""
    last, at = 0, text.find("@")
    while at >= 0:
        local = at - last - len(text[last:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if local else None
        if found:
            yield at - local, found.end()
            last = found.end()
        else:  # no match may reach over this sign
            last = at + 1
        at = text.find("@", last)


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers at a time of each run of numbers joined by dots."""
    for run in _DOTTED.finditer(text):
        parts = run[0].split(".")
        begin = run.start()
        for at in range(0, len(parts) - 3, 4):
            four = parts[at : at + 4]
            length = sum(map(len, four)) + 3
            if all(len(short := part.lstrip("0")) <= 3 and int(short or "0") <= 255 for part in four):
                yield begin, begin + length
            begin += length + 1


def patterns(text: str) -> list[Span]:
    """The base spans, leftmost and non-overlapping in each kind; every search is linear in the text."""
    found = []
    if "@" in text:
        found += [(start, 0, end) for start, end in _emails(text)]
    found += [(start, 1, end) for start, end in _addresses(text)]
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 12:
            digits = _NO_DIGIT.sub("", match[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((match.start(), 2, match.end()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", match[0])) <= 15:
                found.append((match.start(), 3, match.end()))
    return sorted(found)


@dataclass
class Tokens:
    """Words with a digit or an at sign of one text: bounds of their cores, features, labels and links.

    ``plain`` says whether the words before and behind a token are others (or none); ``links`` has (earlier, later, type), type 0 for
    neighbours, 1 for repeated and 2 for similar tokens.
    """

    bounds: list[tuple[int, int]]
    features: np.ndarray
    plain: np.ndarray
    label: np.ndarray
    links: np.ndarray


FEATURES = 42


def _features(core: str, digits: str) -> list[bool]:
    n = len(digits)
    letters = any(c.isalpha() for c in core)
    parts = core.split(".")
    numbers = len(parts) > 1 and all(part.isdecimal() and part.isascii() for part in parts)
    before, _, behind = core.partition("@")
    grouped = core.replace("-", "").replace("(", "").replace(")", "").replace("+", "").isdecimal()
    return [
        True, n == 0, n == 1, n == 2, n == 3, n == 4, 5 <= n <= 6, n == 7, 8 <= n <= 9, n == 10, n == 11, 12 <= n <= 15,
        n == 16, 17 <= n <= 19, n >= 20, letters, letters and n > 0, "@" in core, bool(before and behind) and "@" in core,
        "." in behind.strip("."), core.startswith("+"), core.startswith("("), core.endswith(")"), "-" in core, "/" in core, ":" in core,
        "=" in core, '"' in core, "_" in core, numbers, numbers and len(parts) == 4, numbers and len(parts) in (2, 3),
        numbers and len(parts) == 4 and all(len(part) <= 3 and int(part) <= 255 for part in parts), 12 <= n <= 19 and grouped,
        12 <= n <= 19 and grouped and luhn(digits), grouped and n == len(core), grouped and n < len(core),
        core.startswith("+") and n <= 3, "(" in core and n == 3, grouped and "-" in core and n in (6, 7, 8), len(core) > 40, letters and n >= 8,
    ]


def _keys(core: str, digits: str) -> Iterator[tuple[int, str]]:
    """(link type, key): tokens of one text that share a key are linked, each with the one before."""
    low = core.lower()
    yield 1, low
    if len(digits) >= 7:
        yield 2, "number " + digits[-7:]
    if "@" in low:
        local, _, domain = low.partition("@")
        if any(c.isdigit() for c in local):
            yield 2, local
        if any(c.isdigit() for c in domain):
            yield 2, domain
    elif not low.isdecimal() and any(c.isalpha() for c in low):
        yield 2, low


_EDGE = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum() and chr(c) not in "@+()")


def tokens(text: str, spans: Sequence[Span]) -> Tokens | None:
    """The tokens of a text, labelled by the base spans they overlap; None if there are none."""
    bounds, features, label, words, links = [], [], [], [], []
    last: dict[tuple[int, str], int] = {}
    at = 0
    reached = sorted((start, end, kind + 1) for start, kind, end in spans)
    for match in _TOKEN.finditer(text):
        word = match[0]
        left = word.lstrip(_EDGE)
        core = left.rstrip(_EDGE)
        if not core:
            left = core = word
        start = match.start() + len(word) - len(left)
        end = start + len(core)
        digits = _NO_DIGIT.sub("", core)
        while at < len(reached) and reached[at][1] <= start and all(one[1] <= start for one in reached[at : at + 4]):
            at += 1
        own = next((kind for begin, stop, kind in reached[at : at + 8] if begin < end and stop > start), 0)
        place = len(bounds)
        bounds.append((start, end))
        features.append(_features(core, digits))
        label.append(own)
        words.append((match.start(), match.end()))
        if place and not text[words[place - 1][1] : match.start()].strip(SPACES):
            links.append((place - 1, place, 0))
        seen = set()
        for key in _keys(core, digits):
            before = last.get(key)
            if before is not None and before not in seen:
                links.append((before, place, key[0]))
                seen.add(before)
            last[key] = place
    if not bounds:
        return None
    beside = np.ones((len(bounds), 2))
    link = np.array(links, np.int64).reshape(-1, 3)
    chain = link[link[:, 2] == 0]
    beside[chain[:, 1], 0] = 0
    beside[chain[:, 0], 1] = 0
    return Tokens(bounds, np.array(features, np.uint8), beside, np.array(label, np.int64), link)


def joined(parts: Sequence[Tokens]) -> tuple[np.ndarray, ...]:
    """Features, plain neighbours, labels and links of several texts as one graph."""
    counts = np.array([len(part.bounds) for part in parts])
    begin = np.repeat(np.cumsum(counts) - counts, [len(part.links) for part in parts])
    links = np.concatenate([part.links for part in parts])
    links[:, :2] += begin[:, None]
    return (
        np.concatenate([part.features for part in parts]).astype(np.float64),
        np.concatenate([part.plain for part in parts]),
        np.concatenate([part.label for part in parts]),
        links,
    )


_LABELS = len(KINDS) + 1
_KINDS_AGREE = np.diag([0.0] + [1.0] * len(KINDS))
_PLAIN_AGREE = np.diag([1.0] + [0.0] * len(KINDS))


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis))


class Field:
    """Weights of a skip-chain field: features by label, neighbours by pair of labels, agreement along skip links."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = self.prior() if weights is None else weights

    @staticmethod
    def prior() -> np.ndarray:
        """No preference but the agreement of repeated and of similar tokens on a kind."""
        out = np.zeros(FEATURES * _LABELS + _LABELS * _LABELS + 4)
        out[[-4, -2]] = AGREEMENT
        return out

    def split(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        unary = self.weights[: FEATURES * _LABELS].reshape(FEATURES, _LABELS)
        pairs = self.weights[FEATURES * _LABELS : -4].reshape(_LABELS, _LABELS)
        return unary, pairs, self.weights[-4:].reshape(2, 2)

    def potentials(self, features: np.ndarray, plain: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log potentials of tokens and of links. Beside a token, every other word has the label of no entity."""
        unary, pairs, skip = self.split()
        own = features @ unary + plain @ np.stack([pairs[0], pairs[:, 0]])
        types = np.stack([pairs, *(one[0] * _KINDS_AGREE + one[1] * _PLAIN_AGREE for one in skip)])
        return own, types[links[:, 2]]

    def marginals(
        self, own: np.ndarray, between: np.ndarray, links: np.ndarray, rounds: int = ROUNDS, messages: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of tokens and of links by loopy message passing, and the messages.

        All messages of a round go at once and are damped by half. The number of rounds is fixed, so a document's
        result does not depend on those that go through with it. Without loops, as many rounds as the
        longest path make the marginals exact.
        """
        first, second = links[:, 0], links[:, 1]
        sent = np.zeros((2, len(links), _LABELS)) if messages is None else messages

        def total() -> np.ndarray:
            belief = own.copy()
            for label in range(_LABELS):
                belief[:, label] += np.bincount(second, sent[0, :, label], len(own))
                belief[:, label] += np.bincount(first, sent[1, :, label], len(own))
            return belief

        for _ in range(rounds if len(links) else 0):
            belief = total()
            ahead = _log_sum((belief[first] - sent[1])[:, :, None] + between, 1)
            back = _log_sum((belief[second] - sent[0])[:, None, :] + between, 2)
            fresh = np.stack([ahead, back])
            fresh -= _log_sum(fresh, 2)[:, :, None]
            sent = 0.5 * sent + 0.5 * fresh
        belief = total()
        chance = np.exp(belief - _log_sum(belief, 1)[:, None])
        both = (belief[first] - sent[1])[:, :, None] + between + (belief[second] - sent[0])[:, None, :]
        flat = both.reshape(len(links), _LABELS * _LABELS)
        pair = np.exp(flat - _log_sum(flat, 1)[:, None]).reshape(both.shape)
        return chance, pair, sent


def fit(graph: tuple[np.ndarray, ...], steps: int = 150, ridge: float = 0.3) -> Field:
    """Weights by gradient ascent: what the labels show minus what the field expects, with a ridge; agreement stays."""
    features, plain, label, links = graph
    field = Field()
    truth = np.eye(_LABELS)[label]

    def statistics(chance: np.ndarray, pair: np.ndarray) -> np.ndarray:
        pairs = pair[links[:, 2] == 0].sum(0)
        pairs[0] += plain[:, 0] @ chance
        pairs[:, 0] += plain[:, 1] @ chance
        return np.concatenate([(features.T @ chance).ravel(), pairs.ravel()])

    shown = statistics(truth, truth[links[:, 0]][:, :, None] * truth[links[:, 1]][:, None, :])
    mean = square = np.zeros_like(shown)
    messages = None
    for step in range(1, steps + 1):
        own, between = field.potentials(features, plain, links)
        chance, pair, messages = field.marginals(own, between, links, 4, messages)
        slope = (shown - statistics(chance, pair) - ridge * field.weights[:-4]) / max(1, len(label))
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        field.weights[:-4] += 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return field


def train(documents: DataFrame, most: int = MAX_TRAINING) -> Field:
    """A field fitted on a bounded sample, labelled by the patterns; the prior if it has no token."""
    count = documents.count()
    share = min(1.0, 1.2 * most / max(1, count))
    sample = (
        documents.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
        .select("doc_id", "text")
        .orderBy(F.xxhash64("doc_id"), "doc_id", F.md5("text"))
        .limit(most)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [found for text in batch.column("text").to_pylist() if (found := tokens(text, patterns(text)))]
            parts = [part for part in parts if len(part.bounds) <= MAX_TRAINING_TOKENS]
            columns = [
                pa.array([np.packbits(part.features).tobytes() for part in parts], pa.binary()),
                *(pa.array([getattr(part, name).tobytes() for part in parts], pa.binary()) for name in ("plain", "label", "links")),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["features", "plain", "label", "links"])

    found = sample.mapInArrow(run, "features binary, plain binary, label binary, links binary")
    parts = []
    for one in found.orderBy("features", "links", "label").toArrow().to_pylist():
        label = np.frombuffer(one["label"], np.int64)
        bits = np.unpackbits(np.frombuffer(one["features"], np.uint8), count=len(label) * FEATURES)
        links = np.frombuffer(one["links"], np.int64).reshape(-1, 3)
        parts.append(Tokens([()] * len(label), bits.reshape(-1, FEATURES), np.frombuffer(one["plain"], np.float64).reshape(-1, 2), label, links))
    return fit(joined(parts)) if parts else Field()


def added(field: Field, texts: Sequence[str], parts: Sequence[Tokens], spans: Sequence[Sequence[Span]], threshold: float) -> list[list[Span]]:
    """Spans of the tokens that no pattern found but the field labels; neighbours of one kind are one span if their digits fit it.

    Tokens within a base span are clamped to its kind, so links carry it to repeated and similar tokens.
    """
    features, plain, label, links = joined(parts)
    own, between = field.potentials(features, plain, links)
    clamped = label > 0
    own[clamped] = -50.0
    own[clamped, label[clamped]] = 0.0
    chance, _, _ = field.marginals(own, between, links)
    kind = chance[:, 1:].argmax(1)
    taken = (chance[np.arange(len(kind)), kind + 1] >= threshold) & ~clamped
    out, begin = [], 0
    for text, part, base in zip(texts, parts, spans, strict=True):
        more: list[Span] = []
        end_word = -2
        for place, (start, end) in enumerate(part.bounds):
            if not taken[begin + place]:
                continue
            own_kind = int(kind[begin + place])
            if (
                end_word == place - 1
                and more[-1][1] == own_kind
                and not text[more[-1][2] : start].strip(SPACES)
                and len(_NO_DIGIT.sub("", text[more[-1][0] : end])) <= _MOST_DIGITS[own_kind]
            ):
                more[-1] = (more[-1][0], own_kind, end)
            else:
                more.append((start, own_kind, end))
            end_word = place
        out.append(sorted([*base, *more]))
        begin += len(part.bounds)
    return out


def _results(field: Field, texts: Sequence[str], threshold: float) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text; tokens go through the field in groups of bounded size."""
    base = [patterns(text) for text in texts]
    whole: list[list[Span]] = [list(spans) for spans in base]
    held: list[int] = []
    parts: list[Tokens] = []
    for at, text in enumerate(texts):
        part = tokens(text, base[at])
        if part is not None and not (part.label > 0).all():
            held.append(at)
            parts.append(part)
        if parts and (at == len(texts) - 1 or sum(len(one.bounds) for one in parts) >= GROUP_TOKENS):
            found = added(field, [texts[i] for i in held], parts, [base[i] for i in held], threshold)
            for i, spans in zip(held, found, strict=True):
                whole[i] = spans
            held, parts = [], []
    return list(zip(base, whole, strict=True))


_SPANS = "array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"
_SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def find_personal_data(
    spark: SparkSession, documents: DataFrame, threshold: float = THRESHOLD, field: Field | None = None, keep_text: bool = False
) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end, base) of each document; with ``keep_text`` its text too.

    Spans are in the order of start, then of kind (email, ip, card, phone); they count code points, the end is
    exclusive. Base spans come from the patterns and always stay. The others are words with a digit or an at sign
    to which a skip-chain conditional random field gives a kind with at least the ``threshold``.

    The field labels each such word as none or one of the kinds, by the features of its shape; linked are
    neighbours, and each word with the one before that is equal, has the same last seven digits, or is the name or
    the domain of an address. Loopy message passing carries labels along the links, from the words in base spans,
    which are clamped, to what is repeated or written differently elsewhere in the document. Words without a digit
    and at sign are no entity and enter as labelled neighbours. Weights are fitted on about ``MAX_TRAINING``
    documents, chosen by a hash of the id and labelled by the patterns; or give a ``field``.

    Null texts are empty and have no spans. Rows of equal or null ids are found each by its own text; null ids are not
    fitted on. Other columns are ignored, whatever their names. Without rows, or without any such word, there is
    nothing to fit and base spans are all. No row is shuffled; a text is one row's work, in time linear in its length.
    """
    field = train(documents) if field is None else field
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            spans = [
                [{"kind": KINDS[one[1]], "start": one[0], "end": one[2], "base": one in base} for one in whole]
                for base, whole in ((set(base), whole) for base, whole in _results(field, texts, threshold))
            ]
            columns = [batch.column("doc_id"), pa.array(spans, _SPANS_ARROW), *([batch.column("text")] if keep_text else [])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "spans", *(["text"] if keep_text else [])])

    with session_settings(spark, BATCHES):
        found = documents.select("doc_id", "text").mapInArrow(
            run, f"doc_id {kind}, spans {_SPANS}" + (", text string" if keep_text else "")
        )
        return Scratch(spark, "personal").write(found)


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first counts."""
    state = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("reached"))

    def put(have: Column, span: Column) -> Column:
        between = F.substring(text, (have["reached"] + 1).cast("int"), (span["start"] - have["reached"]).cast("int"))
        more = F.struct(F.concat(have["done"], between, F.lit("<"), span["kind"], F.lit(">")).alias("done"), span["end"].alias("reached"))
        return F.when(span["start"] >= have["reached"], more).otherwise(have)

    return F.aggregate(
        spans, state, put, lambda have: F.concat(have["done"], F.substring(text, (have["reached"] + 1).cast("int"), F.length(text)))
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )
