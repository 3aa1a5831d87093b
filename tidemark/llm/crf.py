"""Document quality from lines: a linear-chain conditional random field over line features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import crc_fold, mix, powers, small_batches

#: Labelled documents of each class that the model is fitted on, in the order of md5(doc_id).
MAX_TRAINING = 1500
#: Labelled documents with more characters or lines are not fitted on; they are scored as all others.
MAX_TRAINING_CHARS, MAX_TRAINING_LINES = 100_000, 256
FEATURES = 14
_LETTER, _UPPER, _DIGIT, _SYMBOL, _STOP, _MARK, _SPACE = range(1, 8)
_KNOWN = 0x250


def _class_of(code: int) -> int:
    letter = chr(code)
    if letter.isspace() or code < 32:
        return _SPACE
    if letter.isupper():
        return _UPPER
    if letter.isalpha():
        return _LETTER
    if letter.isdigit():
        return _DIGIT
    if letter in "#*$%&|<>":
        return _SYMBOL
    return _STOP if letter in ".!?" else _MARK


#: Class of each code point below 0x250; all others count as letters.
_CLASSES = np.array([_class_of(code) for code in range(_KNOWN)] + [_LETTER], np.uint8)


def _line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and lengths of the lines of a text, all lines at once."""
    codes = np.frombuffer((text + "\n").encode("utf-32-le"), np.uint32)
    classes = _CLASSES[np.minimum(codes, _KNOWN)]
    breaks = np.flatnonzero(codes == 10)
    starts = np.concatenate(([0], breaks[:-1] + 1))
    length = (breaks - starts).astype(np.float64)
    count = {kind: np.add.reduceat((classes == kind).astype(np.int32), starts) for kind in range(1, 8)}
    space = classes == _SPACE
    before = np.concatenate(([True], space[:-1]))
    begin = np.flatnonzero(~space & before)
    end = np.flatnonzero(~space & np.concatenate((space[1:], [True])))
    lines = len(starts)
    line = np.searchsorted(breaks, begin)
    words = np.bincount(line, minlength=lines).astype(np.float64)
    some = np.maximum(words, 1)
    if len(begin):
        stretch = np.diff(np.append(begin, len(codes)))
        skipped = codes[begin[0] :]
        place = np.arange(len(skipped)) - np.repeat(begin - begin[0], stretch)
        value = np.where(space[begin[0] :], 0, skipped).astype(np.uint64) * powers(int(stretch.max()) + 1)[place + 1]
        hashes = mix(np.add.reduceat(value, begin - begin[0]))
        again = np.concatenate(([False], (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])))
        order = np.lexsort((hashes, line))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line[order][1:] != line[order][:-1])
        distinct = np.bincount(line[order], weights=fresh, minlength=lines)
        adjacent = np.bincount(line, weights=again, minlength=lines)
        by_symbol = np.bincount(line, weights=classes[end] == _SYMBOL, minlength=lines)
        by_call = np.bincount(line, weights=codes[end] == 33, minlength=lines)
        alone = np.bincount(line, weights=(begin == end) & (classes[begin] == _SYMBOL), minlength=lines)
    else:
        distinct = adjacent = by_symbol = by_call = alone = np.zeros(lines)
    filled = np.maximum(length, 1)
    letters = count[_LETTER] + count[_UPPER]
    last = classes[np.maximum(breaks - 1, 0)]
    features = np.column_stack([
        np.log1p(length) / 5,
        np.log1p(words) / 4,
        (length - (count[_SPACE] - 1)) / some / 8,
        count[_UPPER] / np.maximum(letters, 1),
        count[_SYMBOL] / filled,
        count[_DIGIT] / filled,
        (count[_MARK] + count[_STOP]) / filled,
        distinct / some,
        adjacent / some,
        by_symbol / some,
        by_call / some,
        alone / some,
        words == 0,
        (last == _STOP) & (length > 0),
    ]).astype(np.float32)
    return features, length


def line_features(text: str, most_chars: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Like ``_line_features``; a very long text is cut at line ends, which changes no feature."""
    if len(text) <= most_chars:
        return _line_features(text)
    parts, begin = [], 0
    while begin <= len(text):
        end = text.find("\n", min(len(text), begin + most_chars))
        end = len(text) if end < 0 else end
        parts.append(_line_features(text[begin:end]))
        begin = end + 1
    return np.concatenate([part[0] for part in parts]), np.concatenate([part[1] for part in parts])


def in_context(features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each line's features with those of the lines before and after it in its document, and a constant."""
    first = np.zeros(len(features), bool)
    last = np.zeros(len(features), bool)
    ends = np.cumsum(counts)
    first[ends - counts] = True
    last[ends - 1] = True
    before = np.roll(features, 1, axis=0)
    after = np.roll(features, -1, axis=0)
    before[first] = 0
    after[last] = 0
    return np.column_stack([features, before, after, first, last, np.ones(len(features), np.float32)])


def forward_backward(emission: np.ndarray, transition: np.ndarray, counts: np.ndarray):
    """Probability that each line is good, and the expected transitions of all chains together.

    ``emission`` is the logit of good for each line, ``transition`` the 2 x 2 log weights from a line's
    label to the next one's. Chains of any lengths step together, the longest first.
    """
    begins = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    begins, counts = begins[order], counts[order]
    good = 1 / (1 + np.exp(-np.clip(emission, -30, 30)))
    local = np.column_stack([1 - good, good])
    weights = np.exp(transition - transition.max())
    steps = int(counts[0])
    active = np.searchsorted(-counts, -np.arange(steps), side="left")
    forward = np.empty_like(local)
    for t in range(steps):
        rows = begins[: active[t]] + t
        value = local[rows] * (forward[rows - 1] @ weights) if t else local[rows]
        forward[rows] = value / value.sum(1, keepdims=True)
    backward = np.ones_like(local)
    expected = np.zeros((2, 2))
    for t in range(steps - 1, 0, -1):
        rows = begins[: active[t]] + t
        ahead = local[rows] * backward[rows]
        value = ahead @ weights.T
        backward[rows - 1] = value / value.sum(1, keepdims=True)
        both = forward[rows - 1][:, :, None] * weights * ahead[:, None, :]
        expected += (both / both.sum((1, 2), keepdims=True)).sum(0)
    posterior = forward * backward
    return posterior[:, 1] / posterior.sum(1), expected


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    transition: np.ndarray
    calibration: tuple[float, float]

    def marginals(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        inputs = (in_context(features, counts) - self.center) / self.scale
        return forward_backward(inputs @ self.weights, self.transition, counts)[0]

    def scores(self, marginals: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        slope, offset = self.calibration
        return 1 / (1 + np.exp(-(slope * raw_quality(marginals, lengths, counts) + offset)))


def raw_quality(marginals: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Logit of the length-weighted mean of a document's line marginals."""
    starts = np.cumsum(counts) - counts
    mass = lengths + 1
    mean = np.add.reduceat(marginals * mass, starts) / np.add.reduceat(mass, starts)
    mean = np.clip(mean, 1e-4, 1 - 1e-4)
    return np.log(mean / (1 - mean))


def fit(
    features: np.ndarray, lengths: np.ndarray, counts: np.ndarray, labels: np.ndarray, prior: float, rounds: int = 150
) -> Model:
    """Fit by gradient ascent; the lines of a document take its label. ``prior`` is the share of label 1."""
    inputs = in_context(features, counts)
    center, scale = inputs.mean(0), inputs.std(0)
    constant = scale < 1e-6
    center[constant], scale[constant] = 0, 1
    inputs = ((inputs - center) / scale).astype(np.float64)
    truth = np.repeat(labels, counts).astype(np.float64)
    share = np.repeat(1 / counts, counts)  # every document weighs the same in the emissions
    kept = np.bincount(2 * labels + labels, weights=counts - 1, minlength=4).reshape(2, 2)
    parameters = np.zeros(inputs.shape[1] + 4)
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, rounds + 1):
        weights, transition = parameters[:-4], parameters[-4:].reshape(2, 2)
        marginals, expected = forward_backward(inputs @ weights, transition, counts)
        slope = np.concatenate([
            inputs.T @ ((truth - marginals) * share) / len(counts) - 1e-3 * weights,
            ((kept - expected) / max(1, counts.sum())).ravel() - 1e-2 * parameters[-4:],
        ])
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        parameters += 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights, transition = parameters[:-4], parameters[-4:].reshape(2, 2)
    marginals, _ = forward_backward(inputs @ weights, transition, counts)
    mass = np.where(labels == 1, prior / max(1, (labels == 1).sum()), (1 - prior) / max(1, (labels == 0).sum()))
    calibration = logistic(raw_quality(marginals, lengths, counts)[:, None], labels, mass)
    return Model(center, scale, weights, transition, (float(calibration[0]), float(calibration[1])))


def logistic(inputs: np.ndarray, labels: np.ndarray, mass: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights and constant of a weighted logistic regression, by Newton steps."""
    inputs = np.column_stack([inputs, np.ones(len(inputs))])
    mass = mass / mass.sum()
    found = np.zeros(inputs.shape[1])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ found, -30, 30)))
        slope = inputs.T @ (mass * (labels - chance)) - ridge * found
        curve = (inputs * (mass * chance * (1 - chance))[:, None]).T @ inputs + ridge * np.eye(len(found))
        found = found + np.clip(np.linalg.solve(curve, slope), -5, 5)
    return found


def training_rows(
    documents: DataFrame, labels: DataFrame, label: str, modulus: int, fold: int, per_class: dict[int, int], max_chars: int
) -> tuple[DataFrame, dict[int, int]]:
    """Texts of a bounded sample of the labelled rows outside the held-out fold, and all rows by class.

    Of repeated ids the smallest label and text are taken. Ids are taken in the order of their md5.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~crc_fold("doc_id", modulus, fold))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
    )
    totals = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    order = [F.md5(F.col("doc_id").cast("string").cast("binary")), F.col("doc_id")]
    chosen = None
    for value, most in per_class.items():
        part = known.filter(F.col("label") == value).orderBy(*order).limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = (
        documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .filter(F.length("text") <= max_chars)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )
    return texts, totals


def train(documents: DataFrame, labels: DataFrame) -> Model | float:
    """A model, or the share of label 1 (0.5 without any label) where a class has no training text."""
    texts, totals = training_rows(
        documents, labels, "quality", 3, 1, {0: MAX_TRAINING, 1: MAX_TRAINING}, MAX_TRAINING_CHARS
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [line_features(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "label": batch.column("label"),
                "features": pa.array([part[0].tobytes() for part in found], pa.binary()),
                "lengths": pa.array([part[1].tobytes() for part in found], pa.binary()),
            })

    kind = dict(texts.dtypes)["doc_id"]
    rows = texts.mapInArrow(run, f"doc_id {kind}, label int, features binary, lengths binary")
    rows = rows.filter(F.length("lengths") <= 8 * MAX_TRAINING_LINES).orderBy("doc_id").toArrow().to_pydict()
    target = np.array(rows["label"], np.int64)
    prior = totals.get(1, 0) / max(1, sum(totals.values())) if totals else 0.5
    if len(set(rows["label"])) < 2:
        return prior
    lengths = [np.frombuffer(data, np.float64) for data in rows["lengths"]]
    features = np.concatenate([np.frombuffer(data, np.float32).reshape(-1, FEATURES) for data in rows["features"]])
    return fit(features, np.concatenate(lengths), np.array([len(part) for part in lengths]), target, prior)


def _documents(texts: Sequence[str | None], group_lines: int = 20_000) -> Iterator[tuple]:
    """Features of texts, in groups of about ``group_lines`` lines."""
    held, lines = [], 0
    for place, text in enumerate(texts):
        held.append(line_features(text or ""))
        lines += len(held[-1][1])
        if lines >= group_lines or place == len(texts) - 1:
            counts = np.array([len(part[1]) for part in held])
            yield np.concatenate([part[0] for part in held]), np.concatenate([part[1] for part in held]), counts
            held, lines = [], 0


def quality_scores(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_lines, n_bad_lines for each document.

    ``score`` is the calibrated, length-weighted mean of the line marginals: the chance of label 1. Null
    texts count as empty and have one empty line. Rows with null or equal ids are scored each on its own;
    null ids are not held out. With labels of one class only, every score is that class's share; with
    none it is 0.5. Only ``doc_id`` and ``text`` are read. No row is shuffled.
    """
    small_batches(spark)
    model = train(documents, labels)
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, n_lines, n_bad = [], [], []
            for features, lengths, counts in _documents(batch.column("text").to_pylist()):
                starts = np.cumsum(counts) - counts
                if isinstance(model, float):
                    good, chance = np.full(len(lengths), model), np.full(len(counts), model)
                else:
                    good = model.marginals(features, counts)
                    chance = model.scores(good, lengths, counts)
                score.append(chance)
                n_lines.append(counts)
                n_bad.append(np.add.reduceat((good < 0.5).astype(np.int64), starts))
            score = np.concatenate(score) if score else np.empty(0)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": pa.array(score, pa.float64()), "predicted": pa.array(score >= 0.5).cast(pa.int32()),
                "n_lines": pa.array(np.concatenate(n_lines) if n_lines else [], pa.int64()),
                "n_bad_lines": pa.array(np.concatenate(n_bad) if n_bad else [], pa.int64()),
            })

    return documents.select("doc_id", crc_fold("doc_id", 3, 1).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int, n_lines bigint, n_bad_lines bigint"
    )


def line_labels(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, line (from 0), n_chars, good (marginal) and label for every line of every document."""
    small_batches(spark)
    model = train(documents, labels)
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, done = batch.column("doc_id").to_pylist(), 0
            for features, lengths, counts in _documents(batch.column("text").to_pylist()):
                good = np.full(len(lengths), model) if isinstance(model, float) else model.marginals(features, counts)
                own = [doc_id for doc_id, n in zip(ids[done : done + len(counts)], counts, strict=True) for _ in range(n)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(own, batch.schema.field("doc_id").type),
                    "line": pa.array(np.concatenate([np.arange(n) for n in counts]), pa.int64()),
                    "n_chars": pa.array(lengths.astype(np.int64)), "good": pa.array(good, pa.float64()),
                    "label": pa.array(np.where(good >= 0.5, "good", "bad").tolist(), pa.string()),
                })
                done += len(counts)

    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, line bigint, n_chars bigint, good double, label string"
    )
