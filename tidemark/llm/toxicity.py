"""Toxicity by nearest labelled examples: exact TF-IDF cosine through a block-max inverted index of all their terms."""

from __future__ import annotations

import itertools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import newest
from tidemark.llm.common import crc_fold, hash_words, small_batches
from tidemark.llm.crf import logistic, training_rows
from tidemark.session import session_settings

#: Labelled examples of the index by class, in the order of md5(doc_id), and their longest text.
MAX_TOXIC, MAX_CLEAN, MAX_TRAINING_CHARS = 2000, 4000, 20_000
NEIGHBOURS = 15
#: Examples are put beside like ones by their terms in more than one of so many examples.
LIKE_SHARE = 32
#: Terms in more than one of so many examples are multiplied block by block, the others go through postings.
HEAD_SHARE = 16
#: Examples of a block, and groups of like examples that blocks are cut from.
BLOCK, CLUSTERS = 64, 16
#: Blocks of the highest bounds that give a text its first threshold.
FIRST_BLOCKS = 2
#: Texts that are compared with the examples at once, and letters of a group of texts.
GROUP, GROUP_CHARS = 256, 1 << 21
#: Texts whose postings are multiplied at once.
STRETCH = 32
#: Words that a process remembers the terms of.
KNOWN_WORDS = 300_000
_WORD, _OTHER = re.compile(r"\w+"), re.compile(r"\W+")
#: Latin-1 with a space for what is no part of a word.
_LATIN = bytes(code if _WORD.match(chr(code)) else 32 for code in range(256))


def terms_of(word: str) -> tuple[str, ...]:
    """A word stands for itself and for its first four and five letters."""
    return (word, "^" + word[:4], "^" + word[:5]) if len(word) > 4 else (word,)


def term_counts(text: str) -> Counter:
    counts: Counter = Counter()
    for word, times in Counter(_WORD.findall(text.lower())).items():
        for term in terms_of(word):
            counts[term] += times
    return counts


def word_lists(texts: Sequence[str]) -> pa.ListArray:
    """The words of each lower-cased text; null without any. All else becomes a space first, which is cheap in Latin-1."""
    out = []
    for text in texts:
        text = text.lower()
        try:
            text = text.encode("latin-1").translate(_LATIN).decode("latin-1")
        except UnicodeEncodeError:
            text = _OTHER.sub(" ", text)
        out.append(text.strip() or None)
    return pc.ascii_split_whitespace(pa.array(out, pa.string()))


class Terms:
    """Terms of texts as hashes, or as their places among known hashes; a process remembers words, up to a bound."""

    def __init__(self, hashes: np.ndarray | None = None):
        self.hashes = hashes
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = defaultdict(itertools.count().__next__)
        self.begins, self.terms = np.zeros(1, np.int64), np.empty(0, np.uint64 if self.hashes is None else np.int64)

    def _learn(self) -> None:
        fresh = newest(self.number, len(self.number) - len(self.begins) + 1)
        if not fresh:
            return
        words = pa.array(fresh, pa.string())
        long = np.flatnonzero(pc.greater(pc.utf8_length(words), 4).to_numpy(zero_copy_only=False))
        sizes = np.ones(len(fresh), np.int64)
        sizes[long] = 3
        begins = np.cumsum(sizes) - sizes
        found = np.empty(int(sizes.sum()), np.uint64)
        found[begins] = hash_words([word.encode("utf-8") for word in fresh])
        for place, letters in enumerate((4, 5), 1):  # as in ``terms_of``; few words begin differently
            starts = pc.utf8_slice_codeunits(words.take(pa.array(long)), 0, letters).dictionary_encode()
            hashes = hash_words([b"^" + start.encode("utf-8") for start in starts.dictionary.to_pylist()])
            found[begins[long] + place] = hashes[starts.indices.to_numpy()]
        if self.hashes is not None:
            place = np.searchsorted(self.hashes, found)
            place[place == len(self.hashes)] = 0
            known = self.hashes[place] == found if len(self.hashes) else np.zeros(len(found), bool)
            sizes = np.add.reduceat(known.astype(np.int64), np.cumsum(sizes) - sizes)
            found = place[known]
        self.terms = np.concatenate((self.terms, found))
        self.begins = np.concatenate((self.begins, self.begins[-1] + np.cumsum(sizes)))

    def counts(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, times) of a group of texts, by text and term."""
        if len(self.number) > KNOWN_WORDS:
            self._forget()
        lists = word_lists(texts)
        found = lists.flatten().dictionary_encode()
        words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self._learn()
        own = np.repeat(np.arange(len(texts)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
        both, times = np.unique(own * len(words) + found.indices.to_numpy(), return_counts=True)
        own, word = np.divmod(both, max(1, len(words)))
        word = number[word]
        sizes = self.begins[word + 1] - self.begins[word]
        term = self.terms[_runs(self.begins[word], sizes)]
        own, times = np.repeat(own, sizes), np.repeat(times, sizes)
        if not len(term):
            return own, term, times
        if self.hashes is not None:  # one number for text and place sorts faster than the two
            order = np.argsort(own * len(self.hashes) + term)
        else:
            order = np.lexsort((term, own))
        own, term, times = own[order], term[order], times[order]
        first = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (own[1:] != own[:-1]))))
        return own[first], term[first], np.add.reduceat(times, first)


def _groups(texts: Sequence[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Texts in groups of bounded number and length, each with its begin."""
    begin, chars = 0, 0
    for at, text in enumerate(texts):
        chars += len(text or "")
        if at + 1 - begin >= GROUP or chars >= GROUP_CHARS or at + 1 == len(texts):
            yield begin, [one or "" for one in texts[begin : at + 1]]
            begin, chars = at + 1, 0


def _runs(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``begins``, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def gains(own: np.ndarray, term: np.ndarray, labels: np.ndarray, n_terms: int) -> np.ndarray:
    """Log-likelihood ratio of label and presence of each term among the examples."""
    seen = np.stack([np.bincount(term[labels[own] == label], minlength=n_terms) for label in (0, 1)]).astype(float)
    sizes = np.array([(labels != 1).sum(), (labels == 1).sum()])
    here, total = seen.sum(0), int(sizes.sum())
    gain = np.zeros(n_terms)
    for part_of, size in zip(seen, sizes.tolist(), strict=True):
        for part, margin in ((part_of, here), (size - part_of, total - here)):
            some = part > 0
            gain[some] += 2 * part[some] * np.log(part[some] * total / (margin[some] * size))
    return np.maximum(gain, 0)


@dataclass
class Index:
    """Unit vectors of the examples, in blocks of like ones, as inverted lists with the blocks' greatest values.

    A term of many examples (head) is held by block, with its greatest value in each; the others (tail) have postings.
    The greatest values bound the product of a text with every example of a block: a block whose bound is below the
    text's last neighbour so far is skipped, for that text. Products in single precision only choose candidates,
    by a margin for their rounding; cosines are sums in double precision. So the neighbours are exact.
    """

    weights: np.ndarray
    labels: np.ndarray
    ids: list
    starts: np.ndarray
    rows: np.ndarray
    values: np.ndarray
    calibration: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name[0] != "_"}

    @classmethod
    def build(cls, own: np.ndarray, term: np.ndarray, times: np.ndarray, labels: np.ndarray, ids: list, weights: np.ndarray) -> Index:
        """An index of examples given as (example, term, times), in this order, with a weight for each term."""
        count = len(labels)
        values = unit_values(own, (1 + np.log(times)) * weights[term], count)
        order = _like_together(own, term, values, count, len(weights))
        sizes = np.bincount(own, minlength=count)
        begins = np.cumsum(sizes) - sizes
        at = _runs(begins[order], sizes[order])
        starts = np.concatenate(([0], np.cumsum(sizes[order])))
        return cls(weights, labels[order], [ids[place] for place in order], starts, term[at].astype(np.int32), values[at])

    def _open(self) -> None:
        """Blocks of the head, their greatest values and postings of the tail, made once in each process."""
        count = len(self.labels)
        self._blocks = -(-count // BLOCK)
        place = np.repeat(np.arange(count), np.diff(self.starts))
        common = np.bincount(self.rows, minlength=len(self.weights)) * HEAD_SHARE > count
        self._column = np.where(common, np.cumsum(common) - 1, -1)
        head = common[self.rows]
        self._head = np.zeros((self._blocks, BLOCK, int(common.sum())), np.float32)
        self._head.reshape(self._blocks * BLOCK, -1)[place[head], self._column[self.rows[head]]] = self.values[head]
        self._greatest = np.ascontiguousarray(self._head.max(1).T)
        by_term = np.argsort(self.rows[~head], kind="stable")
        self._places = place[~head][by_term].astype(np.int32)
        self._weights = self.values[~head][by_term].astype(np.float32)
        tail = np.bincount(self.rows[~head], minlength=len(self.weights))
        self._begins = np.concatenate(([0], np.cumsum(tail)))
        self._query = np.zeros(len(self.weights))
        self.scanned = np.zeros(2, np.int64)

    def nearest_of(
        self, own: np.ndarray, rows: np.ndarray, values: np.ndarray, count: int, skips: Sequence[int] | None = None
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Places and cosines of the nearest examples of each of ``count`` texts with a positive cosine, nearest first.

        The texts are unit vectors (text, term, value). ``skips`` names an example for each that is not to be found.
        """
        if not hasattr(self, "_head"):
            self._open()
        width = self._blocks * BLOCK
        columns = self._column[rows]
        head = columns >= 0
        dense = np.zeros((count, self._head.shape[2]), np.float32)
        dense[own[head], columns[head]] = values[head]
        begins, lengths = self._begins[rows[~head]], self._begins[rows[~head] + 1] - self._begins[rows[~head]]
        rare = values[~head].astype(np.float32)
        edges = np.searchsorted(own[~head], np.arange(count + 1))
        rough = np.empty((count, width), np.float32)
        for text in range(0, count, STRETCH):  # a few rows at a time stay in the cache
            stop = min(text + STRETCH, count)
            part = slice(edges[text], edges[stop])
            at = _runs(begins[part], lengths[part])
            places, products = self._places[at], np.repeat(rare[part], lengths[part]) * self._weights[at]
            ends = np.concatenate(([0], np.cumsum(lengths[part])))[edges[text : stop + 1] - edges[text]]
            for row, begin, end in zip(range(text, stop), ends[:-1], ends[1:], strict=True):
                rough[row] = np.bincount(places[begin:end], products[begin:end], width)
        rough = rough.reshape(count, self._blocks, BLOCK)
        # no product is negative, so rounding changes a sum by at most this share of it, one way or the other
        margin = 4 * (self._head.shape[2] + 4) * 2.0**-24
        bound = (dense @ self._greatest + rough.max(2)) * (1 + margin)
        done = np.zeros(bound.shape, bool)
        skip = np.full(count, -1) if skips is None else np.asarray(skips)

        def multiply(wanted: np.ndarray) -> None:
            for block in np.flatnonzero(wanted.any(0)):
                who = np.flatnonzero(wanted[:, block])
                if 2 * len(who) < count:
                    rough[who, block] += dense[who] @ self._head[block].T
                else:  # cheaper than copies of the texts; the others' products are not looked at
                    rough[:, block] += np.where(wanted[:, block, None], dense @ self._head[block].T, 0)
            done[wanted] = True
            who = np.flatnonzero(skip >= 0)
            rough[who, skip[who] // BLOCK, skip[who] % BLOCK] = 0

        first = min(FIRST_BLOCKS, self._blocks)
        chosen = np.argpartition(-bound, first - 1, axis=1)[:, :first]
        wanted = np.zeros(bound.shape, bool)
        np.put_along_axis(wanted, chosen, True, axis=1)
        multiply(wanted)
        last = self._last(np.take_along_axis(rough, chosen[:, :, None], axis=1).reshape(count, -1)) * (1 - margin)
        multiply(~done & (bound > 0) & (bound >= last[:, None]))
        self.scanned += (int(done.sum()), done.size)
        # of the examples above the first threshold, those that may be among the nearest of all
        rough[~done] = 0
        rough = rough.reshape(count, width)
        text, found = np.nonzero(rough >= np.maximum(last, 1e-30)[:, None])
        about = rough[text, found]
        order = np.lexsort((-about, text))
        text, found, about = text[order], found[order], about[order]
        edges = np.searchsorted(text, np.arange(count + 1))
        least = np.zeros(count)
        full = np.diff(edges) >= NEIGHBOURS
        least[full] = about[edges[:-1][full] + NEIGHBOURS - 1] * (1 - margin)
        kept = about >= least[text]
        found, edges = found[kept], np.searchsorted(text[kept], np.arange(count + 1))
        parts = np.searchsorted(own, np.arange(count + 1))
        lengths = self.starts[found + 1] - self.starts[found]
        out = []
        for at in range(count):
            near = found[edges[at] : edges[at + 1]]
            if not len(near):
                out.append((near, np.empty(0)))
                continue
            part, sizes = slice(parts[at], parts[at + 1]), lengths[edges[at] : edges[at + 1]]
            cells = _runs(self.starts[near], sizes)
            self._query[rows[part]] = values[part]
            cosines = np.add.reduceat(self.values[cells] * self._query[self.rows[cells]], np.cumsum(sizes) - sizes)
            self._query[rows[part]] = 0
            order = np.lexsort((near, -cosines))[:NEIGHBOURS]
            out.append((near[order], cosines[order]))
        return out

    @staticmethod
    def _last(products: np.ndarray) -> np.ndarray:
        """The product of the last neighbour of each text."""
        if products.shape[1] <= NEIGHBOURS:
            return np.zeros(len(products))
        return np.partition(products, -NEIGHBOURS, axis=1)[:, -NEIGHBOURS].astype(np.float64)

    def votes(self, found: np.ndarray, cosines: np.ndarray) -> tuple[float, float, float, float]:
        """Share of toxic votes, toxic and clean votes, each example weighed by its cosine, and the nearest cosine."""
        if not len(found):
            return 0.0, 0.0, 0.0, 0.0
        toxic, both = float(cosines @ self.labels[found]), float(cosines.sum())
        return toxic / both, toxic, both - toxic, float(cosines[0])

    def judge(self, own: np.ndarray, term: np.ndarray, times: np.ndarray, count: int) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """Score of each text, with the places and cosines of its nearest examples."""
        values = unit_values(own, (1 + np.log(times)) * self.weights[term], count)
        near = self.nearest_of(own, term, values, count)
        inputs = np.array([[*self.votes(*one), 1.0] for one in near]).reshape(count, 5)
        scores = 1 / (1 + np.exp(-np.clip(inputs @ self.calibration, -30, 30)))
        yield from zip(scores.tolist(), *zip(*near, strict=True), strict=True) if near else ()


def unit_values(own: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    norm = np.sqrt(np.bincount(own, values * values, count))
    return values / np.where(norm > 0, norm, 1)[own]


def _like_together(own: np.ndarray, term: np.ndarray, values: np.ndarray, count: int, n_terms: int, rounds: int = 6) -> np.ndarray:
    """An order of the examples in which like ones follow each other, by k-means over the terms of many examples.

    It has no part in the result, only in how tight the bounds of the blocks are.
    """
    seen = np.bincount(term, minlength=n_terms)
    common = seen * LIKE_SHARE > count
    column = np.cumsum(common) - 1
    head = common[term]
    points = np.zeros((count, int(common.sum())), np.float32)
    points[own[head], column[term[head]]] = values[head]
    if count <= CLUSTERS or not points.shape[1]:
        return np.arange(count)
    centres = points[np.linspace(0, count - 1, CLUSTERS).astype(int)]
    for _ in range(rounds):
        likeness = points @ centres.T
        nearest = likeness.argmax(1)
        centres = np.stack([points[nearest == at].sum(0) if (nearest == at).any() else centres[at] for at in range(CLUSTERS)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return np.lexsort((-likeness.max(1), nearest))


def document_frequencies(documents: DataFrame, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """Documents that have each term, over all documents, and all documents."""
    shared = documents.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, sums, seen = known_terms(shared.value), np.zeros(len(shared.value) + 1, np.int64), 0
        for batch in batches:
            for _, group in _groups(batch.column(0).to_pylist()):
                sums[:-1] += np.bincount(terms.counts(group)[1], minlength=len(sums) - 1)
                seen += len(group)
        sums[-1] = seen
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"row": pa.array(some, pa.int64()), "n": pa.array(sums[some], pa.int64())})

    found = documents.select("text").mapInArrow(run, "row bigint, n bigint").groupBy("row").agg(F.sum("n").alias("n"))
    sums = np.zeros(len(hashes) + 1, np.int64)
    table = found.toArrow()
    sums[table.column("row").to_numpy()] = table.column("n").to_numpy()
    shared.unpersist()
    return sums[:-1], int(sums[-1])


_known: tuple[bytes, Terms] | None = None


def known_terms(hashes: np.ndarray) -> Terms:
    """The terms of this process: tasks that a worker runs one after the other share what it remembers."""
    global _known
    key = hashes[:64].tobytes() + len(hashes).to_bytes(8, "little") + hashes[-64:].tobytes()
    if _known is None or _known[0] != key:
        _known = key, Terms(hashes)
    return _known[1]


def _examples(texts: DataFrame) -> pa.Table:
    """doc_id, label, terms (hashes) and times of the examples: a few numbers for each word, never the texts."""
    kind = dict(texts.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            for begin, group in _groups(batch.column("text").to_pylist()):
                own, term, times = terms.counts(group)
                edges = np.searchsorted(own, np.arange(len(group) + 1)).tolist()
                parts = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(begin, len(group)), "label": batch.column("label").slice(begin, len(group)),
                    "terms": pa.array([term[part].tobytes() for part in parts], pa.binary()),
                    "times": pa.array([np.minimum(times[part], 65535).astype("<u2").tobytes() for part in parts], pa.binary()),
                })

    found = texts.mapInArrow(run, f"doc_id {kind}, label int, terms binary, times binary")
    return found.orderBy("doc_id").toArrow()


def train(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Index] | float:
    """Hashes of the terms and the index, or the share of label 1 (0.5 without any label) where a class has no example.

    The driver gets the terms of the bounded examples as numbers. Frequencies are counted over all documents, and the
    votes that the score is calibrated on, each example without itself, are found by the cluster.
    """
    texts, totals = training_rows(
        documents, labels, "toxic", 4, 2, {1: MAX_TOXIC, 0: MAX_CLEAN}, MAX_TRAINING_CHARS
    )
    rows = _examples(texts)
    prior = totals.get(1, 0) / max(1, sum(totals.values())) if totals else 0.5
    label = rows.column("label").to_numpy().astype(np.int64)
    if len(np.unique(label)) < 2:
        return prior
    terms = [np.frombuffer(data.as_py(), np.uint64) for data in rows.column("terms")]
    times = np.concatenate([np.frombuffer(data.as_py(), "<u2") for data in rows.column("times")]).astype(np.int64)
    own = np.repeat(np.arange(len(terms)), list(map(len, terms)))
    hashes, place = np.unique(np.concatenate(terms), return_inverse=True)
    ids = rows.column("doc_id").to_pylist()
    del terms, rows
    if not len(hashes):
        return prior
    seen, total = document_frequencies(documents, hashes)
    idf = np.log((total + 1) / (seen + 1)) + 1e-3
    index = Index.build(own, place, times, label, ids, idf * (1 + np.sqrt(gains(own, place, label, len(hashes)))))
    votes = _votes_among(documents.sparkSession, index)
    mass = np.where(index.labels == 1, prior / (index.labels == 1).sum(), (1 - prior) / (index.labels != 1).sum())
    index.calibration = logistic(votes, index.labels, mass, ridge=1e-4)
    return hashes, index


def _votes_among(spark: SparkSession, index: Index) -> np.ndarray:
    """The votes of the other examples on each."""
    shared = spark.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            chosen = batch.column(0).to_numpy()
            lengths = index.starts[chosen + 1] - index.starts[chosen]
            at = _runs(index.starts[chosen], lengths)
            own = np.repeat(np.arange(len(chosen)), lengths)
            near = index.nearest_of(own, index.rows[at].astype(np.int64), index.values[at], len(chosen), chosen)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(0), "votes": pa.array([list(index.votes(*one)) for one in near], pa.list_(pa.float64())),
            })

    with session_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": GROUP}):
        found = spark.range(len(index.labels)).mapInArrow(run, "id bigint, votes array<double>").orderBy("id").toArrow()
    shared.unpersist()
    return np.array(found.column("votes").to_pylist())


def toxicity_scores(
    spark: SparkSession, documents: DataFrame, labels: DataFrame, keep_row: bool = False
) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (ids of the three nearest examples), nearest.

    Vectors are (1 + log tf) * idf over all terms of the examples, with idf from all documents, times a weight from
    the label: 1 + the root of the term's log-likelihood ratio with it among the examples. No term is left out.
    ``score`` is the chance of label 1, calibrated on the votes of the nearest examples; ``predicted`` is 1 from 0.3 on.
    A text without a term of any example, as an empty or null one, has no neighbour and takes the score of no votes.
    Rows with null or equal ids are scored each on its own; null ids are not held out. With labels of one class every
    score is that class's share, 0.5 with none. Only ``doc_id`` and ``text`` are read, or with ``keep_row`` all columns,
    which ``row`` then has beside the score. No row is shuffled.
    """
    small_batches(spark)
    model = train(documents, labels)
    kind = dict(documents.dtypes)["doc_id"]
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        constant = model if isinstance(model, float) else None
        hashes, index = (None, None) if constant is not None else model
        terms = None if constant is not None else known_terms(hashes)
        for batch in batches:
            score, evidence, nearest = [], [], []
            for _, group in _groups(batch.column("text").to_pylist()):
                if constant is not None:
                    score.extend([constant] * len(group))
                    evidence.extend([[]] * len(group))
                    nearest.extend([0.0] * len(group))
                    continue
                for value, found, cosines in index.judge(*terms.counts(group), len(group)):
                    score.append(value)
                    evidence.append([index.ids[at] for at in found[:3]])
                    nearest.append(float(cosines[0]) if len(cosines) else 0.0)
            id_type = batch.schema.field("doc_id").type
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": pa.array(score, pa.float64()), "predicted": pa.array([int(x >= 0.3) for x in score], pa.int32()),
                "evidence": pa.array(evidence, pa.list_(id_type)), "nearest": pa.array(nearest, pa.float64()),
                **({"row": batch.column("row")} if keep_row else {}),
            })

    schema = f"doc_id {kind}, held_out boolean, score double, predicted int, evidence array<{kind}>, nearest double"
    row = [F.struct(*documents.columns).alias("row")] if keep_row else []
    if keep_row:
        schema += f", row {documents.select(*row).schema['row'].dataType.simpleString()}"
    return documents.select("doc_id", crc_fold("doc_id", 4, 2).alias("held_out"), "text", *row).mapInArrow(run, schema)
