"""Personal data: patterns against plain expressions, marginals against enumeration, labels carried along links."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from llm_fixtures import corpus, documents, no_documents  # noqa: F401

from tidemark.llm import personal, queries

SMALL = "/root/testdata/sf0.001"
PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_luhn(digits):
    doubled = [int(d) * (1 + at % 2) for at, d in enumerate(digits[::-1])]
    return sum(sum(map(int, str(value))) for value in doubled) % 10 == 0


def brute(text):
    """The base spans as the contract words them."""
    out = []
    for kind, pattern in enumerate(PLAIN):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            if (
                kind == 0
                or (kind == 1 and all(int(part) <= 255 for part in match[0].split(".")))
                or (kind == 2 and 12 <= len(digits) <= 19 and plain_luhn(digits))
                or (kind == 3 and 9 <= len(digits) <= 15)
            ):
                out.append((match.start(), kind, match.end()))
    return sorted(out)


def test_patterns_are_the_plain_expressions():
    rng = random.Random(4)
    pieces = ["a@b.c", "@", ".", "-", " ", "+1", "(017)", "555-7713", "1.2.3.4", "999.1.1.1", "0001.2.3.255", "4929348385146306"]
    pieces += ["é", "x", "7", "..", "%", "\n", "b.c@d", "4929 3483 8514 6306", "2390409500648960", "+12 345.678-90", "漢", " ", "٣"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        assert personal.patterns(text) == brute(text), text


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + " " * 400_000, "a@" * 200_000, "a.b@c-" * 60_000, "1 " * 200_000])
def test_long_texts_take_linear_time(text):
    begun = time.perf_counter()
    personal._results(personal.Field(), [text], 0.8)
    assert time.perf_counter() - begun < 30


def random_field(seed):
    rng = np.random.default_rng(seed)
    field = personal.Field(rng.normal(size=len(personal.Field.prior())))
    return field, rng


def enumerated(own, between, links):
    size = own.shape[1]
    total = np.zeros_like(own)
    for labels in itertools.product(range(size), repeat=len(own)):
        weight = sum(own[at, label] for at, label in enumerate(labels))
        weight += sum(between[e][labels[a], labels[b]] for e, (a, b, _) in enumerate(links))
        for at, label in enumerate(labels):
            total[at, label] += np.exp(weight)
    return total / total.sum(1, keepdims=True)


def test_marginals_of_trees_are_exact_and_of_loops_near():
    for seed in range(8):
        field, rng = random_field(seed)
        features = rng.integers(0, 2, size=(5, personal.FEATURES)).astype(float) * 0.3
        tree = np.array([(0, 1, 0), (1, 2, 0), (1, 3, 1), (3, 4, 2)])
        own, between = field.potentials(features, np.ones((5, 2)), tree)
        chance, pair, _ = field.marginals(own, between, tree, 60)
        np.testing.assert_allclose(chance, enumerated(own, between, tree), atol=1e-6)
        np.testing.assert_allclose(pair.sum(2), chance[tree[:, 0]], atol=1e-6)
        loop = np.vstack([tree, [(2, 4, 1)]])
        own, between = field.potentials(features, np.ones((5, 2)), loop)
        chance, _, _ = field.marginals(own, between, loop, 60)
        assert np.abs(chance - enumerated(own, between, loop)).max() < 0.25


@pytest.fixture(scope="module")
def field(spark):
    return personal.train(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def spans_of(field, text):
    base, whole = personal._results(field, [text], personal.THRESHOLD)[0]
    assert set(base) <= set(whole)
    return [(personal.KINDS[kind], text[start:end]) for start, kind, end in whole if (start, kind, end) not in base]


def test_labels_reach_repeated_and_similar_words(field):
    said = "Call +1 (974) 555-3436 today, "
    assert spans_of(field, said + "or later just 555-3436 again") == [("phone", "555-3436")]
    assert spans_of(field, said + "also (974) 555-3436 works") == [("phone", "(974) 555-3436")]
    assert spans_of(field, "just 555-3436 again") == []  # nothing in this document says so


def test_clean_words_stay(field):
    clean = 'In 2024 no 12. of 9.9. items, 3.5 % and "0a9b8c7d6e5f4a3b2c1d0e9f8a7b6c5d4e3f2a1b" or 2390409500648960, user1@ home'
    assert spans_of(field, clean) == []


def test_field_without_patterns_finds_what_they_find(spark, field):
    """On documents it is not clamped on, the field alone labels the words of base spans."""
    texts = [row.text for row in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect() if row.text]
    parts = [found for text in texts if (found := personal.tokens(text, personal.patterns(text)))]
    features, plain, label, links = personal.joined(parts)
    chance, _, _ = field.marginals(*field.potentials(features, plain, links), links)
    entity = label > 0
    assert (chance.argmax(1)[entity] == label[entity]).mean() > 0.95
    assert (chance.argmax(1)[~entity] == 0).mean() > 0.97


def test_a_document_does_not_depend_on_its_neighbours(field):
    texts = ["+1 (974) 555-3436 then 555-3436", "", "a 1 b", "x.1@mail.example.com x.1", "4929348385146306 2390409500648960"] * 7
    together = personal._results(field, texts, 0.5)
    assert together == [personal._results(field, [text], 0.5)[0] for text in texts]


def test_every_odd_document_has_its_row(spark, field, documents, corpus, rows):  # noqa: F811
    odd = documents.selectExpr("*", "'a' AS spans", "1 AS kind", "2 AS start")
    found = personal.find_personal_data(spark, odd, field=field)
    expected = [(one[0], len(brute(one[1] or ""))) for one in corpus]
    base = personal.F.size(personal.F.filter("spans", lambda span: span["base"])).alias("n")
    assert rows(found.select("doc_id", base)) == sorted(expected, key=lambda row: tuple((value is not None, str(value)) for value in row))


def test_without_rows_or_words(spark, no_documents):  # noqa: F811
    assert personal.find_personal_data(spark, no_documents).count() == 0
    words = spark.createDataFrame([(1, "only words"), (2, None)], "doc_id bigint, text string")
    assert [row.spans for row in personal.find_personal_data(spark, words).collect()] == [[], []]


def test_query_digests(spark):
    given = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = {row.doc_id: row for row in queries.QUERIES["op13_personal_data"](spark, SMALL).collect()}
    assert len(found) == len(given)
    for row in given:
        base = brute(row.text or "")
        listed = ",".join(f"{personal.KINDS[kind]}:{start}:{end}" for start, kind, end in base)
        own = found[row.doc_id]
        assert own.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [own.n_email, own.n_ip, own.n_card, own.n_phone] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        assert set(filter(None, listed.split(","))) <= set(own.spans.split(","))


def test_redacted_text(spark):
    text = "a b@c.de, 1.2.3.4 and é"
    frame = spark.createDataFrame([(1, text), (2, "none"), (3, None)], "doc_id bigint, text string")
    found = personal.find_personal_data(spark, frame, keep_text=True)
    out = found.orderBy("doc_id").select(personal.redacted(personal.F.coalesce("text", personal.F.lit("")), personal.F.col("spans")))
    assert [row[0] for row in out.collect()] == ["a <email>, <ip> and é", "none", ""]
