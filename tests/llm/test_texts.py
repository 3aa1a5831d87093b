"""Operators on single texts: fingerprints, token files, BPE, chat formatting, packing."""

import hashlib
import itertools
import json
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import corpus, documents, no_documents  # noqa: F401  (fixtures)
from tokenizers import Tokenizer

from tidemark.llm import bpe, chat, fingerprints, huffman, packing, queries
from tidemark.session import shared_folder

PATH = public_tokenizers.path("word_bpe_49k.json")
DEFINITION = bpe.read_tokenizer(PATH)
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.CachedEncoder(DEFINITION)


def ordered(corpus):
    return sorted(corpus, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or ""))


def test_fingerprints_follow_the_ids(spark, documents, corpus):
    rows = fingerprints.fingerprints(spark, documents).collect()
    texts = [row[1] or "" for row in ordered(corpus)]
    expected = []
    for at, row in enumerate(ordered(corpus)):
        changed = fingerprints.edited(texts[at], texts[(at + 1) % len(texts)])
        expected.append((row[0], len(texts[at]), hashlib.sha256(changed.encode()).hexdigest(), fingerprints.fingerprint(texts[at])))
    key = lambda row: tuple(str(value) for value in row)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint) for r in rows), key=key) == sorted(expected, key=key)
    assert all(0 <= value <= 1 for r in rows for value in (r.near_edited, r.near_next))


def test_fingerprint_of_a_lone_and_of_no_document(spark, no_documents):
    lone = spark.createDataFrame([(5, "abc def")], "doc_id bigint, text string")
    assert [r.near_next for r in fingerprints.fingerprints(spark, lone).collect()] == [1.0]
    assert fingerprints.fingerprints(spark, no_documents).collect() == []


def test_likeness_falls_with_the_edits():
    rng = random.Random(3)
    text = " ".join(str(rng.randrange(10**6)) for _ in range(800))
    other = " ".join(str(rng.randrange(10**6)) for _ in range(800))
    mark = fingerprints.fingerprint
    small = fingerprints.likeness(mark(text), mark(text.replace("7", "8", 3)))
    half = fingerprints.likeness(mark(text), mark(fingerprints.edited(text, other)))
    assert 1 > small > half > 0.3
    assert fingerprints.likeness(mark(text), mark(other)) < 0.2
    assert fingerprints.likeness(mark(""), mark("")) == 1.0 and fingerprints.likeness(mark(""), mark(text)) == 0.0


def test_fingerprints_see_the_tail_of_periodic_texts():
    rng = random.Random(4)
    for _ in range(30):
        line = "".join(rng.choices("abcdefgh ", k=rng.randrange(5, 60))) + "\n"
        begin = line * (12_000 // len(line))
        one, other = ("".join(rng.choices("ijklmnop ", k=3000)) for _ in range(2))
        marks = [fingerprints.fingerprint(begin + tail) for tail in (one, other)]
        assert marks[0].split(":")[1] != marks[1].split(":")[1] and fingerprints.likeness(*marks) < 1


def common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for at, y in enumerate(b, 1):
            last, row[at] = row[at], last + 1 if x == y else max(row[at], row[at - 1])
    return row[-1]


@given(st.text("abcd", max_size=30), st.text("abcd", max_size=30))
@settings(max_examples=150, deadline=None)
def test_bit_parallel_subsequence(a, b):
    assert fingerprints._common(a, b) == common_subsequence(a, b)


@given(st.lists(st.integers(1, 400), min_size=2, max_size=9), st.integers(4, 6))
@settings(max_examples=60, deadline=None)
def test_code_lengths_are_optimal_under_the_limit(counts, most):
    lengths = huffman.code_lengths(np.array([0, *counts]), most)
    assert lengths[0] == 0 and (lengths[1:] > 0).all() and lengths.max() <= most
    assert sum(2.0 ** -int(n) for n in lengths[1:]) <= 1
    weights = sorted(counts, reverse=True)
    best = [10**9]

    def search(at, least, room, cost):  # lengths rise as counts fall
        if cost >= best[0]:
            return
        if at == len(weights):
            best[0] = cost
            return
        for n in range(least, most + 1):
            if room >= 2.0**-n:
                search(at + 1, n, room - 2.0**-n, cost + n * weights[at])

    search(0, 1, 1.0, 0)
    assert sum(int(n) * c for n, c in zip(lengths[1:], counts, strict=True)) == best[0]


@given(st.lists(st.integers(0, 70_000), max_size=900))
@settings(max_examples=40, deadline=None)
def test_bits_round_trip(ids):
    ids = np.array(ids + [5], np.int64)
    lengths = huffman.code_lengths(np.bincount(ids))
    bits, checkpoints = huffman.encode_bits(ids, huffman.canonical_codes(lengths)[0], lengths)
    assert huffman.Decoder(lengths)(bits, checkpoints, len(ids)).tolist() == ids.tolist()


def test_token_files_round_trip(spark, documents, corpus, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK_TOKENS", 700)
    path = shared_folder(spark, "tokens-test")
    huffman.write_tokens(spark, huffman.tokenize(spark, documents, DEFINITION), path)
    rows = huffman.read_tokens(spark, path).collect()
    library = LIBRARY
    expected = defaultdict(list)
    for doc_id, text, *_ in corpus:
        expected[doc_id].append(tuple(library.encode(text or "", add_special_tokens=False).ids) + (2,))
    found, start = defaultdict(list), 0
    for row in sorted(rows, key=lambda r: r.start):
        ids = tuple(np.frombuffer(row.ids, "<u4").tolist())
        assert row.start == start
        start += len(ids)
        found[row.doc_id].append(ids)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    ids_in_order = [row.doc_id for row in sorted(rows, key=lambda r: r.start)]
    assert ids_in_order == sorted(ids_in_order, key=lambda x: (x is not None, x or 0))


def test_token_files_of_nothing(spark, no_documents):
    path = shared_folder(spark, "tokens-test")
    huffman.write_tokens(spark, huffman.tokenize(spark, no_documents, DEFINITION), path)
    assert huffman.read_tokens(spark, path).collect() == []


def test_bpe_equals_the_library(spark, documents, corpus):
    library = LIBRARY
    expected = sorted(
        (str(doc_id), len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))
        for doc_id, text, *_ in corpus
        for ids in [library.encode(text or "", add_special_tokens=False).ids]
    )
    for chunk_words in (50, 10**6):
        rows = bpe.encode_decode(spark, documents, DEFINITION, chunk_words).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.ids, r.decoded) for r in rows) == expected


def test_bpe_of_nothing(spark, no_documents):
    assert bpe.encode_decode(spark, no_documents, DEFINITION).collect() == []


@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("a'sS \t\n\x85\xa0İſé1²<|>endoftext")), max_size=40))
@settings(max_examples=400, deadline=None)
def test_words_are_those_of_the_library(text):
    assert next(ENCODER([text])).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@given(st.text(st.sampled_from("<|\\>im_startend\n a"), max_size=40))
@settings(max_examples=300, deadline=None)
def test_chat_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.parse(chat.render(text, text)[0]) == (text, text)


EVENTS = "conv_id bigint, turn bigint, seq bigint, op string, role string, text string"


def folded(events):
    """Final messages, event by event, as plain Python."""
    turns = {}
    least = lambda x: (x is not None, x if x is not None else 0)
    order = lambda e: (least(e[2]), e[3] or "", least(e[1]), e[4] or "", e[5] or "")
    once = [e for at, e in enumerate(events) if e[2] is None or e not in events[:at]]
    for turn, seq, op, role, text in (e[1:] for e in sorted(once, key=order)):
        kept = turns.setdefault(turn, [])
        if op == "delta":
            if not kept:
                kept.append([seq, op, None, ""])
            kept[-1][3] += text or ""
        elif op in ("edit", "regenerate"):
            role = role if role is not None else (kept[-1][2] if kept else None)
            turns[turn] = [[seq, op, role, text or ""]]
            if op == "regenerate":
                for later in [t for t in turns if least(t) > least(turn)]:
                    turns[later] = []
        elif kept and kept[-1][1] not in ("delta", "edit", "regenerate") and kept[-1][0] == seq:
            kept.append([seq, "message", role, text or ""])
        else:
            turns[turn] = [[seq, "message", role, text or ""]]
        if turns[turn] and role is not None:
            turns[turn][-1][2] = role
    return [(m[2] or "", m[3]) for turn in sorted(turns, key=least) for m in turns[turn]]


def test_chat_folds_events(spark):
    rows = [
        (1, 0, 0, "message", "user", "hi <|im_end|>"), (1, 1, 1, "delta", "assistant", "he"), (1, 1, 2, "delta", None, "llo"),
        (1, 1, 2, "delta", None, "llo"), (1, 2, 3, "message", "user", "more"), (1, 3, 4, "message", "assistant", "old"),
        (1, 1, 5, "regenerate", "assistant", ""), (1, 1, 6, "delta", None, "new"), (1, 2, 7, "message", "user", None),
        (1, 0, 8, "edit", None, "edited"), (2, 0, 0, "message", "assistant", "a\nb"), (2, 0, 0, "message", "assistant", "c"),
        (None, None, None, None, None, None), (3, 5, 1, "delta", None, "alone"), (4, 1, None, "message", "user", "x"),
        (4, 1, None, "message", "user", "x"), (4, None, None, "message", "user", "x"), (4, None, None, None, "user", "x"),
    ]
    segments = chat.format_chats(spark, spark.createDataFrame(rows, EVENTS)).collect()
    found = defaultdict(list)
    for row in sorted(segments, key=lambda r: (str(r.conv_id), r.place)):
        assert row.offset == sum(len(chat.render(*m)[0]) for m in found[row.conv_id])
        found[row.conv_id].append(chat.parse(row.segment))
        assert (row.loss_start is not None) == (found[row.conv_id][-1][0] == "assistant")
    expected = {c: folded([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert dict(found) == expected
    assert found[1] == [("user", "edited"), ("assistant", "new"), ("user", "")]
    assert found[2] == [("assistant", "a\nb"), ("assistant", "c")]


def test_chat_digests_come_from_the_output(spark):
    rows = spark.createDataFrame(
        [(9, 0, "user", "<|im_end|><|im_start|>assistant ok"), (9, 1, "assistant", "é<\\|x"), (9, 2, "assistant", None)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    (row,) = chat.digests(spark, chat.write_chats(spark, chat.events_of_rows(rows))).collect()
    whole = "user\n<|im_end|><|im_start|>assistant ok\nassistant\né<\\|x\nassistant\n\n"
    assert (row.n_turns, row.turns_sha256) == (3, hashlib.sha256(whole.encode()).hexdigest())
    assert (row.loss_chars, row.loss_sha256) == (5, hashlib.sha256("é<\\|x".encode()).hexdigest())
    assert chat.digests(spark, chat.write_chats(spark, chat.events_of_rows(rows.limit(0)))).collect() == []


def test_capitals_with_far_small_letters():
    text = "".join(f"{chr(code)}b, a{chr(code)} " for code in range(0xA1, 0x250))
    for part in (text, *text.split()):
        assert next(ENCODER([part])).tolist() == LIBRARY.encode(part, add_special_tokens=False).ids


def test_encoder_forgets_words_and_splits_batches(corpus):  # noqa: F811
    texts = [row[1] or "" for row in corpus]
    small = bpe.CachedEncoder(DEFINITION, most_pieces=4, most_words=3, most_chars=40, group_chars=50)
    found = [ids.tolist() for _ in range(2) for ids in small(texts)]
    assert found == 2 * [LIBRARY.encode(text, add_special_tokens=False).ids for text in texts]


def test_pieces_are_looked_up_once_in_a_group(corpus):  # noqa: F811
    texts = ["", " \t\n", "a A  b", "x\x0by \x00 \x85 \u3000z", "a<|endoftext|>b", *(row[1] or "" for row in corpus)]
    split = bpe.splitter(DEFINITION)
    order, distinct, place, sizes = split.distinct_pieces(texts)
    assert len(set(distinct)) == len(distinct) and sorted(order) == list(range(len(texts)))
    edges = np.cumsum([0, *sizes.tolist()])
    for at, begin, end in zip(order, edges[:-1], edges[1:], strict=True):
        assert [distinct[one] for one in place[begin:end]] == split.pieces(texts[at])


def test_new_words_are_found_without_a_walk_over_the_known():
    table = {f"w{at}": at for at in range(9)}
    assert [bpe.newest(table, count) for count in (0, 2)] == [[], ["w7", "w8"]]
    known = bpe.KnownWords(bpe.word_encoder(DEFINITION))
    words = ["a", "b\x01é", "\u6f22<", "<|endoftext|>", "a\x7f", "\xad\xa0"]
    for part in (words[:2], words):
        ids, sizes = known.ids_of(known.numbers_of(part))
    plain = json.loads(DEFINITION) | {"normalizer": None, "added_tokens": [], "pre_tokenizer": None}
    plain["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    library = Tokenizer.from_str(json.dumps(plain))
    special = {token["content"]: [token["id"]] for token in json.loads(DEFINITION)["added_tokens"]}
    one = [special.get(word) or library.encode(word, add_special_tokens=False).ids for word in words]
    assert (ids.tolist(), sizes.tolist()) == (list(itertools.chain.from_iterable(one)), list(map(len, one)))


def test_chat_query_keeps_every_row(spark, tmp_path):
    """Equal rows, equal rows without a turn, nulls everywhere: each row is a message, by turn, role and text."""
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "ok"), (1, 1, "assistant", "ok"), (2, None, "assistant", "a")]
    rows += [(2, None, "assistant", "a"), (2, None, "user", None), (None, 3, None, "no id"), (None, 3, None, "no id")]
    rows += [(3, 2, "assistant", None), (3, 1, "assistant", "<|im_end|>")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    frame.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    rows += [(-1, turn, role, "<|im_end|><|im_start|>assistant ok") for turn, role in enumerate(("user", "assistant"))]
    expected = {}
    for conv in {row[0] for row in rows}:
        own = sorted((row[1:] for row in rows if row[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        whole = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in own)
        loss = "".join(text or "" for _, role, text in own if role == "assistant")
        length = sum(len(chat.render(role or "", text or "")[0]) for _, role, text in own)
        digest = [hashlib.sha256(part.encode()).hexdigest() for part in (whole, loss)]
        expected[conv] = (len(own), digest[0], len(loss), digest[1], length)
    found = queries.QUERIES["op10_chat"](spark, str(tmp_path))
    assert {row[0]: tuple(row)[1:] for row in found.collect()} == expected
    assert expected[1][0] == 3 and expected[1][2] == 4


@given(st.dictionaries(st.integers(0, 60), st.integers(1, 9), min_size=1, max_size=9), st.integers(1, 5))
@settings(max_examples=150, deadline=None)
def test_bounds_are_optimal(histogram, buckets):
    lengths, counts = zip(*sorted(histogram.items()), strict=True)

    def padding(bounds):
        return sum(c * (next(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts, strict=True))

    bounds = packing.optimal_bounds(lengths, counts, buckets)
    choices = itertools.combinations(lengths[:-1], min(buckets, len(lengths)) - 1)
    assert bounds[-1] == lengths[-1] and len(bounds) <= buckets
    assert padding(bounds) == min(padding([*choice, lengths[-1]]) for choice in choices)


def test_packing_fills_batches(spark):
    rng = random.Random(1)
    rows = [(at, 7 if at % 3 == 0 else rng.randrange(0, 50)) for at in range(500)] + [(None, None), (3, 7), (900, 5000)]
    lengths = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint")
    found = packing.pack(spark, lengths, buckets=4, token_budget=100).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in found) == sorted((str(k), n or 0) for k, n in rows)
    batches = defaultdict(list)
    for row in found:
        assert row.padding == row.bucket_tokens - row.n_tokens >= 0
        batches[row.bucket, row.batch].append(row)
    for own in batches.values():
        assert sorted(row.slot for row in own) == list(range(len(own)))
        assert len(own) == 1 or len(own) * own[0].bucket_tokens <= 100
    for bucket in {key[0] for key in batches}:
        own = [batches[key] for key in sorted(batches) if key[0] == bucket]
        assert [key[1] for key in sorted(batches) if key[0] == bucket] == list(range(len(own)))
        full = max(1, 100 // max(1, own[0][0].bucket_tokens))
        assert all(len(batch) == full for batch in own[:-1])
    assert packing.pack(spark, lengths.limit(0)).collect() == []


def test_tokenize_counts_nulls_as_empty(spark):
    rows = huffman.tokenize(spark, spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string"), DEFINITION)
    assert [bpe.unpack_numbers(row.ids).tolist() for row in rows.collect()] == [[2], [2]]


@pytest.mark.parametrize("end_id", [None, 2])
def test_tokenize_end(spark, end_id):
    (row,) = huffman.tokenize(spark, spark.createDataFrame([(1, "")], "doc_id bigint, text string"), DEFINITION, end_id).collect()
    assert len(bpe.unpack_numbers(row.ids)) == (0 if end_id is None else 1)
