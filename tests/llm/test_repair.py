"""Conversation repair against exhaustive search and against its SQL on rows with every odd case."""

import random

import duckdb
import pyarrow as pa
import pytest

from tidemark.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def every_audit(steps, most_inserts=3):
    """(cost, audit) of every way to a whole conversation."""
    found, stack = [], [(0, "", "", 0)]
    while stack:
        at, roles, audit, cost = stack.pop()
        if at == len(steps) and not (body := roles.removeprefix("s")).replace("ua", "") and (body or not roles):
            found.append((cost, audit))
        if audit.count("I") < most_inserts:
            stack.append((at, roles + ("a" if roles.endswith("u") else "u"), audit + "I", cost + 3))
        if at < len(steps):
            forced, initial, truncated = steps[at]
            stack.append((at + 1, roles, audit + "D", cost + 4))
            if not forced:
                for role in "ua":
                    stack.append((at + 1, roles + role, audit + "R", cost + 3 + 3 * truncated))
                if initial:  # an empty role has none, so it does not stay
                    stack.append((at + 1, roles + initial, audit + "K", cost + 3 * truncated))
    return found


def random_steps(rng, most):
    return [
        (True, "", False) if rng.random() < 0.2 else (False, rng.choice(["s", "u", "u", "a", "a", "t", ""]), rng.random() < 0.3)
        for _ in range(rng.randrange(most))
    ]


def test_search_finds_the_cheapest_and_least_audit():
    rng = random.Random(5)
    for _ in range(300):
        steps = random_steps(rng, 6)
        assert repair.search(steps, repair.START) == min(every_audit(steps)), steps


def test_blocks_make_the_same_audit_as_one_search():
    rng = random.Random(6)
    tail = [(state, repair.START, 3 * len(text), 0) for state, text in repair.TAILS.items()]
    for _ in range(200):
        steps = random_steps(rng, 40)
        size = rng.choice([1, 2, 3, 7])
        cuts = [steps[at : at + size] for at in range(0, len(steps), size)] or [[]]
        closes = rng.random() < 0.5
        found = [
            repair.segments(cut, at == 0 and rng.random() < 0.5, closes and at == len(cuts) - 1) for at, cut in enumerate(cuts)
        ]
        ways = repair.choose([[one[:4] for one in block] for block in found] + [tail])
        parts = [
            next((cost, audit) for entry, last, cost, _, audit in block if (entry, last) == way)
            for block, way in zip(found, ways, strict=False)
        ]
        state = ways[-1][0]
        whole = "".join(audit for _, audit in parts) + repair.TAILS[state]
        assert (sum(cost for cost, _ in parts) + 3 * len(repair.TAILS[state]), whole) == repair.search(steps, repair.START)


def odd_rows():
    rng = random.Random(8)
    texts = ["Hi.", "Hello there", "ok!", "", " \t", None, "why?  ", "end.\x1f", "É tout.\n", "x" * 5000 + ".", "a\nb: c."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "émigré"]
    rows = []
    for conv in [*range(60), None, -4]:
        for turn in range(rng.randrange(1, 12)):
            rows.append((conv, turn if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(texts)))
            if rng.random() < 0.2:
                rows.append(rows[-1])
            if rng.random() < 0.1:
                rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    rows += [(100, 7 * at, ("user", "assistant")[at % 2], f"turn {at % 150}.") for at in range(300)]
    rows += [(101, 3, "user", "again.")] * 50
    rows += [(102, -(1 << 40), "user", "far."), (102, 1 << 40, "assistant", "away.")]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).selectExpr(
        "*", "1 AS copies", "'x' AS fault", "2 AS part", "3 AS block", "4 AS place", "5 AS cost", "6 AS audit"
    )


def by_sql(rows):
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    conversations = pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
    with duckdb.connect() as connection:
        connection.register("conversations", conversations)
        result = connection.execute(repair.oracle_sql())
        return [column[0] for column in result.description], result.fetchall()


@pytest.mark.parametrize("block_rows", [1, 4, 256])
def test_repair_is_that_of_the_sql(spark, odd, rows, block_rows):
    damaged = repair.damage(odd)
    found = repair.repair_conversations(spark, damaged, damaged["copies"], block_rows)
    names, expected = by_sql(odd_rows())
    assert rows(found, *names) == sorted(expected, key=lambda row: tuple((value is not None, str(value)) for value in row))


def test_without_rows(spark, odd, rows):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair_conversations(spark, empty).count() == 0
    dropped = repair.repair_conversations(spark, odd.filter("conv_id = 5").limit(1), repair.F.lit(0))
    nothing = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert rows(dropped) == [(5, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_whole_conversations_stay_as_they_are(spark, rows):
    good = [(1, 0, "system", "Be brief."), (1, 1, "user", "Why?"), (1, 2, "assistant", "So.")]
    found = repair.repair_conversations(spark, spark.createDataFrame(good, SCHEMA))
    assert rows(found, "cost", "audit", "illegal") == [(0, "KKK", 0)]


def test_settings_come_back(spark, odd):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    repair.repair_conversations(spark, odd.limit(3)).count()
    assert spark.conf.get(name) == before
