"""Documents for the tests of this folder; a module of its own, as there is one conftest already."""

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def make_corpus(seed: int = 7) -> list[tuple]:
    """Small corpus with copies, near copies, shared passages, nulls, empty, repeated and long texts."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu") for b in ("ra", "te", "so", "") for c in ("n", "s", "é", "um")]

    def words(n: int) -> list[str]:
        return [rng.choice(vocabulary) + str(rng.randrange(40)) for _ in range(n)]

    texts: list[str | None] = [" ".join(words(rng.randrange(40, 160))) for _ in range(40)]
    base = words(300)
    for change in range(8):  # near copies of one text
        own = list(base)
        own[17 * change + 5] = "edit"
        texts.append(" ".join(own))
    passage = words(60)
    for _ in range(6):  # a passage in otherwise different texts
        texts.append(" ".join(words(70) + passage + words(80)))
    texts += [texts[0]] * 4 + [texts[3].upper(), "  " + texts[5].replace(" ", "\n\t") + "\x0b"]
    texts += [None, "", " \n\t ", "one", "one two three", "ONE  two\nthree", "a b c d e", "x\x1cy z w \u0085v"]
    texts += [" ".join(["again"] * 90), "same line here\nsame line here\n\nother line\n" * 5]
    texts += ["Ünïcode ÉÀ ΣΑΣ ǅ 漢字 ½ ٣ é İ don't we'll <|endoftext|> it's <|x|> \U0001f600", " ".join(words(6000))]
    rows = [(at, text, "en", f"s{at % 3}", None if text is None else len(text)) for at, text in enumerate(texts)]
    rows += [(None, texts[1], None, None, None), (None, "no id at all", None, None, None)]
    rows += [(2, texts[2], "en", "s0", 1), (4, "another text of the same id " * 9, "en", "s0", 1)]
    return rows


@pytest.fixture(scope="session")
def corpus():
    return make_corpus()


@pytest.fixture(scope="session")
def documents(spark, corpus):
    """The corpus with columns whose names clash with those the operators make."""
    return (
        spark.createDataFrame(corpus, SCHEMA)
        .selectExpr("*", "1 AS n_words", "'x' AS kept", "'y' AS key", "2 AS score", "3 AS bucket", "array(1) AS places")
        .repartition(3, "lang", "n_chars")
    )


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
