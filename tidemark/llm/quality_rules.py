"""Quality rules: word and line measures, then a hashed n-gram log-likelihood ratio. Column functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, let, words_column

#: Cells of the unigram half and of the bigram half of the table.
CELLS = 1 << 14
#: Labelled documents that may define the trusted target, taken in the order of md5(doc_id).
MAX_TRUSTED = 20_000
#: Occurrences that each cell is taken to have had in the raw corpus, with the target's share of them.
PRIOR = 20
#: Mean log-likelihood ratio per n-gram, in thousandths of a nat, below which a document is rejected.
THRESHOLD = -85
SYMBOLS = "#*$%&|<>"


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text."""
    grams = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda word, at: F.xxhash64(word, F.get(words, at + 1), F.get(words, at + 2)),
    )

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, at: F.when(at == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get(places, at - 1)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def of_sorted(pairs: Column) -> Column:
        twice = F.filter(
            pairs,
            lambda pair, at: F.coalesce(F.get(pairs, at - 1)["h"] == pair["h"], F.lit(False))
            | F.coalesce(F.get(pairs, at + 1)["h"] == pair["h"], F.lit(False)),
        )
        return let(F.sort_array(F.transform(twice, lambda pair: pair["at"])), covered)

    return let(
        grams,
        lambda found: F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(
            let(
                F.sort_array(F.transform(found, lambda h, at: F.struct(h.alias("h"), at.alias("at")))),
                of_sorted,
            )
        ),
    )


def _pairs(hashes: Column) -> Column:
    """A number for each pair of neighbouring words, from their crc32."""
    return F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda h, at: h * 65599 + F.get(hashes, at + 1),
    )


def _hashed(text: Column, body) -> Column:
    """``body(words, hashes, pairs)``, each computed once."""
    return let(
        words_column(text),
        lambda words: let(
            F.transform(words, lambda word: F.crc32(word)),
            lambda hashes: let(_pairs(hashes), lambda pairs: body(words, hashes, pairs)),
        ),
    )


def _measures(text: Column, words: Column, hashes: Column, pairs: Column) -> dict[str, Column]:
    """The base measures of a text; a null text counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    triples = F.transform(
        F.slice(pairs, F.lit(1), F.greatest(F.size(pairs) - 1, F.lit(0))),
        lambda pair, at: pair * 8191 + F.get(hashes, at + 2),
    )
    # equal windows have equal numbers, so only texts with a repeated number are looked at exactly
    repeated = let(
        triples, lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), F.lit(0)).otherwise(_repeated(words))
    )
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": (F.size(F.split(whole, "[" + SYMBOLS + "]")) - 1).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated.cast("long"),
    }


def trusted_documents(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Ids whose labels all say quality 1, at most ``max_trusted`` in the order of md5 of the id."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
        .orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id")
        .limit(max_trusted)
        .select("doc_id")
    )


def ratio_table(documents: DataFrame, trusted: DataFrame, cells: int = CELLS) -> list[int]:
    """Log-likelihood ratio of each cell, in thousandths of a nat, trusted target over the raw corpus.

    Counts cover every n-gram of every document. Both multinomials have the same prior, ``PRIOR``
    occurrences for each cell (scaled to the target's size there), so a cell that was hardly seen says
    little. Only the 2 * cells sums come to the driver. The broadcast side is bounded by ``MAX_TRUSTED`` ids.
    """
    tagged = documents.select("doc_id", "text").join(
        F.broadcast(trusted.withColumn("is_trusted", F.lit(1))), "doc_id", "left"
    )
    number = F.col("number")
    sums = (
        tagged.select(
            F.explode(_hashed(F.col("text"), lambda _, h, p: F.concat(h, F.transform(p, lambda x: -1 - x)))).alias("number"),
            "is_trusted",
        )
        .select(
            F.when(number < 0, (-1 - number).bitwiseAND(cells - 1) + cells)
            .otherwise(number.bitwiseAND(cells - 1))
            .cast("int")
            .alias("cell"),
            "is_trusted",
        )
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("is_trusted").alias("target"))
        .toArrow()
        .to_pydict()
    )
    raw_total, target_total = sum(sums["raw"]), sum(sums["target"])
    table = [0] * (2 * cells)
    if target_total:
        for cell, raw, target in zip(sums["cell"], sums["raw"], sums["target"], strict=True):
            ratio = (target * raw_total / target_total + PRIOR) / (raw + PRIOR)
            table[cell] = math.floor(1000 * math.log(ratio) + 0.5)
    return table


def verdicts(text: Column, table: list[int], threshold: int = THRESHOLD) -> Column:
    """Struct of the measures, ``base_failed``, ``llr`` (thousandths of a nat per n-gram) and ``kept``.

    A text without words fails the base rules, so its ratio (0) does not matter.
    """
    cells = len(table) // 2
    # constants that the optimiser folds once: array literals of that length would be planned slowly
    single, double = (
        F.from_json(F.lit("[" + ",".join(map(str, part)) + "]"), "array<int>") for part in (table[:cells], table[cells:])
    )

    def added(numbers: Column, ratios: Column) -> Column:
        return F.aggregate(
            numbers,
            F.lit(0).cast("long"),
            lambda acc, x: acc + F.get(ratios, x.bitwiseAND(cells - 1).cast("int")),
        )

    def judged(m: Column) -> Column:
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        grams = F.greatest(2 * m["n_words"] - 1, F.lit(0))
        failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
        return F.struct(
            *[m[name].alias(name) for name in names],
            failed.alias("base_failed"),
            (m["sum"].cast("double") / F.greatest(grams, F.lit(1))).alias("llr"),
            (~failed & (m["sum"] >= threshold * grams)).alias("kept"),
        )

    def all_of(words: Column, hashes: Column, pairs: Column) -> Column:
        found = _measures(text, words, hashes, pairs) | {"sum": added(hashes, single) + added(pairs, double)}
        return let(F.struct(*[value.alias(name) for name, value in found.items()]), judged)

    return _hashed(text, all_of)


def quality_rules(
    documents: DataFrame,
    labels: DataFrame,
    cells: int = CELLS,
    threshold: int = THRESHOLD,
    max_trusted: int = MAX_TRUSTED,
) -> DataFrame:
    """All columns of ``documents`` plus the struct ``quality_rules``; no row moves.

    Words are ``[^\\x20\\x09-\\x0D]+``; n-grams are words and pairs of neighbours, hashed by crc32. A
    document is kept unless a base rule fails or its ratio per n-gram is below the threshold. Null
    texts count as empty, so they fail. Rows with equal or null ids are judged each by its own text.
    Without a trusted document every ratio is 0. A column of the same name is replaced.
    """
    table = ratio_table(documents, trusted_documents(labels, max_trusted), cells)
    return documents.withColumn("quality_rules", verdicts(F.col("text"), table, threshold))


def oracle_ctes(documents: str = "documents", cells: int = CELLS, threshold: int = THRESHOLD) -> str:
    """DuckDB common table expressions that end in ``judged``: one row per document with all verdicts."""
    return f"""
crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b::BIGINT, range(8)::BIGINT[]),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM range(256) r(b))),
rows_in AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM {documents}),
word_lists AS (SELECT rid, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w FROM rows_in),
words AS (SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS pos FROM word_lists),
distinct_words AS (SELECT DISTINCT word FROM words),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(1, octet_length(encode(word)) + 1), lambda i: ('0x' || hex(encode(word))[2*i-1:2*i])::BIGINT)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295::BIGINT) AS h
  FROM distinct_words, crc_table),
numbered AS (SELECT rid, pos, h, lead(h) OVER (PARTITION BY rid ORDER BY pos) AS nxt
  FROM words JOIN hashed USING (word)),
grams AS (
  SELECT rid, h % {cells} AS cell FROM numbered
  UNION ALL SELECT rid, (h * 65599 + nxt) % {cells} + {cells} FROM numbered WHERE nxt IS NOT NULL),
trusted AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
  ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT {MAX_TRUSTED}),
sums AS (SELECT cell, count(*) AS raw, count(t.doc_id) AS target
  FROM grams JOIN rows_in USING (rid) LEFT JOIN trusted t USING (doc_id) GROUP BY cell),
totals AS (SELECT sum(raw)::DOUBLE AS raw_total, sum(target)::DOUBLE AS target_total FROM sums),
ratios AS (SELECT cell, CASE WHEN target_total = 0 THEN 0 ELSE floor(1000 * ln(
    (target * raw_total / target_total + {PRIOR}) / (raw + {PRIOR})) + 0.5) END::BIGINT AS ratio FROM sums, totals),
scores AS (SELECT rid, sum(ratio) AS total, count(*) AS n FROM grams JOIN ratios USING (cell) GROUP BY rid),
windows AS (SELECT rid, pos, word AS a, lead(word) OVER w AS b, lead(word, 2) OVER w AS c
  FROM words WINDOW w AS (PARTITION BY rid ORDER BY pos)),
repeats AS (SELECT rid, pos FROM windows WHERE c IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
covered AS (SELECT rid, count(*) AS n FROM (
    SELECT DISTINCT rid, pos + step AS place FROM repeats, range(3) s(step)) GROUP BY rid),
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM (
    SELECT rid, unnest(string_split(text, chr(10))) AS line FROM rows_in)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
measured AS (
  SELECT rid, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    coalesce(s.total, 0) AS total, coalesce(s.n, 0) AS grams
  FROM rows_in JOIN word_lists USING (rid) LEFT JOIN lines l USING (rid) LEFT JOIN covered c USING (rid)
    LEFT JOIN scores s USING (rid)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND total >= {threshold} * grams AS kept
  FROM measured)"""
