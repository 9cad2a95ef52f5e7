"""Quality rules: a table of thresholds compiled into one projection of text statistics.

Every statistic is a Column over built-in functions; a text is read once and no
row leaves its partition.  Arrays that several statistics use are columns of an
inner projection, so they are computed once per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.llm.words import GAP, WORD, word_list

# Characters that count as symbols, and frequent function words
# of the languages of the corpus.
SYMBOLS = "[#*$%&|<>]"
STOP_WORDS = (
    "the of and to a in is that it for was on are as with by this be at from "
    "der die und das in den von zu mit ist des auf für im dem nicht eine als auch "
    "de la le et les des en un du une que est pour dans par sur au qui "
    "el los del las se por con para una no y al lo su"
)

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Texts of at least ``min_words`` words must have ``low <= metric <= high``."""

    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


RULES = (
    Rule("n_words", low=10),
    Rule("repeat_ratio", high=0.20),
    Rule("mean_word_chars", low=1.5, high=30.0, min_words=10),
    Rule("symbol_ratio", high=0.25),
    Rule("symbol_word_ratio", high=0.30, min_words=10),
    Rule("shout_ratio", high=0.40, min_words=10),
    Rule("dup_line_ratio", high=0.50),
    Rule("stop_word_ratio", low=0.01, min_words=80),
)


def _covered_words(out: str) -> Column:
    """Words covered by repeated windows, from their ascending start positions."""
    starts = F.col(out)
    gaps = F.transform(
        starts,
        lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW))),
    )
    return F.aggregate(gaps, F.lit(0), lambda a, g: a + g).cast("long")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts and ratios that rules refer to; a missing text counts as empty.

    ``n_repeat_words`` compares 64-bit hashes of five-word windows.  Only texts
    with a repeated window sort their windows.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    given = list(docs.columns)
    split = docs.select(
        *given,
        word_list(body).alias("_words"),
        F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD)).alias("_lines"),
    )
    hashed = split.select(
        *given, "_words", "_lines", F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes")
    )
    hashes = F.col("_hashes")
    window = F.transform(
        F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - F.lit(WINDOW - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]),
    )
    windowed = hashed.select(*given, "_words", "_lines", window.alias("_windows"))
    windows = F.col("_windows")
    some = F.size(F.array_distinct(windows)) < F.size(windows)
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_ = windowed.select(*given, "_words", "_lines", F.when(some, placed).alias("_placed"))
    rows = F.col("_placed")

    def repeated(x: Column, k: Column) -> Column:
        after = F.get(rows, k + 1)["h"] == x["h"]
        before = F.when(k > 0, F.get(rows, k - 1)["h"] == x["h"])
        return F.coalesce(after, F.lit(False)) | F.coalesce(before, F.lit(False))

    starts = F.array_sort(F.transform(F.filter(rows, repeated), lambda x: x["i"]))
    found = sorted_.select(*given, "_words", "_lines", F.coalesce(starts, F.array().cast("array<int>")).alias("_starts"))
    words, lines = F.col("_words"), F.col("_lines")
    stops = F.array(*[F.lit(w) for w in sorted(set(STOP_WORDS.split()))])
    counted = found.select(
        *given,
        F.size(words).cast("long").alias("n_words"),
        F.length(F.regexp_replace(body, GAP, "")).cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _covered_words("_starts").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(words, lambda w: w.rlike(SYMBOLS))).cast("long").alias("n_symbol_words"),
        F.size(F.filter(words, lambda w: w.rlike(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$"))).cast("long").alias("n_shouted"),
        F.size(F.filter(words, lambda w: F.array_contains(stops, F.lower(w)))).cast("long").alias("n_stop_words"),
    )

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))

    ratios = {
        "repeat_ratio": ("n_repeat_words", "n_words"),
        "mean_word_chars": ("word_chars", "n_words"),
        "symbol_ratio": ("n_symbols", "word_chars"),
        "symbol_word_ratio": ("n_symbol_words", "n_words"),
        "shout_ratio": ("n_shouted", "n_words"),
        "dup_line_ratio": ("n_dup_lines", "n_lines"),
        "stop_word_ratio": ("n_stop_words", "n_words"),
    }
    return counted.withColumns({name: share(*parts) for name, parts in ratios.items()})


def compiled(rules: Sequence[Rule]) -> Column:
    """One boolean Column for the whole table of rules."""
    verdict = F.lit(True)
    for rule in rules:
        value = F.col(rule.metric)
        ok = F.lit(True)
        if rule.low is not None:
            ok = ok & (value >= F.lit(rule.low))
        if rule.high is not None:
            ok = ok & (value <= F.lit(rule.high))
        verdict = verdict & (ok if not rule.min_words else (F.col("n_words") < rule.min_words) | ok)
    return verdict


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document with its statistics, ``base_failed`` and ``kept``.

    The base rule is in whole numbers: fewer than ten words, or more than a
    fifth of the words in repeated windows.  Columns of ``docs`` other than
    ``doc_id`` and ``text`` are ignored, so their names cannot clash.
    """
    stats = with_statistics(docs.select("doc_id", "text")).drop("text")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & compiled(rules)
    )


def rules_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_symbol_words", "n_shouted", "n_stop_words", "n_lines",
    )


_STOPS_SQL = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS.split())))

RULES_SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), base AS (
  SELECT r, doc_id, text,
    regexp_extract_all(text, '{WORD}') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM docs
), windows AS (
  SELECT r, i, array_to_string(words[i : i + 4], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM base WHERE len(words) >= 5)
), repeated AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY r
), stats AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '{GAP}', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(lines)::BIGINT AS n_lines,
    len(list_filter(words, lambda w: regexp_matches(w, '{SYMBOLS}')))::BIGINT AS n_symbol_words,
    len(list_filter(words, lambda w: regexp_matches(w, '^[^\p{{Ll}}]*\p{{Lu}}[^\p{{Ll}}]*\p{{Lu}}[^\p{{Ll}}]*$')))::BIGINT AS n_shouted,
    len(list_filter(words, lambda w: lower(w) IN ({_STOPS_SQL})))::BIGINT AS n_stop_words
  FROM base LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM stats
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
    AND word_chars / n_words BETWEEN 1.5 AND 30.0
    AND n_symbols / word_chars <= 0.25
    AND n_symbol_words / n_words <= 0.30
    AND n_shouted / n_words <= 0.40
    AND n_dup_lines / n_lines <= 0.50
    AND (n_words < 80 OR n_stop_words / n_words >= 0.01) AS kept,
  n_symbol_words, n_shouted, n_stop_words, n_lines
FROM judged
"""
