"""Secret scans in Column expressions: patterns, and Markov models of characters.

A pattern's spans come from the pieces between its matches: lengths of pieces
and matches, summed in turn, are the positions, in code points.

Runs of token characters that no pattern covers are judged by two first-order
Markov models, one of random strings and one of ordinary identifiers: the sum
of log ratios of their character transitions.  Both are counted from labelled
samples by ``train``.  The models are a table of ``STATES ** 2`` numbers, which
is a literal in the scan, so a scan is one projection without a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The base rules, their order, and the alphabet of tokens.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
KINDS = (*PATTERNS, "markov")
LEAST_VALUE = 6
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]{%d,}"

STATES = len(ALPHABET) + 1  # state 0 is the start
SAMPLE_DOCS = 5_000
SAMPLE_STRINGS = 2_000
LEAST_RUN = 16
LEAST_SAMPLE = 6
LEAST_RATIO = 12.0
LEAST_MEAN_RATIO = 0.75
MASK = "[secret]"

_SPANS = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class Markov:
    """Log-likelihood ratio, random over ordinary, of each transition."""

    table: tuple[float, ...]

    def column(self) -> Column:
        text = F.lit(",".join(repr(round(x, 6)) for x in self.table))
        return F.split(text, ",").cast("array<double>")


def _transitions(run: Column) -> Column:
    """Indices into the table for the transitions of a run, from the start state on."""
    at = lambda i: F.call_function("instr", F.lit(ALPHABET), F.substr(run, i, F.lit(1)))
    before = lambda i: F.when(i > 1, at(i - 1)).otherwise(F.lit(0))
    return F.transform(F.sequence(F.lit(1), F.length(run)), lambda i: before(i) * STATES + at(i))


def train(samples: DataFrame, smoothing: float = 0.5) -> Markov:
    """Models from ``(string, random)`` samples; strings without a token character are ignored.

    Each state's transitions have a Dirichlet prior, so without samples of one
    kind its model is uniform.  The counts are at most ``2 * STATES ** 2`` rows.
    """
    runs = samples.where("random is not null").select(
        "random", F.explode(F.regexp_extract_all("string", F.lit("(" + RUN % 1 + ")"), F.lit(1))).alias("run")
    )
    counts = (
        runs.select("random", F.explode(_transitions(F.col("run"))).alias("t"))
        .groupBy("random", "t")
        .count()
        .collect()
    )
    log = {}
    for random in (True, False):
        n = {r["t"]: r["count"] for r in counts if r["random"] == random}
        for a in range(STATES):
            row = [n.get(a * STATES + b, 0) + smoothing for b in range(1, STATES)]
            log[random, a] = [math.log(x / sum(row)) for x in row]
    table = []
    for a in range(STATES):
        table += [0.0, *(x - y for x, y in zip(log[True, a], log[False, a]))]
    return Markov(tuple(table))


def labelled_samples(docs: DataFrame, n_docs: int = SAMPLE_DOCS, n_strings: int = SAMPLE_STRINGS) -> DataFrame:
    """Strings labelled random or ordinary, from at most ``n_docs`` documents.

    Random are the values that the base rules find in them, and digests written
    in base 64 and base 16.  Ordinary are the other token runs of documents in
    which no base rule finds anything.
    """
    spark = docs.sparkSession
    ids = docs.where("doc_id is not null").select("doc_id").orderBy(F.xxhash64("doc_id")).limit(n_docs)
    # At most n_docs numbers are broadcast.
    sample = docs.select("doc_id", "text").join(F.broadcast(ids.distinct()), "doc_id", "left_semi")
    body = F.coalesce(F.col("text"), F.lit(""))
    any_rule = F.lit(False)
    for pattern in PATTERNS.values():
        any_rule = any_rule | body.rlike(pattern)
    judged = sample.select(body.alias("body"), any_rule.alias("hit"))
    values = F.concat(
        F.regexp_extract_all("body", F.lit(PATTERNS["assign"]), F.lit(2)),
        F.regexp_extract_all("body", F.lit(PATTERNS["access"]), F.lit(0)),
        F.regexp_extract_all("body", F.lit(PATTERNS["hex"]), F.lit(0)),
    )
    found = judged.where("hit").select(F.explode(values).alias("string"))
    found = found.where(F.length("string") >= LEAST_VALUE)
    words = F.regexp_extract_all("body", F.lit("(" + RUN % LEAST_SAMPLE + ")"), F.lit(1))
    plain = judged.where("not hit").select(F.explode(words).alias("string"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    drawn = spark.range(n_strings).select(
        F.explode(F.array(F.substr(digest, F.lit(1), F.lit(32)), F.regexp_replace(F.base64(F.unhex(digest)), "=", ""))).alias("string")
    )
    return (
        found.unionByName(drawn).withColumn("random", F.lit(True))
        .unionByName(plain.withColumn("random", F.lit(False)))
    )


def _spans_of(matches: str, pieces: str, kind: int, ok: Column) -> Column:
    """Spans of the matches for which the boolean array ``ok`` is true."""
    rows = F.transform(matches, lambda m, i: F.struct(F.length(m).alias("n"), F.length(F.get(F.col(pieces), i)).alias("gap"), F.get(ok, i).alias("ok")))
    nothing = F.struct(F.lit(0).alias("pos"), F.array().cast(_SPANS).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["gap"]
        end = start + x["n"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(
            end.alias("pos"), F.when(x["ok"], F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out")
        )

    spans = F.aggregate(rows, nothing, step, lambda acc: acc["out"])
    return F.coalesce(spans, F.array().cast(_SPANS))


def find_spans(docs: DataFrame, model: Markov, text: str = "text") -> DataFrame:
    """Adds ``spans``: ``(start, kind, end)`` sorted, ``kind`` an index into ``KINDS``.

    A missing text counts as empty.  Markov spans never overlap base spans: what
    base spans leave of a run is judged, if it is long enough.
    """
    given = list(docs.columns)
    body = F.coalesce(F.col(text), F.lit(""))
    run = RUN % LEAST_RUN
    every = {**PATTERNS, "markov": run}

    def cut(pattern: str) -> list[Column]:
        hit = body.rlike(pattern)
        return [F.when(hit, F.regexp_extract_all(body, F.lit(pattern), F.lit(0))), F.when(hit, F.split(body, pattern))]

    value = F.when(body.rlike(PATTERNS["assign"]), F.regexp_extract_all(body, F.lit(PATTERNS["assign"]), F.lit(2)))
    arrays = docs.select(
        *given,
        value.alias("_values"),
        *[c.alias(f"_{part}_{kind}") for kind, p in every.items() for part, c in zip(("found", "gaps"), cut(p))],
    )
    table = model.column()

    def random(m: Column) -> Column:
        ratio = F.aggregate(_transitions(m), F.lit(0.0), lambda a, t: a + F.get(table, t))
        return (
            m.rlike("[A-Za-z]")
            & (ratio >= LEAST_RATIO)
            & (ratio >= F.length(m) * F.lit(LEAST_MEAN_RATIO))
        )

    ok = {
        "assign": F.transform("_values", lambda v: F.length(v) >= LEAST_VALUE),
        "access": F.transform("_found_access", lambda v: F.lit(True)),
        "hex": F.transform("_found_hex", lambda v: F.lit(True)),
        "markov": F.transform("_found_markov", lambda v: F.lit(True)),
    }
    flags = arrays.select("*", *[c.alias(f"_ok_{kind}") for kind, c in ok.items()])
    kinds = flags.select(
        *given, "_found_markov",
        *[_spans_of(f"_found_{k}", f"_gaps_{k}", i, F.col(f"_ok_{k}")).alias(f"_spans_{k}") for i, k in enumerate(KINDS)],
    )
    base = F.array_sort(F.concat(*[F.col(f"_spans_{k}") for k in PATTERNS]))
    based = kinds.select(*given, "_found_markov", "_spans_markov", base.alias("_base"))

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(KINDS.index("markov")).alias("kind"), end.alias("end"))

    def left_of(s: Column, i: Column) -> Column:
        """Pieces of a run between base spans, with their characters."""

        def step(acc: Column, b: Column) -> Column:
            gap = F.concat(acc["out"], F.array(span(acc["pos"], b["start"])))
            return F.struct(
                F.greatest(acc["pos"], b["end"]).alias("pos"),
                F.when(b["start"] > acc["pos"], gap).otherwise(acc["out"]).alias("out"),
            )

        within = F.filter("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        nothing = F.struct(s["start"].alias("pos"), F.array().cast(_SPANS).alias("out"))
        gaps = F.aggregate(within, nothing, step, lambda acc: F.concat(acc["out"], F.array(span(acc["pos"], s["end"]))))
        run = F.get(F.col("_found_markov"), i)
        return F.transform(
            F.filter(gaps, lambda g: g["end"] - g["start"] >= LEAST_RUN),
            lambda g: F.struct(
                g.alias("span"), F.substr(run, g["start"] - s["start"] + 1, g["end"] - g["start"]).alias("token")
            ),
        )

    pieces = based.select(*given, "_base", F.flatten(F.transform("_spans_markov", left_of)).alias("_pieces"))
    judged = F.transform(F.filter("_pieces", lambda x: random(x["token"])), lambda x: x["span"])
    return pieces.select(*given, F.array_sort(F.concat("_base", judged)).alias("spans"))


def spans_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, model: Markov) -> DataFrame:
    """One row per row of ``docs``: counts of the base rules, digest of their spans, all spans."""
    found = find_spans(docs.select("doc_id", "text"), model).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"] < len(PATTERNS))

    def count(kind: str) -> Column:
        k = KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"), count("access"), count("hex"),
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
        count("markov"),
    )


def redact(docs: DataFrame, model: Markov) -> DataFrame:
    """The documents with every span replaced by ``MASK``, ``n_chars`` counted again if given.

    Overlapping spans become one mask.  Texts without a span are returned as they are.
    """
    # The given row is one column, so that no name of its own can clash.
    found = find_spans(docs.select(F.struct("*").alias("_row"), "text"), model)
    nothing = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substr(F.col("text"), acc["pos"] + 1, s["start"] - acc["pos"])
        return F.when(
            s["start"] >= acc["pos"],
            F.struct(s["end"].alias("pos"), F.concat(acc["out"], between, F.lit(MASK)).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), acc["out"].alias("out")))

    masked = F.aggregate(
        "spans", nothing, step, lambda acc: F.concat(acc["out"], F.substr(F.col("text"), acc["pos"] + 1, F.length("text")))
    )
    some = F.size("spans") > 0
    new = found.withColumn("_masked", F.when(some, masked))
    columns = [
        F.when(some, F.col("_masked")).otherwise(F.col("text")).alias("text") if name == "text"
        else F.when(some, F.length("_masked").cast(docs.schema[name].dataType)).otherwise(F.col("_row")[name]).alias(name) if name == "n_chars"
        else F.col("_row")[name].alias(name)
        for name in docs.columns
    ]
    return new.select(*columns)


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan(docs, train(labelled_samples(docs)))
