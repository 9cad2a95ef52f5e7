"""Token totals by source, language and tokenizer version, maintained from signed changes.

A change names a document's count before and after: an insert has no count
before, a delete none after, a revision both.  A batch of changes is reduced to
one signed row per key, so its size is that of the keys, and totals are the sum
of the committed batches.

A batch is committed by one row that names its delta.  A batch that is applied
again finds its commit and changes nothing; two attempts that commit at the same
time count once, as readers take one attempt per batch.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.llm.token_files import encoder
from verdance.llm.words import small_batches
from verdance.session import materialise, shared_dir

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"
COMMIT = "batch string, attempt string, folds array<string>"


def _word_counter(path: str) -> Callable:
    def count(texts) -> list[int]:
        import numpy as np

        _, ends = encoder(path).encode(texts)
        return (np.diff(ends, prepend=0) - 1).tolist()

    return count


_BYTE_ENCODINGS: dict = {}


def _byte_counter(path: str, pattern: str) -> Callable:
    def count(texts) -> list[int]:
        import tiktoken

        if path not in _BYTE_ENCODINGS:
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            _BYTE_ENCODINGS[path] = tiktoken.Encoding(
                "bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            )
        encode = _BYTE_ENCODINGS[path].encode_ordinary
        return [len(encode(t or "")) for t in texts.to_pylist()]

    return count


def counters(folder: Callable[[str], str], pattern: str) -> dict[str, Callable]:
    """Counting functions by tokenizer version; ``folder`` gives a vocabulary file's place."""
    return {
        "word_bpe_49k": _word_counter(folder("word_bpe_49k.json")),
        "byte_bpe_50k": _byte_counter(folder("byte_bpe_50k.tiktoken"), pattern),
    }


def with_counts(texts: DataFrame, count_by: dict[str, Callable]) -> DataFrame:
    """Adds ``n_tokens`` under the version that the column ``tokenizer`` names; drops ``text``.

    A missing text has no tokens; an unknown or missing version gives NULL.  A
    column of that name in ``texts`` is replaced.
    """
    small_batches(texts.sparkSession)
    others = [f for f in texts.schema if f.name not in ("text", "n_tokens")]

    def count(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            version = batch.column("tokenizer")
            out = np.zeros(batch.num_rows, np.int64)
            known = np.zeros(batch.num_rows, bool)
            for name, counter in count_by.items():
                mask = pc.fill_null(pc.equal(version, name), False)
                at = np.flatnonzero(mask.to_numpy(zero_copy_only=False))
                if len(at):
                    out[at] = counter(batch.column("text").take(pa.array(at)))
                    known[at] = True
            columns = [batch.column(f.name) for f in others]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(out, mask=~known)], names=[*[f.name for f in others], "n_tokens"]
            )

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in others], "n_tokens long"])
    return texts.mapInArrow(count, schema)


def signed_delta(changes: DataFrame) -> DataFrame:
    """One row per key of ``source, lang, tokenizer, old_tokens, new_tokens`` changes.

    NULL is the absence of a count; a NULL source, language or version is a
    key of its own.  Keys whose documents and tokens cancel out are left out.
    """
    there = lambda c: F.col(c).isNotNull().cast("long")
    value = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    return (
        changes.groupBy(*KEYS)
        .agg(
            F.sum(there("new_tokens") - there("old_tokens")).alias("docs"),
            F.sum(value("new_tokens") - value("old_tokens")).alias("tokens"),
        )
        .where("docs <> 0 or tokens <> 0")
    )


class Rollup:
    """Totals kept below ``path``; batches may be applied in any order, each counts once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _commits(self) -> list:
        """One row per batch; as many as were applied since the last compaction."""
        try:
            rows = self.spark.read.schema(COMMIT).parquet(f"{self.path}/commits/*").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        winners: dict = {}
        for row in sorted(rows, key=lambda r: r.attempt):
            winners.setdefault(row.batch, row)
        return list(winners.values())

    def batches(self) -> set[str]:
        """All batches that count, folded ones too."""
        rows = self._commits()
        return {r.batch for r in rows} | {b for r in rows for b in r.folds}

    def _write(self, batch: str, delta: DataFrame, folds: Sequence[str]) -> None:
        attempt = uuid.uuid4().hex
        delta.select("source", "lang", "tokenizer", "docs", "tokens").write.parquet(f"{self.path}/deltas/{attempt}")
        row = self.spark.createDataFrame([(batch, attempt, list(folds))], COMMIT)
        row.coalesce(1).write.parquet(f"{self.path}/commits/{attempt}")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commits a batch of changes; False if it was committed before."""
        if batch in self.batches():
            return False
        self._write(batch, signed_delta(changes), [])
        return True

    def _active(self) -> list:
        """The commits whose deltas add up to the totals, each batch once.

        Two compactions that ran at once may have folded the same batches.  The
        one of the smaller attempt counts, the other is void, and what it folded
        beyond stays with its own delta; deltas are kept.
        """
        rows = self._commits()
        made = sorted((r for r in rows if r.folds), key=lambda r: r.attempt)
        names = {r.batch for r in made}
        accepted: list = []
        for fold in made:
            own = set(fold.folds) - names
            nested = lambda other: other.batch in fold.folds or fold.batch in other.folds  # noqa: B023, E731
            if all(nested(other) or not own & set(other.folds) for other in accepted):
                accepted.append(fold)
        folded = {b for r in accepted for b in r.folds}
        counted = {r.batch for r in accepted}
        return [r for r in rows if r.batch not in folded and (not r.folds or r.batch in counted)]

    def _sum(self, rows: list) -> DataFrame:
        if not rows:
            return self.spark.createDataFrame([], DELTA)
        deltas = self.spark.read.schema(DELTA).parquet(*[f"{self.path}/deltas/{r.attempt}" for r in rows])
        return (
            deltas.groupBy(*KEYS)
            .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
            .where("docs <> 0 or tokens <> 0")
        )

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, docs, tokens`` over all committed batches."""
        return self._sum(self._active())

    def compact(self) -> None:
        """Folds the committed batches into one delta that remembers their ids."""
        rows = self._active()
        if len(rows) > 1:
            folds = [r.batch for r in rows] + [b for r in rows for b in r.folds]
            self._write(f"fold-{uuid.uuid4().hex}", self._sum(rows), folds)


def _change(old: str | None, new: str | None, tokenizer: str) -> list[Column]:
    count = lambda c: (F.col(c) if c else F.lit(None)).cast("long")
    return [
        F.col("source"), F.col("lang"), F.lit(tokenizer).alias("tokenizer"),
        count(old).alias("old_tokens"), count(new).alias("new_tokens"),
    ]


def rollup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after a load, an upgrade of the tokenizer, a revision and a withdrawal.

    All documents are loaded under the word tokenizer; English ones are then
    counted by the byte tokenizer instead, documents with repeated lines are
    revised to their distinct lines, and toxic ones are withdrawn.  The upgrade
    is applied twice, and the batches are folded.
    """
    import public_tokenizers

    old, new = "word_bpe_49k", "byte_bpe_50k"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    toxic = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 1").select("doc_id").distinct()
    given = docs.select(
        "doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    lines = F.split("text", "\n")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))

    def variant(role: str, tokenizer: Column, text: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), tokenizer.alias("tokenizer"), text.alias("text"))

    variants = F.array(
        variant("loaded", F.lit(old), F.col("text")),
        F.when(english, variant("upgraded", F.lit(new), F.col("text"))),
        F.when(
            F.size(F.array_distinct(lines)) < F.size(lines),
            variant("revised", F.when(english, new).otherwise(old), F.array_join(F.array_distinct(lines), "\n")),
        ),
    )
    texts = given.select("row", "doc_id", "source", "lang", F.explode(variants).alias("v")).where("v is not null")
    counted = with_counts(
        texts.select("row", "doc_id", "source", "lang", "v.*"), counters(public_tokenizers.path, public_tokenizers.PATTERN)
    )
    of = lambda role: F.max(F.when(F.col("role") == role, F.col("n_tokens"))).alias(role)
    counts = materialise(counted, "counts").groupBy("row", "doc_id", "source", "lang").agg(
        of("loaded"), of("upgraded"), of("revised")
    )
    counts = counts.withColumn("current", F.coalesce("upgraded", "loaded")).withColumn("last", F.coalesce("revised", "current"))

    def under_own(rows: DataFrame, before: str, after: str | None) -> DataFrame:
        return rows.where(english).select(*_change(before, after, new)).unionByName(
            rows.where(~english).select(*_change(before, after, old))
        )

    rollup = Rollup(spark, shared_dir(spark, "rollup"))
    upgrade = counts.where(english).select(*_change("loaded", None, old)).unionByName(
        counts.where(english).select(*_change(None, "upgraded", new))
    )
    rollup.apply("load", counts.select(*_change(None, "loaded", old)))
    rollup.apply("upgrade", upgrade)
    rollup.apply("revise", under_own(counts.where("revised is not null"), "current", "revised"))
    rollup.apply("upgrade", upgrade)
    rollup.apply("withdraw", under_own(counts.join(toxic, "doc_id", "left_semi"), "last", None))
    rollup.compact()
    return rollup.totals()
