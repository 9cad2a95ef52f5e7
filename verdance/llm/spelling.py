"""Spelling variants: words one edit apart, found by products of blocks of letter counts.

One inserted, deleted or replaced letter changes a word's letter counts by a
squared distance of one or two.  Words are dealt to cells by their length and by
how their letters fall into ``GROUPS`` groups; words one edit apart lie in the
same cell or in cells next to each other, so a cell meets its neighbours alone.
In a cell the squared distances of a block of words to all others are a Gram
matrix, a NumPy product of letter counts; pairs at one (lengths that differ by
one) or two (equal lengths) are verified letter by letter.

A cell of many words is cut into blocks, each met by the cell's neighbours in
stretches of bounded size, and a stretch sends one row per word, not its pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.llm.words import small_batches, utf8
from verdance.session import materialise

SHORTEST = 5
LEAST = 3
#: One in so many runs loses a letter.
EVERY = 97
GROUPS = 4
BLOCK = 4096
#: Distinct words that a task holds while it counts.
HELD = 500_000
CHARSET = "ISO-8859-1"
# a-z and À-ÿ.
LETTERS = 26 + 64

_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{SHORTEST},}}")


def word_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``word, n`` of words of at least five letters that occur ``least`` times.

    A word is a maximal run of letters, A-Z lower-cased.  With ``h`` the CRC-32
    of ``<doc_id>:<word>``, words whose ``h`` is divisible by 97 lose the letter
    at ``h`` modulo their length.  A missing ``doc_id`` counts as an empty one.
    """
    small_batches(docs.sparkSession)

    def table(counts: dict):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"]
        )

    def count(batches: Iterator) -> Iterator:
        total: dict[str, int] = {}
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, utf8(batch.column("text"))):
                begun = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                runs = Counter(_RUN.findall(text.lower().decode("utf-8", "replace")))
                for run, n in runs.items():
                    h = zlib.crc32(run.encode(), begun)
                    if h % EVERY == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < SHORTEST:
                            continue
                    total[run] = total.get(run, 0) + n
                if len(total) > HELD:
                    yield table(total)
                    total = {}
        yield table(total)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = plain.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each word; ``codes`` has a row of ISO-8859-1 letters per word."""
    n, length = codes.shape
    # Letters are numbered a-z, then À-ÿ.
    numbers = np.where(codes < 128, codes - 97, codes - 166)
    flat = numbers + LETTERS * np.arange(n)[:, None]
    counts = np.bincount(flat.ravel(), minlength=LETTERS * n).reshape(n, LETTERS)
    # Products are exact while sums of squared lengths are below the number's precision.
    return counts.astype(np.float32 if length < 2000 else np.float64)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letter codes differ by exactly one edit; ``b`` is as long or longer by one."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate(a[:, ::-1] == b[:, :0:-1], axis=1).sum(axis=1)
    return front + back >= a.shape[1]


def cell_of(words: DataFrame) -> DataFrame:
    """Adds ``cell``: how many letters of a word are in each group; their sum is its length."""

    def letters_in(group: int) -> Column:
        return F.size(F.filter(F.split("word", ""), lambda c: (c != "") & (F.ascii(c) % GROUPS == group)))

    return words.withColumn("cell", F.array(*map(letters_in, range(GROUPS))))


def neighbours() -> list[tuple[int, ...]]:
    """Steps from a cell to itself and, in one direction only, to the cells that one edit can reach."""
    unit = [tuple(int(i == g) for i in range(GROUPS)) for g in range(GROUPS)]
    moved = [
        tuple(x - y for x, y in zip(unit[i], unit[j])) for i in range(GROUPS) for j in range(i + 1, GROUPS)
    ]
    return [(0,) * GROUPS, *moved, *unit]


def blocks_and_visitors(words: DataFrame) -> DataFrame:
    """``cell, block, side, word, n``: the words of a block (side 0) and all that it meets.

    Side 1 are words of the same cell, which find their own partners in blocks
    of their own; side 2 those of neighbours, found from here for both.
    """
    counts = words.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    counts = materialise(counts, "cells")
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    own = words.join(counts, "cell").select("cell", block.alias("block"), F.lit(0).alias("side"), "word", "n")
    steps = F.array(*(F.array(*(F.lit(x) for x in step)) for step in neighbours()))
    visits = words.select(F.posexplode(steps).alias("step", "by"), F.col("cell").alias("home"), "word", "n").select(
        F.zip_with("home", "by", lambda x, y: x - y).alias("cell"),
        F.when(F.col("step") == 0, 1).otherwise(2).alias("side"), "word", "n",
    )
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    visits = visits.join(counts, "cell").select("cell", every, "side", "word", "n")
    return own.unionByName(visits)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, form, form_n`` of words with a near word; ``words`` has ``word, n``.

    ``form`` is the near word with the largest ``n``, of equal ones the first.
    """

    def rows(names: np.ndarray, others: np.ndarray, own: np.ndarray, other: np.ndarray, n: np.ndarray):
        """Per word the number of its partners and the best one; names are letters, the rest places and sizes."""
        import pyarrow as pa

        used, back = np.unique(other, return_inverse=True)
        spelt = [others[i].tobytes() for i in used.tolist()]
        rank = np.empty(len(used), np.int64)
        rank[sorted(range(len(used)), key=spelt.__getitem__)] = np.arange(len(used))
        order = np.lexsort((rank[back], -n[other], own))
        own, back = own[order], back[order]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        best = back[first].tolist()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([names[i].tobytes() for i in own[first].tolist()], pa.binary()),
                pa.array(np.diff(np.append(first, len(own))), pa.int64()),
                pa.array([spelt[i] for i in best], pa.binary()), pa.array(n[used[best]], pa.int64()),
            ],
            names=["word", "n_near", "form", "form_n"],
        )

    class Home:
        """A block of words of one cell, and the matrix by which visitors are multiplied."""

        def __init__(self, codes: np.ndarray, n: np.ndarray):
            self.codes, self.n = codes, n
            counts = letter_counts(codes)
            # Letters of the block alone add to products; lengths of vectors stand beside them.
            self.letters = np.flatnonzero(counts.any(axis=0))
            square = (counts * counts).sum(axis=1, keepdims=True)
            self.matrix = np.concatenate((-2 * counts[:, self.letters], square, np.ones_like(square)), axis=1)

        def meet(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            counts = letter_counts(codes).astype(self.matrix.dtype)
            square = (counts * counts).sum(axis=1, keepdims=True)
            other = np.concatenate((counts[:, self.letters], np.ones_like(square), square), axis=1)
            distance = self.matrix @ other.T
            p, q = np.nonzero(distance == (2 if self.codes.shape[1] == codes.shape[1] else 1))
            right = [one_edit(self.codes[p[i : i + 65536]], codes[q[i : i + 65536]]) for i in range(0, len(p), 65536)]
            right = np.concatenate(right) if right else np.empty(0, bool)
            return p[right], q[right]

    def compare(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        now, held, home = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column("cell").dictionary_encode()
            names = cells.dictionary.to_pylist()
            of, block, side, n = (
                x.to_numpy(zero_copy_only=False) for x in (cells.indices, *(batch.column(c) for c in ("block", "side", "n")))
            )
            words = batch.column("word").cast(pa.large_binary())
            length = pc.binary_length(words).to_numpy(zero_copy_only=False)
            letters = np.frombuffer(b"".join(words.to_pylist()), np.uint8)
            ends = np.concatenate(([0], np.cumsum(length)))
            new = np.ones(len(of), bool)
            new[1:] = (of[1:] != of[:-1]) | (block[1:] != block[:-1]) | (side[1:] != side[:-1]) | (length[1:] != length[:-1])
            starts = np.flatnonzero(new).tolist()
            for i, j in zip(starts, [*starts[1:], len(of)]):
                if (key := (names[of[i]], int(block[i]))) != now:
                    now, held, home = key, [], None
                codes = letters[ends[i] : ends[j]].reshape(j - i, int(length[i]))
                if side[i] == 0:
                    held.append((codes, n[i:j]))
                    continue
                if not held:  # a visitor to a cell of which this block has no word
                    continue
                home = home or Home(*(np.concatenate(x) for x in zip(*held)))
                p, q = home.meet(codes)
                if not len(p):
                    continue
                yield rows(home.codes, codes, p, q, n[i:j])
                if side[i] == 2:
                    yield rows(codes, home.codes, q, p, home.n)

    placed = blocks_and_visitors(cell_of(words))
    # Letters go to and from the workers as single bytes, in the order of their code points.
    placed = placed.select(F.concat_ws(",", "cell").alias("cell"), "block", "side", F.encode("word", CHARSET).alias("word"), "n")
    ordered = placed.repartition("cell", "block").sortWithinPartitions("cell", "block", "side", F.octet_length("word"))
    found = ordered.mapInArrow(compare, "word binary, n_near long, form binary, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        F.decode("word", CHARSET).alias("word"), "n_near", F.decode("best.form", CHARSET).alias("form"),
        (-F.col("best.less")).alias("form_n"),
    )


def with_roots(variants: DataFrame) -> DataFrame:
    """Adds ``root``: the last word on the way from a word over forms.

    Every step at least doubles the frequency, and every round the steps taken,
    so the rounds are bounded by the logarithm of a number's bits.
    """
    steps = materialise(
        variants.where("form is not null").select("word", F.col("form").alias("root")), "roots"
    )
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = materialise(
            steps.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "roots",
        )
        if not steps.where("moved").limit(1).count():
            break
        steps = steps.drop("moved")
    return variants.join(steps.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words that occur often enough.

    Two words are near if one inserted, deleted or replaced letter makes one of
    the other.  The form is the near word of largest ``n`` if that is at least
    twice the word's.  Texts that are missing, empty or without letters add
    nothing, rows that repeat count each, and a table without words gives none.
    """
    words = materialise(word_counts(docs, least), "words")
    joined = words.join(near_words(words), "word", "left")
    kept = F.col("form_n") >= 2 * F.col("n")
    variants = joined.select(
        "word", F.when(kept, F.col("form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(kept, F.col("form_n")).alias("form_n"),
    )
    return with_roots(materialise(variants, "variants")).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# CRC-32 by its table, which a rule gives; 3988292384 is the reflected polynomial of the standard.
_CRC = """xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(octet_length(bytes)), lambda i: ('0x' || substr(hex(bytes), (2 * i + 1)::INTEGER, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"""

SPELLING_SQL = rf"""
WITH RECURSIVE crc_rows AS (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS i)
), crc AS (
  SELECT list(v ORDER BY i) AS crc_table FROM crc_rows
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents
), counted AS (
  SELECT run, count(*) AS n, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS bytes FROM runs WHERE length(run) >= {SHORTEST} GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, {_CRC} AS h FROM counted, crc
), altered AS (
  SELECT CASE WHEN h % {EVERY} = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM altered WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= {LEAST}
), shorter AS (
  SELECT word, n, length(word) AS size, i, word[1 : i - 1] || word[i + 1 :] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT DISTINCT s.word AS a, w.word AS b FROM shorter s JOIN words w ON w.word = s.rest
  UNION SELECT DISTINCT w.word, s.word FROM shorter s JOIN words w ON w.word = s.rest
  UNION SELECT DISTINCT s.word, t.word FROM shorter s JOIN shorter t ON s.rest = t.rest AND s.i = t.i AND s.size = t.size AND s.word <> t.word
), best AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS form, max(n) AS form_n
  FROM pairs JOIN words ON words.word = b GROUP BY a
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN form_n >= 2 * w.n THEN form END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word
), walk AS (
  SELECT word, word AS root FROM forms
  UNION ALL
  SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.root WHERE forms.form IS NOT NULL
), ends AS (
  SELECT walk.word, walk.root FROM walk JOIN forms ON forms.word = walk.root WHERE forms.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""
