"""Phrase collocations: frequent n-grams by Misra-Gries summaries, then exact counts and scores.

N-grams are dealt to hash partitions.  A task sends one summary per partition
and ``FLUSH`` n-grams, exact as it is far below capacity, and the summaries of a
partition are merged with a capacity that exceeds the partition's mass divided
by the least frequency.  A merged summary errs by less than that frequency, so
every frequent n-gram survives.  Single words and pairs come first; longer
n-grams are summarised only where all their pairs survive.

Survivors become a bitmap of fixed size, by which a last pass counts phrases
exactly and as text.  What the bitmap lets through by chance is counted as well
and falls to the exact threshold, so the result does not depend on its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdance.llm.words import mixed, small_batches, utf8
from verdance.session import materialise

LONGEST = 5
LEAST = 100
TOP = 2000
NO_LANGUAGE = "und"
#: Fixed size of the bitmap of survivors: eight megabytes.
FILTER_BITS = 26
#: N-grams in a summary of a task, and bytes of text that are hashed at a time.
FLUSH = 4 << 20
CHUNK = 4 << 20
#: Counters of a hash partition that merging aims at, and the least number of partitions.
COUNTERS = 1 << 18
LEAST_PARTITION_BITS = 8

# Fixed by the definition of pieces and words.
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_GAPS = b" \t"

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bases of two polynomial hashes; odd, so that their powers can be inverted.
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def _byte_class() -> np.ndarray:
    """0 in words, 1 between words, 2 between pieces."""
    kind = np.zeros(256, np.uint8)
    kind[list(_GAPS)] = 1
    kind[list(_BREAKS)] = 2
    return kind


_CLASS = _byte_class()


def byte_numbers(salt: int, kinds: np.ndarray = _CLASS) -> np.ndarray:
    """A number per byte, the same for A-Z and a-z, none for bytes outside words."""
    codes = np.arange(256)
    lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(np.uint64)
    return np.where(kinds == 0, mixed((lower + np.uint64(1)) * _STEP + np.uint64(salt)), np.uint64(0))


_LETTERS = tuple(map(byte_numbers, (1, 2)))


class Powers:
    """Powers of an odd number and of its inverse, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = (np.ones(1, np.uint64) for _ in range(2))

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate((self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))))
            self.down = np.concatenate((self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))))
        return self.up[:n], self.down


_POWERS = tuple(map(Powers, _BASES))


class Text:
    """Words of some texts as places in one run of bytes; ``left`` counts words to the piece's end."""

    #: Kinds of bytes, and numbers of those in words for two hash functions.
    kinds, letters = _CLASS, _LETTERS

    def __init__(self, texts: list[bytes]):
        self.bytes = b"\n".join(texts)
        self.data = np.frombuffer(self.bytes, np.uint8)
        kind = self.kinds[self.data]
        inside = np.zeros(len(kind) + 2, np.int8)
        inside[1:-1] = kind == 0
        edge = np.diff(inside)
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        breaks = np.flatnonzero(kind == 2)
        piece = np.searchsorted(breaks, self.start)
        last = np.searchsorted(piece, piece, side="right")
        self.left = last - np.arange(len(piece))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, number: int = 0) -> np.ndarray:
        """Hashes of the words by one of two hash functions, a stretch of ``CHUNK`` bytes at a time."""
        out, i = np.empty(len(self), np.uint64), 0
        letters, powers = self.letters[number], _POWERS[number]
        while i < len(self):
            at = int(self.start[i])
            j = max(i + 1, int(np.searchsorted(self.end, at + CHUNK, side="right")))
            part = self.data[at : int(self.end[j - 1])]
            up, down = powers.upto(len(part))
            starts = self.start[i:j] - at
            out[i:j] = np.add.reduceat(letters[part] * up, starts) * down[starts]
            i = j
        return mixed(out)

    def phrase(self, first: int, n: int) -> str:
        """``n`` words from the word numbered ``first``, joined by a space."""
        run = self.bytes[int(self.start[first]) : int(self.end[first + n - 1])]
        return b" ".join(run.lower().split()).decode("utf-8", "replace")


def language_seed(lang: str) -> np.uint64:
    import xxhash

    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def extend(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of n-grams made longer by one word each."""
    return mixed(h * _STEP + words)


class Bitmap:
    """A set of hashes by their leading bits, with false members but without missing ones."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, np.uint8)
        self.shift = np.uint64(64 - (len(bits) * 8 - 1).bit_length())

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> self.shift
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def grams(words: np.ndarray, left: np.ndarray, seed: np.uint64, pairs: Bitmap | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(n, first words, hashes)`` of single words and pairs, and with a bitmap of longer n-grams.

    Beyond pairs only n-grams all of whose pairs are in the bitmap are given.
    """
    at, h = np.arange(len(words)), mixed(words ^ seed)
    yield 1, at, h
    keep = left >= 2
    at, h = at[keep], h[keep]
    h = extend(h, words[at + 1])
    yield 2, at, h
    if pairs is None:
        return
    known = np.zeros(len(words) + 1, bool)
    known[at] = pairs.has(h)
    keep = known[at]
    at, h = at[keep], h[keep]
    for n in range(3, LONGEST + 1):
        keep = known[at + n - 2] & (left[at] >= n)
        at, h = at[keep], h[keep]
        h = extend(h, words[at + n - 1])
        yield n, at, h


def by_language(batches: Iterator) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language, about ``CHUNK`` bytes at a time."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), utf8(batch.column("text"))):
            held.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] >= CHUNK:
                yield lang, held.pop(lang)
                size.pop(lang)
    yield from held.items()


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers with their first, second, third and fourth bytes together, which compresses well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


class Summary:
    """Misra-Gries counters of 32-bit codes, mergeable; exact while they are at most ``capacity``.

    A count is too low by at most ``error``, and by less than ``least`` as long
    as ``capacity * least`` exceeds the mass of all that is added.
    """

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.codes, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.held.append((codes, counts))
        self.waiting += len(codes)
        if self.waiting > max(2 * self.capacity, 1 << 16):
            self.merge()

    def merge(self) -> None:
        codes = np.concatenate([self.codes, *(c for c, _ in self.held)])
        counts = np.concatenate([self.counts, *(n for _, n in self.held)])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.empty(0, np.int64)
        self.codes, self.counts = codes[first], np.add.reduceat(counts, first) if len(first) else counts
        self.held, self.waiting = [], 0
        if len(self.codes) > self.capacity:
            over = len(self.codes) - self.capacity - 1
            cut = int(np.partition(self.counts, over)[over])
            left = self.counts > cut
            self.codes, self.counts = self.codes[left], self.counts[left] - cut
            self.error += cut

    def frequent(self, least: int) -> np.ndarray:
        """Codes that may occur ``least`` times."""
        self.merge()
        return self.codes[self.counts + self.error >= least]


def partition_summaries(texts: DataFrame, partition_bits: int, pairs) -> DataFrame:
    """``part, kind, mass, codes, counts``: masses (kind 0) and summaries (kind 1) of hash partitions.

    Words and pairs without ``pairs``, else longer n-grams; ``pairs`` is a broadcast bitmap.
    """
    shift, low = np.uint64(64 - partition_bits), np.uint64(32 - partition_bits)

    def summary(hashes: list[np.ndarray]):
        import pyarrow as pa

        found = np.concatenate(hashes)
        found.sort()
        first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        counts = np.diff(np.append(first, len(found)))
        found = found[first]
        codes = (found >> low).astype(np.uint32)  # of the bits that follow the partition's
        part = (found >> shift).astype(np.int64)
        edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        rows = [[], [], [], [], []]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            number = int(part[a])
            data = packed(np.diff(codes[a:b], prepend=np.uint32(0)))
            for row in ((number, 0, int(counts[a:b].sum()), None, None), (number, 1, None, data, packed(counts[a:b]))):
                for column, value in zip(rows, row):
                    column.append(value)
        types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows, types)], names=["part", "kind", "mass", "codes", "counts"]
        )

    def summarise(batches: Iterator) -> Iterator:
        bitmap = Bitmap(pairs.value) if pairs is not None else None
        wanted = (1, 2) if bitmap is None else range(3, LONGEST + 1)
        held, size = [], 0
        for lang, some in by_language(batches):
            text = Text(some)
            for n, _, h in grams(text.hashes(), text.left, language_seed(lang), bitmap):
                if n in wanted and len(h):
                    held.append(h)
                    size += len(h)
            if size >= FLUSH:
                yield summary(held)
                held, size = [], 0
        if size:
            yield summary(held)

    return texts.mapInArrow(summarise, "part long, kind int, mass long, codes binary, counts binary")


def survivors(summaries: DataFrame, least: int, partition_bits: int) -> bytes:
    """The bitmap of n-grams that may be frequent; every hash partition fills its own stretch of it."""
    slice_bits = FILTER_BITS - partition_bits

    def merge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def done(number: int, merged: Summary):
            marks = np.zeros(1 << slice_bits, np.uint8)
            marks[merged.frequent(least) >> np.uint32(32 - slice_bits)] = 1
            data = np.packbits(marks, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([data], pa.binary())], names=["part", "bits"]
            )

        now, mass, merged = None, 0, None
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("part", "kind", "mass", "codes", "counts"))
            for part, kind, some, codes, counts in zip(*columns):
                if part != now:
                    if merged is not None:
                        yield done(now, merged)
                    now, mass, merged = part, 0, None
                if kind == 0:  # masses come before summaries
                    mass += some
                    continue
                merged = merged or Summary(mass // least + 1)
                merged.add(np.cumsum(unpacked(codes), dtype=np.uint32), unpacked(counts).astype(np.int64))
        if merged is not None:
            yield done(now, merged)

    ordered = summaries.repartition("part").sortWithinPartitions("part", "kind")
    size = 1 << max(0, slice_bits - 3)
    bits = bytearray(size << partition_bits)
    for row in ordered.mapInArrow(merge, "part long, bits binary").collect():
        bits[row.part * size : (row.part + 1) * size] = row.bits
    return bytes(bits)


def exact_counts(texts: DataFrame, short, long, least: int, partition_bits: int) -> DataFrame:
    """``lang, n_words, phrase, f`` of n-grams in the bitmaps with ``f >= least``, and all words.

    The number of all words has ``n_words`` 0 and no phrase.  A task combines by
    hash before it sends text; a second hash tells apart n-grams that share the
    first.  Phrases of a hash partition travel in one row per stretch of text,
    and are counted by their text.
    """
    shift = np.uint64(64 - partition_bits)

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        pairs, longer = Bitmap(short.value), Bitmap(long.value)
        for lang, some in by_language(batches):
            text, seed = Text(some), language_seed(lang)
            first, second = text.hashes(0), text.hashes(1)
            rows = [(0, "", packed(np.array([len(text)])))]
            for n, at, h in grams(first, text.left, seed, pairs):
                hit = (pairs if n <= 2 else longer).has(h)
                at, h = at[hit], h[hit]
                other = second[at]
                for k in range(1, n):
                    other = extend(other, second[at + k])
                order = np.lexsort((other, h))
                h, other, at = h[order], other[order], at[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (other[1:] != other[:-1])
                starts = np.flatnonzero(new)
                counts, at = np.diff(np.append(starts, len(h))), at[starts]
                part = (h[starts] >> shift).astype(np.int64)
                edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else [0]
                for a, b in zip(edges[:-1], edges[1:]):
                    phrases = "\n".join([text.phrase(i, n) for i in at[a:b].tolist()])
                    rows.append((int(part[a]), phrases, packed(counts[a:b])))
            part, phrases, counts = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(rows), pa.string()), pa.array(part, pa.int64()), pa.array(phrases, pa.string()), pa.array(counts, pa.binary())],
                names=["lang", "part", "phrases", "counts"],
            )

    def merge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def done(lang: str, total: dict[str, int]):
            often = [(p, f) for p, f in total.items() if f >= least or not p]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(often), pa.string()),
                    pa.array([p.count(" ") + 1 if p else 0 for p, _ in often], pa.int32()),
                    pa.array([p or None for p, _ in often], pa.string()), pa.array([f for _, f in often], pa.int64()),
                ],
                names=["lang", "n_words", "phrase", "f"],
            )

        now, total = None, {}
        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("part", "lang", "phrases", "counts"))
            for part, lang, phrases, counts in zip(*columns):
                if (part, lang) != now:
                    if total:
                        yield done(now[1], total)
                    now, total = (part, lang), {}
                for phrase, f in zip(phrases.split("\n"), unpacked(counts).tolist()):
                    total[phrase] = total.get(phrase, 0) + f
        if total:
            yield done(now[1], total)

    rows = texts.mapInArrow(count, "lang string, part long, phrases string, counts binary")
    ordered = rows.repartition("part").sortWithinPartitions("part", "lang")
    return ordered.mapInArrow(merge, "lang string, n_words int, phrase string, f long")


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, n_words, phrase, f`` of all phrases of 1 to 5 words with ``f >= least``.

    ``n_words`` 0 is the number of all words of the language.  A missing text is
    empty, a missing language is ``und``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), "text"
    )
    # A word takes two bytes with its end, and starts up to five n-grams.
    size = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    counters = LONGEST * (size // 2) // least
    partition_bits = min(20, max(LEAST_PARTITION_BITS, (counters // COUNTERS).bit_length()))
    sent = []
    for _ in range(2):
        bits = survivors(partition_summaries(texts, partition_bits, sent[0] if sent else None), least, partition_bits)
        sent.append(spark.sparkContext.broadcast(bits))
    return materialise(exact_counts(texts, *sent, least, partition_bits), "phrases")


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, n_words, a, l, r, n, score`` of phrases of two words or more, by their weakest cut."""
    known = phrases.where("n_words > 0").select("lang", "phrase", "f")
    totals = phrases.where("n_words = 0").select("lang", F.col("f").alias("n"))
    words = F.split("phrase", " ")
    cuts = phrases.where("n_words > 1").select(
        "lang", "phrase", "n_words", F.col("f").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"), words.alias("words"),
    ).select(
        "lang", "phrase", "n_words", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("n_words") - F.col("k")), " ").alias("rest"),
    )

    def part(name: str, f: str) -> DataFrame:
        return known.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))

    joined = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    # Counts below 10^12 keep the products within 38 digits; the quotient is at most 1000 n / least.
    score = F.expr("(cast(1000 * a AS decimal(19,0)) * cast(n AS decimal(19,0))) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    weakest = joined.withColumn("score", score).groupBy("lang", "phrase", "n_words", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    return weakest.select("lang", "phrase", "n_words", "a", "cut.l", "cut.r", "n", "cut.score")


def inside_longer(phrases: DataFrame) -> DataFrame:
    """``lang, phrase`` of those that a phrase of one more word holds in all their occurrences.

    A longer phrase is never more frequent than its parts, so whatever holds a
    phrase in all occurrences has such a phrase between them.
    """
    longer = phrases.where("n_words > 2")
    words = F.split("phrase", " ")
    part = F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("n_words") - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.col("n_words") - 1), " "),
    ))
    return longer.select("lang", part.alias("phrase"), F.col("f").alias("a")).distinct()


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's first phrases: ``lang, rank, phrase, a, l, r, n, score``.

    Tables without rows, without words or without frequent phrases give none;
    rows that repeat count each.  Only ``lang`` and ``text`` are read.
    """
    phrases = frequent_phrases(docs, least)
    rest = scored(phrases).join(inside_longer(phrases), ["lang", "phrase", "a"], "left_anti")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = rest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    def number(name: str) -> Column:
        return F.col(name).cast("long").alias(name)

    return ranked.select("lang", number("rank"), "phrase", *map(number, ("a", "l", "r", "n", "score")))


def collocation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATION_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
         unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM split GROUP BY lang
), grams AS (
  SELECT lang, s.n_words, array_to_string(w[i : i + s.n_words - 1], ' ') AS phrase
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split WHERE len(w) > 0),
       (SELECT unnest(range(1, {LONGEST + 1})) AS n_words) s
  WHERE i + s.n_words - 1 <= len(w)
), counts AS (
  SELECT lang, n_words, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}
), cuts AS (
  SELECT lang, phrase, n_words, f AS a, k,
         array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, n_words)) AS k FROM counts WHERE n_words > 1)
), marked AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000 * c.a * t.n) // (x.f * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head
  JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest JOIN totals t ON t.lang = c.lang
), weakest AS (
  SELECT * FROM marked QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
  SELECT DISTINCT p.lang, p.phrase
  FROM counts p JOIN counts q ON q.lang = p.lang AND q.n_words > p.n_words AND 100 * q.f >= 100 * p.f
   AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ')
  WHERE p.n_words > 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM weakest WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM held)
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n,
       score::BIGINT AS score
FROM ranked WHERE rank <= {TOP}
"""
