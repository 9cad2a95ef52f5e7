"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Seeds are pairs of words at a distance of one or two, so that a pair survives
single words that are put between, taken out or replaced.  Of the pairs that
occur in the documents at all, the rarest of every short window of an item are
its seeds.  Seeds meet the documents' pairs by hash, as tables; each document and
item with a seed in common is then judged by alignment, behind an exact upper
bound: a span of ``n`` words with ``h`` words of the item scores at most
``MATCH h - COST (n - h)``.

``exact=True`` leaves the seeds out: it bounds every document against every item,
the benchmark being dealt to blocks of bounded size.  Alignments that share no
pair with their item, which seeds can't see, are found only so.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdance.llm.collocations import _STEP, CHUNK, Bitmap, Text, byte_numbers
from verdance.llm.words import mixed, small_batches, utf8, word_hashes
from verdance.session import materialise

#: Words that must match at least, or all of a shorter item.
GRAM = 3
#: Seeds are pairs of words at these distances; of each window of so many words so many are taken.
DISTANCES = (1, 2)
WINDOW, PER_WINDOW = 3, 2
#: Every pair of an item of up to so many words is a seed if it occurs.
SHORT_ITEM = 15
#: Fixed size of a bitmap of grams (two megabytes), and of its slices.
SEED_BITS, SLICE_BITS = 24, 6
ITEMS_PER_BLOCK = 1000
KNOWN_ITEMS = 10_000
BLOCK_WORDS = 1_000_000
MATCH, MISMATCH, GAP_COST = 2, -1, 1
#: Contaminated: a score of this share of the item's own, or of so many words' matches.
LEAST_RATIO = 0.5
LEAST_WORDS = 30
#: What a document's word inside an alignment costs at least if it matches nothing.
COST = min(-MISMATCH, GAP_COST)
#: Share of the least score up to which an item's most common words are left to the second bound.
COMMON_SHARE = 0.25
FILTER_BITS = 20
# White space ends words; nothing else does.
_KINDS = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r")).astype(np.uint8)


@dataclass(frozen=True)
class Items:
    """A block of benchmark items: word hashes of each."""

    ids: np.ndarray
    words: tuple[np.ndarray, ...]


def items_of(rows: list[tuple[int, bytes]]) -> Items:
    return Items(np.array([i for i, _ in rows], np.int64), tuple(word_hashes(text) for _, text in rows))


class Lookup:
    """Finds the words of a document that are in a sorted array."""

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        self.shift = np.uint64(64 - FILTER_BITS)
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[(grams >> self.shift).astype(np.int64)] = True

    def places(self, found: np.ndarray) -> np.ndarray:
        """Positions in ``found`` of hashes that are known."""
        at = np.flatnonzero(self.maybe[(found >> self.shift).astype(np.int64)])
        if not len(at):
            return at
        near = np.minimum(np.searchsorted(self.grams, found[at]), len(self.grams) - 1)
        return at[self.grams[near] == found[at]]


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """The items in blocks of about ``block_words`` words; items without words are left out."""
    given = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    given = given.where("item_id is not null and text is not null")
    total = given.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / 6 / block_words))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for number in range(blocks):
        rows = given.where(block == number).distinct().orderBy("item_id", "text").collect()
        items = items_of([(r.item_id, bytes(r.text)) for r in rows])
        if any(len(w) for w in items.words):
            yield items


def least_scores(sizes: np.ndarray) -> np.ndarray:
    """Least score that counts, by item size; at least ``GRAM`` words, or all of a shorter item, match."""
    share = np.minimum(LEAST_RATIO * MATCH * sizes, MATCH * LEAST_WORDS)
    return np.maximum(share, MATCH * np.minimum(GRAM, sizes))


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and the position after its last word in ``words``."""
    n = len(words)
    above = np.zeros(n + 1, np.int64)
    slope = GAP_COST * np.arange(n + 1)
    best, end = 0, 0
    for word in item:
        row = np.zeros(n + 1, np.int64)
        row[1:] = above[:-1] + np.where(words == word, MATCH, MISMATCH)
        np.maximum(row, above - GAP_COST, out=row)
        np.maximum(row, 0, out=row)
        # A gap along the row: the best earlier cell less its distance.
        above = np.maximum.accumulate(row + slope) - slope
        top = int(above.argmax())
        if above[top] > best:
            best, end = int(above[top]), top
    return best, end


def spans(own: np.ndarray, size: int, least: float, words: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of the words that hold every span in which an item may reach its least score.

    ``own`` are the item's distinct words in order, ``size`` is its length.
    """
    near = np.minimum(np.searchsorted(own, words), len(own) - 1)
    place = np.flatnonzero(own[near] == words)
    level = (MATCH + COST) * np.arange(len(place)) - COST * place
    lowest = np.minimum.accumulate(level)
    highest = np.maximum.accumulate(level[::-1])[::-1]
    place = place[highest - lowest + MATCH >= least]
    if not len(place):
        return []
    # No alignment goes over a gap that costs more than the whole item scores.
    cut = np.flatnonzero(COST * np.diff(place) > MATCH * size) + 1
    return [(int(p[0]), int(p[-1]) + 1) for p in np.split(place, cut)]


def match(passage: np.ndarray, own: np.ndarray, words: np.ndarray) -> tuple[int, float, int, int] | None:
    """``(score, ratio, first word, word after)`` of an item's passage in the words, if it counts."""
    least = float(least_scores(np.array([len(passage)]))[0])
    best, span = 0, (0, 0)
    for a, b in spans(own, len(passage), least, words):
        score, end = align(passage, words[a:b])
        if score > best:
            best, span = score, (a, a + end)
    if best < least:
        return None
    a, b = span
    _, back = align(passage[::-1], words[a:b][::-1])
    return best, best / (MATCH * len(passage)), b - back, b


class Aligner:
    """Judges one text after the other against a block of items.

    Most words of a text that some item holds are common ones.  So an item's
    most common words, at most ``spared`` places of it, are left out at first:
    had they all matched, the score would be higher by ``(MATCH + COST) spared``
    at most.  Items that reach their least score with that are bounded again
    with all their words, and then aligned.
    """

    def __init__(self, items: Items):
        self.items = items
        sizes = np.array([len(w) for w in items.words], np.int64)
        self.least = least_scores(sizes)
        spared = np.floor(COMMON_SHARE * self.least).astype(np.int64)
        self.need = self.least - (MATCH + COST) * spared
        self.sorted = [np.unique(w) for w in items.words]

        word, item = np.concatenate(items.words), np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((item, word))
        word, item = word[order], item[order]
        new = np.concatenate(([True], (word[1:] != word[:-1]) | (item[1:] != item[:-1])))
        copies = np.diff(np.append(np.flatnonzero(new), len(word)))
        word, item = word[new], item[new]
        _, at, spread = np.unique(word, return_inverse=True, return_counts=True)
        order = np.lexsort((-spread[at], item))
        places = np.cumsum(copies[order])
        before = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        rare = np.empty(len(word), bool)
        rare[order] = places - before[item[order]] > spared[item[order]]
        self.known, self.start, self.many = np.unique(word[rare], return_index=True, return_counts=True)
        self.holder = item[rare].astype(np.uint16 if len(sizes) <= 1 << 16 else np.int64)
        self.lookup = Lookup(self.known)

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Items that may be in the words by their rarer words, in order."""
        hits = self.lookup.places(words)
        at = np.searchsorted(self.known, words[hits])
        many = self.many[at]
        total = int(many.sum())
        index = np.arange(total) + np.repeat(self.start[at] - (np.cumsum(many) - many), many)
        item, place = self.holder[index], np.repeat(hits, many)
        enough = MATCH * np.bincount(item, minlength=len(self.need)) >= self.need
        kept = enough[item]
        item, place = item[kept], place[kept]
        order = np.argsort(item, kind="stable")
        item, place = item[order].astype(np.int64), place[order]
        # The best span that ends at a hit starts at the item's hit with the lowest level before it.
        level = (MATCH + COST) * np.arange(len(item)) - COST * place
        apart = item * ((MATCH + COST) * total + COST * len(words) + 1)
        lowest = np.minimum.accumulate(level - apart) + apart
        return np.unique(item[level - lowest + MATCH >= self.need[item]])

    def matches(self, text: bytes) -> list[tuple[int, int, float, int, int]]:
        """``(item, score, ratio, first word, word after)`` of items whose passage is in the text."""
        words = word_hashes(text)
        out = []
        for number in self.candidates(words).tolist():
            found = match(self.items.words[number], self.sorted[number], words)
            if found:
                out.append((int(self.items.ids[number]), *found))
        return out


class Plain(Text):
    """Words between white space alone, and which text each is in."""

    kinds = _KINDS
    letters = tuple(byte_numbers(salt, _KINDS) for salt in (1, 2))

    def __init__(self, texts: list[bytes]):
        super().__init__(texts)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        self.text = np.searchsorted(begins, self.start, side="right") - 1

    def seeds(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(distance, places of first words, hashes)``: words alone (0), and pairs at one and two."""
        h = self.hashes()
        yield 0, np.arange(len(h)), mixed(h)
        for distance in DISTANCES:
            at = np.flatnonzero(self.text[distance:] == self.text[:-distance])
            yield distance, at, mixed(mixed(h[at]) * _STEP + h[at + distance])


def _several(batches: Iterator, *names: str) -> Iterator[tuple[list, ...]]:
    """Rows of a few columns, about ``CHUNK`` bytes of text at a time; the last column is the text."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in names), utf8(batch.column("text"))):
            held.append(row)
            size += len(row[-1])
            if size >= CHUNK:
                yield tuple(map(list, zip(*held)))
                held, size = [], 0
    if held:
        yield tuple(map(list, zip(*held)))


def _pair_rows(names: list[str], *columns):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def item_grams(items: DataFrame) -> DataFrame:
    """``gram, item, window`` of the items: their pairs, and the word of an item of one word."""

    def cut(batches: Iterator) -> Iterator:
        for keys, texts in _several(batches, "item"):
            text = Plain(texts)
            many = np.bincount(text.text, minlength=len(texts))
            first = np.concatenate(([0], np.cumsum(many)))
            keys = np.array(keys, np.int64)
            for distance, at, h in text.seeds():
                of = text.text[at]
                if distance == 0:
                    alone = many[of] == 1
                    at, h, of = at[alone], h[alone], of[alone]
                place = at - first[of]
                window = np.where(many[of] <= SHORT_ITEM, place, place // WINDOW)
                yield _pair_rows(["gram", "item", "window"], h.view(np.int64), keys[of], window)

    return items.select("item", "text").mapInArrow(cut, "gram long, item long, window long")


def gram_bitmap(grams: DataFrame) -> bytes:
    """The grams as a bitmap of ``SEED_BITS``, a fixed size; equal leading bits fill one slice of it."""
    slice_bits = SEED_BITS - SLICE_BITS

    def mark(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[int, np.ndarray] = {}
        for batch in batches:
            h = batch.column("gram").to_numpy(zero_copy_only=False).view(np.uint64)
            at = (h >> np.uint64(64 - SEED_BITS)).astype(np.int64)
            for number in np.unique(at >> slice_bits).tolist():
                marks = held.setdefault(number, np.zeros(1 << slice_bits, np.uint8))
                marks[at[at >> slice_bits == number] & ((1 << slice_bits) - 1)] = 1
        bits = [np.packbits(m, bitorder="little").tobytes() for m in held.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(bits, pa.binary())], names=["number", "bits"])

    number = F.shiftrightunsigned("gram", 64 - SLICE_BITS)
    dealt = grams.select("gram").distinct().repartition(number)
    size = 1 << slice_bits - 3
    out = bytearray(size << SLICE_BITS)
    for row in dealt.mapInArrow(mark, "number long, bits binary").collect():
        out[row.number * size : (row.number + 1) * size] = row.bits
    return bytes(out)


def gram_counts(docs: DataFrame, known) -> DataFrame:
    """``gram, docs``: in how many documents each gram of the broadcast bitmap occurs, as it reports them."""

    def count(batches: Iterator) -> Iterator:
        bitmap = Bitmap(known.value)
        for (texts,) in _several(batches):
            text = Plain(texts)
            found = []
            for _, at, h in text.seeds():
                hit = bitmap.has(h)
                found.append((h[hit], text.text[at[hit]]))
            h, of = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((of, h))
            h, of = h[order], of[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
            grams, docs_with = np.unique(h[new], return_counts=True)
            yield _pair_rows(["gram", "docs"], grams.view(np.int64), docs_with)

    counted = docs.select("text").mapInArrow(count, "gram long, docs long")
    return counted.groupBy("gram").agg(F.sum("docs").alias("docs"))


def choose_seeds(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """``gram, item``: of the grams that occur, the rarest ``PER_WINDOW`` of each window of an item."""
    order = W.partitionBy("item", "window").orderBy("docs", "gram")
    ranked = grams.distinct().join(counts, "gram").withColumn("place", F.row_number().over(order))
    return ranked.where(F.col("place") <= PER_WINDOW).select("gram", "item").distinct()


def seeded_pairs(docs: DataFrame, seeds: DataFrame, known) -> DataFrame:
    """``row, item`` of documents and items that share a seed, each once; ``docs`` has ``row, text``."""

    def find(batches: Iterator) -> Iterator:
        bitmap = Bitmap(known.value)
        for rows, texts in _several(batches, "row"):
            text = Plain(texts)
            rows = np.array(rows, np.int64)
            for _, at, h in text.seeds():
                hit = bitmap.has(h)
                yield _pair_rows(["row", "gram"], rows[text.text[at[hit]]], h[hit].view(np.int64))

    hits = docs.select("row", "text").mapInArrow(find, "row long, gram long").distinct()
    return hits.join(seeds, "gram").select("row", "item").distinct()


def _seeded(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, row, item_id, score, ratio, first_word, end_word`` of documents and items joined by seeds."""
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    items = items.distinct().withColumn("item", F.xxhash64("item_id", "text"))
    grams = materialise(item_grams(items), "item-grams")
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    counts = gram_counts(keyed, spark.sparkContext.broadcast(gram_bitmap(grams)))
    seeds = materialise(choose_seeds(grams, counts), "seeds")
    pairs = seeded_pairs(keyed, seeds, spark.sparkContext.broadcast(gram_bitmap(seeds)))
    # A document meets its items in blocks, so that a row of the alignment stays small.
    blocks = max(1, math.ceil(items.count() / ITEMS_PER_BLOCK))
    met = (
        pairs.join(items, "item")
        .groupBy("row", F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"))
        .agg(F.collect_list(F.struct("item_id", F.col("text").alias("item_text"))).alias("items"))
    )
    met = materialise(met, "seeded")

    def judge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def item(text: str) -> tuple[np.ndarray, np.ndarray]:
            if text not in known:
                if len(known) >= KNOWN_ITEMS:
                    known.clear()
                words = word_hashes(text.encode())
                known[text] = words, np.unique(words)
            return known[text]

        for batch in batches:
            out = []
            columns = (batch.column(n).to_pylist() for n in ("doc_id", "row", "items"))
            for doc_id, row, some, text in zip(*columns, utf8(batch.column("text"))):
                words = word_hashes(text)
                for one in some:
                    found = match(*item(one["item_text"]), words)
                    if found:
                        out.append((doc_id, row, one["item_id"], *found))
            columns = list(zip(*out)) if out else [()] * 7
            types = [pa.int64()] * 4 + [pa.float64()] + [pa.int64()] * 2
            names = ["doc_id", "row", "item_id", "score", "ratio", "first_word", "end_word"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    schema = "doc_id long, row long, item_id long, score long, ratio double, first_word long, end_word long"
    return keyed.join(met, "row").select("doc_id", "row", "items", "text").mapInArrow(judge, schema)


def _every_pair(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``_seeded`` without seeds: every document against every item, behind the bound."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, row long, item_id long, score long, ratio double, first_word long, end_word long"
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")

    def searcher(items: Items):
        def search(batches: Iterator) -> Iterator:
            import pyarrow as pa

            aligner = Aligner(items)
            for batch in batches:
                columns = (batch.column(n).to_pylist() for n in ("doc_id", "row"))
                rows = [
                    (i, row, *found) for i, row, text in zip(*columns, utf8(batch.column("text"))) for found in aligner.matches(text)
                ]
                columns = list(zip(*rows)) if rows else [()] * 7
                types = [pa.int64()] * 4 + [pa.float64()] + [pa.int64()] * 2
                names = ["doc_id", "row", "item_id", "score", "ratio", "first_word", "end_word"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        return search

    found = docs.sparkSession.createDataFrame([], schema)
    for items in benchmark_blocks(benchmark):
        found = found.unionByName(keyed.mapInArrow(searcher(items), schema))
    return found


def find_contamination(docs: DataFrame, benchmark: DataFrame, exact: bool = False) -> DataFrame:
    """One row per document row and benchmark item found in it.

    ``doc_id, item_id, score, ratio, first_word, end_word``; missing and empty
    texts match nothing, and items that are equal are reported each.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (_every_pair if exact else _seeded)(plain, benchmark).drop("row")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, exact: bool = False) -> DataFrame:
    """The documents in which no benchmark item is found, with all their columns."""
    key = F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = (_every_pair if exact else _seeded)(plain, benchmark).select("row").distinct()
    # The document is one column, so that no column of it can clash.
    whole = docs.select(key, F.struct(*docs.columns).alias("document"))
    return whole.join(found, "row", "left_anti").select("document.*")


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
