"""Exact Jaccard self-join of word-shingle sets, and the classes its links form.

Sizes are cut into bands, and each band into tiles that can be compared apart
from each other.  In a band two sets that link differ in at most ``d`` elements
(see ``Band``).  Hash values are dealt to ``d + 1 + spare`` segments; differing
elements spoil at most ``d`` of them, so linked sets have a segment with the
same elements.  A tile holds the sets of a band that agree in one segment.
Within a tile, bitmaps of the hashed elements bound the overlap from above by
bit counts; what they leave is decided on the sorted arrays.

Only classes are wanted, so a tile does not compare all its pairs.  First each
member meets one head of its tile and a neighbour by size; then, if a tile still
spans several classes, the members outside its largest class meet all others,
in cells of bounded size.  No pair is left out that could join two classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdance.llm.components import components
from verdance.llm.words import WORD, mixed, shingle_hashes, small_batches, utf8, word_hashes
from verdance.session import materialise, remove_scratch, scratch_mark

SHINGLE = 3
#: A link: PERCENT * union <= 100 * intersection.
PERCENT = 90
BAND_RATIO = 1.4
BITMAP_WORDS = 32
SHORT = 8 * BITMAP_WORDS
#: Shared tiles that are broadcast at most, 16 bytes each.
MAX_HEADS = 500_000
BLOCK = 1024


@dataclass(frozen=True)
class Band:
    """Sets of ``low`` to ``high - 1`` elements and their larger partners.

    With ``p`` percent, ``100 i >= p (a + b - i)`` gives ``i >= p (a + b) / (100 + p)``,
    so the sets differ in at most ``(a + b) (100 - p) / (100 + p)`` elements, and
    the larger has at most ``100 a / p``.
    """

    number: int
    low: int
    high: int
    percent: int

    @property
    def differing(self) -> int:
        small = self.high - 1
        large = 100 * small // self.percent
        return (small + large) * (100 - self.percent) // (100 + self.percent)

    @property
    def spare(self) -> int:
        """Segments beyond what differing elements can spoil: for empty ones, and so that linked sets share several."""
        return 2 + self.differing // 10

    @property
    def segments(self) -> int:
        return self.differing + 1 + self.spare


def bands_of(size: int, percent: int) -> list[Band]:
    """Bands whose tiles a set of this size belongs to: its own, and lower ones with partners."""
    found, low, number = [], 1, 0
    smallest = -(-percent * size // 100)
    while low <= size:
        high = max(low + 1, int(low * BAND_RATIO))
        if high > smallest:
            found.append(Band(number, low, high, percent))
        low, number = high, number + 1
    return found


def tile_keys(elements: np.ndarray, percent: int) -> np.ndarray:
    """Tiles of a sorted set: one number per band and usable segment."""
    keys = []
    for band in bands_of(len(elements), percent):
        if not band.differing:  # only equal sets link, and these are one class already
            continue
        # The arrays are sorted by value, so segments of the value range are runs.
        of = ((elements >> np.uint64(32)) * np.uint64(band.segments)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
        sums = np.add.reduceat(mixed(elements), starts)
        tiles = of[starts] + np.uint64(band.number << 40)
        keys.append(mixed(mixed(tiles) ^ sums))
        if band.segments - len(starts) > band.spare:
            # More empty segments than spare ones: an empty one may be the only one in common.
            empty = np.setdiff1d(np.arange(band.segments, dtype=np.uint64), of[starts])
            keys.append(mixed(mixed(empty + np.uint64(band.number << 40))))
    return np.unique(np.concatenate(keys)) if keys else np.empty(0, np.uint64)


def least_common(elements: np.ndarray, percent: int) -> int:
    """Tiles that a set has in common with any larger or equal one it links with, at least.

    Of the segments of the set's own band at least ``spare + 1`` are not spoiled;
    those of them that are empty need not be tiles.
    """
    bands = bands_of(len(elements), percent)
    if not bands or not bands[-1].differing:
        return 1
    band = bands[-1]
    of = ((elements >> np.uint64(32)) * np.uint64(band.segments)) >> np.uint64(32)
    filled = 1 + int(np.count_nonzero(of[1:] != of[:-1]))
    return max(1, band.spare + 1 - (band.segments - filled))


def bitmap(elements: np.ndarray) -> bytes:
    """A bit per hashed element, in at least twice as many bits as there are elements, a power of two."""
    size = BITMAP_WORDS * 64
    while size < 2 * len(elements):
        size *= 2
    bits = np.zeros(size, np.uint8)
    bits[(mixed(elements) & np.uint64(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def folded(bitmaps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps of equal size as rows of ``size`` bytes in 64-bit words: what they would be with fewer bits."""
    wide = np.frombuffer(b"".join(bitmaps), np.uint64).reshape(len(bitmaps), -1, size // 8)
    return np.bitwise_or.reduce(wide, axis=1)


def elements_of(text: bytes, shingle: int) -> np.ndarray:
    """The document's set, as a sorted array of hashes."""
    found = shingle_hashes(word_hashes(text), shingle)
    found.sort()
    return found[np.concatenate(([True], found[1:] != found[:-1]))] if len(found) else found


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, size, set_hi, set_lo, bits, short, need, tiles`` per document: a digest, bitmaps and tile numbers.

    ``short`` is the bitmap folded to the least width, which cells of tiles
    carry; ``need`` is what ``least_common`` says.
    """
    import xxhash

    def describe(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for text in utf8(batch.column("text")):
                elements = elements_of(text, shingle)
                digest = np.frombuffer(xxhash.xxh3_128_digest(elements.tobytes()), "<i8")
                tiles = tile_keys(elements, percent).view(np.int64)
                bits = bitmap(elements)
                rows.append((len(elements), int(digest[0]), int(digest[1]), bits, folded([bits], SHORT).tobytes(), least_common(elements, percent), tiles))
            size, hi, lo, bits, short, need, tiles = zip(*rows) if rows else ((),) * 7
            ends = np.concatenate(([0], np.cumsum([len(t) for t in tiles]))).astype(np.int32)
            flat = np.concatenate(tiles) if tiles else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(size, pa.int64()),
                    pa.array(hi, pa.int64()),
                    pa.array(lo, pa.int64()),
                    pa.array(bits, pa.binary()),
                    pa.array(short, pa.binary()),
                    pa.array(need, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["doc_id", "size", "set_hi", "set_lo", "bits", "short", "need", "tiles"],
            )

    schema = "doc_id long, size long, set_hi long, set_lo long, bits binary, short binary, need long, tiles array<long>"
    return docs.select("doc_id", "text").mapInArrow(describe, schema)


def tile_members(chosen: DataFrame) -> DataFrame:
    """``tile, rep, size, n, block, head, head_size`` of the sets in tiles of two or more, ``n`` of them.

    ``head`` is the tile's set with the smallest id.  Members are dealt to
    blocks of about ``BLOCK``, so that no step gathers a tile that a large group
    of copies fills.  The shared tiles are written and counted: few are broadcast,
    else the join meets a plain table, of which Spark splits hot partitions.
    """
    placed = chosen.select("rep", "size", F.explode("tiles").alias("tile"))
    # Most tiles hold one set, so the count of all sends their numbers alone.
    shared = materialise(placed.groupBy("tile").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    if shared.count() <= MAX_HEADS:
        shared = F.broadcast(shared)
    block = F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / BLOCK)).cast("int")
    together = materialise(placed.join(shared, "tile").select("tile", "rep", "size", "n", block.alias("block")), "shared")
    heads = together.groupBy("tile").agg(F.min(F.struct("rep", "size")).alias("first"))
    heads = heads.select("tile", F.col("first.rep").alias("head"), F.col("first.size").alias("head_size"))
    return together.join(heads, "tile")


def first_pairs(members: DataFrame) -> DataFrame:
    """Pairs of each tile member with the tile's head and with its neighbour by size in its block."""
    order = W.partitionBy("tile", "block").orderBy("size", "rep")
    b = [F.col("rep").alias("b"), F.col("size").alias("size_b")]
    near = members.select(F.lag("rep").over(order).alias("a"), F.lag("size").over(order).alias("size_a"), *b)
    star = members.select(F.col("head").alias("a"), F.col("head_size").alias("size_a"), *b)
    return star.unionByName(near.where("a is not null"))


def bounded_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` across the classes of tiles that sizes, short bitmaps and common tiles let link.

    ``members`` has ``tile, rep, size, component, short, need``, all members of
    a tile.  A pair comes out of a cell once for each tile it has in common, and
    must do so as often as its smaller set needs.  Members outside the
    tile's largest class meet all others, in cells of two blocks, so a task
    holds one cell at a time.
    """

    def numbers(batch) -> dict:
        names = ("tile", "a", "b", "side", "rep", "size", "component", "need")
        out = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        flat = np.frombuffer(b"".join(batch.column("short").to_pylist()), np.uint64)
        return out | {"bits": flat.reshape(-1, BITMAP_WORDS)}

    def pairs(cell: dict) -> Iterator:
        import pyarrow as pa

        size, comp, rep, need, bits, minor = (cell[n] for n in ("size", "component", "rep", "need", "bits", "side"))
        left, right = np.flatnonzero((minor == 0) | (minor == 3)), np.flatnonzero(minor != 0)
        apart = comp[left][:, None] != comp[right][None, :]
        near = (size[left][:, None] * 100 >= size[right][None, :] * percent) & (
            size[right][None, :] * 100 >= size[left][:, None] * percent
        )
        # Two members outside the largest class meet twice, once on either side.
        once = (minor[right] == 2)[None, :] | (rep[left][:, None] < rep[right][None, :])
        p, q = np.nonzero(apart & near & once)
        for k in range(0, len(p), 65536):
            a, b = left[p[k : k + 65536]], right[q[k : k + 65536]]
            may = may_link(bits[a], bits[b], size[a] + size[b], percent)
            if may.any():
                a, b = a[may], b[may]
                needs = np.where(size[a] < size[b], need[a], np.where(size[b] < size[a], need[b], np.minimum(need[a], need[b])))
                ends = np.minimum(rep[a], rep[b]), np.maximum(rep[a], rep[b])
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*ends, needs)], names=["a", "b", "need"])

    def compare(batches: Iterator) -> Iterator:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = numbers(batch)
            if held is not None:
                now = {n: np.concatenate((held[n], now[n])) for n in now}
            new = np.zeros(len(now["tile"]) - 1, bool)
            for n in ("tile", "a", "b"):
                new |= now[n][1:] != now[n][:-1]
            edges = [0, *(np.flatnonzero(new) + 1).tolist()]
            for s, e in zip(edges[:-1], edges[1:]):
                yield from pairs({n: v[s:e] for n, v in now.items()})
            held = {n: v[edges[-1] :] for n, v in now.items()}
        if held is not None:
            yield from pairs(held)

    largest = F.max(F.struct("n", "component"))
    tiles = (
        members.groupBy("tile", "component").agg(F.count("*").alias("n"))
        .groupBy("tile").agg(largest.alias("most"), F.sum("n").alias("all"))
        .select(
            "tile", F.col("most.component").alias("largest"), F.ceil(F.col("all") / BLOCK).alias("blocks"),
            F.ceil((F.col("all") - F.col("most.n")) / BLOCK).alias("minor_blocks"),
        )
        .where("minor_blocks > 0")
    )
    placed = members.join(tiles, "tile").withColumn("minor", F.col("component") != F.col("largest"))
    salt = F.xxhash64("rep")
    row = ["tile", "rep", "size", "component", "short", "need"]

    def every(blocks: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks).cast("long") - 1))

    # Sides: 0 a member outside the largest class, met by 1 others outside and 2 those inside;
    # 3 is 0 and 1 at once, for tiles of one block, which send a member once.
    small = placed.where("blocks = 1").select(
        *row, F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.when(F.col("minor"), 3).otherwise(2).alias("side")
    )
    placed = placed.where("blocks > 1")
    left = placed.where("minor").select(
        *row, F.pmod(salt, F.col("minor_blocks")).cast("long").alias("a"), every("blocks").alias("b"), F.lit(0).alias("side")
    )
    right = placed.select(
        *row, every("minor_blocks").alias("a"), F.pmod(salt, F.col("blocks")).cast("long").alias("b"),
        F.when(F.col("minor"), 1).otherwise(2).alias("side"),
    )
    cells = small.unionByName(left).unionByName(right).repartition("tile", "a", "b").sortWithinPartitions("tile", "a", "b")
    met = cells.mapInArrow(compare, "a long, b long, need long")
    often = met.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("need").alias("need"))
    return often.where("n >= need").select("a", "b")


def may_link(bits_a, bits_b, sizes, percent: int):
    """Whether bitmaps let sets link: an element that sets a bit of one bitmap alone is in one set alone."""
    differing = np.bitwise_count(bits_a ^ bits_b).sum(axis=1, dtype=np.int64)
    return differing * (100 + percent) <= sizes * (100 - percent)


def bounded(pairs: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """Those pairs of ``a, b`` whose sizes and bitmaps let them link; no text is read for the others."""

    def decide(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes = batch.column("sizes").to_numpy(zero_copy_only=False)
            bits = [batch.column(n).to_pylist() for n in ("bits_a", "bits_b")]
            widths = np.array([[len(x), len(y)] for x, y in zip(*bits)], np.int64).reshape(-1, 2)
            may = np.zeros(len(sizes), bool)
            for pair in np.unique(widths, axis=0):
                at = np.flatnonzero((widths == pair).all(axis=1))
                one, two = (folded([b[i] for i in at.tolist()], int(pair.min())) for b in bits)
                may[at] = may_link(one, two, sizes[at], percent)
            yield batch.select(["a", "b"]).filter(pa.array(may))

    def side(name: str) -> DataFrame:
        return chosen.select(F.col("rep").alias(name), F.col("size").alias(f"size_{name}"), F.col("bits").alias(f"bits_{name}"))

    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    compared = joined.select("a", "b", (F.col("size_a") + F.col("size_b")).alias("sizes"), "bits_a", "bits_b")
    return compared.mapInArrow(decide, "a long, b long").distinct()


def verified(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those pairs of ``a, b`` whose sets link, by intersection of the sorted arrays.

    ``docs`` has ``doc_id, text``; only texts of documents in the pairs are moved.
    """

    def decide(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep, a, b, one, two = [], None, None, None, None
            for x, y in zip(utf8(batch.column("text_a")), utf8(batch.column("text_b"))):
                if x != a:
                    a, one = x, elements_of(x, shingle)
                if y != b:
                    b, two = y, elements_of(y, shingle)
                joint = np.concatenate((one, two))
                joint.sort(kind="stable")
                common = int(np.count_nonzero(joint[1:] == joint[:-1]))
                keep.append(100 * common >= percent * (len(joint) - common))
            mask = pa.array(keep, pa.bool_())
            yield batch.select(["a", "b"]).filter(mask)

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    docs = docs.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    left = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(decide, "a long, b long")


def apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Those pairs of ``a, b`` whose ends are in different groups, or in none."""
    for end in ("a", "b"):
        own = groups.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        pairs = pairs.join(own, end, "left")
    return pairs.where("coalesce(of_a, a) <> coalesce(of_b, b)").select("a", "b")


def jaccard_classes(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """Classes of documents under links, and the verified links between different sets.

    Returns ``(doc_id, n_shingles, component_id)``, one row per row of ``docs``,
    and ``(a, b)``.  The component is the smallest document reachable by links;
    documents without words (or text) link with nothing.  Documents with equal
    sets are linked and stand for one representative.  Rows without a
    ``doc_id`` are returned with component NULL.  If rows share a ``doc_id``, it
    links if any of its texts does, and each row gets the component of the class
    of its own set.
    """
    spark = docs.sparkSession
    small_batches(spark)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    mark = scratch_mark()
    sets = materialise(shingle_sets(plain, shingle, percent), "sets")
    wide = scratch_mark()
    full = sets.where("size > 0 and doc_id is not null")
    equal = full.groupBy("set_hi", "set_lo").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies")
    )
    equal = materialise(equal, "equal")
    several = equal.where("copies > 1").select("set_hi", "set_lo", "rep")
    reps = equal.select(F.col("rep").alias("doc_id"), "set_hi", "set_lo")
    chosen = full.join(reps, ["doc_id", "set_hi", "set_lo"], "left_semi").select(
        F.col("doc_id").alias("rep"), "size", "bits", "short", "need", "tiles"
    )
    chosen = materialise(chosen, "chosen")
    # Bitmaps and tile numbers are with the representatives now; the rest is narrow.
    sets = materialise(sets.select("doc_id", "size", "set_hi", "set_lo"), "sets")
    remove_scratch(spark, mark, wide)
    members = materialise(tile_members(chosen), "tiles")

    close = F.expr(f"a <> b and 100 * least(size_a, size_b) >= {percent} * greatest(size_a, size_b)")
    tried = materialise(first_pairs(members).where(close).select("a", "b").distinct(), "pairs")
    first = bounded(tried, chosen, percent).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    first = materialise(first.distinct(), "pairs")
    # Every set meets its first partner, and the others only where that has not joined them yet.
    one = first.groupBy("b").agg(F.min("a").alias("a"))
    links = materialise(verified(one, plain, shingle, percent), "links")
    groups = materialise(components(links, "a", "b"), "groups")
    others = materialise(apart(first.join(one, ["a", "b"], "left_anti"), groups), "pairs")
    links = links.unionByName(materialise(verified(others, plain, shingle, percent), "links"))
    groups = materialise(components(links, "a", "b"), "groups")

    # The only pair of a tile of two is decided by now.
    grouped = members.where("n > 2").join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    mixed_tiles = grouped.groupBy("tile").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low < high").select("tile")
    open_members = materialise(
        grouped.join(mixed_tiles, "tile", "left_semi").join(chosen.select("rep", "short", "need"), "rep"), "open-tiles"
    )
    tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # Written apart, so that the cells are gone before the wide bitmaps travel.
    rest = materialise(bounded_pairs(open_members, percent).join(tried, ["a", "b"], "left_anti"), "pairs")
    rest = materialise(bounded(rest, chosen, percent), "pairs")
    more = materialise(verified(rest, plain, shingle, percent), "links")
    links = links.unionByName(more)
    groups = materialise(components(links, "a", "b"), "groups")

    rep = F.coalesce("rep", "doc_id")
    placed = sets.select("doc_id", "size", "set_hi", "set_lo").join(
        several, ["set_hi", "set_lo"], "left"
    )
    placed = placed.select("doc_id", "size", F.when(F.col("size") > 0, rep).otherwise(F.col("doc_id")).alias("rep"))
    result = placed.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    return result, links


def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_classes(docs)[0]


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD_SQL = rf"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '{WORD}') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM split WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common.n >= {PERCENT} * (x.n + y.n - common.n)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT node, b FROM reach JOIN both_ways ON a = other
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id)
JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY 1) USING (doc_id)
"""
