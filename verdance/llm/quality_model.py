"""Quality classifier: histogram gradient-boosted trees over document statistics.

Training is on a bounded sample of labelled documents (``MAX_TRAIN``, by hash of
the id); its statistics, a few dozen numbers a row, come to the driver, where
trees are grown on binned values.  The trees are complete binary trees in flat
arrays, so a batch of documents walks all of them in numpy at once.  Scoring is
one pass over the texts without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdance.llm.words import small_batches, utf8

MAX_TRAIN = 20_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
RIDGE = 1.0
LEAST_HESSIAN = 1.0

# Byte classes, counted by one histogram of the text's bytes.
_CLASSES = {
    "lower": bytes(range(97, 123)),
    "upper": bytes(range(65, 91)),
    "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "line": b"\n",
    "stop": b".,;:",
    "shout": b"!?",
    "symbol": b"#*$%&|<>",
    "quote": b"\"'()[]{}",
    "other": b"@/\\_-+=~^`",
    "high": bytes(range(128, 256)),
}
_OF = np.zeros((256, len(_CLASSES)))
for _i, _bytes in enumerate(_CLASSES.values()):
    _OF[list(_bytes), _i] = 1.0

STATISTICS = (
    *_CLASSES,
    "bytes", "words", "word_bytes", "longest_word", "distinct_words", "top_word", "next_same",
    "distinct_pairs", "lines", "distinct_lines", "line_words", "symbol_words", "short_words",
)


def statistics(text: bytes) -> tuple:
    """Size-free numbers that describe a text; zeros for an empty one."""
    if not text:
        return (0.0,) * len(STATISTICS)
    size = len(text)
    classes = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _OF
    words = text.split()
    n = len(words)
    if not n:
        return (*(classes / size), np.log1p(size), *(0.0,) * (len(STATISTICS) - len(_CLASSES) - 1))
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    ends = sum(c for w, c in counts.items() if w[-1] in b"#*$%&|<>!")
    return (
        *(classes / size),
        np.log1p(size),
        np.log1p(n),
        lengths.mean(),
        min(int(lengths.max()), 200),
        len(counts) / n,
        max(counts.values()) / n,
        same / n,
        pairs / max(n - 1, 1),
        np.log1p(len(lines)),
        len(set(lines)) / len(lines),
        n / len(lines),
        ends / n,
        np.count_nonzero(lengths <= 3) / n,
    )


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: node ``i`` has children ``2i+1`` and ``2i+2``.

    A node sends a value up to its threshold left; a node that does not split
    has threshold infinity.  ``leaf`` has ``2**depth`` values per tree.
    """

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(trees):
            at = np.zeros(len(x), np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, self.feature[t, at]] > self.threshold[t, at])
            out += self.leaf[t, at - inner]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margins(x)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    """Boosted trees for labels 0 and 1; with one label or no rows, a constant."""
    inner, leaves = 2**depth - 1, 2**depth
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    model = Trees(feature, threshold, leaf, float(np.log(share / (1 - share))))
    if not len(y) or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1)
    wide = x.shape[1]
    flat = binned + np.arange(wide) * bins
    margin = np.full(len(y), model.base)
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            cell = ((at - first)[:, None] * (wide * bins) + flat).ravel()
            shape = (nodes, wide, bins)
            g = np.bincount(cell, np.repeat(grad, wide), nodes * wide * bins).reshape(shape).cumsum(2)
            h = np.bincount(cell, np.repeat(hess, wide), nodes * wide * bins).reshape(shape).cumsum(2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
            gain[(h < LEAST_HESSIAN) | (h_all - h < LEAST_HESSIAN)] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            for node in range(nodes):
                f, b = divmod(int(best[node]), bins)
                if gain[node, f, b] > 1e-9 and b < len(edges[f]):
                    feature[t, first + node], threshold[t, first + node] = f, edges[f][b]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t, at]] > threshold[t, at])
        g = np.bincount(at - inner, grad, leaves)
        h = np.bincount(at - inner, hess, leaves)
        leaf[t] = -RATE * g / (h + RIDGE)
        margin += leaf[t, at - inner]
    return model


def _described(batch) -> np.ndarray:
    rows = [statistics(text) for text in utf8(batch.column("text"))]
    return np.array(rows, float).reshape(-1, len(STATISTICS))


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether a document's label is kept from training."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Trees:
    """Trees from labelled documents that are not held out.

    ``labels`` has ``doc_id, quality``; other values than 0 and 1 are ignored,
    and a document with both labels counts with each.  At most ``max_train``
    labels are used, those with the smallest hashes of the id.
    """

    def describe(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            flat = pa.array(_described(batch).ravel())
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.ListArray.from_arrays(ends, flat)],
                names=["doc_id", "quality", "x"],
            )

    small_batches(docs.sparkSession)
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    usable = usable.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    sample = usable.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_train)
    # The sample has at most max_train rows of two numbers.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    rows = texts.mapInArrow(describe, "doc_id long, quality int, x array<double>")
    # In one order, so that the trees do not depend on tasks; a repeated id is bounded as well.
    rows = rows.orderBy("doc_id", "quality", "x").limit(max_train).collect()
    x = np.array([r.x for r in rows], float).reshape(-1, len(STATISTICS))
    return grow(x, np.array([r.quality for r in rows], float))


def score(docs: DataFrame, model: Trees) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; missing texts count as empty."""

    def rate(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            scores = model.scores(_described(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    small_batches(docs.sparkSession)
    rated = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        rate, "doc_id long, score double"
    )
    return rated.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, model: Trees, least: float = 0.5) -> DataFrame:
    """The documents whose score is at least ``least``, with all their columns.

    Scores are joined to nothing: rows pass through one Arrow function.
    """
    small_batches(docs.sparkSession)
    schema = docs.schema

    def sift(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array(model.scores(_described(batch)) >= least))

    return docs.mapInArrow(sift, schema)


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, train(docs, labels))
