"""Token ids in ORC files: integer run lengths, row indexes and Bloom filters on document ids.

Documents are dealt to ranges of ``doc_id`` before they are encoded, so only
texts are shuffled, and every file holds one sorted range.  ORC stores the ids
as run-length-encoded integers in stripes that tasks read independently; a
lookup by ``doc_id`` prunes files and stripes by their ranges and Bloom filters.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from verdance.llm.words import small_batches
from verdance.session import shared_dir

TOKENIZER = "word_bpe_49k.json"
#: The id after each document, fixed by the format.
END_ID = 1
ROWS_PER_FILE = 50_000
STRIPE_BYTES = 16 << 20
INDEX_STRIDE = 1000
#: ``monotonically_increasing_id`` counts rows below this bit and partitions above it.
PLACE_BITS = 33


# Letters whose lower case and normal form are the same everywhere; the tokenizer cuts
# text into runs of letters, single digits and runs of other characters.
_LETTER = "a-zß-öø-ÿ"
_PLAIN = r"^[\x09-\x0D\x20-\x7EÀ-ÖØ-öø-ÿ]*$"
_SPECIAL = r"'|<\|"
_ONE_RUN = re.compile(f"[{_LETTER}]+|[0-9]|[!-/:-@\\[-`{{-~]+")
KNOWN_LIMIT = 400_000
SLICE_ROWS = 1000


class Encoder:
    """Encodes texts with one tokenizer, each distinct piece of them once.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its pieces in order.  Texts of plain letters are also cut
    where the tokenizer cuts them, which leaves fewer distinct pieces.  Special
    tokens hold no white space; texts that may have one are not cut further.
    Equality with whole texts is tested.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers import pre_tokenizers as P

        self.tokenizer = Tokenizer.from_file(path)
        # For runs that are in normal form and cut already, the same without these steps.
        self.for_runs = Tokenizer.from_file(path)
        self.for_runs.normalizer = None
        self.for_runs.pre_tokenizer = P.Sequence(
            [P.WhitespaceSplit(), P.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.last = np.array([n.endswith("</w>") for n in names])
        self.place: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.starts, self.sizes, self.uses = (np.empty(0, np.int64) for _ in range(3))

    def _forget_rare(self) -> None:
        """Keeps the pieces that more than one call used, half of the limit at most."""
        names = list(self.place)
        kept = np.flatnonzero(self.uses > 1)
        often = np.argsort(-self.uses[kept], kind="stable")[: KNOWN_LIMIT // 2]
        kept = np.sort(kept[often])
        n = self.sizes[kept]
        starts = np.cumsum(n) - n
        self.flat = self.flat[np.arange(n.sum()) + np.repeat(self.starts[kept] - starts, n)]
        self.starts, self.sizes, self.uses = starts, n, np.zeros(len(kept), np.int64)
        self.place = {names[k]: i for i, k in enumerate(kept.tolist())}

    def _learn(self, pieces: list[str]) -> None:
        one_run, other = [], []
        for piece in pieces:
            (one_run if _ONE_RUN.fullmatch(piece) else other).append(piece)
        ids, sizes = [], []
        if one_run:
            # Every run ends with an id that marks the end of a word.
            joined = self.for_runs.encode_batch_fast([" ".join(one_run)], add_special_tokens=False)
            joined = np.array(joined[0].ids, np.int32)
            ends = np.flatnonzero(self.last[joined]) + 1
            ids.append(joined)
            sizes.append(np.diff(ends, prepend=0))
        if other:
            done = self.tokenizer.encode(other, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(done.ids, np.int32))
            words = np.array(done.word_ids, np.int64)
            sizes.append(np.bincount(words, minlength=len(other)))
        sizes = np.concatenate(sizes)
        first = len(self.flat) + np.cumsum(sizes) - sizes
        for i, piece in enumerate(one_run + other, len(self.place)):
            self.place[piece] = i
        self.flat = np.concatenate([self.flat, *ids])
        self.starts = np.concatenate([self.starts, first])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.uses = np.concatenate([self.uses, np.zeros(len(sizes), np.int64)])

    def _places(self, pieces: list[str]) -> np.ndarray:
        new = [p for p in pieces if p not in self.place]
        if new and len(self.place) + len(new) > KNOWN_LIMIT:
            self._forget_rare()
            new = [p for p in pieces if p not in self.place]
        for at in range(0, len(new), 20_000):
            self._learn(new[at : at + 20_000])
        places = np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))
        self.uses[places] += 1
        return places

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow column of texts, each followed by ``END_ID``, and the ends of the texts."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        plain = pc.and_not(pc.match_substring_regex(texts, _PLAIN), pc.match_substring_regex(texts, _SPECIAL))
        cut = pc.utf8_lower(texts)
        for pattern, by in (
            ("([0-9])", r" \1 "),
            (rf"([{_LETTER}])([^{_LETTER}\s])", r"\1 \2"),
            (rf"([^{_LETTER}\s])([{_LETTER}])", r"\1 \2"),
        ):
            cut = pc.replace_substring_regex(cut, pattern=pattern, replacement=by)
        split = pc.ascii_split_whitespace(pc.if_else(plain, cut, texts))
        pieces = split.flatten().dictionary_encode()
        vocabulary = self._places(pieces.dictionary.to_pylist())
        place = vocabulary[pieces.indices.to_numpy(zero_copy_only=False)]
        pieces_per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        text_of_piece = np.repeat(np.arange(len(pieces_per_text)), pieces_per_text)
        n = self.sizes[place]
        stops = np.cumsum(n)
        # Each text before a piece has put one end id before it.
        shift = self.starts[place] - (stops - n) - text_of_piece
        ends = np.concatenate(([0], stops))[np.cumsum(pieces_per_text)] + np.arange(1, len(pieces_per_text) + 1)
        out = np.full(int(ends[-1]) if len(ends) else 0, END_ID, np.int32)
        inner = np.arange(int(stops[-1]) if len(stops) else 0) + np.repeat(text_of_piece, n)
        out[inner] = self.flat[inner + np.repeat(shift, n)]
        return out, ends


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, place, n_tokens, ids`` in place; ``docs`` has ``doc_id, place, text``."""

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        # Slices, as the numbers for a text's ids are many times its size.
        slices = (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS))
        for rows in slices:
            ids, ends = encoder(tokenizer).encode(rows.column("text"))
            ends = np.concatenate(([0], ends))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), rows.column("place"), pa.array(np.diff(ends)),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                ],
                names=["doc_id", "place", "n_tokens", "ids"],
            )

    schema = "doc_id long, place long, n_tokens long, ids array<int>"
    return docs.select("doc_id", "place", "text").mapInArrow(encode, schema)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Writes ORC files of ``doc_id, place, n_tokens, ids`` in ascending order of ``doc_id``.

    ``place`` numbers the rows in order, with gaps between files.  Missing
    texts are empty documents with the end id alone.  Rows without a ``doc_id``
    come first; rows that share one are all written.
    """
    small_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    files = max(
        -(-plain.count() // rows_per_file), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    )
    dealt = plain.repartitionByRange(files, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    (
        tokenized(ordered.withColumn("place", F.monotonically_increasing_id()), tokenizer)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", INDEX_STRIDE)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("compression", "zstd")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def document_tokens(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of some documents; the filter reaches the files' statistics and Bloom filters."""
    return read_token_files(spark, path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def token_index(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the stored ids.

    The ids before a document are those of earlier files, one number a file,
    and those before it in its file.
    """
    small_batches(files.sparkSession)

    def digest(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.concatenate(([0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("place"), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "place", "n_tokens", "ids_crc32"],
            )

    rows = files.select("doc_id", "place", "ids").mapInArrow(
        digest, "doc_id long, place long, n_tokens long, ids_crc32 long"
    )
    file = F.shiftright("place", PLACE_BITS)
    earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    # One row a file, of which there is one for a fixed number of documents.
    totals = files.groupBy(file.alias("file")).agg(F.sum("n_tokens").alias("n"))
    before = totals.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    order = W.partitionBy("file").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = F.sum("n_tokens").over(order) - F.col("n_tokens")
    return (
        rows.withColumn("file", file)
        .withColumn("inside", inside)
        .join(before, "file")
        .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )


def token_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = shared_dir(spark, "tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_token_files(docs, path, public_tokenizers.path(TOKENIZER))
    return token_index(read_token_files(spark, path))
