"""Language-model scores by stupid backoff over the corpus's own n-gram counts."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ALPHA = 0.4  # the published backoff factor
ROW_BYTES = 64  # what a row counts for beside its text, so that empty texts fill blocks as well
GRAMS = "gram bigint, block bigint, n bigint"
MOST_PARTITIONS = 50_000  # more of them cost a shuffle more in small blocks than sorting in memory saves
EVERY = np.int64(0)  # the empty n-gram, which counts all words
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Sorted hashes in Parquet's second version are their differences; few of a block's words are distinct.
PACKED = {"parquet.writer.version": "v2", "parquet.dictionary.page.size": str(8 << 20)}


def _words(texts: pa.Array) -> pa.ListArray:
    """The 64-bit hash of each word of each text; a null text has none."""
    text = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    split = pc.ascii_split_whitespace(text)
    lengths = np.where(pc.binary_length(text).to_numpy() > 0, pc.list_value_length(split).to_numpy(), 0)
    words = pc.list_flatten(split).cast(pa.large_binary())
    words = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words.dictionary.to_pylist()], "<u8")
    ids = words.indices.to_numpy()
    values = hashes[ids] if len(ids) else np.zeros(0, "<u8")
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype("<i4")), pa.array(values.view("<i8")))


def _block_words(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of a block, words per document)."""
    words = block.column("words").combine_chunks()
    return pc.list_flatten(words).to_numpy().view("<u8"), pc.list_value_length(words).to_numpy().astype("<i8")


def _grams(word: np.ndarray, lengths: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the n-gram that ends at each word, whether the document has the words for it)."""
    place = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    key = np.full(len(word), np.uint64(0x9E3779B97F4A7C15 * order % 2**64))
    for back in range(order - 1, -1, -1):
        moved = np.zeros(len(word), np.uint64)
        moved[back:] = word[: len(word) - back]
        key = (key ^ moved) * np.uint64(0xFF51AFD7ED558CCD)
        key ^= key >> np.uint64(32)
    return key, place >= order - 1


def _among(keys: np.ndarray, grams: np.ndarray, values: np.ndarray, absent: int) -> np.ndarray:
    """The value of each key in the sorted grams."""
    if not len(grams):
        return np.full(len(keys), absent, values.dtype)
    at = np.minimum(np.searchsorted(grams, keys), len(grams) - 1)
    return np.where(grams[at] == keys, values[at], absent)


def _shared(shared: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(sorted n-grams that other blocks have too, their counts there)."""
    grams, elsewhere = shared.column("gram").to_numpy().view("<u8"), shared.column("elsewhere").to_numpy()
    by_gram = np.argsort(grams)
    return grams[by_gram], elsewhere[by_gram]


def _block_grams(block: pa.Table, shorter: pa.Table | None, order: int, part: int, parts: int) -> pa.Table:
    """The distinct n-grams of a block with their counts, of one part of all hashes: a frequent n-gram leaves it as one row.

    `shorter` holds the block's n-grams of one word less that other blocks have too. An n-gram is left out unless both such
    n-grams in it are among them: no other block can have it.
    """
    word, lengths = _block_words(block)
    key, taken = _grams(word, lengths, order)
    if shorter is not None:
        known = pa.array(_grams(word, lengths, order - 1)[0].view("<i8"))
        known = pc.is_in(known, value_set=shorter.column("gram")).to_numpy(zero_copy_only=False)
        taken &= known
        taken[1:] &= known[:-1]
    if parts > 1:
        taken &= (key >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32) == part
    unique, counts = np.unique(key[taken], return_counts=True)
    gram, n = unique.view("<i8"), counts.astype("<i8")
    if order == 1:
        gram, n = np.append(gram, EVERY), np.append(n, len(word))
    number = block.column("block")[0].as_py()
    return pa.table({"gram": gram, "block": np.full(len(gram), number, "<i8"), "n": n})


def _rest(word: np.ndarray, lengths: np.ndarray, doc: np.ndarray, order: int, grams: np.ndarray, elsewhere: np.ndarray) -> np.ndarray:
    """Occurrences in all other documents of the n-gram that ends at each word; 0 where there is none."""
    key, whole = _grams(word, lengths, order)
    rest = np.zeros(len(word), "<i8")
    spots = np.flatnonzero(whole)
    if not len(spots):
        return rest
    by_gram = np.argsort(key[spots])
    spots = spots[by_gram]
    key = key[spots]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    counts = np.diff(np.append(starts, len(key)))
    totals = counts + _among(key[starts], grams, elsewhere, 0)
    # Each n-gram's occurrences by document: how many are the word's own document's.
    pair = np.repeat(np.arange(len(starts)), counts) * len(lengths) + doc[spots]
    by_pair = np.argsort(pair)
    pair, spots = pair[by_pair], spots[by_pair]
    firsts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    own = np.diff(np.append(firsts, len(pair)))
    rest[spots] = np.repeat(totals[pair[firsts] // len(lengths)] - own, own)
    return rest


def _scored(block: pa.Table, shared: pa.Table, order: int, alpha: float, names: list[str]) -> pa.Table:
    """The scores of a block's documents; `shared` holds the n-grams that other blocks have too, with their counts there."""
    word, lengths = _block_words(block)
    grams, elsewhere = _shared(shared)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    rest = [_rest(word, lengths, doc, n, grams, elsewhere) for n in range(1, order + 1)]
    all_words = len(word) + int(_among(np.array([EVERY]).view("<u8"), grams, elsewhere, 0)[0])
    others = np.maximum(all_words - lengths[doc], 1)
    # From the shortest order up: a longer n-gram that occurs elsewhere replaces the shorter one's score.
    log = np.log(np.maximum(rest[0], alpha) / others)
    seen = np.zeros(len(word), bool)
    for n in range(2, order + 1):
        context = np.concatenate(([0], rest[n - 2][:-1])) if len(word) else rest[n - 2]
        hit = rest[n - 1] > 0
        ratio = np.log(np.where(hit, rest[n - 1], 1) / np.where(hit, np.maximum(context, 1), 1))
        log = np.where(hit, ratio, log + np.where(place >= n - 1, np.log(alpha), 0.0))
        seen |= hit if n == order else False
    sums = np.bincount(doc, weights=log, minlength=len(lengths))
    n_seen = np.bincount(doc, weights=seen, minlength=len(lengths)).astype(np.int64)
    mean = pa.array(sums / np.maximum(lengths, 1), pa.float64(), mask=lengths == 0)
    return pa.table([block.column("doc_id"), pa.array(lengths), pa.array(n_seen), mean], names=names)


def in_blocks(texts: DataFrame, block_bytes: int) -> DataFrame:
    """(doc_id, words, block) of texts (doc_id, text): the hashes of the words, and a bigint for rows that follow each other,
    about block_bytes of text, in one part."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype("<i8") + ROW_BYTES
            starts = held + np.cumsum(sizes) - sizes
            held += int(sizes.sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), _words(batch.column(1)), pa.array(first + starts // block_bytes)], names=["doc_id", "words", "block"])

    return texts.mapInArrow(numbered, T.StructType([texts.schema["doc_id"], *T._parse_datatype_string("words array<bigint>, block bigint").fields]))


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark deletes the shuffle files of each written step as it ends."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


class Home:
    """A table in the shared scratch folder whose rows are bucketed by block: what meets by block later needs no shuffle."""

    def __init__(self, spark: SparkSession, purpose: str, buckets: int):
        self.spark, self.path, self.buckets = spark, scratch_dir(spark, purpose), buckets
        self.name = f"{purpose.replace('-', '_')}_{uuid.uuid4().hex}"

    def add(self, rows: DataFrame, compression: str = "snappy") -> None:
        placed = rows.repartition(self.buckets, "block").write.mode("append").bucketBy(self.buckets, "block")
        with shuffles_freed(self.spark):
            placed.options(path=self.path, compression=compression, **PACKED).saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forgets the name; the files stay for those who hold the rows."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def score(
    documents: DataFrame, order: int = 2, alpha: float = ALPHA, block_bytes: int = 8 << 20, bucket_bytes: int = 4 << 20, parts: int = 2
) -> DataFrame:
    """One row (doc_id, n_words, n_seen, mean_log_score) per document; doc_id keeps its type.

    A word's score is the stupid backoff score from the counts of all other documents: f(n-gram) / f(context) for the
    longest n-gram that occurs there, times alpha for each order skipped, down to f(word) / all words; a word that occurs
    nowhere else counts alpha times. n_seen counts the words whose longest n-gram occurs elsewhere.

    Documents are dealt into blocks, written once as hashes of their words so that a lost executor's blocks come back as
    they were. Each block explodes into its distinct n-grams, one row (64-bit hash, block, count) each, and these are
    partitioned by hash. There the count table is their sum by hash; joined to the same rows it tells each block how often
    its n-grams occur in others. An n-gram that only one block has needs no answer, as the block counted it itself. A block
    then sums the scores per document. The most frequent n-gram has one row per block, so no key is hot. The number of hash
    partitions follows the size of the texts, bucket_bytes of text each, up to MOST_PARTITIONS; beyond that they grow, and
    their sorts spill.

    To keep the disk small, each order from two on is counted in as many steps as `parts` says, by hash; a step's answers
    are written by block, and its shuffles deleted, before the next. An n-gram of three words or more occurs elsewhere only
    if both n-grams of one word less in it do, so a block sends no other.

    Words are what is not ASCII white space, A-Z as a-z. Null and empty texts have no words and a null score. Copies count
    as other documents, also repeated rows. No rows give no rows; other columns aren't looked at.
    """
    spark = documents.sparkSession
    texts = documents.select("doc_id", "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    result = T.StructType([texts.schema["doc_id"], *T._parse_datatype_string("n_words bigint, n_seen bigint, mean_log_score double").fields])
    names = result.names
    buckets = min(max(4, -(-total // bucket_bytes)), MOST_PARTITIONS)
    homes = min(max(4, 2 * -(-total // block_bytes)), MOST_PARTITIONS)  # a task sorts few blocks at a time

    words = Home(spark, "lm-words", homes)
    words.add(in_blocks(texts, block_bytes), "zstd")
    blocks = words.rows().groupBy("block")
    words.close()

    def answers(n: int, part: int, known: DataFrame | None) -> DataFrame:
        def exploded(block: pa.Table) -> pa.Table:
            return _block_grams(block, None, n, part, 1 if n == 1 else parts)

        def pruned(block: pa.Table, shorter: pa.Table) -> pa.Table:
            return _block_grams(block, shorter, n, part, parts)

        grams = blocks.applyInArrow(exploded, GRAMS) if known is None else blocks.cogroup(known.groupBy("block")).applyInArrow(pruned, GRAMS)
        grams = grams.repartition(buckets, "gram")
        # All columns are read here, so that the join reads the same shuffle.
        counts = grams.groupBy("gram").agg(F.sum("n").alias("total"), F.min("block").alias("first"), F.max("block").alias("last"))
        counts = counts.filter("first < last").select("gram", "total")
        if buckets < MOST_PARTITIONS:  # the shared n-grams of a few MB of text fit a task's memory
            counts = counts.hint("shuffle_hash")
        return grams.join(counts, "gram").select("block", "gram", (F.col("total") - F.col("n")).alias("elsewhere"))

    found = Home(spark, "lm-shared", homes)
    for n in range(2, order + 1):
        known = found.rows().filter(F.col("size") == n - 1).drop("size") if n > 2 else None
        for part in range(parts):
            found.add(answers(n, part, known).withColumn("size", F.lit(n)))
    shared = answers(1, 0, None).repartition(homes, "block")
    if order > 1:
        shared = found.rows().drop("size").unionByName(shared)
    found.close()

    def scored(block: pa.Table, shared: pa.Table) -> pa.Table:
        return _scored(block, shared, order, alpha, names)

    return blocks.cogroup(shared.groupBy("block")).applyInArrow(scored, result)
