"""Target-distribution importance resampling of documents, with a cutoff found by quantile-sketch bracketing.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. Features are single words
and pairs of neighbours, hashed into a fixed number of buckets; a bucket's gain is the log ratio of its smoothed
share in the target texts to that in the documents. A document's weight is the mean gain of its features, read
from one array of gains; its score adds Gumbel noise drawn from a hash of its id, so that the highest scores are
a sample without replacement in proportion to the weights' exponentials.

1. Spark sums the bucket counts of the tasks; the counts of both sides (``buckets`` numbers each) reach the driver.
2. Every whole text is scored against the array of gains where it is read; scores are stored with a row number.
3. The score of the last document drawn is located: a quantile sketch gives a bracket, exact counts of the rows
   outside validate it or widen it, and a bracket of more than ``most`` rows is sketched again within itself.
   Only the rows of the last bracket are sorted. Equal scores are bracketed by id in the same way.
4. Drawn rows are ranked by score value: rows of a value are numbered in its own window, and each value starts
   after the rows of all higher ones. Scores are whole thousandths within some 100,000 values (a gain is at most
   1000 ln(10^16), the noise lies in -3,200 to 23,000), so the table of starts is small whatever the input.

Defined results: a null text has no words; a document without features has weight 0; rows with fewer than
``least_words`` words are scored but never drawn; a null id counts as the empty text in the noise and as the
largest id in ties; repeated rows are ranked one after the other; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentyield.llm.tables import numbered
from rentyield.llm.text_arrays import Words, kept_in_worker, slices, text_buffer

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
#: Rows of a bracket that are sorted at once.
MOST = 100_000
ACCURACY = 10_000
#: Longest word whose pairs are hashed through the tables; longer ones are hashed one by one.
_TABLE_BYTES = 64
_LAST = (1 << 63) - 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes that separate words, after lower-casing: all of ASCII but digits and a-z.
_GAP = np.zeros(256, dtype=bool)
_GAP[0:128] = True
_GAP[48:58] = False
_GAP[97:123] = False


def _zero_tables() -> np.ndarray:
    """[length, byte, value]: CRC-32 of what begins with that byte of a sum, followed by ``length`` zero bytes.

    A CRC is linear, so the sum of a text A followed by B is that of A carried over len(B) zero bytes, xor that of B.
    """
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1).astype(np.uint32)
    out = np.zeros((_TABLE_BYTES + 1, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(_TABLE_BYTES):
        out[n + 1] = one[out[n] & 0xFF] ^ (out[n] >> 8)
    return out


def feature_sums(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 and row of every feature of a slice: the words, then the pairs (joined by one space)."""
    if not len(words.code):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    vocabulary = words.vocabulary.to_pylist()
    alone = np.fromiter((zlib.crc32(w) for w in vocabulary), np.uint32, len(vocabulary))
    spaced = np.fromiter((zlib.crc32(b" ", int(c)) for c in alone), np.uint32, len(vocabulary))
    length = np.fromiter((len(w) for w in vocabulary), np.int64, len(vocabulary))
    at = np.flatnonzero(words.row[1:] == words.row[:-1])
    left, right = spaced[words.code[at]], words.code[at + 1]
    table = kept_in_worker("crc tables", _zero_tables)
    size = np.minimum(length[right], _TABLE_BYTES)
    pair = alone[right].copy()
    for byte in range(4):
        pair ^= table[size, byte, (left >> np.uint32(8 * byte)) & 0xFF]
    for i in np.flatnonzero(length[right] > _TABLE_BYTES):
        pair[i] = zlib.crc32(vocabulary[right[i]], int(left[i]))
    return np.concatenate([alone[words.code], pair]), np.concatenate([words.row, words.row[at]])


def _features(part: pa.RecordBatch, text: str, buckets: int) -> tuple[Words, np.ndarray, np.ndarray]:
    data, offsets = text_buffer(part.column(text))
    words = Words(_LOWER[data], offsets, _GAP)
    sums, row = feature_sums(words)
    return words, (sums % np.uint32(buckets)).astype(np.int64), row


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket. Each task counts what it reads; Spark sums by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for part in slices(batches, "t"):
            held += np.bincount(_features(part, "t", buckets)[1], minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(held[some])], ["bucket", "n"])

    counted = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():       # a row per bucket
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares), target to source, per bucket."""
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float((int(t) + 1) * (s_all + buckets)) / float((int(s) + 1) * (t_all + buckets))))
                     for s, t in zip(source, target)], dtype=np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_features, weight): the floored mean gain of each text's features."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            words, bucket, row = _features(part, "t", buckets)
            n = np.bincount(row, minlength=part.num_rows).astype(np.int64)
            total = np.bincount(row, weights=gains[bucket], minlength=part.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("k"), pa.array(words.per_row.astype(np.int64)), pa.array(n), pa.array(total // np.maximum(n, 1))],
                ["k", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, "k long, n_words long, n_features long, weight long").withColumnRenamed("k", key)


def gumbel(key: str, seed: int) -> Column:
    """Noise in whole thousandths from the first 32 bits of sha256('<seed>:<id>')."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


@dataclass(frozen=True)
class Cutoff:
    """Place of the last row drawn, and how it was found: rows sorted at the end, brackets validated and widened."""

    values: tuple[int, int]
    sorted_rows: int
    brackets: int
    widened: int


def locate(rows: DataFrame, k: int, order: tuple[str, str], most: int = MOST, accuracy: int = ACCURACY,
           margin: float = 2.0) -> Cutoff:
    """Values of the two ``order`` columns (longs without nulls, ascending) in the k-th row.

    ``margin`` is the bracket's half width in units of the sketch's rank error. Counts outside are exact, so a
    sketch that is off costs another round and never a wrong row.
    """
    first, second = order
    brackets = widened = 0
    rest, left = rows, k
    for column in order:
        while True:
            n = rest.count()
            half = margin / accuracy
            while True:
                place = (left - 0.5) / n
                lo, hi = rest.agg(F.percentile_approx(column, [max(place - half, 0.0), min(place + half, 1.0)], accuracy)).first()[0]
                if half >= 1:                                   # the whole range, whatever the sketch says
                    lo, hi = rest.agg(F.min(column), F.max(column)).first()
                under, upto = rest.agg(F.count_if(F.col(column) < lo), F.count_if(F.col(column) <= hi)).first()
                brackets += 1
                if under < left <= upto:
                    break
                widened += 1
                half = max(8 * half, 1 / accuracy)
            rest, left = rest.filter(F.col(column).between(lo, hi)), left - under
            if upto - under <= most:
                at = rest.orderBy(first, second).select(first, second).offset(left - 1).limit(1).first()
                return Cutoff((at[0], at[1]), upto - under, brackets, widened)
            if lo == hi or upto - under == n:                   # one value, or as narrow as the sketch gets
                break
        if lo != hi:                                            # halve by value until one is left
            while lo < hi:
                mid = (lo + hi) // 2
                upto = rest.filter(F.col(column) <= mid).count()
                brackets += 1
                if left <= upto:
                    rest, hi = rest.filter(F.col(column) <= mid), mid
                else:
                    rest, lo, left = rest.filter(F.col(column) > mid), mid + 1, left - upto
    return Cutoff((rest.agg(F.min(first)).first()[0], lo), 0, brackets, widened)


def _ranked(drawn: DataFrame, parts: int = 64) -> DataFrame:
    """``rank`` by (_v, _id), without one task for all rows: a window per score value, started by a small table."""
    # rows without an id tie with each other: any order will do, so they are dealt over several windows
    drawn = drawn.withColumn("_p", F.when(F.col("_null"), 1 + F.pmod("_row", F.lit(parts))).otherwise(F.lit(0)))
    before = Window.orderBy("_v", "_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = drawn.groupBy("_v", "_p").agg(F.count("*").alias("_n")).select(
        F.col("_v").alias("_sv"), F.col("_p").alias("_sp"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    number = F.row_number().over(Window.partitionBy("_v", "_p").orderBy("_id", "_row"))
    return (drawn.withColumn("_number", number)
            .join(F.broadcast(starts), (F.col("_v") == F.col("_sv")) & (F.col("_p") == F.col("_sp")))
            .withColumn("rank", F.col("_start") + F.col("_number")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED, most: int = MOST, accuracy: int = ACCURACY,
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_features, weight, score, rank): one row per input row; ``rank`` is null where the row is not drawn.

    ``percent`` of the rows with ``least_words`` words or more are drawn, by score, ties to the smaller id.
    """
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, text, buckets))
    scored = weighted(docs, gains, key, text).withColumnRenamed(key, "_key")
    scored = numbered(scored.withColumn("score", F.col("weight") + gumbel("_key", seed)))
    scored = scored.withColumns({"_v": -F.col("score"), "_id": F.coalesce("_key", F.lit(_LAST)), "_null": F.col("_key").isNull()})
    enough = F.col("n_words") >= least_words
    able = scored.filter(enough)
    k = percent * able.count() // 100
    out = [F.col("_key").alias(key), "n_features", "weight", "score"]
    if k == 0:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    v, i = locate(able.select("_v", "_id"), k, ("_v", "_id"), most, accuracy).values
    chosen = enough & ((F.col("_v") < v) | ((F.col("_v") == v) & (F.col("_id") <= i)))
    # rows equal to the last one drawn may be more than there is room for
    rank = F.when(F.col("rank") <= k, F.col("rank")).cast("long").alias("rank")
    return (_ranked(scored.filter(chosen)).select(*out, rank)
            .unionByName(scored.filter(~chosen).select(*out, F.lit(None).cast("long").alias("rank"))))
