"""Severity of toxicity by cumulative-link ordinal regression on sparse word features.

Grades are ordered: 0 not toxic, 1 toxic, 2 toxic and of low quality (from the labels ``toxic`` and
``quality``). One weight vector w serves all thresholds t1 <= t2: P(grade >= k) = sigmoid(w.x - t_k).
Features are the distinct words of a text (ASCII letters lower-cased, punctuation at the ends cut) and
their beginnings of ``PREFIXES`` characters, hashed into ``2^BITS`` buckets. A bucket can enter if at
least ``MIN_TEXTS`` sample texts have it; the ``FEATURES`` buckets most associated with toxicity do,
and an L1 penalty, lighter for strong association, leaves few of them with a weight.

The model is fitted on a bounded sample: the ``SAMPLE`` labelled documents with the smallest hash of
their key; only their bucket numbers reach the driver. Every document is scored by its whole text.
Output: the expected severity, the probability of each grade, the most likely grade, and ``toxic``
(probability of grade 1 or more is at least ``TOXIC``).

Defined results: a null or empty text has no features and the severity of the thresholds alone;
labels that are null, conflict or name no document are no part of the sample; without any label all
severities are 0; repeated rows are scored alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentyield.llm.text_arrays import Words, hash_bytes, mix64, slices, text_buffer

BITS = 22
SAMPLE = 12_000
MIN_TEXTS = 3
FEATURES = 4_000
PREFIXES = (4, 5, 6, 7)
GRADES = 3
ROUNDS = 300
PENALTY = 1.0
#: Probability of grade 1 or more from which a text counts as toxic: a miss weighs four times a false alarm.
TOXIC = 0.2
_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def word_buckets(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket): buckets of each word and of its beginnings of PREFIXES characters; none for punctuation."""
    words = pc.utf8_trim(pc.ascii_lower(vocabulary.cast(pa.large_string())), characters=_EDGES)
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    number, bucket = [], []
    for n in (*PREFIXES, None):
        some = np.flatnonzero(size > (n or 0))          # a beginning is shorter than the word
        if not len(some):
            continue
        held = words.take(pa.array(some))
        # beginnings are hashed once each, and apart from whole words
        coded = (held if n is None else pc.utf8_slice_codeunits(held, 0, n)).dictionary_encode()
        hashed = mix64(hash_bytes(*text_buffer(coded.dictionary)) + np.uint64(n or 0))
        number.append(some)
        bucket.append((hashed >> np.uint64(64 - BITS)).astype(np.int64)[coded.indices.to_numpy(zero_copy_only=False)])
    if not number:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(number), np.concatenate(bucket)


def features(part: pa.RecordBatch, text: str, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket), distinct, sorted by row; only of ``wanted`` buckets if given."""
    words = Words(*text_buffer(part.column(text)))
    if not len(words.code):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    number, bucket = word_buckets(words.vocabulary)
    if wanted is not None:
        number, bucket = number[wanted[bucket]], bucket[wanted[bucket]]
    by = np.argsort(number, kind="stable")
    number, bucket = number[by], bucket[by]
    each = np.bincount(number, minlength=len(words.vocabulary))
    first = np.cumsum(each) - each
    some = np.flatnonzero(each[words.code])
    code, row = words.code[some], words.row[some]
    size = each[code]
    at = np.repeat(first[code] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    pair = np.unique((np.repeat(row, size) << BITS) | bucket[at])
    return pair >> BITS, pair & ((1 << BITS) - 1)


def sample_features(docs: DataFrame, labels: DataFrame, key: str, text: str, sample: int) -> list:
    """(grade, buckets) of the sampled documents."""
    grade = F.when(F.col("toxic") == 0, 0).when(F.col("quality") == 0, 2).when(F.col("quality") == 1, 1)
    known = labels.select(F.col(key).cast("long").alias("_key"), grade.alias("grade")).filter("_key IS NOT NULL AND grade IS NOT NULL")
    known = known.groupBy("_key").agg(F.min("grade").alias("grade"), F.max("grade").alias("_max")).filter("grade = _max").drop("_max")
    known = known.orderBy(F.xxhash64("_key"), "_key").limit(sample)       # at most `sample` rows of two numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            row, bucket = features(part, text)
            bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [part.column(key), part.column("grade"), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(bucket.astype(np.int32)))],
                [key, "grade", "buckets"])

    chosen = docs.join(F.broadcast(known), F.col(key) == F.col("_key")).select(key, "grade", text)
    found = chosen.mapInArrow(run, f"{key} long, grade int, buckets array<int>")
    return found.orderBy(F.xxhash64(key), key, "buckets").limit(sample).toArrow()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def _strongest(row: np.ndarray, column: np.ndarray, grade: np.ndarray, often: np.ndarray) -> np.ndarray:
    """Association of each column with grade 1 or more: the score test of a table of two by two."""
    n, share = len(grade), float((grade > 0).mean())
    seen = np.bincount(column, weights=(grade > 0)[row], minlength=len(often))
    spread = often * (1 - often / n) * share * (1 - share)
    return np.abs(seen - often * share) / np.sqrt(np.maximum(spread, 1e-9))


def fit(rows: pa.Table, grades: int = GRADES, min_texts: int = MIN_TEXTS, keep: int = FEATURES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, their weights, and the thresholds: likelihood with an L1 penalty by accelerated proximal steps."""
    grade = rows.column("grade").to_numpy().astype(np.int64)
    lists = rows.column("buckets").combine_chunks()
    flat = lists.flatten().to_numpy()
    row = np.repeat(np.arange(len(grade)), lists.value_lengths().to_numpy())
    if not len(grade):
        return np.zeros(0, np.int64), np.zeros(0), np.full(grades - 1, 30.0)
    bucket, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    strength = np.where(often >= min_texts, _strongest(row, column, grade, often), -1.0)
    use = np.zeros(len(bucket), bool)
    use[np.argsort(-strength, kind="stable")[:keep]] = True
    use &= strength > 0
    some = use[column]
    row, column, bucket = row[some], (np.cumsum(use) - 1)[column[some]], bucket[use]
    # the penalty is lighter for buckets of strong association (adaptive lasso): their value is not 1 but this
    value_of = strength[use] / 3.0
    value = value_of[column]
    n, m = len(grade), len(bucket)
    share = np.clip([(grade >= k).mean() for k in range(1, grades)], 1e-3, 1 - 1e-3)
    cut = np.maximum.accumulate(np.log((1 - share) / share) + 0.1 * np.arange(grades - 1))
    one = np.arange(n)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean negative log-likelihood and its gradient; thresholds are t1, then log distances."""
        gaps = np.exp(x[m + 1:])
        t = x[m] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(row, weights=x[column] * value, minlength=n)
        upper = np.concatenate([np.ones((n, 1)), _sigmoid(score[:, None] - t[None, :]), np.zeros((n, 1))], axis=1)
        p = np.maximum(upper[one, grade] - upper[one, grade + 1], 1e-12)
        slope = upper * (1 - upper)                 # derivative of P(grade >= k) by the score
        d_score = -(slope[one, grade] - slope[one, grade + 1]) / p / n
        d_cut = np.array([np.sum((slope[:, k] / p)[grade == k]) - np.sum((slope[:, k] / p)[grade == k - 1]) for k in range(1, grades)]) / n
        d_gaps = np.cumsum(d_cut[::-1])[::-1]       # a distance moves all thresholds from its own on
        gradient = np.concatenate([np.bincount(column, weights=d_score[row] * value, minlength=m), d_gaps[:1], d_gaps[1:] * gaps])
        return float(-np.log(p).mean()), gradient

    x = np.concatenate([np.zeros(m), cut[:1], np.log(np.maximum(np.diff(cut), 0.1))])
    y, momentum, step = x, 1.0, 1.0
    for _ in range(ROUNDS):
        now, gradient = loss(y)
        while True:
            new = y - step * gradient
            new[:m] = np.sign(new[:m]) * np.maximum(np.abs(new[:m]) - step * PENALTY / n, 0)
            moved = new - y
            if loss(new)[0] <= now + gradient @ moved + moved @ moved / (2 * step) + 1e-12 or step < 1e-6:
                break
            step /= 2
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = new + (momentum - 1) / following * (new - x)
        x, momentum, step = new, following, step * 1.2
    some = np.flatnonzero(x[:m])
    return bucket[some], x[some] * value_of[some], x[m] + np.concatenate([[0.0], np.cumsum(np.exp(x[m + 1:]))])


def severity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(key, expected_severity, severity_grade, p_1, p_2, toxic): one row per input row."""
    docs = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    shared = docs.sparkSession.sparkContext.broadcast(fit(sample_features(docs, labels, key, text, sample)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, weight, cut = shared.value
        dense = np.zeros(1 << BITS)
        dense[bucket] = weight
        wanted = dense != 0
        for part in slices(batches, text):
            row, found = features(part, text, wanted)
            score = np.bincount(row, weights=dense[found], minlength=part.num_rows)
            upper = _sigmoid(score[:, None] - cut[None, :])         # P(grade >= 1), P(grade >= 2)
            each = np.concatenate([1 - upper[:, :1], upper[:, :-1] - upper[:, 1:], upper[:, -1:]], axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column(key), pa.array(upper.sum(axis=1)), pa.array(each.argmax(axis=1)), pa.array(each[:, 1]), pa.array(each[:, 2]),
                 pa.array(upper[:, 0] >= TOXIC)], [key, "expected_severity", "severity_grade", "p_1", "p_2", "toxic"])

    return docs.mapInArrow(run, f"{key} long, expected_severity double, severity_grade long, p_1 double, p_2 double, toxic boolean")
