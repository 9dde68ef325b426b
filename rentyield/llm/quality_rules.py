"""Quality rules by n-gram perplexity under a modified Kneser-Ney model.

The model is over the characters (UTF-8 bytes) of words, with a space as word boundary, so its
n-grams stay inside a word and a word's probability can be computed once per distinct word. Spark
counts the n-grams of every whole text per language: each task counts what it reads, the partial
counts are summed by key. Lower orders use continuation counts, each order and language has the
three discounts of modified Kneser-Ney estimated from its counts of counts.

An n-gram of at most 7 bytes is packed into a 64-bit key with its length, so the keys are exact.
For scoring the model is held as sorted key arrays with parallel log-probabilities and back-off
weights (one pair per language and order), looked up by binary search. It is sent to the tasks only
while it has at most ``max_model_rows`` rows; beyond that the n-grams of each document are joined
with the probability table instead, with the same result.

A document is rejected when its mean log-probability leaves the band of its language: median
perplexity (in log space) plus ``upper`` or minus ``lower`` times the median absolute deviation.
Medians are taken exactly over a histogram of the log-perplexities in thousandths.

Defined results: a null or empty text has no words and fails the base rule; a null language is a
language of its own; repeated rows are scored alike; an empty table gives an empty result; other
columns of the input are ignored (``quality``) or passed on (``keep_good``).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentyield.llm.tables import durable, fewer_tasks, numbered, release
from rentyield.llm.text_arrays import Words, binary_array, slices, text_buffer, window_codes, window_rows

ORDER = 5
#: Occurrences from which a longest n-gram counts.
LEAST = 3
#: Fitted on scores in deviations from the median of the language (0.1 GB of prose in four languages and planted texts, 40 of a
#: kind and language): 99.5 % of the prose lies below 19, texts in two languages below 24; with half of the words
#: replaced by random letters texts lie above 38, with letters shuffled within words above 64, and most texts under
#: another language's label above 25. Words in another order score alike: the n-grams stay inside words.
UPPER = 27.0
LOWER = 12.0
#: Floor of the deviation, in thousandths of a nat: a language whose texts are all alike rejects none of them.
LEAST_MAD = 20
MAX_MODEL_ROWS = 4_000_000
_BOUNDARY = 0x20


def _settled(df: DataFrame) -> DataFrame:
    """Checkpointed, and the shuffle files of the steps before let go."""
    out = durable(df)
    release(df.sparkSession)
    return out


def word_grams(vocabulary: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Key of the n-gram ending at each byte of ' word ' after the first, and the word of each.

    The n-gram is the last ``order`` bytes, or fewer where the word begins: then it starts with the
    boundary. Key: length in the highest byte, then the bytes.
    """
    data, offsets = text_buffer(vocabulary)
    size = np.diff(offsets)
    n = len(size)
    padded = np.full(len(data) + 2 * n, _BOUNDARY, dtype=np.uint64)
    begin = offsets[:-1] + 2 * np.arange(n)
    padded[np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, size)] = data
    word = np.repeat(np.arange(n), size + 2)
    place = np.arange(len(padded)) - np.repeat(begin, size + 2)
    key = np.zeros(len(padded), dtype=np.uint64)
    for back in range(order - 1, -1, -1):
        shifted = np.concatenate([np.zeros(back, np.uint64), padded[:len(padded) - back]])
        key = np.where(place >= back, (key << np.uint64(8)) | shifted, key)
    length = np.minimum(place + 1, order).astype(np.uint64)
    at = place >= 1
    return (key[at] | (length[at] << np.uint64(56))), word[at]


def _languages(batch: pa.RecordBatch, lang: str) -> tuple[np.ndarray, list]:
    coded = batch.column(lang).cast(pa.string()).dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def gram_counts(docs: DataFrame, order: int = ORDER, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, key, n): occurrences of each longest n-gram over all texts. Nulls: empty text, own language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for part in slices(batches, text):
            words = Words(*text_buffer(part.column(text)))
            if not len(words.code):
                continue
            keys, word = word_grams(words.vocabulary, order)
            codes, names = _languages(part, lang)
            of_word = codes[words.row]
            for i, name in enumerate(names):
                often = np.bincount(words.code[of_word == i], minlength=len(words.vocabulary))
                weight = often[word]
                some = weight > 0
                held.setdefault(name, []).append(_summed(keys[some], weight[some]))
                if len(held[name]) >= 8:
                    held[name] = [_summed(*(np.concatenate(x) for x in zip(*held[name])))]
        for name, parts in held.items():
            key, n = _summed(*(np.concatenate(x) for x in zip(*parts)))
            for a in range(0, len(key), 100_000):
                k = key[a:a + 100_000].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(k), pa.string()), pa.array(k), pa.array(n[a:a + 100_000])], ["lang", "key", "n"])

    partial = fewer_tasks(docs.select(text, lang)).mapInArrow(count, "lang string, key long, n long")
    return partial.groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(key):
        return key, n.astype(np.int64)
    by = np.argsort(key, kind="stable")
    key, n = key[by], n[by]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n.astype(np.int64), first)


def _suffix(key: Column, n: int) -> Column:
    """The last n - 1 bytes of an n-gram's key, as a key."""
    return key.bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1)) + F.lit((n - 1) << 56)


def _prefix(key: Column, n: int) -> Column:
    """The first n - 1 bytes (the context) of an n-gram's key, as a key."""
    return F.shiftright(key.bitwiseAND(F.lit((1 << 8 * n) - 1)), 8) + F.lit((n - 1) << 56)


def kneser_ney(counts: DataFrame, order: int = ORDER, least: int = LEAST) -> DataFrame:
    """(lang, key, logp, backoff): modified Kneser-Ney, interpolated; one row per n-gram seen.

    ``backoff`` is the log weight that the n-gram, as a context, gives to the next lower order. Longest
    n-grams with fewer than ``least`` occurrences, and shorter ones of three bytes or more with a single
    left neighbour, are discounted whole: their probability is the lower order's. Else a text that
    nothing else resembles would be predicted by its own counts. ``least`` = 1 switches this off.
    """
    level = {}
    for k in range(order, 0, -1):
        grams = counts.filter(F.shiftright("key", 56) == k).select("lang", "key", "n")
        if k < order:
            # distinct left extensions; n-grams at the beginning of a word have none and keep their counts
            continued = level[k + 1].groupBy("lang", _suffix(F.col("key"), k + 1).alias("key")).agg(F.count("*").alias("n"))
            grams = durable(continued.unionByName(grams).groupBy("lang", "key").agg(F.sum("n").alias("n")))
        level[k] = grams
    # all orders in one plan: planning each again and again is what takes the driver's memory
    grams = reduce(DataFrame.unionByName, [x.withColumn("len", F.lit(k)).withColumn("context", _prefix(F.col("key"), k)) for k, x in level.items()])
    ones = [F.sum((F.col("n") == i).cast("long")).alias(f"t{i}") for i in (1, 2, 3, 4)]
    t = [F.col(f"t{i}").cast("double") for i in range(1, 5)]
    y = t[0] / (t[0] + 2 * t[1])
    # where a count of counts is zero the discount falls back to fixed values
    d = [F.when((t[i] > 0) & (t[i + 1] > 0), F.least(F.greatest(i + 1 - (i + 2) * y * t[i + 1] / t[i], F.lit(0.1)), F.lit(i + 1.0)))
         .otherwise(F.lit((0.5, 1.0, 1.5)[i])) for i in range(3)]
    table = grams.groupBy("lang", "len").agg(*ones).select(F.col("lang").alias("_l"), F.col("len").alias("_len"), *[x.alias(f"d{i + 1}") for i, x in enumerate(d)])
    table = durable(table)          # a row per language and order
    rows = grams.join(F.broadcast(table), F.col("lang").eqNullSafe(F.col("_l")) & (F.col("len") == F.col("_len"))).drop("_l", "_len")
    least_of = F.when(F.col("len") == order, least).when(F.col("len") > 2, 2 if least > 1 else 1).otherwise(1)
    cut = F.when(F.col("n") < least_of, F.col("n")).when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = rows.withColumn("cut", cut)
    # a context's key holds its length, so contexts of different orders are apart
    totals = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("cut").alias("freed"))
    totals = totals.select(F.col("lang").alias("_l"), F.col("context").alias("_c"), "total",
                           (F.col("freed") / F.col("total")).alias("gamma"))
    rows = rows.join(totals, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("context") == F.col("_c")))
    own = (F.col("n") - F.col("cut")) / F.col("total")
    rows = rows.select("lang", "key", "len", "context", own.alias("own"), "gamma")
    del level, grams, totals
    rows = _settled(rows)
    levels, model = [], None
    for k in range(1, order + 1):
        grams = rows.filter(F.col("len") == k)
        if k == 1:
            grams = grams.withColumn("lower", F.lit(1.0 / 256))
        else:
            below = model.select(F.col("lang").alias("_m"), F.col("key").alias("_k"), F.exp("logp").alias("lower"))
            grams = grams.join(below, F.col("lang").eqNullSafe(F.col("_m")) & (_suffix(F.col("key"), k) == F.col("_k")))
        model = durable(grams.select("lang", "key", F.log(F.col("own") + F.col("gamma") * F.col("lower")).alias("logp"), "context", "gamma"))
        levels.append(model)
    model = reduce(DataFrame.unionByName, levels)
    weights = model.groupBy(F.col("lang").alias("_l"), F.col("context").alias("_c")).agg(F.log(F.max("gamma")).alias("backoff"))
    return (model.join(weights, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("key") == F.col("_c")), "left")
            .select("lang", "key", "logp", F.coalesce("backoff", F.lit(0.0)).alias("backoff")))


def gram_arrays(rows: pa.Table) -> dict:
    """The model as sorted key arrays: language -> (keys, log-probabilities, back-off weights)."""
    coded = rows.column("lang").combine_chunks().dictionary_encode(null_encoding="encode")
    code, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    key, logp, backoff = (rows.column(c).to_numpy() for c in ("key", "logp", "backoff"))
    out = {}
    for i, name in enumerate(names):
        at = np.flatnonzero(code == i)
        at = at[np.argsort(key[at])]
        out[name] = (key[at], logp[at], backoff[at])
    return out


def gram_logp(arrays: dict, lang: str | None, keys: np.ndarray) -> np.ndarray:
    """Log-probability of each n-gram; unseen ones back off to shorter ones, at last to 1/256."""
    out = np.zeros(len(keys))
    if lang not in arrays:
        return out + np.log(1.0 / 256)
    known, logp, backoff = arrays[lang]
    left = np.arange(len(keys))
    key = keys.astype(np.int64)
    while len(left):
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        hit = known[at] == key
        out[left[hit]] += logp[at[hit]]
        left, key = left[~hit], key[~hit]
        n = key >> 56
        out[left[n == 1]] += np.log(1.0 / 256)
        left, key, n = left[n > 1], key[n > 1], n[n > 1]
        context = ((key & ((np.int64(1) << (8 * n)) - 1)) >> 8) + ((n - 1) << 56)
        at = np.minimum(np.searchsorted(known, context), len(known) - 1)
        out[left] += np.where(known[at] == context, backoff[at], 0.0)
        key = (key & ((np.int64(1) << (8 * (n - 1))) - 1)) + ((n - 1) << 56)
    return out


def base_figures(part: pa.RecordBatch, words: Words, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Word, symbol, repeated-line and repeated-window figures of each text of a slice."""
    rows = len(offsets) - 1
    row_of_byte = np.repeat(np.arange(rows), np.diff(offsets))
    letter = words.solid & ((data & 0xC0) != 0x80)          # first byte of a code point, in a word
    symbol = np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8))
    out = {"n_words": words.per_row, "word_chars": np.bincount(row_of_byte[letter], minlength=rows),
           "n_symbols": np.bincount(row_of_byte[symbol], minlength=rows)}
    # lines: a text's pieces between \n
    cut = np.concatenate([np.flatnonzero(data == 0x0A) + 1, offsets[:-1]])
    cut = np.unique(cut[cut < len(data)])
    bounds = np.append(cut, len(data))
    line_row = row_of_byte[cut] if len(cut) else np.zeros(0, np.int64)
    has_word = np.add.reduceat(words.solid, cut, dtype=np.int64) > 0 if len(cut) else np.zeros(0, bool)
    size = np.diff(bounds)
    ends_line = data[bounds[1:] - 1] == 0x0A if len(cut) else np.zeros(0, bool)
    # without the closing \n, so that a last line equals an earlier one
    keep = np.ones(len(data), bool)
    keep[(bounds[1:] - 1)[ends_line]] = False
    code = binary_array(data[keep], np.concatenate([[0], np.cumsum(size - ends_line)])).dictionary_encode()
    code = code.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    line_row, code = line_row[has_word], code[has_word]
    seen = np.unique(line_row * (int(code.max()) + 1 if len(code) else 1) + code, return_index=True)[1]
    out["n_dup_lines"] = np.bincount(line_row, minlength=rows) - np.bincount(line_row[seen], minlength=rows)
    # words in windows of three that occur twice or more in their text
    marked = np.zeros(len(words.code) + 3, bool)
    at = window_rows(words.first, 3)
    at = at[at + 2 < len(words.code)]
    if len(at):
        window = window_codes(words.code, 3)[at]
        pair = pd.factorize(words.row[at] * (int(window.max()) + 1) + window)[0]
        twice = at[np.bincount(pair)[pair] > 1]
        for k in range(3):
            marked[twice + k] = True
    out["n_repeat_words"] = np.bincount(words.row[marked[:len(words.code)]], minlength=rows)
    return out


FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(docs: DataFrame, model: dict | None, order: int = ORDER, key: str = "doc_id",
            text: str = "text", lang: str = "lang") -> DataFrame:
    """Base figures per row, with the sum of log-probabilities and the number of n-grams if a model is given."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for part in slices(batches, text):
            data, offsets = text_buffer(part.column(text))
            words = Words(data, offsets)
            figures = base_figures(part, words, data, offsets)
            total, grams = np.zeros(part.num_rows), np.zeros(part.num_rows, np.int64)
            if len(words.code):
                keys, word = word_grams(words.vocabulary, order)
                often = np.bincount(word, minlength=len(words.vocabulary))
                grams = np.bincount(words.row, weights=often[words.code], minlength=part.num_rows).astype(np.int64)
                codes, names = _languages(part, lang)
                of_word = codes[words.row]
                for i, name in enumerate(names if held else []):
                    mine = of_word == i
                    used = np.zeros(len(words.vocabulary), bool)
                    used[words.code[mine]] = True
                    some = used[word]
                    each = np.bincount(word[some], weights=gram_logp(held, name, keys[some]), minlength=len(words.vocabulary))
                    total += np.bincount(words.row[mine], weights=each[words.code[mine]], minlength=part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(key), part.column(lang).cast(pa.string()), *[pa.array(figures[f].astype(np.int64)) for f in FIGURES],
                 pa.array(total), pa.array(grams)], [key, lang, *FIGURES, "sum_logp", "n_grams"])

    return docs.select(key, text, lang).mapInArrow(
        run, f"{key} long, {lang} string, " + ", ".join(f"{f} long" for f in FIGURES) + ", sum_logp double, n_grams long")


def joined_scores(docs: DataFrame, model: DataFrame, order: int, key: str, text: str, lang: str) -> DataFrame:
    """(key, sum_logp) by a join of each row's n-grams with the model: the way for a model too large to send."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, 1 << 20):
            words = Words(*text_buffer(part.column(text)))
            if not len(words.code):
                continue
            keys, word = word_grams(words.vocabulary, order)
            gram, distinct = pd.factorize(keys)
            each = np.bincount(word, minlength=len(words.vocabulary))
            start = np.concatenate([[0], np.cumsum(each)])
            size = each[words.code]
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            pair = np.repeat(words.row, size) * len(distinct) + gram[np.repeat(start[words.code], size) + inside]
            pair, n = np.unique(pair, return_counts=True)
            row = pair // len(distinct)
            yield pa.RecordBatch.from_arrays(
                [part.column(key).take(pa.array(row)), part.column(lang).cast(pa.string()).take(pa.array(row)),
                 pa.array(distinct[pair % len(distinct)].astype(np.int64)), pa.array(n)], [key, "lang", "key", "n"])

    rows = docs.select(key, text, lang).mapInArrow(grams, f"{key} long, lang string, key long, n long")
    probability = model.select(F.col("lang").alias("_l"), F.col("key").alias("_k"), "logp")
    return (rows.join(probability, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("key") == F.col("_k")))
            .groupBy(key).agg(F.sum(F.col("n") * F.col("logp")).alias("sum_logp")))


def bands(scored: DataFrame, lang: str, upper: float, lower: float) -> DataFrame:
    """(lang, low, high) in thousandths of a nat: exact medians over a histogram per language."""

    def median(df: DataFrame, value: str, out: str) -> DataFrame:
        hist = df.groupBy(lang, value).agg(F.count("*").alias("n"))         # at most some 10,000 values a language
        w = Window.partitionBy(lang)
        upto = F.sum("n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
        return (hist.withColumn("upto", upto).withColumn("total", F.sum("n").over(w))
                .filter(2 * F.col("upto") >= F.col("total")).groupBy(F.col(lang).alias("_b")).agg(F.min(value).alias(out)))

    some = scored.filter("ppl IS NOT NULL").select(lang, "ppl")
    mid = median(some, "ppl", "mid")
    off = some.join(F.broadcast(mid), F.col(lang).eqNullSafe(F.col("_b"))).select(lang, F.abs(F.col("ppl") - F.col("mid")).alias("off"))
    mad = median(off, "off", "mad").withColumnRenamed("_b", "_b2")
    width = F.greatest(F.col("mad"), F.lit(LEAST_MAD))
    return (mid.join(F.broadcast(mad), F.col("_b").eqNullSafe(F.col("_b2")))
            .select("_b", (F.col("mid") - lower * width).alias("low"), (F.col("mid") + upper * width).alias("high")))


def quality(docs: DataFrame, order: int = ORDER, upper: float = UPPER, lower: float = LOWER,
            max_model_rows: int = MAX_MODEL_ROWS, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per input row: base figures, ``ppl`` (mean -log p in thousandths), ``base_failed`` and ``kept``."""
    docs = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text),
                       F.col(lang).cast("string").alias(lang))
    model = _settled(kneser_ney(_settled(gram_counts(docs, order, text, lang)), order))
    if model.count() <= max_model_rows:
        scored = measure(docs, gram_arrays(model.toArrow()), order, key, text, lang)
    else:
        # by row number: rows of the same id, or of none, are scored by their own texts
        rows = numbered(docs)
        sums = joined_scores(rows, model, order, "_row", text, lang).withColumnRenamed("_row", "_sum")
        scored = measure(rows, None, order, "_row", text, lang).drop("sum_logp").withColumnRenamed("_row", "_figures")
        scored = (rows.select("_row", key).join(scored, F.col("_row") == F.col("_figures"))
                  .join(sums, F.col("_row") == F.col("_sum"), "left").drop("_row", "_figures", "_sum"))
    ppl = F.when(F.col("n_grams") > 0, F.round(-1000 * F.col("sum_logp") / F.col("n_grams")).cast("long"))
    scored = _settled(scored.withColumn("ppl", ppl))
    limits = bands(scored, lang, upper, lower)      # a row per language
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    inside = F.coalesce(F.col("ppl").between(F.col("low"), F.col("high")), F.lit(False))
    return (scored.join(F.broadcast(limits), F.col(lang).eqNullSafe(F.col("_b")), "left")
            .withColumn("base_failed", failed).withColumn("kept", ~failed & inside)
            .select(key, lang, *FIGURES, "ppl", "base_failed", "kept"))


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text the rules keep: by row, so repeated and missing ids do not matter."""
    rows = numbered(docs)
    verdict = quality(rows, key="_row", **options).filter("kept").select(F.col("_row").alias("_kept"))
    return rows.join(verdict, F.col("_row") == F.col("_kept"), "left_semi").drop("_row")
