"""Periodic runs of words, found by an online sparse diagonal pass over each text.

A run is a stretch of words with smallest period q, at least max(least, times * q) words long, that no neighbouring
word extends. A text is read word by word. The earlier occurrences of what has just been read are its active lags: a
lag d matches as long as each word equals the one d before it, and its match length grows by one. When a lag ceases to
match, its diagonal ends, and a run is emitted if the diagonal is long enough.

What keeps the pass sparse, without losing a run:

* A run of five or more words has ``least - 1`` (five) matches in a row, so occurrences are those of five words in a row, and
  texts without a repeated one (nearly all) are done with after one vectorised pass over many texts.
* A lag of five or more is opened only where the five words also occur one lag further on, or one more back.
* While a lag q matches that is long enough already, a longer lag whose earlier place lies in the same run is
  not opened: two runs of periods q < d share fewer than q + d words, so the other run, if there is one, is
  met again outside, and its diagonal is then followed back to its first match.

Lags of a multiple of the period give the same stretch; the smallest is kept. A text's pass uses memory in
proportion to the text; Spark deals the texts over the tasks.

Defined results: a null text has no words and no runs; repeated rows are treated alike; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentyield.llm.text_arrays import Words, slices, text_buffer, window_codes, window_rows

LEAST = 6
TIMES = 4
_MANY = 64      # earlier occurrences from which they are compared as an array

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def runs_of(windows: np.ndarray, repeated: np.ndarray, span: int, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text, by start, then period.

    ``windows`` has the code of the ``span`` words from each place, ``repeated`` whether the text has it again.
    """
    code = windows.tolist()
    places, words = len(code), len(code) + span - 1
    seen: dict[int, array] = {}
    active: dict[int, int] = {}         # lag -> first place that matched
    found: dict[tuple[int, int], int] = {}

    def enough(lag: int, last: int) -> bool:
        length = last + span - active[lag] + lag
        return length >= least and length >= times * lag

    def close(lag: int, last: int) -> None:
        if enough(lag, last):
            stretch = (active[lag] - lag, last + span)
            found[stretch] = min(lag, found.get(stretch, lag))
        del active[lag]

    def candidates(held: array, at: int, settled: list[tuple[int, int]]) -> Iterator[int]:
        """Lags of earlier places, nearest first, leaving out those inside a run that is settled."""
        reach = max(at - min(words // times, words - at), 0)
        high = len(held)
        while high:
            skip = None
            for lag, begin in settled:
                if begin <= held[high - 1] < at - lag:
                    skip = begin
                    break
            if skip is not None:
                high = bisect_left(held, skip, 0, high)
                continue
            # down to where a settled run begins to hide places
            low = 0
            for lag, begin in settled:
                if at - lag <= held[high - 1]:
                    low = max(low, bisect_left(held, at - lag, 0, high))
            low = max(low, bisect_left(held, reach, 0, high))
            if low >= high:
                return
            if high - low < _MANY:
                for j in range(high - 1, low - 1, -1):
                    lag = at - held[j]
                    if lag < 5 or (at + lag < places and code[at + lag] == code[at]) or (at >= 2 * lag and code[at - 2 * lag] == code[at]):
                        yield lag
            else:
                lags = at - np.frombuffer(held, dtype=np.int64)[low:high]
                ahead = windows[np.minimum(at + lags, places - 1)] == code[at]
                back = windows[np.maximum(at - 2 * lags, 0)] == code[at]
                fits = (lags < 5) | (ahead & (at + lags < places)) | (back & (at >= 2 * lags))
                yield from lags[fits][::-1].tolist()
            high = low

    previous = -1
    for at in np.flatnonzero(repeated).tolist():
        if at != previous + 1:
            for lag in list(active):
                close(lag, previous)
        previous = at
        now = code[at]
        for lag in [d for d in active if code[at - d] != now]:
            close(lag, at - 1)
        held = seen.get(now)
        if held is None:
            seen[now] = array("q", [at])
            continue
        settled = [(lag, first - lag) for lag, first in active.items() if enough(lag, at)]
        opened = [lag for lag in candidates(held, at, settled) if lag not in active]
        for lag in opened:
            first = at
            while first > lag and code[first - 1] == code[first - 1 - lag]:      # hidden by another run until now
                first -= 1
            active[lag] = first
        held.append(at)
    for lag in list(active):
        close(lag, previous)
    return sorted((a, b - a, lag) for (a, b), lag in found.items())


def runs_of_slice(data: np.ndarray, offsets: np.ndarray, least: int, times: int) -> tuple[Words, dict[int, list[tuple[int, int, int]]]]:
    """Row -> its runs, for the rows of a slice that have any."""
    words = Words(data, offsets)
    span = least - 1
    at = window_rows(words.first, span)
    at = at[at + span <= len(words.code)]
    out: dict[int, list[tuple[int, int, int]]] = {}
    if not len(at):
        return words, out
    window = window_codes(words.code, span)[at]
    row = words.row[at]
    pair = pd.factorize(row * (int(window.max()) + 1) + window)[0]
    again = np.bincount(pair)[pair] > 1
    bounds = np.searchsorted(row, np.arange(words.rows + 1))
    for r in np.unique(row[again]).tolist():
        a, b = bounds[r], bounds[r + 1]
        runs = runs_of(pair[a:b], again[a:b], span, least, times)
        if runs:
            out[r] = runs
    return words, out


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, runs, collapsed): the runs of each text, and its words without what repeats a run's first period.

    ``collapsed`` has the kept words joined by one space: a word goes where a run holds it after the run's first
    ``period`` words. ``least`` is 3 at least and ``times`` 3 at least.
    """
    if least < 3 or times < 3:
        raise ValueError("least and times must be 3 or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "t"):
            data, offsets = text_buffer(part.column("t"))
            _, found = runs_of_slice(data, offsets, least, times)
            raw = data.tobytes()
            kept = []
            for r in range(part.num_rows):
                words = raw[offsets[r]:offsets[r + 1]].split()      # by the white space of ASCII
                if r in found:
                    keep = np.ones(len(words), bool)
                    for start, length, period in found[r]:
                        keep[start + period:start + length] = False
                    words = [words[i] for i in np.flatnonzero(keep)]
                kept.append(b" ".join(words))
            runs = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in found.get(r, [])] for r in range(part.num_rows)], _RUNS)
            yield pa.RecordBatch.from_arrays([part.column("k"), runs, pa.array(kept, pa.binary()).cast(pa.string())], ["k", "runs", "collapsed"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, f"k long, runs {RUNS}, collapsed string").withColumnRenamed("k", key)


def planted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text): a tenth of the texts, chosen by a hash of the id, made periodic from some word on.

    With h = crc32 of the decimal id and g = h // 10: where h % 10 = 0 and the text has n > 0 words, each word i from
    a = g % n on becomes the word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8); the words are joined by one space.
    Texts without id, and all others, are as they were.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column("k").to_pylist(), batch.column("t")
            changed = {}
            for r, i in enumerate(ids):
                if i is None or (h := zlib.crc32(str(i).encode())) % 10 or not column[r].is_valid:
                    continue
                words, g = column[r].as_py().encode().split(), h // 10
                if words:
                    n = len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    changed[r] = b" ".join(words[:a] + [words[a + (j - a) % p] for j in range(a, n)]).decode()
            if changed:
                texts = column.to_pylist()
                for r, t in changed.items():
                    texts[r] = t
                column = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("k"), column.cast(pa.string())], ["k", "t"])

    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, "k long, t string").toDF(key, text)


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of runs, the longest run (ties: smallest start, then period), and digests of the runs and the kept words."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period)))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","),
                                                   r.period.cast("string"), F.lit("\n")))
    found = found.withColumn("_best", best)
    length, period = F.col("_best").getField("length"), -F.col("_best").getItem("col3")
    return found.select(
        key, F.size("runs").cast("long").alias("n_runs"), (-F.col("_best").getItem("col2")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
