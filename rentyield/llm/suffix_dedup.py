"""Repeated byte strings by bucket-pointer refinement over sampled suffixes.

Wanted are all strings of ``LENGTH`` bytes that start at two or more places of the corpus. Suffixes
get bucket identifiers: the identifier of the first 2k bytes of a suffix is made from the
identifiers of its first k bytes and of the first k bytes of the suffix k later, and so on
recursively; equal strings have equal identifiers, in every task and without a shuffle.

1. Initial buckets: suffixes by their first ``GRAM`` bytes. Only sampled suffixes ("anchors") are
   kept: a place is an anchor if its identifier is the smallest among the grams of some string of
   LENGTH bytes around it. Equal strings have equal anchors at equal offsets, so every repeated
   string contains an anchor whose bucket has two members. Buckets of one member are dropped.
2. Refinement by what surrounds the anchor (all strings of LENGTH bytes that contain its gram lie in
   there): members of a bucket with equal surroundings are settled at once, all of it is repeated.
3. Buckets that are left with unlike members are refined window by window: the identifiers of the
   LENGTH bytes at each offset from the anchor, again made of identifiers at later offsets, are
   sorted within the bucket; those found twice are repeated. A bucket with more than ``MOST`` unlike
   members (a passage in very many texts) is dealt to several tasks; strings that one of them has only
   once are then counted over all by an aggregate.

Each distinct surrounding takes part once, whatever the number of its copies. Identifiers have 64
bits and are compared within a bucket, itself a 64-bit identifier.

Rows are numbered once, in a stored table of numbers and texts that all steps read: how the input is
split when it is planned again, or how many executors are alive then, does not matter.

Defined results: a null text counts as empty and stays null in ``without_repeats``; repeated rows are
copies of one another and match; texts of any length are treated whole; an empty table gives an
empty result; other columns are ignored (``repeats``) or kept (``without_repeats``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentyield.llm.tables import durable, numbered, release
from rentyield.llm.text_arrays import mix64, slices, text_buffer

LENGTH = 400
#: Unlike members of a bucket that are gathered in one group; surroundings gathered in one task at once.
MOST = 20_000
GATHERED = 4_000
CHUNK = 2_000
#: Shares of the identifiers (a power of two) that are sorted one after the other.
SHARES = 16


def _gram(length: int) -> int:
    """Bytes of the initial buckets: the largest power of two below the length."""
    return 1 << ((length - 1).bit_length() - 1)


def identifiers(data: np.ndarray, length: int) -> np.ndarray:
    """Bucket identifier of the first ``length`` bytes (8 at least) at each place that has so many."""
    places = len(data) - 7
    if len(data) < length:
        return np.zeros(0, np.uint64)
    raw = np.ascontiguousarray(data)
    name = mix64(np.ndarray(places, dtype="<u8", buffer=raw, strides=(1,)))
    have = 8
    while have < length:
        step = min(have, length - have)         # the later offset whose identifier is used again
        later = name[step:]
        name = name[:len(name) - step] * np.uint64(0x9E3779B97F4A7C15 + 2 * have)
        name += later
        have += step
    return name


def _window_min(x: np.ndarray, w: int, function=np.minimum, fill=np.uint64(2**64 - 1)) -> np.ndarray:
    """Smallest of each w in a row."""
    n = len(x) - w + 1
    blocks = np.concatenate([x, np.full(-len(x) % w, fill)]).reshape(-1, w)
    ahead = function.accumulate(blocks, axis=1).ravel()[w - 1:w - 1 + n]
    behind = np.ascontiguousarray(function.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()[:n]
    return function(ahead, behind)


def anchor_places(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors in the buffer, and their identifiers. Strings lie inside a row."""
    gram = _gram(length)
    width = length - gram + 1
    name = identifiers(data, gram)
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least = _window_min(name, width)
    end = np.repeat(offsets[1:], np.diff(offsets))
    outside = np.arange(len(least)) + length > end[:len(least)]
    least[outside] = 0                          # no string of a row begins here
    # a place is an anchor if it is the smallest of one of the strings that contain it
    none = np.zeros(width - 1, np.uint64)
    largest = _window_min(np.concatenate([none, least, none]), width, np.maximum, np.uint64(0))
    at = np.flatnonzero(largest == name)
    at = at[at + gram <= end[at]]
    return at, name[at]


def anchors(docs: DataFrame, length: int, text: str) -> DataFrame:
    """(bucket, around, row, place): anchors with the identifier of what surrounds them."""
    reach = length - _gram(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for part in slices(batches, text, 2 << 20):
            data, offsets = text_buffer(part.column(text))
            at, name = anchor_places(data, offsets, length)
            row = np.searchsorted(offsets, at, side="right") - 1
            begin, end = np.maximum(at - reach, offsets[row]), np.minimum(at + length, offsets[row + 1])
            raw = data.tobytes()
            around = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:z], s) for a, z, s in zip(begin.tolist(), end.tolist(), (at - begin).tolist())),
                                 np.uint64, len(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(name.view(np.int64)), pa.array(around.view(np.int64)), part.column("_row").take(pa.array(row)),
                 pa.array((at - offsets[row]).astype(np.int32))], ["bucket", "around", "row", "place"])

    return docs.select("_row", text).mapInArrow(run, "bucket long, around long, row long, place int")


def _windows(table: pa.Table | pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Refined identifier of each window of the surroundings in ``around``, its context, its begin there.

    The identifier also holds the bucket and the window's offset from the anchor.
    """
    data, offsets = text_buffer(table.column("around"))
    size = np.diff(offsets)
    name = identifiers(data, length)
    count = np.maximum(size - length + 1, 0)
    context = np.repeat(np.arange(len(size)), count)
    begin = np.arange(len(context)) - np.repeat(np.cumsum(count) - count, count)
    left = table.column("left").to_numpy()
    bucket = table.column("bucket").to_numpy().view(np.uint64)
    offset = (left[context] - begin).astype(np.uint64)
    return mix64(name[offsets[:-1][context] + begin] ^ mix64(bucket[context] + mix64(offset))), context, begin


def _runs(context: np.ndarray, begin: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge overlapping windows (sorted by context and begin): context, begin and end of each run."""
    if not len(context):
        return context, begin, begin
    new = np.ones(len(context), bool)
    new[1:] = (context[1:] != context[:-1]) | (begin[1:] > begin[:-1] + length)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(context)) - 1
    return context[first], begin[first], begin[last] + length


def surroundings(docs: DataFrame, chosen: DataFrame, length: int, text: str) -> DataFrame:
    """(bucket, n, members, row, place, left, around): the bytes around the chosen anchors."""
    reach = length - _gram(length)
    lists = chosen.groupBy("row").agg(F.collect_list(F.struct("bucket", "n", "members", "place")).alias("chosen"))
    joined = docs.select("_row", text).join(lists, F.col("_row") == F.col("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, 2 << 20):
            data, offsets = text_buffer(part.column(text))
            raw = data.tobytes()
            lists = part.column("chosen")
            flat = lists.flatten()
            of = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            place = flat.field("place").to_numpy().astype(np.int64)
            at = offsets[of] + place
            begin, end = np.maximum(at - reach, offsets[of]), np.minimum(at + length, offsets[of + 1])
            for a in range(0, len(of), 5_000):
                z = slice(a, a + 5_000)
                around = [raw[x:y] for x, y in zip(begin[z].tolist(), end[z].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*[flat.field(c).slice(a, 5_000) for c in ("bucket", "n", "members")], part.column("row").take(pa.array(of[z])),
                     flat.field("place").slice(a, 5_000), pa.array((at - begin)[z].astype(np.int32)), pa.array(around, pa.binary())],
                    ["bucket", "n", "members", "row", "place", "left", "around"])

    return joined.select("row", text, "chosen").mapInArrow(
        run, "bucket long, n long, members long, row long, place int, left int, around binary")


def refine(contexts: DataFrame, length: int) -> DataFrame:
    """(row, begin, end, key, times): spans of strings that a group of surroundings holds twice; and, of
    buckets that several groups share, each string's identifier with its times, row and begin if it is
    alone in the group."""
    schema = pa.schema([("row", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("key", pa.int64()), ("times", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        # identifiers are made for some surroundings at a time: only the windows' own are kept
        key = np.concatenate([_windows(group.slice(a, CHUNK), length)[0] for a in range(0, max(1, group.num_rows), CHUNK)])
        count = np.maximum(pc.binary_length(group.column("around")).to_numpy().astype(np.int64) - length + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(count)])
        shift = group.column("place").to_numpy().astype(np.int64) - group.column("left").to_numpy()
        row = group.column("row").to_numpy()
        # surroundings with copies are settled already, and count twice
        alone = np.repeat(group.column("n").to_numpy() == 1, count)
        crowded = np.repeat(group.column("members").to_numpy() > MOST, count)
        twice = np.zeros(len(key), bool)
        ones, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for share in range(SHARES):         # equal identifiers are in one share; so the sorting takes a part of the memory
            at = np.flatnonzero((key & np.uint64(SHARES - 1)) == np.uint64(share))
            if not len(at):
                continue
            by = at[np.argsort(key[at], kind="stable")]
            ordered = key[by]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            times = np.add.reduceat(np.where(alone[by], 1, 2), first)
            twice[by] = np.repeat(times > 1, np.diff(np.append(first, len(by))))
            shared = crowded[by[first]]
            ones.append(by[first[shared]])
            sums.append(times[shared])

        def placed(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            context = np.searchsorted(bounds, at, side="right") - 1
            return context, at - bounds[context]

        of, a, z = _runs(*placed(np.flatnonzero(twice & alone)), length)
        none = pa.nulls(len(of), pa.int64())
        out = [pa.table([pa.array(row[of]), pa.array(a + shift[of]), pa.array(z + shift[of]), none, none], schema=schema)]
        one, times = np.concatenate(ones), np.concatenate(sums)
        context, begin = placed(one)
        known = times == 1
        out.append(pa.table([pa.array(row[context], mask=~known), pa.array(begin + shift[context], mask=~known),
                             pa.nulls(len(one), pa.int64()), pa.array(key[one].view(np.int64)), pa.array(times)], schema=schema))
        return pa.concat_tables(out)

    return contexts.groupBy("part").applyInArrow(run, "row long, begin long, end long, key long, times long")


def found_elsewhere(refined: DataFrame, length: int) -> DataFrame:
    """(row, begin, end): strings that are alone in their group, and also in another group of the bucket."""
    keys = refined.filter("key IS NOT NULL")
    twice = durable(keys.groupBy("key").agg(F.sum("times").alias("n")).filter("n > 1").select(F.col("key").alias("_key")))
    return (keys.filter("times = 1").join(twice, F.col("key") == F.col("_key"), "left_semi")
            .select("row", "begin", (F.col("begin") + length).alias("end")))


def _merged(begin: np.ndarray, end: np.ndarray, size: int, length: int) -> list[tuple[int, int]]:
    """Union of spans, clipped to the text; a clipped span shorter than the length is none."""
    begin, end = np.maximum(begin, 0), np.minimum(end, size)
    some = end - begin >= length
    begin, end = begin[some], end[some]
    by = np.argsort(begin, kind="stable")
    out: list[tuple[int, int]] = []
    for a, z in zip(begin[by].tolist(), end[by].tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def repeated_spans(docs: DataFrame, length: int, text: str) -> tuple[DataFrame, DataFrame]:
    """Per row number: (row, places), anchors whose surroundings are repeated, and (row, spans), the
    begins and ends of other repeated strings; not yet merged or clipped."""
    spark = docs.sparkSession
    found = anchors(docs, length, text)
    # a table of its own: Spark splits a large bucket in a join of two plain shuffles
    crowd = durable(found.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("bucket").alias("_bucket")))
    release(spark)
    found = durable(found.join(crowd, F.col("bucket") == F.col("_bucket"), "left_semi"))
    release(spark)
    alike = durable(found.groupBy("bucket", "around").agg(F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("one")))
    release(spark)
    settled = found.join(alike.filter("n > 1").select(F.col("bucket").alias("_b"), F.col("around").alias("_a")),
                         (F.col("bucket") == F.col("_b")) & (F.col("around") == F.col("_a")), "left_semi")
    settled = durable(settled.groupBy("row").agg(F.collect_list("place").alias("places")))
    unlike = alike.groupBy("bucket").agg(F.count("*").alias("members"), F.min("n").alias("least"))
    unlike = unlike.filter("members > 1 AND least = 1").select(F.col("bucket").alias("_bucket"), "members")
    chosen = durable(alike.join(unlike, F.col("bucket") == F.col("_bucket")).select(
        "bucket", "n", "members", F.col("one.row").alias("row"), F.col("one.place").alias("place")))
    del found, crowd, alike, unlike
    release(spark)
    parts = max(1, chosen.count() // GATHERED)
    # the members of a crowded bucket are dealt to several groups
    salt = F.pmod(F.xxhash64("row", "place"), F.ceil(F.col("members") / MOST))
    contexts = surroundings(docs, chosen, length, text).withColumn("part", F.pmod(F.xxhash64("bucket", salt), F.lit(parts)))
    refined = durable(refine(contexts, length))
    release(spark)
    spans = refined.filter("key IS NULL").select("row", "begin", "end").unionByName(found_elsewhere(refined, length))
    spans = durable(spans)
    release(spark)
    return settled, spans.groupBy("row").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def _with_spans(docs: DataFrame, length: int, text: str) -> DataFrame:
    """``docs`` with ``_places`` and ``_spans`` of each row."""
    docs = numbered(docs)
    settled, spans = repeated_spans(docs, length, text)
    # the documents may have columns of any name but these
    settled = settled.select(F.col("row").alias("_of"), F.col("places").alias("_places"))
    spans = spans.select(F.col("row").alias("_of"), F.col("spans").alias("_spans"))
    return docs.join(settled, F.col("_row") == F.col("_of"), "left").drop("_of").join(spans, F.col("_row") == F.col("_of"), "left").drop("_of")


def _span_lists(part: pa.RecordBatch, offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int]]]:
    reach = length - _gram(length)
    for i, (places, spans) in enumerate(zip(part.column("_places"), part.column("_spans"))):
        begin, end = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if places.is_valid:
            at = places.values.to_numpy().astype(np.int64)
            begin, end = at - reach, at + length
        if spans.is_valid:
            begin = np.concatenate([begin, spans.values.field("begin").to_numpy()])
            end = np.concatenate([end, spans.values.field("end").to_numpy()])
        yield _merged(begin, end, int(offsets[i + 1] - offsets[i]), length) if len(begin) else []


def repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, spans): what is repeated in each row, byte offsets."""
    docs = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    joined = _with_spans(docs, length, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            data, offsets = text_buffer(part.column(text))
            raw = data.tobytes()
            removed, count, sha, lists = [], [], [], []
            for i, spans in enumerate(_span_lists(part, offsets, length)):
                base, left, to = int(offsets[i]), hashlib.sha256(), 0
                for a, z in spans:
                    left.update(raw[base + to:base + a])
                    to = z
                left.update(raw[base + to:int(offsets[i + 1])])
                removed.append(sum(z - a for a, z in spans))
                count.append(len(spans))
                sha.append(left.hexdigest())
                lists.append([{"begin": a, "end": z} for a, z in spans])
            yield pa.RecordBatch.from_arrays(
                [part.column(key), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(lists, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
                [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return joined.select(key, text, "_places", "_spans").mapInArrow(
        run, f"{key} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin:long,end:long>>")


def _cut(whole: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the spans, which shrink to whole characters."""
    left, to = [], 0
    for a, z in spans:
        while a < len(whole) and whole[a] & 0xC0 == 0x80:       # a cut character stays
            a += 1
        while z < len(whole) and whole[z] & 0xC0 == 0x80:
            z -= 1
        if a < z:
            left.append(whole[to:a])
            to = z
    return (b"".join(left) + whole[to:]).decode("utf-8")


def without_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated strings taken out of ``text``, in whole characters; ``chars``, where
    there is such a column, is the new length of a changed text."""
    names = docs.columns
    joined = _with_spans(docs, length, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            data, offsets = text_buffer(part.column(text))
            lists = list(_span_lists(part, offsets, length))
            columns = {n: part.column(n) for n in names}
            if any(lists):
                raw = data.tobytes()
                made = [_cut(raw[int(offsets[i]):int(offsets[i + 1])], spans) if spans else old
                        for i, (spans, old) in enumerate(zip(lists, part.column(text).to_pylist()))]
                columns[text] = pa.array(made, part.column(text).type)
                if chars in names:
                    n = [len(new) if spans else old for new, spans, old in zip(made, lists, part.column(chars).to_pylist())]
                    columns[chars] = pa.array(n, part.column(chars).type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    return joined.select(*names, "_places", "_spans").mapInArrow(run, docs.schema)
