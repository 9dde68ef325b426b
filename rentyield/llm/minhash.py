"""Near-duplicate texts by MinHash banding with sequential Bayesian verification.

1. Each whole text becomes a set of word shingles (64-bit hashes) and a signature of
   ``bands * rows`` min-hashes. Texts with the same set are one class, of which the smallest id stands
   for all.
2. Banded candidates: texts that share a band's hashes are in a bucket; each member is paired with
   the bucket's smallest id. No bucket is expanded into all its pairs.
3. Sequential verification: signatures are compared in batches of hashes. After each batch a pair is
   dropped if the posterior probability (uniform prior) that its similarity reaches the threshold is
   below ``miss``. The survivors are verified exactly on the full sets.
4. Buckets whose members are not all in one component after that are compared once more, so that no
   link between members is lost to the choice of the partner in step 2. Members outside the
   bucket's largest component are held against all of that component's members in such buckets, in
   blocks of ``BLOCK``: signatures first, then full sets, up to the first link. The members outside
   are also compared with each other, and survivors of the same pruning verified exactly.
5. Components of all links.

With 32 bands of 5 rows a pair at similarity 0.8 shares no bucket with probability 3e-6, and less
above it.

Defined results: a null or empty text, or one without words, has an empty set and no links; a text
with fewer words than a shingle is one shingle; rows of the same id are one vertex; a row without id
has no links and no component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentyield.llm.components import components
from rentyield.llm.tables import durable, numbered
from rentyield.llm.text_arrays import Words, hash_bytes, mix64, slices, text_buffer

WIDTH = 5
SIMILARITY = 80
BANDS = 32
ROWS = 5
BATCH = 32
MISS = 1e-6
BLOCK = 256


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 0x41) & (data <= 0x5A), data + 0x20, data).astype(np.uint8)


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within the row, and the rows' bounds."""
    data, offsets = text_buffer(column)
    words = Words(lower_ascii(data), offsets)
    if not len(words.code):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    hashed = hash_bytes(*text_buffer(words.vocabulary))[words.code]
    first, count = words.first, words.per_row
    total = len(hashed)
    rolled = np.full(total, np.uint64(width))
    for k in range(min(width, total)):
        rolled[:total - k] = mix64(rolled[:total - k] * np.uint64(0x9E3779B97F4A7C15) + hashed[k:])
    each = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(each)])
    at = np.repeat(first[:-1], each) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], each)
    out = rolled[at]
    for row in np.flatnonzero((count > 0) & (count < width)):     # the whole sequence as one
        value = np.uint64([count[row]])
        for h in hashed[first[row]:first[row + 1]]:
            value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + h)
        out[bounds[row]] = value[0]
    row = np.repeat(np.arange(len(count)), each)
    by = np.lexsort((out, row))
    out, row = out[by], row[by]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[new], np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(count)))])


def signatures(docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS,
               key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, same, bands, sig): ``same`` identifies the set, ``sig`` holds 16 bits per hash."""
    n = bands * rows
    seeds = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for part in slices(batches, text, 4 << 20):
            sets, bounds = shingle_sets(part.column(text), width)
            size = np.diff(bounds)
            some = np.flatnonzero(size)
            sig = np.zeros((part.num_rows, n), np.uint32)
            for i in range(n):
                if len(some):
                    low = np.minimum.reduceat((sets + seeds[n + i]) * seeds[i], bounds[some])
                    sig[some, i] = low >> np.uint64(32)
            keys = np.zeros((part.num_rows, bands), np.uint64)
            for b in range(bands):
                value = np.full(part.num_rows, b + 1, np.uint64)
                for r in range(rows):
                    value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + sig[:, b * rows + r].astype(np.uint64))
                keys[:, b] = value
            raw = sets.tobytes()
            same = [xxhash.xxh3_128_digest(raw[8 * a:8 * z]) for a, z in zip(bounds[:-1], bounds[1:])]
            short = np.ascontiguousarray((sig & 0xFFFF).astype("<u2")).tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column(key), pa.array(size, pa.int64()), pa.array(same, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands), pa.int32()), pa.array(keys.ravel().view(np.int64))),
                 pa.array([short[2 * n * i:2 * n * (i + 1)] for i in range(part.num_rows)], pa.binary())],
                [key, "n_shingles", "same", "bands", "sig"])

    return docs.select(key, text).mapInArrow(run, f"{key} long, n_shingles long, same binary, bands array<long>, sig binary")


def least_matches(n: int, batch: int, similarity: int, miss: float) -> list[tuple[int, int]]:
    """(hashes compared, matches needed): with fewer, P(similarity >= threshold) is below ``miss``.

    With a uniform prior and m of k hashes equal, that probability is P(Binomial(k + 1, threshold) <= m).
    """
    t = similarity / 100
    out = []
    for k in [*range(batch, n, batch), n]:
        p, need = 0.0, 0
        for m in range(k + 1):
            p += comb(k + 1, m) * t**m * (1 - t) ** (k + 1 - m)
            if p >= miss:
                need = m
                break
        out.append((k, need))
    return out


def _pruned(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Rows of two signature matrices that no batch of hashes rules out."""
    left = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    done = 0
    for k, need in steps:
        matches = matches + (a[left, done:k] == b[left, done:k]).sum(axis=1)
        some = matches >= need
        left, matches, done = left[some], matches[some], k
    return left


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    data, offsets = text_buffer(column)
    return np.ascontiguousarray(data).view("<u2").reshape(len(offsets) - 1, -1)


def prune(pairs: DataFrame, sigs: DataFrame, steps: list[tuple[int, int]]) -> DataFrame:
    """The pairs (a, b) that the sequential comparison of their signatures leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left = pa.array(_pruned(_matrix(batch.column("sig_a")), _matrix(batch.column("sig_b")), steps))
                yield batch.select(["a", "b"]).take(left)

    both = (pairs.join(sigs.select(F.col("id").alias("_a"), F.col("sig").alias("sig_a")), F.col("a") == F.col("_a"))
            .join(sigs.select(F.col("id").alias("_b"), F.col("sig").alias("sig_b")), F.col("b") == F.col("_b")))
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose full sets reach the similarity (in percent)."""
    both = (pairs.join(sets.select(F.col("id").alias("_a"), F.col("items").alias("set_a")), F.col("a") == F.col("_a"))
            .join(sets.select(F.col("id").alias("_b"), F.col("items").alias("set_b")), F.col("b") == F.col("_b")))
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = both.select("a", "b", common.alias("n"), (F.size("set_a") + F.size("set_b")).alias("m"))
    return both.filter(100 * F.col("n") >= similarity * (F.col("m") - F.col("n"))).select("a", "b")


def set_table(docs: DataFrame, ids: DataFrame, width: int, key: str, text: str) -> DataFrame:
    """(id, items): the shingle sets of the documents ``ids`` (a column id, distinct)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, 4 << 20):
            sets, bounds = shingle_sets(part.column(text), width)
            yield pa.RecordBatch.from_arrays(
                [part.column(key), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sets.view(np.int64)))],
                ["id", "items"])

    chosen = docs.join(ids, F.col(key) == F.col("id"), "left_semi").select(key, text)
    return chosen.mapInArrow(run, "id long, items array<long>")


def _open_buckets(members: DataFrame, label: DataFrame) -> DataFrame:
    """(bucket, id, component, main): rows of buckets whose members are in several components; ``main`` is
    the component of most of them. ``label``: (vertex, component) of those with links so far."""
    named = (members.join(label, F.col("id") == F.col("vertex"), "left")
             .select("bucket", "id", F.coalesce("component", "id").alias("component")))
    sizes = named.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("total"))
    main = main.filter(F.col("total") > F.col("top.n")).select(F.col("bucket").alias("_bucket"), F.col("top.component").alias("main"))
    return named.join(main, F.col("bucket") == F.col("_bucket")).drop("_bucket")


def _in_blocks(rows: DataFrame, group: str, first: Column) -> DataFrame:
    """Deal the rows of a group into blocks: (group, i, k) holds block i of the rows where ``first``, and block k of the others."""
    sizes = rows.groupBy(group).agg(F.sum(first.cast("long")).alias("n"), F.sum((~first).cast("long")).alias("m"))
    sizes = sizes.select(F.col(group).alias("_group"), F.ceil(F.col("n") / BLOCK).cast("int").alias("n"), F.ceil(F.col("m") / BLOCK).cast("int").alias("m"))
    rows = rows.join(sizes.filter("n > 0 AND m > 0"), F.col(group) == F.col("_group")).drop("_group")
    mine = F.pmod(F.xxhash64("id"), F.when(first, F.col("n")).otherwise(F.col("m"))).cast("int")
    other = F.when(first, F.col("m")).otherwise(F.col("n"))
    return (rows.withColumn("_mine", mine).withColumn("_other", F.explode(F.sequence(F.lit(0), other - 1)))
            .withColumn("i", F.when(first, F.col("_mine")).otherwise(F.col("_other")))
            .withColumn("k", F.when(first, F.col("_other")).otherwise(F.col("_mine"))).drop("n", "m", "_mine", "_other"))


def links_to_main(opened: DataFrame, sigs: DataFrame, sets: DataFrame, steps: list[tuple[int, int]], similarity: int) -> DataFrame:
    """(a, b): for members outside their bucket's main component, a link to a member of it, if there is one.

    Each such text is compared with all texts of that component that are in open buckets, block by
    block: signatures first, then the full sets, from the most similar down to the first link.
    """
    rows = opened.select("main", "id", (F.col("component") == F.col("main")).alias("inside")).distinct()
    rows = _in_blocks(rows, "main", F.col("inside"))
    rows = (rows.join(sigs.select(F.col("id").alias("_id"), "sig"), F.col("id") == F.col("_id")).drop("_id")
            .join(sets.select(F.col("id").alias("_id"), "items"), F.col("id") == F.col("_id")).drop("_id"))

    def compare(group: pa.Table) -> pa.Table:
        inside = group.column("inside").to_numpy()
        ids, sig, items = group.column("id").to_numpy(), _matrix(group.column("sig")), group.column("items").combine_chunks()
        sets = [items[i].values.to_numpy() for i in range(len(ids))]
        ours, found = np.flatnonzero(inside), []
        for x in np.flatnonzero(~inside):
            left = ours[_pruned(np.broadcast_to(sig[x], (len(ours), sig.shape[1])), sig[ours], steps)]
            alike = (sig[left] == sig[x]).sum(axis=1)
            for y in left[np.argsort(-alike, kind="stable")]:
                n = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * n >= similarity * (len(sets[x]) + len(sets[y]) - n):
                    found.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                    break
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("main", "i", "k").applyInArrow(compare, "a long, b long")


def candidates_beside_main(opened: DataFrame, sigs: DataFrame, steps: list[tuple[int, int]]) -> DataFrame:
    """(a, b): pairs that survive pruning among members of a bucket outside its main component, in different ones."""
    rest = opened.filter(F.col("component") != F.col("main")).select("bucket", "id", "component")
    sizes = rest.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"), F.count("*").alias("all"))
    rest = rest.join(sizes.filter(F.col("all") > 1).select(F.col("bucket").alias("_bucket"), "n"), F.col("bucket") == F.col("_bucket")).drop("_bucket")
    rest = rest.withColumn("_mine", F.pmod(F.xxhash64("id"), F.col("n")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rest = rest.select("bucket", "id", "component", F.least("_mine", "_other").alias("i"), F.greatest("_mine", "_other").alias("k"), "_mine")
    rest = rest.join(sigs.select(F.col("id").alias("_id"), "sig"), F.col("id") == F.col("_id")).drop("_id")

    def compare(group: pa.Table) -> pa.Table:
        ids, part, mine = (group.column(c).to_numpy() for c in ("id", "component", "_mine"))
        across = group.column("i")[0].as_py() != group.column("k")[0].as_py()       # two blocks: pairs within one are met elsewhere
        sig = _matrix(group.column("sig"))
        found = []
        for x in range(len(ids) - 1):
            other = x + 1 + np.flatnonzero((part[x + 1:] != part[x]) & (~across | (mine[x + 1:] != mine[x])))
            if len(other):
                left = other[_pruned(np.broadcast_to(sig[x], (len(other), sig.shape[1])), sig[other], steps)]
                found += [(min(ids[x], ids[y]), max(ids[x], ids[y])) for y in left]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rest.groupBy("bucket", "i", "k").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY, bands: int = BANDS,
                    rows: int = ROWS, miss: float = MISS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_shingles, component_id (smallest id reachable), kept."""
    docs = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    steps = least_matches(bands * rows, BATCH, similarity, miss)
    found = durable(signatures(docs, width, bands, rows, key, text).withColumnRenamed(key, "id"))
    some = found.filter("id IS NOT NULL AND n_shingles > 0")
    classes = some.groupBy("same").agg(F.min("id").alias("rep"))
    classed = some.select("id", "same").join(classes.withColumnRenamed("same", "_same"), F.col("same") == F.col("_same"))
    copies = durable(classed.select("id", "rep").distinct())
    reps = copies.select("rep").distinct()
    sigs = found.select("id", "sig")

    banded = (some.select("id", "bands").join(reps, F.col("id") == F.col("rep"), "left_semi")
              .select(F.explode("bands").alias("bucket"), "id"))
    # a table of its own: Spark splits a large bucket in a join of two plain shuffles
    buckets = durable(banded.groupBy("bucket").agg(F.min("id").alias("least"), F.count("*").alias("n")).filter("n > 1"))
    members = durable(banded.join(buckets.withColumnRenamed("bucket", "_bucket"), F.col("bucket") == F.col("_bucket"))
                      .select("bucket", "id", "least", "n"))
    pairs = members.filter(F.col("id") > F.col("least")).select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    likely = durable(prune(pairs, sigs, steps))
    # sets of what may have to be verified: survivors, and members of buckets with more than a pair
    wanted = (likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id")))
              .unionByName(members.filter("n > 2").select("id")).distinct())
    sets = durable(set_table(docs, wanted, width, key, text))
    links = durable(verify(likely, sets, similarity))

    more = members.filter("n > 2").select("bucket", "id")
    opened = durable(_open_buckets(more, components(links)))
    late = durable(links_to_main(opened, sigs, sets, steps, similarity)
                   .unionByName(verify(candidates_beside_main(opened, sigs, steps), sets, similarity)))

    same_set = copies.filter(F.col("id") > F.col("rep")).select(F.col("rep").alias("a"), F.col("id").alias("b"))
    label = components(links.unionByName(late).unionByName(same_set))
    out = found.select("id", "n_shingles").join(label, F.col("id") == F.col("vertex"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, all columns, without those that are near-duplicates of a smaller id.

    For tables of unique ids: rows of the same id stay or go together. Else see ``keep_one_row``.
    """
    gone = near_duplicates(docs, key=key, **options).filter(~F.col("kept")).select(F.col(key).alias("_gone")).distinct()
    return docs.join(gone, F.col(key) == F.col("_gone"), "left_anti")


def keep_one_row(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, of each group of near-duplicates only one: that of the smallest id.

    Rows are linked by their own texts, whatever their ids; rows without id come last, and of rows of
    the same id the first numbered one stays.
    """
    rows = numbered(docs)
    found = near_duplicates(rows, key="_row", text=text, **options).select(F.col("_row").alias("_of"), "component_id")
    named = rows.select("_row", F.col(key).cast("long").alias("_key")).join(found, F.col("_row") == F.col("_of"))
    first = F.min(F.struct(F.col("_key").isNull().alias("none"), "_key", "_row"))
    kept = named.groupBy("component_id").agg(first.alias("one")).select(F.col("one._row").alias("_kept"))
    return rows.join(kept, F.col("_row") == F.col("_kept"), "left_semi").drop("_row")
