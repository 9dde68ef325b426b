"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Only vectors with equal, non-null labels are compared. Vectors that are null, zero, or hold null or
non-finite components link with nothing. Equal vectors of a label form a class of which the smallest
id stands for all.

1. Iterative quantisation: principal directions of a bounded sample (``SAMPLE`` vectors with the
   smallest hash), then alternating steps between signs and the rotation that fits them best. The
   signs of a rotated vector are its code of at most 64 bits.
2. Multi-index Hamming tables: a code is cut into substrings, one table each. Codes within ``radius``
   bits agree in one substring to within ``radius // tables`` bits, so probing each table with all
   substrings that close finds every code within the radius. A pair is taken from the first table
   that finds it. Substrings get longer with the number of vectors per label, which changes the
   plan, not the result.
3. Rerank: the cosine of the original vectors in double precision. A bucket where more than
   ``MOST_PAIRS`` pairs meet (a dense group of close vectors) gives no row per pair: chunks of it are
   compared in tasks of their own, which return what each vector links with as a number and the
   smallest vector that it reaches. The links are the same either way.

The radius is set so that two vectors at the threshold differ in more bits with probability ``MISS``
(bits differ independently with probability angle / pi; ITQ does better).

Defined results: rows of the same id are one vertex; a row without id has no links and no component;
repeated rows link with each other as copies do; an empty table gives an empty result; other columns
are ignored; ties play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import acos, comb, pi
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentyield.llm.components import components
from rentyield.llm.tables import durable

SAMPLE = 4_000
SIMILARITY = 0.93
ROUNDS = 50
MISS = 1e-4
MAX_BITS = 64
#: Pairs that meet in a bucket from which its vectors are compared in blocks; components of vectors in a chunk; rows of a block.
MOST_PAIRS = 65_536
CHUNK_VALUES = 131_072
BLOCK_ROWS = 256


def learn_rotation(x: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Directions x bits: principal directions, rotated to balance and fit the signs."""
    bits = min(MAX_BITS, x.shape[1])
    _, _, directions = np.linalg.svd(x.T @ x)
    directions = directions[:bits].T
    projected = x @ directions
    rotation = np.linalg.qr(np.random.default_rng(0).standard_normal((bits, bits)))[0]
    for _ in range(rounds):
        code = np.where(projected @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(code.T @ projected)
        rotation = (left @ right).T
    return directions @ rotation


def radius_for(bits: int, similarity: float, miss: float) -> int:
    """Smallest radius that two vectors at the similarity exceed with probability below ``miss``."""
    p = acos(similarity) / pi
    total = 0.0
    for r in range(bits + 1):
        total += comb(bits, r) * p**r * (1 - p) ** (bits - r)
        if 1 - total < miss:
            return r
    return bits


def _valid(vector: Column) -> Column:
    """Vectors without null or non-finite components, and not zero (in double precision)."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(as_double, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # divided by the largest component first: squares of very large or small ones stay in range
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def codes(classes: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, list[int]]:
    """(id, label, dim, code), and the lengths of vector in use; a rotation is learned for each."""
    dims = [r[0] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n")).collect()]
    rotations = {}
    for dim in dims:
        some = classes.filter(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow()
        rotations[dim] = learn_rotation(_unit(_matrix(some.column("vector").combine_chunks())))
    shared = classes.sparkSession.sparkContext.broadcast(rotations)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim = batch.column("dim").to_numpy()
            code = np.zeros(len(dim), np.uint64)
            for d, rotation in shared.value.items():
                at = np.flatnonzero(dim == d)
                if len(at):
                    sign = _unit(_matrix(batch.column("vector").take(pa.array(at)))) @ rotation >= 0
                    code[at] = (sign.astype(np.uint64) << np.arange(sign.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("dim"), pa.array(code.view(np.int64))],
                                             ["id", "label", "dim", "code"])

    coded = classes.select("id", "label", "dim", "vector").mapInArrow(run, "id long, label long, dim int, code long")
    return coded, dims


class Tables(NamedTuple):
    """Substrings of a code (bit bounds), the bits a probe may differ in, the radius of the whole."""

    bounds: list[int]
    near: int
    radius: int

    @property
    def masks(self) -> Column:
        width = max(b - a for a, b in zip(self.bounds, self.bounds[1:]))
        # masks that a narrower substring lacks find nothing there
        some = [sum(1 << i for i in chosen) for k in range(self.near + 1) for chosen in combinations(range(width), k)]
        return F.array(*[F.lit(m).cast("long") for m in some])

    def part(self, code: Column, t: int) -> Column:
        return F.shiftrightunsigned(code, self.bounds[t]).bitwiseAND(F.lit((1 << self.bounds[t + 1] - self.bounds[t]) - 1))


BUCKET = ["label", "dim", "t", "sub"]


def tables_for(bits: int, radius: int, per_label: int) -> Tables:
    length = min(16, max(8, int(np.ceil(np.log2(max(2, per_label)) - 4.5))))
    n = max(1, bits // length)
    return Tables([bits * t // n for t in range(n + 1)], radius // n, radius)


def index_rows(coded: DataFrame, tables: Tables) -> DataFrame:
    """(label, dim, t, sub, id, code): a row per vector and table."""
    keys = F.array(*[F.struct(F.lit(t).alias("t"), tables.part(F.col("code"), t).alias("sub")) for t in range(len(tables.bounds) - 1)])
    return coded.select("label", "dim", "id", "code", F.explode(keys).alias("k")).select("label", "dim", "k.t", "k.sub", "id", "code")


def probe_rows(index: DataFrame, tables: Tables) -> DataFrame:
    """The rows again under every substring that is near enough to theirs."""
    return index.withColumn("sub", F.explode(F.transform(tables.masks, lambda m: F.col("sub").bitwiseXOR(m))))


def crowded_buckets(index: DataFrame, tables: Tables, most_pairs: int) -> DataFrame:
    """(label, dim, t, sub, n_index, n_probe) of the buckets in which more than ``most_pairs`` pairs meet; from their sizes alone."""
    sizes = durable(index.groupBy(BUCKET).agg(F.count("*").alias("n_index")))
    probes = probe_rows(sizes, tables).groupBy(BUCKET).agg(F.sum("n_index").alias("n_probe"))
    return sizes.join(probes, BUCKET).filter(F.col("n_index") * F.col("n_probe") > most_pairs)


def candidates(index: DataFrame, probe: DataFrame, tables: Tables) -> DataFrame:
    """Pairs (a, b), a < b, of a label whose codes differ in at most ``radius`` bits; each once."""
    index = index.select(*[F.col(c).alias(f"_{c}") for c in BUCKET], F.col("id").alias("b"), F.col("code").alias("code_b"))
    differ = F.col("code").bitwiseXOR(F.col("code_b"))
    first = F.lit(True)
    for t in range(len(tables.bounds) - 2):
        first = first & ((F.col("t") <= t) | (F.bit_count(tables.part(differ, t)) > tables.near))
    same = [F.col(c) == F.col(f"_{c}") for c in BUCKET]
    return (probe.withColumnRenamed("id", "a").join(index, reduce(Column.__and__, same) & (F.col("a") < F.col("b"))
                                                    & (F.bit_count(differ) <= tables.radius) & first).select("a", "b"))


def _reached(linked: np.ndarray, a: np.ndarray, b: np.ndarray, members_a: np.ndarray, members_b: np.ndarray) -> tuple:
    """(vertex, others, root) of the links that the matrix marks: rows that a vertex links with, smallest vertex it reaches.

    A vertex may be both a row and a column. The matrix is gone through in blocks of rows.
    """
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    of_a, of_b = place[:len(a)], place[len(a):]
    blocks = [slice(i, i + BLOCK_ROWS) for i in range(0, len(a), BLOCK_ROWS)]
    others, least, none = np.zeros(len(ids)), np.arange(len(ids)), len(ids)
    for block in blocks:
        others[of_a[block]] += linked[block] @ members_b.astype(float)
        others[of_b] += members_a[block].astype(float) @ linked[block]
    before = None
    while before is None or (before != least).any():
        before = least.copy()
        for block in blocks:
            mine = of_a[block]
            least[of_b] = np.minimum(least[of_b], np.where(linked[block], least[mine][:, None], none).min(axis=0))
            least[mine] = np.minimum(least[mine], np.where(linked[block], least[of_b][None, :], none).min(axis=1))
    some = np.flatnonzero(others)
    return ids[some], others[some].astype(np.int64), ids[least[some]]


def linked_in_blocks(crowded: DataFrame, index: DataFrame, tables: Tables, classes: DataFrame, similarity: float) -> DataFrame:
    """(id, others, root) of the crowded buckets, without a row per pair.

    Both sides of a bucket are dealt into chunks, and every chunk of probes meets every chunk of the index in a task of its own:
    codes within the radius that no earlier table finds, then the cosine of the original vectors. A chunk pair gives a row per
    linked vector and role: the rows it links with, and the smallest vector it reaches there.
    """
    chunk = F.greatest(F.lit(64), F.lit(CHUNK_VALUES) / F.col("dim"))
    crowded = durable(crowded.select(*BUCKET, F.ceil(F.col("n_index") / chunk).cast("int").alias("parts_b"),
                                     F.ceil(F.col("n_probe") / chunk).cast("int").alias("parts_a")))
    mine = F.pmod(F.xxhash64("id"), F.col("parts_a")).cast("int")
    theirs = F.pmod(F.xxhash64("id"), F.col("parts_b")).cast("int")
    # the substrings that probe a crowded bucket are those that it would probe
    near_by = probe_rows(crowded.withColumn("to", F.col("sub")), tables)
    probe = (index.join(near_by, BUCKET).drop("sub").withColumnRenamed("to", "sub")
             .select(*BUCKET, "id", "code", F.lit(True).alias("probe"), mine.alias("part_a"), F.explode(F.sequence(F.lit(0), F.col("parts_b") - 1)).alias("part_b")))
    held = (index.join(crowded, BUCKET)
            .select(*BUCKET, "id", "code", F.lit(False).alias("probe"), F.explode(F.sequence(F.lit(0), F.col("parts_a") - 1)).alias("part_a"), theirs.alias("part_b")))
    vectors = classes.select(F.col("id").alias("_id"), "vector", "members")
    rows = probe.unionByName(held).join(vectors, F.col("id") == F.col("_id")).drop("_id")
    bounds, near, radius = tables

    def link(group: pa.Table) -> pa.Table:
        t, is_probe = group.column("t")[0].as_py(), group.column("probe").to_numpy()
        unit = _unit(_matrix(group.column("vector").combine_chunks()))
        ids, code, members = (group.column(c).to_numpy() for c in ("id", "code", "members"))
        code = code.view(np.uint64)
        a, b = np.flatnonzero(is_probe), np.flatnonzero(~is_probe)
        if not len(a) or not len(b):
            a, b = a[:0], b[:0]
        linked = np.zeros((len(a), len(b)), bool)
        for begin in range(0, len(a), BLOCK_ROWS):
            some = a[begin:begin + BLOCK_ROWS]
            differ = code[some][:, None] ^ code[b][None, :]
            found = (np.bitwise_count(differ) <= radius) & (ids[some][:, None] < ids[b][None, :])
            for k in range(t):
                part = (differ >> np.uint64(bounds[k])) & np.uint64((1 << bounds[k + 1] - bounds[k]) - 1)
                found &= np.bitwise_count(part) > near
            cosine = unit[some] @ unit[b].T
            # a product summed in another order may differ in its last bits: close ones as ``rerank`` sums them
            at = np.nonzero(found & (np.abs(cosine - similarity) < 1e-9))
            cosine[at] = np.minimum(np.einsum("ij,ij->i", unit[some[at[0]]], unit[b[at[1]]]), 1.0)
            linked[begin:begin + BLOCK_ROWS] = found & (cosine >= similarity)
        vertex, others, root = _reached(linked, ids[a], ids[b], members[a], members[b])
        return pa.table({"id": pa.array(vertex, pa.int64()), "others": pa.array(others, pa.int64()), "root": pa.array(root, pa.int64())})

    return rows.groupBy(*BUCKET, "part_a", "part_b").applyInArrow(link, "id long, others long, root long")


def rerank(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """(a, b, cosine) of the pairs at or above the similarity, by the original vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pa.compute.list_value_length(batch.column("vector_a")).to_numpy()
            for d in np.unique(size):
                at = pa.array(np.flatnonzero(size == d))
                a, b = (_matrix(batch.column(c).take(at)) for c in ("vector_a", "vector_b"))
                cosine = np.minimum(np.einsum("ij,ij->i", _unit(a), _unit(b)), 1.0)
                part = batch.select(["a", "b"]).take(at).append_column("cosine", pa.array(cosine))
                yield part.take(pa.array(np.flatnonzero(cosine >= similarity)))

    import pyarrow.compute  # noqa: F401  (pa.compute in the tasks)
    both = (pairs.join(classes.select(F.col("id").alias("_a"), F.col("vector").alias("vector_a")), F.col("a") == F.col("_a"))
            .join(classes.select(F.col("id").alias("_b"), F.col("vector").alias("vector_b")), F.col("b") == F.col("_b")))
    return both.select("a", "b", "vector_a", "vector_b").mapInArrow(run, "a long, b long, cosine double")


def near_duplicates(vectors: DataFrame, similarity: float = SIMILARITY, sample: int = SAMPLE, miss: float = MISS,
                    key: str = "vec_id", vector: str = "embedding", label: str = "label", most_pairs: int = MOST_PAIRS) -> DataFrame:
    """One row per input row: key, n_links (other rows linked directly), component_id, kept."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    rows = durable(rows.withColumn("ok", F.col("id").isNotNull() & F.col("label").isNotNull() & _valid(F.col("vector")))
                   .withColumn("same", F.xxhash64("label", "vector")))
    good = rows.filter("ok")
    # grouping by the vector itself, not only by its hash
    classes = good.groupBy("label", "same", "vector").agg(F.min("id").alias("id"), F.count("*").alias("members"))
    classes = durable(classes.withColumn("dim", F.size("vector")))
    coded, dims = codes(classes, sample)
    coded = durable(coded)
    top = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    pairs, counted = [], []
    for dim in dims:        # lengths that at least two vectors have
        bits = min(MAX_BITS, dim)
        tables = tables_for(bits, radius_for(bits, similarity, miss), top)
        index = index_rows(coded.filter(F.col("dim") == dim), tables)
        crowded = durable(crowded_buckets(index, tables, most_pairs))
        pairs.append(candidates(index.join(crowded, BUCKET, "left_anti"), probe_rows(index, tables), tables))
        if not crowded.isEmpty():
            counted.append(linked_in_blocks(crowded, index, tables, classes, similarity))
    none = coded.filter("false")
    pairs = reduce(DataFrame.unionByName, pairs, none.select(F.col("id").alias("a"), F.col("id").alias("b")))
    links = durable(rerank(pairs, classes, similarity))
    # from the crowded buckets: rows linked with and a vertex reached, instead of the links
    counted = reduce(DataFrame.unionByName, counted, none.select("id", F.col("id").alias("others"), F.col("id").alias("root")))
    counted = durable(counted.groupBy("id", "root").agg(F.sum("others").alias("others")))

    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("id").alias("_b"), F.col("members").alias("more"))
    linked = (both.join(sizes, F.col("b") == F.col("_b")).select("a", "more").unionByName(counted.select(F.col("id").alias("a"), F.col("others").alias("more")))
              .groupBy("a").agg(F.sum("more").alias("others")))
    links = links.select("a", "b").unionByName(counted.select(F.col("id").alias("a"), F.col("root").alias("b")))
    label_of = components(links)
    classes = (classes.join(linked, F.col("id") == F.col("a"), "left").join(label_of, F.col("id") == F.col("vertex"), "left")
               .select("label", "same", "vector", "members", F.col("id").alias("rep"),
                       (F.coalesce("others", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    classes = classes.select(F.col("label").alias("_label"), F.col("same").alias("_same"), F.col("vector").alias("_vector"), "n_links", "component_id")
    out = rows.join(classes, F.col("ok") & (F.col("label") == F.col("_label")) & (F.col("same") == F.col("_same"))
                    & (F.col("vector") == F.col("_vector")), "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
