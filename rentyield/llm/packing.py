"""Best-fit packing by sum of squares: token pieces into sequences of a fixed size.

A document's tokens are its ids and an end id. Only documents longer than a sequence are cut: into
pieces of the full size, the first of which may be shorter. Full pieces fill a sequence each. The
others are dealt at random into blocks of about ``block_items`` pieces, and each block is packed by
the sum-of-squares rule: a piece goes to the open sequence it fits for which the sum over residual
gaps of the squared number of open sequences with that gap becomes smallest (ties: the smallest
gap). Pieces are taken from long to short, and a new sequence is opened only where no open one fits:
measured on the test tables this leaves a block at most a few sequences above total / size.

Defined results: a null or empty text has the end id alone; repeated rows are packed each; texts of
any length are encoded whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentyield.llm.bpe import Ragged, Vocabulary, WordBlock, _vocabulary
from rentyield.llm.tables import durable
from rentyield.llm.text_arrays import slices

SIZE = 1024
END_ID = 2
BLOCK_ITEMS = 50_000
#: Words that a task remembers with their ids; beyond it the memory starts anew.
REMEMBERED = 300_000


def _ids_of(words: list[bytes], vocabulary: Vocabulary, held: dict) -> Ragged:
    if len(held) > REMEMBERED:
        held.clear()
    found = []
    for word in words:
        ids = held.get(word)
        if ids is None:
            text = word.decode("utf-8", "surrogateescape")
            ids = held[word] = [vocabulary.added[text]] if text in vocabulary.added else vocabulary.encode(word)
        found.append(ids)
    size = np.fromiter(map(len, found), np.int64, len(found))
    values = np.fromiter((i for ids in found for i in ids), np.uint32, int(size.sum()))
    return Ragged(values, np.concatenate([[0], np.cumsum(size)]))


def pieces(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = True,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): each document's tokens, cut where longer than ``size``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        held: dict = {}
        for part in slices(batches, text):
            block = WordBlock(part.column(text), vocabulary.added)
            lists = _ids_of(block.words.to_pylist(), vocabulary, held)
            begin = 0
            while begin < part.num_rows:            # documents in groups of a bounded number of words
                base = block.first[begin]
                to = max(begin + 1, int(np.searchsorted(block.first, base + 500_000, side="right")) - 1)
                ids, bounds = lists.take(block.code[base:block.first[to]])
                ends = bounds[block.first[begin:to + 1] - base][1:]
                ids = np.insert(ids.astype("<u4"), ends, end_id)            # an end id after each document
                ends = ends + np.arange(1, to - begin + 1)
                total = np.diff(np.concatenate([[0], ends]))
                count = -(-total // size)
                row = np.repeat(np.arange(to - begin), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                short = total - (count - 1) * size                          # the first piece
                start = np.where(piece == 0, 0, short[row] + (piece - 1) * size)
                length = np.where(piece == 0, short[row], size)
                at = (ends - total)[row] + start
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at, at + length)]
                out = [part.column(key).slice(begin, to - begin).take(pa.array(row)), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = [key, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(at, at[-1] + length[-1]), pa.int32()),
                                                        pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)
                begin = to

    schema = f"{key} long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).mapInArrow(run, schema)


def sum_of_squares(length: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each item; items are placed from long to short; a bin is opened where none fits."""
    bins_of_gap: list[list[int]] = [[] for _ in range(size + 1)]
    count = np.zeros(size + 1, np.int64)            # open bins per gap; a gap of 0 does not count
    gap_of: list[int] = []
    bin_of = np.zeros(len(length), np.int64)
    offset = np.zeros(len(length), np.int64)
    never = np.iinfo(np.int64).max
    for i in np.argsort(-length, kind="stable").tolist():
        s = int(length[i])
        here = count[s:]                            # gaps s .. size, of bins that the item fits
        change = 2 * (count[:size + 1 - s] - here) + 2
        change[0] = 1 - 2 * here[0]                 # the bin gets full
        change[here == 0] = never
        best = int(change.argmin())
        if change[best] < never:
            gap = best + s
            b = bins_of_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, b = size, len(gap_of)
            gap_of.append(size)
        bin_of[i], offset[i] = b, size - gap
        gap_of[b] = gap - s
        if gap > s:
            bins_of_gap[gap - s].append(b)
            count[gap - s] += 1
    return bin_of, offset


def pack(items: DataFrame, size: int = SIZE, block_items: int = BLOCK_ITEMS, length: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``size`` tokens. ``items`` is materialised once."""
    items = durable(items.withColumn("_item", F.monotonically_increasing_id()))     # numbers are fixed from here on
    short = items.filter(F.col(length) < size)
    blocks = max(1, -(-short.count() // block_items))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("_item")          # the same packing whatever order the rows came in
        bins, offset = sum_of_squares(group.column(length).to_numpy(), size)
        block = group.column("_block")[0].as_py()
        return pa.table({"_placed": group.column("_item"), "sequence_id": pa.array(bins + (block << 32)), "offset": pa.array(offset)})

    placed = (short.select("_item", length, F.pmod(F.xxhash64("_item"), F.lit(blocks)).alias("_block"))
              .groupBy("_block").applyInArrow(run, "_placed long, sequence_id long, offset long"))
    full = items.filter(F.col(length) >= size).select(F.col("_item").alias("_placed"), (-1 - F.col("_item")).alias("sequence_id"),
                                                      F.lit(0).cast("long").alias("offset"))
    return items.join(placed.unionByName(full), F.col("_item") == F.col("_placed")).drop("_item", "_placed")


def pack_documents(docs: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID, with_ids: bool = True,
                   block_items: int = BLOCK_ITEMS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their place: sequences are ``sequence_id`` ordered by ``offset``."""
    return pack(pieces(docs, path, size, end_id, with_ids, key, text), size, block_items)
