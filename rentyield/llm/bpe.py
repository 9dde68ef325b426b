"""Byte-level BPE encoding and decoding through a distinct-word table.

``split_words`` cuts the whole texts of a slice into the pieces of the byte-level pre-tokenizer (a
piece is a "word"; together they are the text). Within a block of documents each distinct word gets
a number, and the block's documents become lists of word numbers. The distinct words of all blocks
are dealt out by word and sorted, so that every distinct word of the corpus is encoded once; its ids
return to the blocks by (block, number) and are put in place of the numbers. Decoding joins ids with
the id-to-piece table (bounded by the vocabulary, so each task has a copy) and concatenates pieces.

The documents must come from a source that gives the same rows in the same order when a task is run
again (a file scan does): the blocks of the two branches have to agree. A block whose words do not
all arrive raises an error rather than give wrong ids.

Defined results: null and empty texts have no ids and decode to ''; repeated rows are encoded alike;
texts of any length are encoded whole; the text of an added token becomes its id, as in the
tokenizers library's default; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentyield.llm.text_arrays import (
    LETTER, SPACE, binary_array, character_classes, code_points, kept_in_worker, slices, text_buffer)

BLOCK_BYTES = 32 << 20
#: Bytes that are split into words at once, and rows of ids that a task packs together.
SPLIT_BYTES = 2 << 20
PACKED_ROWS = 400_000

#: The contractions of the pattern.
_CONTRACTIONS = [b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"]


def split_words(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which a word begins; rows begin words. Words are contiguous.

    Follows the pattern 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
    """
    if not len(data):
        return np.zeros(0, np.int64)
    b, lead = code_points(data)
    kind = character_classes()[b]
    n = len(kind)
    row_start = np.zeros(n + 1, bool)
    row_start[np.searchsorted(lead, offsets[:-1])] = True
    row_start = row_start[:n]
    change = np.empty(n, bool)
    change[0] = True
    change[1:] = kind[1:] != kind[:-1]
    change |= row_start
    begin = change.copy()
    # a run of white space before something else gives up its last character: a space joins what
    # follows, another one is a word by itself
    space = kind == SPACE
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~row_start[1:]
    last = np.flatnonzero(last)
    begin[last] = True
    joins = last[b[last] == 0x20]
    begin[joins + 1] = False
    # contractions: a lone apostrophe that begins a word, before a letter
    quote = np.flatnonzero((b == 0x27) & begin)
    quote = quote[quote + 1 < n]
    quote = quote[(kind[quote + 1] == LETTER) & ~row_start[quote + 1]]
    for tail in _CONTRACTIONS:
        k = len(tail)
        some = quote[quote + k < n]
        hit = np.ones(len(some), bool)
        for j, c in enumerate(tail, 1):
            hit &= (b[some + j] == c) & ~row_start[some + j]
        some = some[hit]
        begin[some + 1] = False
        after = some + k + 1
        begin[after[after < n]] = True
        quote = np.setdiff1d(quote, some, assume_unique=True)
    return lead[begin]


class Vocabulary:
    """Ids and pieces of a byte-level BPE file; encodes single words."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            held = json.load(f)
        byte_of = _byte_of_char()
        vocab = {bytes(byte_of[c] for c in piece): i for piece, i in held["model"]["vocab"].items()}
        merges = [x.split(" ") if isinstance(x, str) else x for x in held["model"]["merges"]]
        ranks = [held["model"]["vocab"][a + b] for a, b in merges]
        if ranks != sorted(ranks):
            raise ValueError(f"{path}: ids do not follow the order of merges")
        self.added = {x["content"]: x["id"] for x in held["added_tokens"]}
        self.pieces: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for piece, i in vocab.items():
            self.pieces[i] = piece
        for text, i in self.added.items():
            self.pieces[i] = text.encode()
        self._bpe = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=vocab, special_tokens={})

    def encode(self, word: bytes) -> list[int]:
        """Ids of one word, or of the text of an added token."""
        return self._bpe._encode_single_piece(word)


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for
    themselves, the others numbered from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


def _vocabulary(path: str) -> Vocabulary:
    return kept_in_worker(("vocabulary", path), lambda: Vocabulary(path))


def _added_marks(data: np.ndarray, offsets: np.ndarray, added: dict[str, int]) -> np.ndarray:
    """Begin and end positions of added tokens' texts: they are words of their own."""
    marks: list[int] = []
    raw = None
    for text in added:
        mark = text.encode()
        if raw is None:
            raw = data.tobytes()
        at = raw.find(mark)
        while at >= 0:
            row = np.searchsorted(offsets, at, side="right")
            if at + len(mark) <= offsets[row]:
                marks += [at, at + len(mark)]
                at = raw.find(mark, at + len(mark))
            else:
                at = raw.find(mark, at + 1)
    return np.array(sorted(marks), dtype=np.int64)


class WordBlock:
    """Words of a slice of texts: ``code`` and ``row`` of each, and the distinct ones in ``words``."""

    def __init__(self, column: pa.Array, added: dict[str, int]):
        data, offsets = text_buffer(column)
        marks = _added_marks(data, offsets, added)
        cuts = np.unique(np.concatenate([offsets, marks])) if len(marks) else offsets
        found, at = [], 0
        while at + 1 < len(cuts):           # a bounded number of bytes at once, or one text
            to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + SPLIT_BYTES, side="right")) - 1)
            found.append(split_words(data[cuts[at]:cuts[to]], cuts[at:to + 1] - cuts[at]) + cuts[at])
            at = to
        start = np.concatenate(found) if found else np.zeros(0, np.int64)
        if len(marks):      # nothing begins inside an added token
            between = np.searchsorted(marks, start, side="right")
            start = start[(between % 2 == 0) | np.isin(start, marks[::2])]
        bounds = np.append(start, len(data))
        coded = binary_array(data, bounds).dictionary_encode()
        self.words = coded.dictionary
        self.code = coded.indices.to_numpy(zero_copy_only=False)
        self.per_row = np.diff(np.searchsorted(start, offsets))
        self.first = np.concatenate([[0], np.cumsum(self.per_row)])


class Ragged:
    """Integer lists in one array: list i is ``values[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, values: np.ndarray, bounds: np.ndarray):
        self.values, self.bounds = values, bounds

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen lists one after the other, and the bounds of each."""
        size = np.diff(self.bounds)[at]
        ends = np.cumsum(size)
        shift = np.repeat(self.bounds[:-1][at] - (ends - size), size)
        return self.values[np.arange(len(shift)) + shift], np.concatenate([[0], ends])


def _block_key(partition: int, number: int, data: np.ndarray, offsets: np.ndarray) -> int:
    """A block's place in the scan hashed with its texts: where a second read cuts the scan otherwise, no words are found."""
    import hashlib
    digest = hashlib.blake2b(np.array([partition, number], "<i8").tobytes(), digest_size=8)
    digest.update(np.ascontiguousarray(offsets, "<i8"))
    digest.update(np.ascontiguousarray(data))
    return int.from_bytes(digest.digest(), "little", signed=True)


def _packed(codes: np.ndarray) -> bytes:
    """Word numbers as compressed byte planes."""
    import zstandard
    planes = np.ascontiguousarray(codes.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _by_frequency(block: WordBlock) -> tuple[np.ndarray, pa.Array]:
    """Codes and words renumbered, frequent ones first: small numbers pack well."""
    often = np.bincount(block.code, minlength=len(block.words))
    order = np.argsort(-often, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return number[block.code], block.words.take(pa.array(order))


def _blocks(batches: Iterator[pa.RecordBatch], text: str, added: dict[str, int], block_bytes: int):
    from pyspark import TaskContext
    partition = TaskContext.get().partitionId()
    for number, part in enumerate(slices(batches, text, block_bytes)):
        yield _block_key(partition, number, *text_buffer(part.column(text))), part, WordBlock(part.column(text), added)


def word_rows(docs: DataFrame, path: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, number, word): the distinct words of each block of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = _vocabulary(path).added
        for key, _, block in _blocks(batches, text, added, block_bytes):
            _, words = _by_frequency(block)
            for a in range(0, len(words), 50_000):
                some = words.slice(a, 50_000).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), key)), pa.array(np.arange(a, a + len(some), dtype=np.int32)), some],
                    ["block", "number", "word"])

    return docs.select(text).mapInArrow(run, "block long, number int, word binary")


def document_rows(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, keys, sizes, codes): a row per block, with its documents as lists of word numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added = _vocabulary(path).added
        for block_key, part, block in _blocks(batches, text, added, block_bytes):
            codes, words = _by_frequency(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block_key], pa.int64()), pa.array([part.column(key).to_pylist()], pa.list_(pa.int64())),
                 pa.array([block.per_row.tolist()], pa.list_(pa.int64())), pa.array([_packed(codes)], pa.binary()),
                 pa.array([len(words)], pa.int32())], ["block", "keys", "sizes", "codes", "n_words"])

    # only the columns used: the scan reads nothing else
    return docs.select(key, text).mapInArrow(
        run, "block long, keys array<long>, sizes array<long>, codes binary, n_words int")


def _pack_ids(number: list[int], ids: list[list[int]]) -> bytes:
    import zstandard
    size = np.fromiter(map(len, ids), "<u4", len(ids))
    flat = np.fromiter((i for x in ids for i in x), "<u4", int(size.sum()))
    raw = np.concatenate([np.array([len(number)], "<u4"), np.array(number, "<u4"), size, flat])
    planes = np.ascontiguousarray(raw.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack_ids(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers, the number of ids of each, all ids."""
    flat = _unpacked(raw)
    n = int(flat[0])
    return flat[1:n + 1], flat[n + 1:2 * n + 1], flat[2 * n + 1:]


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """(block, packed): rows are dealt out by word and sorted, each distinct word is encoded once; its ids
    are packed with others of the same block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        last, ids, rows = None, [], 0
        held: dict[int, tuple[list, list]] = {}

        def packed() -> pa.RecordBatch:
            made = [_pack_ids(*x) for x in held.values()]
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(made, pa.binary())], ["block", "packed"])

        for batch in batches:
            for block, number, word in zip(batch.column("block").to_pylist(), batch.column("number").to_pylist(), batch.column("word").to_pylist()):
                if word != last:
                    text = word.decode("utf-8", "surrogateescape")
                    last, ids = word, [vocabulary.added[text]] if text in vocabulary.added else vocabulary.encode(word)
                to = held.get(block)
                if to is None:
                    to = held[block] = ([], [])
                to[0].append(number)
                to[1].append(ids)
            rows += batch.num_rows
            if rows >= PACKED_ROWS:
                yield packed()
                held, rows = {}, 0
        if held:
            yield packed()

    return words.repartition("word").sortWithinPartitions("word").mapInArrow(run, "block long, packed binary")


def with_ids(docs: DataFrame, path: str, emit: Callable, schema: str, key: str = "doc_id", text: str = "text",
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Bring the ids of all words back to their blocks; ``emit(keys, ids, bounds, pieces)`` makes the output batches.

    ``ids[bounds[i]:bounds[i + 1]]`` are the ids of the document ``keys[i]``.
    """
    words = encode_words(word_rows(docs, path, text, block_bytes), path)

    def assemble(block: pa.Table, found: pa.Table) -> pa.Table:
        made = []
        for row in block.to_pylist():
            parts = [_unpack_ids(x) for x in found.column("packed").to_pylist()]
            number = np.concatenate([x[0] for x in parts]) if parts else np.zeros(0, "<u4")
            if len(number) != row["n_words"]:
                raise ValueError("a block's words are not those of its documents: the source changed between reads")
            size = np.concatenate([x[1] for x in parts]).astype(np.int64) if parts else np.zeros(0, np.int64)
            flat = np.concatenate([x[2] for x in parts]) if parts else np.zeros(0, "<u4")
            lists = Ragged(flat, np.concatenate([[0], np.cumsum(size)]))
            place = np.empty(len(number), np.int64)
            place[number] = np.arange(len(number))
            codes = _unpacked(row["codes"])
            ends = np.cumsum(row["sizes"], dtype=np.int64) if row["sizes"] else np.zeros(0, np.int64)
            keys = np.array(row["keys"], dtype=object)
            begin = 0
            while begin < len(keys):                # documents in groups of a bounded number of words
                base = ends[begin - 1] if begin else 0
                to = max(begin + 1, int(np.searchsorted(ends, base + 500_000, side="right")))
                ids, bounds = lists.take(place[codes[base:ends[to - 1]]])
                cut = np.concatenate([[0], ends[begin:to] - base])
                made.append(emit(keys[begin:to], ids, bounds[cut], _vocabulary(path).pieces))
                begin = to
        return pa.concat_tables(made) if made else emit(np.zeros(0, object), np.zeros(0, "<u4"), np.zeros(1, np.int64),
                                                        _vocabulary(path).pieces)

    blocks = document_rows(docs, path, key, text, block_bytes)
    return blocks.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(assemble, schema)


def decode_ids(ids: np.ndarray, bounds: np.ndarray, pieces: pa.Array) -> tuple[bytes, np.ndarray]:
    """Join ids with the id-to-piece table and concatenate: bytes of all lists, and each list's bounds."""
    joined = pieces.take(pa.array(ids))
    data, offsets = text_buffer(joined)
    return data.tobytes(), offsets[bounds]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids of each whole text."""

    def emit(keys, ids, bounds, pieces):
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
        return pa.table({key: pa.array(keys.tolist(), pa.int64()), "ids": lists})

    return with_ids(docs, path, emit, f"{key} long, ids array<int>", key, text)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text): pieces joined by id and concatenated; invalid UTF-8 is replaced. Null ids: ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(_vocabulary(path).pieces, pa.binary())
        for batch in batches:
            texts = [b"".join(pieces.take(pa.array(x or [], pa.int64())).to_pylist()).decode("utf-8", "replace")
                     for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(texts, pa.string())], [key, "text"])

    return encoded.select(key, ids).mapInArrow(run, f"{key} long, text string")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encode, decode, and the digests of both."""
    import hashlib

    def emit(keys, ids, bounds, pieces):
        raw = ids.astype("<u4").tobytes()
        text_bytes, cut = decode_ids(ids, bounds, pa.array(pieces, pa.binary()))
        sha = [hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
        back = [text_bytes[a:b] for a, b in zip(cut[:-1], cut[1:])]
        back = [hashlib.sha256(x.decode("utf-8", "replace").encode()).hexdigest() for x in back]
        return pa.table({key: pa.array(keys.tolist(), pa.int64()), "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                         "ids_sha256": pa.array(sha, pa.string()), "decoded_sha256": pa.array(back, pa.string())})

    return with_ids(docs.withColumn(key, F.col(key).cast("long")), path, emit,
                    f"{key} long, n_tokens long, ids_sha256 string, decoded_sha256 string", key, text)
