"""Language identification by cross-parsing entropy (Ziv-Merhav) with suffix automata.

For each language a bounded sample of labelled texts becomes a suffix automaton. A text is parsed
greedily with it: each phrase is the longest match, from where the last one ended, with any part of
the sample. Phrases needed, times log2 of the sample's length, per character estimate the
cross-entropy; the language that needs fewest wins. Texts are parsed whole, in segments of
``SEGMENT`` characters side by side: a segment's end ends a phrase, alike for all languages.

The fit is bounded: ``SAMPLE_TEXTS`` texts a language, those with the smallest hash of their key,
``SAMPLE_CHARS`` characters in all. Characters are lower-cased letters, a space for each run of white
space, and one symbol for all else; letters beyond the ``SYMBOLS`` most frequent share symbols.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without labelled
texts all are ``und``; ties go to the first language by name; repeated rows are predicted alike; a
row without key is never in the sample; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentyield.llm.text_arrays import LETTER, SPACE, character_classes, code_points, kept_in_worker, slices, text_buffer

SAMPLE_TEXTS = 200
SAMPLE_CHARS = 30_000
SEGMENT = 256
SYMBOLS = 250
_PAD, _SPACE, _ELSE, _FIRST = 0, 1, 2, 3


def held_out(key: str = "doc_id") -> Column:
    """Rows kept out of the fit: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _lower() -> np.ndarray:
    def make() -> np.ndarray:
        points = np.arange(0x110000, dtype=np.uint32)
        for c in np.flatnonzero(character_classes() == LETTER).tolist():
            low = chr(c).lower()
            if len(low) == 1:
                points[c] = ord(low)
        return points

    return kept_in_worker("lower case", make)


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters (code point of a letter, or 0 for a space, 1 for all else), row of each, rows with a letter."""
    point, lead = code_points(data)
    kind = character_classes()[point]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(lead, offsets)))
    out = np.where(kind == LETTER, _lower()[point], np.where(kind == SPACE, 0, 1)).astype(np.int64)
    again = np.zeros(len(out), bool)
    again[1:] = (out[1:] == 0) & (out[:-1] == 0) & (row[1:] == row[:-1])
    letters = np.zeros(len(offsets) - 1, bool)
    letters[row[kind == LETTER]] = True
    return out[~again], row[~again], letters


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(following)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = new
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(following)
                following.append(dict(following[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = copy
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = copy
                    p = link[p]
        last = new
    return following


def parse_table(following: list[dict[int, int]], width: int) -> np.ndarray:
    """Dense steps: entry [state * width + symbol] is 2 * (next state * width) + (1 if a phrase begins)."""
    table = np.full((len(following), width), -1, np.int64)
    for state, to in enumerate(following):
        for c, q in to.items():
            table[state, c] = 2 * q * width
    root = table[0].copy()
    fresh = np.where(root >= 0, root + 1, 1)        # a phrase begins with this symbol, or is this unknown symbol
    table = np.where(table >= 0, table, fresh[None, :])
    table[0] = fresh
    table[:, _PAD] = 0                              # after the text: nothing begins
    return table.ravel().astype(np.int32)


class Model:
    """Languages, the character-to-symbol table, and a step table with the sample's length for each."""

    def __init__(self, samples: dict[str, list[str]], max_chars: int):
        texts = {}
        for lang in sorted(samples):
            held, left = [], max_chars
            for text in samples[lang]:
                column = pa.array([text[:left]])
                char, _, _ = normalised(*text_buffer(column))
                held.append(char)
                left -= len(text)
                if left <= 0:
                    break
            texts[lang] = held
        letters, count = np.unique(np.concatenate([c for held in texts.values() for c in held] or [np.zeros(0, np.int64)]), return_counts=True)
        letters = letters[np.argsort(-count, kind="stable")]
        letters = letters[letters > 1]
        self.symbol_of = np.full(0x110000, 0, np.uint8)
        self.symbol_of[:] = _FIRST + SYMBOLS        # letters that no sample has
        self.symbol_of[letters] = _FIRST + np.arange(len(letters)) % SYMBOLS
        self.symbol_of[0], self.symbol_of[1] = _SPACE, _ELSE
        self.width = _FIRST + min(SYMBOLS, len(letters)) + 1
        self.symbol_of[self.symbol_of == _FIRST + SYMBOLS] = self.width - 1
        self.languages = list(texts)
        self.tables, self.bits = [], []
        for held in texts.values():
            symbols: list[int] = []
            for char in held:                       # a pad between texts: no phrase runs over it
                symbols += self.symbol_of[char].tolist() + [_PAD]
            self.tables.append(parse_table(suffix_automaton(symbols), self.width))
            self.bits.append(float(np.log2(max(2, len(symbols)))))


def phrases(symbols: np.ndarray, row: np.ndarray, rows: int, table: np.ndarray, width: int) -> np.ndarray:
    """Number of phrases of each row's symbols, with all segments parsed side by side."""
    count = np.bincount(row, minlength=rows)
    parts = -(-count // SEGMENT)
    first = np.concatenate([[0], np.cumsum(parts)])
    inside = np.arange(len(symbols)) - np.repeat(np.cumsum(count) - count, count)
    grid = np.zeros((SEGMENT, first[-1]), np.uint8)
    grid[inside % SEGMENT, first[row] + inside // SEGMENT] = symbols
    state = np.zeros(first[-1], np.int32)
    begun = np.zeros(first[-1], np.int32)
    for step in grid:
        to = table.take(state + step)
        begun += to & 1
        state = to >> 1
    return np.bincount(np.repeat(np.arange(rows), parts), weights=begun, minlength=rows)


def fit(labelled: DataFrame, key: str, text: str, lang: str, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> Model:
    """Model from a bounded sample: per language the texts with the smallest hash of their key."""
    names = sorted(r[0] for r in labelled.filter(F.col(lang).isNotNull()).groupBy(lang).agg(F.count("*")).select(lang).collect())
    chosen = []
    for name in names:      # two columns are read; the order is cut to the sample in each task
        ranked = labelled.filter((F.col(lang) == name) & F.col(key).isNotNull()).select(key, F.xxhash64(key).alias("_h"))
        chosen += [r[0] for r in ranked.orderBy("_h", key).limit(texts).collect()]
    found = labelled.filter(F.col(key).isin(chosen) & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    # whole texts are cut to the sample's size in the tasks: no more is taken of one anyway
    rows = found.select(key, lang, F.substring(text, 1, chars).alias("text")).orderBy(F.xxhash64(key), key, "text").limit(texts * max(1, len(names))).collect()
    samples: dict[str, list[str]] = {}
    for r in rows:
        samples.setdefault(r[1], []).append(r[2])
    return Model(samples, chars)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score, bits): score is 1 - best / second best cross-entropy; bits the best one."""
    docs = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text), F.col(lang).cast("string").alias(lang))
    model = fit(docs.filter(~held_out(key)), key, text, lang)
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.symbol_of, model.width, model.tables, model.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, symbol_of, width, tables, bits = shared.value
        for part in slices(batches, text, 4 << 20):
            data, offsets = text_buffer(part.column(text))
            char, row, letters = normalised(data, offsets)
            symbols = symbol_of[char]
            rows = part.num_rows
            chars = np.maximum(np.bincount(row, minlength=rows), 1)
            each = np.array([phrases(symbols, row, rows, t, width) * b for t, b in zip(tables, bits)]).reshape(len(languages), rows)
            if languages:
                best = each.argmin(axis=0)
                least = each[best, np.arange(rows)]
                each[best, np.arange(rows)] = np.inf
                second = each.min(axis=0)
                score = np.where(np.isinf(second), 1.0, 1.0 - least / np.maximum(second, 1e-9))
                names = [languages[i] if ok else "und" for i, ok in zip(best.tolist(), letters.tolist())]
                score, entropy = np.where(letters, score, 0.0), np.where(letters, least / chars, 0.0)
            else:
                names, score, entropy = ["und"] * rows, np.zeros(rows), np.zeros(rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(key), part.column("held_out"), pa.array(names, pa.string()), pa.array(score), pa.array(entropy)],
                [key, "held_out", "lang_pred", "score", "bits"])

    return docs.select(key, held_out(key).alias("held_out"), text).mapInArrow(
        run, f"{key} long, held_out boolean, lang_pred string, score double, bits double")
