"""MinHash, suffix dedup, vectors, components: against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from odd_rows import documents, none, odd, texts  # noqa: F401  (fixtures)
from rentyield.llm import components, itq, minhash, suffix_dedup


def _union(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    random.seed(1)
    links = [(i, i + 1) for i in range(1, 60)] + [(100, x) for x in range(101, 200)] + [(random.randint(300, 400), random.randint(300, 400)) for _ in range(60)]
    df = spark.createDataFrame([*links, (5, 5), (None, 3), (7, 8), (8, 7)], "a long, b long")
    got = {r["vertex"]: r["component"] for r in components.components(df).collect()}
    known = _union({x for e in links for x in e}, links)
    joined = {x for a, b in links if a != b for x in (a, b)}
    assert got == {v: c for v, c in known.items() if v in joined}
    assert components.components(df.filter("false")).count() == 0


def _shingles(text, width):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(low))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def _check_minhash(rows, texts, width):
    sets = {i: _shingles(t, width) for i, t in texts.items()}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[:n] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    known = _union(ids, links)
    for r in rows:
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), known[r["doc_id"]]), r
        assert r["kept"] == (r["doc_id"] == known[r["doc_id"]])
    return links


@pytest.mark.parametrize("width", [4, 5])
def test_minhash_against_brute_force(documents, texts, width):
    rows = minhash.near_duplicates(documents, width=width).collect()
    assert len(rows) == len(texts)
    _check_minhash(rows, texts, width)


def test_minhash_loses_no_link_in_a_large_group(spark):
    """Edited copies of one text: chains of links, and members that link with only some others."""
    random.seed(9)
    base = [f"t{i}" for i in range(120)]
    texts = {}
    for i in range(150):
        words = list(base)
        for _ in range(random.randint(0, 7)):
            words[random.randrange(len(words))] = f"e{random.randrange(10_000)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    old, minhash.BLOCK = minhash.BLOCK, 16          # several blocks
    try:
        links = _check_minhash(minhash.near_duplicates(df, width=4).collect(), texts, 4)
    finally:
        minhash.BLOCK = old
    assert len(links) > 500


def test_minhash_odd_rows(odd, none):
    rows = minhash.near_duplicates(odd, width=4).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_shingles"] == 0 and by[1]["kept"] and by[8]["component_id"] == 7 and not by[8]["kept"]
    assert by[5]["n_shingles"] == 1 and by[None]["component_id"] is None and by[None]["kept"]
    assert minhash.near_duplicates(none).count() == 0
    kept = minhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1


def test_pruning_bound_is_the_posterior():
    from math import comb
    for k, need in minhash.least_matches(160, 32, 80, 1e-6):
        # P(similarity >= 0.8 | m of k) by numeric integration of the posterior
        t = np.linspace(0, 1, 200_001)
        for m, below in ((need - 1, True), (need, False)):
            density = t**m * (1 - t) ** (k - m) * (k + 1) * comb(k, m)
            p = np.trapezoid(density[t >= 0.8], t[t >= 0.8])
            assert (p < 1e-6) == below


def _repeats(texts, length):
    raw = {i: (t or "").encode() for i, t in texts.items()}
    seen = {}
    for i, b in raw.items():
        for k in range(len(b) - length + 1):
            seen[b[k:k + length]] = seen.get(b[k:k + length], 0) + 1
    out = {}
    for i, b in raw.items():
        mark = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                mark[k:k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if mark[k] and (k == 0 or not mark[k - 1]))
        out[i] = (len(b), sum(mark), spans, hashlib.sha256(bytes(c for c, m in zip(b, mark) if not m)).hexdigest())
    return out


def _check_repeats(df, texts, length):
    rows = suffix_dedup.repeats(df, length=length).collect()
    known = _repeats(texts, length)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == known[r["doc_id"]], r["doc_id"]
    return sum(r["n_removed"] for r in rows)


@pytest.mark.parametrize("most", [2, 2000])
def test_suffix_dedup_against_brute_force(spark, most):
    random.seed(6)
    passage = "".join(random.choices("abcdé ", k=300))
    texts = {}
    for i in range(60):
        noise = "".join(random.choices("abcdefgh ", k=random.randint(0, 300)))
        cut = random.randint(0, 200)
        texts[i] = noise + passage[cut:cut + random.randint(20, 100)] + noise[::-1] + (noise if i % 7 == 0 else "")
    texts |= {100: "z" * 500, 101: "ab" * 200, 102: None, 103: "", 104: passage, 105: passage, 106: "short"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3).checkpoint()
    old = suffix_dedup.MOST, suffix_dedup.GATHERED
    suffix_dedup.MOST, suffix_dedup.GATHERED = most, 20
    try:
        assert _check_repeats(df, texts, 40) > 1000
    finally:
        suffix_dedup.MOST, suffix_dedup.GATHERED = old


def test_suffix_dedup_odd_rows(odd, none):
    odd = odd.checkpoint()
    rows = suffix_dedup.repeats(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_bytes"] == 0 and by[6]["n_removed"] == 50_000 and by[7]["n_removed"] == by[7]["n_bytes"] == by[8]["n_removed"]
    assert by[9]["n_removed"] == by[9]["n_bytes"]       # a repeated row is its own copy
    assert suffix_dedup.repeats(none).count() == 0
    left = suffix_dedup.without_repeats(odd)
    assert left.columns == odd.columns
    after = {r["doc_id"]: r for r in left.collect()}
    assert after[1]["text"] is None and after[7]["text"] == "" and after[7]["n_chars"] == 0 and after[4]["text"] == "one"


def _check_vectors(rows, vectors, labels):
    unit = {i: np.array(v, float) / np.linalg.norm(np.array(v, float)) for i, v in vectors.items()
            if v is not None and labels[i] is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    links = [(a, b) for a in unit for b in unit if a < b and labels[a] == labels[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93]
    known = _union(vectors, links)
    count = {i: sum(i in e for e in links) for i in vectors}
    right = sum((r["n_links"], r["component_id"]) == (count[r["vec_id"]], known[r["vec_id"]]) for r in rows)
    return right / len(rows), links


def test_itq_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 64))
    vectors, labels = {}, {}
    for i in range(600):
        v = centres[i % 40] + rng.standard_normal(64) * rng.choice([0.0, 0.1, 0.25, 0.3, 1.0])
        vectors[i], labels[i] = [float(np.float32(x)) for x in v], int(i % 3) if i % 50 else None
    vectors |= {1000: None, 1001: [0.0] * 64, 1002: [None] + [1.0] * 63, 1003: [float("nan")] + [1.0] * 63, 1004: [float("inf")] * 64, 1005: [1.0, 2.0], 1006: [2.0, 4.0], 1007: []}
    labels |= {i: 1 for i in range(1000, 1008)}
    df = spark.createDataFrame([(i, v, labels[i], "x", i) for i, v in vectors.items()], "vec_id long, embedding array<float>, label int, same string, id long")
    rows = itq.near_duplicates(df.repartition(4)).collect()
    assert len(rows) == len(vectors)
    right, links = _check_vectors(rows, vectors, labels)
    assert right >= 0.99 and len(links) > 500
    assert itq.near_duplicates(df.filter("false")).count() == 0


def test_itq_common_vector_counts_its_copies(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else [float(i % 7), 1.0, -2.0, float(i % 5)], 1) for i in range(300)],
                               "vec_id long, embedding array<float>, label int")
    rows = {r["vec_id"]: r for r in itq.near_duplicates(df).collect()}
    vectors = {r["vec_id"]: r["embedding"] for r in df.collect()}
    right, _ = _check_vectors(rows.values(), vectors, {i: 1 for i in vectors})
    assert right == 1.0 and rows[0]["n_links"] >= 99


def _dense(n, noise, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((3, 64))
    vectors = {i: (centres[0 if i % 5 else i % 3] + noise * rng.standard_normal(64)).astype(np.float32).astype(float).tolist() for i in range(n)}
    return vectors | {n + i: vectors[i] for i in range(0, n, 50)}         # copies too


def test_itq_crowded_buckets_as_pairs(spark):
    """Compared in blocks or as rows of pairs: the same links and components, those of brute force."""
    vectors = _dense(600, 0.27)
    labels = {i: 1 for i in vectors}
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors.items()], "vec_id long, embedding array<double>, label int").repartition(4)
    rows = [sorted(map(tuple, itq.near_duplicates(df, most_pairs=m).collect())) for m in (0, 20_000, 1 << 60)]
    assert rows[0] == rows[1] == rows[2]
    right, links = _check_vectors(itq.near_duplicates(df, most_pairs=0).collect(), vectors, labels)
    assert right >= 0.99 and 10_000 < len(links) < 600 * 599 // 2


def test_itq_dense_group_has_no_row_per_pair(spark, monkeypatch):
    vectors = _dense(3_000, 0.05)
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors.items()], "vec_id long, embedding array<double>, label int").repartition(4)
    seen, rerank = [], itq.rerank
    monkeypatch.setattr(itq, "rerank", lambda pairs, *rest: seen.append(pairs.count()) or rerank(pairs, *rest))
    rows = itq.near_duplicates(df).collect()
    assert seen[0] < 100 * len(vectors)
    unit = np.array([vectors[i] for i in sorted(vectors)])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    assert [r["n_links"] for r in sorted(rows, key=lambda r: r["vec_id"])] == links.tolist()
    assert sum(r["kept"] for r in rows) == 3


def test_itq_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r["vec_id"]: r["embedding"] for r in df.collect()}
    labels = {r["vec_id"]: r["label"] for r in df.collect()}
    right, _ = _check_vectors(itq.near_duplicates(df).collect(), vectors, labels)
    assert right >= 0.99


def test_rotation_is_orthogonal_and_balanced():
    x = np.random.default_rng(0).standard_normal((2000, 16)) @ np.random.default_rng(1).standard_normal((16, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    r = itq.learn_rotation(x)
    assert np.allclose(r.T @ r, np.eye(16), atol=1e-8)
    assert np.abs(((x @ r) >= 0).mean(axis=0) - 0.5).max() < 0.1


def test_multi_index_finds_every_code_in_the_radius(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 30, dtype=np.int64)
    code = {i: int(base[i % 30]) for i in range(300)}
    for i in code:
        for bit in rng.choice(63, rng.integers(0, 12), replace=False):
            code[i] ^= 1 << int(bit)
    df = spark.createDataFrame([(i, i % 2, 64, c) for i, c in code.items()], "id long, label long, dim int, code long")
    expected = {(a, b) for a in code for b in code if a < b and a % 2 == b % 2 and bin(code[a] ^ code[b]).count("1") <= 9}
    for per_label in (10, 100_000):
        tables = itq.tables_for(64, 9, per_label)
        index = itq.index_rows(df, tables)
        got = [tuple(r) for r in itq.candidates(index, itq.probe_rows(index, tables), tables).collect()]
        assert len(got) == len(set(got)) and set(got) == expected


def _prose(seed, words, choices="abcdefghij", size=5):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(choices, k=size)) for _ in range(words))


def test_suffix_dedup_whatever_the_splits(spark, tmp_path):
    """The scan is split otherwise after the first step, as when an executor is lost or joins."""
    shared = _prose(1, 40)
    texts = {i: f"{_prose(100 + i, 30)} {shared if i % 3 == 0 else _prose(200 + i, 40)} {_prose(300 + i, 20 + i)}" for i in range(24)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8, "doc_id")
    df.write.parquet(str(tmp_path / "docs"))
    durable, files = suffix_dedup.durable, "spark.sql.files.minPartitionNum"

    def after(frame):
        out = durable(frame)
        spark.conf.set(files, "100")
        return out

    spark.conf.set(files, "1")
    suffix_dedup.durable = after
    try:
        docs = spark.read.parquet(str(tmp_path / "docs"))
        before = docs.rdd.getNumPartitions()
        assert _check_repeats(docs, texts, 100) > 1000
        assert spark.read.parquet(str(tmp_path / "docs")).rdd.getNumPartitions() > before
    finally:
        suffix_dedup.durable = durable
        spark.conf.unset(files)


def test_one_row_of_repeated_rows_stays_and_keeps_its_text(spark):
    one, other, clean, last = (_prose(i, 120) for i in range(4))
    rows = [(1, one), (1, one), (2, other), (3, other + " more"), (3, clean), (None, last), (None, last), (4, None), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).checkpoint()
    kept = minhash.keep_one_row(df).checkpoint()
    assert kept.columns == df.columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert found == sorted([(1, one), (2, other), (3, clean), (None, last), (4, None), (4, None)], key=str)
    left = sorted(((r["doc_id"], r["text"]) for r in suffix_dedup.without_repeats(kept).collect()), key=str)
    assert left == found


def test_windows_of_a_group_are_compared_in_shares(monkeypatch):
    """The same spans as when all identifiers are sorted at once, in a part of the memory."""
    import tracemalloc

    import pyarrow as pa

    class Grouped:
        def groupBy(self, *_):
            return self

        def applyInArrow(self, run, _):
            return run

    run, rng, n = suffix_dedup.refine(Grouped(), 250), np.random.default_rng(3), 4000
    middle = b"a passage in all of them " * 8
    around = [bytes(rng.integers(97, 99 if i % 3 else 98, 86, np.uint8)) + middle + bytes(rng.integers(97, 99 if i % 5 else 98, 86, np.uint8)) for i in range(n)]
    group = pa.table({"bucket": pa.array(np.arange(n) % 3), "n": pa.array(1 + (np.arange(n) % 11 == 0)), "members": pa.array(np.where(np.arange(n) % 3, 50, 20)),
                      "row": pa.array(np.arange(n)), "place": pa.array(np.full(n, 500, np.int32)), "left": pa.array(np.full(n, 122, np.int32)), "around": pa.array(around, pa.binary())})
    windows = n * (len(around[0]) - 250 + 1)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 100)
    run(group.slice(0, 10))
    tracemalloc.start()
    try:
        found = run(group)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    print("bytes per window", peak / windows)
    assert peak < 30 * windows                  # before: 83
    monkeypatch.setattr(suffix_dedup, "MOST", 30)
    shared = run(group)
    monkeypatch.setattr(suffix_dedup, "SHARES", 1)
    assert sorted(map(str, run(group).to_pylist())) == sorted(map(str, shared.to_pylist()))
    assert shared.column("key").null_count < shared.num_rows and 0 < found.num_rows == found.column("key").null_count
