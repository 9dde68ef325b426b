"""Operators 11 to 13 against plain passes: importance resampling, periodic runs, entropy balancing."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentyield.llm import balancing, periodic_runs, resampling
from rentyield.llm.tables import table
from rentyield.llm.text_arrays import Words, text_buffer

from odd_rows import SF, documents, none, odd  # noqa: F401

GAPS = r"[^\x20\x09-\x0D]+"


# ---- 11: importance resampling -------------------------------------------------------

def _words11(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _buckets(text):
    w = _words11(text)
    return [zlib.crc32(f.encode()) % 10_000 for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]


def _plain_resample(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(_buckets(text))
    for text in target:
        t.update(_buckets(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (big_s + 10_000)) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, text in docs:
        f = _buckets(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(_words11(text))])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, r in enumerate(able[:25 * len(able) // 100]):
        r[4] = n + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def _got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.mark.parametrize("most, accuracy", [(100_000, 10_000), (5, 20)])
def test_resampling_equals_a_plain_pass(spark, documents, most, accuracy):
    target = table(spark, SF, "benchmark")
    got = resampling.resample(documents, target, most=most, accuracy=accuracy)
    want = _plain_resample([(r["doc_id"], r["text"]) for r in documents.collect()], [r["text"] for r in target.collect()])
    assert _got(got) == want


def test_resampling_odd_rows(spark, odd, none):
    target = table(spark, SF, "benchmark")
    assert _got(resampling.resample(odd, target)) == _plain_resample(
        [(r["doc_id"], r["text"]) for r in odd.collect()], [r["text"] for r in target.collect()])
    assert resampling.resample(none, target).collect() == []
    assert resampling.resample(odd, none).count() == odd.count()


def test_pair_sums_are_those_of_the_joined_words():
    import pyarrow as pa
    texts = ["aé b", "x" * 70 + " " + "y" * 200 + " z", "one", None, "日本 語 " + "w" * 64]
    words = Words(*text_buffer(pa.array(texts)), resampling._GAP)
    sums, row = resampling.feature_sums(words)
    got = defaultdict(Counter)
    for s, r in zip(sums.tolist(), row.tolist()):
        got[r][s] += 1
    for r, t in enumerate(texts):
        w = (t or "").split()
        assert got[r] == Counter(zlib.crc32(f.encode()) for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))])


def test_cutoff_widens_a_bracket_that_misses_and_meets_ties(spark):
    values = [(v % 7, i) for i, v in enumerate(range(3000))]
    rows = spark.createDataFrame(values, "_v long, _id long")
    for k in (1, 429, 3000):
        cut = resampling.locate(rows, k, ("_v", "_id"), most=10, accuracy=50)
        assert cut.values == sorted(values)[k - 1]
        assert cut.sorted_rows <= 10
    # no margin at all around a coarse sketch: brackets have to be widened
    spread = [(i * i % 10_007, i) for i in range(5000)]
    rows = spark.createDataFrame(spread, "_v long, _id long")
    cuts = [resampling.locate(rows, k, ("_v", "_id"), most=50, accuracy=10, margin=0.0) for k in (17, 4321)]
    assert [c.values for c in cuts] == [sorted(spread)[k - 1] for k in (17, 4321)]
    assert sum(c.widened for c in cuts) > 0
    # all rows equal
    same = spark.createDataFrame([(3, 4)] * 100, "_v long, _id long")
    assert resampling.locate(same, 60, ("_v", "_id"), most=10).values == (3, 4)


def test_rows_equal_at_the_cutoff_are_drawn_only_as_far_as_there_is_room(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(5, text)] * 40 + [(None, text)] * 40, "doc_id long, text string")
    got = resampling.resample(docs, docs, most=3).collect()
    assert len(got) == 80
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, 21))


# ---- 12: periodic runs ---------------------------------------------------------------

def _plain_runs(words, least=6, times=4):
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            begin = i - q
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - begin >= max(least, times * q):
                out.setdefault((begin, i - begin), q)       # smaller periods come first
    return sorted((s, length, q) for (s, length), q in out.items())


def _nested_texts(seed, texts):
    rng = random.Random(seed)
    for _ in range(texts):
        w, size = [], rng.choice([4, 20, 60, 200])
        while len(w) < size:
            c = rng.random()
            if c < 0.4:
                w += [rng.choice("ab") for _ in range(rng.randint(1, 6))]
            elif c < 0.8:
                p = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
                if rng.random() < 0.3:
                    p = [rng.choice("ab") for _ in range(rng.randint(1, 3))] * rng.randint(1, 7) + p
                w += (p * 7)[:rng.randint(1, 7 * len(p))]
            else:
                w += w[-rng.randint(1, 30):]
        yield w


@pytest.mark.parametrize("least, times", [(6, 4), (4, 3), (8, 5)])
def test_runs_equal_a_plain_pass_over_all_periods(spark, least, times):
    texts = list(_nested_texts(least, 800))
    docs = spark.createDataFrame([(i, "  \t".join(w) + "\n") for i, w in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in periodic_runs.periodic_runs(docs, least, times).collect()}
    assert len(got) == len(texts)
    some = 0
    for i, w in enumerate(texts):
        want = _plain_runs(w, least, times)
        some += len(want)
        assert [tuple(r) for r in got[i]["runs"]] == want
        gone = {j for s, n, q in want for j in range(s + q, s + n)}
        assert got[i]["collapsed"] == " ".join(x for j, x in enumerate(w) if j not in gone)
    assert some > 300


def test_long_hot_texts_end_soon_and_right(spark):
    rng = random.Random(3)
    texts = [["a"] * 100_000, (["a"] * 50 + ["b"]) * 1000, [rng.choice("ab") for _ in range(5000)], ["x", "y"] * 20_000 + ["z"] + ["x", "y"] * 20_000]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic_runs.periodic_runs(docs).collect()}
    assert got[0] == [(0, 100_000, 1)]
    assert got[1][0] == (0, 50, 1) and (0, 51_000, 51) in got[1] and len(got[1]) == 1001
    assert got[2] == _plain_runs(texts[2])
    assert got[3] == [(0, 40_000, 2), (40_001, 40_000, 2)]


def test_periodic_query_equals_a_plain_pass(spark, documents):
    got = {r["doc_id"]: r for r in periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(documents))).collect()}
    with_runs = 0
    for r in documents.collect():
        w = re.findall(GAPS, r["text"] or "")
        n, h = len(w), zlib.crc32(str(r["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
        runs = _plain_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        gone = {j for s, m, q in runs for j in range(s + q, s + m)}
        d = got[r["doc_id"]]
        assert (d["n_runs"], d["start"], d["length"], d["period"]) == (len(runs), *best)
        assert d["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert d["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert d["collapsed_sha256"] == hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()
        with_runs += bool(runs)
    assert with_runs > 10


def test_periodic_odd_rows(spark, odd, none):
    got = periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.planted(odd)))
    assert got.count() == odd.count()
    empty = hashlib.sha256(b"").hexdigest()
    first = got.filter("doc_id = 1").first()
    assert (first["n_runs"], first["start"], first["runs_sha256"], first["collapsed_sha256"]) == (0, None, empty, empty)
    no_id = got.filter("doc_id IS NULL").first()        # five words, twenty times
    assert (no_id["n_runs"], no_id["start"], no_id["length"], no_id["period"], no_id["exponent_milli"]) == (1, 0, 100, 5, 20_000)
    assert periodic_runs.periodic_runs(none).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(odd, times=2)


# ---- 13: entropy balancing -------------------------------------------------------------

def _plain_targets(totals, weights=(1, 2, 3), cap=3):
    """Share by weight, stop sources at their cap, share the excess again, until none is above."""
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, free, left = {}, set(names), sum(totals.values())
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > cap * totals[s]}
        if not above:
            return fixed | {s: level * weight[s] for s in free}
        for s in above:
            fixed[s] = cap * totals[s]
            left -= fixed[s]
        free -= above
    return fixed


def _sources(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def _mix(df, **options):
    return balancing.mixed(df, **options).collect()


def test_targets_equal_repeated_sharing(spark):
    rng = random.Random(5)
    for trial in range(6):
        totals = {s: rng.choice([0, 1, 7, 100, 5000, 10 ** 6]) * rng.randint(1, 3) for s in ["é", "a", "B", "z", "10", "", "aa"][:2 + trial]}
        rows = spark.createDataFrame([("v" + s, t) for s, t in totals.items()], "src string, total long")
        got = {r["src"][1:]: r["target"] for r in balancing.targets(rows).collect()}
        want = _plain_targets(totals)
        assert sum(got.values()) == pytest.approx(sum(totals.values()))
        assert got == pytest.approx(want)


def test_multipliers_solve_the_dual(spark):
    rng = random.Random(9)
    counts, goals = [], []
    for s, share in (("a", 0.05), ("b", 0.5), ("c", 1.0), ("d", 1.7), ("e", 2.9), ("f", 2.9999), ("g", 3.0), ("h", 1e-4)):
        sizes = {rng.choice([1, 2, 30, 400, 5000, 20_000]) + rng.randint(0, 9): rng.randint(1, 50) for _ in range(12)}
        counts += [(s, z, n) for z, n in sizes.items()]
        total = sum(z * n for z, n in sizes.items())
        goals.append((s, total, share * total))
    c = spark.createDataFrame(counts, "src string, size long, n long")
    g = spark.createDataFrame(goals, "src string, total long, target double")
    a = {r["src"]: r["a"] for r in balancing.multipliers(c, g).collect()}
    assert set(a) == set("abcdefh")                         # g is at the cap
    for s, total, target in goals:
        if s in a:
            words = sum(n * z * min(3.0, math.exp(min(a[s] * z, 50))) for x, z, n in counts if x == s)
            assert words == pytest.approx(target, rel=1e-8)
    assert a["c"] == pytest.approx(0, abs=1e-9)


def test_tilted_rates_diverge_least_from_one(spark):
    """No other rates with the same words are nearer to 1 in Kullback-Leibler divergence."""
    sizes = np.array([3.0, 10, 40, 200, 1000])
    target = float(0.6 * sizes.sum())
    c = spark.createDataFrame([("s", int(z), 1) for z in sizes], "src string, size long, n long")
    g = spark.createDataFrame([("s", int(sizes.sum()), target)], "src string, total long, target double")
    rate = np.minimum(3, np.exp(balancing.multipliers(c, g).first()["a"] * sizes))
    kl = lambda r: (r * np.log(r) - r + 1).sum()                                    # noqa: E731
    rng = np.random.default_rng(1)
    for _ in range(200):
        move = rng.normal(size=5)
        move -= sizes * (move @ sizes) / (sizes @ sizes)    # keeps the words
        other = rate + 1e-3 * move
        assert kl(other) >= kl(rate)


@pytest.mark.parametrize("rows_per_task", [1_000_000, 3])
def test_mix_meets_its_targets(spark, documents, rows_per_task):
    rows = _mix(documents, rows_per_task=rows_per_task)
    texts = documents.collect()
    assert len(rows) == len(texts)
    size = {r["doc_id"]: len(re.findall(GAPS, r["text"] or "")) for r in texts}
    total = Counter()
    for r in texts:
        total[r["source"]] += size[r["doc_id"]]
    want, source = _plain_targets(total), {r["doc_id"]: r["source"] for r in texts}
    taken, shortest = Counter(), {}
    for r in rows:
        s = source[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[s] and r["target"] == pytest.approx(want[s])
        assert r["taken"] in [k * r["size"] for k in range(4)]
        taken[s] += r["taken"]
    for s in total:     # ten short texts a source here
        assert abs(taken[s] - want[s]) <= max(0.03 * want[s], 25)


def test_mix_of_a_hot_source_repeats_and_does_not_depend_on_the_order(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * 20), "hot") for i in range(600)]
    rows += [(600 + i, " ".join(["w"] * rng.randint(1, 90)), rng.choice(["a", "b", None])) for i in range(300)]
    first = sorted(map(tuple, _mix(_sources(spark, rows).repartition(2), rows_per_task=50)))
    rng.shuffle(rows)
    again = sorted(map(tuple, _mix(_sources(spark, rows).repartition(7), rows_per_task=50)))
    assert first == again
    hot = [r for r in first if r[0] < 600]
    assert len({r[4] for r in hot}) == 2                    # equal texts differ by one copy at most
    assert abs(sum(r[4] for r in hot) - hot[0][3]) <= 20


def test_mix_odd_rows(spark, odd, none):
    rows = _mix(odd.withColumn("source", F.when(F.col("doc_id") > 6, "s")))
    assert len(rows) == odd.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert _mix(none) == []
    blank = _mix(_sources(spark, [(1, None, "a"), (2, "", "b"), (3, " ", None)]))
    assert {(r["size"], r["source_size"], r["target"], r["taken"]) for r in blank} == {(0, 0, 0.0, 0)}
    # the source at its cap gets three copies of everything; the other what is left
    capped = _mix(_sources(spark, [(1, "a b", "x"), (2, "c", "x"), *[(i, "d e f g", "y") for i in range(3, 33)]]), weights=(5, 1))
    assert {r["doc_id"]: r["taken"] for r in capped if r["doc_id"] < 3} == {1: 6, 2: 3}
