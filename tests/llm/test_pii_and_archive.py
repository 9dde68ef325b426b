"""PII spans against Python's re, co-occurring terms, archive revisits against DuckDB, the pipeline."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oracle_compare import compare
from odd_rows import documents, none, odd, texts  # noqa: F401  (fixtures)
from rentyield.llm import minhash, packing, pii, quality_rules, revisits, suffix_dedup
from rentyield.llm.queries import QUERIES, tokenizer_path

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def _spans(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if _passes(k, m[0])]


ODD = ["a@b.cd%x@e.f 1.2.3.4.5.6.7.8 é 999.1.1.1 4111 1111 1111 1111 4111-1111-1111-1111 +1 (2) 345-678-90 +12 34\n😀 x@y.z. 0001.2.3.255",
       "1.1.1.1" * 3 + "+1234567890123456 +123456789)", "a@b", "@@a@b.c@d.e", "1-1-1 1  1", "+49 30 1234567 und +49", "4111111111111111" * 2, "5500 0000 0000 0004"]


def _check_spans(rows, texts):
    for r in rows:
        found = _spans(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in found) for k in pii.KINDS], r["doc_id"]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest() and r["spans"].startswith(listed)


def test_base_spans(spark, documents, texts, odd, none):
    extra = {10_000 + i: t for i, t in enumerate(ODD)}
    df = documents.select("doc_id", "text").unionByName(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))
    rows = pii.find(df).collect()
    assert len(rows) == len(texts) + len(ODD)
    _check_spans(rows, texts | extra)
    rows = pii.find(odd).collect()
    assert len(rows) == odd.count()
    _check_spans(rows, {r["doc_id"]: r["text"] for r in odd.collect()})
    assert pii.find(none).count() == 0
    clean = pii.sanitise(odd)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    assert {r["doc_id"]: r["text"] for r in clean.collect()}[1] is None


def test_patterns_do_not_backtrack(spark):
    texts = ["a" * 60_000, "1" * 60_000, "1-" * 60_000, "a." * 60_000 + "@b" + ".c" * 60_000, "+1" + "(" * 60_000, "1." * 60_000, "@" * 60_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert pii.find(df).count() == len(texts)


def _disclosing_rows():
    """'Zubrowka' stands only in lines with one address; 'meeting' is common; 'Obscure' is in one copied line."""
    lines = [(i, f"note {i} about Zubrowka and the meeting, write to jan.k@example.org today") for i in range(6)]
    lines += [(100 + i, f"the meeting number {i} is today and we write a note about it to all") for i in range(200)]
    lines += [(400 + i, "Obscure words beside eva@example.org") for i in range(5)]
    lines += [(500, "Zubrowka is not beside an address here"), (501, "two lines\nwrite to jan.k@example.org, Zubrowka!")]
    return lines


def test_terms_that_disclose(spark):
    rows = _disclosing_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {(r["entity"], r["term"]): r["action"] for r in pii.disclosing(df).collect()}
    assert terms[("email:jan.k@example.org", "zubrowka")] in ("remove", "general")
    assert not any(t in ("meeting", "write", "obscure", "today") for _, t in terms)
    # the measure, by hand
    from math import log
    contexts = [x for _, t in rows for x in t.split("\n")]
    holds = lambda w: [x for x in contexts if w in re.split(r"[^a-z]+", x.lower())]
    n, n_t, n_e = len(contexts), len(holds("zubrowka")), sum("jan.k@" in x for x in contexts)
    both = sum("jan.k@" in x for x in holds("zubrowka"))
    share = log(n * both / (n_t * n_e)) / log(n / n_e)
    assert terms[("email:jan.k@example.org", "zubrowka")] == ("remove" if share >= pii.REMOVE else "general")
    found = {r["doc_id"]: r for r in pii.find(df).collect()}
    texts = dict(rows)
    assert found[500]["n_terms"] == 0 and found[100]["spans"] == "" and found[501]["n_terms"] == 1
    spans = [s.split(":") for s in found[0]["spans"].split(",")]
    assert [texts[0][int(a):int(b)] for k, a, b in spans if k in ("remove", "general")] == ["Zubrowka"]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert "Zubrowka" not in clean[501] and "[EMAIL]" in clean[501] and clean[500] == texts[500] and clean[100] == texts[100]


def test_masking_plan_holds_no_counting(documents):
    """The terms that disclose are a table of their own: the plan over the texts is small for the driver."""
    plan = pii.sanitise(documents)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Generate" not in plan


def test_pii_runs_no_python(spark, documents):
    plan = pii.find(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_revisits_match_sql(spark, sf):
    assert compare(spark, "op4_revisits", sf)["status"] == "match"


def _records(spark, rows):
    return spark.createDataFrame(rows, "record_id long, url string, ts double, revisit boolean, headers map<string,string>, _id string, stored string")


def test_revisit_cases(spark):
    e = lambda tag, **more: {"ETag": tag} | more
    rows = [
        (1, "http://WWW.a.org:80/x/?b=2&a=1&utm_source=z#f", 1.0, False, e('"1"', Server="s", Expires="old"), "", ""),
        (2, "https://a.org/x?a=1&b=2", 2.0, True, e('W/"1"', Expires="new", **{"Content-Length": "0"}), "", ""),
        (3, "http://a.org/x?a=1&b=2", 3.0, False, e('"2"'), "", ""),
        (4, "http://a.org/x?a=1&b=2", 3.0, True, e('"1"'), "", ""),            # tie of time: the response has the lower id
        (5, "http://a.org/x?a=1&b=2", 0.5, True, e('"1"'), "", ""),            # nothing earlier
        (6, None, 4.0, True, None, "", ""), (7, "", 4.0, True, None, "", ""), (8, "http://a.org/x?a=1&b=2", None, True, e('"2"'), "", ""),
        (9, "http://b.org/", 1.0, False, {"Last-Modified": "m"}, "", ""), (10, "http://b.org", 2.0, True, {"last-modified": "m"}, "", ""),
        (11, "http://b.org", 3.0, True, {"last-modified": "n"}, "", ""), (12, "http://b.org", 3.0, True, None, "", ""),
    ]
    got = {r["record_id"]: r for r in revisits.resolve(_records(spark, rows)).collect()}
    assert got[2]["outcome"] == "resolved" and got[2]["refers_to"] == 1
    assert got[2]["headers"] == {"etag": 'W/"1"', "server": "s", "expires": "new"}
    assert (got[4]["outcome"], got[4]["refers_to"]) == ("etag-mismatch", 3)
    assert [got[i]["outcome"] for i in (5, 6, 7, 8, 10, 11, 12)] == ["no-response"] * 4 + ["resolved", "date-mismatch", "no-validator"]
    assert len(got) == len(rows)
    assert revisits.resolve(_records(spark, rows).filter("false")).count() == 0


def test_as_of_over_time_slices(spark):
    """One URL with most records, cut into many slices: the same as one pass in order of time."""
    import random
    random.seed(8)
    rows = [(i, "hot" if i % 3 else f"u{i % 20}", float(random.randint(0, 400)), random.random() < 0.05) for i in range(3000)]
    df = spark.createDataFrame(rows, "record_id long, url_key string, ts double, full boolean").repartition(5)
    known, last = {}, {}
    for i, url, ts, full in sorted(rows, key=lambda r: (r[2], r[0])):
        if full:
            last[url] = i
        else:
            known[i] = last.get(url)
    assert {r["record_id"]: r["refers_to"] for r in revisits.latest_earlier(df, 100).collect()} == known


def test_slices_of_many_cuts(spark):
    from bisect import bisect_right
    values = [-1.0, 0.0, 0.5, 41.0, 42.0, 4999.5, 9998.0, 9999.0, 1e9]
    df = spark.createDataFrame([(v,) for v in values], "ts double")
    for n in (0, 1, 2, 3, 10, 9_999, 10_000):
        cuts = [float(i) for i in range(n)]
        got = {r[0]: r[1] for r in df.select("ts", revisits.cuts_up_to(cuts, F.col("ts"))).collect()}
        assert got == {v: bisect_right(cuts, v) for v in values}


def test_pipeline(spark, documents):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "minhash near-dedup", "suffix-array dedup", "pii", "best-fit packing"]
    docs, folder = documents, "/root/testdata/sf0.001"
    kept = {r["doc_id"] for r in quality_rules.quality(docs).collect() if r["kept"]}
    first = corpus_pipeline.good_quality(spark, docs, folder).checkpoint()
    assert first.columns == docs.columns and {r["doc_id"] for r in first.collect()} == kept
    one = {r["doc_id"] for r in minhash.near_duplicates(first).collect() if r["kept"]}
    second = corpus_pipeline.distinct_texts(spark, first, folder).checkpoint()
    assert {r["doc_id"] for r in second.collect()} == one
    removed = {r["doc_id"]: r for r in suffix_dedup.repeats(second, length=corpus_pipeline.PASSAGE).collect()}
    third = corpus_pipeline.unrepeated_passages(spark, second, folder).checkpoint()
    texts = {r["doc_id"]: r["text"] for r in second.collect()}
    for r in third.collect():
        gone = removed[r["doc_id"]]
        if not gone["n_spans"]:
            assert r["text"] == texts[r["doc_id"]]
        else:       # whole characters: at most three bytes more at each end of a span
            assert 0 <= len(r["text"].encode()) - (gone["n_bytes"] - gone["n_removed"]) <= 6 * gone["n_spans"]
    fourth = corpus_pipeline.without_personal_data(spark, third, folder).checkpoint()
    assert fourth.columns == docs.columns
    assert all(sum(r[f"n_{k}"] for k in pii.KINDS) == 0 for r in pii.find(fourth).collect())
    whole = {(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, folder).collect()}
    last = packing.pack_documents(fourth, tokenizer_path(), with_ids=False)
    assert {(r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in last.collect()} == whole


def test_passage_of_52_words_is_cut(spark):
    def prose(seed, words):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(4, 6))) for _ in range(words))

    passage = prose(0, 52)
    assert 250 <= len(passage) < 400
    docs = spark.createDataFrame([(i, f"{prose(i, 100)}\n{passage}\n{prose(10 + i, 100)}") for i in (1, 2)], "doc_id long, text string").checkpoint()
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.unrepeated_passages(spark, docs, "").collect()}
    assert all(passage not in t and prose(i, 100) in t and prose(10 + i, 100) in t for i, t in left.items()) and len(left) == 2


def test_every_operator_is_registered():
    import __spark_entry__ as E
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 11)) and set(QUERIES) | {"pipeline"} <= set(E.queries())
    duckdb.sql("select 1")


def test_records_of_one_id_are_resolved_each(spark):
    rows = [(1, "http://a.org/x", 1.0, False, {"ETag": "p"}), (1, "http://b.org/y", 1.0, False, {"ETag": "q"}),
            (7, "http://a.org/x", 2.0, True, {"ETag": "p"}), (7, "http://b.org/y", 2.0, True, {"ETag": "p"}), (7, "http://c.org/z", 2.0, True, {"ETag": "p"}),
            (None, "http://a.org/x", 3.0, True, None)]
    df = spark.createDataFrame(rows, "record_id long, url string, ts double, revisit boolean, headers map<string,string>").repartition(3)
    got = revisits.resolve(df).collect()
    assert len(got) == len(rows)
    assert sorted((r["outcome"], r["refers_to"] or 0) for r in got if r["record_id"] == 7) == [("etag-mismatch", 1), ("no-response", 0), ("resolved", 1)]


def test_good_rows_are_kept_by_row_not_by_id(spark, documents):
    good = [r["text"] for r in quality_rules.quality(documents).filter("kept").join(documents.select("doc_id", "text"), "doc_id").limit(30).collect()]
    rows = [(i, t, "en") for i, t in enumerate(good)] + [(0, "bad text", "en"), (None, good[0], "en"), (None, "bad text", "en"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = quality_rules.keep_good(df, upper=1e6, lower=1e6).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"]) for r in kept) == [-1, *range(len(good))]
    assert all(r["text"] != "bad text" for r in kept)
