"""Nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""
import math

import pytest
from pyspark.sql import functions as F

from cabflow.llm import embdedup, langid, licenses, minhash, mixing, packing, pii, tokencount, topk, urlfilter

DOC = "doc_id long, text string, lang string, source string, n_chars long, size long, taken long, seq string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, l, s, None if t is None else len(t), 1, 2, "x") for i, t, l, s in rows], DOC)


@pytest.fixture(scope="module")
def odd(spark):
    long = "word " * 30_000 + "end" + "x" * 70_000
    rows = [(1, None, None, None), (2, "", "en", "b"), (3, "  \n\t ", "en", "b"), (4, "one two", "en", None), (5, long, "en", "a"),
            (6, "same text here for all of us", "en", "a"), (6, "same text here for all of us", "en", "a"), (None, "no id at all but some words", None, "a"),
            (7, "Same  text here\nfor all of us", "de", "é"), (8, "é\u00a0ü 漢字 🙂 \x00 end", None, "z")]
    return docs(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return docs(spark, [(1, "x", "en", "a")]).where("doc_id > 1")


def test_empty_tables(spark, none):
    vec = spark.createDataFrame([(1, [1.0], 1)], "vec_id long, embedding array<float>, label int").where("vec_id > 1")
    pages = spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string").where("page_id > 1")
    assert topk.top_k(vec, vec).count() == 0
    assert embdedup.embedding_links(vec).count() == 0
    assert urlfilter.filter_urls(pages).count() == 0
    assert langid.identify_corpus(none, pages).count() == 0 and langid.keep_identified(none).count() == 0
    assert minhash.near_duplicates(none).count() == 0 and minhash.keep_one(none).count() == 0
    assert packing.pack_documents(none).count() == 0
    assert mixing.mix_sizes(none).count() == 0 and mixing.repeat(none).count() == 0
    assert licenses.digest(licenses.scan_licenses(none)).count() == 0
    assert pii.digest(pii.find_spans(none)).count() == 0 and pii.redact(none).count() == 0
    assert tokencount.token_counts(none).count() == 0


def test_odd_texts(spark, odd):
    n = odd.count()
    assert licenses.digest(licenses.scan_licenses(odd)).count() == n
    assert pii.digest(pii.find_spans(odd)).count() == n
    red = pii.redact(odd)
    assert red.columns == odd.columns and red.count() == n
    t = tokencount.token_counts(odd)
    assert {r.doc_id: r.n_tokens for r in t.collect()}[1] == 0 and t.count() == n
    kept = langid.keep_identified(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 not in ids and 2 not in ids and 3 not in ids and 5 in ids


def test_near_duplicates_odd(odd):
    out = minhash.near_duplicates(odd)
    rows = out.collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[7].class_id == 6 and by[6].class_id == 6 and not by[7].kept
    assert by[1].class_id == 1 and by[2].class_id == 2 and by[None].class_id is None
    stay = minhash.keep_one(odd)
    assert stay.columns == odd.columns
    assert sorted(str(r.doc_id) for r in stay.select("doc_id").distinct().collect()) == sorted(map(str, [1, 2, 3, 4, 5, 6, 8, None]))


def test_mixing_odd(odd):
    out = mixing.mix(odd).collect()
    assert len(out) == odd.count()
    assert set(mixing.mix(odd).columns) == {"doc_id", "text", "lang", "source", "n_chars", "seq", "size", "source_size", "target", "taken"}
    for r in out:
        assert r.taken <= 3 * r["size"]
    by = {}
    for r in out:
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 1 + len(rows)
    rep = mixing.repeat(odd)
    assert rep.columns == odd.columns
    words = lambda d: d.select(F.sum(mixing.word_count("text"))).first()[0]
    assert words(rep) == sum(r.taken for r in out)
    assert sorted(map(repr, mixing.mix(odd).collect())) == sorted(map(repr, out))  # reruns agree


def test_vectors_odd(spark):
    inf, nan = math.inf, math.nan
    rows = [(0, [1.0, 0.0], 1, "q"), (50, [0.0, 1.0], 1, "q"), (1, [1.0, 0.0], 1, "q"), (1, [1.0, 0.0], 1, "q"), (2, [0.99, 0.01], 1, "q"), (3, None, 1, "q"),
            (4, [nan, 1.0], 1, "q"), (5, [None, 1.0], 1, "q"), (6, [inf, 1.0], 1, "q"), (7, [0.0, 0.0], 1, "q"), (8, [1.0, 0.0], None, "q"), (9, [1.0], 1, "q"),
            (None, [1.0, 0.0], 1, "q"), (10, [-0.5, 0.25], 2, "q")]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")
    top = topk.top_k(v, v.where("vec_id % 50 = 0"), k=3).collect()
    got = {q: [(r.vec_id, r.score) for r in sorted(top, key=lambda r: r.rank) if r.query_id == q] for q in (0, 50)}
    assert got[0] == [(1, 65536), (8, 65536), (9, 65536)]
    # the smaller part of 0.01 is floor(256 * 0.01) = 2
    assert got[50] == [(10, 64 * 256), (2, 2 * 256), (0, 0)]
    links = {r.vec_id: r for r in embdedup.embedding_links(v).collect() if r.vec_id is not None}
    assert links[0].n_links == 4 and links[0].component_id == 0 and links[0].kept   # two rows of 1, 2, and the row without an id
    assert links[2].component_id == 0 and not links[2].kept
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 50):
        assert links[i].n_links == 0 and links[i].component_id == i and links[i].kept, i


def test_urls_odd(spark):
    rows = [(1, None, None), (2, "no scheme", "x"), (3, "http://", ""), (4, "HTTP://WWW.Example.COM", None), (5, "http://a.com/x?y#z", None),
            (6, "http://example.com/en/1", None), (7, "http://www.example.com/en/1", None), (8, "http://x.net/es/q", None), (9, "a://b.org://c/d", None)]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1][:3] == ("", "", None) and got[2][:3] == ("", "", None) and got[3][:3] == ("", "", None)
    assert got[4] == ("www.example.com", "", None, got[4][3])
    assert got[5] == ("a.com", "/x", "com/", "allow") and got[6][2:] == ("example.com/en/", "block")
    assert got[7][2:] == ("www.example.com/en/", "allow") and got[8][2:] == ("net/es/", "block")
    assert got[9][:2] == ("b.org:", "//c/d")
