"""Every operator and stage on awkward rows: nulls, empty and long texts, ties, repeats, extra columns."""

import pytest

import corpus_pipeline
from ticktide.llm import (alignment, byte_bpe, fingerprints, langid, packing, pii, quality, sentencepiece, simhash,
                          substring_dedup, token_counts, url_filter)

LONG = "alpha beta gamma delta " * 4000
PROSE = " ".join(f"word{i} stands{i * 7 % 13} here{i * i % 101}" for i in range(60))
TEXTS = [(1, PROSE), (1, PROSE), (2, PROSE), (3, None), (4, ""), (5, " \n\t "), (6, LONG), (None, PROSE), (7, "x"),
         (8, "Ünïcödé 漢字 😀 <|endoftext|> ▁ <s> \x00 end"), (9, "a@b.c +1 (234) 567-8901 4111 1111 1111 1111 1.2.3.4"),
         (10, "x" * 60_000)]
# Names that the operators use themselves.
EXTRA = "n_words long, fp long, view int, text_hash long, key long, row string, n_chars long, kept boolean, a long"
OPERATORS = {
    "encode": sentencepiece.encode, "count": token_counts.token_counts, "substrings": substring_dedup.deduplicate,
    "quality": quality.quality, "pii": pii.pii, "language": langid.identify,
    "byte_bpe": byte_bpe.encode, "alignment": alignment.align, "fingerprints": fingerprints.edited_fingerprints, "simhash": simhash.near_duplicates,
}


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, None if i == 2 else "en", None if i == 3 else "s", 1, 2, 3, 4, 5, "r", None, True, 6)
            for i, t in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {EXTRA}").repartition(3)


@pytest.mark.parametrize("name", OPERATORS)
def test_one_result_per_row(awkward, name):
    rows = OPERATORS[name](awkward).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in TEXTS)
    # Repeated rows get equal results.
    same = [r for r in rows if r["doc_id"] == 1]
    if name not in ("fingerprints",):
        assert same[0] == same[1]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(awkward, name):
    assert OPERATORS[name](awkward.filter("false")).collect() == []


def test_packing_awkward(awkward):
    rows = packing.pack(awkward).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in TEXTS}
    assert all(r["offset"] + r["length"] <= 1024 for r in rows)
    assert packing.pack(awkward.filter("false")).collect() == []


def test_urls_awkward(spark):
    urls = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://WWW.Example.COM/en/x?q#f"),
            (5, "http://a.example.com/en/"), (None, "http://b.net/es/"), (6, "http://b.net/es"), (7, "http://" + "a." * 9000),
            (8, "http://free-casino.org/")]
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in urls], "page_id long, url string, host string, token int")
    got = {(r["page_id"], r["host"][:20], r["path"]): (r["rule"], r["verdict"], r["pattern"])
           for r in url_filter.judge(pages).collect()}
    assert len(got) == len(urls)
    assert got[1, "", ""] == got[3, "", ""] == (None, "allow", None)
    assert got[5, "www.example.com", "/en/x"] == ("www.example.com/en/", "allow", None)
    assert got[5, "a.example.com", "/en/"] == ("example.com/en/", "block", None)
    assert got[None, "b.net", "/es/"] == ("net/es/", "block", None)
    assert got[6, "b.net", "/es"] == (None, "allow", None)
    assert got[8, "free-casino.org", "/"] == (None, "block", "^casino^")
    assert url_filter.judge(pages.filter("false")).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_awkward_rows(spark, awkward, sf_dir, name, stage):
    out = stage(spark, awkward, sf_dir)
    assert stage(spark, awkward.filter("false"), sf_dir).collect() == []
    if name != "packed":
        assert out.dtypes == awkward.dtypes
        assert out.count() <= awkward.count()


def test_rows_without_labels(awkward):
    from pyspark.sql import functions as F
    rows = langid.identify(awkward.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)}
