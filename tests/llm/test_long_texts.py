"""Texts of a megabyte that once took quadratic time: each in seconds."""

import time

import pytest

from rosterlake.llm import html_text, secrets, surrogates

BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def test_secrets_in_one_long_run(spark):
    run = "".join(BASE64[i * i * 7 % 61 % 64] for i in range(1_000_000))
    words = "/".join(["customers", "orders-of-the-year"] * 40_000)
    docs = spark.createDataFrame([(1, run), (2, words), (3, "plain words")], "doc_id bigint, text string")
    found = secrets.find_secrets(docs, secrets.train(docs, sample=50)).select("doc_id", "found.start", "found.end")
    began = time.time()
    rows = {r["doc_id"]: r for r in found.collect()}
    assert time.time() - began < 60
    assert rows[3]["start"] == [] and all(0 <= s < e <= len(run) for s, e in zip(rows[1]["start"], rows[1]["end"]))


@pytest.mark.parametrize("text,kinds", [
    ("a@ " * 350_000, 0), ("a" * 1_000_000 + "@", 0), ("a@" * 500_000, 0), ("@" * 1_000_000, 0),
    ("a" * 1_000_000 + "@ b joe@example.org", 1), ("x@y.z" * 200_000, 100_000), ("1 " * 500_000, 0), ("Dr. " * 250_000, 0)])
def test_entities_in_long_texts(text, kinds):
    began = time.time()
    found = surrogates.entities_of(text)
    assert time.time() - began < 10
    assert sum(k == "email" for _, _, k in found) == kinds


def test_keys(spark):
    docs = spark.createDataFrame([("joe@example.org",)], "text string")
    with pytest.warns(UserWarning, match="not set"):
        assert surrogates.surrogate_key(spark) == surrogates.TRIAL_KEY
    spark.conf.set(surrogates.KEY_SETTING, "secret")
    try:
        assert surrogates.surrogate_key(spark) == "secret"
    finally:
        spark.conf.unset(surrogates.KEY_SETTING)
    one, two = (surrogates.distinct_surrogates(docs, k).first()["text"] for k in ("k1", "k2"))
    assert one != two
    with pytest.raises(ValueError, match="another key"):
        surrogates.distinct_surrogates(docs, "k", tries=0)


@pytest.mark.parametrize("piece,tail", [
    ("<a ", ""), ("<!x ", ""), ("<![CDATA[>", ""), ("<a \"", ""), ("<a \">\"", "'"), ("<svg><p>", ""), ("<div><svg></div>", "</svg>"),
    ("<head><title>", ""), ("<div>", "</x>" * 100_000), ("<", ""), ("<!--", ""), ("</p ", ""), ("<a '>", "\""),
    ("<noscript><div>", ""), ("<p class='", "")])
def test_pages_of_broken_markup(piece, tail):
    page = piece * (1_000_000 // len(piece)) + tail
    began = time.time()
    html_text.main_text(page, {"the"})
    assert time.time() - began < 15


@pytest.mark.parametrize("page,want", [
    ("<article><p>L</p><p class='share-price'>The price.</p><p class='advert'>Buy</p><p>L</p></article>", "L|The price.|L"),
    ("<main><header><h1>Title</h1></header><p>L</p></main>", "Title|L"),
    ("<article><p>1 <b and it's 2</p><p>L</p></article>", "1 <b and it's 2|L"),
    ("<article><p>L</p><p>a < b > c</p></article>", "L|a < b > c")])
def test_article_text_is_kept(page, want):
    line = "The words of the article and the story of the day run on for a good while here."
    assert html_text.main_text(page.replace("L<", line + "<"), {"the", "of", "and", "a", "for"}).split("\n") == [
        line if w == "L" else w for w in want.split("|")]
