"""Language identification, main text and the pipeline."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from larder.llm import articles, langid, mixing, packing
from larder.llm.queries import QUERIES
from larder.session import stage

DATA = "/root/testdata/sf0.001"


# -- language ----------------------------------------------------------------------


def test_held_out_accuracy(spark, documents):
    lang = {r.doc_id: r.lang for r in documents.collect()}
    rows = QUERIES["op3_language_id"](spark, DATA).collect()
    assert len(rows) == len(lang)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 20
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, "uno dos tres" if i % 2 else "one two three", "es" if i % 2 else "en") for i in range(40)]
    poison = [
        (i, "uno dos tres", "xx") for i in range(100, 400) if zlib.crc32(str(i).encode()) % 4 == 2
    ]
    docs = spark.createDataFrame(rows + poison, "doc_id bigint, text string, lang string")
    got = langid.identify(docs).collect()
    assert {r.lang_pred for r in got} == {"en", "es"}


@pytest.mark.parametrize("count", [2, 3, 4])
def test_unknown_scripts_go_whatever_the_number_of_languages(spark, count):
    words = {"en": "one two three", "es": "uno dos tres", "de": "eins zwei drei", "fi": "yksi kaksi kolme"}
    names = list(words)[:count]
    rows = [(i, words[names[i % count]], names[i % count]) for i in range(12 * count)]
    odd = [(900, "Ελληνικά ΣΣ", None), (901, "日本語", None), (902, "12 34", None), (903, None, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string")
    kept = {r.doc_id for r in langid.keep_identified(docs).collect()}
    assert kept == {r[0] for r in rows}


def test_backoff_from_words_to_characters():
    model = langid.Model.of(
        ["a", "b"],
        {"known": np.array([-1.0, -9.0])},
        {"_ab": np.array([-2.0, -5.0])},
        {"zz": np.array([-4.0, -3.0])},
        {"q": np.array([-7.0, -6.0])},
    )
    assert model.word_scores("known").tolist() == [-1, -9]
    assert model.word_scores("abc").tolist() == [-2, -5]
    assert model.word_scores("xzzz").tolist() == [-4, -3]
    assert model.word_scores("q").tolist() == [-7, -6]
    assert model.word_scores("x").tolist() == [0, 0]
    scorer = langid.Scorer(model, limit=2)
    assert scorer.predict("known known abc q x y z")[0] == "a"
    assert scorer.predict("xyx")[0] == "a"  # a tie goes to the first name
    assert scorer.predict("12 !?") == scorer.predict(None) == scorer.predict("") == ("und", 0.0)


def test_language_of_odd_rows(odd, empty, odd_file):
    rows = {r.doc_id: r for r in langid.identify(odd).collect()}
    assert len(rows) == 10
    assert rows[3].lang_pred == rows[4].lang_pred == rows[5].lang_pred == "und"
    assert rows[None].held_out is False
    assert langid.identify(empty).count() == 0
    for docs in (odd, odd_file):
        kept = langid.keep_identified(docs)
        assert kept.columns == docs.columns
        assert not {r.doc_id for r in kept.collect()} & {3, 4, 5}
    assert langid.keep_identified(empty).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}
    assert langid.keep_identified(unlabelled).count() == 8


# -- pages -------------------------------------------------------------------------


def text_of(source):
    page = articles.parse(source)
    best = articles.best_container(page)
    return articles.extract(page, best[0]) if best else ""


STORY = "A long enough story about something that happened, told in full. "


@pytest.mark.parametrize(
    "source, expected",
    [
        (None, ""),
        ("", ""),
        ("<<<", "<<<"),
        ("plain text only", "plain text only"),
        ("<p>a &amp; b &lt;i&gt; &#233; &nbsp; &unknown; &amp", "a & b <i> é &unknown; &"),
        (f"<nav><a href=x>Home</a></nav><article><h1>Title</h1><p>{STORY}</article><footer>f</footer>",
         "Title\n" + STORY.strip()),
        (f"<div class='sidebar-2'>{STORY * 3}</div><main><p>{STORY}<p>two\n  lines</main>",
         STORY.strip() + "\ntwo lines"),
        (f"<article><p>{STORY}</p><div class='ad'>buy</div><script>if (a<b) x('</p>')</script>"
         f"<style>p{{}}</style><form><input>name</form><p>end</p><div id='comments'><p>{STORY * 5}</div></article>",
         STORY.strip() + "\nend"),
        (f"<div><p>{STORY}<b>bold</b> and <i>more<br>next</i></p></div><!-- <p>no</p> -->",
         STORY + "bold and more\nnext"),
        (f"<html><head><title>t</title><meta><body><div>{STORY}</div><div hidden>no</div>"
         f"<div style='display: none'>no</div></body>", STORY.strip()),
        (f"<header>site</header><article><header><h1>Head</h1></header><p>{STORY}</p></article>",
         "Head\n" + STORY.strip()),
        (f"<article><p>{STORY}</p><p>cut off <a href='x", STORY.strip() + "\ncut off"),
    ],
)
def test_main_text_of_a_page(source, expected):
    assert text_of(source) == expected


def test_hosts_agree_on_a_path(spark):
    def page(body, extra=""):
        return (
            f"<body><div class='menu'>menu</div><div class='post post-{len(body)}'><p>{body}</p></div>"
            f"<div class='promo-box'>x</div><div class='teaser'><p>{extra}</p></div></body>"
        )

    rows = [(i, "https://A.example.com:80/x", page(STORY * (i + 2))) for i in range(5)]
    rows.append((5, "http://a.example.com/short", page("Short one.", STORY * 3)))
    rows.append((6, "https://b.example.com/", page("Short one.", STORY * 3)))
    rows += [(7, None, None), (8, "not a url", ""), (7, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in articles.main_text(pages).collect()}
    assert got[5].text == "Short one."  # its own best container would be the teaser
    assert got[6].text == (STORY * 3).strip()
    assert got[7].text == got[8].text == "" and got[7].n_chars == 0
    assert got[3].n_chars == len(got[3].text)
    assert articles.main_text(pages).count() == len(rows)
    assert articles.main_text(pages.limit(0)).count() == 0


def test_all_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = QUERIES["op4_main_text"](spark, DATA).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        for end in ("</p>", "<p>", "<br>", "</h1>"):
            inner = inner.replace(end, "\n")
        for tag in ("<h1>", "<b>"):
            inner = inner.replace(tag, "")
        import html

        lines = (" ".join(html.unescape(x).split()) for x in inner.split("\n"))
        assert r.text == "\n".join(x for x in lines if x)


# -- the pipeline ------------------------------------------------------------------


def test_stages_work_on_what_is_left(spark, documents):
    docs, sizes = documents, {}
    for name, function in corpus_pipeline.STAGES:
        after = stage(function(spark, docs, DATA), f"test-{name}")
        if name != "pack_sequences":
            assert after.columns == documents.columns
        sizes[name] = after.count()
        if name == "exact_dedup":
            lower = {r.text.lower() for r in docs.select("text").collect()}
            assert sizes[name] == len(lower)
        if name == "mix_sources":
            planned = mixing.mixed_sizes(docs).collect()
            expected = Counter({r.doc_id: r.taken // r.size for r in planned if r.taken})
            assert Counter(r.doc_id for r in after.select("doc_id").collect()) == expected
        if name == "pack_sequences":
            rows = after.collect()
            assert {r.doc_id for r in rows} == {r.doc_id for r in docs.select("doc_id").collect()}
            assert all(len(r.ids) == 4 * r.length for r in rows)
            full = Counter()
            for r in rows:
                full[r.sequence_id] += r.length
            assert max(full.values()) <= packing.WINDOW
        docs = after
    assert sizes["language_id"] == 200  # every document there is clean text
    assert sizes["simhash_dedup"] <= sizes["exact_dedup"] <= 200


def test_pipeline_of_odd_and_empty_tables(spark, odd_file, empty):
    for docs in (odd_file, empty):
        names = docs.columns
        for name, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, DATA), f"test-{name}")
            assert name == "pack_sequences" or docs.columns == names
        docs.collect()


def test_pipeline_query(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0
