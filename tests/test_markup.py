"""Plain markup by Spark's functions gives what the parser gives."""

import random

import pytest
from pyspark.sql import functions as F

from lexmill.functions import arrow, markup

CASES = [
    None, "", "  \n", "plain text", "<p>a</p><p>b</p>", "a<br/>b<br>c", '<p class="x" id="y">a  b\t c</p>\n\n\n\nd', "a &amp; b &lt;c&gt; &quot;&copy;&middot; &amp;lt;", "<script>var t=\"</p>\" & <b> ;</script>x<style>p{margin:0}</style>",
    "<!DOCTYPE html><html><!-- ad 0 --><b>x</b></html>", "<page-number>*12</page-number> The cause came on to be heard <page-number> 13 </page-number>\n\nnext page", "a<page-number></page-number>b", "<page-number>*7</page-number>", "x <page-number>**8</page-number>",
    "é ü ñ ß", "<li><page-number>*7</page-number>one</li><li><page-number>*7</page-number>two</li>", "x > y and a>b", "<p>   <page-number>5</page-number>   </p>end", "<section>a</section><h1>b</h1><hr/>c",
    # for the parser
    "é", "&eacute;&#233;", "[*12] a", "*12] b", '<span class="star-pagination">*3</span>a', '<page-number label="9">*8</page-number>t', "<P>upper</P>", "<p title='x'>y</p>", "a < b", "<p", "<!-- a--b -->x", "<page-number>3 no end", "a\rb", "\x01a", "a", " a ",
    "<script>x</style>y</script>z", "<textarea><b>x</b></textarea>", "<title>a & b</title>", "a&b", "<p a=\"x<y\">z</p>", "<page-number>a<b>c</b></page-number>d", "[*٣] x",
]
PLAIN = 19


def compare(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, m string")
    rows = df.select("i", "m", markup.rendered(F.col("m")).alias("a"), markup.is_plain(F.coalesce("m", F.lit(""))).alias("plain")).collect()
    for r in rows:
        text, breaks = arrow.render(r.m)
        assert (r.a.clean_text, [tuple(b) for b in r.a.page_breaks]) == (text, breaks), r.m
    return {r.i: r.plain for r in rows}


def test_cases(spark):
    plain = compare(spark, CASES)
    assert [plain[i] for i in range(len(CASES))] == [i < PLAIN for i in range(len(CASES))]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_markup(spark, seed):
    rnd = random.Random(seed)
    pieces = ["<p>", "</p>", "<b>", "</b>", "<br/>", " ", "\n", "\t", "word", "é", "&amp;", "&lt;", "<page-number>*4</page-number>", "<page-number> 5</page-number>", "<!-- x -->", "<script>if (a<b) </p></script>", '<a href="/x y">', "</a>", ">", "*", "7]", "[*", "&", "<", "</", "<li>", "some longer words here ", "<!--", "-->"]
    compare(spark, ["".join(rnd.choice(pieces[:22] if i % 3 else pieces) for _ in range(rnd.randrange(40))) for i in range(600)])


def test_pages(spark):
    marked = F.replace("html", F.lit("<li>"), F.lit("<li><page-number>*7</page-number>"))
    pages = [r.m for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select(marked.alias("m")).collect()]
    plain = compare(spark, pages)
    assert sum(plain.values()) >= 0.9 * len(pages)


def test_pages_decode_whole_entities_alone(spark, tmp_path):
    from lexmill.queries import texts

    pages = [(1, "<title>a&amp;&amp</title><script>x && y &amp z</script>b &lt; c &copy;"), (2, "<p>plain &amp; &quot;</p>"), (3, "<!-- & --><li>d & e</li>"), (4, None)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.clean_text for r in texts.render_pages(spark, str(tmp_path)).collect()}
    assert got == {1: "a&&ampx && y &amp zb &lt; c ©", 2: 'plain & "', 3: "d & e", 4: ""}
