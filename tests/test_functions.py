"""Scalars: captions, shingles, citations, spots, markup."""

import json
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from lexmill.functions import arrow, records, text
from lexmill.functions.folding import without_marks
from lexmill.operators import select, unpivot


def values(spark, column, *rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i long, x {kind}")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_caption_keys(spark):
    names = ["M'Clung v. The Silliman's", "Sam's of In-re AB", None, "the of", "Smith, Master v. The II Ships for use", "été d'or"]
    assert values(spark, text.caption_key("x"), *names) == ["mcclung silliman", "ab re samcs", "", "", "ii master ships smith use", "or"]
    assert values(spark, text.match_key("x"), *names) == ["mcclungsilliman", "abresamcs", "", "", "forshipssmith", "or"]


def test_shingles_need_enough_words(spark):
    rows = ["", "a b c d", "a b c d e", "<b>A</b> b, c-d e F", None, "x x x x x x x"]
    got = values(spark, text.shingles(text.plain_words("x")), *rows)
    assert got == [[], [], ["a b c d e"], ["a b c d e", "b c d e f"], [], ["x x x x x"]]


def test_leading_digits(spark):
    assert values(spark, text.leading_int("x"), "12a", "a12", "", None, "007", "401") == [12, None, None, None, 7, 401]


def test_blank_and_stripped(spark):
    rows = [" \t\n", " ", " a ", "", None]
    assert values(spark, text.blank_to_null("x"), *rows) == [None, None, " a ", None, None]
    assert values(spark, text.stripped("x"), *rows) == [None, None, "a", None, None]


def test_dirty(spark):
    rows = ["The Juftice", "juftices", "a ■", None, "éfaid", "faid.", "a_fuit"]
    assert values(spark, text.is_dirty("x"), *rows) == [True, False, True, False, False, True, False]


def test_suspects_and_their_json(spark):
    rows = ["Tbe ■ 𝒳 tbe", "clean", None, "■■", "bad-ber"]
    got = values(spark, text.suspects("x"), *rows)
    assert [[(h.offset, h.token) for h in r] for r in got] == [[(0, "Tbe"), (4, "■"), (8, "tbe")], [], [], [(0, "■"), (1, "■")], [(0, "bad"), (4, "ber")]]
    assert values(spark, text.suspects_json(text.suspects("x")), "a tbe", "x") == ['{"count":1,"hits":[{"offset":2,"token":"tbe"}]}', None]


def test_containment(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c", "d"]), ([], ["a"])], "l array<string>, r array<string>")
    over, shared = text.containment("l", "r")
    assert [tuple(r) for r in df.select(over, shared).collect()] == [(0.5, 1), (0.0, 0)]


@pytest.mark.parametrize(
    ("cites", "want"),
    [
        ([("U.S.", "12", "100")], (12, "100", "12 U.S. 100")),
        ([("U.S. LEXIS", "9", "z"), ("Dall.", "2", "1"), ("U.S.", "2", "300")], (2, "300", "2 U.S. 300")),
        ([("Dall.", "2", "1")], (None, None, None)),
        ([], (None, None, None)),
        ([("U.S.", "12", None)], (None, None, None)),
        ([("U.S.", "12", " ")], (None, None, None)),
        ([("U.S.", "02", "5")], (2, "5", "2 U.S. 5")),
        ([("U.S.", "x", "5"), ("U.S.", "3", "6")], (3, "6", "3 U.S. 6")),
    ],
)
def test_first_citation(spark, cites, want):
    df = spark.createDataFrame([([(*c, 1) for c in cites],)], "c array<struct<reporter:string,volume:string,page:string,type:int>>")
    assert tuple(df.select(records.first_citation("c").alias("r")).select("r.*").first()) == want


def test_ids_in_urls(spark):
    assert values(spark, records.id_in_url("x"), "https://h/api/opinions/12/", "/clusters/7", "none", None) == [12, 7, None, None]
    df = spark.createDataFrame([(5, "/c/6/"), (None, "/c/6/")], "i long, u string")
    assert [r[0] for r in df.select(records.parent_of("i", "u")).collect()] == [5, 6]


def test_contracts(spark):
    rule = records.contract_violations("x", ("id", "cites"), {"id": "integer", "cites": "array"})
    rows = '{"id": 1, "cites": []}', '{"id": "a", "cites": null}', '{"cites": {}}', '{"id": true, "cites": [1]}'
    got = values(spark, rule, *rows)
    assert got == [records.violations_of(json.loads(r), ("id", "cites"), {"id": "integer", "cites": "array"}) for r in rows]
    assert got == [[], ["'id' is no integer"], ["'id' is absent", "'cites' is no array"], []]


def test_ratio_keeps_its_order(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), ("", "a"), ("ab", "ab")], "a string, b string")
    assert [r[0] for r in df.select(arrow.sequence_ratio("a", "b")).collect()] == [0.25, 0.5, 0.0, 1.0]


MARKUP = [
    ('<p>One <span class="star-pagination" label="12">*12</span> two</p>', "One  two", [("12", 5)]),
    ('a<span class="x star-pagination">*13</span>b', "ab", [("13", 1)]),
    ("a <page-number>*7</page-number>b", "a b", [("7", 2)]),
    ("x [*54] y *55] z *56 w", "x  y  z *56 w", [("54", 3), ("55", 6)]),
    ("a<br/>b<br>c", "a\nb\nc", []),
    ("caf&eacute; é", "café é", []),
    ("a\x07\t b\r\nc \n\n\n\n d", "a b\nc\n\nd", []),
    ("<script>var x;</script>t<!-- c -->", "var x;t", []),
    ("a <span class='star-pagination' label='3'>*3 lost", "a ", [("3", 2)]),
    ("a 0b", "a 0b", []),
    (" \n ", "", []),
    (None, "", []),
    ("a <page-number/> b", "a b", []),
]


@pytest.mark.parametrize(("markup", "want", "breaks"), MARKUP)
def test_rendering(markup, want, breaks):
    got, found = arrow.render(markup)
    assert got == want and [(label, offset) for _, label, offset, _ in found] == breaks


def test_anchor_is_the_words_that_follow():
    _, found = arrow.render("a [*2] one two three four five six seven")
    assert found == [(1, "2", 3, "one two three four five six")]


def test_rendering_in_spark(spark):
    df = spark.createDataFrame([(i, m) for i, (m, _, _) in enumerate(MARKUP)], "i long, x string")
    rows = df.select("i", arrow.render_markup("x").alias("r")).orderBy("i").collect()
    assert [r.r.clean_text for r in rows] == [w for _, w, _ in MARKUP]
    assert [[(b.page_label, b.char_offset) for b in r.r.page_breaks] for r in rows] == [b for _, _, b in MARKUP]


def test_source_priority_and_longest(spark):
    df = spark.createDataFrame([("", "x", None, "y"), (None, None, None, None), ("aa", "b", "cc", "")], "source_html_lawbox string, source_xml_harvard string, source_html string, source_html_with_citations string")
    assert [r[0] for r in df.select(select.chosen_name()).collect()] == ["source_xml_harvard", None, "source_html_lawbox"]
    assert df.select(select.longest_text(("source_html", "source_html_lawbox"))).collect()[2][0] == "cc"


def test_long_form_and_manifest(spark):
    names = "id long, case_name_full string, attorneys string, judges string, " + ", ".join(f"{k} string" for k in unpivot.KINDS)
    rows = [(100, "Full", " ", "J", None, None, "sum", "head", None, "disp", " ", ""), (101, None, "A", None, *[None] * 8), (102, " ", "", None, *[None] * 8)]
    df = spark.createDataFrame(rows, names)
    pointers = spark.createDataFrame([(100, "canonical", None), (101, "duplicate", 100)], "cluster_id long, dedup_role string, dup_of long")
    texts, metas, counts = unpivot.build(df, unpivot.canonical_pointers(pointers))
    assert sorted((r.kind, r.char_count) for r in texts.collect()) == [("disposition", 4), ("headmatter", 4), ("summary", 3)]
    assert sorted(tuple(r) for r in metas.collect()) == [(100, "Full", None, "J"), (101, None, "A", None)]
    assert counts["n_skipped"] == 1 and counts["kind_summary"] == 1
    assert [tuple(r) for r in unpivot.kinds_manifest(texts, "cluster_id").collect()] == [(100, "summary;headmatter;disposition", 11)]


def test_search_folds(spark):
    from lexmill.operators import search

    df = spark.createDataFrame([(1, "The Naïve, necessary and PROPER clause"), (2, "proper"), (3, None)], "i long, t string")
    index = search.inverted_index(df, "i", "t")
    find = lambda q: sorted(r.i for r in search.match(index, q, "i").collect())
    assert find("necessary proper") == [1] and find("Proper") == [1, 2] and find("naive") == [1] and find("none OR proper") == [1, 2] and find("necessary none") == []
    assert df.select(F.count("i")).first()[0] == 3


def test_many_spots_in_one_text(spark):
    rows = ["tbe x " * 3000, "bad" * 9, "■" * 700, "𝒳Bad é_bim9 ber"]
    got = values(spark, text.suspects("x"), *rows)
    for row, found in zip(rows, got):
        want = [(m.start(), m[0]) for m in re.finditer("[A-Za-z]+|■", row) if m[0].lower() in text.SUSPECT_TOKENS or m[0] == "■"]
        assert [(h.offset, h.token) for h in found] == want


@pytest.mark.parametrize("size", [0, 1, 3, 4, 5, 17])
def test_running_sums(spark, size):
    df = spark.createDataFrame([(list(range(1, size + 1)),)], "a array<long>")
    assert df.select(text.before_each(F.col("a"), 4)).first()[0] == [i * (i + 1) // 2 for i in range(size)]


def test_folding_of_every_character(spark):
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    rows = [("".join(every[i : i + 500]),) for i in range(0, len(every), 500)] + [("a\u0301\u0327é",), ("",), ("plain",), ("각가a",)]
    plain = lambda t: "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))
    got = spark.createDataFrame(rows, "t string").select("t", without_marks(F.col("t")).alias("f"))
    assert all(r.f == plain(r.t) for r in got.collect())
    assert "Python" not in got._jdf.queryExecution().toString()
