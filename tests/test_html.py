from pyspark.sql import functions as F

from irspark.functions import html as H
from irspark.operators import fields, html

PAGE = """lead<html><meta name="description" content=" first "><meta content="it's > x" name=description>
<meta name='keywords' content='a, b'><title>Ti&amp;</title><title>tle</title><body>one</b>two<!-- c <p>no</p> -->three
<p title="x>y" alt=' z '>para <b>bold</b> after <img alt=pic></p> a < b <style>p{}</style>tail
<script>var x='<p>no</p>';</script>gone<P>end &eacute;&#1078;&#x41;&nope;"""


def page(spark, text=PAGE):
    return spark.createDataFrame([(1, "http://h.x/", text)], "page_id long, url string, html string")


def test_runs_belong_to_the_last_opened_tag(spark):
    got = [(r.tag, r.text) for r in html.page_text(page(spark)).orderBy("pos").collect()]
    assert got == [
        ("", "lead"), ("body", "one"), ("body", "two"), ("body", "three"), ("p", "para"),
        ("b", "bold"), ("b", "after"), ("img", "a < b"), ("style", "p{}"), ("style", "tail"),
        ("p", "end éжA&nope;"),
    ]


def test_title_and_meta(spark):
    assert html.page_title(page(spark)).first().title == "Ti&tle"
    meta = html.page_meta(page(spark)).first()
    assert (meta.description, meta.keywords) == ("it's > x", "a, b")


def test_missing_meta_is_empty(spark):
    meta = html.page_meta(page(spark, "<p>x</p>")).first()
    assert (meta.description, meta.keywords) == ("", "")


def test_attributes(spark):
    got = [(r.tag, r.attr, r.value) for r in html.page_attrs(page(spark)).orderBy("pos").collect()]
    assert got == [("p", "title", "x>y"), ("p", "alt", "z"), ("img", "alt", "pic")]


def test_document_gathers_by_tag(spark):
    doc = html.page_document(page(spark)).first()
    assert doc.text["p"] == ["para", "end éжA&nope;"]
    assert set(doc.text) == {"", "body", "p", "b", "img", "style"}
    assert doc.attr["p"] == {"title": ["x>y"], "alt": ["z"]}


def test_long_pages_do_not_overflow(spark):
    text = "<p " + "a='b' " * 20000 + ">" + "x</b>" * 20000 + "a < b " * 20000
    assert html.page_text(page(spark, text)).count() == 20001


def test_field_builders(spark):
    row = fields.page_fields(page(spark)).select(
        fields.paragraph_text().alias("p"),
        fields.tagged_text().alias("t"),
        fields.training_text().alias("all"),
    ).first()
    assert row.p == "para\nend éжA&nope;"
    assert row.t == "para\nend éжA&nope;\nbold\nafter\na < b"
    assert row.all.endswith("\nTi&tle\nit's > x\na, b")


def test_unescape_once(spark):
    df = spark.createDataFrame([("&amp;lt; &copy &#0; &#xD800; &notit; &nope; &Aacute; &ampx",), (None,)], "t string")
    got = [r[0] for r in df.select(H.unescape(F.col("t"))).collect()]
    assert got == ["&lt; © � � ¬it; &nope; Á &x", None]


def test_links_skip_scripts_and_comments(spark):
    text = "<a href='/1'>x</a><A class=c HREF=/2>y</A><a name=n>z</a><script>'<a href=\"/3\">'</script><!-- <a href='/4'> -->"
    got = [r.href for r in html.extract_links(page(spark, text)).orderBy("pos").collect()]
    assert got == ["/1", "/2"]


def test_normalize_pages_keeps_shape(spark):
    doc = html.page_document(page(spark, "<title>красивые дома</title><p title='книги'>важная</p>"))
    row = fields.normalize_pages(doc).first()
    assert row.title == "красив дом"
    assert row.text["p"] == ["важн"]
    assert row.attr["p"]["title"] == ["книг"]
