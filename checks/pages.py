"""Page extraction, field scoring and the link graph of the pages table."""

from __future__ import annotations

import base64
import sys
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, r6, table, wide_table
from checks.text import candidates, queries
from irspark.functions import html as H
from irspark.functions import urls as U
from irspark.operators import fields, graph, html, ranking, tfidf
from irspark.plans.lineage import materialize
from irspark.sources import graph as GS
from irspark.sources import relevance as S

TRIM = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160)"


# Workers get the functions of this module with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def pages(spark: SparkSession, d: str) -> DataFrame:
    return wide_table(spark, d, "pages")


def decoded_sql(column: str) -> str:
    """Character references of the pages; a name may also stand without its semicolon."""
    for name, char in (("middot", "chr(183)"), ("copy", "chr(169)"), ("quot", "'\"'"), ("lt", "'<'"), ("gt", "'>'"), ("amp", "'&'")):
        column = f"regexp_replace({column}, '&{name};?', {char}, 'g')"
    return column


# The SQL finds the last opened tag with a window over all markup of a page.
RUNS_SQL = f"""
clean AS (
  SELECT page_id, url, regexp_replace(html, '<script[^>]*>.*?</script>', '<script></script>', 'gs') AS h
  FROM pages
),
mark AS (
  SELECT page_id, url, unnest(m) AS t, generate_subscripts(m, 1) AS i
  FROM (SELECT page_id, url, regexp_extract_all(h, '(?s)<(?:!--.*?--|[^>]*)>[^<]*') AS m FROM clean)
),
opened AS (
  SELECT page_id, url, i, t,
    regexp_extract(t, '(?s)^<(?:!--.*?--|[^>]*)>([^<]*)$', 1) AS raw,
    CASE WHEN regexp_matches(t, '^<[a-zA-Z]') THEN lower(regexp_extract(t, '^<([a-zA-Z][a-zA-Z0-9]*)', 1)) END AS o
  FROM mark
),
tagged AS (
  SELECT page_id, url, i, raw,
    last_value(o IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS tag
  FROM opened
),
run AS (
  SELECT page_id, url, i, coalesce(tag, '') AS tag, trim(CASE WHEN tag = 'style' THEN raw ELSE
    {decoded_sql('raw')} END, {TRIM}) AS text
  FROM tagged
)"""


@check(f"""
WITH {RUNS_SQL}
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos, tag, text
FROM run WHERE text <> '' AND tag NOT IN ('title', 'script')
""")
def page_text(spark: SparkSession, d: str) -> DataFrame:
    return html.page_text(pages(spark, d))


@check(f"""
WITH {RUNS_SQL}
SELECT page_id, coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE tag = 'title' AND text <> ''), '') AS title
FROM run GROUP BY page_id
""")
def page_title(spark: SparkSession, d: str) -> DataFrame:
    return html.page_title(pages(spark, d))


# Pages have no description, keywords, title or alt attributes; every page gets some, written
# from its own url and id, in several quotings.
def pages_with_meta(spark: SparkSession, d: str) -> DataFrame:
    head = F.concat(
        F.lit('<meta name="description" content="first"><META content=" about > '),
        "url",
        F.lit(" &amp; more \" NAME=description><meta name='keywords' content='k"),
        F.col("page_id").cast("string"),
        F.lit(", page'><img alt=p"),
        F.col("page_id").cast("string"),
        F.lit(' title=" "><p title="t'),
        F.col("page_id").cast("string"),
        F.lit("\" alt=' a > b '>x</p>"),
    )
    return pages(spark, d).withColumn("html", F.concat("html", head))


@check("""
SELECT page_id, 'about > ' || url || ' & more' AS description, 'k' || page_id || ', page' AS keywords
FROM pages
""")
def page_meta(spark: SparkSession, d: str) -> DataFrame:
    return html.page_meta(pages_with_meta(spark, d))


@check("""
SELECT page_id, 0 AS pos, 'img' AS tag, 'alt' AS attr, 'p' || page_id AS value FROM pages
UNION ALL SELECT page_id, 1, 'p', 'title', 't' || page_id FROM pages
UNION ALL SELECT page_id, 2, 'p', 'alt', 'a > b' FROM pages
""")
def page_attrs(spark: SparkSession, d: str) -> DataFrame:
    return html.page_attrs(pages_with_meta(spark, d))


DOCUMENT_SQL = f"""
{RUNS_SQL},
doc AS (
  SELECT page_id, url,
    coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE tag = 'title'), '') AS title,
    coalesce(string_agg(text, chr(10) ORDER BY i) FILTER (WHERE tag = 'p'), '') AS p_text,
    count(DISTINCT tag) FILTER (WHERE tag <> 'title') AS n_tags
  FROM run WHERE text <> '' AND tag <> 'script' GROUP BY page_id, url
)"""


@check(f"""
WITH {DOCUMENT_SQL}
SELECT page_id AS number, url, title, '' AS description, md5(p_text) AS p_text, n_tags, 0 AS n_attrs FROM doc
""")
def page_document(spark: SparkSession, d: str) -> DataFrame:
    record = html.page_document(pages(spark, d))
    runs = F.coalesce(F.try_element_at("text", F.lit("p")), F.array().cast("array<string>"))
    return record.select(
        "number",
        "url",
        "title",
        "description",
        F.md5(F.array_join(runs, "\n")).alias("p_text"),
        F.size("text").cast("bigint").alias("n_tags"),
        F.size("attr").alias("n_attrs"),
    )


@check(rf"""
WITH {DOCUMENT_SQL}
SELECT page_id AS number, array_to_string(regexp_extract_all(title, '[\p{{L}}\p{{N}}_]+'), ' ') AS title,
  md5(array_to_string(regexp_extract_all(p_text, '[\p{{L}}\p{{N}}_]+'), ' ')) AS p_text FROM doc
""")
def normalized_pages(spark: SparkSession, d: str) -> DataFrame:
    record = fields.normalize_pages(html.page_document(pages(spark, d)))
    runs = F.coalesce(F.try_element_at("text", F.lit("p")), F.array().cast("array<string>"))
    words = F.filter(runs, lambda r: r != "")
    return record.select("number", "title", F.md5(F.array_join(words, " ")).alias("p_text"))


TAGS = ", ".join(f"'{t}'" for t in H.TEXT_TAGS)
# Runs are gathered per tag, tags in the order in which they first show text.
FIELDS_SQL = f"""
{RUNS_SQL},
kept AS (SELECT * FROM run WHERE text <> '' AND tag NOT IN ('title', 'script')),
ordered AS (SELECT *, min(i) OVER (PARTITION BY page_id, tag) AS first_i FROM kept),
texts AS (
  SELECT page_id,
    coalesce(string_agg(text, chr(10) ORDER BY first_i, i) FILTER (WHERE tag = 'p'), '') AS paragraphs,
    string_agg(text, chr(10) ORDER BY first_i, i) AS all_tags,
    coalesce(string_agg(text, chr(10) ORDER BY first_i, i) FILTER (WHERE tag IN ({TAGS})), '') AS listed
  FROM ordered GROUP BY page_id
),
titles AS (
  SELECT page_id, coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE tag = 'title'), '') AS title
  FROM run GROUP BY page_id
),
fx AS (SELECT * FROM texts JOIN titles USING (page_id))"""


@check(f"""
WITH {FIELDS_SQL}
SELECT page_id AS doc_id, md5(paragraphs) AS paragraphs, md5(all_tags) AS all_tags, md5(listed) AS listed,
  md5(listed || chr(10) || title || chr(10) || chr(10)) AS training FROM fx
""")
def field_text(spark: SparkSession, d: str) -> DataFrame:
    return fields.page_fields(pages(spark, d)).select(
        "doc_id",
        F.md5(fields.paragraph_text()).alias("paragraphs"),
        F.md5(fields.all_text()).alias("all_tags"),
        F.md5(fields.tagged_text()).alias("listed"),
        F.md5(fields.training_text()).alias("training"),
    )


PAGE_SCORE_SQL = rf"""
{FIELDS_SQL},
train AS (SELECT page_id AS doc_id, listed || chr(10) || title || chr(10) || chr(10) AS text FROM fx),
fit AS (
  SELECT term, count(DISTINCT doc_id) AS df FROM (
    SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS term FROM train)
  GROUP BY term
),
idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM train)) / (1 + df)) + 1 AS idf FROM fit),
long AS (
  SELECT page_id AS doc_id, 'text' AS field, listed AS text FROM fx
  UNION ALL SELECT page_id, 'title', title FROM fx
  UNION ALL SELECT page_id, 'all', all_tags FROM fx
),
tf AS (
  SELECT doc_id, field, term, count(*) AS tf FROM (
    SELECT doc_id, field, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS term FROM long)
  GROUP BY 1, 2, 3
),
w AS (
  SELECT doc_id, field, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id, field)) AS weight
  FROM tf JOIN idf USING (term)
),
cand AS (
  SELECT CAST(page_id % (SELECT count(*) FROM benchmark) AS VARCHAR) AS query_id, page_id AS doc_id FROM pages
  UNION ALL SELECT CAST(item_id AS VARCHAR), item_id + 1000000000 FROM benchmark
),
qtok AS (
  SELECT CAST(item_id AS VARCHAR) AS query_id,
    unnest(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '')) AS term FROM benchmark
),
hits AS (
  SELECT c.query_id, c.doc_id, w.field, sum(w.weight) AS score
  FROM cand c JOIN qtok q USING (query_id) JOIN w ON w.doc_id = c.doc_id AND w.term = q.term GROUP BY 1, 2, 3
),
names AS (SELECT unnest(['text', 'title', 'keywords', 'description', 'all']) AS field),
scored AS (
  SELECT c.query_id, c.doc_id, n.field,
    CASE WHEN p.page_id IS NULL THEN NULL ELSE coalesce(h.score, 0) END AS score
  FROM cand c CROSS JOIN names n LEFT JOIN pages p ON p.page_id = c.doc_id
  LEFT JOIN hits h ON h.query_id = c.query_id AND h.doc_id = c.doc_id AND h.field = n.field
)"""
FOUR = ("text", "title", "keywords", "description")
WEIGHTS = {
    "text": 1.0, "title": 0.4, "description": 0.4, "keywords": 0.4,
    "xtext": 2.0, "xtitle": 0.4, "xdescription": 0.4, "xkeywords": 0.4,
}


def _fitted(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Parsed pages, written once, and the idf of their training text."""
    parsed = materialize(fields.page_fields(pages(spark, d)))
    training = parsed.select("doc_id", fields.training_text().alias("text"))
    return parsed, tfidf.fit_idf(training)


def _scores(
    spark: SparkSession, d: str, parsed: DataFrame, texts: DataFrame, idf: DataFrame, names: tuple[str, ...] = FOUR
) -> DataFrame:
    weights = tfidf.transform(texts, idf, ("doc_id", "field"))
    cand = candidates(spark, d, "pages", "page_id")
    return tfidf.score(queries(spark, d), cand, weights, parsed, names)


def field_scores(spark: SparkSession, d: str) -> DataFrame:
    parsed, idf = _fitted(spark, d)
    return _scores(spark, d, parsed, fields.field_texts(parsed), idf)


def two_families(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the four fields, merged with scores where the text is that of all tags.

    Fields are weighted and scored apart from each other, so both families take theirs from one run.
    """
    parsed, idf = _fitted(spark, d)
    whole = parsed.select("doc_id", F.lit("all").alias("field"), fields.all_text().alias("text"))
    texts = fields.field_texts(parsed).unionByName(whole)
    scores = materialize(_scores(spark, d, parsed, texts, idf, (*FOUR, "all")))
    field = F.col("field")
    others = scores.filter(field != "text").withColumn("field", F.when(field == "all", "text").otherwise(field))
    return ranking.merge_families(scores.filter(field != "all"), others)


@check(f"WITH {PAGE_SCORE_SQL} SELECT doc_id, term, round(weight, 6) AS weight FROM w WHERE field = 'all'")
def page_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Weights of the text of all tags."""
    parsed, idf = _fitted(spark, d)
    texts = parsed.select("doc_id", fields.all_text().alias("text"))
    return tfidf.transform(texts, idf).select("doc_id", "term", r6("weight").alias("weight"))


@check(f"WITH {PAGE_SCORE_SQL} SELECT doc_id, field, term, round(weight, 6) AS weight FROM w WHERE field <> 'all'")
def field_weights(spark: SparkSession, d: str) -> DataFrame:
    parsed, idf = _fitted(spark, d)
    weights = tfidf.transform(fields.field_texts(parsed), idf, ("doc_id", "field"))
    return weights.select("doc_id", "field", "term", r6("weight").alias("weight"))


@check(f"""
WITH {PAGE_SCORE_SQL}
SELECT query_id, doc_id, field, round(score, 6) AS score FROM scored WHERE field <> 'all'
""")
def tfidf_field_scores(spark: SparkSession, d: str) -> DataFrame:
    return field_scores(spark, d).select("query_id", "doc_id", "field", r6("score").alias("score"))


@check(f"""
WITH {PAGE_SCORE_SQL}
SELECT query_id, doc_id, round(max(score) FILTER (WHERE field = 'text'), 6) AS "text",
  round(max(score) FILTER (WHERE field = 'title'), 6) AS title, 4 AS n_fields
FROM scored WHERE field <> 'all' GROUP BY 1, 2
""")
def field_score_record(spark: SparkSession, d: str) -> DataFrame:
    record = tfidf.score_record(field_scores(spark, d))
    return record.select(
        "query_id",
        "doc_id",
        r6(F.element_at("scores", "text")).alias("text"),
        r6(F.element_at("scores", "title")).alias("title"),
        F.size("scores").alias("n_fields"),
    )


TOTAL_SQL = f"""
{PAGE_SCORE_SQL},
total AS (
  SELECT query_id, doc_id, coalesce(sum(score), -1) AS score FROM scored WHERE field <> 'all' GROUP BY 1, 2
)"""


@check(f"""
WITH {TOTAL_SQL}
SELECT query_id, doc_id, round(score, 6) AS score,
  row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM total
""")
def rank_sum(spark: SparkSession, d: str) -> DataFrame:
    ranked = ranking.rank_by_sum(field_scores(spark, d))
    return ranked.select("query_id", "doc_id", r6("score").alias("score"), "rank")


@check(f"""
WITH {TOTAL_SQL},
good AS (
  SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS place
  FROM total WHERE score <> -1
),
n AS (SELECT query_id, count(*) FILTER (WHERE score <> -1) AS n FROM total GROUP BY 1),
bad AS (
  SELECT t.query_id, t.doc_id, floor(CAST('0x' || substr(md5('5|' || t.query_id || '|' || t.doc_id), 1, 12) AS BIGINT)
    / 281474976710656.0 * (n + 1)) + 0.5 AS place FROM total t JOIN n USING (query_id) WHERE score = -1
)
SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY place, doc_id) AS rank
FROM (SELECT * FROM good UNION ALL SELECT * FROM bad)
""")
def rank_random_missing(spark: SparkSession, d: str) -> DataFrame:
    ranked = ranking.rank_random_missing(field_scores(spark, d), "5")
    return ranked.select("query_id", "doc_id", "rank")


MERGED_SQL = f"""
{PAGE_SCORE_SQL},
fam AS (
  SELECT query_id, doc_id, field, score FROM scored WHERE field <> 'all'
  UNION ALL
  SELECT query_id, doc_id, 'x' || CASE WHEN field = 'all' THEN 'text' ELSE field END, score
  FROM scored WHERE field <> 'text' AND score IS NOT NULL
)"""


@check(f"WITH {MERGED_SQL} SELECT query_id, doc_id, field, round(score, 6) AS score FROM fam")
def rank_merge(spark: SparkSession, d: str) -> DataFrame:
    return two_families(spark, d).select("query_id", "doc_id", "field", r6("score").alias("score"))


@check(f"""
WITH {MERGED_SQL},
total AS (
  SELECT query_id, doc_id, sum(score * CASE field WHEN 'text' THEN 1.0 WHEN 'xtext' THEN 2.0 ELSE 0.4 END) AS score
  FROM fam GROUP BY 1, 2
)
SELECT query_id, doc_id, round(score, 6) AS score, row_number() OVER (
  PARTITION BY query_id ORDER BY round(score, 9) DESC NULLS LAST, doc_id) AS rank FROM total
""")
def rank_weighted(spark: SparkSession, d: str) -> DataFrame:
    ranked = ranking.rank_weighted(two_families(spark, d), WEIGHTS)
    return ranked.select("query_id", "doc_id", r6("score").alias("score"), "rank")


@check(f"SELECT page_id, md5({decoded_sql('html')}) AS decoded FROM pages")
def entities(spark: SparkSession, d: str) -> DataFrame:
    """Character references of whole pages."""
    return pages(spark, d).select("page_id", F.md5(H.unescape(F.col("html"))).alias("decoded"))


@check("SELECT page_id, md5(html) AS html FROM pages")
def decode_pages(spark: SparkSession, d: str) -> DataFrame:
    raw = pages(spark, d).select("page_id", F.encode("html", "UTF-8").alias("content"))
    return S.decode_content(raw).select("page_id", F.md5("html").alias("html"))


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        packed = [base64.b64encode(zlib.compress(h.encode("utf-8"))).decode() for h in batch["html"]]
        yield pd.DataFrame({"value": [f"{i}\t{p}" for i, p in zip(batch["page_id"], packed)]})


def packed_lines(spark: SparkSession, d: str) -> DataFrame:
    return pages(spark, d).select("page_id", "html").mapInPandas(
        lambda batches: _pack(batches), "value string"
    )


@check("""
SELECT page_id AS id, regexp_replace(regexp_replace(url, '^https://', 'http://'), '/+$', '') AS url,
  md5(html) AS html FROM pages
""")
def packed_pages(spark: SparkSession, d: str) -> DataFrame:
    """Packed page lines, unpacked and given their url from the side table."""
    unpacked = S.read_packed_pages(packed_lines(spark, d))
    side = pages(spark, d).select(F.col("page_id").alias("id"), "url")
    return graph.attach_urls(unpacked, side).select("id", "url", F.md5("html").alias("html"))


HREF_SQL = """
href AS (
  SELECT page_id, url, unnest(m) AS href, generate_subscripts(m, 1) - 1 AS pos
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a[^>]*\\shref="([^"]*)"', 1) AS m FROM pages)
)"""


@check(f"WITH {HREF_SQL} SELECT page_id, pos, href FROM href")
def page_hrefs(spark: SparkSession, d: str) -> DataFrame:
    return html.extract_links(pages(spark, d))


@check("""
SELECT page_id, regexp_replace(regexp_replace(url, '^https://', 'http://'), '/+$', '') AS normal FROM pages
""")
def url_normalize(spark: SparkSession, d: str) -> DataFrame:
    rough = F.concat(F.lit(""), F.col("url"), F.lit("//\n"))
    plain = U.normalize_url(F.col("url"))
    # Slashes before a closing newline go as well.
    same = F.when(U.normalize_url(rough) == plain, plain)
    return pages(spark, d).select("page_id", same.alias("normal"))


@check(f"""
WITH {HREF_SQL},
b AS (
  SELECT page_id, pos, href, url, regexp_extract(url, '^([a-z]+)://', 1) AS sch,
    regexp_extract(url, '^[a-z]+://[^/]*', 0) AS root,
    regexp_extract(url, '^[a-z]+://[^/]*(/[^?#]*/)', 1) AS folder,
    regexp_extract(url, '^([^#]*)', 1) AS page
  FROM href
)
SELECT page_id, pos, 'plain' AS kind, root || href AS url FROM b
UNION ALL SELECT page_id, pos, 'host', sch || '://other.org' || href FROM b
UNION ALL SELECT page_id, pos, 'relative', root || folder || 'r' || href FROM b
UNION ALL SELECT page_id, pos, 'up', root || href FROM b
UNION ALL SELECT page_id, pos, 'dots', root || folder || 'x' || href FROM b
UNION ALL SELECT page_id, pos, 'query', root || folder || '?q=' || pos FROM b
UNION ALL SELECT page_id, pos, 'fragment', page || '#f' || pos FROM b
UNION ALL SELECT page_id, pos, 'script', NULL FROM b
UNION ALL SELECT page_id, pos, 'absolute', 'http://abs.org' || href FROM b
""")
def url_resolve(spark: SparkSession, d: str) -> DataFrame:
    """Every link of every page, also rewritten in the other forms a link can take."""
    href, pos = F.col("href"), F.col("pos").cast("string")
    forms = {
        "plain": href,
        "host": F.concat(F.lit("//other.org"), href),
        "relative": F.concat(F.lit(" r"), href),
        "up": F.concat(F.lit("/a/b/../.."), href),
        "dots": F.concat(F.lit("./y/../x/."), href),
        "query": F.concat(F.lit("?q="), pos),
        "fragment": F.concat(F.lit("#f"), pos),
        "script": F.concat(F.lit("javascript:"), href),
        "absolute": F.concat(F.lit("http://abs.org"), href),
    }
    variants = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("link")) for k, v in forms.items()]))
    links = html.extract_links(pages(spark, d)).join(pages(spark, d).select("page_id", "url"), "page_id")
    return links.select("page_id", "pos", "url", variants.alias("v")).select(
        "page_id", "pos", "v.kind", U.resolve_url(F.col("url"), F.col("v.link")).alias("url")
    )


@check("""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1) AS host,
  regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1) LIKE '%.example.com' AS on_com FROM pages
""")
def host_filter(spark: SparkSession, d: str) -> DataFrame:
    host = U.host(F.col("url"))
    com = F.concat(F.regexp_replace(host, r"\.example\..*$", ""), F.lit(".example.com"))
    return pages(spark, d).select(
        "page_id", host.alias("host"), U.same_host(F.col("url"), com).alias("on_com")
    )


GRAPH_SQL = f"""
{HREF_SQL},
page AS (SELECT page_id, regexp_replace(regexp_replace(url, '^https://', 'http://'), '/+$', '') AS url FROM pages),
link AS (
  SELECT p.url, h.page_id, h.pos,
    regexp_replace(regexp_extract(p.url, '^[a-z]+://[^/?#]*', 0) || h.href, '/+$', '') AS link
  FROM href h JOIN page p USING (page_id)
),
merged AS (
  SELECT p.url, l.link, count(l.link) AS times FROM page p LEFT JOIN link l ON l.page_id = p.page_id GROUP BY 1, 2
)"""


@check(f"""
WITH {GRAPH_SQL}
SELECT p.url, coalesce(string_agg(l.link, ' ' ORDER BY l.pos), '') AS links
FROM page p LEFT JOIN link l ON l.page_id = p.page_id GROUP BY p.page_id, p.url
""")
def link_graph(spark: SparkSession, d: str) -> DataFrame:
    return graph.link_graph(pages(spark, d)).select("url", F.array_join("links", " ").alias("links"))


@check(f"WITH {GRAPH_SQL} SELECT url, link, times FROM merged")
def merge_adjacency(spark: SparkSession, d: str) -> DataFrame:
    return graph.merge_adjacency(graph.link_graph(pages(spark, d)))


NUMBERED_SQL = f"""
{GRAPH_SQL},
names AS (SELECT url FROM merged UNION SELECT link FROM merged WHERE link IS NOT NULL),
ids AS (SELECT url, row_number() OVER (ORDER BY url) - 1 AS id FROM names)"""


@check(f"""
WITH {NUMBERED_SQL}
SELECT s.id, t.id AS link_id, m.times FROM merged m JOIN ids s ON s.url = m.url LEFT JOIN ids t ON t.url = m.link
""")
def number_urls(spark: SparkSession, d: str) -> DataFrame:
    return graph.number_urls(graph.link_graph(pages(spark, d)))[1]


@check(f"WITH {NUMBERED_SQL} SELECT id, url FROM ids")
def url_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return graph.number_urls(graph.link_graph(pages(spark, d)))[0]


@check(f"""
WITH {GRAPH_SQL},
rows AS (
  SELECT url, CASE WHEN link IS NULL THEN 1 ELSE 0 END AS empty FROM merged GROUP BY 1, 2
  UNION SELECT link, 1 FROM merged WHERE link IS NOT NULL AND link NOT IN (SELECT url FROM merged)
)
SELECT count(*) AS pages, CAST(sum(empty) AS BIGINT) AS without_links, round(sum(empty) / count(*), 6) AS share
FROM rows
""")
def graph_stats(spark: SparkSession, d: str) -> DataFrame:
    stats = graph.graph_stats(graph.link_graph(pages(spark, d)), count_targets=True)
    return stats.withColumn("share", r6("share"))


@check(f"""
WITH {GRAPH_SQL}
SELECT url, NULL AS value, coalesce(string_agg(link, ' ' ORDER BY link), '') AS links
FROM (SELECT p.url, l.link FROM page p LEFT JOIN link l ON l.page_id = p.page_id) GROUP BY url
""")
def adjacency_tsv(spark: SparkSession, d: str) -> DataFrame:
    """Adjacency written as text lines and read back."""
    edges = graph.link_graph(pages(spark, d)).select("url", F.explode_outer("links").alias("link"))
    lines = GS.format_adjacency(GS.adjacency_lists(edges))
    back = GS.parse_adjacency(lines)
    return back.select(
        "url", F.col("value").cast("string").alias("value"), F.array_join("links", " ").alias("links")
    )


@check("""
SELECT CASE WHEN role = 'user' THEN conv_id || chr(9) || turn ELSE conv_id || chr(9) || turn || chr(9) || '[]' || chr(9) || role END AS value
FROM conversations WHERE role <> 'assistant'
""")
def malformed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Turns written as lines; only those of the assistant have three fields."""
    start = F.concat_ws("\t", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    line = (
        F.when(F.col("role") == "user", start)
        .when(F.col("role") == "assistant", F.concat(start, F.lit("\t[]")))
        .otherwise(F.concat(start, F.lit("\t[]\t"), "role"))
    )
    return GS.malformed_lines(table(spark, d, "conversations").select(line.alias("value")))

