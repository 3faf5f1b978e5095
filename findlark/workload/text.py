"""Full-text search: words, phrases, prefixes, scores, highlights."""

from __future__ import annotations

from pyspark.sql import functions as F

from findlark import IndexSpec, Registry, Settings
from findlark.operators import postings as P
from findlark.operators.highlight import highlight_fragments
from findlark.operators.textmatch import Clause, ScannedText, highlight_words, match_text
from findlark.plans.search import SearchIndex
from findlark.workload import common as C
from findlark.workload.textsql import WORDS, search_sql

QUERIES = C.Catalogue()
query = QUERIES.add

BODY = {"Body": "searchable"}
MAIN = {"SearchableText": "searchable", "Title": "title"}
SCORED = "SELECT uid, round(score, 4) AS score FROM hits"


def _scored(hits):
    return hits.select("uid", F.round("score", 4).alias("score"))


def _scanned(spark, sf_dir):
    return ScannedText(C.content(spark, sf_dir), partitions=C.spread(spark).scan_partitions)


def _main(words):
    return [("phrase", "SearchableText", words), ("prefix", "Title", words, 2.0), ("any", "SearchableText", words)]


# --- analysis ---


@query(
    f"""WITH words AS (
      SELECT doc_id, unnest(regexp_extract_all(lower(text), '{WORDS}')) AS term FROM documents)
    SELECT count(*) AS n_words, count(DISTINCT term) AS n_terms,
           count(DISTINCT (doc_id, term)) AS n_postings FROM words"""
)
def tokenize_stats(spark, sf_dir):
    postings = P.build_postings(C.content(spark, sf_dir), ["SearchableText"])
    per_term = postings.groupBy("term").agg(F.sum("tf").alias("words"), F.count("*").alias("docs"))
    return per_term.agg(
        F.sum("words").alias("n_words"), F.count("*").alias("n_terms"), F.sum("docs").alias("n_postings")
    )


@query(
    f"""WITH words AS (
      SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '{WORDS}')) AS term FROM documents)
    SELECT term, count(*) AS df FROM words GROUP BY term"""
)
def term_statistics(spark, sf_dir):
    postings = P.build_postings(C.content(spark, sf_dir), ["SearchableText"])
    return P.term_statistics(postings).select("term", "df")


# --- clauses ---


@query(search_sql(C.CONTENT_SQL, BODY, [("any", "Body", ["that", "with", "from"])], SCORED))
def match_any(spark, sf_dir):
    clause = Clause("any", "Body", ("that", "with", "from", "that"))
    return _scored(match_text(_scanned(spark, sf_dir), [clause]))


@query(search_sql(C.CONTENT_SQL, BODY, [("phrase", "Body", ["the", "of", "in"])], SCORED))
def phrase_slop2(spark, sf_dir):
    clause = Clause("phrase", "Body", ("the", "of", "in"))
    return _scored(match_text(_scanned(spark, sf_dir), [clause]))


@query(search_sql(C.CONTENT_SQL, BODY, [("phrase", "Body", ["the", "of", "the"])], "SELECT uid FROM hits"))
def phrase_repeated_word(spark, sf_dir):
    clause = Clause("phrase", "Body", ("the", "of", "the"))
    return match_text(_scanned(spark, sf_dir), [clause]).select("uid")


@query(
    search_sql(
        C.CONTENT_SQL, {"Title": "title"}, [("phrase", "Title", ["the", "o"]), ("prefix", "Title", ["the", "o"], 2.0)], SCORED
    )
)
def title_phrase_prefix(spark, sf_dir):
    return _scored(C.content_index(spark, sf_dir).search({"Title": "the o"}).hits)


@query(search_sql(C.CONTENT_SQL, BODY, [("phrase", "Body", ["und", "der"]), ("any", "Body", ["und", "der"])], SCORED))
def other_field(spark, sf_dir):
    return _scored(C.content_index(spark, sf_dir).search({"Body": {"query": "Und der"}}).hits)


@query(
    search_sql(
        C.CONTENT_SQL,
        MAIN,
        _main(["that", "with", "from"]),
        "SELECT uid, portal_type, round(score, 4) AS score FROM hits JOIN content USING (uid) WHERE lang = 'en'",
    )
)
def searchable_pooled(spark, sf_dir):
    found = C.content_index(spark, sf_dir).search({"SearchableText": "that with from", "Language": "en"})
    return found.hits.select("uid", "portal_type", F.round("score", 4).alias("score"))


@query(
    search_sql(
        C.CONTENT_SQL,
        {"Title": "title", "Body": "searchable"},
        [
            ("phrase", "Title", ["de", "la"]),
            ("prefix", "Title", ["de", "la"], 2.0),
            ("phrase", "Body", ["und", "der"]),
            ("any", "Body", ["und", "der"]),
        ],
        SCORED,
    )
)
def two_field_or(spark, sf_dir):
    return _scored(C.content_index(spark, sf_dir).search({"Title": "de la", "Body": "und der"}).hits)


@query(
    search_sql(
        C.CONTENT_SQL,
        MAIN,
        _main(["that", "with", "from"]),
        "SELECT uid, portal_type, round(score, 4) AS score FROM hits JOIN content USING (uid) "
        "WHERE lang = 'en' ORDER BY hits.score DESC, uid LIMIT 20",
    )
)
def bm25_top20(spark, sf_dir):
    found = C.content_index(spark, sf_dir).search({"SearchableText": "that with from", "Language": "en"})
    return found.page(0, 20).select("uid", "portal_type", F.round("score", 4).alias("score"))


@query(search_sql(C.CONTENT_SQL, MAIN, _main(["que", "les"]), SCORED))
def star_strip(spark, sf_dir):
    return _scored(C.content_index(spark, sf_dir).search({"SearchableText": "**Que les*"}).hits)


@query(search_sql(C.CONTENT_SQL, MAIN, _main(["für", "nicht"]), SCORED))
def search_only_field(spark, sf_dir):
    registry = C.CONTENT.without("SearchableText", "Title")
    found = SearchIndex(C.content(spark, sf_dir), registry, C.spread(spark)).search({"SearchableText": "für nicht"})
    return _scored(found.hits)


_PARTS = "content AS (SELECT CAST(p_partkey AS VARCHAR) AS uid, p_name AS searchable, p_brand FROM part)"


@query(
    search_sql(
        _PARTS,
        {"SearchableText": "searchable"},
        [("phrase", "SearchableText", ["red", "widget"]), ("any", "SearchableText", ["red", "widget"])],
        "SELECT uid, p_brand, round(score, 4) AS score FROM hits JOIN content USING (uid) WHERE p_brand <> 'Brand#4'",
    )
)
def short_names(spark, sf_dir):
    parts = C.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("uid"), F.col("p_name").alias("SearchableText"),
        "p_brand",
    )
    registry = Registry([IndexSpec("SearchableText", "text"), IndexSpec("p_brand", "field", analyzed=False)])
    found = SearchIndex(parts, registry).search({"SearchableText": "red widget", "p_brand": {"not": "Brand#4"}})
    return found.hits.select("uid", "p_brand", F.round("score", 4).alias("score"))


# --- through the stored index ---


@query(
    f"""WITH {C.CONTENT_SQL}, words AS (
      SELECT uid, 's' AS field, unnest(regexp_extract_all(lower(searchable), '{WORDS}')) AS term FROM content
      UNION ALL SELECT uid, 't', unnest(regexp_extract_all(lower(title), '{WORDS}')) FROM content)
    SELECT (SELECT count(*) FROM content) AS n_docs, count(DISTINCT (uid, field, term)) AS n_postings,
           count(DISTINCT (field, term)) AS n_terms, count(*) AS n_words FROM words"""
)
def index_build(spark, sf_dir):
    """All tables of a stored index, built from the documents."""
    store = C.new_store(spark, C.STORED)
    store.rebuild(C.content(spark, sf_dir))
    text = store.index().text
    docs = text.docs.agg(F.count("*").alias("n")).scalar()
    words = text.field_stats.agg(F.sum("words").alias("n")).scalar()
    terms = text.term_stats.groupBy("field", "term").agg(F.sum("df").alias("df"))
    return terms.agg(F.sum("df").alias("n_postings"), F.count("*").alias("n_terms")).select(
        docs.alias("n_docs"), "n_postings", "n_terms", words.alias("n_words")
    )


@query(
    search_sql(
        C.CONTENT_SQL,
        MAIN,
        _main(["that", "with", "from"]),
        "SELECT uid, portal_type, round(score, 4) AS score FROM hits JOIN content USING (uid) WHERE lang = 'en'",
    )
)
def stored_searchable(spark, sf_dir):
    index = C.content_store(spark, sf_dir).index()
    found = index.search({"SearchableText": "that with from", "Language": "en"})
    return found.hits.select("uid", "portal_type", F.round("score", 4).alias("score"))


@query(search_sql(C.CONTENT_SQL, {"Title": "title"}, [("phrase", "Title", ["the", "o"]), ("prefix", "Title", ["the", "o"], 2.0)], SCORED))
def stored_title_prefix(spark, sf_dir):
    return _scored(C.content_store(spark, sf_dir).index().search({"Title": "the o"}).hits)


# --- highlighting ---

_FRAGMENTS = r"""runs AS (
  SELECT uid, generate_subscripts(f, 1) - 1 AS ord, trim(unnest(f), E' \t\n\f\r\x0b') AS run
  FROM (SELECT uid, regexp_extract_all(searchable, '(?s)\S.{0,99}(?:\s|\z)|\S+') AS f  FROM content)),
parts AS (
  SELECT uid, ord, regexp_extract_all(run, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS p FROM runs),
marked AS (
  SELECT uid, ord, len(list_filter(p, lambda x: lower(x) IN ('that', 'with'))) AS matches,
         array_to_string(list_transform(p, lambda x: CASE WHEN lower(x) IN ('that', 'with')
                         THEN '<em>' || x || '</em>' ELSE x END), '') AS fragment FROM parts),
best AS (
  SELECT *, row_number() OVER (PARTITION BY uid ORDER BY matches DESC, ord) AS place
  FROM marked WHERE matches > 0)"""


@query(f"WITH {C.CONTENT_SQL},\n{_FRAGMENTS} SELECT uid, ord, matches, fragment FROM best WHERE place <= 5")
def highlight_best_fragments(spark, sf_dir):
    clauses = [Clause("any", "SearchableText", ("that", "with"))]
    rows = C.content(spark, sf_dir)
    found = highlight_fragments(F.col("SearchableText"), highlight_words(clauses), "<em>", "</em>")
    best = rows.select("uid", F.inline(found).alias("ord", "matches", "fragment"))
    return best.withColumns({name: F.col(name).cast("long") for name in ("ord", "matches")})


@query(
    search_sql(
        C.CONTENT_SQL,
        MAIN,
        _main(["that", "with"]),
        """SELECT h.uid, coalesce(d.description, 'none') AS description FROM hits h
        JOIN content c ON c.uid = h.uid LEFT JOIN described d ON d.uid = h.uid WHERE lang = 'en'""",
        tail=f""",
{_FRAGMENTS},
running AS (
  SELECT *, sum(length(fragment)) OVER (PARTITION BY uid ORDER BY place) AS total FROM best WHERE place <= 5),
described AS (
  SELECT uid, string_agg(fragment, ' ... ' ORDER BY place) AS description
  FROM running WHERE place = 1 OR total <= 250 GROUP BY uid)""",
    )
)
def highlight_threshold(spark, sf_dir):
    settings = Settings(
        highlight=True, highlight_threshold=250, highlight_pre_tags="<em>\n<b>", highlight_post_tags="</em>\n</b>"
    )
    rows = C.content(spark, sf_dir).withColumn("Description", F.lit("none"))
    found = SearchIndex(rows, C.CONTENT, C.spread(spark, settings)).search({"SearchableText": "that with", "Language": "en"})
    return found.hits.select("uid", F.col("Description").alias("description"))
