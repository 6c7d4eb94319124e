"""Queries over text and value functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from revmill.config import ReviewConfig
from revmill.functions import ratings as R
from revmill.functions import text as X
from revmill.functions import values as V
from revmill.operators import cleaning
from revmill.operators import features as FE
from revmill.plans.registry import query
from revmill.plans.views import Views
from revmill.session import cut_lineage

# The cleaning rule in SQL, step by step.
SQL_NORMAL = """trim(regexp_replace(lower(regexp_replace(regexp_replace(text,
    'https?://\\S+|www\\.\\S+', ' ', 'gi'), '\\S+@\\S+\\.\\S+', ' ', 'g')), '[^a-z0-9ı'']+', ' ', 'g'))"""


# The bound that q_clean_text shows; all other queries clean whole texts.
BOUNDED = ReviewConfig(max_chars=8000)


def sql_bound(column: str, lo: int = 15, hi: int | None = None) -> str:
    if hi is None:
        return f"CASE WHEN length({column}) < {lo} THEN NULL ELSE {column} END"
    return (
        f"CASE WHEN length({column}) < {lo} THEN NULL WHEN length({column}) > {hi} "
        f"THEN regexp_replace(substr({column}, 1, {hi}), ' [^ ]*$', '') ELSE {column} END"
    )


SQL_CLEAN = f"""cleaned AS (
  SELECT review_id, entity_id, {sql_bound('t')} AS text
  FROM (SELECT review_id, entity_id, {SQL_NORMAL} AS t FROM reviews))"""
SQL_CLEAN_BOUNDED = SQL_CLEAN.replace(sql_bound("t"), sql_bound("t", hi=8000))

SQL_WORDS = f"""{SQL_CLEAN},
  words AS (SELECT review_id, string_split(text, ' ') AS words FROM cleaned WHERE text IS NOT NULL)"""


def clean_reviews(v: Views):
    return cleaning.clean_text(v.review_texts(), "text", "text")


def review_words(v: Views):
    kept = clean_reviews(v).filter(F.col("text").isNotNull())
    return kept.select("review_id", X.tokens(F.col("text")).alias("words"))


@query("q_clean_text", f"WITH {SQL_CLEAN_BOUNDED} SELECT review_id, text FROM cleaned", "reviews")
def clean_text(v):
    return cleaning.clean_text(v.review_texts(), "text", "text", BOUNDED).select("review_id", "text")


@query("q_nfkc")
def nfkc(v):
    return v.reviews().select("review_id", X.nfkc(F.col("text")).alias("text"))


@query(
    "q_strip_urls",
    r"""SELECT page_id, regexp_replace(concat('see ', url, ' or WWW.', substr(url, 9), ' now'),
             'https?://\S+|www\.\S+', ' ', 'gi') AS url_text,
           regexp_replace(regexp_replace(html, '\s', ' ', 'g'), 'https?://\S+|www\.\S+', ' ', 'gi') AS html_text
        FROM pages""",
)
def strip_urls(v):
    line = F.concat(F.lit("see "), "url", F.lit(" or WWW."), F.expr("substr(url, 9)"), F.lit(" now"))
    html = X.strip_urls(X.flatten_space(F.col("html")))
    return v.table("pages").select("page_id", X.strip_urls(line).alias("url_text"), html.alias("html_text"))


@query(
    "q_strip_emails",
    r"""SELECT doc_id, regexp_replace(regexp_replace(text, '\s', ' ', 'g'), '\S+@\S+\.\S+', ' ', 'g') AS text
        FROM documents""",
)
def strip_emails(v):
    flat = X.flatten_space(F.col("text"))
    return v.table("documents").select("doc_id", X.strip_emails(flat).alias("text"))


@query(
    "q_strip_symbols",
    r"""SELECT doc_id, regexp_replace(regexp_replace(text, '\s', ' ', 'g'),
               '[^a-zA-Z0-9İıſK'' ]+', ' ', 'g') AS text FROM documents""",
)
def strip_symbols(v):
    flat = X.flatten_space(F.col("text"))
    return v.table("documents").select("doc_id", X.strip_symbols(flat).alias("text"))


@query("q_squeeze", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents")
def squeeze(v):
    return v.table("documents").select("doc_id", X.squeeze(F.col("text")).alias("text"))


@query(
    "q_bound_text",
    f"""SELECT doc_id, {sql_bound('t', 200, 1500)} AS text
        FROM (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)""",
)
def bound_text(v):
    flat = v.table("documents").select("doc_id", X.squeeze(F.col("text")).alias("text"))
    return flat.select("doc_id", X.bound_text(F.col("text"), 200, 1500).alias("text"))


@query(
    "q_truncate_suffix",
    """SELECT doc_id, CASE WHEN length(text) > 5000 THEN concat(substr(text, 1, 5000), '... [truncated]')
              ELSE text END AS text FROM documents""",
)
def truncate_suffix(v):
    return v.table("documents").select("doc_id", X.truncate_suffix(F.col("text")).alias("text"))


SQL_NORMAL_CATEGORIES = """nullif(array_to_string(list_transform(list_filter(
    list_transform(parts, lambda p, i: {'p': p, 'i': i}),
    lambda q: q.p <> '' AND list_position(parts, q.p) = q.i), lambda q: q.p), ', '), '')"""


@query(
    "q_normalize_categories",
    f"""SELECT p_partkey, {SQL_NORMAL_CATEGORIES} AS categories
        FROM (SELECT p_partkey, list_transform(string_split(
                concat(p_type, ' ,', p_name, ',,', replace(p_name, ' ', ',  '), ', ', lower(p_type), ' , '), ','),
                lambda p: lower(trim(p))) AS parts FROM part)""",
)
def normalise_categories(v):
    messy = F.concat(
        "p_type", F.lit(" ,"), "p_name", F.lit(",,"), F.replace("p_name", F.lit(" "), F.lit(",  ")),
        F.lit(", "), F.lower("p_type"), F.lit(" , "),
    )
    return v.table("part").select("p_partkey", X.normalise_categories(messy).alias("categories"))


@query(
    "q_category_array",
    """SELECT entity_id, len(items)::INTEGER AS n_items, items[1] AS first_item,
              array_to_string(items, '|') AS items
       FROM (SELECT entity_id, string_split(categories, ', ') AS items FROM entities)""",
    "entities",
)
def category_array(v):
    items = v.entities().select("entity_id", X.category_array(F.col("categories")).alias("items"))
    return items.select(
        "entity_id",
        F.size("items").alias("n_items"),
        F.col("items")[0].alias("first_item"),
        F.array_join("items", "|").alias("items"),
    )


@query(
    "q_parse_json",
    """SELECT event_type, count(*) AS n, sum(k)::BIGINT AS sum_k, min(k) AS min_k, max(k) AS max_k
       FROM (SELECT event_type, (props->>'$.k')::BIGINT AS k FROM events) GROUP BY event_type""",
)
def parse_json(v):
    k = X.parse_json(F.col("props"), "k bigint")["k"]
    return v.table("events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(k).alias("sum_k"), F.min(k).alias("min_k"), F.max(k).alias("max_k")
    )


@query(
    "q_formats",
    """SELECT o_orderkey, format('{:,}', floor(o_totalprice)::BIGINT) AS thousands,
              printf('%.4f', o_totalprice) AS plain, printf('%+.4f', 100000 - o_totalprice) AS signed,
              concat(printf('%.2f', o_totalprice / 1000000 * 100), '%') AS percent FROM orders""",
)
def formats(v):
    price = F.col("o_totalprice")
    return v.table("orders").select(
        "o_orderkey",
        R.fmt_thousands(F.floor(price)).alias("thousands"),
        R.fmt_number(price).alias("plain"),
        R.fmt_signed(100000 - price).alias("signed"),
        R.fmt_percent(price / 1000000).alias("percent"),
    )


@query(
    "q_rating_band",
    """SELECT doc_id, score, CASE WHEN score >= 0.95 THEN 'excellent' WHEN score >= 0.90 THEN 'very good'
              WHEN score >= 0.80 THEN 'good' WHEN score >= 0.70 THEN 'fair' ELSE 'poor' END AS band
       FROM scored""",
    "scored",
)
def rating_band(v):
    return v.scored().select("doc_id", "score", R.rating_band(F.col("score")).alias("band"))


# Gaps between two rates of each review fact stand for train-minus-test gaps.
SQL_GAPS = """gaps AS (SELECT l_returnflag, round(2 * l_discount - l_tax, 4) AS auc_diff,
              round(l_quantity / 200 - l_tax, 4) AS acc_diff FROM lineitem)"""


def gaps(v: Views):
    return v.table("lineitem").select(
        "l_returnflag",
        F.round(2 * F.col("l_discount") - F.col("l_tax"), 4).alias("auc_diff"),
        F.round(F.col("l_quantity") / 200 - F.col("l_tax"), 4).alias("acc_diff"),
    )


def _by_status(v: Views, rule):
    status = rule(F.col("auc_diff"), F.col("acc_diff")).alias("status")
    return gaps(v).groupBy("l_returnflag", status).agg(
        F.count("*").alias("n"), F.round(F.max("auc_diff"), 4).alias("max_auc_diff")
    )


@query(
    "q_overfit_a",
    f"""WITH {SQL_GAPS} SELECT l_returnflag,
          CASE WHEN abs(auc_diff) > 0.15::DOUBLE OR abs(acc_diff) > 0.15::DOUBLE THEN 'warning'
               WHEN abs(auc_diff) > 0.08::DOUBLE OR abs(acc_diff) > 0.08::DOUBLE THEN 'monitor'
               ELSE 'good' END AS status,
          count(*) AS n, round(max(auc_diff), 4) AS max_auc_diff FROM gaps GROUP BY ALL""",
)
def overfit_a(v):
    return _by_status(v, R.overfit_status_a)


@query(
    "q_overfit_b",
    f"""WITH {SQL_GAPS} SELECT l_returnflag,
          CASE WHEN abs(auc_diff) < 0.05::DOUBLE AND abs(acc_diff) < 0.05::DOUBLE THEN 'minimal'
               WHEN abs(auc_diff) < 0.1::DOUBLE AND abs(acc_diff) < 0.1::DOUBLE THEN 'good'
               WHEN abs(auc_diff) < 0.15::DOUBLE OR abs(acc_diff) < 0.15::DOUBLE THEN 'moderate'
               ELSE 'high' END AS status,
          count(*) AS n, round(max(auc_diff), 4) AS max_auc_diff FROM gaps GROUP BY ALL""",
)
def overfit_b(v):
    return _by_status(v, R.overfit_status_b)


@query(
    "q_gap_flag",
    f"""WITH {SQL_GAPS} SELECT l_returnflag, CASE WHEN abs(acc_diff) < 0.1::DOUBLE THEN 'ok' ELSE 'warning' END
          AS flag, count(*) AS n FROM gaps GROUP BY ALL""",
)
def gap_flag(v):
    flag = R.gap_flag(F.col("acc_diff")).alias("flag")
    return gaps(v).groupBy("l_returnflag", flag).agg(F.count("*").alias("n"))


@query(
    "q_tokens",
    f"""WITH {SQL_WORDS} SELECT review_id, len(words)::INTEGER AS n_words, array_to_string(words, '|') AS words
        FROM words""",
    "reviews",
)
def tokens(v):
    return review_words(v).select(
        "review_id", F.size("words").alias("n_words"), F.array_join("words", "|").alias("words")
    )


_SQL_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in FE.STOP_WORDS)
SQL_KEPT = f"""{SQL_WORDS},
  kept AS (SELECT review_id, list_filter(words, lambda w: NOT list_contains([{_SQL_STOP}], w)) AS words FROM words)"""


def kept_words(v: Views):
    return review_words(v).withColumn("words", X.without(F.col("words"), FE.STOP_WORDS))


@query(
    "q_stopwords",
    f"""WITH {SQL_KEPT} SELECT review_id, len(words)::INTEGER AS n_words, array_to_string(words, '|') AS words
        FROM kept""",
    "reviews",
)
def stopwords(v):
    return kept_words(v).select(
        "review_id", F.size("words").alias("n_words"), F.array_join("words", "|").alias("words")
    )


@query(
    "q_bigrams",
    f"""WITH {SQL_KEPT} SELECT review_id, greatest(len(words) - 1, 0)::INTEGER AS n_bigrams,
          coalesce(array_to_string(list_transform(list_zip(words[1:len(words)-1], words[2:len(words)]),
                                   lambda p: concat(p[1], ' ', p[2])), '|'), '') AS bigrams
        FROM kept""",
    "reviews",
)
def bigrams(v):
    pairs = kept_words(v).select("review_id", X.bigrams(F.col("words")).alias("bigrams"))
    return pairs.select(
        "review_id", F.size("bigrams").alias("n_bigrams"), F.array_join("bigrams", "|").alias("bigrams")
    )


@query(
    "q_tfidf",
    f"""WITH {SQL_KEPT},
  tf AS (SELECT review_id, term, count(*) AS tf
         FROM (SELECT review_id, unnest(words) AS term FROM kept) GROUP BY ALL),
  dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT review_id, term, tf, df, round(tf * CASE WHEN df >= 2
         THEN ln(((SELECT count(*) FROM kept) + 1)::DOUBLE / (df + 1)) ELSE 0.0 END, 6) AS tfidf
FROM tf JOIN dfs USING (term)""",
    "reviews",
)
def tfidf(v):
    table = FE.tfidf(cut_lineage(kept_words(v)), "review_id", "words", min_df=2)
    return table.withColumn("tfidf", F.round("tfidf", 6))


@query(
    "q_category_vocab",
    """SELECT term, count(*) AS total FROM (SELECT unnest(string_split(categories, ', ')) AS term FROM entities)
       GROUP BY term ORDER BY total DESC, term LIMIT 150""",
    "entities",
)
def category_vocab(v):
    items = v.entities().select(X.category_array(F.col("categories")).alias("items"))
    return FE.category_vocab(items, "items")
