"""Queries over counts, top lists, shares, histograms and densities."""

from __future__ import annotations

from pyspark.sql import functions as F

from revmill.functions import values as V
from revmill.operators import counts, histograms, limits
from revmill.plans.catalog_rows import SQL_TIER
from revmill.plans.registry import query


@query("q_reviews_per_entity", "SELECT entity_id, count(*) AS n FROM ratings GROUP BY entity_id", "ratings")
def reviews_per_entity(v):
    return counts.group_count(v.ratings(), "entity_id")


@query(
    "q_top_entities",
    "SELECT entity_id, count(*) AS n FROM ratings GROUP BY entity_id ORDER BY n DESC, entity_id LIMIT 5",
    "ratings",
)
def top_entities(v):
    return limits.top_k(counts.group_count(v.ratings(), "entity_id"), 5)


@query(
    "q_top_cities",
    "SELECT city, count(*) AS n FROM entities GROUP BY city ORDER BY n DESC, city LIMIT 10",
    "entities",
)
def top_cities(v):
    return limits.top_k(counts.value_counts(v.entities(), "city"), 10)


@query(
    "q_top_reviewers",
    "SELECT user_id, count(*) AS n FROM users GROUP BY user_id ORDER BY n DESC, user_id LIMIT 5",
    "users",
)
def top_reviewers(v):
    return limits.top_k(counts.value_counts(v.users(), "user_id"), 5)


SQL_ITEMS = "items AS (SELECT unnest(string_split_regex(categories, ',\\s*')) AS category FROM entities)"
SQL_CATEGORIES = f"WITH {SQL_ITEMS} SELECT category, count(*) AS n FROM items GROUP BY category"


@query("q_category_counts", SQL_CATEGORIES, "entities")
def category_counts(v):
    return counts.category_counts(v.entities(), "categories")


@query("q_top_categories", SQL_CATEGORIES + " ORDER BY n DESC, category LIMIT 10", "entities")
def top_categories(v):
    return limits.top_k(category_counts(v), 10)


@query(
    "q_category_share_top5",
    f"""WITH {SQL_ITEMS}, top5 AS (SELECT category, count(*) AS n FROM items GROUP BY category
         ORDER BY n DESC, category LIMIT 5)
SELECT category, n, round(n * 100.0 / (SELECT sum(n) FROM top5), 1)::DOUBLE AS share_pct FROM top5""",
    "entities",
)
def category_share_top5(v):
    return counts.with_share(limits.top_k(category_counts(v), 5))


@query(
    "q_tier_distribution",
    f"SELECT {SQL_TIER} AS label, count(*) AS n FROM entities GROUP BY 1 ORDER BY 1",
    "entities",
)
def tier_distribution(v):
    labelled = v.entities().select(V.tier_label(F.col("stars")).alias("label"))
    return counts.group_count(labelled, "label").orderBy("label")


@query(
    "q_class_balance",
    """SELECT count(*) FILTER (label = 1) AS positive_count, count(*) FILTER (label = 0) AS negative_count,
              count(*) AS total, round(greatest(count(*) FILTER (label = 1), count(*) FILTER (label = 0))::DOUBLE
                                       / count(*), 6) AS baseline_accuracy FROM scored""",
    "scored",
)
def class_balance(v):
    return counts.class_balance(v.scored()).withColumn("baseline_accuracy", F.round("baseline_accuracy", 6))


@query(
    "q_star_distribution",
    "SELECT stars, count(*) AS n FROM entities WHERE stars IS NOT NULL GROUP BY stars ORDER BY stars",
    "entities",
)
def star_distribution(v):
    return counts.value_counts(v.entities(), "stars").orderBy("stars")


@query(
    "q_star_share",
    """SELECT stars, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM entities), 1)::DOUBLE
              AS share_pct FROM entities GROUP BY stars""",
    "entities",
)
def star_share(v):
    return counts.with_share(counts.value_counts(v.entities(), "stars"))


def sql_histogram(source: str, column: str, bins: int, where: str = "") -> str:
    return f"""WITH x AS (SELECT ({column})::DOUBLE AS x FROM {source} {where}),
  r AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM x),
  b AS (SELECT CASE WHEN w > 0 THEN least(floor((x - lo) / w), {bins - 1}) ELSE 0 END::INTEGER AS bin,
               count(*) AS n FROM x, r GROUP BY 1)
SELECT g.bin::INTEGER AS bin, round(lo + g.bin * w, 6) AS bin_start, round(lo + (g.bin + 1) * w, 6) AS bin_end,
       coalesce(n, 0) AS n
FROM generate_series(0, {bins - 1}) g(bin) CROSS JOIN r LEFT JOIN b ON b.bin = g.bin"""


def _rounded(hist):
    return hist.withColumns({c: F.round(c, 6) for c in ("bin_start", "bin_end")})


@query("q_star_histogram", sql_histogram("entities", "stars", 9), "entities")
def star_histogram(v):
    return _rounded(histograms.histogram(v.entities(), "stars", 9))


@query(
    "q_review_count_histogram",
    sql_histogram("counted_entities", "review_count", 50, "WHERE review_count <= 500"),
    "counted_entities",
)
def review_count_histogram(v):
    return _rounded(histograms.histogram(v.counted_entities(), "review_count", 50, upper=500))


@query("q_length_histogram", sql_histogram("reviews", "length(text)", 30), "reviews")
def length_histogram(v):
    lengths = v.reviews().select(F.length("text").alias("chars"))
    return _rounded(histograms.histogram(lengths, "chars", 30))


@query(
    "q_star_kde",
    """WITH s AS (SELECT min(stars) AS lo, max(stars) AS hi, count(*) AS n,
                 stddev_samp(stars) * count(*)::DOUBLE ** -0.2::DOUBLE AS h FROM entities),
  c AS (SELECT stars AS v, count(*) AS k FROM entities GROUP BY stars),
  g AS (SELECT p::INTEGER AS point, lo + p * ((hi - lo) / 199) AS x, n, h
        FROM generate_series(0, 199) t(p) CROSS JOIN s)
SELECT point, round(any_value(x), 6) AS x,
       round(sum(k * exp(-0.5::DOUBLE * ((x - v) / h) ** 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6)
         AS density
FROM g CROSS JOIN c GROUP BY point""",
    "entities",
)
def star_kde(v):
    table = histograms.kde(v.entities(), "stars")
    return table.withColumns({c: F.round(c, 6) for c in ("x", "density")})
