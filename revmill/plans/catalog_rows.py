"""Queries over row filters, coercions, joins, dedupe and limits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmill.config import ReviewConfig
from revmill.functions import values as V
from revmill.operators import cleaning, counts, dedupe, joins, limits, rows, sampling
from revmill.plans.catalog_text import SQL_CLEAN, clean_reviews
from revmill.plans.registry import query
from revmill.plans.views import Views

CFG = ReviewConfig()


# --- scans and projections -------------------------------------------------------------------------------


@query("q_head_sample", "SELECT * FROM reviews ORDER BY review_id LIMIT 300", "reviews")
def head_sample(v):
    return limits.head_sample(v.reviews(), 300, ["review_id"])


@query("q_column_scan", "SELECT city FROM entities", "entities")
def column_scan(v):
    return limits.column_scan(v.entities(), "city")


@query("q_project", "SELECT entity_id, name, stars, city FROM entities", "entities")
def project(v):
    return rows.select_existing(v.entities(), ["entity_id", "name", "stars", "city", "postal_code"])


@query(
    "q_top_rated",
    """SELECT entity_id, name, stars, review_count, city FROM counted_entities
       WHERE stars > 4 AND review_count > 25""",
    "counted_entities",
)
def top_rated(v):
    kept = rows.filter_entities(v.counted_entities(), 4.0, 25)
    return kept.select("entity_id", "name", "stars", "review_count", "city")


# --- null handling and coercion; the given tables hold no null, so nulls and dirty values are derived ------

SQL_HOLES = """holes AS (
  SELECT p_partkey AS entity_id, CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS kind,
         CASE WHEN p_size % 10 = 3 THEN NULL ELSE p_size END AS size,
         CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN '  '
              ELSE p_name END AS name FROM part)"""


def holes(v: Views) -> DataFrame:
    key = F.col("p_partkey")
    return v.table("part").select(
        key.alias("entity_id"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("kind"),
        F.when(F.col("p_size") % 10 != 3, F.col("p_size")).alias("size"),
        F.when(key % 7 == 0, None)
        .when(key % 11 == 0, "")
        .when(key % 13 == 0, "  ")
        .otherwise(F.col("p_name"))
        .alias("name"),
    )


@query(
    "q_drop_null",
    f"""WITH {SQL_HOLES} SELECT * FROM holes
        WHERE entity_id IS NOT NULL AND kind IS NOT NULL AND size IS NOT NULL AND name IS NOT NULL""",
)
def drop_null(v):
    return rows.drop_any_null(holes(v))


@query("q_non_blank", f"WITH {SQL_HOLES} SELECT entity_id, name FROM holes WHERE length(trim(name)) > 0")
def non_blank(v):
    return holes(v).filter(V.non_blank(F.col("name"))).select("entity_id", "name")


@query("q_min_len", "SELECT entity_id, name FROM entities WHERE length(trim(name)) >= 10", "entities")
def min_len(v):
    return v.entities().filter(V.min_len(F.col("name"), 10)).select("entity_id", "name")


@query("q_require_key", f"WITH {SQL_HOLES} SELECT entity_id, name FROM holes WHERE coalesce(name, '') <> ''")
def require_key(v):
    return rows.require_key(holes(v), "name").select("entity_id", "name")


SQL_DIRTY = """dirty AS (
  SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'n/a' WHEN event_id % 17 = 0 THEN NULL
                        ELSE value::VARCHAR END AS stars,
         CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN 'many'
              ELSE user_id::VARCHAR END AS useful FROM events)"""


def dirty(v: Views) -> DataFrame:
    key = F.col("event_id")
    stars = F.when(key % 11 == 0, "n/a").when(key % 17 == 0, None).otherwise(F.col("value").cast("string"))
    useful = F.when(key % 19 == 0, None).when(key % 23 == 0, "many").otherwise(F.col("user_id").cast("string"))
    return v.table("events").select(key, stars.alias("stars"), useful.alias("useful"))


COERCE = {"stars": ("double", 0.0), "useful": ("int", 0)}


@query(
    "q_valid_range",
    f"""WITH {SQL_DIRTY} SELECT event_id, try_cast(stars AS DOUBLE) AS stars FROM dirty
        WHERE try_cast(stars AS DOUBLE) BETWEEN 1.0 AND 5.0""",
)
def valid_range(v):
    ok = V.valid_range(F.col("stars"), 1.0, 5.0)
    return dirty(v).filter(ok).select("event_id", F.col("stars").try_cast("double").alias("stars"))


@query(
    "q_coerce_defaults",
    f"""WITH {SQL_DIRTY} SELECT event_id, coalesce(try_cast(stars AS DOUBLE), 0.0::DOUBLE) AS stars,
          coalesce(try_cast(useful AS INTEGER), 0) AS useful FROM dirty""",
)
def coerce_defaults(v):
    return rows.coerce_defaults(dirty(v), COERCE)


@query(
    "q_soft_int",
    f"WITH {SQL_DIRTY} SELECT event_id, useful AS raw, try_cast(useful AS INTEGER) AS useful FROM dirty",
)
def soft_int(v):
    return dirty(v).select("event_id", F.col("useful").alias("raw"), V.soft_int(F.col("useful")).alias("useful"))


@query(
    "q_coerce_reject",
    f"""WITH {SQL_DIRTY},
  tested AS (SELECT *, (stars IS NOT NULL AND try_cast(stars AS DOUBLE) IS NULL)
                    OR (useful IS NOT NULL AND try_cast(useful AS INTEGER) IS NULL) AS bad FROM dirty)
SELECT event_id, CASE WHEN bad THEN NULL ELSE coalesce(try_cast(stars AS DOUBLE), 0.0::DOUBLE) END AS stars,
       CASE WHEN bad THEN NULL ELSE coalesce(try_cast(useful AS INTEGER), 0) END AS useful, bad AS rejected
FROM tested""",
)
def coerce_reject(v):
    good, bad = rows.coerce_or_reject(dirty(v), COERCE)
    lost = bad.select(
        "event_id",
        F.lit(None).cast("double").alias("stars"),
        F.lit(None).cast("int").alias("useful"),
        F.lit(True).alias("rejected"),
    )
    return good.withColumn("rejected", F.lit(False)).unionByName(lost)


@query(
    "q_binary_label",
    "SELECT entity_id, stars, CASE WHEN stars >= 4.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM entities",
    "entities",
)
def binary_label(v):
    return v.entities().select("entity_id", "stars", V.binary_label(F.col("stars")).alias("label"))


SQL_TIER = """CASE WHEN stars >= 4.0 THEN 0.0::DOUBLE WHEN stars >= 3.0 THEN 1.0::DOUBLE
              ELSE 2.0::DOUBLE END"""


@query("q_tier_label", f"SELECT entity_id, stars, {SQL_TIER} AS label FROM entities", "entities")
def tier_label(v):
    return v.entities().select("entity_id", "stars", V.tier_label(F.col("stars")).alias("label"))


# --- joins -----------------------------------------------------------------------------------------------


@query(
    "q_label_join",
    """SELECT order_id, line_id, entity_id, user_id, price,
              CASE WHEN stars >= 4.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, categories
       FROM ratings JOIN entities USING (entity_id) WHERE length(trim(categories)) > 0""",
    "ratings entities",
)
def label_join(v):
    joined = joins.label_reviews(v.ratings(), joins.entity_labels(v.entities(), "entity_id"), "entity_id")
    return joined.drop("quantity")


@query(
    "q_orphan_reviews",
    """SELECT * FROM ratings r WHERE NOT EXISTS (
         SELECT 1 FROM entities e WHERE e.is_open = 1 AND e.entity_id = r.entity_id)""",
    "ratings entities",
)
def orphan_reviews(v):
    return joins.orphan_reviews(v.ratings(), v.entities().filter("is_open = 1"), "entity_id")


SQL_TRAINING = """training AS (
  SELECT DISTINCT entity_id, trim(text, ' ') AS text,
         CASE WHEN stars >= 4.0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, categories
  FROM cleaned JOIN entities USING (entity_id)
  WHERE length(trim(text, ' ')) >= 10 AND length(trim(categories)) > 0)"""


def training_set(v: Views) -> DataFrame:
    return joins.training_reviews(clean_reviews(v), v.entities(), "entity_id")


@query(
    "q_training_set",
    f"""WITH {SQL_CLEAN}, {SQL_TRAINING}
SELECT entity_id, text, label, array_to_string(string_split(categories, ', '), '|') AS categories FROM training""",
    "reviews entities",
)
def training_rows(v):
    return training_set(v).select(
        "entity_id", "text", "label", F.array_join("cat_array", "|").alias("categories")
    )


# --- counts and cleaning totals --------------------------------------------------------------------------

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@query(
    "q_table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES),
)
def table_counts(v):
    return reduce(DataFrame.unionByName, [counts.table_count(v.table(t), t) for t in TABLES])


@query(
    "q_cleaning_counts",
    f"""WITH {SQL_HOLES}
SELECT 'entities' AS table_name, (SELECT count(*) FROM holes) AS rows_before,
       (SELECT count(DISTINCT entity_id) FROM holes
        WHERE kind IS NOT NULL AND size IS NOT NULL AND name IS NOT NULL) AS rows_after
UNION ALL
SELECT 'ratings', (SELECT count(*) FROM ratings),
       (SELECT count(*) FROM (SELECT DISTINCT order_id, line_id FROM ratings))""",
    "ratings",
)
def cleaning_counts(v):
    raw, ratings = holes(v), v.ratings()
    clean = rows.drop_any_null(raw).dropDuplicates(["entity_id"])
    clean_ratings = rows.drop_any_null(ratings).dropDuplicates(["order_id", "line_id"])
    return counts.cleaning_counts("entities", raw, clean).unionByName(
        counts.cleaning_counts("ratings", ratings, clean_ratings)
    )


# --- dedupe and limits -----------------------------------------------------------------------------------

RATING_ORDER = ["entity_id", "user_id", "quantity", "price"]


@query(
    "q_keep_first",
    """SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY order_id, line_id
         ORDER BY entity_id, user_id, quantity, price) AS rn FROM ratings) WHERE rn = 1""",
    "ratings",
)
def keep_first(v):
    return dedupe.keep_first(v.ratings(), ["order_id", "line_id"], RATING_ORDER)


@query("q_distinct_pairs", "SELECT DISTINCT entity_id, user_id FROM ratings", "ratings")
def distinct_pairs(v):
    return v.ratings().select("entity_id", "user_id").dropDuplicates(["entity_id", "user_id"])


SQL_UNIQUE = f"""{SQL_CLEAN},
  ranked AS (SELECT *, row_number() OVER (PARTITION BY entity_id, text ORDER BY review_id) AS rn
             FROM cleaned WHERE text IS NOT NULL),
  unique_reviews AS (SELECT review_id, entity_id, text FROM ranked WHERE rn = 1)"""


@query("q_dedupe_reviews", f"WITH {SQL_UNIQUE} SELECT * FROM unique_reviews", "reviews")
def dedupe_reviews(v):
    return cleaning.dedupe_reviews(v.review_texts(), "entity_id", "text", ["review_id"])


@query(
    "q_fast_sample",
    """WITH scanned AS (SELECT * FROM reviews ORDER BY review_id LIMIT 600),
  """
    + SQL_UNIQUE.replace("FROM reviews", "FROM scanned")
    + " SELECT * FROM unique_reviews ORDER BY review_id LIMIT 400",
    "reviews",
)
def fast_sample(v):
    return limits.fast_sample(v.reviews(), "entity_id", "text", ["review_id"], max_rows=400, raw_cap=600)


@query(
    "q_random_k",
    """SELECT doc_id, label, score FROM scored ORDER BY md5(concat(doc_id::VARCHAR, '#42')), doc_id LIMIT 150""",
    "scored",
)
def random_k(v):
    return limits.random_k(v.scored().select("doc_id", "label", "score"), "doc_id", 150)


SQL_KEYED = "row_number() OVER (PARTITION BY o_custkey ORDER BY src DESC, o_orderdate DESC, o_orderkey DESC)"


@query(
    "q_upsert",
    f"""SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (
         SELECT *, {SQL_KEYED} AS rn FROM (
           SELECT *, 0 AS src FROM orders WHERE o_orderstatus = 'F'
           UNION ALL SELECT *, 1 AS src FROM orders WHERE o_orderstatus <> 'F')) WHERE rn = 1""",
)
def upsert(v):
    orders = v.table("orders")
    old, new = orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'")
    merged = dedupe.upsert(old, new, "o_custkey", ["o_orderdate", "o_orderkey"])
    return merged.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


# --- quality counters and prepared tables ----------------------------------------------------------------

# Raw entities: repeated ids, empty ids, stars off the scale and empty category lists, in supply order.
SQL_RAW_ENTITIES = """raw_entities AS (
  SELECT l_orderkey AS seq1, l_linenumber AS seq2, l_partkey AS seq3, l_suppkey AS seq4, l_extendedprice AS seq5,
         CASE WHEN l_suppkey % 31 = 0 THEN '' WHEN l_suppkey % 37 = 0 THEN NULL
              ELSE l_partkey::VARCHAR END AS entity_id,
         CASE WHEN l_quantity > 48 THEN NULL ELSE l_quantity / 8 END AS stars,
         CASE WHEN l_linenumber = 7 THEN ' , ,' ELSE concat(l_returnflag, ',', l_linestatus, ', ', l_returnflag)
         END AS categories
  FROM lineitem)"""
ENTITY_ORDER = ["seq1", "seq2", "seq3", "seq4", "seq5"]


def raw_entities(v: Views) -> DataFrame:
    supplier = F.col("l_suppkey")
    return v.table("lineitem").select(
        F.col("l_orderkey").alias("seq1"),
        F.col("l_linenumber").alias("seq2"),
        F.col("l_partkey").alias("seq3"),
        supplier.alias("seq4"),
        F.col("l_extendedprice").alias("seq5"),
        F.when(supplier % 31 == 0, "")
        .when(supplier % 37 == 0, None)
        .otherwise(F.col("l_partkey").cast("string"))
        .alias("entity_id"),
        F.when(F.col("l_quantity") <= 48, F.col("l_quantity") / 8).alias("stars"),
        F.when(F.col("l_linenumber") == 7, " , ,")
        .otherwise(F.concat_ws("", "l_returnflag", F.lit(","), "l_linestatus", F.lit(", "), "l_returnflag"))
        .alias("categories"),
    )


SQL_VALID = f"""{SQL_RAW_ENTITIES},
  judged AS (SELECT *, coalesce(entity_id, '') <> '' AND coalesce(stars BETWEEN 1.0 AND 5.0, false)
                       AND regexp_matches(categories, '[^ ,]') AS ok,
                    row(seq1, seq2, seq3, seq4, seq5) AS place FROM raw_entities),
  firsts AS (SELECT entity_id, min(place) AS first_place FROM judged WHERE ok GROUP BY entity_id)"""


@query(
    "q_prepare_entities",
    f"""WITH {SQL_VALID}
SELECT entity_id, stars, array_to_string(list_distinct_in_order, ', ') AS categories, seq1, seq2 FROM (
  SELECT *, CASE WHEN lower(flags[1]) = lower(flags[2]) THEN [lower(flags[1])]
                 ELSE [lower(flags[1]), lower(flags[2])] END AS list_distinct_in_order
  FROM (SELECT *, string_split(categories, ',') AS flags,
               row_number() OVER (PARTITION BY entity_id ORDER BY place) AS rn FROM judged WHERE ok) WHERE rn = 1)""",
)
def prepare_entities(v):
    kept = cleaning.prepare_entities(raw_entities(v), "entity_id", ENTITY_ORDER)
    return kept.select("entity_id", "stars", "categories", "seq1", "seq2")


@query("q_prepare_reviews", f"WITH {SQL_UNIQUE} SELECT * FROM unique_reviews", "reviews")
def prepare_reviews(v):
    states = cleaning.review_states(v.review_texts(), "entity_id", "text")
    return cleaning.kept_reviews(states, "entity_id", ["review_id"])


@query(
    "q_quality_counters",
    f"""WITH {SQL_VALID}, {SQL_UNIQUE},
  entity_n AS (SELECT count(*) FILTER (place = first_place) AS records_written,
                      count(*) FILTER (place > first_place) AS dropped_duplicate,
                      count(*) FILTER (first_place IS NULL OR place < first_place) AS dropped_invalid
               FROM judged LEFT JOIN firsts USING (entity_id)),
  review_n AS (SELECT (SELECT count(*) FROM unique_reviews) AS records_written,
                      (SELECT count(*) FROM ranked WHERE rn > 1) AS dropped_duplicate,
                      (SELECT count(*) FROM cleaned WHERE text IS NULL) AS dropped_invalid)
SELECT 'entities' AS table_name, * FROM entity_n UNION ALL SELECT 'reviews', * FROM review_n""",
    "reviews",
)
def quality_counters(v):
    reasons = cleaning.entity_reasons(raw_entities(v), "entity_id", ENTITY_ORDER)
    entities = cleaning.entity_counters(reasons).select(
        F.lit("entities").alias("table_name"),
        "records_written",
        F.col("dropped_duplicate_id").alias("dropped_duplicate"),
        "dropped_invalid",
    )
    states = cleaning.review_states(v.review_texts(), "entity_id", "text")
    reviews = cleaning.review_counters(states, "entity_id").select(
        F.lit("reviews").alias("table_name"),
        "records_written",
        "dropped_duplicate",
        (F.col("dropped_malformed_json") + F.col("dropped_empty_short")).alias("dropped_invalid"),
    )
    return entities.unionByName(reviews)


@query(
    "q_eda_summary",
    f"""WITH {SQL_UNIQUE}
SELECT '2.1' AS cleaning_version, (SELECT count(*) FROM entities) AS n_businesses,
       (SELECT count(*) FROM unique_reviews) AS n_reviews_full, false AS fast_mode,
       (SELECT least(count(*), {CFG.sample_rows}) FROM unique_reviews) AS n_reviews_small""",
    "reviews entities",
)
def eda_summary(v):
    kept = cleaning.dedupe_reviews(v.review_texts(), "entity_id", "text", ["review_id"])
    return counts.eda_summary(v.entities(), kept, CFG.sample_rows, CFG.cleaning_version)


# --- class samples ---------------------------------------------------------------------------------------

SQL_U = "('0x' || substr(md5(concat(doc_id::VARCHAR, '#42')), 1, 8))::UBIGINT::DOUBLE / 4294967296.0::DOUBLE"


@query(
    "q_undersample",
    f"""SELECT doc_id, label FROM scored WHERE label = 0 OR {SQL_U} <
          (SELECT count(*) FILTER (label = 0)::DOUBLE / count(*) FILTER (label = 1) FROM scored)""",
    "scored",
)
def undersample(v):
    return sampling.undersample(v.scored().select("doc_id", "label"), "doc_id")


@query(
    "q_hash_split",
    f"""SELECT doc_id, CASE WHEN {SQL_U} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split FROM documents""",
)
def hash_split(v):
    return sampling.with_split(v.table("documents").select("doc_id"), "doc_id")


@query("q_union_classes", "SELECT doc_id, label FROM scored WHERE label IN (0, 1)", "scored")
def union_classes(v):
    return sampling.union_classes(v.scored().select("doc_id", "label"))
