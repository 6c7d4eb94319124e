"""Queries over parsing, loading, feature and split steps that the jobs are made of."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revmill import schemas
from revmill.functions import text as X
from revmill.functions import values as V
from revmill.operators import features as FE
from revmill.operators import cleaning, joins, rows, sampling
from revmill.operators import models as M
from revmill.operators.ensembles import feature_values
from revmill.plans.analyse import eda_long
from revmill.plans.catalog_rows import SQL_TRAINING, SQL_U, SQL_UNIQUE
from revmill.plans.catalog_text import SQL_CLEAN, SQL_KEPT, clean_reviews, kept_words
from revmill.plans.load import load_counters, store_rows
from revmill.plans.registry import query
from revmill.plans.views import Views
from revmill.session import cut_lineage, new_folder, staged
from revmill.sources import files, sinks

# --- JSON lines built from review facts: numbers as tokens, quoted, null, left out, and lines that are broken ---

SQL_LINES = """raw_lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey % 9 AS kind,
    CASE l_orderkey % 9 WHEN 0 THEN l_linenumber || '.0' WHEN 1 THEN '"' || l_linenumber || '.0"'
      WHEN 2 THEN l_linenumber || '.7' WHEN 3 THEN 'true' WHEN 4 THEN 'null' WHEN 5 THEN '"' || l_linenumber || '"'
      ELSE l_linenumber::VARCHAR END AS token FROM lineitem)"""
# What the integer is: null where it cannot be read or is not given.
SQL_INTEGER = """CASE WHEN kind IN (1, 4) THEN NULL WHEN kind = 3 THEN 1 ELSE l_linenumber::INTEGER END"""


def raw_lines(v: Views) -> DataFrame:
    number, kind = F.col("l_linenumber").cast("string"), F.col("l_orderkey") % 9
    token = (
        F.when(kind == 0, F.concat(number, F.lit(".0"))).when(kind == 1, F.concat(F.lit('"'), number, F.lit('.0"')))
        .when(kind == 2, F.concat(number, F.lit(".7"))).when(kind == 3, "true").when(kind == 4, "null")
        .when(kind == 5, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    )
    # Kind 7 has no key, kind 8 is cut off.
    line = F.concat(
        F.lit('{"review_id": "'), F.when(kind != 7, F.concat_ws("-", "l_orderkey", number)).otherwise(""),
        F.lit('", "useful": '), token, F.lit(', "text": "says \\"useful\\": 9.5, ok"'), F.when(kind == 8, "").otherwise("}"),
    )
    return v.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", line.alias("value"),
        F.lit("lines").alias("line_file"), F.col("l_orderkey").alias("line_block"),
        (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("line_no"),
    )


def parsed_lines(v: Views, *fields: str) -> DataFrame:
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return files.parse_lines(raw_lines(v), schema)


@query(
    "q_json_integers",
    f"""WITH {SQL_LINES} SELECT l_orderkey, l_linenumber, {SQL_INTEGER} AS useful, count(*) AS n
        FROM raw_lines WHERE kind <> 8 GROUP BY ALL""",
)
def json_integers(v):
    good = parsed_lines(v, "review_id", "useful").filter(F.col(schemas.CORRUPT).isNull())
    return good.groupBy("l_orderkey", "l_linenumber", V.soft_int(F.col("useful")).alias("useful")).agg(
        F.count("*").alias("n")
    )


@query(
    "q_tolerant_parse",
    f"""WITH {SQL_LINES} SELECT kind, count(*) FILTER (kind <> 8) AS good, count(*) FILTER (kind = 8) AS malformed
        FROM raw_lines GROUP BY kind""",
)
def tolerant_parse(v):
    broken = F.col(schemas.CORRUPT).isNotNull()
    return parsed_lines(v, "review_id", "useful", "text").groupBy((F.col("l_orderkey") % 9).alias("kind")).agg(
        F.count_if(~broken).alias("good"), F.count_if(broken).alias("malformed")
    )


LOAD = T.StructType([T.StructField("review_id", T.StringType()), T.StructField("useful", T.IntegerType())])


@query(
    "q_load_counters",
    f"""WITH {SQL_LINES} SELECT count(*) FILTER (kind NOT IN (1, 4, 7, 8)) AS loaded,
          count(*) FILTER (kind IN (1, 4, 8)) AS skipped, count(*) FILTER (kind = 7) AS keyless FROM raw_lines""",
)
def load_counts(v):
    return load_counters(store_rows(parsed_lines(v, "review_id", "useful"), LOAD, "review_id"))


@query(
    "q_load_narrow",
    f"""WITH {SQL_LINES} SELECT l_orderkey || '-' || l_linenumber AS review_id,
          coalesce({SQL_INTEGER}, 0) AS useful FROM raw_lines WHERE kind NOT IN (1, 7, 8)""",
)
def load_narrow(v):
    found = store_rows(parsed_lines(v, "review_id", "useful"), LOAD, "review_id", null_skips=False)
    return found.filter("fate = 'loaded'").select("review_id", "useful")


# --- text and training rows ------------------------------------------------------------------------------

PLAIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
WIDE = "".join(chr(ord(c) + 0xFEE0) for c in PLAIN)
assert unicodedata.normalize("NFKC", WIDE) == PLAIN


@query("q_nfkc_wide", "SELECT doc_id, text FROM documents")
def nfkc_wide(v):
    """Letters and digits written in full width come back as they were."""
    return v.table("documents").select("doc_id", X.nfkc(F.translate("text", PLAIN, WIDE)).alias("text"))


@query(
    "q_training_repeated",
    f"WITH {SQL_CLEAN}, {SQL_TRAINING} SELECT entity_id, text, label, categories FROM training",
    "reviews entities",
)
def training_repeated(v):
    """Entities that are listed twice do not double their reviews."""
    twice = v.entities().unionByName(v.entities())
    return joins.training_reviews(clean_reviews(v), twice, "entity_id").drop("cat_array")


BUCKETS = 3072
MASK = 4294967295


def sql_rotated(x: str, bits: int) -> str:
    return f"((({x} << {bits}) | ({x} >> {32 - bits})) & {MASK})"


def sql_spread(x: str) -> str:
    """How a block of four bytes is mixed before it enters the hash."""
    return f"({sql_rotated(f'(({x} * 3432918353) & {MASK})', 15)} * 461845907) & {MASK}"


# MurmurHash3 of 32 bits with seed 42 over the UTF-8 bytes of each term, and its bucket: the remainder of the signed hash.
SQL_BUCKETS = f"""term_list AS (SELECT DISTINCT unnest(words) AS term FROM kept),
  term_bytes AS (SELECT term, list_transform(range(1, strlen(term) + 1), lambda i:
    (16 * (instr('0123456789ABCDEF', hex(term)[2 * i - 1]) - 1) + instr('0123456789ABCDEF', hex(term)[2 * i]) - 1)::UBIGINT) AS b
    FROM term_list),
  term_blocks AS (SELECT term, len(b)::UBIGINT AS size,
    list_transform(range(len(b) // 4), lambda i: b[4 * i + 1] | (b[4 * i + 2] << 8) | (b[4 * i + 3] << 16) | (b[4 * i + 4] << 24)) AS blocks,
    coalesce(b[4 * (len(b) // 4) + 1], 0::UBIGINT) | (coalesce(b[4 * (len(b) // 4) + 2], 0::UBIGINT) << 8)
      | (coalesce(b[4 * (len(b) // 4) + 3], 0::UBIGINT) << 16) AS tail FROM term_bytes),
  term_mixed AS (SELECT term, size, list_transform(blocks, lambda k: {sql_spread('k')}) AS blocks, {sql_spread('tail')} AS tail
    FROM term_blocks),
  term_body AS (SELECT term, size, tail, list_reduce(list_concat([42::UBIGINT], blocks), lambda h, k:
    ({sql_rotated('xor(h, k)', 13)} * 5 + 3864292196) & {MASK}) AS h FROM term_mixed),
  term_last AS (SELECT term, xor(xor(h, tail), size) AS h FROM term_body),
  term_one AS (SELECT term, (xor(h, h >> 16) * 2246822507) & {MASK} AS h FROM term_last),
  term_two AS (SELECT term, (xor(h, h >> 13) * 3266489909) & {MASK} AS h FROM term_one),
  term_hash AS (SELECT term, xor(h, h >> 16)::BIGINT AS h FROM term_two),
  term_bucket AS (SELECT term, ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END % {BUCKETS} + {BUCKETS}) % {BUCKETS})::INTEGER
    AS bucket FROM term_hash)"""


@query(
    "q_hashed_tf",
    f"""WITH {SQL_KEPT}, {SQL_BUCKETS}
SELECT review_id, bucket, count(*) AS n FROM (SELECT review_id, unnest(words) AS term FROM kept)
JOIN term_bucket USING (term) GROUP BY review_id, bucket""",
    "reviews",
)
def hashed_tf(v):
    """The words of each review by the bucket that their hash gives."""
    hashed = HashingTF(inputCol="words", outputCol="tf", numFeatures=BUCKETS).transform(kept_words(v))
    found = feature_values(hashed, "review_id", "tf")
    return found.select("review_id", F.col("feature").alias("bucket"), F.col("value").cast("long").alias("n"))


@query(
    "q_category_idf",
    """WITH items AS (SELECT entity_id, unnest(list_distinct(string_split(categories, ', '))) AS term FROM entities)
SELECT term, round(ln(((SELECT count(*) FROM entities) + 1)::DOUBLE / (count(*) + 1)), 6) AS idf
FROM items GROUP BY term""",
    "entities",
)
def category_idf(v):
    """The weights that the count vectorizer and the IDF stage fit, of every term and without a limit of the vocabulary."""
    items = v.entities().select(F.array_distinct(X.category_array(F.col("categories"))).alias("items"))
    total = items.agg(F.count("*").alias("total"))
    found = items.select(F.explode("items").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    idf = F.log((total.scalar() + 1) / (F.col("n") + 1).cast("double"))
    return found.select("term", F.round(idf, 6).alias("idf"))


@query(
    "q_numeric_assembler",
    """SELECT entity_id, review_count + is_open + num1 AS total FROM counted_entities""",
    "counted_entities",
)
def assembled(v):
    vectors = FE.numeric_assembler(["review_count", "is_open", "num1"]).transform(v.counted_entities())
    a = vector_to_array("features")
    return vectors.select("entity_id", (a[0] + a[1] + a[2]).alias("total"))


# --- splits and samples by key ---------------------------------------------------------------------------


@query(
    "q_keyed_folds",
    f"SELECT doc_id, floor({SQL_U} * 5)::INTEGER AS fold FROM documents",
)
def keyed_folds(v):
    """Membership in five folds, fixed by key and seed."""
    fold = F.floor(V.key_fraction(F.col("doc_id"), 42) * 5).cast("int")
    return v.table("documents").select("doc_id", fold.alias("fold"))


@query(
    "q_split_sizes",
    f"""SELECT count(*) FILTER ({SQL_U} < 0.8::DOUBLE) AS train, count(*) FILTER ({SQL_U} >= 0.8::DOUBLE) AS test,
          0::BIGINT AS both FROM documents""",
)
def split_sizes(v):
    """The two parts of a keyed split are whole and share no row."""
    train, test = sampling.hash_split(v.table("documents").select("doc_id"), "doc_id")
    return train.agg(F.count("*").alias("train")).select(
        "train",
        test.agg(F.count("*")).scalar().alias("test"),
        train.join(test, "doc_id").agg(F.count("*")).scalar().alias("both"),
    )


# --- model tables, the parts that are known beforehand ----------------------------------------------------


@query(
    "q_tier_rows",
    f"""SELECT entity_id, CASE WHEN stars >= 4.0 THEN 0.0 WHEN stars >= 3.0 THEN 1.0 ELSE 2.0 END::DOUBLE AS label,
              true AS known FROM counted_entities WHERE {SQL_U.replace("doc_id", "entity_id")} >= 0.8::DOUBLE""",
    "counted_entities",
)
def tier_rows(v):
    """Test rows and labels of the tier tree's table, and that every prediction is one of the tiers."""
    scored = M.tier_tree(v.counted_entities(), "entity_id", ["review_count", "is_open", "num1", "num2"])
    return scored.select("entity_id", "label", F.col("prediction").isin(0.0, 1.0, 2.0).alias("known"))


@query(
    "q_not_null_selected",
    """SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND n_chars IS NOT NULL""",
)
def not_null_selected(v):
    return rows.drop_any_null(v.table("documents"), ["text", "n_chars"]).select("doc_id", "text")


# --- exploration ------------------------------------------------------------------------------------------


@query(
    "q_eda_long",
    """WITH items AS (SELECT unnest(string_split(categories, ', ')) AS item FROM counted_entities),
  pairs AS (
  SELECT 'city' AS table_name, city AS key FROM counted_entities UNION ALL SELECT 'category', item FROM items
  UNION ALL SELECT 'stars', stars::VARCHAR FROM counted_entities
  UNION ALL SELECT 'review_count', review_count::VARCHAR FROM counted_entities
  UNION ALL SELECT 'user_id', (review_id % 150)::VARCHAR FROM reviews
  UNION ALL SELECT 'chars', length(text)::VARCHAR FROM reviews)
SELECT table_name, key, count(*) AS n FROM pairs WHERE key IS NOT NULL GROUP BY ALL""",
    "counted_entities reviews",
)
def eda_counts(v):
    return eda_long(v.counted_entities(), v.reviews().withColumn("user_id", F.col("review_id") % 150))


@query(
    "q_observed_counters",
    f"""WITH {SQL_UNIQUE}
SELECT (SELECT count(*) FROM unique_reviews) AS records_written, 0::BIGINT AS dropped_malformed_json,
       (SELECT count(*) FROM cleaned WHERE text IS NULL) AS dropped_empty_short,
       (SELECT count(*) FROM ranked WHERE rn > 1) AS dropped_duplicate""",
    "reviews",
)
def observed_counters(v):
    """The counters of the preparation, gathered while its tables are written."""
    states, seen = cleaning.observe_states(cleaning.review_states(v.review_texts(), "entity_id", "text"))
    with staged(states) as states:
        kept, written = cleaning.observe_rows(cleaning.kept_reviews(states, "entity_id", ["review_id"]))
        kept.write.parquet(new_folder(v.spark, "kept"))
    counters = cleaning.observed_counters(seen, written)
    return v.spark.createDataFrame([tuple(counters.values())], ", ".join(f"{name} long" for name in counters))


# --- files and store tables ---------------------------------------------------------------------------------


@query("q_jsonl_round_trip", f"WITH {SQL_UNIQUE} SELECT * FROM unique_reviews", "reviews")
def jsonl_round_trip(v):
    """Clean reviews written as JSON lines and read back; a file that is not there gives no rows."""
    base = new_folder(v.spark, "jsonl")
    kept = cleaning.dedupe_reviews(v.review_texts(), "entity_id", "text", ["review_id"])
    sinks.write_jsonl(kept, f"{base}/reviews")
    found = files.read_jsonl(v.spark, f"{base}/reviews", kept.schema)
    return found.select(kept.columns)


@query(
    "q_append_twice",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderkey % 3 = 0 AS first_batch FROM orders",
)
def append_twice(v):
    """Two batches appended to a store, each tried twice: what it holds then is each batch once."""
    store = new_folder(v.spark, "store")
    first = F.col("o_orderkey") % 3 == 0
    orders = v.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", first.alias("first_batch"))
    for batch, rows_ in (("a", orders.filter("first_batch")), ("b", orders.filter("NOT first_batch"))):
        for _ in range(2):
            sinks.append_batch(rows_, store, batch)
    return sinks.read_batches(v.spark, store, orders.schema)


# --- embeddings ---------------------------------------------------------------------------------------------

EMBEDDED = 50


def fitted_embedding(v: Views):
    """Staged words of the reviews, and the embedding stage fitted to them."""
    words = cut_lineage(kept_words(v).select("review_id", "words"))
    return words, FE.embedding_stages(EMBEDDED, parts=FE.fit_parts(words, "words"))[-1].fit(words)


@query("q_embedding_rows", f"WITH {SQL_KEPT} SELECT review_id, true AS same FROM kept", "reviews")
def embedding_rows(v):
    """Whether the mean of the exported word vectors is what the fitted stage gives, up to the order of the sums."""
    words, model = fitted_embedding(v)
    ours = FE.embed(words, "review_id", "words", cut_lineage(model.getVectors()))
    theirs = model.transform(words).select("review_id", vector_to_array("embedding").alias("theirs"))
    apart = F.zip_with("embedding", "theirs", lambda a, b: F.coalesce(F.abs(F.coalesce(a, F.lit(0.0)) - b), F.lit(1.0)))
    most = F.coalesce(F.array_max(apart), F.lit(1.0))
    return ours.join(theirs, "review_id").select("review_id", (most <= 1e-9).alias("same"))


@query(
    "q_embedding_vocab",
    f"""WITH {SQL_KEPT} SELECT term FROM (SELECT unnest(words) AS term FROM kept) GROUP BY term HAVING count(*) >= 5""",
    "reviews",
)
def embedding_vocab(v):
    """The words that have a vector: those seen five times or more."""
    _, model = fitted_embedding(v)
    return model.getVectors().select(F.col("word").alias("term"))


@query(
    "q_sample_modes",
    """WITH first_rows AS (SELECT review_id, entity_id, text FROM reviews ORDER BY review_id LIMIT 50),
  later_rows AS (SELECT review_id, entity_id, text FROM reviews ORDER BY review_id DESC LIMIT 50),
  modes AS (SELECT 'missing' AS mode, review_id, entity_id, text FROM reviews WHERE false
    UNION ALL SELECT 'built', * FROM first_rows UNION ALL SELECT 'kept', * FROM first_rows
    UNION ALL SELECT 'forced', * FROM later_rows)
SELECT * FROM modes""",
    "reviews",
)
def sample_modes(v):
    """A sample that is missing, built, kept though its source has changed, and built anew by force."""
    base, spark = new_folder(v.spark, "sample"), v.spark
    schema = v.reviews().schema
    for name, order in (("first", F.asc("review_id")), ("later", F.desc("review_id"))):
        sinks.write_jsonl(v.reviews().orderBy(order), f"{base}/{name}")  # files by ranges of ids, in order
    steps = (
        ("missing", lambda: files.read_optional(spark, f"{base}/small", schema)),
        ("built", lambda: files.build_sample(spark, f"{base}/first", f"{base}/small", schema, 50)),
        ("kept", lambda: files.build_sample(spark, f"{base}/later", f"{base}/small", schema, 50)),
        ("forced", lambda: files.build_sample(spark, f"{base}/later", f"{base}/small", schema, 50, "force")),
    )
    # Each is staged at once, as the next step may replace the sample.
    found = [cut_lineage(step().select(F.lit(mode).alias("mode"), *schema.fieldNames())) for mode, step in steps]
    return reduce(DataFrame.unionByName, found)


@query(
    "q_fitted_idf",
    f"""WITH {SQL_KEPT}, {SQL_BUCKETS},
  dfs AS (SELECT bucket, count(DISTINCT review_id) AS df
          FROM (SELECT review_id, unnest(words) AS term FROM kept) JOIN term_bucket USING (term) GROUP BY bucket)
SELECT bucket, df, round(ln(((SELECT count(*) FROM kept) + 1)::DOUBLE / (df + 1)), 6) AS idf FROM dfs WHERE df >= 2""",
    "reviews",
)
def fitted_idf(v):
    """What the IDF stage of the training features has fitted: one weight for each of the fixed number of buckets."""
    words = kept_words(v).select("words")
    hashed = HashingTF(inputCol="words", outputCol="tf", numFeatures=BUCKETS).transform(words)
    model = IDF(inputCol="tf", outputCol="tfidf", minDocFreq=2).fit(cut_lineage(hashed.select("tf")))
    rows_ = [(i, int(n), float(w)) for i, (n, w) in enumerate(zip(model.docFreq, model.idf)) if n >= 2]
    return v.spark.createDataFrame(rows_, "bucket int, df long, idf double").withColumn("idf", F.round("idf", 6))
