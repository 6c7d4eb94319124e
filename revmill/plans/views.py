"""The review tables as views over the given star-schema tables, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.sources.files import spread


class Views:
    """Business and review tables derived from the Parquet files of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def entities(self) -> DataFrame:
        """Businesses without the columns that need the review facts."""
        return self.table("part").select(
            F.col("p_partkey").alias("entity_id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("city"),
            F.concat_ws(", ", F.replace("p_name", F.lit(" "), F.lit(", ")), "p_type").alias("categories"),
            (1.0 + (F.col("p_size") % 9) * 0.5).alias("stars"),
            (F.col("p_partkey") % 5 != 0).cast("int").alias("is_open"),
            F.col("p_retailprice").alias("num1"),
        )

    def counted_entities(self) -> DataFrame:
        """Businesses with their review count and mean quantity."""
        facts = self.table("lineitem").groupBy(F.col("l_partkey").alias("entity_id")).agg(
            F.count("*").alias("review_count"), F.avg("l_quantity").alias("num2")
        )
        return self.entities().join(facts, "entity_id", "left").fillna({"review_count": 0, "num2": 0.0})

    def ratings(self) -> DataFrame:
        """Review facts without text."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_id"),
            F.col("l_partkey").alias("entity_id"),
            F.col("l_suppkey").alias("user_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
        )

    def reviews(self) -> DataFrame:
        """Review texts; the source number is the business."""
        return self.table("documents").select(
            F.col("doc_id").alias("review_id"),
            F.expr("substr(source, 4)").cast("bigint").alias("entity_id"),
            "text",
        )

    def review_texts(self) -> DataFrame:
        """Reviews for costly work on the text, spread over the cores if the files give too few tasks."""
        return spread(self.reviews(), "review_id")

    def users(self) -> DataFrame:
        return self.table("events").select("user_id")

    def scored(self) -> DataFrame:
        """Labelled predictions."""
        score = (F.col("n_chars") % 97).cast("double") / 97.0
        return (
            self.table("documents")
            .join(self.table("labels"), "doc_id")
            .select(
                "doc_id",
                F.col("quality").cast("double").alias("label"),
                score.alias("score"),
                (score >= 0.5).cast("double").alias("prediction"),
            )
        )


# The same views for the SQL twins; {views} picks those a query needs.
SQL_VIEWS = {
    "entities": """entities AS (
  SELECT p_partkey AS entity_id, p_name AS name, p_brand AS city,
         concat(replace(p_name, ' ', ', '), ', ', p_type) AS categories,
         (1.0 + (p_size % 9) * 0.5)::DOUBLE AS stars,
         (p_partkey % 5 <> 0)::INTEGER AS is_open, p_retailprice AS num1
  FROM part)""",
    "counted_entities": """counted_entities AS (
  SELECT p_partkey AS entity_id, p_name AS name, p_brand AS city,
         concat(replace(p_name, ' ', ', '), ', ', p_type) AS categories,
         (1.0 + (p_size % 9) * 0.5)::DOUBLE AS stars,
         (p_partkey % 5 <> 0)::INTEGER AS is_open, p_retailprice AS num1,
         coalesce(f.review_count, 0) AS review_count, coalesce(f.num2, 0.0) AS num2
  FROM part LEFT JOIN (SELECT l_partkey, count(*) AS review_count, avg(l_quantity) AS num2
                       FROM lineitem GROUP BY l_partkey) f ON f.l_partkey = p_partkey)""",
    "ratings": """ratings AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_partkey AS entity_id, l_suppkey AS user_id,
         l_quantity AS quantity, l_extendedprice AS price
  FROM lineitem)""",
    "reviews": """reviews AS (
  SELECT doc_id AS review_id, substr(source, 4)::BIGINT AS entity_id, text FROM documents)""",
    "users": "users AS (SELECT user_id FROM events)",
    "scored": """scored AS (
  SELECT doc_id, quality::DOUBLE AS label, score, (score >= 0.5)::INTEGER::DOUBLE AS prediction
  FROM (SELECT doc_id, quality, (n_chars % 97)::DOUBLE / 97.0::DOUBLE AS score
        FROM documents JOIN labels USING (doc_id)))""",
}
