"""Text and category features: the ML stages, and exact relational tables of the same quantities."""

from __future__ import annotations

import itertools

from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    HashingTF,
    NGram,
    StopWordsRemover,
    Tokenizer,
    VectorAssembler,
    Word2Vec,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmill.config import ReviewConfig
from revmill.operators.joins import spread_join
from revmill.operators.limits import top_k

# The default English stop words.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her "
    "hers herself it its itself they them their theirs themselves what which who whom this that these "
    "those am is are was were be been being have has had having do does did doing a an the and but if or "
    "because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where "
    "why how all any both each few more most other some such no nor not only own same so than too very s "
    "t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd "
    "they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't "
    "couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's "
    "would "
).split()


def feature_stages(cfg: ReviewConfig = ReviewConfig()) -> list[Transformer | Estimator]:
    """Words, bigrams and categories to one sparse vector. Stages that need no fitting come first."""
    return [
        Tokenizer(inputCol="text", outputCol="words_raw"),
        StopWordsRemover(inputCol="words_raw", outputCol="words"),
        NGram(n=2, inputCol="words", outputCol="bigrams"),
        HashingTF(inputCol="words", outputCol="word_tf", numFeatures=cfg.word_buckets),
        HashingTF(inputCol="bigrams", outputCol="bigram_tf", numFeatures=cfg.bigram_buckets),
        IDF(inputCol="word_tf", outputCol="word_tfidf", minDocFreq=cfg.word_min_df),
        IDF(inputCol="bigram_tf", outputCol="bigram_tfidf", minDocFreq=cfg.bigram_min_df),
        CountVectorizer(inputCol="cat_array", outputCol="cat_counts", vocabSize=cfg.category_vocab),
        VectorAssembler(
            inputCols=["word_tfidf", "bigram_tfidf", "cat_counts"],
            outputCol="features",
            handleInvalid="skip",
        ),
    ]


def split_stages(stages: list) -> tuple[list[Transformer], list, list[str]]:
    """(leading stages that need no fitting, the others, the columns the others read from before them)."""
    fixed = list(itertools.takewhile(lambda s: isinstance(s, Transformer), stages))
    rest = stages[len(fixed):]
    read, made = [], set()
    for stage in rest:
        names = stage.getInputCols() if isinstance(stage, VectorAssembler) else [stage.getInputCol()]
        read += [n for n in names if n not in made and n not in read]
        made.add(stage.getOutputCol())
    return fixed, rest, read


# A part of an embedding's fit sees so many words at least, so small tables are fitted in one part.
WORDS_PER_PART = 1_000_000
# Numbers in a vector table up to which it is broadcast (80 MB).
MAX_BROADCAST_NUMBERS = 10_000_000


def embedding_stages(size: int = 50, min_count: int = 5, seed: int = 42, parts: int = 1) -> list[Transformer | Estimator]:
    """Word embeddings averaged per review. The fit learns in so many parts side by side and averages what they find."""
    return [
        Tokenizer(inputCol="text", outputCol="words_raw"),
        StopWordsRemover(inputCol="words_raw", outputCol="words"),
        Word2Vec(
            inputCol="words", outputCol="embedding", vectorSize=size, minCount=min_count, seed=seed, numPartitions=parts
        ),
    ]


def fit_parts(df: DataFrame, words: str) -> int:
    """Parts for the fit of an embedding: as many as tasks run at once, if each sees enough words."""
    total = df.agg(F.sum(F.size(words))).first()[0] or 0
    return max(1, min(total // WORDS_PER_PART, df.sparkSession.sparkContext.defaultParallelism))


def embed(df: DataFrame, key: str, words: str, vectors: DataFrame) -> DataFrame:
    """(key, embedding): the mean vector of each row's words from a table (word, vector) of a fitted embedding.

    Words without a vector count as zero, as in the fitted stage; a row without words has an empty embedding. The key is unique. A
    small table of vectors is broadcast, and all words of a row are added where the row lies. Otherwise equal words of a row
    are one row of a join by word, and a word found in most rows is split for it.
    """
    first = vectors.select(F.size(vector_to_array("vector")).alias("n")).first()
    size = first["n"] if first else 0
    table = vectors.select(F.col("word").alias("term"), vector_to_array("vector").alias("vector"))
    if vectors.count() * size <= MAX_BROADCAST_NUMBERS:
        found = df.select(key, F.explode(words).alias("term")).join(F.broadcast(table), "term").withColumn("tf", F.lit(1))
    else:
        tf = term_counts(df, key, words)
        df_ = tf.groupBy("term").agg(F.count("*").alias("rows"))
        found = spread_join(tf, table.join(df_, "term"), "term", "rows", [key])
    # Plain sums stay in the hash table of a task; an aggregate of whole vectors sorts its rows from the 129th key on.
    sums = found.groupBy(key).agg(*(F.sum(F.get("vector", F.lit(i)) * F.col("tf")).alias(f"_{i}") for i in range(size)), F.lit(1).alias("_"))
    sums = sums.select(key, F.array(*(f"_{i}" for i in range(size))).cast("array<double>").alias("s"))
    sizes = df.select(key, F.size(words).alias("_n"))
    total = F.coalesce("s", F.array().cast("array<double>"))
    return sizes.join(sums, key, "left").select(key, F.transform(total, lambda x: x / F.col("_n")).alias("embedding"))


def numeric_assembler(columns: list[str]) -> VectorAssembler:
    """Numeric columns to a vector; an invalid value is an error."""
    return VectorAssembler(inputCols=columns, outputCol="features")


def term_counts(df: DataFrame, key: str, words: str) -> DataFrame:
    """(key, term, tf) for an array column of words. Copies within a row are summed before the shuffle."""
    return (
        df.select(key, F.explode(words).alias("term"))
        .groupBy(key, "term")
        .agg(F.count("*").alias("tf"))
    )


def tfidf(df: DataFrame, key: str, words: str, min_df: int = 0) -> DataFrame:
    """Exact (key, term, tf, df, tfidf) with idf = ln((rows + 1) / (df + 1)), 0 below min_df.

    The key is unique per row; rows without words still count as rows. The table is read three times, so
    hand in staged words if they are costly to make. A term found in most rows is split for the join.
    """
    rows = df.agg(F.count("*")).scalar()
    per_term = (
        df.select(F.explode(F.array_distinct(words)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
    )
    idf = F.when(F.col("df") >= min_df, F.log((rows + 1.0) / (F.col("df") + 1.0))).otherwise(0.0)
    joined = spread_join(term_counts(df, key, words), per_term, "term", "df", [key])
    return joined.select(key, "term", "tf", "df", (F.col("tf") * idf).alias("tfidf"))


def category_vocab(df: DataFrame, items: str, size: int = 150) -> DataFrame:
    """The size most frequent items of an array column (term, total), ties by name."""
    counts = df.select(F.explode(items).alias("term")).groupBy("term").agg(F.count("*").alias("total"))
    return top_k(counts, size, "total", "term")
