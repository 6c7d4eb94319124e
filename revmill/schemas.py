"""Fixed schemas of the two input tables. Explicit schemas spare the inference pass over the files."""

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())

BUSINESS = T.StructType(
    [
        T.StructField("business_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("review_count", T.IntegerType()),
        T.StructField("is_open", T.IntegerType()),
        T.StructField("categories", T.StringType()),
        T.StructField("attributes", _TEXT_MAP),
        T.StructField("hours", _TEXT_MAP),
    ]
)

# Only the key, the stars and the categories may reject a business. A typed column would mark the whole line
# as malformed when its value does not fit, so all others arrive as text and are cast later.
BUSINESS_RAW = T.StructType(
    [T.StructField(f.name, f.dataType if f.name == "stars" else T.StringType()) for f in BUSINESS.fields]
)

# Only business_id and text may reject a review, so the numeric fields arrive as text and are cast later.
REVIEW_RAW = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("business_id", T.StringType()),
        T.StructField("stars", T.StringType()),
        T.StructField("useful", T.StringType()),
        T.StructField("funny", T.StringType()),
        T.StructField("cool", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("date", T.StringType()),
    ]
)

# Store tables in their three published widths.
BUSINESS_STORE = T.StructType(
    [f for f in BUSINESS.fields if f.name not in ("attributes", "hours")]
)
BUSINESS_STORE_NO_GEO = T.StructType(
    [f for f in BUSINESS_STORE.fields if f.name not in ("latitude", "longitude")]
)
BUSINESS_STORE_NARROW = T.StructType(
    [BUSINESS[n] for n in ("business_id", "city", "categories", "stars", "review_count")]
)
REVIEW_STORE = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("business_id", T.StringType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("useful", T.IntegerType()),
        T.StructField("funny", T.IntegerType()),
        T.StructField("cool", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("date", T.StringType()),
    ]
)
REVIEW_CLEAN = T.StructType(REVIEW_STORE.fields + [T.StructField("useful_raw", T.StringType())])
REVIEW_STORE_NARROW = T.StructType(
    [REVIEW_STORE[n] for n in ("review_id", "business_id", "user_id", "stars", "text")]
)


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus the column that receives malformed lines."""
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
