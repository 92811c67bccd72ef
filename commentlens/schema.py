"""Fixed row types: the raw filing, the derived ``analysis`` struct and the stored comment."""

from __future__ import annotations

from pyspark.sql import types as T

ADDRESS = T.StructType(
    [
        T.StructField("address_line_1", T.StringType()),
        T.StructField("address_line_2", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("zip4", T.StringType()),
        T.StructField(
            "internationaladdressentity",
            T.StructType([T.StructField("addresstext", T.StringType())]),
        ),
    ]
)

ADDRESSES = T.ArrayType(ADDRESS)

FILING = T.StructType(
    [
        T.StructField("id_submission", T.StringType()),
        T.StructField("confirmation_number", T.StringType()),
        T.StructField("text_data", T.StringType()),
        T.StructField("date_received", T.TimestampType()),
        T.StructField("date_disseminated", T.TimestampType()),
        T.StructField("contact_email", T.StringType()),
        T.StructField("emailConfirmation", T.StringType()),
        T.StructField("browser", T.StringType()),
        T.StructField("express_comment", T.IntegerType()),
        T.StructField("filers", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
        T.StructField("addressentity", ADDRESSES),
        T.StructField(
            "internationaladdressentity",
            T.StructType([T.StructField("addresstext", T.StringType())]),
        ),
        T.StructField("proceedings", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    ]
)

MORE_LIKE_THIS = T.StructType(
    [
        T.StructField("src_doc_id", T.StringType()),
        T.StructField("is_source", T.BooleanType()),
        T.StructField("matches", T.LongType()),
        T.StructField("too_short", T.BooleanType()),
        T.StructField("source", T.StringType()),
    ]
)

# Leaves the annotation job derives from the row itself.
ROW_LEAVES = [
    T.StructField("fulladdress", T.BooleanType()),
    T.StructField("capsemail", T.BooleanType()),
    T.StructField("source", T.StringType()),
    T.StructField("proceedings_keys", T.StringType()),
    T.StructField("onsite", T.BooleanType()),
    T.StructField("ingestion_method", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("titleii", T.BooleanType()),
    T.StructField("words", T.IntegerType()),
    T.StructField("untaggable", T.BooleanType()),
]

# Leaves that other jobs (labels, ranking, breach lists, clustering) add later.
LATER_LEAVES = [
    T.StructField("sentiment_manual", T.BooleanType()),
    T.StructField("sentiment_sig_terms_ordered", T.BooleanType()),
    T.StructField("breached", T.BooleanType()),
    T.StructField("more_like_this", MORE_LIKE_THIS),
]

ANALYSIS = T.StructType(ROW_LEAVES + LATER_LEAVES)

COMMENT = T.StructType(FILING.fields + [T.StructField("analysis", ANALYSIS)])
