"""Fixed schemas: the parse schema of a response page, the stored record table,
the run ledger and the request log. Never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
ARR = T.ArrayType(T.StringType())

# Parse schema of one OAI-PMH response page (root element OAI-PMH).
# Every Dublin Core element and the header's identifier/datestamp are declared
# as arrays so that callers can choose the first or the last occurrence.
HEADER = T.StructType([
    T.StructField("_status", S),
    T.StructField("identifier", ARR),
    T.StructField("datestamp", ARR),
    T.StructField("setSpec", ARR),
])
DUBLIN_CORE = T.StructType([
    T.StructField("title", ARR),
    T.StructField("creator", ARR),
    T.StructField("subject", ARR),
    T.StructField("description", ARR),
    T.StructField("date", ARR),
    T.StructField("type", ARR),
    T.StructField("identifier", ARR),
])
# The metadata's child elements by name, whatever they are called: each is read for Dublin Core.
RECORD_XML = T.StructType([
    T.StructField("header", HEADER),
    T.StructField("metadata", T.MapType(S, DUBLIN_CORE)),
])
PAGE_XML = T.StructType([
    T.StructField("responseDate", S),   # present in every OAI-PMH response
    T.StructField("ListRecords", T.StructType([
        T.StructField("record", T.ArrayType(RECORD_XML)),
        T.StructField("resumptionToken", T.StructType([
            T.StructField("_VALUE", S),
            T.StructField("_cursor", S),
            T.StructField("_completeListSize", S),
        ])),
    ])),
    T.StructField("error", T.StructType([
        T.StructField("_code", S),
        T.StructField("_VALUE", S),
    ])),
    # the server's echo of the request arguments
    T.StructField("request", T.StructType([
        T.StructField("_VALUE", S),
        T.StructField("_verb", S),
        T.StructField("_set", S),
        T.StructField("_from", S),
        T.StructField("_until", S),
        T.StructField("_metadataPrefix", S),
        T.StructField("_resumptionToken", S),
    ])),
    T.StructField("_corrupt_record", S),
])

# The stored metadata table: one row per header_identifier.
RECORD_COLUMNS = [
    "header_identifier",
    "header_datestamp",
    "header_setSpecs",
    "metadata_creator",
    "metadata_date",
    "metadata_description",
    "metadata_identifier",
    "metadata_subject",
    "metadata_title",
    "metadata_type",
]
# Columns replaced when an incoming record meets a stored one.
UPDATE_COLUMNS = RECORD_COLUMNS[1:]

RECORD = T.StructType([
    T.StructField("header_identifier", S, False),
    T.StructField("header_datestamp", T.TimestampNTZType()),
    T.StructField("header_setSpecs", ARR),
    T.StructField("metadata_creator", ARR),
    T.StructField("metadata_date", ARR),
    T.StructField("metadata_description", S),
    T.StructField("metadata_identifier", ARR),
    T.StructField("metadata_subject", ARR),
    T.StructField("metadata_title", ARR),
    T.StructField("metadata_type", S),
])
# When a stored row arrived: microseconds since 1970 (UTC), and the page and place it came from.
# Structs compare field by field, so the later arrival is the larger one.
ARRIVAL = T.StructType([
    T.StructField("at", T.LongType()),
    T.StructField("path", S),
    T.StructField("pos", T.LongType()),
])
TABLE = T.StructType(RECORD.fields + [
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("arrival", ARRIVAL),
    T.StructField("bucket", T.IntegerType()),
])

# Fixed column limits of the stored table.
MAX_IDENTIFIER_CHARS = 255
MAX_TYPE_CHARS = 100

LEDGER = T.StructType([
    T.StructField("run_id", S),
    T.StructField("set_spec", S),
    T.StructField("d", T.DateType()),
    T.StructField("n", T.LongType()),
    T.StructField("elapsed_s", T.DoubleType()),
])
REQUEST_LOG = T.StructType([
    T.StructField("client", S),
    T.StructField("request_id", S),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("status", T.IntegerType()),
])
REQUESTS = T.StructType([
    T.StructField("set_spec", S),
    T.StructField("from_date", T.DateType()),
    T.StructField("until_date", T.DateType()),
    T.StructField("chunk_no", T.LongType()),
    T.StructField("url", S),
])
