"""Landed OAI-PMH response pages: read, parse, classify, explode.

One row per page all the way to ``explode_records``: the XML parse is a
JVM-side ``from_xml`` per row, so pages parse in parallel across tasks and a
malformed page yields a status instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import array_len, empty_if_null
from ..schemas import DUBLIN_CORE, PAGE_XML

# Fixed values of the protocol: the error code a server answers with when a
# selective harvest matches nothing, and the page statuses we report.
NO_RECORDS_CODE = "noRecordsMatch"
STATUS_OK = "ok"
STATUS_NO_RECORDS = "no_records"
STATUS_MALFORMED = "malformed"
STATUS_ERROR = "error"

ARCHIVE_SCHEMA = "path string, landed_at timestamp, value string"
# a closing root tag that anything but white space, comments and instructions follows
ROOT_NOT_LAST = r"</(?:[\w.-]+:)?OAI-PMH\s*>(?!(?:\s++|<!--(?s:.*?)-->|<\?(?s:.*?)\?>)*+$)"
# An opening tag with its attributes, and the metadata element's with the text that follows it.
TAG = r'<(?:[^<>"]++|"[^"]*+")*+>'
METADATA_TAG = r"<((?:[\w.-]+:)?metadata)(?:\s[^<>]*?)?(/?)>[^<]*"
ESCAPED_LT = "&lt;|&#0*60;|&#[xX]0*3[cC];"
# A less-than sign that is text is spelt with this noncharacter while markup is told from text.
MARK = "\ufdd0"
XML_OPTIONS = {
    "ignoreNamespace": "true",          # <dc:title> and <title> both read as title
    "ignoreSurroundingSpaces": "false",  # keep values raw, as the DOM content is
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
}


def read_pages(spark: SparkSession, path: str | list[str],
               recursive: bool = True) -> DataFrame:
    """Every landed response file as one row ``(path, landed_at, value)``;
    ``landed_at`` is the file's modification time.

    Zero-length files give no row. ``recursive`` (default, as in the stream)
    reads every sub-folder and infers no partition columns from folder names.
    """
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    paths = [path] if isinstance(path, str) else list(path)
    df = reader.text(paths, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_modification_time").alias("landed_at"), "value")


def compact_pages(pages: DataFrame, out_path: str, pages_per_file: int = 2000,
                  mode: str = "append", merge: bool = True) -> None:
    """Archive landed pages as Parquet ``(path, landed_at, value)`` files of at
    most ``pages_per_file`` pages, so later runs list a few large files instead
    of one small file per response. Small scan tasks are merged by size (AQE's
    rebalance), and pages are in path order within a task's files. ``merge=False`` for pages
    whose tasks are sized already, as a shuffle's are: they are written where they are."""
    landed = F.col("landed_at") if "landed_at" in pages.columns else F.lit(None)
    rows = pages.select("path", landed.cast("timestamp").alias("landed_at"), "value")
    (rows.hint("rebalance") if merge else rows).sortWithinPartitions("path").write.mode(mode) \
        .option("compression", "zstd").option("maxRecordsPerFile", int(pages_per_file)).parquet(out_path)


def read_page_archive(spark: SparkSession, path: str) -> DataFrame:
    """Pages archived by ``compact_pages``: rows ``(path, landed_at, value)``."""
    return spark.read.schema(ARCHIVE_SCHEMA).parquet(path)


def _marked(value: Column) -> Column:
    """A page in which every ``<`` is markup: those that are text become ``MARK`` and "1", so
    child elements can be told from text that looks like them. The metadata elements lose
    attributes and stray text, which nothing reads."""
    def cdata(part: Column) -> Column:
        pieces = F.split(part, "]]>", 2)
        text = F.replace(F.replace(F.get(pieces, 0), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit(MARK + "1"))
        return F.when(F.size(pieces) == 2, F.concat(text, F.get(pieces, 1))).otherwise(F.concat(F.lit("<![CDATA["), part))

    v = F.replace(value, F.lit(MARK), F.lit(MARK + "0"))
    parts = F.split(v, r"<!\[CDATA\[", -1)
    plain = F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), cdata), ""))
    v = F.when(F.contains(v, F.lit("<![CDATA[")), plain).otherwise(v)
    return F.regexp_replace(F.regexp_replace(v, ESCAPED_LT, MARK + "1"), METADATA_TAG, "<$1$2>")


def _unmarked(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(MARK + "1"), F.lit("<")), F.lit(MARK + "0"), F.lit(MARK))


def _content(values: Column) -> Column:
    """The text content of elements that were read as strings: child tags go, their text stays."""
    return F.transform(values, lambda v: _unmarked(F.when(F.contains(v, F.lit("<")), F.regexp_replace(v, TAG, "")).otherwise(v)))


def _record(r: Column) -> Column:
    """One record with its text content, and as ``metadata.dc`` the Dublin Core elements of all
    the metadata's child elements."""
    h = r["header"]
    header = F.struct(_unmarked(h["_status"]).alias("_status"), *[_content(h[c]).alias(c) for c in ("identifier", "datestamp", "setSpec")])

    def values(name: str) -> Column:
        return _content(F.flatten(F.transform(F.map_values(r["metadata"]), lambda c: empty_if_null(c[name]))))

    dc = F.struct(*[values(name).alias(name) for name in DUBLIN_CORE.fieldNames()])
    return F.struct(F.when(h.isNotNull(), header).alias("header"), F.when(r["metadata"].isNotNull(), F.struct(dc.alias("dc"))).alias("metadata"))


def parse_pages(pages: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse each page. Drops the raw text, keeps every other column.

    Adds ``records`` (array of record structs), ``error_code``, ``error_text``,
    ``resumption_token``, ``token_cursor``, ``complete_list_size``, the echoed
    request arguments ``request_set``, ``request_from``, ``request_until``, ``request_token``,
    ``response_date`` and ``malformed`` (unparseable, XML that is not an
    OAI-PMH response, or anything but white space, comments and instructions after its root).
    A malformed page carries nothing else, however far the parser got: no records, no echoed
    arguments, no corrupt text.

    A record's ``metadata`` may hold elements of any name; the Dublin Core elements of each are
    read, as ``metadata.dc``. A value is its element's text content, child tags left out.
    """
    p = F.from_xml(_marked(F.col(value_col)), PAGE_XML, XML_OPTIONS)
    keep = [c for c in pages.columns if c != value_col]
    # unparseable, or well-formed XML that is no OAI-PMH response at all
    bad = (F.col("_p._corrupt_record").isNotNull() | F.col("_p").isNull()
           | (F.col("_p.responseDate").isNull() & F.col("_p.ListRecords").isNull()
              & F.col("_p.error").isNull()) | F.col("_more"))
    more = F.coalesce(F.regexp_like(F.col(value_col), F.lit(ROOT_NOT_LAST)), F.lit(False))
    # inline() of a one-element array: what the optimizer infers of the records cannot be pushed
    # below it, which would parse each page once more for every use of the parsed page
    once = F.inline(F.array(F.struct(p.alias("_p"), more.alias("_more"))))
    parsed = pages.select(*keep, once).select(*keep, bad.alias("malformed"), F.when(~bad, F.col("_p")).alias("_p"))
    # and once more for the records' text content
    records = F.inline(F.array(F.struct(F.transform("_p.ListRecords.record", _record).alias("records"))))
    return parsed.select("*", records).select(
        *keep,
        "records",
        _unmarked(F.col("_p.error._code")).alias("error_code"),
        _unmarked(F.col("_p.error._VALUE")).alias("error_text"),
        _unmarked(F.col("_p.ListRecords.resumptionToken._VALUE")).alias("resumption_token"),
        F.col("_p.ListRecords.resumptionToken._cursor").try_cast("bigint").alias("token_cursor"),
        F.col("_p.ListRecords.resumptionToken._completeListSize").try_cast("bigint")
         .alias("complete_list_size"),
        *[_unmarked(F.col(f"_p.request.{a}")).alias(c) for a, c in
          (("_set", "request_set"), ("_from", "request_from"), ("_until", "request_until"), ("_resumptionToken", "request_token"))],
        F.col("_p.responseDate").alias("response_date"),
        "malformed",
    )


def status_of() -> Column:
    """S4 rule as a column over ``parse_pages`` output."""
    n = array_len("records")
    return (F.when(F.col("malformed"), F.lit(STATUS_MALFORMED))
             .when(F.col("error_code") == F.lit(NO_RECORDS_CODE), F.lit(STATUS_NO_RECORDS))
             .when(F.col("error_code").isNotNull(), F.lit(STATUS_ERROR))
             .when(n > 0, F.lit(STATUS_OK))
             .otherwise(F.lit(STATUS_NO_RECORDS)))


def page_status(parsed: DataFrame) -> DataFrame:
    """Classify each parsed page: ok / no_records / malformed / error.

    Adds ``status`` and ``n_records`` (record elements on the page).
    """
    return parsed.withColumn("status", status_of()) \
                 .withColumn("n_records", array_len("records"))


def explode_records(parsed: DataFrame) -> DataFrame:
    """S3: one row per ``<record>`` with its position ``pos`` in the page.

    Pages without records (errors, malformed, empty lists) contribute nothing.
    """
    keep = [c for c in parsed.columns if c != "records"]
    return parsed.select(*keep, F.posexplode("records").alias("pos", "r"))
