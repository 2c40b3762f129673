"""Deterministic adapters from the driver's tables to this library's inputs.

The driver's tables hold no harvested metadata, so each input is derived from
them by a fixed rule that the SQL oracle repeats:

* ``records_v`` - one bibliographic record per ``documents`` row;
* ``pages_v``   - those records rendered as OAI-PMH pages of 20, plus extra
  ``noRecordsMatch``, malformed and cut-in pages (every document is still rendered
  whole into exactly one well-formed page);
* ``log_v``     - a request log from ``events``;
* ``ledger_v``  - a run ledger from ``events``;
* ``keyed_v``   - record-shaped rows from ``events`` keyed by user, split into a
  stored base and an incoming batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import number_rows

# Fixed rules of the adapters (the oracle SQL repeats them).
PAGE_SIZE = 20
DATESTAMP_BASE = "2024-01-01"
DATESTAMP_MULT = 7919
DATESTAMP_SPAN = 61
DELETED_MOD, DELETED_REM = 13, 5        # header status="deleted"
NO_ID_MOD, NO_ID_REM = 17, 3            # empty <identifier/>
BAD_DATE_MOD, BAD_DATE_REM = 29, 11     # datestamp 2024-02-30 (not a date)
BAD_DATESTAMP = "2024-02-30"
EMPTY_PAGE_MOD, EMPTY_PAGE_REM = 10, 8  # an extra noRecordsMatch page
BAD_PAGE_MOD, BAD_PAGE_REM = 10, 9      # an extra malformed copy of the page
JUNK_PAGE_MOD, JUNK_PAGE_REM = 10, 7    # an extra copy with text after the root element
OTHER_PAGE_MOD, OTHER_PAGE_REM = 10, 6  # an extra copy with another metadata container
REQUEST_PAGES = 5                       # pages that answer one request
LOST_MOD, LOST_REM, LOST_PAGE = 7, 3, 2  # requests whose third page issues a token nothing answers
REQUEST_FROM, REQUEST_UNTIL = "2024-01-01", "2024-03-01"
LANDED_EPOCH = 1717200000               # 2024-06-01 00:00:00 UTC; page p lands p seconds later
KEYED_SPLIT = "2024-01-15 00:00:00"
OAI_NS = "http://www.openarchives.org/OAI/2.0/"
OAI_DC_NS = "http://www.openarchives.org/OAI/2.0/oai_dc/"
DC_NS = "http://purl.org/dc/elements/1.1/"
RESPONSE_DATE = "2024-06-01T00:00:00Z"
NO_MATCH_TEXT = "No records match the request."


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def datestamp_text(doc_id: Column) -> Column:
    day = F.date_add(F.lit(DATESTAMP_BASE).cast("date"),
                     ((doc_id * DATESTAMP_MULT) % DATESTAMP_SPAN).cast("int"))
    return F.when(doc_id % BAD_DATE_MOD == BAD_DATE_REM, F.lit(BAD_DATESTAMP)) \
            .otherwise(F.date_format(day, "yyyy-MM-dd"))


def records_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per document, as the text values a page would carry."""
    d = table(spark, sf_dir, "documents")
    did = F.col("doc_id")
    return d.select(
        did,
        F.expr(f"doc_id div {PAGE_SIZE}").alias("page_no"),
        F.when(did % NO_ID_MOD == NO_ID_REM, F.lit(""))
         .otherwise(F.concat(F.lit("oai:doc:"), _s(did))).alias("identifier"),
        (did % DELETED_MOD == DELETED_REM).alias("deleted"),
        datestamp_text(did).alias("datestamp"),
        F.array(F.col("lang"), F.concat_ws(":", "lang", "source")).alias("sets"),
        F.substring_index(F.col("text"), "\n", 1).alias("title"),
        F.array(F.col("source")).alias("creators"),
        F.array(F.col("source"), F.col("lang")).alias("subjects"),
        F.array(F.col("text"), F.lit("Comment")).alias("descriptions"),
        F.array(F.concat(F.lit("doc:"), _s(did))).alias("dc_identifiers"),
        F.lit("text").alias("dc_type"),
        F.col("lang"), F.col("source"), F.col("text"),
    )


def xml_escape(c: Column) -> Column:
    """Escape ``& < >`` (and carriage return, which parsers would normalise)."""
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    out = F.replace(out, F.lit(">"), F.lit("&gt;"))
    return F.replace(out, F.lit("\r"), F.lit("&#13;"))


def _elements(tag: str, arr: Column) -> Column:
    return F.array_join(F.transform(arr, lambda v: F.concat(
        F.lit(f"<{tag}>"), xml_escape(v), F.lit(f"</{tag.split(' ')[0]}>"))), "")


def record_xml(r: DataFrame) -> DataFrame:
    """Render each record as one ``<record>`` element."""
    header = F.concat(
        F.when(F.col("deleted"), F.lit('<header status="deleted">')).otherwise(F.lit("<header>")),
        F.lit("<identifier>"), xml_escape(F.col("identifier")), F.lit("</identifier>"),
        F.lit("<datestamp>"), xml_escape(F.col("datestamp")), F.lit("</datestamp>"),
        _elements("setSpec", F.col("sets")),
        F.lit("</header>"),
    )
    meta = F.concat(
        F.lit(f'<metadata><oai_dc:dc xmlns:oai_dc="{OAI_DC_NS}" xmlns:dc="{DC_NS}">'),
        F.lit("<dc:title>"), xml_escape(F.col("title")), F.lit("</dc:title>"),
        _elements("dc:creator", F.col("creators")),
        _elements("dc:subject", F.col("subjects")),
        _elements("dc:description", F.col("descriptions")),
        F.lit("<dc:date>"), xml_escape(F.col("datestamp")), F.lit("</dc:date>"),
        F.lit("<dc:type>"), xml_escape(F.col("dc_type")), F.lit("</dc:type>"),
        _elements("dc:identifier", F.col("dc_identifiers")),
        F.lit("</oai_dc:dc></metadata>"),
    )
    body = F.concat(F.lit("<record>"), header,
                    F.when(F.col("deleted"), F.lit("")).otherwise(meta), F.lit("</record>"))
    return r.select("doc_id", "page_no", body.alias("xml"))


def _envelope(inner: Column, set_spec: Column) -> Column:
    return F.concat(
        F.lit(f'<?xml version="1.0" encoding="UTF-8"?><OAI-PMH xmlns="{OAI_NS}">'
              f"<responseDate>{RESPONSE_DATE}</responseDate>"
              f'<request verb="ListRecords" metadataPrefix="oai_dc" from="{REQUEST_FROM}"'
              f' until="{REQUEST_UNTIL}" set="'),
        set_spec, F.lit('">https://example.org/oai</request>'), inner, F.lit("</OAI-PMH>"))


def pages_v(spark: SparkSession, sf_dir: str, other_containers: bool = False) -> DataFrame:
    """Response pages ``(path, page_no, landed_at, value)``, from one pass over the documents.

    Records are grouped 20 to a page in ``doc_id`` order (a group is bounded by the page
    size), and five pages echo one request. Extra pages, by ``page_no % 10``: a
    ``noRecordsMatch`` answer next to every page with 8, a malformed copy (mismatched closing
    tag) of every page with 9, and a copy with text after its root element of every page with
    7; with ``other_containers`` also a copy whose metadata is in a container other than
    ``dc`` of every page with 6.
    """
    recs = record_xml(records_v(spark, sf_dir))
    no = F.col("page_no")
    kinds = [F.lit(""), F.when(no % EMPTY_PAGE_MOD == EMPTY_PAGE_REM, "-empty"),
             F.when(no % BAD_PAGE_MOD == BAD_PAGE_REM, "-bad"),
             F.when(no % JUNK_PAGE_MOD == JUNK_PAGE_REM, "-junk")]
    if other_containers:
        kinds.append(F.when(no % OTHER_PAGE_MOD == OTHER_PAGE_REM, "-other"))
    grouped = recs.groupBy("page_no").agg(
        F.array_sort(F.collect_list(F.struct("doc_id", "xml"))).alias("rs"))
    each = grouped.select("page_no", "rs", F.explode(F.array_compact(F.array(*kinds))).alias("kind"))
    records = F.array_join(F.transform(F.col("rs"), lambda x: x["xml"]), "")
    records = F.when(F.col("kind") != "-other", records).otherwise(F.replace(F.replace(
        records, F.lit("<oai_dc:dc "), F.lit("<oai_dc:other ")), F.lit("</oai_dc:dc>"), F.lit("</oai_dc:other>")))
    closing = F.when(F.col("kind") == "-bad", "</resumptionToken></ListRecordz>").otherwise(
        "</resumptionToken></ListRecords>")
    inner = F.when(F.col("kind") == "-empty", f'<error code="noRecordsMatch">{NO_MATCH_TEXT}</error>').otherwise(
        F.concat(F.lit("<ListRecords>"), records, F.lit('<resumptionToken cursor="'),
                 _s(no * PAGE_SIZE), F.lit('">'), _s(no + 1), closing))
    request = F.concat(F.lit("r"), _s(F.expr(f"page_no div {REQUEST_PAGES}")))
    junk = F.when(F.col("kind") == "-junk", " trailing text").otherwise("")
    return each.select(
        F.concat(F.lit("pages/p"), F.lpad(_s(no), 7, "0"), F.col("kind"), F.lit(".xml")).alias("path"),
        "page_no", F.timestamp_seconds(F.lit(LANDED_EPOCH) + no).alias("landed_at"),
        F.concat(_envelope(inner, request), junk).alias("value"))


def chained_pages_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as lists that resumption tokens lead through, five pages a request, with the
    landings a harvest of them leaves: ``(path, page_no, landed_at, value)``.

    A request's first page echoes its arguments, the others the token ``t|<page_no>`` they were
    asked with; all tell the size of the whole list, and the last page's token is empty. In
    every request whose number is 3 modulo 7 the third page issues a token that no page
    answers. Page p lands p minutes after the start. By ``page_no % 10``: an error lands 20
    seconds before every page with 3, three errors before every page with 2, one error two
    hours before every page with 1, and every page with 0 lands again a day later.
    """
    recs = record_xml(records_v(spark, sf_dir))
    no, req = F.col("page_no"), F.expr(f"page_no div {REQUEST_PAGES}")
    sizes = recs.groupBy(req.alias("req")).agg(F.count(F.lit(1)).alias("total"), F.max("page_no").alias("last_page"))
    grouped = recs.groupBy("page_no").agg(F.array_sort(F.collect_list(F.struct("doc_id", "xml"))).alias("rs")).withColumn(
        "req", req).join(sizes, "req")
    end = no == F.col("last_page")
    lost = (F.col("req") % LOST_MOD == LOST_REM) & (no % REQUEST_PAGES == LOST_PAGE)
    token = F.when(end, F.lit("")).otherwise(F.concat(F.when(lost, F.lit("lost|")).otherwise(F.lit("t|")), _s(no + 1)))
    echo = F.when(no % REQUEST_PAGES == 0, F.concat(F.lit(f'metadataPrefix="oai_dc" from="{REQUEST_FROM}" until="{REQUEST_UNTIL}" set="r'), _s(F.col("req")),
                                                    F.lit('"'))).otherwise(F.concat(F.lit('resumptionToken="t|'), _s(no), F.lit('"')))
    head = F.concat(F.lit(f'<OAI-PMH xmlns="{OAI_NS}"><responseDate>{RESPONSE_DATE}</responseDate><request verb="ListRecords" '), echo,
                    F.lit(">https://example.org/oai</request>"))
    body = F.concat(F.lit("<ListRecords>"), F.array_join(F.transform("rs", lambda x: x["xml"]), ""), F.lit('<resumptionToken completeListSize="'),
                    _s(F.col("total")), F.lit('" cursor="'), _s(no % REQUEST_PAGES * PAGE_SIZE), F.lit('">'), token, F.lit("</resumptionToken></ListRecords>"))
    landing = lambda kind, seconds: F.struct(F.lit(kind).alias("kind"), F.lit(seconds).alias("shift"))
    kinds = [landing("", 0)]
    for rem, copies in {3: [("-err1", -20)], 2: [("-err1", -60), ("-err2", -40), ("-err3", -20)], 1: [("-err1", -7200)], 0: [("-again", 86400)]}.items():
        kinds += [F.when(no % 10 == rem, landing(*c)) for c in copies]
    each = grouped.withColumn("landing", F.explode(F.array_compact(F.array(*kinds))))
    error = F.lit('<error code="badResumptionToken">busy</error>')
    return each.select(
        F.concat(F.lit("chains/p"), F.lpad(_s(no), 7, "0"), F.col("landing.kind"), F.lit(".xml")).alias("path"), "page_no",
        F.timestamp_seconds(F.lit(LANDED_EPOCH) + no * 60 + F.col("landing.shift")).alias("landed_at"),
        F.concat(head, F.when(F.contains("landing.kind", F.lit("err")), error).otherwise(body), F.lit("</OAI-PMH>")).alias("value"))


def stale_and_late(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Copies of pages that land at other times: an outdated one of every page with
    ``page_no % 10 = 6``, landed a day earlier under a path that sorts later, and, a day
    later, a corrected one of every page with 5 and an unchanged one of every page with 4."""
    def copy(rem: int, mark: str, suffix: str, days: int) -> DataFrame:
        return pages.where((F.col("page_no") % 10 == rem) & F.col("path").rlike(r"p[0-9]+\.xml$")).select(
            F.replace(F.col("path"), F.lit(".xml"), F.lit(suffix + ".xml")).alias("path"), "page_no",
            F.timestamp_seconds(F.lit(LANDED_EPOCH + 86400 * days) + F.col("page_no")).alias("landed_at"),
            F.replace(F.col("value"), F.lit("<dc:title>"), F.lit("<dc:title>" + mark)).alias("value"))

    return copy(6, "stale ", "_old", -1), copy(5, "late ", "_late", 1).unionByName(copy(4, "", "_again", 1))


def foreign_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's web pages as ``(page_id, kind, value)``: as they are, which is no
    response, and as the description of a response's only record."""
    html = F.coalesce(F.col("html"), F.lit(""))
    record = F.concat(
        F.lit(f'<ListRecords><record><metadata><oai_dc:dc xmlns:oai_dc="{OAI_DC_NS}" xmlns:dc="{DC_NS}"><dc:description>'),
        xml_escape(html), F.lit("</dc:description></oai_dc:dc></metadata></record></ListRecords>"))
    p = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("html"),
                                             F.explode(F.array(F.lit("raw"), F.lit("wrapped"))).alias("kind"))
    return p.select("page_id", "kind", F.when(F.col("kind") == "raw", F.col("html"))
                    .otherwise(_envelope(record, F.lit("web"))).alias("value"))


def log_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request log: one attempt per event. Client is the user; a request is
    the user's day; attempts are numbered in ``(ts, event_id)`` order;
    ``error`` events are 503 answers, the rest 200."""
    e = table(spark, sf_dir, "events")
    base = e.select(
        _s(F.col("user_id")).alias("client"),
        F.concat(_s(F.col("user_id")), F.lit("-"), _s(F.to_date("ts"))).alias("request_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id"),
        F.when(F.col("event_type") == "error", F.lit(503)).otherwise(F.lit(200)).alias("status"),
    )
    numbered = number_rows(base, ["request_id"], ["ts", "event_id"], out="attempt")
    return numbered.withColumn("attempt", F.col("attempt").cast("int"))


def ledger_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run ledger: one request outcome per event. Run is the event's day, set
    is the event type, ``n = -1`` (failed) for every third error, else
    ``event_id % 50``; elapsed seconds is the event's value."""
    e = table(spark, sf_dir, "events")
    failed = (F.col("event_type") == "error") & (F.col("event_id") % 3 == 0)
    return e.select(
        F.concat(F.lit("run-"), _s(F.to_date("ts"))).alias("run_id"),
        F.col("event_type").alias("set_spec"),
        F.to_date("ts").alias("d"),
        F.when(failed, F.lit(-1)).otherwise(F.col("event_id") % 50).cast("bigint").alias("n"),
        F.col("value").alias("elapsed_s"),
        F.col("event_id"),
    )


def keyed_v(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Record-shaped events keyed by ``'user:' || user_id``; ``(base, incoming)``
    split at 2024-01-15. Arrival order is ``(ts, event_id)``."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp_ntz")
    rows = e.select(
        F.concat(F.lit("user:"), _s(F.col("user_id"))).alias("header_identifier"),
        ts.alias("header_datestamp"),
        F.array(F.col("event_type")).alias("header_setSpecs"),
        F.array().cast("array<string>").alias("metadata_creator"),
        F.array(_s(F.to_date("ts"))).alias("metadata_date"),
        F.col("props").alias("metadata_description"),
        F.array(_s(F.col("event_id"))).alias("metadata_identifier"),
        F.array().cast("array<string>").alias("metadata_subject"),
        F.array(_s(F.col("value"))).alias("metadata_title"),
        F.col("event_type").alias("metadata_type"),
        ts.alias("ts"), F.col("event_id"),
    )
    split = F.lit(KEYED_SPLIT).cast("timestamp_ntz")
    return rows.filter(F.col("ts") < split), rows.filter(F.col("ts") >= split)
