"""The registered queries: one Spark plan per operator group, each with the
DuckDB SQL that computes the same rows from the driver's tables.

Every query reads whole tables (``documents`` or ``events``, or ``orders``)
through the adapters of ``adapters.py``; arrays are emitted as JSON text so
both engines print them alike.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import (backfill_bounds, day_range, harvest_date, parse_datestamp,
                               parse_iso_date, recent_window)
from ..functions.jsonfmt import array_to_json, json_to_array, safe_serialize, safe_serialize_array
from ..functions.text import collapse_ws, first_value, last_value
from ..operators.chains import page_attempts, token_chains
from ..operators.coverage import (chunk_dates, coverage_summary, date_difference, existing_dates,
                                  missing_any_set, missing_dates, records_in_sets, set_date_spine)
from ..operators.ledger import (assign_batches, batch_summary, harvest_summary, outcome_by_day, page_ledger,
                                pacing_audit, resolve_attempts, run_throughput)
from ..operators.merge import latest_per_key, match_existing, upsert
from ..operators.query import (date_between, in_set, list_records, query, select_where, set_like,
                               subject_contains)
from ..operators.records import accepted, clean_records, flatten_records, validate_records
from ..schemas import RECORD
from ..session import scratch_path, written
from ..sources.pages import (compact_pages, explode_records, page_status, parse_pages,
                             read_page_archive, read_pages)
from ..sources.table import compact_table, covered_days, ensure_table, merge_into, read_metadata, write_batches, write_set_batches
from ..streaming.harvest import land_pages, stream_harvest
from . import adapters as A
from .jobs import backfill_plan, both_plan

QueryFn = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------------------
# shared pieces

def parsed_pages(spark: SparkSession, sf: str) -> DataFrame:
    return parse_pages(A.pages_v(spark, sf))


def kept_records(spark: SparkSession, sf: str) -> DataFrame:
    """Pages -> records -> flatten -> has identifier -> not deleted."""
    return clean_records(explode_records(parsed_pages(spark, sf)))


# SQL fragments repeating the adapters' rules on ``documents``.
SQL_IDENT = "'oai:doc:' || CAST(doc_id AS VARCHAR)"
SQL_DAY = (f"(DATE '{A.DATESTAMP_BASE}' + "
           f"CAST((doc_id * {A.DATESTAMP_MULT}) % {A.DATESTAMP_SPAN} AS INTEGER))")
SQL_BAD_DATE = f"doc_id % {A.BAD_DATE_MOD} = {A.BAD_DATE_REM}"
SQL_DELETED = f"doc_id % {A.DELETED_MOD} = {A.DELETED_REM}"
SQL_NO_ID = f"doc_id % {A.NO_ID_MOD} = {A.NO_ID_REM}"
SQL_TS = f"CASE WHEN {SQL_BAD_DATE} THEN NULL ELSE CAST({SQL_DAY} AS TIMESTAMP) END"
SQL_KEPT = f"NOT ({SQL_DELETED}) AND NOT ({SQL_NO_ID})"
SQL_WS = r"trim(regexp_replace({x}, '\s+', ' ', 'g'))"
SQL_PAGE_NO = f"doc_id // {A.PAGE_SIZE}"
SQL_PAGE_PATH = f"'pages/p' || lpad(CAST({SQL_PAGE_NO} AS VARCHAR), 7, '0') || '.xml'"


# ---------------------------------------------------------------------------
# Parse pages into records

def q_parse_records(spark: SparkSession, sf: str) -> DataFrame:
    r = kept_records(spark, sf)
    return r.select(
        "header_identifier", "header_datestamp",
        array_to_json("header_setSpecs").alias("set_specs"),
        array_to_json("metadata_creator").alias("creators"),
        "title",
        F.col("metadata_description").alias("description"),
        "metadata_type",
        F.col("path").alias("page_path"),
        F.col("pos").cast("bigint").alias("pos"),
    )


SQL_PARSE_RECORDS = f"""
SELECT {SQL_IDENT} AS header_identifier,
       {SQL_TS} AS header_datestamp,
       to_json([lang, lang || ':' || source]) AS set_specs,
       to_json([source]) AS creators,
       {SQL_WS.format(x="split_part(text, chr(10), 1)")} AS title,
       {SQL_WS.format(x="text")} AS description,
       'text' AS metadata_type,
       {SQL_PAGE_PATH} AS page_path,
       CAST(row_number() OVER (PARTITION BY {SQL_PAGE_NO} ORDER BY doc_id) - 1 AS BIGINT) AS pos
FROM documents
QUALIFY {SQL_KEPT}
"""


def q_page_status(spark: SparkSession, sf: str) -> DataFrame:
    p = page_status(parsed_pages(spark, sf))
    return p.groupBy("status").agg(F.count(F.lit(1)).alias("n_pages"),
                                   F.sum("n_records").cast("bigint").alias("n_records"))


SQL_PAGE_STATUS = f"""
WITH pg AS (SELECT {SQL_PAGE_NO} AS page_no, count(*) AS n FROM documents GROUP BY 1)
SELECT 'ok' AS status, count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS n_records FROM pg
UNION ALL
SELECT 'no_records', count(*), CAST(0 AS BIGINT) FROM pg
WHERE page_no % {A.EMPTY_PAGE_MOD} = {A.EMPTY_PAGE_REM} HAVING count(*) > 0
UNION ALL
SELECT 'malformed', count(*), CAST(0 AS BIGINT) FROM pg
WHERE page_no % {A.BAD_PAGE_MOD} = {A.BAD_PAGE_REM} OR page_no % {A.JUNK_PAGE_MOD} = {A.JUNK_PAGE_REM}
HAVING count(*) > 0
"""


# ---------------------------------------------------------------------------
# The stored records (F8-accepted) and the coverage parameters.

SETS = ["en", "fr", "en:src1", "fr:src1"]
LO, HI = "2024-01-01", "2024-03-01"
AS_OF_RECENT = "2024-03-02"


def stored_records(spark: SparkSession, sf: str) -> DataFrame:
    return accepted(validate_records(kept_records(spark, sf)))


SQL_STORED = f"{SQL_KEPT} AND NOT ({SQL_BAD_DATE})"
SQL_SETS = "(VALUES ('en'), ('fr'), ('en:src1'), ('fr:src1')) s(set_spec)"
SQL_SPINE = ("(SELECT CAST(g.d AS DATE) AS d FROM generate_series(DATE '2024-01-01', "
             "DATE '2024-03-01', INTERVAL 1 DAY) g(d))")
SQL_HAVE = f"""(SELECT DISTINCT s.set_spec, CAST({SQL_DAY} AS DATE) AS d
  FROM documents JOIN {SQL_SETS} ON s.set_spec IN (lang, lang || ':' || source)
  WHERE {SQL_STORED} AND {SQL_DAY} BETWEEN DATE '2024-01-01' AND DATE '2024-03-01')"""
SQL_MISSING = f"""(SELECT s.set_spec, sp.d FROM {SQL_SETS} CROSS JOIN {SQL_SPINE} sp
  WHERE NOT EXISTS (SELECT 1 FROM {SQL_HAVE} h WHERE h.set_spec = s.set_spec AND h.d = sp.d))"""
SQL_URL = ("'https://example.org/oai?verb=ListRecords&metadataPrefix=oai_dc&set=' || {s} || "
           "'&from=' || strftime({f}, '%Y-%m-%d') || '&until=' || strftime({u}, '%Y-%m-%d')")


# Backfill request plan
def q_build_requests(spark: SparkSession, sf: str) -> DataFrame:
    return backfill_plan(stored_records(spark, sf), SETS, LO, HI)


SQL_BUILD_REQUESTS = f"""
SELECT set_spec, d AS from_date, d AS until_date,
       CAST((row_number() OVER (PARTITION BY set_spec ORDER BY d) - 1) // 7 AS BIGINT) AS chunk_no,
       {SQL_URL.format(s='set_spec', f='d', u='d')} AS url
FROM {SQL_MISSING} m
"""


# P2
def q_collapse_ws(spark: SparkSession, sf: str) -> DataFrame:
    d = A.table(spark, sf, "documents")
    ws = collapse_ws("text")
    return d.select("doc_id", ws.alias("text_ws"), F.length(ws).cast("bigint").alias("n_chars_ws"))


SQL_COLLAPSE_WS = f"""
SELECT doc_id, {SQL_WS.format(x='text')} AS text_ws,
       CAST(length({SQL_WS.format(x='text')}) AS BIGINT) AS n_chars_ws
FROM documents
"""


# P3, P4
def q_first_last_value(spark: SparkSession, sf: str) -> DataFrame:
    d = A.table(spark, sf, "documents")
    lines = F.split(F.col("text"), "\n", -1)
    longs = F.filter(lines, lambda x: F.length(x) > 200)
    return d.select("doc_id",
                    first_value(lines).alias("first_line"), last_value(lines).alias("last_line"),
                    first_value(longs).alias("first_long"), last_value(longs).alias("last_long"),
                    F.size(lines).cast("bigint").alias("n_lines"))


SQL_FIRST_LAST_VALUE = """
SELECT doc_id, ls[1] AS first_line, ls[-1] AS last_line,
       lg[1] AS first_long, lg[-1] AS last_long, CAST(len(ls) AS BIGINT) AS n_lines
FROM (SELECT doc_id, string_split(text, chr(10)) AS ls,
             list_filter(string_split(text, chr(10)), lambda x: length(x) > 200) AS lg
      FROM documents)
"""


# P5, P8
def q_array_to_json(spark: SparkSession, sf: str) -> DataFrame:
    r = kept_records(spark, sf)
    return r.select("header_identifier",
                    array_to_json("header_setSpecs").alias("sets_json"),
                    array_to_json("metadata_subject").alias("subjects_json"),
                    safe_serialize_array("metadata_date").alias("dates_json"),
                    array_to_json("metadata_identifier").alias("ids_json"),
                    array_to_json(F.lit(None).cast("array<string>")).alias("none_json"))


SQL_ARRAY_TO_JSON = f"""
SELECT {SQL_IDENT} AS header_identifier,
       to_json([lang, lang || ':' || source]) AS sets_json,
       to_json([source, lang]) AS subjects_json,
       to_json([CASE WHEN {SQL_BAD_DATE} THEN '{A.BAD_DATESTAMP}'
                     ELSE strftime({SQL_DAY}, '%Y-%m-%d') END])
         AS dates_json,
       to_json(['doc:' || CAST(doc_id AS VARCHAR)]) AS ids_json,
       '[]' AS none_json
FROM documents WHERE {SQL_KEPT}
"""


# P6
def q_json_to_array(spark: SparkSession, sf: str) -> DataFrame:
    e = A.table(spark, sf, "events")
    mixed = F.concat(F.lit("["), F.col("props"), F.lit(', "'), F.col("event_type"), F.lit('", '),
                     F.col("user_id").cast("string"), F.lit(', null, "u'),
                     F.col("user_id").cast("string"), F.lit('"]'))
    return e.select("event_id",
                    array_to_json(json_to_array(mixed)).alias("strings_json"),
                    array_to_json(json_to_array("props")).alias("object_json"),
                    array_to_json(json_to_array(F.col("event_type"))).alias("bad_json"))


SQL_JSON_TO_ARRAY = """
SELECT event_id,
       to_json(list_filter(list_transform(
           CAST(json_extract(j, '$[*]') AS JSON[]), lambda x: CASE WHEN json_type(x) = 'VARCHAR'
                                                                  THEN x ->> '$' END),
           lambda x: x IS NOT NULL)) AS strings_json,
       '[]' AS object_json, '[]' AS bad_json
FROM (SELECT event_id, '[' || props || ', "' || event_type || '", ' || CAST(user_id AS VARCHAR)
             || ', null, "u' || CAST(user_id AS VARCHAR) || '"]' AS j FROM events)
"""


# P7
def q_safe_serialize(spark: SparkSession, sf: str) -> DataFrame:
    e = A.table(spark, sf, "events").select(
        F.lit("events").alias("src"), F.col("event_id").alias("id"),
        safe_serialize("props").alias("serialized"))
    d = A.table(spark, sf, "documents").select(
        F.lit("documents").alias("src"), F.col("doc_id").alias("id"),
        safe_serialize("text").alias("serialized"))
    return e.unionByName(d)


SQL_SAFE_SERIALIZE = """
SELECT 'events' AS src, event_id AS id,
       CASE WHEN json_valid(props) THEN CAST(json(props) AS VARCHAR) ELSE to_json(props) END
         AS serialized
FROM events
UNION ALL
SELECT 'documents', doc_id,
       CASE WHEN json_valid(text) THEN CAST(json(text) AS VARCHAR) ELSE CAST(to_json(text) AS VARCHAR) END
FROM documents
"""


# P7, as it is written: numbers of any length, key order and repeated keys stay
def q_serialize_exact(spark: SparkSession, sf: str) -> DataFrame:
    e = A.table(spark, sf, "events")
    digits = F.lpad(F.col("event_id").cast("string"), 60, "7")
    text = F.concat(F.lit(' { "id" : '), digits, F.lit(' ,\n "z  z" : '), F.col("props"), F.lit(', "id" : [ 1.50, 1e3 ] }'),
                    F.when(F.col("event_id") % 3 == 0, F.lit(" trailing")).otherwise(F.lit("")))
    return e.select("event_id", safe_serialize(text, preserve=True).alias("serialized"))


SQL_SERIALIZE_EXACT = """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(to_json(' { "id" : ' || digits || ' ,' || chr(10) || ' "z  z" : ' || props || ', "id" : [ 1.50, 1e3 ] } trailing') AS VARCHAR)
       ELSE '{"id":' || digits || ',"z  z":' || replace(props, ' ', '') || ',"id":[1.50,1e3]}' END AS serialized
FROM (SELECT event_id, props, lpad(CAST(event_id AS VARCHAR), 60, '7') AS digits FROM events)
"""


# P9-P14
def q_date_scalars(spark: SparkSession, sf: str) -> DataFrame:
    e = A.table(spark, sf, "events")
    d = harvest_date("ts")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    loose = F.concat_ws("-", F.year("ts"), F.month("ts"), F.dayofmonth("ts"))
    lo, hi = day_range(d, legacy=True)
    rf, ru = recent_window(d)
    bf_lo, bf_hi = backfill_bounds(None, None, d)
    return e.select("event_id", d.alias("d"),
                    parse_datestamp(stamp).alias("stamp_ts"),
                    parse_datestamp(F.date_format("ts", "yyyy-MM-dd")).alias("day_ts"),
                    parse_iso_date(F.date_format("ts", "yyyy-MM-dd")).alias("iso_ok"),
                    parse_iso_date(loose).alias("iso_loose"),
                    hi.alias("legacy_until"),
                    rf.alias("recent_from"), ru.alias("recent_until"),
                    bf_lo.alias("backfill_from"), bf_hi.alias("backfill_until"))


SQL_DATE_SCALARS = r"""
SELECT event_id, CAST(ts AS DATE) AS d,
       date_trunc('second', ts) AS stamp_ts,
       CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day_ts,
       CAST(ts AS DATE) AS iso_ok,
       CASE WHEN regexp_full_match(loose, '\d{4}-\d{2}-\d{2}') THEN TRY_CAST(loose AS DATE) END
         AS iso_loose,
       CAST(ts AS DATE) + 1 AS legacy_until,
       CAST(ts AS DATE) - 2 AS recent_from, CAST(ts AS DATE) - 1 AS recent_until,
       DATE '2007-01-01' AS backfill_from, CAST(ts AS DATE) - 1 AS backfill_until
FROM (SELECT *, CAST(year(ts) AS VARCHAR) || '-' || CAST(month(ts) AS VARCHAR) || '-'
                || CAST(day(ts) AS VARCHAR) AS loose FROM events)
"""


# F3, F4
def q_set_exact(spark: SparkSession, sf: str) -> DataFrame:
    r = stored_records(spark, sf).filter(in_set("fr:src1"))
    return r.select("header_identifier", array_to_json("header_setSpecs").alias("set_specs"))


def q_set_like(spark: SparkSession, sf: str) -> DataFrame:
    r = stored_records(spark, sf).filter(set_like("fr:src1"))
    return r.select("header_identifier", array_to_json("header_setSpecs").alias("set_specs"))


SQL_SET_EXACT = f"""
SELECT {SQL_IDENT} AS header_identifier, to_json([lang, lang || ':' || source]) AS set_specs
FROM documents WHERE {SQL_STORED} AND list_contains([lang, lang || ':' || source], 'fr:src1')
"""
SQL_SET_LIKE = f"""
SELECT {SQL_IDENT} AS header_identifier, to_json([lang, lang || ':' || source]) AS set_specs
FROM documents WHERE {SQL_STORED} AND CAST(to_json([lang, lang || ':' || source]) AS VARCHAR)
      LIKE '%fr:src1%'
"""


# F5, F6, F7, F9
def q_list_records(spark: SparkSession, sf: str) -> DataFrame:
    r = list_records(stored_records(spark, sf), "en", "2024-01-10", "2024-01-20")
    return r.select("header_identifier", "header_datestamp", "title")


SQL_LIST_RECORDS = f"""
SELECT {SQL_IDENT} AS header_identifier, CAST({SQL_DAY} AS TIMESTAMP) AS header_datestamp,
       {SQL_WS.format(x="split_part(text, chr(10), 1)")} AS title
FROM documents
WHERE {SQL_STORED} AND lang = 'en' AND {SQL_DAY} BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
"""


def q_subject_lookup(spark: SparkSession, sf: str) -> DataFrame:
    r = select_where(stored_records(spark, sf), subject_contains("src3"),
                     date_between("2024-01-01", "2024-02-15"))
    return r.select("header_identifier", array_to_json("metadata_subject").alias("subjects"))


SQL_SUBJECT_LOOKUP = f"""
SELECT {SQL_IDENT} AS header_identifier, to_json([source, lang]) AS subjects
FROM documents
WHERE {SQL_STORED} AND source = 'src3' AND {SQL_DAY} BETWEEN DATE '2024-01-01' AND DATE '2024-02-15'
"""


# F1, F2, F8
def q_validate_records(spark: SparkSession, sf: str) -> DataFrame:
    pages = parse_pages(A.pages_v(spark, sf, other_containers=True))
    r = validate_records(flatten_records(explode_records(pages)))
    return r.select("header_identifier", F.col("path").alias("page_path"),
                    F.col("pos").cast("bigint").alias("pos"), "accepted",
                    F.array_join("reasons", ",").alias("reasons"), "title", array_to_json("metadata_subject").alias("subjects"))


# a copy of some pages keeps its metadata in a container of another name, which is read as well
SQL_VALIDATE_RECORDS = f"""
WITH r AS (
  SELECT doc_id, text, lang, source, {SQL_PAGE_NO} AS page_no, {SQL_PAGE_PATH} AS page_path,
         CAST(row_number() OVER (PARTITION BY {SQL_PAGE_NO} ORDER BY doc_id) - 1 AS BIGINT) AS pos,
         false AS other
  FROM documents),
both_kinds AS (
  SELECT * FROM r
  UNION ALL
  SELECT doc_id, text, lang, source, page_no, replace(page_path, '.xml', '-other.xml'), pos, true FROM r
  WHERE page_no % {A.OTHER_PAGE_MOD} = {A.OTHER_PAGE_REM})
SELECT CASE WHEN {SQL_NO_ID} THEN '' ELSE {SQL_IDENT} END AS header_identifier, page_path, pos,
       NOT ({SQL_NO_ID} OR {SQL_BAD_DATE} OR {SQL_DELETED}) AS accepted,
       concat_ws(',', CASE WHEN {SQL_NO_ID} THEN 'missing_identifier' END,
                      CASE WHEN {SQL_BAD_DATE} THEN 'bad_datestamp' END,
                      CASE WHEN {SQL_DELETED} THEN 'deleted' END) AS reasons,
       CASE WHEN NOT ({SQL_DELETED}) THEN {SQL_WS.format(x="split_part(text, chr(10), 1)")} END AS title,
       CASE WHEN {SQL_DELETED} THEN '[]' ELSE CAST(to_json([source, lang]) AS VARCHAR) END AS subjects
FROM both_kinds
"""


# A top-k report
def q_query_topk(spark: SparkSession, sf: str) -> DataFrame:
    o = A.table(spark, sf, "orders")
    return query(o, where=[F.col("o_orderstatus") == "F", F.col("o_totalprice") > 100000],
                 order_col="o_totalprice", asc=False, limit=100, tie_break=["o_orderkey"])


SQL_QUERY_TOPK = """
SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000
ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 100
"""


# A1, J3
def q_existing_dates(spark: SparkSession, sf: str) -> DataFrame:
    return existing_dates(stored_records(spark, sf), SETS, LO, HI)


SQL_EXISTING_DATES = f"SELECT set_spec, d FROM {SQL_HAVE} h"


def q_records_in_sets(spark: SparkSession, sf: str) -> DataFrame:
    r = records_in_sets(stored_records(spark, sf), SETS, match="substring")
    return r.groupBy("set_spec").agg(F.count(F.lit(1)).alias("n_records"))


SQL_RECORDS_IN_SETS = f"""
SELECT s.set_spec, count(*) AS n_records
FROM documents JOIN {SQL_SETS}
  ON contains(CAST(to_json([lang, lang || ':' || source]) AS VARCHAR), s.set_spec)
WHERE {SQL_STORED} GROUP BY s.set_spec
"""


# A2
def q_coverage_summary(spark: SparkSession, sf: str) -> DataFrame:
    return coverage_summary(stored_records(spark, sf), SETS, LO, HI)


SQL_COVERAGE_SUMMARY = f"""
SELECT s.set_spec, count(*) AS total_days, count(h.d) AS existing_days,
       count(*) - count(h.d) AS missing_days
FROM {SQL_SETS} CROSS JOIN {SQL_SPINE} sp
LEFT JOIN {SQL_HAVE} h ON h.set_spec = s.set_spec AND h.d = sp.d
GROUP BY s.set_spec
"""


# A2 with the requested sets taken from the data (a DataFrame of every set seen)
def q_coverage_all_sets(spark: SparkSession, sf: str) -> DataFrame:
    recs = stored_records(spark, sf)
    sets = recs.select(F.explode("header_setSpecs").alias("set_spec")).distinct()
    return coverage_summary(recs, sets, LO, HI)


SQL_COVERAGE_ALL_SETS = f"""
WITH rec AS (SELECT lang, source, CAST({SQL_DAY} AS DATE) AS d FROM documents WHERE {SQL_STORED}),
sets AS (SELECT DISTINCT lang AS set_spec FROM rec
         UNION SELECT DISTINCT lang || ':' || source FROM rec),
have AS (SELECT DISTINCT s.set_spec, rec.d FROM rec JOIN sets s
           ON s.set_spec IN (rec.lang, rec.lang || ':' || rec.source)
         WHERE rec.d BETWEEN DATE '{LO}' AND DATE '{HI}')
SELECT s.set_spec, count(*) AS total_days, count(h.d) AS existing_days,
       count(*) - count(h.d) AS missing_days
FROM sets s CROSS JOIN {SQL_SPINE} sp
LEFT JOIN have h ON h.set_spec = s.set_spec AND h.d = sp.d
GROUP BY s.set_spec
"""


# J1, J2
def q_missing_dates(spark: SparkSession, sf: str) -> DataFrame:
    return missing_dates(stored_records(spark, sf), SETS, LO, HI)


SQL_MISSING_DATES = f"SELECT set_spec, d FROM {SQL_MISSING} m"


# J5
def q_missing_any_set(spark: SparkSession, sf: str) -> DataFrame:
    return missing_any_set(stored_records(spark, sf), "2023-12-01", "2024-03-15")


SQL_MISSING_ANY_SET = f"""
SELECT CAST(g.d AS DATE) AS d
FROM generate_series(DATE '2023-12-01', DATE '2024-03-15', INTERVAL 1 DAY) g(d)
WHERE CAST(g.d AS DATE) NOT IN (SELECT {SQL_DAY} FROM documents WHERE {SQL_STORED})
"""


# U2
def q_date_difference(spark: SparkSession, sf: str) -> DataFrame:
    all_days = set_date_spine(spark, ["fr"], LO, HI).select("d")
    have = existing_dates(stored_records(spark, sf), ["fr"], LO, HI).select("d")
    return date_difference(all_days, have)


SQL_DATE_DIFFERENCE = f"""
SELECT d FROM {SQL_SPINE} sp
EXCEPT ALL
SELECT d FROM {SQL_HAVE} h WHERE set_spec = 'fr'
"""


# W2
def q_chunk_dates(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_dates(missing_dates(stored_records(spark, sf), SETS, LO, HI), 7)


SQL_CHUNK_DATES = f"""
SELECT set_spec, d,
       CAST((row_number() OVER (PARTITION BY set_spec ORDER BY d) - 1) // 7 AS BIGINT) AS chunk_no,
       CAST((row_number() OVER (PARTITION BY set_spec ORDER BY d) - 1) % 7 AS INTEGER) AS chunk_pos
FROM {SQL_MISSING} m
"""


# J4, W3, K1 on record-shaped events keyed by user
AS_OF_BASE, AS_OF_INCOMING = "2024-01-15 00:00:00", "2024-02-01 00:00:00"
SEQ = ["ts", "event_id"]


def _keyed_state(spark: SparkSession, sf: str) -> DataFrame:
    base, incoming = A.keyed_v(spark, sf)
    empty = spark.createDataFrame([], RECORD).withColumn(
        "created_at", F.lit(None).cast("timestamp_ntz")).withColumn(
        "updated_at", F.lit(None).cast("timestamp_ntz"))
    state = upsert(empty, base, AS_OF_BASE, seq=SEQ)
    return upsert(state, incoming, AS_OF_INCOMING, seq=SEQ)


def _state_out(df: DataFrame) -> DataFrame:
    return df.select("header_identifier", "header_datestamp", "metadata_type",
                     array_to_json("metadata_identifier").alias("metadata_identifier"),
                     "created_at", "updated_at")


def q_match_existing(spark: SparkSession, sf: str) -> DataFrame:
    base, incoming = A.keyed_v(spark, sf)
    inc = latest_per_key(incoming, SEQ)
    return match_existing(base, inc).select("header_identifier", "action")


def q_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    base, incoming = A.keyed_v(spark, sf)
    r = latest_per_key(base.unionByName(incoming), SEQ)
    return r.select("header_identifier", "header_datestamp", "event_id", "metadata_type")


def q_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _state_out(_keyed_state(spark, sf))


def q_write_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    base, incoming = A.keyed_v(spark, sf)
    path = scratch_path(spark, "metadata")
    ensure_table(spark, path, 16)
    merge_into(spark, path, base, AS_OF_BASE, SEQ, num_buckets=16)
    merge_into(spark, path, incoming, AS_OF_INCOMING, SEQ, num_buckets=16)
    compact_table(spark, path, 16, max_files=1)          # row content must be unchanged
    return _state_out(read_metadata(spark, path))


# K4: the batch files read back, and whether the file a row is in keeps to the size
def q_write_batches(spark: SparkSession, sf: str) -> DataFrame:
    base, incoming = A.keyed_v(spark, sf)
    path = scratch_path(spark, "batches")
    write_batches(latest_per_key(base.unionByName(incoming), SEQ).select(*RECORD.fieldNames()), path, size=20)
    back = spark.read.schema(RECORD).parquet(path).select("*", F.col("_metadata.file_path").alias("file"))
    sizes = back.groupBy("file").agg((F.count("*") <= 20).alias("fits"))
    return back.join(sizes, "file").select("header_identifier", "header_datestamp", "metadata_type", "fits")


SQL_KEYED = """
ev AS (SELECT 'user:' || CAST(user_id AS VARCHAR) AS k, ts, event_id, event_type FROM events),
lb AS (SELECT * FROM ev WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
       QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts DESC, event_id DESC) = 1),
li AS (SELECT * FROM ev WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
       QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts DESC, event_id DESC) = 1)
"""
SQL_MATCH_EXISTING = f"""
WITH {SQL_KEYED}
SELECT li.k AS header_identifier,
       CASE WHEN EXISTS (SELECT 1 FROM lb WHERE lb.k = li.k) THEN 'update' ELSE 'insert' END AS action
FROM li
"""
SQL_LATEST_PER_KEY = f"""
WITH {SQL_KEYED}
SELECT k AS header_identifier, ts AS header_datestamp, event_id, event_type AS metadata_type FROM ev
QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts DESC, event_id DESC) = 1
"""
SQL_WRITE_BATCHES = f"""
SELECT header_identifier, header_datestamp, metadata_type, true AS fits FROM ({SQL_LATEST_PER_KEY}) latest
"""
SQL_UPSERT = f"""
WITH {SQL_KEYED}
SELECT coalesce(li.k, lb.k) AS header_identifier,
       coalesce(li.ts, lb.ts) AS header_datestamp,
       coalesce(li.event_type, lb.event_type) AS metadata_type,
       to_json([CAST(coalesce(li.event_id, lb.event_id) AS VARCHAR)]) AS metadata_identifier,
       CASE WHEN lb.k IS NOT NULL THEN TIMESTAMP '2024-01-15 00:00:00'
            ELSE TIMESTAMP '2024-02-01 00:00:00' END AS created_at,
       CASE WHEN li.k IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00'
            ELSE TIMESTAMP '2024-01-15 00:00:00' END AS updated_at
FROM lb FULL OUTER JOIN li ON lb.k = li.k
"""


# Batches of a harvest, per first set (the language), 20 to a batch
BATCH = 20


def _harvest_rows(spark: SparkSession, sf: str) -> DataFrame:
    r = kept_records(spark, sf)
    return r.select("header_identifier", "path", "pos",
                    first_value("header_setSpecs").alias("set_spec"))


def q_assign_batches(spark: SparkSession, sf: str) -> DataFrame:
    b = assign_batches(_harvest_rows(spark, sf), ["path", "pos"], "set_spec", BATCH)
    return b.select("header_identifier", "set_spec", "row_no", "batch_no")


SQL_ASSIGN_BATCHES = f"""
SELECT header_identifier, set_spec, row_no, CAST((row_no - 1) // {BATCH} AS BIGINT) AS batch_no
FROM (SELECT {SQL_IDENT} AS header_identifier, lang AS set_spec,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS row_no
      FROM documents WHERE {SQL_KEPT})
"""


def q_batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return batch_summary(_harvest_rows(spark, sf), "set_spec", BATCH)


SQL_BATCH_SUMMARY = f"""
SELECT set_spec, n_records, CAST(ceil(n_records / {BATCH}) AS BIGINT) AS n_batches,
       CAST(n_records - (ceil(n_records / {BATCH}) - 1) * {BATCH} AS BIGINT) AS last_batch_size
FROM (SELECT lang AS set_spec, count(*) AS n_records FROM documents WHERE {SQL_KEPT} GROUP BY lang)
"""


# W4, A6 on the request log
SQL_LOG = """
log AS (SELECT CAST(user_id AS VARCHAR) AS client,
               CAST(user_id AS VARCHAR) || '-' || strftime(CAST(ts AS DATE), '%Y-%m-%d') AS request_id,
               ts, event_id, CASE WHEN event_type = 'error' THEN 503 ELSE 200 END AS status,
               CAST(row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                       ORDER BY ts, event_id) AS INTEGER) AS attempt
        FROM events)
"""


def q_pacing_audit(spark: SparkSession, sf: str) -> DataFrame:
    p = pacing_audit(A.log_v(spark, sf), delay_ms=3000)
    return p.select("client", "request_id", "attempt", "wait_us", "violation")


SQL_PACING_AUDIT = f"""
WITH {SQL_LOG}
SELECT client, request_id, attempt, wait_us, wait_us > 0 AS violation
FROM (SELECT client, request_id, attempt,
             CAST(CASE WHEN prev IS NULL THEN 0
                       ELSE greatest(0, 3000000 - (epoch_us(ts) - epoch_us(prev))) END AS BIGINT)
               AS wait_us
      FROM (SELECT *, lag(ts) OVER (PARTITION BY client ORDER BY ts, request_id, attempt) AS prev
            FROM log))
"""


def q_resolve_attempts(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_attempts(A.log_v(spark, sf), max_retries=3)


SQL_RESOLVE_ATTEMPTS = f"""
WITH {SQL_LOG},
w AS (SELECT client, request_id,
             min(attempt) FILTER (WHERE attempt <= 3 AND status < 400) AS t_att,
             max(attempt) FILTER (WHERE attempt <= 3) AS l_att
      FROM log GROUP BY client, request_id)
SELECT w.client, w.request_id, l.status < 400 AS succeeded,
       coalesce(t_att, l_att) AS attempts_used, l.status AS last_status
FROM w JOIN log l ON l.client = w.client AND l.request_id = w.request_id
                 AND l.attempt = coalesce(t_att, l_att)
"""


# A3, A4, A7 on the run ledger
def q_harvest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return harvest_summary(A.ledger_v(spark, sf), ["run_id"])


SQL_LEDGER = """
led AS (SELECT 'run-' || strftime(CAST(ts AS DATE), '%Y-%m-%d') AS run_id, event_type AS set_spec,
               CAST(ts AS DATE) AS d,
               CAST(CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN -1 ELSE event_id % 50 END
                    AS BIGINT) AS n,
               value AS elapsed_s
        FROM events)
"""
SQL_HARVEST_SUMMARY = f"""
WITH {SQL_LEDGER}
SELECT run_id, count(*) AS sets_processed, count(*) FILTER (WHERE n >= 0) AS successful,
       count(*) FILTER (WHERE n < 0) AS failed,
       CAST(coalesce(sum(greatest(n, 0)), 0) AS BIGINT) AS total_records
FROM led GROUP BY run_id
"""


def q_throughput(spark: SparkSession, sf: str) -> DataFrame:
    t = run_throughput(A.ledger_v(spark, sf), ["run_id"])
    return t.select("run_id", "total_records", F.round("elapsed_s", 6).alias("elapsed_s"),
                    "records_per_minute")


SQL_THROUGHPUT = f"""
WITH {SQL_LEDGER}
SELECT run_id, CAST(coalesce(sum(greatest(n, 0)), 0) AS BIGINT) AS total_records,
       round(sum(elapsed_s), 6) AS elapsed_s,
       round(CASE WHEN sum(elapsed_s) > 0 THEN coalesce(sum(greatest(n, 0)), 0) * 60.0 / sum(elapsed_s)
                  ELSE 0.0 END, 2) AS records_per_minute
FROM led GROUP BY run_id
"""


def q_outcome_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return outcome_by_day(A.ledger_v(spark, sf))


SQL_OUTCOME_BY_DAY = f"""
WITH {SQL_LEDGER}
SELECT set_spec, d, count(*) AS requests,
       CAST(coalesce(sum(greatest(n, 0)), 0) AS BIGINT) AS records,
       count(*) FILTER (WHERE n < 0) AS failures,
       CASE WHEN count(*) FILTER (WHERE n < 0) > 0 THEN 'failed'
            WHEN coalesce(sum(greatest(n, 0)), 0) = 0 THEN 'none' ELSE 'some' END AS outcome
FROM led GROUP BY set_spec, d
"""


# The ledger of landed pages: five pages echo one request; a malformed page is one of its own
def q_page_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return page_ledger(parsed_pages(spark, sf), "run")


SQL_PAGE_LEDGER = f"""
WITH pg AS (SELECT {SQL_PAGE_NO} AS page_no, {SQL_PAGE_PATH} AS page,
                   count(*) FILTER (WHERE {SQL_STORED}) AS n FROM documents GROUP BY 1, 2)
SELECT 'run' AS run_id, 'r' || CAST(page_no // {A.REQUEST_PAGES} AS VARCHAR) AS set_spec,
       DATE '{A.REQUEST_FROM}' AS d, CAST(NULL AS VARCHAR) AS page, CAST(sum(n) AS BIGINT) AS n,
       false AS failed, CAST(max(page_no) - min(page_no) AS DOUBLE) AS elapsed_s
FROM pg GROUP BY page_no // {A.REQUEST_PAGES}
UNION ALL
SELECT 'run', NULL, NULL, replace(page, '.xml', '-bad.xml'), 0, true, 0.0 FROM pg
WHERE page_no % {A.BAD_PAGE_MOD} = {A.BAD_PAGE_REM}
UNION ALL
SELECT 'run', NULL, NULL, replace(page, '.xml', '-junk.xml'), 0, true, 0.0 FROM pg
WHERE page_no % {A.JUNK_PAGE_MOD} = {A.JUNK_PAGE_REM}
"""


# A3, A4 on the ledger of landed pages
def q_page_throughput(spark: SparkSession, sf: str) -> DataFrame:
    return run_throughput(page_ledger(parsed_pages(spark, sf), "run"))


SQL_PAGE_THROUGHPUT = f"""
WITH led AS ({SQL_PAGE_LEDGER})
SELECT run_id, count(*) AS sets_processed, count(*) FILTER (WHERE NOT failed) AS successful,
       count(*) FILTER (WHERE failed) AS failed, CAST(sum(n) AS BIGINT) AS total_records,
       sum(elapsed_s) AS elapsed_s,
       round(CASE WHEN sum(elapsed_s) > 0 THEN sum(n) * 60.0 / sum(elapsed_s) ELSE 0.0 END, 2) AS records_per_minute
FROM led GROUP BY run_id
"""


# The request plan of a run in mode "both"
def q_union_runs(spark: SparkSession, sf: str) -> DataFrame:
    return both_plan(stored_records(spark, sf), SETS, AS_OF_RECENT, LO, HI)


SQL_UNION_RUNS = f"""
SELECT 'recent' AS mode, s.set_spec, DATE '2024-02-29' AS from_date, DATE '2024-03-01' AS until_date,
       CAST(NULL AS BIGINT) AS chunk_no,
       {SQL_URL.format(s='s.set_spec', f="DATE '2024-02-29'", u="DATE '2024-03-01'")} AS url
FROM {SQL_SETS}
UNION ALL
SELECT 'backfill', set_spec, d, d,
       CAST((row_number() OVER (PARTITION BY set_spec ORDER BY d) - 1) // 7 AS BIGINT),
       {SQL_URL.format(s='set_spec', f='d', u='d')}
FROM {SQL_MISSING} m
"""


# Incremental harvest of landed pages into the table, in two runs. The first holds
# outdated copies of some pages, whose paths sort after the pages that replace them; the
# second holds late corrections and repeats.
def q_stream_harvest(spark: SparkSession, sf: str) -> DataFrame:
    landing = scratch_path(spark, "landing")
    table_path = scratch_path(spark, "stream-table")
    pages = A.pages_v(spark, sf)
    stale, late = A.stale_and_late(pages)
    for part in (pages.unionByName(stale), late):
        compact_pages(part, landing, merge=False)
        stream_harvest(spark, landing, table_path, max_files_per_trigger=None, archive=True).awaitTermination()
    t = read_metadata(spark, table_path)
    return t.select("header_identifier", "header_datestamp",
                    array_to_json("header_setSpecs").alias("set_specs"),
                    F.get("metadata_title", 0).alias("raw_title"),
                    "metadata_description", "created_at", "updated_at")


SQL_STREAM_HARVEST = f"""
WITH landed AS (
  SELECT TIMESTAMP '2024-06-01' + to_seconds(max({SQL_PAGE_NO})) AS first_run,
         TIMESTAMP '2024-06-02' + to_seconds(max({SQL_PAGE_NO}) FILTER (WHERE {SQL_PAGE_NO} % 10 IN (4, 5))) AS second_run
  FROM documents)
SELECT {SQL_IDENT} AS header_identifier, CAST({SQL_DAY} AS TIMESTAMP) AS header_datestamp,
       to_json([lang, lang || ':' || source]) AS set_specs,
       CASE WHEN {SQL_PAGE_NO} % 10 = 5 THEN 'late ' ELSE '' END || split_part(text, chr(10), 1) AS raw_title,
       {SQL_WS.format(x='text')} AS metadata_description, first_run AS created_at,
       CASE WHEN {SQL_PAGE_NO} % 10 IN (4, 5) THEN second_run ELSE first_run END AS updated_at
FROM documents, landed WHERE {SQL_STORED}
"""


# S2, S4 on foreign input: the driver's raw web pages are no OAI-PMH responses, and their whole
# markup comes back unchanged as the text of a record
def q_foreign_pages(spark: SparkSession, sf: str) -> DataFrame:
    p = page_status(parse_pages(A.foreign_v(spark, sf)))
    text = F.get(F.get("records", 0)["metadata"]["dc"]["description"], 0)
    return p.select("page_id", "kind", "status", F.col("n_records").cast("bigint").alias("n_records"),
                    F.when(F.col("kind") == "wrapped", F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("text_md5"))


SQL_FOREIGN_PAGES = """
SELECT page_id, 'raw' AS kind, 'malformed' AS status, CAST(0 AS BIGINT) AS n_records, CAST(NULL AS VARCHAR) AS text_md5 FROM pages
UNION ALL
SELECT page_id, 'wrapped', 'ok', 1, md5(coalesce(html, '')) FROM pages
"""


# S1 (+ K4 on pages): land pages as files, read them back, archive and re-read
def q_landed_pages(spark: SparkSession, sf: str) -> DataFrame:
    landing = scratch_path(spark, "landed")
    archive = scratch_path(spark, "archive")
    land_pages(A.pages_v(spark, sf), landing)
    compact_pages(read_pages(spark, landing, recursive=True), archive, pages_per_file=25)
    p = page_status(parse_pages(read_page_archive(spark, archive)))
    return p.groupBy("status").agg(F.count(F.lit(1)).alias("n_pages"),
                                   F.sum("n_records").cast("bigint").alias("n_records"))


# The same pages in runs of any order. Corrections land first, then two thirds of the
# pages, which are folded into the base, and last the others with all outdated copies; the
# records are those of one batch over everything.
def q_harvest_any_order(spark: SparkSession, sf: str) -> DataFrame:
    pages = A.pages_v(spark, sf)
    stale, late = A.stale_and_late(pages)
    landing, table_path = scratch_path(spark, "any-order"), scratch_path(spark, "any-order-table")
    third = lambda k: pages.where(F.col("page_no") % 3 == k)
    for n, part in enumerate((late, third(1).unionByName(third(2)), third(0).unionByName(stale))):
        compact_pages(part, f"{landing}/{n}", merge=False)
        stream_harvest(spark, landing, table_path, as_of=AS_OF_RECENT + " 00:00:00", num_buckets=8, max_files_per_trigger=None,
                       archive=True).awaitTermination()
        if n == 1:
            compact_table(spark, table_path, 8, max_files=0)
    t = read_metadata(spark, table_path)
    return t.select("header_identifier", "header_datestamp", F.get("metadata_title", 0).alias("raw_title"), "metadata_description",
                    F.timestamp_micros("arrival.at").cast("timestamp_ntz").alias("landed_at"), F.col("arrival.path").alias("page"))


SQL_HARVEST_ANY_ORDER = f"""
SELECT {SQL_IDENT} AS header_identifier, CAST({SQL_DAY} AS TIMESTAMP) AS header_datestamp,
       CASE WHEN {SQL_PAGE_NO} % 10 = 5 THEN 'late ' ELSE '' END || split_part(text, chr(10), 1) AS raw_title,
       {SQL_WS.format(x='text')} AS metadata_description,
       TIMESTAMP '2024-06-01' + to_seconds({SQL_PAGE_NO} + CASE WHEN {SQL_PAGE_NO} % 10 IN (4, 5) THEN 86400 ELSE 0 END) AS landed_at,
       replace({SQL_PAGE_PATH}, '.xml', CASE {SQL_PAGE_NO} % 10 WHEN 5 THEN '_late.xml' WHEN 4 THEN '_again.xml' ELSE '.xml' END) AS page
FROM documents WHERE {SQL_STORED}
"""


# Sets given as data, matched as substrings of the records' set lists
def q_sets_substring(spark: SparkSession, sf: str) -> DataFrame:
    # both matches read the records, and one of them twice: the pages are parsed for all at once
    recs = written(stored_records(spark, sf).select("header_setSpecs", "header_datestamp"), scratch_path(spark, "set-records"))
    d = A.table(spark, sf, "documents")
    sets = d.select(F.explode(F.array("lang", "source", F.concat_ws(":", "lang", "source"), F.concat(F.lit('"'), "lang", F.lit('","')),
                                      F.concat(F.substr("lang", F.lit(2)), F.lit(":")), F.substr("lang", F.lit(1), F.lit(1)),
                                      F.concat("source", F.lit("?")))).alias("name")).distinct()
    found = existing_dates(recs, sets, LO, HI, "substring").groupBy("set_spec").agg(F.count(F.lit(1)).alias("n_days"))
    n = records_in_sets(recs, sets, "substring").groupBy("set_spec").agg(F.count(F.lit(1)).alias("n_records"))
    return n.join(found, "set_spec")


SQL_SETS_SUBSTRING = f"""
WITH rec AS (SELECT CAST(to_json([lang, lang || ':' || source]) AS VARCHAR) AS sets, CAST({SQL_DAY} AS DATE) AS d
             FROM documents WHERE {SQL_STORED}),
names AS (SELECT DISTINCT unnest([lang, source, lang || ':' || source, '"' || lang || '","', substr(lang, 2) || ':', substr(lang, 1, 1),
                                  source || '?']) AS set_spec FROM documents)
SELECT set_spec, count(*) AS n_records, count(DISTINCT d) FILTER (WHERE d BETWEEN DATE '{LO}' AND DATE '{HI}') AS n_days
FROM names JOIN rec ON contains(rec.sets, names.set_spec) GROUP BY set_spec
"""


# The lists that resumption tokens lead through
def q_token_chains(spark: SparkSession, sf: str) -> DataFrame:
    c = token_chains(parse_pages(A.chained_pages_v(spark, sf)))
    return c.select("head", "request_set", "n_pages", "n_records", "complete_list_size", "failed_pages", "orphan", "complete", "missing", "resume_url")


SQL_CHAINS = f"""
pg AS (SELECT {SQL_PAGE_NO} AS p, count(*) AS n FROM documents GROUP BY 1),
lists AS (SELECT *, p // {A.REQUEST_PAGES} AS r, p % {A.REQUEST_PAGES} AS i, max(p) OVER w AS last_page, sum(n) OVER w AS total
          FROM pg WINDOW w AS (PARTITION BY p // {A.REQUEST_PAGES}))
"""
SQL_LIST_NAME = """'list:{{"v":"r' || CAST({r} AS VARCHAR) || '"}}{{"v":"%s"}}{{"v":"%s"}}'""" % (A.REQUEST_FROM, A.REQUEST_UNTIL)
SQL_TOKEN_CHAINS = f"""
WITH {SQL_CHAINS},
parts AS (SELECT *, r % {A.LOST_MOD} = {A.LOST_REM} AND i > {A.LOST_PAGE} AS after,
                 r % {A.LOST_MOD} = {A.LOST_REM} AND i <= {A.LOST_PAGE} AND last_page % {A.REQUEST_PAGES} > {A.LOST_PAGE} AS before FROM lists)
SELECT CASE WHEN after THEN 'token:t|' || CAST(min(p) AS VARCHAR) ELSE {SQL_LIST_NAME.format(r='r')} END AS head,
       CASE WHEN NOT after THEN 'r' || CAST(r AS VARCHAR) END AS request_set, count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS n_records,
       CAST(max(total) AS BIGINT) AS complete_list_size, CAST(0 AS BIGINT) AS failed_pages, after AS orphan, NOT before AS complete,
       CAST(max(total) - sum(n) AS BIGINT) AS missing,
       CASE WHEN before THEN 'https://example.org/oai?verb=ListRecords&resumptionToken=lost%7C' || CAST(max(p) + 1 AS VARCHAR) END AS resume_url
FROM parts GROUP BY r, after, before
"""


# Attempts out of landed pages
def q_page_attempts(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_attempts(page_attempts(parse_pages(A.chained_pages_v(spark, sf))), max_retries=3).drop("client")


SQL_PAGE_ATTEMPTS = f"""
WITH {SQL_CHAINS},
named AS (SELECT p, CASE WHEN i = 0 THEN {SQL_LIST_NAME.format(r='r')} ELSE 'token:t|' || CAST(p AS VARCHAR) END AS request FROM lists)
SELECT request || '#1' AS request_id, p % 10 NOT IN (1, 2) AS succeeded,
       CAST(CASE p % 10 WHEN 2 THEN 3 WHEN 3 THEN 2 ELSE 1 END AS INTEGER) AS attempts_used,
       CASE WHEN p % 10 IN (1, 2) THEN 503 ELSE 200 END AS last_status FROM named
UNION ALL
SELECT request || '#2', true, 1, 200 FROM named WHERE p % 10 IN (0, 1)
"""


# A3 feed: a failure that was landed again well is none
def q_retried_ledger(spark: SparkSession, sf: str) -> DataFrame:
    led = page_ledger(parse_pages(A.chained_pages_v(spark, sf).where(~F.contains("path", F.lit("-again")))), "run")
    return led.select("set_spec", "page", "n", "failed")


SQL_RETRIED_LEDGER = f"""
WITH pg AS (SELECT {SQL_PAGE_NO} AS p, count(*) FILTER (WHERE {SQL_STORED}) AS n FROM documents GROUP BY 1)
SELECT CASE WHEN p % {A.REQUEST_PAGES} = 0 THEN 'r' || CAST(p // {A.REQUEST_PAGES} AS VARCHAR) END AS set_spec,
       CASE WHEN p % {A.REQUEST_PAGES} > 0 THEN 'token:t|' || CAST(p AS VARCHAR) END AS page, n, false AS failed FROM pg
"""


# The batches a harvest flushes, as files
def q_set_batches(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "set-batches")
    write_set_batches(_harvest_rows(spark, sf), path, ["path", "pos"], BATCH)
    # written once: opening a file costs more than its few records
    back = written(spark.read.schema("header_identifier string, row_no long, batch_no long, set_spec string").parquet(path).select(
        "*", F.col("_metadata.file_path").alias("file")), scratch_path(spark, "set-batches-read"))
    files = back.groupBy("set_spec", "batch_no").agg(F.countDistinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_rows"))
    return back.join(files, ["set_spec", "batch_no"]).select("header_identifier", "set_spec", "batch_no", "row_no", "n_files", "n_rows")


SQL_SET_BATCHES = f"""
SELECT header_identifier, set_spec, batch_no, row_no, CAST(1 AS BIGINT) AS n_files, count(*) OVER (PARTITION BY set_spec, batch_no) AS n_rows
FROM ({SQL_ASSIGN_BATCHES}) b
"""


# Coverage from the side table, kept through updates and folds. Each user's last event
# is their record, so a record moves from one day and set to another.
def q_tracked_coverage(spark: SparkSession, sf: str) -> DataFrame:
    base, incoming = A.keyed_v(spark, sf)
    path = scratch_path(spark, "tracked")
    ensure_table(spark, path, 8, track_coverage=True)
    kinds = base.select("metadata_type").unionByName(incoming.select("metadata_type")).distinct()
    out = []
    for stage, part, as_of in (("first", base, AS_OF_BASE), ("second", incoming, AS_OF_INCOMING), ("folded", None, None)):
        if part is None:
            compact_table(spark, path, 8, max_files=0)
        else:
            merge_into(spark, path, part, as_of, SEQ, num_buckets=8)
        days = written(covered_days(spark, path), scratch_path(spark, "covered"))
        out.append(coverage_summary(days, kinds, "2023-12-25", "2024-02-05").withColumn("stage", F.lit(stage)))
    return reduce(DataFrame.unionByName, out)


SQL_TRACKED_COVERAGE = f"""
WITH {SQL_KEYED},
rec AS (SELECT 'first' AS stage, event_type, CAST(ts AS DATE) AS d FROM lb
        UNION ALL SELECT s, coalesce(li.event_type, lb.event_type), CAST(coalesce(li.ts, lb.ts) AS DATE)
        FROM lb FULL OUTER JOIN li ON lb.k = li.k, (VALUES ('second'), ('folded')) v(s)),
have AS (SELECT DISTINCT stage, event_type, d FROM rec WHERE d BETWEEN DATE '2023-12-25' AND DATE '2024-02-05'),
spine AS (SELECT stage, event_type, CAST(g.d AS DATE) AS d
          FROM (VALUES ('first'), ('second'), ('folded')) v(stage), (SELECT DISTINCT event_type FROM ev),
               generate_series(DATE '2023-12-25', DATE '2024-02-05', INTERVAL 1 DAY) g(d))
SELECT stage, s.event_type AS set_spec, count(*) AS total_days, count(h.d) AS existing_days, count(*) - count(h.d) AS missing_days
FROM spine s LEFT JOIN have h USING (stage, event_type, d) GROUP BY stage, s.event_type
"""


QUERIES: dict[str, QueryFn] = {
    "parse_records": q_parse_records,
    "page_status": q_page_status,
    "landed_pages": q_landed_pages,
    "foreign_pages": q_foreign_pages,
    "validate_records": q_validate_records,
    "collapse_ws": q_collapse_ws,
    "first_last_value": q_first_last_value,
    "array_to_json": q_array_to_json,
    "json_to_array": q_json_to_array,
    "safe_serialize": q_safe_serialize,
    "date_scalars": q_date_scalars,
    "set_exact": q_set_exact,
    "set_like": q_set_like,
    "list_records": q_list_records,
    "subject_lookup": q_subject_lookup,
    "query_topk": q_query_topk,
    "existing_dates": q_existing_dates,
    "records_in_sets": q_records_in_sets,
    "coverage_summary": q_coverage_summary,
    "coverage_all_sets": q_coverage_all_sets,
    "missing_dates": q_missing_dates,
    "missing_any_set": q_missing_any_set,
    "date_difference": q_date_difference,
    "chunk_dates": q_chunk_dates,
    "build_requests": q_build_requests,
    "union_runs": q_union_runs,
    "match_existing": q_match_existing,
    "latest_per_key": q_latest_per_key,
    "upsert": q_upsert,
    "write_roundtrip": q_write_roundtrip,
    "write_batches": q_write_batches,
    "assign_batches": q_assign_batches,
    "batch_summary": q_batch_summary,
    "pacing_audit": q_pacing_audit,
    "resolve_attempts": q_resolve_attempts,
    "harvest_summary": q_harvest_summary,
    "throughput": q_throughput,
    "outcome_by_day": q_outcome_by_day,
    "page_ledger": q_page_ledger,
    "page_throughput": q_page_throughput,
    "stream_harvest": q_stream_harvest,
    "harvest_any_order": q_harvest_any_order,
    "sets_substring": q_sets_substring,
    "token_chains": q_token_chains,
    "page_attempts": q_page_attempts,
    "retried_ledger": q_retried_ledger,
    "set_batches": q_set_batches,
    "tracked_coverage": q_tracked_coverage,
    "serialize_exact": q_serialize_exact,
}

ORACLE_SQL: dict[str, str] = {
    "parse_records": SQL_PARSE_RECORDS,
    "page_status": SQL_PAGE_STATUS,
    "landed_pages": SQL_PAGE_STATUS,
    "foreign_pages": SQL_FOREIGN_PAGES,
    "validate_records": SQL_VALIDATE_RECORDS,
    "collapse_ws": SQL_COLLAPSE_WS,
    "first_last_value": SQL_FIRST_LAST_VALUE,
    "array_to_json": SQL_ARRAY_TO_JSON,
    "json_to_array": SQL_JSON_TO_ARRAY,
    "safe_serialize": SQL_SAFE_SERIALIZE,
    "date_scalars": SQL_DATE_SCALARS,
    "set_exact": SQL_SET_EXACT,
    "set_like": SQL_SET_LIKE,
    "list_records": SQL_LIST_RECORDS,
    "subject_lookup": SQL_SUBJECT_LOOKUP,
    "query_topk": SQL_QUERY_TOPK,
    "existing_dates": SQL_EXISTING_DATES,
    "records_in_sets": SQL_RECORDS_IN_SETS,
    "coverage_summary": SQL_COVERAGE_SUMMARY,
    "coverage_all_sets": SQL_COVERAGE_ALL_SETS,
    "missing_dates": SQL_MISSING_DATES,
    "missing_any_set": SQL_MISSING_ANY_SET,
    "date_difference": SQL_DATE_DIFFERENCE,
    "chunk_dates": SQL_CHUNK_DATES,
    "build_requests": SQL_BUILD_REQUESTS,
    "union_runs": SQL_UNION_RUNS,
    "match_existing": SQL_MATCH_EXISTING,
    "latest_per_key": SQL_LATEST_PER_KEY,
    "upsert": SQL_UPSERT,
    "write_roundtrip": SQL_UPSERT,
    "write_batches": SQL_WRITE_BATCHES,
    "assign_batches": SQL_ASSIGN_BATCHES,
    "batch_summary": SQL_BATCH_SUMMARY,
    "pacing_audit": SQL_PACING_AUDIT,
    "resolve_attempts": SQL_RESOLVE_ATTEMPTS,
    "harvest_summary": SQL_HARVEST_SUMMARY,
    "throughput": SQL_THROUGHPUT,
    "outcome_by_day": SQL_OUTCOME_BY_DAY,
    "page_ledger": SQL_PAGE_LEDGER,
    "page_throughput": SQL_PAGE_THROUGHPUT,
    "stream_harvest": SQL_STREAM_HARVEST,
    "harvest_any_order": SQL_HARVEST_ANY_ORDER,
    "sets_substring": SQL_SETS_SUBSTRING,
    "token_chains": SQL_TOKEN_CHAINS,
    "page_attempts": SQL_PAGE_ATTEMPTS,
    "retried_ledger": SQL_RETRIED_LEDGER,
    "set_batches": SQL_SET_BATCHES,
    "tracked_coverage": SQL_TRACKED_COVERAGE,
    "serialize_exact": SQL_SERIALIZE_EXACT,
}
