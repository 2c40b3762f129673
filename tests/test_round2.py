"""Arrival order, attempts by order, repeated set names, day precision, emptied runs."""

import datetime as dt

from pyspark.sql import functions as F

from dcflow.functions.dates import parse_datestamp
from dcflow.operators.coverage import records_in_sets, set_date_spine
from dcflow.operators.ledger import resolve_attempts
from dcflow.plans.jobs import _replace_run, both_plan, ingest_pages
from dcflow.schemas import RECORD
from dcflow.sources.table import ensure_table, read_metadata

PAGE = """<?xml version="1.0"?><OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><responseDate>2024-01-05T00:00:00Z</responseDate>
<request verb="ListRecords">https://example.org/oai</request><ListRecords><record><header><identifier>k1</identifier>
<datestamp>2024-01-01</datestamp><setSpec>s</setSpec></header><metadata><oai_dc:dc xmlns:oai_dc="http://www.openarchives.org/OAI/2.0/oai_dc/"
xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>{}</dc:title></oai_dc:dc></metadata></record></ListRecords></OAI-PMH>"""


def test_the_later_landing_wins_whatever_its_name(spark, tmp_dir):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    pages = spark.createDataFrame([("p9.xml", PAGE.format("OLD"), old), ("p10.xml", PAGE.format("NEW"), new)],
                                  "path string, value string, landed_at timestamp_ntz")
    ensure_table(spark, tmp_dir + "/one", 2)
    ensure_table(spark, tmp_dir + "/two", 2)
    ingest_pages(spark, pages, tmp_dir + "/one", "2024-02-01 00:00:00", num_buckets=2)
    for p in ("p9.xml", "p10.xml"):
        ingest_pages(spark, pages.where(F.col("path") == p), tmp_dir + "/two", "2024-02-01 00:00:00", num_buckets=2)
    title = [[r["metadata_title"] for r in read_metadata(spark, f"{tmp_dir}/{t}").collect()] for t in ("one", "two")]
    assert title[0] == title[1] and "NEW" in str(title[0])


def test_attempts_count_by_order(spark):
    log = spark.createDataFrame([("c", 1, 3, 503), ("c", 1, 4, 503), ("c", 1, 5, 200), ("c", 1, 9, 500)], "client string, request_id long, attempt int, status int")
    r = resolve_attempts(log, 3).first()
    assert (r["succeeded"], r["attempts_used"], r["last_status"]) == (True, 3, 200)


def test_repeated_set_names_count_once(spark):
    assert set_date_spine(spark, ["en", "en"], "2024-01-01", "2024-01-10").count() == 10
    df = spark.createDataFrame([(["en"],)], "header_setSpecs array<string>")
    assert [records_in_sets(df, ["en", "en"], m).count() for m in ("exact", "substring")] == [1, 1]


def test_datestamps_name_a_day(spark):
    df = spark.createDataFrame([("2024",), ("2024-01",), ("2024-01-02",), ("2024-01-02T03:04:05Z",), ("x",), (None,)], "s string")
    assert [r[0] is not None for r in df.select(parse_datestamp("s")).collect()] == [False, False, True, True, False, False]


def test_an_emptied_run_leaves_no_rows(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "run-2024-01-01 00:00:00"), (2, "other")], "x int, run_id string")
    path = tmp_dir + "/q"
    _replace_run(rows, path, "run-2024-01-01 00:00:00")
    _replace_run(rows.limit(0), path, "run-2024-01-01 00:00:00")
    assert [r["x"] for r in spark.read.parquet(path).collect()] == [2]


def test_both_halves_of_a_plan_carry_endpoint_and_prefix(spark):
    stored = spark.createDataFrame([], RECORD)
    plan = both_plan(stored, ["s"], "2024-01-05", "2024-01-01", "2024-01-03", base_url="https://a.example/oai", metadata_prefix="mods").collect()
    assert {r["mode"] for r in plan} == {"recent", "backfill"}
    assert all("https://a.example/oai" in str(r) and "mods" in str(r) for r in plan)


ECHO_PAGE = ('<OAI-PMH><responseDate>2024-06-01T00:00:00Z</responseDate>'
        '<request verb="ListRecords" set="a" from="2024-01-01" until="2024-01-02">u</request><ListRecords><record>'
        '<header><identifier>k</identifier><datestamp>2024-01-01</datestamp></header>'
        '<metadata><dc><title>t</title></dc></metadata></record></ListRecords></OAI-PMH>')


def test_text_after_the_root_is_malformed_and_carries_nothing(spark):
    from dcflow.sources.pages import page_status, parse_pages
    tails = {"plain": "", "space": " \n", "comment": "\n<!-- OAI-PMH --> <?x y?>\n", "text": " x", "element": "<a/>",
             "twice": ECHO_PAGE}
    pages = spark.createDataFrame([(k, ECHO_PAGE + v) for k, v in tails.items()] + [("none", None), ("empty", "")], "path string, value string")
    got = {r["path"]: r for r in page_status(parse_pages(pages)).collect()}
    for k in ("plain", "space", "comment"):
        assert (got[k].status, got[k].n_records, got[k].request_set) == ("ok", 1, "a"), k
    for k in ("text", "element", "twice", "none", "empty"):
        assert (got[k].status, got[k].n_records, got[k].request_set, got[k].records) == ("malformed", 0, None, None), k


def test_each_page_is_parsed_once(spark):
    from dcflow.plans.catalog import QUERIES
    for name in ("page_status", "parse_records"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_xml") == 1 and plan.count("FileScan") == 1, name


def test_scratch_paths_share_the_application_folder(spark):
    from dcflow.session import path_exists, scratch_path
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    folder = a.rsplit("/", 1)[0]
    assert a != b and b.startswith(folder + "/") and folder.endswith(spark.sparkContext.applicationId)
    assert path_exists(spark, folder) and not path_exists(spark, a)


def test_ingest_leaves_no_staged_pages(spark):
    from dcflow.plans.jobs import ingest_pages
    from dcflow.session import list_names, scratch_path
    from dcflow.sources.table import read_metadata
    table = scratch_path(spark, "t-staged")
    pages = spark.createDataFrame([("p", ECHO_PAGE)], "path string, value string")
    ingest_pages(spark, pages, table, "2024-06-01 00:00:00")
    assert read_metadata(spark, table).count() == 1
    assert not [n for n in list_names(spark, table.rsplit("/", 1)[0]) if n.startswith("parsed-pages")]


def test_archives_merge_small_tasks(spark):
    import datetime as dt

    from dcflow.session import list_names, scratch_path
    from dcflow.sources.pages import compact_pages, read_page_archive
    at = dt.datetime(2024, 6, 1)
    pages = spark.createDataFrame([(f"p{i:03d}", at, ECHO_PAGE) for i in range(40)], "path string, landed_at timestamp, value string").repartition(20)
    out = scratch_path(spark, "t-archive")
    compact_pages(pages, out)
    assert len([n for n in list_names(spark, out) if n.endswith(".parquet")]) < 5
    assert read_page_archive(spark, out).count() == 40


def test_archive_stream_takes_rows_of_each_file(spark):
    import datetime as dt

    from dcflow.session import scratch_path
    from dcflow.sources.pages import compact_pages
    from dcflow.sources.table import read_metadata
    from dcflow.streaming.harvest import stream_harvest
    landing, table = scratch_path(spark, "t-arch-landing"), scratch_path(spark, "t-arch-table")

    def land(path, minute, title):
        compact_pages(spark.createDataFrame([(path, dt.datetime(2024, 6, 1, 0, minute), ECHO_PAGE.replace(">t<", f">{title}<"))],
                                            "path string, landed_at timestamp, value string"), landing)
    land("p9", 1, "old")
    land("p10", 2, "new")           # sorts before p9, lands after it
    stream_harvest(spark, landing, table, max_files_per_trigger=None, archive=True).awaitTermination()
    assert read_metadata(spark, table).first().metadata_title == ["new"]
    land("p1", 3, "late")
    stream_harvest(spark, landing, table, max_files_per_trigger=None, archive=True).awaitTermination()
    row = read_metadata(spark, table).first()
    assert row.metadata_title == ["late"] and row.created_at < row.updated_at
