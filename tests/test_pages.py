"""Golden response pages: parse, classify, explode, flatten, clean."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from dcflow.operators.records import clean_records, flatten_records
from dcflow.sources.pages import explode_records, page_status, parse_pages, read_pages

NS = 'xmlns="http://www.openarchives.org/OAI/2.0/"'
DC = ('<oai_dc:dc xmlns:oai_dc="http://www.openarchives.org/OAI/2.0/oai_dc/" '
      'xmlns:dc="http://purl.org/dc/elements/1.1/">')


def page(records: str, token: str = "") -> str:
    return (f'<?xml version="1.0" encoding="UTF-8"?><OAI-PMH {NS}>'
            f"<responseDate>2024-01-01T00:00:00Z</responseDate>"
            f"<ListRecords>{records}{token}</ListRecords></OAI-PMH>")


def rec(ident="oai:x:1", stamp="2024-01-02", sets=("cs",), dc="", status=None) -> str:
    st = f' status="{status}"' if status else ""
    s = "".join(f"<setSpec>{x}</setSpec>" for x in sets)
    meta = f"<metadata>{DC}{dc}</oai_dc:dc></metadata>" if dc is not None else ""
    return (f"<record><header{st}><identifier>{ident}</identifier>"
            f"<datestamp>{stamp}</datestamp>{s}</header>{meta}</record>")


def flat(spark, pages):
    df = spark.createDataFrame([(f"p{i}", v) for i, v in enumerate(pages)], "path string, value string")
    return flatten_records(explode_records(parse_pages(df)))


def test_normal_record_arrays_in_document_order(spark):
    dc = ("<dc:title> A  title\n here </dc:title><dc:creator>Ann</dc:creator><dc:creator>Bob</dc:creator>"
          "<dc:description>First\tabstract </dc:description><dc:description>Comment</dc:description>"
          "<dc:subject>math</dc:subject><dc:type>text</dc:type><dc:date>2024-01-01</dc:date>")
    r = flat(spark, [page(rec(dc=dc, sets=("cs", "math")))]).collect()[0]
    assert r.metadata_creator == ["Ann", "Bob"]
    assert r.metadata_description == "First abstract"
    assert r.metadata_title == [" A  title\n here "]
    assert r.title == "A title here"
    assert r.header_setSpecs == ["cs", "math"]
    assert r.metadata_type == "text"
    assert str(r.header_datestamp) == "2024-01-02 00:00:00"
    assert r.pos == 0 and r.deleted is False


def test_deleted_empty_identifier_and_two_identifiers(spark):
    recs = (rec("oai:x:del", status="deleted", dc=None) + rec("", dc="<dc:title>t</dc:title>")
            + "<record><header><identifier>first</identifier><identifier>last</identifier>"
              "<datestamp>2024-01-03</datestamp></header></record>")
    rows = flat(spark, [page(recs)]).orderBy("pos").collect()
    assert [r.header_identifier for r in rows] == ["oai:x:del", "", "last"]
    assert rows[0].deleted is True and rows[0].metadata_title == []
    df = flat(spark, [page(recs)])
    kept = clean_records(explode_records(parse_pages(
        spark.createDataFrame([("p", page(recs))], "path string, value string"))))
    assert [r.header_identifier for r in kept.collect()] == ["last"]
    assert df.count() == 3


def test_empty_title_cdata_entities_and_raw_blanks(spark):
    dc = ("<dc:title/><dc:creator><![CDATA[R&D <lab>]]></dc:creator>"
          "<dc:subject>a &amp; b</dc:subject><dc:identifier>  padded  </dc:identifier>")
    r = flat(spark, [page(rec(dc=dc))]).collect()[0]
    assert r.metadata_title == [""]
    assert r.title == ""
    assert r.metadata_creator == ["R&D <lab>"]
    assert r.metadata_subject == ["a & b"]
    assert r.metadata_identifier == ["  padded  "]


def test_unprefixed_dc_with_other_namespace(spark):
    body = ('<record><header><identifier>u1</identifier><datestamp>2024-01-05</datestamp></header>'
            '<metadata><dc xmlns="urn:other"><title>Plain</title></dc></metadata></record>')
    r = flat(spark, [page(body)]).collect()[0]
    assert r.metadata_title == ["Plain"] and r.header_identifier == "u1"


def test_page_statuses_and_token(spark):
    ok = page(rec(), '<resumptionToken cursor="0" completeListSize="40">tok-1</resumptionToken>')
    none = f'<?xml version="1.0"?><OAI-PMH {NS}><error code="noRecordsMatch">none</error></OAI-PMH>'
    other = f'<?xml version="1.0"?><OAI-PMH {NS}><error code="badArgument">bad</error></OAI-PMH>'
    trunc = ok[:150]
    empty_list = page("")
    html = "<html><head><title>503 Service Unavailable</title></head><body>busy</body></html>"
    df = spark.createDataFrame([("a", ok), ("b", none), ("c", other), ("d", trunc), ("e", empty_list),
                                ("f", html)], "path string, value string")
    p = page_status(parse_pages(df))
    got = {r.path: (r.status, r.n_records) for r in p.collect()}
    assert got == {"a": ("ok", 1), "b": ("no_records", 0), "c": ("error", 0),
                   "d": ("malformed", 0), "e": ("no_records", 0), "f": ("malformed", 0)}
    tok = p.filter("path = 'a'").select("resumption_token", "token_cursor",
                                        "complete_list_size").first()
    assert tuple(tok) == ("tok-1", 0, 40)
    assert explode_records(parse_pages(df)).count() == 1


def test_read_pages_whole_files_and_zero_length(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "p1.xml"), "w") as f:
        f.write(page(rec("a") + rec("b")).replace("><", ">\n<"))
    open(os.path.join(tmp_dir, "empty.xml"), "w").close()
    pages = read_pages(spark, tmp_dir)
    assert pages.count() == 1
    recs = flatten_records(explode_records(parse_pages(pages)))
    assert sorted(r.header_identifier for r in recs.collect()) == ["a", "b"]
    assert recs.select(F.col("path").endswith("p1.xml")).first()[0]


def test_page_ledger_from_request_echo(spark):
    import datetime as dt

    from dcflow.operators.ledger import harvest_summary, page_ledger, run_throughput

    def pg(set_, day, body):
        return (f'<?xml version="1.0"?><OAI-PMH {NS}><request verb="ListRecords" set="{set_}" '
                f'from="{day}" until="{day}" metadataPrefix="oai_dc">https://x/oai</request>'
                f"{body}</OAI-PMH>")
    ok1 = pg("cs", "2024-01-02", f"<ListRecords>{rec('a')}{rec('b', status='deleted', dc=None)}"
                                 "<resumptionToken>t</resumptionToken></ListRecords>")
    ok2 = pg("cs", "2024-01-02", f"<ListRecords>{rec('c')}</ListRecords>")
    none = pg("math", "2024-01-02", '<error code="noRecordsMatch">x</error>')
    bad = pg("stat", "2024-01-02", "<ListRecords><record>")
    df = spark.createDataFrame([("1", ok1), ("2", ok2), ("3", none), ("4", bad)],
                               "path string, value string")
    led = page_ledger(parse_pages(df), "run-1")
    got = {(r.set_spec, r.page): (r.n, r.failed) for r in led.collect()}
    assert got == {("cs", None): (2, False), ("math", None): (0, False), (None, "4"): (0, True)}
    halves = spark.createDataFrame([("1", ok1, dt.datetime(2024, 1, 3)), ("2", ok2, dt.datetime(2024, 1, 3, 0, 1))],
                                   "path string, value string, landed_at timestamp")
    t = run_throughput(page_ledger(parse_pages(halves), "run-1")).first()
    assert (t.total_records, t.elapsed_s, t.records_per_minute) == (2, 60.0, 2.0)
    s = harvest_summary(led).first()
    assert (s.sets_processed, s.successful, s.failed, s.total_records) == (3, 2, 1, 2)


def test_select_builder_later_calls_replace(spark):
    from dcflow.operators.query import Select
    df = spark.range(20).withColumnRenamed("id", "k")
    q = Select().where(F.col("k") > 3).where(F.col("k") < 15).order_by("k").order_by("k", asc=False) \
        .limit(10).limit(3)
    assert [r.k for r in q.apply(df).collect()] == [14, 13, 12]


def test_description_rule_options(spark):
    dc = "<dc:description> first  one </dc:description><dc:description> last\\n one </dc:description>"
    df = spark.createDataFrame([("p", page(rec(dc=dc)))], "path string, value string")
    ex = explode_records(parse_pages(df))
    assert flatten_records(ex).first().metadata_description == "first one"
    assert flatten_records(ex, description="last", collapse=False).first().metadata_description \
        == " last\\n one "


def test_read_pages_gzip_files(spark, tmp_dir):
    import gzip
    with gzip.open(os.path.join(tmp_dir, "p2.xml.gz"), "wt", encoding="utf-8") as f:
        f.write(page(rec("gz-1") + rec("gz-2")))
    with open(os.path.join(tmp_dir, "p3.xml"), "w") as f:
        f.write(page(rec("plain-1")))
    recs = flatten_records(explode_records(parse_pages(read_pages(spark, tmp_dir))))
    assert sorted(r.header_identifier for r in recs.collect()) == ["gz-1", "gz-2", "plain-1"]


def test_type_and_datestamp_take_the_last_occurrence(spark):
    body = ("<record><header><identifier>t1</identifier><datestamp>2024-01-01</datestamp>"
            "<datestamp>2024-01-09</datestamp></header>"
            f"<metadata>{DC}<dc:type>text</dc:type><dc:type>Article</dc:type></oai_dc:dc></metadata>"
            "</record>")
    r = flat(spark, [page(body)]).collect()[0]
    assert r.metadata_type == "Article" and str(r.header_datestamp) == "2024-01-09 00:00:00"


def test_metadata_in_any_container_is_stored(spark):
    from dcflow.operators.records import validate_records

    def of(ident, metadata):
        return f"<record><header><identifier>{ident}</identifier><datestamp>2024-01-01</datestamp></header>{metadata}</record>"

    body = (of("m1", '<metadata xmlns:x="urn:x" id="7">\n <mods><title>kept elsewhere</title><unread>u</unread></mods>\n</metadata>')
            + of("m2", "") + rec("m3") + of("m4", "<metadata/>") + of("m5", "<metadata>stray<a><title>A</title></a><b k='v'><title>B</title><type>t</type></b></metadata>")
            + of("m6", "<metadata><x:any xmlns:x='urn:x'><x:title>one</x:title><x:nested><x:title>deeper</x:title></x:nested><x:title>two</x:title></x:any></metadata>")
            + of("m7", "<metadata><title>no container</title></metadata>"))
    rows = {r.header_identifier: r for r in validate_records(flat(spark, [page(body)])).collect()}
    assert {k: r.reasons for k, r in rows.items()} == {f"m{i}": [] for i in range(1, 8)}
    assert {k: r.metadata_title for k, r in rows.items()} == {
        "m1": ["kept elsewhere"], "m2": [], "m3": [], "m4": [], "m5": ["A", "B"], "m6": ["one", "two"], "m7": []}
    assert rows["m5"].metadata_type == "t"


def test_a_value_is_its_text_content(spark):
    dc = ("<dc:title>H<sub>2</sub>O &lt;b&gt; <i a=\"1>2\">it<b>al</b></i>ic<!-- note --> &#60;x&#x3c; &amp;lt;</dc:title>"
          "<dc:creator><![CDATA[a <b> & ]]>c <![CDATA[<d>]]>\ufdd0</dc:creator><dc:subject><only/></dc:subject><dc:type>a<br/>b</dc:type>")
    r = flat(spark, [page(rec("a&lt;b", dc=dc, sets=("s&lt;1",)))]).first()
    assert r.metadata_title == ["H2O <b> italic <x< &lt;"]
    assert r.metadata_creator == ["a <b> & c <d>\ufdd0"]
    assert r.metadata_subject == [""] and r.metadata_type == "ab"
    assert r.header_identifier == "a<b" and r.header_setSpecs == ["s<1"]
