"""Records keep their arrival: any split of pages into batches, in any order, is one batch."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dcflow.operators.coverage import existing_dates, names_in_texts, records_in_sets
from dcflow.operators.merge import upsert
from dcflow.plans.jobs import ingest_pages
from dcflow.sources.table import compact_table, read_metadata

PAGE = ('<OAI-PMH><responseDate>x</responseDate><ListRecords>{}</ListRecords></OAI-PMH>')
REC = ("<record><header><identifier>k{}</identifier><datestamp>2024-01-0{}</datestamp></header>"
       "<metadata><dc><title>{}</title></dc></metadata></record>")


def _pages(rnd, n):
    rows = []
    for i in range(n):
        body = "".join(REC.format(rnd.randint(0, 9), rnd.randint(1, 9), f"{i}-{j}") for j in range(rnd.randint(0, 4)))
        rows.append((f"p{rnd.randint(0, 99):02d}-{i}", dt.datetime(2024, 6, 1, 0, 0, rnd.randint(0, 9)), PAGE.format(body)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_in_any_order_equals_one_batch(spark, tmp_dir, seed):
    rnd = random.Random(seed)
    rows = _pages(rnd, 14)
    schema = "path string, landed_at timestamp, value string"
    keep = ["header_identifier", "header_datestamp", "metadata_title", "created_at", "updated_at", "arrival"]
    ingest_pages(spark, spark.createDataFrame(rows, schema), tmp_dir + "/one", "2024-07-01 00:00:00", num_buckets=3)
    want = sorted(map(str, read_metadata(spark, tmp_dir + "/one").select(keep).collect()))
    rnd.shuffle(rows)
    parts = [rows[:5], rows[5:9], rows[9:], rows[2:7]]      # the last lands again
    for i, part in enumerate(parts):
        ingest_pages(spark, spark.createDataFrame(part, schema), tmp_dir + "/many", "2024-07-01 00:00:00", num_buckets=3)
        if i == seed:
            compact_table(spark, tmp_dir + "/many", 3, max_files=0)
    assert sorted(map(str, read_metadata(spark, tmp_dir + "/many").select(keep).collect())) == want
    compact_table(spark, tmp_dir + "/many", 3, max_files=0)
    assert sorted(map(str, read_metadata(spark, tmp_dir + "/many").select(keep).collect())) == want


def test_pages_without_landing_time_arrive_with_their_run(spark, tmp_dir):
    def ingest(title, as_of):
        ingest_pages(spark, spark.createDataFrame([("p", PAGE.format(REC.format(1, 1, title)))], "path string, value string"), tmp_dir + "/t", as_of, num_buckets=2)
        return read_metadata(spark, tmp_dir + "/t").first().metadata_title

    assert ingest("b", "2024-02-01 00:00:00") == ["b"]
    assert ingest("a", "2024-01-01 00:00:00") == ["b"]
    assert ingest("c", "2024-03-01 00:00:00") == ["c"]
    assert ingest("d", "2024-03-01 00:00:00") == ["d"]     # the same moment: the later merge


def test_upsert_by_arrival(spark):
    def rows(*xs):
        return spark.createDataFrame(xs, "header_identifier string, x string, a long")

    base = rows(("k", "new", 5), ("m", "old", 1)).withColumn("created_at", F.lit("2024-01-02").cast("timestamp_ntz")).withColumn("updated_at", F.col("created_at"))
    out = upsert(base, rows(("k", "late", 4), ("m", "newer", 2), ("n", "fresh", 0)), "2024-01-01 00:00:00", seq=["a"], columns=["x"], arrival="a")
    assert {r.header_identifier: (r.x, r.a, r.created_at.day, r.updated_at.day) for r in out.collect()} == {
        "k": ("new", 5, 1, 2), "m": ("newer", 2, 1, 1), "n": ("fresh", 0, 1, 1)}


def test_names_in_texts_equals_like(spark):
    rnd = random.Random(6)
    texts = ["".join(rnd.choice('ab",:[]é') for _ in range(rnd.randint(0, 25))) for _ in range(120)] + [None, "", "%_%", "a" * 300]
    names = ["".join(rnd.choice('ab",:é') for _ in range(rnd.randint(0, 6))) for _ in range(150)] + [None, "", "%", "_", "zzz", "aaaa"]
    t = spark.createDataFrame([(x,) for x in set(texts)], "t string")
    n = spark.createDataFrame([(x,) for x in set(names)], "n string")
    found = names_in_texts(t, n)
    got = sorted(map(tuple, found.collect()))
    assert got == sorted((a, b) for a in set(texts) for b in set(names) if a is not None and b is not None and b in a)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_substring_sets_from_a_frame_equal_a_list(spark):
    rows = [("a", ["cs", "cs:AI"], "2024-01-01"), ("b", ["math"], "2024-01-02"), ("c", [], "2024-01-02"), ("d", ["cs"], "2024-01-03")]
    df = spark.createDataFrame(rows, "id string, header_setSpecs array<string>, ts string").withColumn("header_datestamp", F.col("ts").cast("timestamp_ntz"))
    names = ["cs", "AI", ":", "h", "physics", "", '","']
    sets = spark.createDataFrame([(x,) for x in names + ["cs"]], "s string")
    for fn in (lambda s: records_in_sets(df, s, "substring").select("id", "set_spec"), lambda s: existing_dates(df, s, "2024-01-01", "2024-01-02", "substring")):
        assert sorted(map(tuple, fn(sets).collect())) == sorted(map(tuple, fn(names).collect()))


def test_substring_sets_from_a_frame_parse_pages_once(spark, monkeypatch):
    from dcflow.plans import catalog

    acc = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: acc.add(1) or x, "string")
    one = ("<OAI-PMH><responseDate>x</responseDate><ListRecords><record><header><identifier>k{0}</identifier><datestamp>2024-01-0{0}</datestamp>"
           "<setSpec>en</setSpec></header><metadata><dc/></metadata></record></ListRecords></OAI-PMH>")
    pages = spark.createDataFrame([(f"p{i}", one.format(i)) for i in range(1, 6)], "path string, value string")
    monkeypatch.setattr(catalog.A, "pages_v", lambda *_: pages.withColumn("value", seen("value")))
    monkeypatch.setattr(catalog.A, "table", lambda *_: spark.createDataFrame([("en", "src")], "lang string, source string"))
    assert {r.set_spec: (r.n_records, r.n_days) for r in catalog.q_sets_substring(spark, "").collect()} == {"en": (5, 5), "e": (5, 5)}
    assert acc.value == 5      # a page, a call
