"""Upsert rules, validation, and the bucketed table round trip."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from dcflow.operators.merge import latest_per_key, match_existing, upsert
from dcflow.operators.records import validate_records
from dcflow.schemas import RECORD
from dcflow.sources import table as T
from dcflow.sources.table import ensure_table, merge_into, read_metadata

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)


def recs(spark, rows):
    """rows: (id, datestamp, type, seq)"""
    data = [(i, d, [s] if s else [], [], [], "desc", [], [], ["t"], t, q)
            for i, d, t, q, s in [(r + (None,))[:5] for r in rows]]
    schema = T_.StructType(RECORD.fields + [T_.StructField("seq", T_.LongType())])
    return spark.createDataFrame(data, schema)


def empty_base(spark):
    return spark.createDataFrame([], RECORD).withColumn("created_at", F.lit(None).cast("timestamp_ntz")) \
        .withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))


def test_upsert_insert_update_keep_created(spark):
    base = upsert(empty_base(spark), recs(spark, [("a", T0, "x", 1), ("b", T0, "x", 2)]), T0, seq=["seq"])
    inc = recs(spark, [("a", dt.datetime(2023, 1, 1), "new", 5), ("a", T1, "older-seq", 4),
                       ("c", T1, "y", 6)])
    out = {r.header_identifier: r for r in upsert(base, inc, T1, seq=["seq"]).collect()}
    assert set(out) == {"a", "b", "c"}
    # higher seq wins even with an older datestamp
    assert out["a"].metadata_type == "new" and out["a"].header_datestamp == dt.datetime(2023, 1, 1)
    assert out["a"].created_at == T0 and out["a"].updated_at == T1
    assert out["b"].created_at == T0 and out["b"].updated_at == T0
    assert out["c"].created_at == T1 and out["c"].updated_at == T1


def test_upsert_empty_batch_and_idempotence(spark):
    base = upsert(empty_base(spark), recs(spark, [("a", T0, "x", 1)]), T0, seq=["seq"])
    same = upsert(base, recs(spark, []), T1, seq=["seq"])
    assert [tuple(r) for r in same.collect()] == [tuple(r) for r in base.collect()]
    inc = recs(spark, [("a", T1, "y", 2), ("b", T1, "z", 3)])
    once = upsert(base, inc, T1, seq=["seq"])
    twice = upsert(once, inc, T1, seq=["seq"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_one_key_under_two_sets_is_one_row(spark):
    inc = recs(spark, [("k", T0, "x", 1, "cs"), ("k", T0, "x", 2, "math")])
    out = upsert(empty_base(spark), inc, T0, seq=["seq"]).collect()
    assert len(out) == 1 and out[0].header_setSpecs == ["math"]


def test_latest_per_key_and_match_existing(spark):
    inc = recs(spark, [("a", T0, "1", 1), ("a", T0, "2", 2), ("b", T0, "3", 3)])
    latest = {r.header_identifier: r.metadata_type for r in latest_per_key(inc, ["seq"]).collect()}
    assert latest == {"a": "2", "b": "3"}
    base = upsert(empty_base(spark), recs(spark, [("a", T0, "x", 1)]), T0, seq=["seq"])
    acts = {r.header_identifier: r.action for r in
            match_existing(base, latest_per_key(inc, ["seq"])).collect()}
    assert acts == {"a": "update", "b": "insert"}


def test_validate_reject_cases(spark):
    rows = [(None, T0, "t"), ("k" * 256, T0, "t"), ("ok", T0, "t" * 101), ("bad-date", None, "t"),
            ("good", T0, "t")]
    df = spark.createDataFrame(rows, "header_identifier string, header_datestamp timestamp_ntz, "
                                     "metadata_type string")
    got = {r.header_identifier: (r.accepted, r.reasons) for r in validate_records(df).collect()}
    assert got[None] == (False, ["missing_identifier"])
    assert got["k" * 256] == (False, ["identifier_too_long"])
    assert got["ok"] == (False, ["type_too_long"])
    assert got["bad-date"] == (False, ["bad_datestamp"])
    assert got["good"] == (True, [])
    assert validate_records(df).count() == len(rows)   # accepted + rejected = input


def test_merge_reads_and_rewrites_no_stored_file(spark, tmp_dir):
    base = recs(spark, [(f"id{i}", T0, "x", i) for i in range(50)])
    inc = recs(spark, [(f"id{i}", T1, "y", 100 + i) for i in range(25, 75)])
    path = os.path.join(tmp_dir, "t")

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
                for d, _, fs in os.walk(path) for f in fs}

    assert ensure_table(spark, path, 4) is True
    assert ensure_table(spark, path, 4) is False
    assert merge_into(spark, path, base, T0, ["seq"], num_buckets=4) == {"batch_rows": 50, "version": 1}
    assert T.compact_table(spark, path, 4, max_files=0) == 1
    before = files()
    assert merge_into(spark, path, inc, T1, ["seq"], num_buckets=4) == {"batch_rows": 50, "version": 1}
    assert before.items() <= files().items()
    seen = []
    for step in ("delta over base", "folded", "split", "rebucketed"):
        if step == "folded":
            assert T.compact_table(spark, path, 4, max_files=0) == 1
        if step == "split":
            T.write_metadata(read_metadata(spark, path), path, 4, tasks_per_bucket=3)
        if step == "rebucketed":
            T.rebucket_table(spark, path, path + "-9", 9)
            path += "-9"
        t = read_metadata(spark, path)
        seen.append(sorted(tuple(r) for r in t.drop("bucket").collect()))
        got = {r.header_identifier: (r.created_at, r.updated_at, r.metadata_type) for r in t.collect()}
        assert len(got) == t.count() == 75
        assert (got["id10"], got["id30"], got["id70"]) == ((T0, T0, "x"), (T0, T1, "y"), (T1, T1, "y"))
        n = 9 if step == "rebucketed" else 4
        assert t.filter(F.col("bucket") != T.bucket_of("header_identifier", n)).count() == 0
    assert all(x == seen[0] for x in seen)


def test_empty_batch_adds_no_version(spark, tmp_dir):
    path = os.path.join(tmp_dir, "none")
    assert merge_into(spark, path, recs(spark, []), T0, ["seq"]) == {"batch_rows": 0, "version": None}
    assert T.delta_versions(spark, path) == [] and read_metadata(spark, path).count() == 0


def test_merge_refuses_another_bucket_count(spark, tmp_dir):
    import pytest
    path = os.path.join(tmp_dir, "layout")
    merge_into(spark, path, recs(spark, [("a", T0, "x", 1)]), T0, ["seq"], num_buckets=4)
    assert T.table_buckets(spark, path) == 4
    with pytest.raises(ValueError):
        merge_into(spark, path, recs(spark, [("b", T0, "x", 2)]), T1, ["seq"], num_buckets=8)
    assert read_metadata(spark, path).count() == 1


def test_replayed_batches_and_compaction_change_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "appends")
    merge_into(spark, path, recs(spark, [(f"id{i}", T0, "x", i) for i in range(40)]), T0, ["seq"], num_buckets=8)
    one_update = recs(spark, [("id3", T1, "y", 100)])
    new_only = recs(spark, [("new1", T1, "z", 200)])
    merge_into(spark, path, one_update, T1, ["seq"], num_buckets=8)
    merge_into(spark, path, new_only, T1, ["seq"], num_buckets=8)
    t = read_metadata(spark, path)
    snapshot = sorted(map(tuple, t.collect()))
    assert len(snapshot) == 41
    row = t.filter("header_identifier = 'id3'").first()
    assert (row.metadata_type, row.created_at, row.updated_at) == ("y", T0, T1)
    merge_into(spark, path, new_only, T1, ["seq"], num_buckets=8)
    merge_into(spark, path, one_update, T1, ["seq"], num_buckets=8)
    assert sorted(map(tuple, read_metadata(spark, path).collect())) == snapshot
    assert T.compact_table(spark, path, 8, max_files=5) == 0
    assert T.compact_table(spark, path, 8, max_files=4) == 5
    assert T.delta_versions(spark, path) == []
    assert sorted(map(tuple, read_metadata(spark, path).collect())) == snapshot


def test_merge_refuses_records_without_key(spark, tmp_dir):
    import pytest
    path = os.path.join(tmp_dir, "nokey")
    some = recs(spark, [("gone", T0, "x", 1), ("a", T0, "x", 2)]) \
        .withColumn("header_identifier", F.expr("nullif(header_identifier, 'gone')"))
    with pytest.raises(Exception, match="records without header_identifier"):
        merge_into(spark, path, some, T0, ["seq"], num_buckets=4)
    assert read_metadata(spark, path).count() == 0          # nothing was committed
    merge_into(spark, path, some.where("header_identifier = 'a'"), T0, ["seq"], num_buckets=4)
    assert read_metadata(spark, path).count() == 1
