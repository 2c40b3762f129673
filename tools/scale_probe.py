"""Scale probe: ingest, merge and coverage on k copies of a scale factor's
documents (ids shifted per copy, so every copy is a distinct record).

    python tools/scale_probe.py [sf_dir] [copies] [cpus] [shuffle|skew]

Prints one JSON line with seconds and rates. Not a registered query: it is a
larger-volume check of the same jobs the bench times at sf0.1.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from dcflow.operators.coverage import missing_dates  # noqa: E402
from dcflow.plans import adapters as A  # noqa: E402
from dcflow.plans.jobs import ingest_pages  # noqa: E402
from dcflow.session import build_session, scratch_path  # noqa: E402
from dcflow.sources.pages import compact_pages, read_page_archive  # noqa: E402
from dcflow.sources.table import merge_into, read_metadata  # noqa: E402


def skew(spark, sf: str, copies: int) -> dict:
    """Pacing audit where one client holds a third of all requests: skew-safe
    numbering + equi-join against a plain lag() window over the client."""
    from pyspark.sql import Window
    from dcflow.operators.ledger import pacing_audit
    ev = A.table(spark, sf, "events")
    n = ev.agg(F.max("event_id")).first()[0] + 1
    big = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_c")) \
        .withColumn("event_id", F.col("event_id") + F.col("_c") * F.lit(n)) \
        .withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                                           F.col("_c").cast("decimal(18,6)")))
    log = big.select(
        F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("user_id").cast("string"))
         .alias("client"),
        F.col("event_id").cast("string").alias("request_id"), F.lit(1).alias("attempt"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("event_type") == "error", F.lit(503)).otherwise(F.lit(200)).alias("status"))
    log_dir = scratch_path(spark, "skew-log")
    log.write.parquet(log_dir)
    log = spark.read.parquet(log_dir)
    out = {"rows": log.count(), "hot_rows": log.filter("client = 'hot'").count()}
    t = time.perf_counter()
    safe = pacing_audit(log)
    safe.write.format("noop").mode("overwrite").save()
    out["skew_safe_sec"] = round(time.perf_counter() - t, 2)
    w = Window.partitionBy("client").orderBy("ts", "request_id", "attempt")
    gap = F.timestamp_diff("MICROSECOND", F.lag("ts").over(w), F.col("ts"))
    naive = log.withColumn("wait_us", F.greatest(F.lit(0), F.lit(3_000_000) - gap))
    t = time.perf_counter()
    naive.write.format("noop").mode("overwrite").save()
    out["plain_window_sec"] = round(time.perf_counter() - t, 2)
    a = safe.select("request_id", "wait_us").exceptAll(
        naive.select("request_id", F.coalesce("wait_us", F.lit(0)).cast("bigint"))).count()
    out["rows_differing"] = a
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    cpus = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    spark = build_session(f"local[{cpus}]", app="dcflow-scale", shuffle_partitions=cpus * 4,
                          extra={"spark.driver.memory": "16g"})
    if len(sys.argv) > 4 and sys.argv[4] == "skew":
        print(json.dumps({"sf": sf, "copies": copies, "cpus": cpus, **skew(spark, sf, copies)}))
        return
    docs = A.table(spark, sf, "documents")
    n = docs.agg(F.max("doc_id")).first()[0] + 1
    big = docs.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_c")) \
        .withColumn("doc_id", F.col("doc_id") + F.col("_c") * F.lit(n)).drop("_c")
    big_dir = scratch_path(spark, "scale-docs")
    big.write.parquet(f"{big_dir}/documents.parquet")
    out: dict = {"sf": sf, "copies": copies, "cpus": cpus}

    t = time.perf_counter()
    archive = scratch_path(spark, "scale-archive")
    compact_pages(A.pages_v(spark, big_dir), archive)
    out["render_and_archive_sec"] = round(time.perf_counter() - t, 2)

    table = scratch_path(spark, "scale-table")
    t = time.perf_counter()
    res = ingest_pages(spark, read_page_archive(spark, archive), table, "2024-06-01 00:00:00",
                       num_buckets=64, with_counts=True)
    sec = time.perf_counter() - t
    out.update(ingest_sec=round(sec, 2), ingest_records=res["accepted"],
               ingest_records_per_min=round(res["accepted"] * 60 / sec))

    # a second batch updating 10% of the records (fresh datestamps)
    upd = read_metadata(spark, table).filter(F.pmod(F.xxhash64("header_identifier"), F.lit(10)) == 0) \
        .withColumn("header_datestamp", F.col("header_datestamp") + F.expr("INTERVAL 1 DAY")) \
        .withColumn("seq", F.lit(1)).drop("created_at", "updated_at", "bucket")
    t = time.perf_counter()
    r2 = merge_into(spark, table, upd, "2024-06-02 00:00:00", ["seq"], num_buckets=64)
    out.update(update_sec=round(time.perf_counter() - t, 2), update_rows=r2["batch_rows"])

    # a daily harvest: 5% new records and 1% updates of stored ones
    cur = read_metadata(spark, table).drop("created_at", "updated_at", "bucket")
    h = F.pmod(F.xxhash64("header_identifier", F.lit("day")), F.lit(100))
    new = cur.filter(h < 5).withColumn("header_identifier",
                                       F.concat(F.col("header_identifier"), F.lit(":v2")))
    upd2 = cur.filter(h == 5).withColumn("metadata_type", F.lit("revised"))
    day = new.unionByName(upd2).withColumn("seq", F.lit(2))
    t = time.perf_counter()
    r3 = merge_into(spark, table, day, "2024-06-03 00:00:00", ["seq"], num_buckets=64)
    out.update(daily_sec=round(time.perf_counter() - t, 2), daily_rows=r3["batch_rows"])

    t = time.perf_counter()
    m = missing_dates(read_metadata(spark, table), ["en", "fr", "de", "es"], "2023-12-01",
                      "2024-03-31").count()
    out.update(missing_dates_sec=round(time.perf_counter() - t, 2), missing_rows=m)
    t = time.perf_counter()
    hit = read_metadata(spark, table).filter(F.col("header_identifier") == "oai:doc:12346").count()
    out.update(point_lookup_sec=round(time.perf_counter() - t, 2), point_lookup_rows=hit)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
