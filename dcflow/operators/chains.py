"""Lists that a server hands out page by page (resumption tokens), put together from landed
pages, and the attempts behind them (S1, S2, A3, A6).

A list is a request and the pages its tokens lead to. Pages land in any order, more than once,
or not at all, so a list is a chain of pointers over the landed pages: a page answers the
token it was asked with, and issues the next. ``token_chains`` ranks the pages of all lists at
once by pointer doubling, so a list of n pages takes log2(n) joins and no list is ever held
by one task.

``page_attempts`` is the other view of the same pages: every landing of a request is an
attempt, and landings close enough to one another are one run of attempts. It is a request
log, which ``resolve_attempts`` and ``pacing_audit`` read like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import array_len
from ..session import scratch_path, written
from ..sources.pages import STATUS_ERROR, STATUS_MALFORMED, status_of
from ..sources.requests import DEFAULT_BASE_URL
from .numbering import number_rows, previous_row, running_sum, sliced

# A landing later than this after the one before it starts a new run of attempts.
DEFAULT_GAP_S = 3600
# What a landed answer counts as in a request log: the protocol answers errors with 200.
STATUS_CODES = {STATUS_MALFORMED: 502, STATUS_ERROR: 503}
GOOD_CODE = 200
ECHO = ["request_set", "request_from", "request_until", "request_token"]


def _landed_at(parsed: DataFrame) -> Column:
    return F.col("landed_at").cast("timestamp") if "landed_at" in parsed.columns else F.lit(None).cast("timestamp")


def request_name() -> Column:
    """What a page answers, as one text: the token it was asked with, or the request's arguments
    (with its cursor, if the server repeats the arguments on later pages); a page without an
    echo, as a malformed one, answers for itself alone."""
    part = lambda c: F.to_json(F.struct(F.col(c).alias("v")))
    none = F.coalesce(*ECHO).isNull()
    later = F.coalesce(F.when(F.col("token_cursor") > 0, F.concat(F.lit("@"), F.col("token_cursor").cast("string"))), F.lit(""))
    return (F.when(none, F.concat(F.lit("page:"), F.col("path")))
             .when(F.length("request_token") > 0, F.concat(F.lit("token:"), F.col("request_token")))
             .otherwise(F.concat(F.lit("list:"), *[part(c) for c in ECHO[:3]], later)))


def last_answers(parsed: DataFrame) -> DataFrame:
    """One row per request: its last good page, or its last page if none was good, with
    ``request``, ``status``, ``n_records`` and ``landings``. A partial aggregate, so a
    request landed many times is one row per task before it moves."""
    status = status_of()
    rows = parsed.select(request_name().alias("request"), "path", _landed_at(parsed).alias("landed_at"), *ECHO, status.alias("status"),
                         array_len("records").cast("bigint").alias("n_records"), "resumption_token", "token_cursor", "complete_list_size")
    good = ~F.col("status").isin(*STATUS_CODES)
    others = [c for c in rows.columns if c != "request"]
    return rows.groupBy("request").agg(F.max_by(F.struct(*others), F.struct(good, "landed_at", "path")).alias("_v"),
                                       F.count(F.lit(1)).alias("landings")).select("request", "_v.*", "landings")


def ranked_pages(parsed: DataFrame) -> DataFrame:
    """Every answered request with its place in its list: ``head`` (the request the list starts
    with), ``place`` (0 for the head), ``issued`` (the request its token makes, NULL at the end),
    ``answered`` (whether that one landed) and ``circular`` (the list has no start).

    A page that answers a token no landed page issued is a head too (``orphan``)."""
    spark = parsed.sparkSession
    token = F.when(F.length(F.trim("resumption_token")) > 0, F.col("resumption_token"))
    pages = written(last_answers(parsed).withColumn("issued", F.concat(F.lit("token:"), token)), scratch_path(spark, "chain-pages"))
    # a token issued by two pages leads on from the one that landed last
    before = pages.where("issued IS NOT NULL").groupBy(F.col("issued").alias("request")).agg(
        F.max_by("request", F.struct("landed_at", "path")).alias("up"))
    ranks = pages.select("request").join(before, "request", "left").select(
        "request", F.coalesce("up", "request").alias("head"), F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("bigint").alias("place"),
        F.col("up").isNotNull().alias("open"))
    ranks = written(ranks, scratch_path(spark, "chain-ranks"))
    longest, reach = ranks.where("open").count(), 1
    while reach <= longest and not ranks.where("open").isEmpty():
        # every open row takes over its pointer's pointer: 2 ** round pages at a time
        far = ranks.select(F.col("request").alias("head"), F.col("head").alias("_head"), F.col("place").alias("_place"), F.col("open").alias("_open"))
        moving = ranks.where("open").join(far, "head").select(
            "request", F.col("_head").alias("head"), (F.col("place") + F.col("_place")).alias("place"), F.col("_open").alias("open"))
        ranks = written(ranks.where("NOT open").unionByName(moving), scratch_path(spark, "chain-ranks"))
        reach *= 2
    landed = pages.select(F.col("request").alias("issued"), F.lit(True).alias("_landed"))
    placed = pages.join(ranks, "request").join(landed, "issued", "left")
    circular = F.col("open")
    return placed.select("request", "path", "landed_at", *ECHO, "status", "n_records", "resumption_token", "token_cursor", "complete_list_size",
                         "landings", F.when(~circular, F.col("head")).alias("head"), F.when(~circular, F.col("place")).alias("place"), "issued",
                         F.when(F.col("issued").isNotNull(), F.coalesce("_landed", F.lit(False))).alias("answered"), circular.alias("circular"),
                         (F.col("request").startswith("token:") & (F.col("place") == 0) & ~circular).alias("orphan"))


def token_chains(parsed: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """One row per list: ``head``, its arguments, ``n_pages``, ``n_records``, the
    ``complete_list_size`` the server told, whether the list is ``complete`` (its last page
    issues no token and none of its pages failed), ``missing`` (records told of but not seen),
    ``orphan`` (its start is missing) and ``resume_url``, which asks for the page the list
    breaks off at."""
    ranked = ranked_pages(parsed).where(~F.col("circular"))
    failed = F.col("status").isin(*STATUS_CODES)
    # pre-aggregated per task, then per list: a list of any length stays one row
    lists = ranked.groupBy("head").agg(
        *[F.max_by(c, -F.col("place")).alias(c) for c in ECHO], F.count(F.lit(1)).alias("n_pages"), F.sum("n_records").alias("n_records"),
        F.max("complete_list_size").alias("complete_list_size"), F.count_if(failed).alias("failed_pages"),
        F.max_by(F.struct("resumption_token", "issued"), "place").alias("_last"), F.bool_or("orphan").alias("orphan"))
    broken = F.col("_last.issued").isNotNull()
    url = F.concat(F.lit(f"{base_url}?verb=ListRecords&resumptionToken="), F.replace(F.url_encode(F.col("_last.resumption_token")), F.lit("+"), F.lit("%20")))
    return lists.select("head", *ECHO, "n_pages", "n_records", "complete_list_size", "failed_pages", "orphan",
                        (~broken & (F.col("failed_pages") == 0)).alias("complete"),
                        F.when(F.col("complete_list_size").isNotNull(), F.greatest(F.col("complete_list_size") - F.col("n_records"), F.lit(0))).alias("missing"), F.when(broken, url).alias("resume_url"))


def page_attempts(parsed: DataFrame, gap_s: int = DEFAULT_GAP_S, client: str = "harvester") -> DataFrame:
    """A request log of landed pages: ``client``, ``request``, ``request_id``, ``attempt``
    (1-based), ``ts`` and ``status``.

    Each landing is an attempt at what its page answers. A run of attempts ends with a good
    answer, or with a silence of more than ``gap_s`` seconds; ``request_id`` names the request
    and the run. Runs are numbered by range, so a request landed very often is spread.
    """
    status = status_of()
    code = F.lit(GOOD_CODE)
    for name, c in STATUS_CODES.items():
        code = F.when(status == F.lit(name), F.lit(c)).otherwise(code)
    rows = parsed.select(request_name().alias("request"), "path", _landed_at(parsed).alias("ts"), code.alias("status"))
    numbered = number_rows(rows, ["request"], ["ts", "path"], out="n")
    seen = previous_row(numbered, ["request"], ["ts", "status"], rn="n")
    silence = F.unix_micros("ts") - F.unix_micros("prev_ts") > F.lit(gap_s * 1_000_000)
    fresh = (F.col("n") == 1) | (F.col("prev_status") == GOOD_CODE) | F.coalesce(silence, F.lit(False))
    runs = running_sum(sliced(seen.withColumn("_new", fresh.cast("int")), ["request"], ["n"]), ["request"], "_new", "run")
    first = runs.where("_new = 1").select("request", "run", F.col("n").alias("_n"))
    return runs.join(first, ["request", "run"]).select(
        F.lit(client).alias("client"), "request", F.concat("request", F.lit("#"), F.col("run").cast("string")).alias("request_id"),
        (F.col("n") - F.col("_n") + 1).cast("int").alias("attempt"), "ts", "status")
