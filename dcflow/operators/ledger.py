"""Run ledgers and request logs: summaries, batches, retries, pacing
(A3-A7, W1, W4).

Ledger rows are one request outcome each: ``n > 0`` records stored, ``0`` none,
``< 0`` failed (or ``failed``, where a ledger carries that column). Request-log rows are one HTTP attempt each.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import number_rows, previous_row
from .records import accepted, flatten_records, validate_records

# The batch size of a flush, the default attempts per request,
# the status codes the older client retried on, the pause between requests.
DEFAULT_BATCH_SIZE = 2000
DEFAULT_MAX_RETRIES = 3
LEGACY_RETRYABLE = (503, 429)
DEFAULT_DELAY_MS = 3000


def page_ledger(parsed: DataFrame, run_id: str = "", tagged: DataFrame | None = None) -> DataFrame:
    """The run ledger of landed pages: one row per request.

    A request is what the server echoed (set, from, until), or the token it was asked with, then
    named in ``page``; a page without an echo, as a malformed one may be, is a request of its
    own, named by its path there. ``n`` counts
    the records that ``validate_records`` accepts, over all the request's pages; ``failed``
    says that one of them is malformed or an error other than no-records and was not landed
    again as a good answer later, and leaves ``n`` as it is. ``elapsed_s`` runs from the request's first landed page to its last (NULL without
    landing times). ``tagged``: the pages' validated records, where there are any already.
    """
    from ..sources.pages import STATUS_ERROR, STATUS_MALFORMED, explode_records, status_of
    from .chains import request_name

    if tagged is None:
        tagged = validate_records(flatten_records(explode_records(parsed)))
    token = F.when(F.length("request_token") > 0, F.concat(F.lit("token:"), F.col("request_token")))
    page = F.when(F.coalesce("request_set", "request_from", "request_until").isNull(), F.coalesce(token, F.col("path")))
    keys = [F.col("request_set").alias("set_spec"), "request_from", "request_until", page.alias("page")]
    by = ["set_spec", "request_from", "request_until", "page"]
    landed = F.col("landed_at").cast("double") if "landed_at" in parsed.columns else F.lit(None).cast("double")
    pages = parsed.select(*keys, request_name().alias("answers"), status_of().isin(STATUS_MALFORMED, STATUS_ERROR).alias("bad"),
                          landed.alias("at"), "path")
    # of the landings that answer the same thing, the last one tells whether it failed
    each = pages.groupBy(*by, "answers").agg(F.max_by("bad", F.struct("at", "path")).alias("failed"),
                                             F.min("at").alias("first"), F.max("at").alias("last"))
    kept = accepted(tagged).select(*keys, F.lit(1).alias("n"), F.lit(False).alias("failed"),
                                   *[F.lit(None).cast("double").alias(c) for c in ("first", "last")])
    g = each.drop("answers").withColumn("n", F.lit(0)).unionByName(kept).groupBy(*by).agg(
        F.sum("n").cast("bigint").alias("n"), F.bool_or("failed").alias("failed"),
        (F.max("last") - F.min("first")).alias("elapsed_s"))
    return g.select(F.lit(run_id).alias("run_id"), "set_spec",
                    F.to_date(F.col("request_from").try_cast("timestamp_ntz")).alias("d"),
                    "page", "n", "failed", "elapsed_s")


def _failed(ledger: DataFrame) -> Column:
    """A request's failure: its own column, or ``n < 0`` in a ledger without one."""
    return F.col("failed") if "failed" in ledger.columns else F.col("n") < 0


def _summary_aggs(ledger: DataFrame) -> list[Column]:
    bad = _failed(ledger)
    return [
        F.count(F.lit(1)).alias("sets_processed"),
        F.count_if(~bad).alias("successful"),
        F.count_if(bad).alias("failed"),
        F.coalesce(F.sum(F.greatest("n", F.lit(0))), F.lit(0)).cast("bigint").alias("total_records"),
    ]


def harvest_summary(ledger: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """A3: requests processed, successful (n >= 0), failed (n < 0), and the
    total of records stored (sum of positive n)."""
    return ledger.groupBy(*by).agg(*_summary_aggs(ledger))


def throughput(total: Column | str, elapsed_s: Column | str) -> Column:
    """A4: records per minute, rounded to 2 places; 0 when elapsed is 0."""
    t = F.col(total) if isinstance(total, str) else total
    e = F.col(elapsed_s) if isinstance(elapsed_s, str) else elapsed_s
    return F.round(F.when(e > 0, t * F.lit(60.0) / e).otherwise(F.lit(0.0)), 2)


def run_throughput(ledger: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """A3 + A4 per run in one aggregate; the run's elapsed time is the sum of
    its requests' (NULL elapsed counts as 0)."""
    g = ledger.groupBy(*by).agg(*_summary_aggs(ledger),
                                F.coalesce(F.sum("elapsed_s"), F.lit(0.0)).alias("elapsed_s"))
    return g.withColumn("records_per_minute", throughput("total_records", "elapsed_s"))


def batch_summary(df: DataFrame, set_col: str = "set_spec",
                  size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """A5: per set, records, batches (ceil(n / size)) and the last batch's size."""
    g = df.groupBy(set_col).agg(F.count(F.lit(1)).alias("n_records"))
    nb = F.ceil(F.col("n_records") / F.lit(size)).cast("bigint")
    return g.withColumn("n_batches", nb).withColumn(
        "last_batch_size", (F.col("n_records") - (nb - 1) * F.lit(size)).cast("bigint"))


def assign_batches(df: DataFrame, order: Sequence[Column | str], set_col: str = "set_spec",
                   size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """``batch_no`` (0-based) and ``row_no`` (1-based) within each set's
    harvest in arrival ``order``; batches hold ``size`` rows, the last is partial.

    Numbering is skew-safe: a set too big for one task is split over many.
    """
    out = number_rows(df, [set_col], order, out="row_no")
    return out.withColumn("batch_no", F.floor((F.col("row_no") - 1) / F.lit(size)).cast("bigint"))


def resolve_attempts(log: DataFrame, max_retries: int = DEFAULT_MAX_RETRIES,
                     retryable: Iterable[int] | None = None,
                     by: Sequence[str] = ("client", "request_id")) -> DataFrame:
    """Replay each request's attempts as the client would have.

    Attempts are taken in ``attempt`` order up to ``max_retries``; the request
    stops at the first success (status < 400) or at the first failure that is
    not retryable (``retryable=None`` retries every failure; ``(503, 429)`` is
    the older client's rule). Output per request: ``succeeded``,
    ``attempts_used``, ``last_status``.
    """
    # the first rows by order, however they are numbered; the filter on row_number() is
    # applied before the shuffle too, so a request with many attempts stays small
    order = Window.partitionBy(*by).orderBy("attempt")
    a, st = F.col("_nth"), F.col("status")
    first = log.withColumn("_nth", F.row_number().over(order)).where(a <= F.lit(max_retries))
    if retryable is None:
        terminal = st < 400
    else:
        codes = [int(c) for c in retryable]
        terminal = (st < 400) | ~st.isin(codes)
    g = first.groupBy(*by).agg(
        F.min(F.when(terminal, a)).alias("_t_att"),
        F.min_by(st, F.when(terminal, a)).alias("_t_st"),
        F.max(a).alias("_l_att"),
        F.max_by(st, a).alias("_l_st"),
    )
    used = F.coalesce(F.col("_t_att"), F.col("_l_att"))
    last = F.when(F.col("_t_att").isNotNull(), F.col("_t_st")).otherwise(F.col("_l_st"))
    return g.select(*by, (last < 400).alias("succeeded"), used.alias("attempts_used"),
                    last.alias("last_status"))


def outcome_by_day(ledger: DataFrame) -> DataFrame:
    """Per set and day of a backfill: requests, records, and the outcome
    ``failed`` (any request failed), ``none`` (no records) or ``some``."""
    n = F.col("n")
    g = ledger.groupBy("set_spec", "d").agg(
        F.count(F.lit(1)).alias("requests"),
        F.coalesce(F.sum(F.greatest(n, F.lit(0))), F.lit(0)).cast("bigint").alias("records"),
        F.count_if(_failed(ledger)).alias("failures"),
    )
    outcome = (F.when(F.col("failures") > 0, F.lit("failed"))
                .when(F.col("records") == 0, F.lit("none"))
                .otherwise(F.lit("some")))
    return g.withColumn("outcome", outcome)


def pacing_audit(log: DataFrame, delay_ms: int = DEFAULT_DELAY_MS, client: str = "client",
                 order: Sequence[str] = ("ts", "request_id", "attempt")) -> DataFrame:
    """The wait each request still owed: ``max(0, delay - elapsed since
    the client's previous request)``; 0 for a client's first request.

    Adds ``wait_us`` (microseconds, exact) and ``violation`` (wait > 0).
    The previous request comes from skew-safe numbering plus an equi-join on
    ``(client, n - 1)``, so one busy client is spread over many tasks.
    """
    numbered = number_rows(log, [client], list(order), out="_n")
    with_prev = previous_row(numbered, [client], ["ts"], rn="_n").drop("_n")
    gap = F.timestamp_diff("MICROSECOND", F.col("prev_ts"), F.col("ts"))
    wait = F.when(F.col("prev_ts").isNull(), F.lit(0)) \
            .otherwise(F.greatest(F.lit(0), F.lit(delay_ms * 1000) - gap))
    return with_prev.withColumn("wait_us", wait.cast("bigint")) \
                    .withColumn("violation", F.col("wait_us") > 0) \
                    .drop("prev_ts")
