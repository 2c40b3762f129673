"""Line dedup: repeated line runs by distributed prefix doubling, later copies deleted.

A document is the sequence of its lines that hold a word. Lines are ranked by their 128-bit
hash; rank 2**(k+1) of a suffix comes from the pair of ranks at distance 2**k, and the
distinct pairs are numbered in order, so ranks sort suffixes as a suffix array does and each
rank with two or more members is a longest-common-prefix interval of depth 2**k. Suffixes
whose rank is theirs alone drop out of every later round.

A repeated run is deleted from every place but its first if it has at least ``min_words``
words. It is enough to look at shortest qualifying windows: a line inside a qualifying run
is also inside the shortest window of ``min_words`` words that starts, or that ends, at some
line of that run, and such windows are at most ``min_words`` lines long. A window of m lines
is identified by two overlapping ranks of depth 2**floor(log2 m), so log2(min_words) rounds
decide every run, however long it is, and overlapping windows add up to the maximal runs.

Documents are ordered by doc_id (null first), then by the hash of the text; the first copy
in that order stays. Defined results: blank lines separate nothing and are kept unless the
whole text goes; a null text has no lines and stays null; rows equal in doc_id and text are
one document and get the same result; a run may overlap its own copy (a line repeated over
and over keeps its first line); an empty table gives an empty result; other columns pass
through. Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_SPACE, WORD_SPACE_CLASS, free_prefix, staged

MIN_WORDS = 50
KEY = ["d", "t"]
#: stands for a null doc_id in join keys
NO_ID = -(2**63)


def _keys(docs: DataFrame) -> tuple[Column, Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)), F.xxhash64(text)


def line_table(docs: DataFrame) -> DataFrame:
    """(d, t, i, pos, h1, h2, words): one row per line with a word; i counts those lines,
    pos all lines of the text."""
    d, t = _keys(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("line")))
    lines = F.filter(lines, lambda x: F.btrim(x["line"], F.lit(WORD_SPACE)) != "")
    one = docs.select(d.alias("d"), t.alias("t"), F.posexplode(lines).alias("i", "x"))
    return one.select("d", "t", "i", "x.pos", F.xxhash64("x.line").alias("h1"),
                      F.xxhash64(F.lit("2"), "x.line").alias("h2"),
                      F.size(F.split(F.btrim("x.line", F.lit(WORD_SPACE)), WORD_SPACE_CLASS + "+")).alias("words"))


def _ranked(rows: DataFrame, by: list[str], keep: list[str], name: str, n_rows: int) -> DataFrame:
    """``keep`` and the order-preserving rank r of ``by``, for values met at least twice.
    ``n_rows``: about how many ``rows`` has."""
    classes = rows.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").select(*by)
    ranks = (classes.repartitionByRange(*by).sortWithinPartitions(*by)
             .select(*by, F.monotonically_increasing_id().alias("r")))
    # numbered once and written: a re-run task must not number anew
    ranks = staged(ranks, name + "-ranks", rows=n_rows // 2)
    return staged(rows.join(ranks, by).select(*keep, "r"), name, rows=n_rows)


def doubled(lines: DataFrame, depth: int) -> list[DataFrame]:
    """Ranks (d, t, i, r) of the runs of 1, 2, 4, ... lines up to ``depth`` lines that occur
    at least twice; the list ends early when no longer run repeats."""
    n_rows = lines.count()
    lines = lines.select(*KEY, "i", "words", "h1", "h2").distinct()
    levels = [_ranked(lines, ["h1", "h2"], [*KEY, "i", "words"], "lines-1", n_rows)]
    step = 1
    while 2 * step <= depth:
        now = levels[-1].select(*KEY, "i", "r")
        after = now.select(*KEY, (F.col("i") - step).alias("i"), F.col("r").alias("r2"))
        pairs = now.join(after, [*KEY, "i"]).withColumnRenamed("r", "r1")
        step *= 2
        n_rows = levels[-1].count()
        nxt = _ranked(pairs, ["r1", "r2"], [*KEY, "i"], f"lines-{step}", n_rows)
        if nxt.isEmpty():
            break
        levels.append(nxt)
    return levels


def _windows(base: DataFrame, min_words: int) -> DataFrame:
    """(d, t, i, m): the shortest windows of at least ``min_words`` words, among lines that
    repeat, that start or end at each line."""
    by_doc = Window.partitionBy(*KEY).orderBy("i")
    run = base.withColumn("island", F.col("i") - F.row_number().over(by_doc))
    w = Window.partitionBy(*KEY, "island").orderBy("i")
    ahead = F.collect_list("words").over(w.rowsBetween(0, min_words - 1))
    back = F.reverse(F.collect_list("words").over(w.rowsBetween(1 - min_words, 0)))

    def need(words: Column) -> Column:
        """How many leading elements reach min_words; null if all of them do not."""
        start = F.struct(F.lit(0).cast("long").alias("s"), F.lit(0).alias("m"))
        return F.aggregate(words, start, lambda a, x: F.when(a["s"] >= min_words, a).otherwise(
            F.struct((a["s"] + x).alias("s"), (a["m"] + 1).alias("m"))),
            lambda a: F.when(a["s"] >= min_words, a["m"]))

    run = run.select(*KEY, "i", ahead.alias("ahead"), back.alias("back"))
    run = run.select(*KEY, "i", need(F.col("ahead")).alias("fore"), need(F.col("back")).alias("aft"))
    both = run.select(*KEY, F.explode(F.array(
        F.struct(F.col("i"), F.col("fore").alias("m")),
        F.struct((F.col("i") - F.col("aft") + 1).alias("i"), F.col("aft").alias("m")))).alias("x"))
    return both.select(*KEY, "x.i", "x.m").where("m IS NOT NULL").distinct()


def later_copies(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d, t, i): the lines inside a run of ``min_words`` words or more that also occurs
    earlier."""
    levels = doubled(lines, min_words)
    ranks = None
    for k, level in enumerate(levels):
        part = level.select(F.lit(k).alias("k"), *KEY, "i", "r")
        ranks = part if ranks is None else ranks.unionAll(part)
    # floor(log2(m)) as the length of m in binary digits
    windows = _windows(levels[0], min_words).withColumn("k", F.length(F.bin(F.col("m").cast("long"))) - 1)
    head = ranks.select("k", *KEY, "i", F.col("r").alias("ra"))
    tail = ranks.select("k", *KEY, F.col("i").alias("j"), F.col("r").alias("rb"))
    found = (windows.withColumn("j", (F.col("i") + F.col("m") - F.expr("shiftleft(1, k)")).cast("int"))
             .join(head, ["k", *KEY, "i"]).join(tail, ["k", *KEY, "j"])
             .select(*KEY, "i", "m", "ra", "rb"))
    found = staged(found, "line-windows", rows=2 * levels[0].count())
    first = (found.groupBy("m", "ra", "rb").agg(F.min(F.struct(*KEY, "i")).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("m", "ra", "rb", "first"))
    later = found.join(first, ["m", "ra", "rb"]).where(F.struct(*KEY, "i") > F.col("first"))
    return later.select(*KEY, F.explode(F.sequence(F.col("i"), F.col("i") + F.col("m") - 1)).alias("i")).distinct()


def _deleted(docs: DataFrame, min_words: int) -> DataFrame:
    """(d, t, gone): the positions of the deleted lines of each document that loses any."""
    lines = staged(line_table(docs), "lines")
    gone = later_copies(lines, min_words).join(lines.select(*KEY, "i", "pos").distinct(), [*KEY, "i"])
    return gone.groupBy(*KEY).agg(F.collect_set("pos").alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, str]:
    """``docs`` with later copies deleted from ``text``, and three extra columns, whose names
    begin with the returned prefix: n_lines and n_deleted (of lines with a word), and changed."""
    p = free_prefix(docs, "l_")
    d, t = _keys(docs)
    own = [F.col(f"`{c}`") for c in docs.columns]
    gone = _deleted(docs, min_words).select(F.col("d").alias(p + "d"), F.col("t").alias(p + "t"), F.col("gone").alias(p + "gone"))
    out = docs.withColumns({p + "d": d, p + "t": t}).join(gone, [p + "d", p + "t"], "left")
    out = out.withColumns({p + "all": F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n"),
                           p + "changed": F.col(p + "gone").isNotNull()})
    at = F.array_except(F.sequence(F.lit(0), F.size(p + "all") - 1), F.col(p + "gone"))
    text = F.when(F.col(p + "changed"), F.array_join(F.transform(at, lambda i: F.get(F.col(p + "all"), i)), "\n")).otherwise(F.col("text"))
    out = out.withColumns({
        "text": text,
        p + "n_lines": F.size(F.filter(F.col(p + "all"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != "")).cast("long"),
        p + "n_deleted": F.when(F.col(p + "changed"), F.size(p + "gone")).otherwise(0).cast("long")})
    return out.select(*own, p + "n_lines", p + "n_deleted", p + "changed"), p


def drop_later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The columns of ``docs`` with later copies deleted; a document all of whose lines are
    later copies goes, and n_chars, where there is one, follows the text."""
    out, p = dedup_lines(docs, min_words)
    out = out.where(~(F.col(p + "changed") & (F.col(p + "n_deleted") == F.col(p + "n_lines"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(p + "changed"), F.length("text").cast(dict(docs.dtypes)["n_chars"]))
                             .otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
