"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dcflow.session import remove_path, scratch_path

#: the six white-space characters of the word rule ``[^\x20\x09-\x0D]+``
WORD_SPACE = " \t\n\x0b\f\r"
WORD_SPACE_CLASS = r"[\x20\x09-\x0D]"
#: a staged table of which the rows are known goes into one file for about so many
FILE_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, text string) of a table, every row kept; a null text is empty."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def only_the_last(spark: SparkSession) -> Iterator[list[str]]:
    """Inside, what ``staged`` writes is noted; at the end all of it goes but the last table,
    which must be all that is still read. (Nothing goes if the block fails.)"""
    made: list[str] = []
    mark = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(mark)
    for path in made[:-1]:
        remove_path(spark, path)


def staged(df: DataFrame, name: str, partition_by: str | None = None, rows: int | None = None) -> DataFrame:
    """Write a result to the shared scratch folder and read it back: the lineage ends
    there, so a lost executor costs a re-read and not a re-run of what came before.

    ``rows``: about how many there will be, if known. A small table then goes into few files,
    however many shuffle partitions there are: each file costs requests to the store (in a
    local folder, four ``chmod`` processes beside the executor) and a task that reads it. All
    rows are written, more than that too. Not for rows numbered by TaskContext, as a task then
    writes several partitions."""
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    path = scratch_path(df.sparkSession, name)
    made = _made.get()
    w = df.write.mode("error").option("compression", "zstd")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_prefix(df: DataFrame, base: str) -> str:
    """A column-name prefix that no column of ``df`` starts with (names clash otherwise)."""
    names = [c.lower() for c in df.columns]
    while any(c.startswith(base) for c in names):
        base = "_" + base
    return base


def count_chars(text: Column, char_class: str) -> Column:
    """How many characters of a text belong to a regular-expression class."""
    return F.length(text) - F.length(F.regexp_replace(text, char_class + "+", ""))
