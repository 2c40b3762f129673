import random

import pytest

from dcflow.llm import linededup, simhash
from dcflow.llm.common import FILE_ROWS, only_the_last, staged
from dcflow.session import list_names


@pytest.fixture()
def many_partitions(spark):
    """Shuffles into 24 partitions that are not put together."""
    own = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def files(spark, path):
    return sum(x.startswith("part-") for x in list_names(spark, path))


def corpus(spark):
    rnd = random.Random(3)
    shared = [[" ".join(f"s{k}{i}w{j}" for j in range(12)) for i in range(8)] for k in range(20)]
    rows = []
    for i in range(200):
        own = [" ".join(f"d{i}l{k}w{j}" for j in range(12)) for k in range(4)]
        rows.append((i, "\n".join(own[:2] + rnd.choice(shared) + own[2:])))
        rows.append((1000 + i, rows[-1][1].replace(f"d{i}l0w0", "edited")))
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def test_line_tables_go_into_as_many_files_as_their_rows_need(spark, many_partitions):
    with only_the_last(spark) as made:
        assert linededup.drop_later_copies(corpus(spark)).count() > 0
        n = {p.rsplit("/", 1)[1].rsplit("-", 1)[0]: files(spark, p) for p in made}
    assert {"lines-1", "lines-1-ranks", "lines-4", "line-windows"} <= set(n)
    assert set(n.values()) == {1}, n


def test_fingerprints_and_components_go_into_few_files(spark, many_partitions):
    with only_the_last(spark) as made:
        assert simhash.keep_one(corpus(spark)).count() < 400
        n = [(p.rsplit("/", 1)[1].rsplit("-", 1)[0], files(spark, p)) for p in made]
    assert {"simhash-distinct", "components"} <= {name for name, _ in n}
    assert {k for _, k in n} == {1}, n


def test_a_number_of_rows_cuts_no_row(spark, many_partitions):
    rows = spark.range(0, 3 * FILE_ROWS, 1, 12)
    for known in (0, 1, FILE_ROWS, FILE_ROWS + 1, 100 * FILE_ROWS):
        with only_the_last(spark) as made:
            out = staged(rows, "rows", rows=known)
            assert out.distinct().count() == 3 * FILE_ROWS
            assert files(spark, made[0]) == min(12, max(1, -(-known // FILE_ROWS)))
    assert staged(rows.limit(0), "rows", rows=0).count() == 0
