"""The files of a set's batches."""

from collections import defaultdict

from pyspark.sql import functions as F

from dcflow.session import list_names
from dcflow.sources.table import write_set_batches


def test_one_file_a_batch_and_one_folder_a_set(spark, tmp_dir):
    rows = [(f"k{i}", None if i % 7 == 0 else "" if i % 7 == 1 else f"s{i % 2}", i) for i in range(300)]
    write_set_batches(spark.createDataFrame(rows, "header_identifier string, set_spec string, pos long"), tmp_dir + "/b", ["pos"], 10)
    folders = [n for n in list_names(spark, tmp_dir + "/b") if n.startswith("set_spec=")]
    assert sorted(folders) == ["set_spec=__HIVE_DEFAULT_PARTITION__", "set_spec=s0", "set_spec=s1"]
    assert not [n for f in folders for n in list_names(spark, f"{tmp_dir}/b/{f}") if not n.endswith((".parquet", ".crc"))]

    back = spark.read.schema("header_identifier string, row_no long, batch_no long, set_spec string").parquet(tmp_dir + "/b")
    files = defaultdict(list)
    for r in back.withColumn("file", F.col("_metadata.file_path")).collect():
        files[r.file].append(r)
    want = defaultdict(list)
    for key, set_spec, _ in rows:
        want[set_spec or None].append(key)
    assert sorted((str(rs[0].set_spec), rs[0].batch_no, [(r.header_identifier, r.row_no) for r in rs]) for rs in files.values()) == sorted(
        (str(s), n, [(k, 10 * n + j + 1) for j, k in enumerate(keys[10 * n:10 * n + 10])]) for s, keys in want.items() for n in range((len(keys) + 9) // 10))
