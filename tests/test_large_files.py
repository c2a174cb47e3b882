"""Files of any size have a hash: what is above the size of one row is hashed as a stream."""

import hashlib
import inspect
import os

from daymart.sources import files


def test_streamed_hashes_equal_whole_ones(spark, tmp_path):
    held = {"a b+c%.csv": b"x,y\r\n1,2\n\n3,\xff\x00\n" * 5000, "no_end.csv": b"1\n\n2" * 3000, "only_ends.csv": b"\n" * 999,
            "mark.csv": b"\xef\xbb\xbfa\n" + b"b\n" * 500, "mark_no_end.csv": b"\xef\xbb\xbfa\n" + b"b" * 500,
            "one_line.csv": b"z" * 70_000, "random.parquet": os.urandom(200_000), "small.csv": b"1\n"}
    for name, raw in held.items():
        (tmp_path / name).write_bytes(raw)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")  # several splits a file
    try:
        whole = sorted(map(tuple, files.file_inventory(spark, str(tmp_path)).collect()))
        got = sorted(map(tuple, files.file_inventory(spark, str(tmp_path), whole_bytes=500).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == whole and sorted(x[2] for x in got) == sorted(hashlib.sha256(r).hexdigest() for r in held.values())


def test_no_size_is_refused_by_default():
    assert inspect.signature(files.file_inventory).parameters["max_bytes"].default is None
