"""Incremental raw ingest: new files only, every file once, the batch reader's rules."""

import os
import tempfile

from tidystar.session import scratch_path
from tidystar.streaming.raw_stream import stream_raw_csv


def test_stream_picks_up_only_new_files(spark):
    src = tempfile.mkdtemp(prefix="tidystar-stream-src-")
    out = scratch_path(spark, "raw-stream-out")
    ckpt = scratch_path(spark, "raw-stream-ckpt")

    def drop(name, body):
        with open(os.path.join(src, name), "wb") as fh:
            fh.write(body)

    def run():
        stream_raw_csv(spark, src, out, ckpt).awaitTermination(120)
        return sorted((tuple(r) for r in spark.read.parquet(out).select("order_id", "status").collect()), key=repr)

    drop("a.csv", b"order_id,status\n1,ok\n2,NULL\n")
    drop("notes.txt", b"not data\n")
    assert run() == [("1", "ok"), ("2", None)]
    drop("b.csv", 'status,order_id\nEnvío,3\n'.encode("latin-1"))
    drop("c.csv", 'order_id,status\n4,"a\nb"\n'.encode())
    rows = [("1", "ok"), ("2", None), ("3", "Envío"), ("4", "a\nb")]
    assert run() == rows
    assert run() == rows  # nothing new: nothing changes
