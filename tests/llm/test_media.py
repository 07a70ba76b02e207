"""Shards: equal payloads of different tasks, and compaction."""

import hashlib
import io
import os
import tarfile

from pyspark.sql import functions as F

from kinfold.llm import media


def test_equal_payloads_of_many_tasks_and_compaction(spark, tmp_path):
    folder = f"file://{tmp_path}/media"
    docs = spark.range(0, 400, 1, 8).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 50).cast("string")).alias("text"))
    got = media.media_columns(docs, folder=folder).collect()
    assert len(got) == 400 and len({(r.shard, r.offset) for r in got}) == 50
    files = os.listdir(f"{tmp_path}/media")
    assert set(files) == {r.shard for r in got}  # what seven of eight tasks wrote is gone
    held = sum(len(tarfile.open(f"{tmp_path}/media/{f}").getnames()) for f in files)
    assert held == 50
    for r in got[:20]:
        with open(f"{tmp_path}/media/{r.shard}", "rb") as file:
            file.seek(r.offset)
            data = media.decode_png(file.read(r.length))
        text = f"text {r.doc_id % 50}".encode()
        assert data == text + bytes(64 - len(text)) and hashlib.sha256(data).hexdigest() == r.digest == r.payload_sha256
    with tarfile.open(f"{tmp_path}/media/{files[0]}") as tar:
        assert all(n.endswith(".png") and media.png_header(io.BytesIO(tar.extractfile(n).read()).read())[0] == 64 for n in tar.getnames())


def test_shards_with_little_waste_stay(spark, tmp_path):
    folder = f"file://{tmp_path}/media"
    docs = spark.range(0, 90, 1, 3).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 30 == 0, "same").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    got = media.media_columns(docs, folder=folder).collect()
    assert len(os.listdir(f"{tmp_path}/media")) == 3 and len({r.digest for r in got}) == 88
