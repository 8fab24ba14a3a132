import hashlib
import os
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lectio.llm import warc_index as W


def payload(row):
    return (row.html or "").encode()


def test_round_trip(odd_pages, no_pages, tmpdir_path):
    pages = odd_pages.collect()
    index = W.write_archives(odd_pages, folder=tmpdir_path)
    got = W.read_archives(index).collect()
    first = defaultdict(list)
    for p in pages:
        if len(payload(p)) >= W.MIN_REVISIT_BYTES and p.page_id is not None:
            first[payload(p)].append(p.page_id)
    want = Counter()
    for p in pages:
        body = payload(p)
        refers = min(first[body]) if first.get(body) and min(first[body]) != p.page_id else None
        want[p.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if refers is not None else "response",
             None if refers is None else str(refers), None if refers is not None else body] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                    None if r.payload is None else bytes(r.payload)) for r in got) == want
    assert W.read_archives(W.write_archives(no_pages)).count() == 0


def test_archives_are_sequences_of_gzip_members(odd_pages, tmpdir_path):
    index = W.write_archives(odd_pages, folder=tmpdir_path).collect()
    for name in {r.archive for r in index}:
        own = sorted((r.offset, r.length) for r in index if r.archive == name)
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False))
        path = os.path.join(tmpdir_path, os.path.basename(name))
        assert own[-1][0] + own[-1][1] == os.path.getsize(path)
        raw, seen = open(path, "rb").read(), 0
        while raw:
            member = zlib.decompressobj(31)
            text = member.decompress(raw)
            assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            raw, seen = member.unused_data, seen + 1
        assert seen == len(own)


def test_only_selected_ranges_are_read(spark, tmpdir_path):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"),
                                    F.repeat(F.concat(F.lit("body "), "id"), 40).alias("html"))
    index = W.write_archives(pages, folder=tmpdir_path)
    got = W.read_archives(index, F.col("page_id") % 7 == 3).collect()
    assert sorted(r.page_id for r in got) == [i for i in range(400) if i % 7 == 3]
    assert all(bytes(r.payload) == b"body %d" % r.page_id * 40 and r.url == f"http://h/{r.page_id}" for r in got)
    spoiled = index.withColumn("offset", F.col("offset") + 1)
    try:
        W.read_archives(spoiled).collect()
    except Exception:  # noqa: BLE001
        return
    raise AssertionError("a wrong offset must not pass")


def test_reading_tasks_get_bytes_not_rows(spark, tmpdir_path):
    """Records of very different lengths are dealt by their bytes, to as many
    tasks as the archives' bytes ask for."""
    noise = F.concat_ws("", *(F.sha2(F.concat(F.lit(f"{i}-"), F.col("id")), 512) for i in range(12)))
    pages = spark.range(600).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(noise, F.when(F.col("id") % 20 == 0, 8).otherwise(1)).alias("html"))
    index = W.write_archives(pages.repartition(3), folder=tmpdir_path)
    total = index.agg(F.sum("length")).first()[0]
    dealt = W._dealt(index.select("page_id", "archive", "offset", "length"), 50_000)
    assert dealt.rdd.getNumPartitions() == -(-total // 50_000) > 4
    sizes = [r[1] for r in dealt.groupBy(F.spark_partition_id()).agg(F.sum("length")).collect()]
    assert sum(sizes) == total and max(sizes) < 3 * 50_000
    assert sorted(r.page_id for r in W.read_archives(index, task_bytes=50_000).collect()) == list(range(600))


def test_stores_by_the_names_spark_uses(tmpdir_path):
    assert W.open_store(f"file://{tmpdir_path}")[1] == W.open_store(tmpdir_path)[1]
    assert W.open_store("dbfs:/mnt/x")[1] == "/dbfs/mnt/x"
    for uri in ("wasbs://c@a.example/x", "odd://x/y"):
        with pytest.raises(ValueError, match="archives can't be kept"):
            W.open_store(uri)
