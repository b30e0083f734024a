import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from levyflow.llm.sharding import assign, write_shards
from tests.llm.tables import no_documents, odd_documents, prose


def bits(key) -> str:
    return bin(int(hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:15], 16))[2:].zfill(60)


def split(rows, limit, prefix=""):
    """The bucket of each row by splitting one bit at a time."""
    inside = [r for r in rows if r[0].startswith(prefix)]
    if sum(n for _, n in inside) <= limit or len({h for h, _ in inside}) <= 1:
        return {h: prefix for h, _ in inside}
    return split(inside, limit, prefix + "0") | split(inside, limit, prefix + "1")


@pytest.mark.parametrize("limit", [300, 5_000, 10**9])
def test_same_buckets_as_splitting_bit_by_bit(spark, limit):
    docs = odd_documents(spark)
    got = assign(docs, limit=limit).collect()
    rows = [(bits(r.doc_id), len((r.text or "").encode())) for r in docs.collect()]
    expected = split(rows, limit)
    assert len(got) == len(rows)
    assert all(r["shard"] == "b" + expected[bits(r["doc_id"])] for r in got)
    assert all(r["depth"] == len(r["shard"]) - 1 for r in got)


def test_a_hot_key_goes_to_pages_within_the_limit(spark):
    docs = spark.createDataFrame([(7, prose(20 + i % 5, i)) for i in range(900)] + [(i, "x") for i in range(100)],
                                 "doc_id long, text string")
    limit, pages = 4_000, defaultdict(int)
    for r in assign(docs, limit=limit).collect():
        pages[r["shard"], r["page"]] += r["bytes"]
    assert max(pages.values()) <= limit and len({s for s, _ in pages}) > 1


def test_a_row_over_the_limit_has_a_page_of_its_own(spark):
    docs = spark.createDataFrame([(1, "y" * 900), (1, "z" * 50), (1, "z" * 60)], "doc_id long, text string")
    got = {(r["bytes"], r["page"]) for r in assign(docs, limit=200).collect()}
    assert len({page for _, page in got}) == 2 and len(got) == 3


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = odd_documents(spark)
    shards = write_shards(docs, f"{tmp_path}/shards", limit=20_000)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(map(repr, back.select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))
    assert back.select("shard").distinct().count() == shards.count()
    sizes = assign(docs, limit=20_000).groupBy("shard").agg(F.count("*").alias("n"))
    assert {tuple(r) for r in back.groupBy("shard").count().collect()} == {tuple(r) for r in sizes.collect()}


def test_no_rows(spark, tmp_path):
    assert assign(no_documents(spark)).count() == 0


def test_columns_named_like_the_folders(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}", f"s{i}", i) for i in range(9)], "doc_id long, text string, shard string, page int")
    write_shards(docs, f"{tmp_path}/shards", limit=4)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert sorted(back.select(*docs.columns).collect()) == sorted(docs.collect())
    assert {"shard_", "page_"} <= set(back.columns) and back.select("shard_").distinct().count() > 1
