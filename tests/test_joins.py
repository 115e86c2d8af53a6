"""Joins with one key holding a third of the rows."""

import pytest
from prosewell.operators import joins
from prosewell.sources.tables import fan_out
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def big(spark):
    rows = spark.range(9000).withColumn(
        "word", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("w"), F.col("id") % 700))
    )
    return rows.cache()


@pytest.fixture(scope="module")
def small(spark):
    words = [("hot", 1), ("hot", 2)] + [(f"w{i}", i) for i in range(0, 900, 2)]
    return spark.createDataFrame(words, "word string, value int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sliced_join_equals_plain_join(big, small, how):
    plain = big.join(small, "word", how)
    sliced = joins.sliced_join(big, small, "word", how, slices=50)
    assert sliced.columns == plain.columns
    assert sorted(map(tuple, sliced.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_sliced_join_with_known_counts(big):
    counts = big.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    out = joins.sliced_join(big, counts, "word", rows_per_key="n", slices=50)
    assert out.count() == 9000
    assert out.filter("word = 'hot'").select("n").distinct().collect()[0][0] == 3000


def test_lookup_beyond_the_bound_gives_the_same(big, small):
    a = joins.lookup(big, small, "word").count()
    assert joins.lookup(big, small, "word", max_rows=5).count() == a


def test_broadcast_only_within_the_bound(big, small):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert joins.fits_broadcast(small)
    assert not joins.fits_broadcast(small, max_rows=10)
    assert not joins.fits_broadcast(small, max_bytes=100)
    assert "_slice" in plan(joins.lookup(big, small, "word", max_rows=5))
    assert "strategy=broadcast" in plan(joins.lookup(big, small, "word"))


def test_top_k_breaks_ties_by_the_given_order(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 1), ("b", 4, 0)], "g string, id int, x int")
    out = joins.top_k(df, "g", [F.desc("x"), F.asc("id")], 2)
    assert sorted((r.g, r.id, r["rank"]) for r in out.collect()) == [("a", 1, 1), ("a", 2, 2), ("b", 4, 1)]


def test_fan_out_spreads_a_single_file(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = fan_out(docs, "doc_id")
    assert out.select(F.spark_partition_id()).distinct().count() > 1
    assert out.count() == docs.count()


def test_deal_gives_tasks_a_bounded_share(spark, folder):
    """More bytes, more partitions; a key's rows stay together, so counts by key and word move nothing."""
    from prosewell.operators import terms
    from prosewell.sources.tables import deal

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    few, many = deal(docs, "doc_id"), deal(docs, "doc_id", 4_000)
    assert many.rdd.getNumPartitions() > 4 * few.rdd.getNumPartitions()
    twice = deal(docs.union(docs), "doc_id", 4_000).withColumn("p", F.spark_partition_id())
    assert twice.groupBy("doc_id").agg(F.countDistinct("p").alias("n")).filter("n > 1").isEmpty()
    counted = terms.count_tokens(terms.tokenize(many))
    assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert counted.count() == terms.term_counts(docs).count()


def test_count_tokens_query_deals_its_documents(spark, folder, monkeypatch):
    from prosewell.plans import text
    from prosewell.sources import tables

    monkeypatch.setattr(tables, "TASK_BYTES", 4_000)
    assert text.c7b(spark, folder).rdd.getNumPartitions() > 50


@pytest.mark.parametrize("how", ["inner", "left"])
def test_frequent_lookup_moves_rare_keys_only(spark, how):
    """Beyond the bounds the frequent keys are broadcast, the others joined by shuffle: the rows are those of one join."""
    words = [f"w{i}" for i in range(40)]
    rows = [(i, words[(i * i) % (1 + i % 40)]) for i in range(2_000)] + [(9_000, None), (9_001, "unknown")]
    big = spark.createDataFrame(rows, "id int, word string")
    small = big.filter("word LIKE 'w%'").groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    wanted = sorted(map(str, big.join(small, "word", how).select("id", "word", "df").collect()))
    for level in (F.floor(F.log2("df")), F.lit(0), F.lit(None), F.when(F.col("df") > 20, 1)):
        found = joins.frequent_lookup(big, small, "word", level, how, max_rows=20)
        assert sorted(map(str, found.select("id", "word", "df").collect())) == wanted
    found = joins.frequent_lookup(big, small, "word", F.floor(F.log2("df")), how, rows_per_key="df", max_rows=20)
    assert sorted(map(str, found.select("id", "word", "df").collect())) == wanted
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "LeftAnti" in plan


def test_sliced_join_counts_its_rows_once(spark):
    """Without counts given, the large side is read for the counts once, by the join once."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def look(i):
        seen.add(1)
        return i

    big = spark.range(1_000).select(look.asNondeterministic()((F.col("id") % 7).cast("int")).alias("k"), "id")
    small = spark.createDataFrame([(i, i) for i in range(7)], "k int, v int")
    assert joins.sliced_join(big, small, "k").count() == 1_000
    assert seen.value <= 2_000
