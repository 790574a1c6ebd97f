"""Stages decide by row: null and repeated ids follow their own text."""

from collections import Counter

from pyspark.sql import functions as F

from daybook.llm import content_sort, ngram_join, positional_index
from daybook.llm.tables import ROW, by_row

SCHEMA = "doc_id long, text string, lang string, n long"
LONG = " ".join(f"w{i}" for i in range(60))


def rows(spark, *pairs):
    return spark.createDataFrame([(i, t, "en", 3) for i, t in pairs], SCHEMA)


def left(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_row_numbers_keep_the_order_of_ids(spark):
    docs = spark.range(200).select(F.when(F.col("id") % 7 > 0, F.col("id") % 60 - 5).alias("doc_id"), F.col("id").alias("n"))
    found = by_row(docs.repartition(5)).collect()
    assert len({r[ROW] for r in found}) == 200
    ids = {r.doc_id for r in found if r.doc_id is not None}
    assert {r[ROW] for r in found if r[ROW] == r.doc_id} == ids
    assert all(r[ROW] > max(ids) for r in found if r[ROW] != r.doc_id)
    assert by_row(spark.range(5).select(F.col("id").alias("doc_id"))).where(f"{ROW} <> doc_id").isEmpty()


def test_exact_copies(spark):
    docs = rows(spark, (5, "a copy"), (5, "only here"), (2, "a copy"), (None, "a  copy"), (None, "no id"), (7, "twice"), (7, "twice"), (8, None), (None, ""))
    assert left(content_sort.keep_first(docs)) == Counter(
        {(None, "a  copy"): 1, (5, "only here"): 1, (None, "no id"): 1, (7, "twice"): 1, (8, None): 1})
    assert content_sort.keep_first(docs).columns == docs.columns
    assert content_sort.keep_first(docs.limit(0)).collect() == []


def test_near_copies(spark):
    docs = rows(spark, (5, LONG), (5, "only here of course it is"), (3, LONG + " tail"), (None, "head " + LONG), (4, "x"), (None, None), (None, ""))
    assert left(ngram_join.keep_first(docs)) == Counter(
        {(3, LONG + " tail"): 1, (5, "only here of course it is"): 1, (4, "x"): 1, (None, None): 1, (None, ""): 1})
    assert left(ngram_join.keep_first(rows(spark, (None, LONG), (None, LONG)))) == Counter({(None, LONG): 1})


def test_contaminated(spark):
    bench = spark.createDataFrame([(1, "the secret answer"), (2, None)], "item_id long, text string")
    docs = rows(spark, (7, "clean text"), (7, "this is The Secret Answer"), (None, "the secret answer"), (None, "clean"), (9, None))
    assert left(positional_index.keep_clean(docs, bench)) == Counter({(7, "clean text"): 1, (None, "clean"): 1, (9, None): 1})
