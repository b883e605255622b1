"""Small tables for the tests."""


def make_docs(spark, rows):
    return spark.createDataFrame([(r[0], r[1], "x") for r in rows], "doc_id bigint, text string, item_id string")


def make_items(spark, rows):
    return spark.createDataFrame([(r[0], r[1], "y") for r in rows], "item_id bigint, text string, doc_id string")
