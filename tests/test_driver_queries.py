import duckdb

from lumenframe.functions.text import numbers_in
from lumenframe.plans import driver_queries as q

D = "/root/testdata/sf0.001"


def by_sql(name, *tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return con.execute(q.SQL[name]).fetchall()


def test_reference_lists_of_all_orders(spark):
    got = q.QUERIES["resolve_reference_lists"](spark, D)
    assert sorted(map(tuple, got.collect())) == sorted(by_sql("resolve_reference_lists", "lineitem"))
    assert got.count() == spark.read.parquet(f"{D}/lineitem.parquet").select("l_orderkey").distinct().count()


def test_postings_of_all_tokens(spark):
    got = q.QUERIES["inverted_index"](spark, D).collect()
    assert sorted(map(tuple, got)) == sorted(by_sql("inverted_index", "conversations"))


def test_numbers_of_whole_texts(spark):
    rows = spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").collect()
    want = [(r.doc_id, i, n["raw_text"], n["numeric_value"], n["number_kind"], n["unit"]) for r in rows for i, n in enumerate(numbers_in(r.text) or [])]
    got = q.QUERIES["numeric_values"](spark, D).collect()
    assert want and sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
