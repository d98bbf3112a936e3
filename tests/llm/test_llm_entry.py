import __spark_entry__
from ledgerloom.llm.oracles import op9_base


def test_every_operator_has_one_query():
    names = __spark_entry__.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_base_spans_match_sql(spark, tmp_path):
    import duckdb

    texts = ["a.b@c.de and 4111 1111 1111 1111", "1.2.3.4 +1 (456) 555-2186 é 1.2.3.400", None, "x@y.z_d@e.f"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in __spark_entry__.queries()["op9_pii"](spark, str(tmp_path)).collect()}
    base = duckdb.connect()
    base.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == {r[0]: r[1:6] for r in base.sql(op9_base()).fetchall()}
