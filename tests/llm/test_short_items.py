"""Items of one to four words are found inside longer documents."""

import duckdb

from skuflow.llm import decontaminate, queries

SF = "/root/testdata/sf0.001"


def test_short_items_inside_documents(make, spark):
    docs = make([(1, "a long text that says Alpha, beta GAMMA delta and goes on"), (2, "alpha beta gamma delta"),
                 (3, "alpha beta gamma and delta in other places of a long text"), (4, "omega"), (5, None),
                 (6, "one OMEGA among the other letters"), (None, "one OMEGA among the other letters"), (7, "gamma delta and"),
                 (7, "gamma delta and"), (8, "alphabeta gamma delta")])
    items = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "Omega!"), (3, "gamma delta and"), (4, ""), (5, None),
                                   (6, "omega")], "item_id long, text string")
    got = sorted((str(r["doc_id"]), r["item_id"], r["n_items"], r["m"], r["matched"])
                 for r in decontaminate.find_leaks(docs, items).collect())
    assert got == [("1", 1, 1, 1, 1), ("1", 3, 1, 1, 1), ("2", 1, 1, 1, 1), ("4", 2, 2, 1, 1), ("6", 2, 2, 1, 1),
                   ("7", 3, 1, 1, 1), ("None", 2, 2, 1, 1)]
    kept = [r["doc_id"] for r in decontaminate.decontaminate(docs, items).collect()]
    assert sorted(kept, key=str) == [3, 5, 8]


def test_short_items_match_sql(spark):
    """The given tables with short items taken from the documents' own words."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    con.execute(f"""CREATE TABLE benchmark AS SELECT item_id, text FROM '{SF}/benchmark.parquet' UNION ALL
        SELECT 1000000 + doc_id * 10 + n, array_to_string(string_split_regex(trim(text), '\\s+')[3:2 + n], ' ')
        FROM documents, range(1, 5) r(n) WHERE doc_id % 20 = 0 AND text IS NOT NULL""")
    want = con.execute(queries.SQL["op2_decontaminate"]).fetchall()
    items = spark.createDataFrame(con.execute("SELECT item_id, text FROM benchmark").fetchall(), "item_id long, text string")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = [(r["doc_id"], r["item_id"], r["n_items"], r["m"], r["matched"], r["matched"] / r["m"])
           for r in decontaminate.find_leaks(docs, items).collect()]
    assert sorted(got) == sorted(want) and len({r[3] for r in got}) > 1 and sum(r[3] == 1 for r in got) > 10
