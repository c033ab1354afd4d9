"""Document queries against their DuckDB SQL, on whole tables and on edge cases."""

import duckdb
import pyarrow.parquet as pq
from oracle_check import compare, rows_of

from gapscan.llm import oracle
from gapscan.llm.conversations import op13_repair
from gapscan.llm.quality import op3_quality
from gapscan.llm.spelling import op11_spelling
from gapscan.llm.warc import op9_warc

SF = "/root/testdata/sf0.001"


def test_whole_tables(spark):
    assert compare(spark, SF, ["op3_quality", "op9_warc", "op11_spelling", "op13_repair"]) == []


def same(spark, tmp_path, table, df, query, sql):
    """Both engines read the same single file."""
    path = f"{tmp_path}/{table}.parquet"
    pq.write_table(df.toArrow(), path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    found, expected = query(spark, str(tmp_path)).toPandas(), con.execute(sql).df()
    assert rows_of(found) == rows_of(expected)
    return len(expected)


def test_edge_documents(spark, tmp_path, edge_docs):
    assert same(spark, tmp_path, "documents", edge_docs, op3_quality, oracle.OP3_SQL)


def test_edge_words(spark, tmp_path, edge_docs):
    forms = ["straße", "weather", "wether", "weathers", "Weather", "wéather", "ÉTÉnduë", "éténduë", "aaaaaaaa", "aaaaaaaaa"]
    texts = [(i if i % 5 else None, " ".join(w for k, w in enumerate(forms) if i % (k * k + 1) == 0)) for i in range(400)]
    docs = edge_docs.select("doc_id", "text").unionByName(spark.createDataFrame(texts, "doc_id long, text string"))
    assert same(spark, tmp_path, "documents", docs, op11_spelling, oracle.OP11_SQL)


def test_edge_pages(spark, tmp_path):
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(
        [None, "", "a", "a", "é😀", "é😀", "WARC/1.1\r\n\r\nx", "line\n\nline", "x" * 300_000])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert same(spark, tmp_path, "pages", pages, op9_warc, oracle.OP9_SQL) == len(rows)


def test_edge_conversations(spark, tmp_path):
    roles = ["system", "user", "assistant", "tool", "", None, "user"]
    texts = ["A.", "b", None, "", " \t\n", "A.", "Why?", "no end,", "é!"]
    rows = [(c if c < 30 else None, None if (c + t) % 11 == 0 else t - t // 7, roles[(c * t + t) % 7],
             texts[(c + 2 * t) % 9]) for c in range(31) for t in range(c)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert same(spark, tmp_path, "conversations", table, op13_repair, oracle.OP13_SQL) == 30
