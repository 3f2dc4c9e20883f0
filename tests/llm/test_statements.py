"""The SQL statements of the joins give the operators' rows, here on awkward rows (scripts/check_oracle.py: on the test tables)."""

import duckdb
from llm_fixtures import AWKWARD, awkward  # noqa: F401

from varsift.llm import decontaminate, jaccard_join


def _rows(frame, columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def _duck(sql, docs, items, columns):
    con = duckdb.connect()
    con.register("documents", docs)
    con.register("benchmark", items)
    rel = con.sql(sql)
    at = [rel.columns.index(c) for c in columns]
    return sorted((tuple(r[k] for k in at) for r in rel.fetchall()), key=repr)


ITEMS = [("a", "one two three four five six seven eight nine ten eleven twelve"), ("b", "Single!"), ("b", "two words"),
         ("c", None), ("d", " ,;"), (None, "a document without an id"), ("e", "word " * 40), ("f", "eleven twelve")]


def test_statements_give_the_operators_rows(spark, awkward):  # noqa: F811
    docs, items = awkward.select("doc_id", "text"), spark.createDataFrame(ITEMS, "item_id string, text string")
    for got, sql in ((jaccard_join.classes(docs), jaccard_join.SQL), (decontaminate.contract(docs, items), decontaminate.SQL)):
        rows = _rows(got, got.columns)
        assert rows == _duck(sql, docs.toArrow(), items.toArrow(), got.columns) and len(rows) == len(AWKWARD)
