from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from edops.llm import queries as llm
from edops.llm.common import components, number_rows
from edops.session import stage
from llm_helpers import make, prose, words_of


def test_stages_on_odd_rows(spark, odd_docs, odd_rows):
    docs, counts = odd_docs, {}
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, "unused"), name)
        counts[name] = docs.count()
        if name != "packing":
            assert docs.columns == odd_docs.columns
        if name == "near_dedup":
            ids = [r[0] for r in docs.select("doc_id").collect()]
            assert len(set(ids)) == len(ids) and 7 not in ids and 9 not in ids and 6 in ids and 8 in ids
        if name == "substring_dedup":
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert texts[6] == odd_rows[5][1]  # nothing of it occurs earlier
            windows = [tuple(words_of(t)[i : i + 20]) for t in texts.values() for i in range(len(words_of(t)) - 19)]
            assert len(windows) == len(set(windows))
    assert counts["quality"] == sum(len(words_of(r[1])) >= 50 and not r[1].startswith("a a") and r[0] != 14 for r in odd_rows)


def test_documents_with_no_id_or_one_id_stay_unless_linked(spark):
    """Different texts stay whatever their ids; a passage that they share stays once."""
    shared = prose(70, 30)
    texts = [f"{prose(700 + i, 200)} {shared} {prose(800 + i, 200)}" for i in range(8)]
    ids = [None, None, None, None, 5, 5, 5, 6]
    rows = [(i, t, "en", "a") for i, t in zip(ids, texts)]
    copies = [(None, texts[0] + " more", "en", "a"), (None, texts[7] + " more", "en", "a"), (5, texts[4] + " more", "en", "a")]
    kept = stage(corpus_pipeline.near_dedup(spark, make(spark, rows + copies), "unused"), "near")
    got = kept.collect()
    assert len(got) == 8 and sorted(r["text"].removesuffix(" more") for r in got) == sorted(texts)
    assert (6, texts[7]) in {(r["doc_id"], r["text"]) for r in got}  # a key goes before none
    cut = corpus_pipeline.substring_dedup(spark, kept, "unused").collect()
    assert len(cut) == 8 and sum(shared in r["text"] for r in cut) == 1
    assert [r["doc_id"] for r in cut if shared in r["text"]] == [None]


def test_stages_on_an_empty_table(spark, no_docs):
    docs = no_docs
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, "unused"), name)
    assert docs.count() == 0


def test_registered():
    assert set(llm.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [name.split("_")[0] for name in llm.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_numbers_are_gapless_in_every_group(spark):
    df = stage(spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g")), "numbers")
    rows = number_rows(df, ["g"], ["id"], "at", rows_per_run=50).groupBy("g").agg(
        F.count("*").alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi"), F.countDistinct("at").alias("d")
    )
    assert all(r["lo"] == 0 and r["hi"] == r["n"] - 1 and r["d"] == r["n"] for r in rows.collect())


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)] + [(300 + i, 300 + (i + 1) % 9) for i in range(9)]
    edges += [(7, 3), (5, 5), (500, 499)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in [100, *range(200, 230)]} | {i: 300 for i in range(300, 309)} | {499: 499, 500: 499}


@pytest.mark.parametrize("name", [n for n in llm.QUERIES if int(n[2:].split("_")[0]) <= 10])
def test_queries_return_one_row_per_input_row(spark, name):
    got = llm.QUERIES[name](spark, entry.SMOKE_DIR)
    if name == "op4_linear_grouping":
        got = got.filter("piece = 0")
    table = {"op3": "pages", "op7": "embeddings"}.get(name.split("_")[0], "documents")
    assert got.count() == spark.read.parquet(f"{entry.SMOKE_DIR}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from compare import compare

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{entry.SMOKE_DIR}/{table}.parquet'")
    assert compare(llm.QUERIES[name](spark, entry.SMOKE_DIR), con, llm.ORACLES[name]) is None
