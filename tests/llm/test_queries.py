"""The registered queries, their SQL, and the pipeline's stages."""

import pytest

import corpus_pipeline
from parity import connect, differences
from tallymart.llm import queries


def test_one_query_an_operator():
    assert [int(name[2:].split("_")[0]) for name in queries.QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", queries.ORACLE_SQL)
def test_query_equals_its_sql(spark, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLE_SQL[name]) == []


def test_pipeline_takes_out_what_was_planted(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = docs.join(labels.where("toxic = 0 AND quality = 1"), "doc_id", "left_semi").where("n_chars > 1500")
    one, two = clean.orderBy("doc_id").limit(2).collect()
    words = one.text.split()
    passage = " ".join(f"planted{k} word" for k in range(40))
    extra = [
        (900_001, one.text),  # an exact copy
        (900_002, " ".join([*words[:-1], "different"])),  # a near copy
        (900_003, f"{' '.join(two.text.split()[:60])} begins {passage} ends here"),
        (900_004, f"something else {passage} and after"),
        (None, None),
    ]
    more = spark.createDataFrame(extra, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'s' AS source", "length(text) AS n_chars", "1 AS dropped_hash", "2 AS more"
    )
    docs = docs.selectExpr("*", "0 AS dropped_hash", "2 AS more").unionByName(more)
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name == "suffix dedup":
            left = {r.doc_id: r for r in docs.collect()}
            assert "planted7 word" not in left[900_003].text and "something else" in left[900_004].text
            assert all(r.n_chars == len(r.text) for r in left.values() if r.text is not None and r.doc_id)
        if name != "packing":
            assert docs.columns == more.columns
    toxic, exact, near, cut, packed = seen
    assert {one.doc_id, two.doc_id, 900_001, 900_002, 900_003, 900_004} <= toxic
    assert 900_001 in exact and one.doc_id not in exact
    assert len({900_001, 900_002, one.doc_id} & near) == 1 and {900_003, 900_004} <= near
    assert near == cut == packed and None in packed


def test_columns_pass_through_with_their_values(spark):
    docs = spark.createDataFrame([(1, "a", 7), (2, "b", 8), (None, "c", 9)], "doc_id long, text string, dropped_hash int")
    dropped = docs.where("doc_id <> 1").selectExpr("doc_id", "sha2(text, 256) AS text_sha256", "1 AS row_hash")
    left = corpus_pipeline.without(docs, dropped)
    assert sorted(r.dropped_hash for r in left.collect()) == [7, 9]


def test_a_text_that_occurs_once_stays_under_an_id_that_is_dropped(spark):
    rows = [(1, "a copied text", 5), (1, "an own text", 6), (2, "a copied text", 7), (3, None, 8), (3, None, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_hash int")
    left = corpus_pipeline.exact_copies(spark, docs, "")
    assert sorted((r.doc_id, r.text, r.row_hash) for r in left.collect() if r.text) == [
        (1, "an own text", 6), (2, "a copied text", 7)
    ]
    assert left.where("text IS NULL").count() == 1
    some, other = " ".join(f"a{k}" for k in range(90)), " ".join(f"b{k}" for k in range(90))
    near = spark.createDataFrame([(1, some), (2, f"{some} more"), (2, other)], "doc_id long, text string")
    left = corpus_pipeline.near_copies(spark, near, "")
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, some), (2, other)]


def test_pipeline_of_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        if "doc_id" in docs.columns and "text" in docs.columns:
            docs = stage(spark, docs, sf_dir)
            assert docs.count() == 0
