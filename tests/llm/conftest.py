import pytest

# Texts every operator has to take: nothing, blanks, signs at which splitters differ, special strings, long ones, ties.
ODD_TEXTS = [
    None,
    "",
    "   ",
    "\r\n 　 x",
    "a  b\t\tc \n\n d\x1c e\x85f\xa0g  ",
    "<|endoftext|> x<|startoftext|>  y  <|endoftext|>",
    "don't 'll we'd '' 'rest 中文 字 ñ ́e ǅ ٣ İΣς 😀",
    "é" * 700,
    "x" * 9000,
    "ab " * 3000,
    "one",
    "One two",
    "one two",
    "one two three",
]


@pytest.fixture(scope="session")
def odd_docs(spark, sf_dir, tmp_path_factory):
    """Part of documents, odd texts, a repeated row and columns with names that operators use themselves."""
    base = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 300").select("doc_id", "text")
    odd = [(10**6 + k, t) for k, t in enumerate(ODD_TEXTS)] + [(10**6 + 50, "one two three")]
    frame = base.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    frame = frame.selectExpr("doc_id", "text", "'k' AS key", "1 AS n_tokens", "2L AS `group`", "3 AS component_id", "4 AS spans")
    path = str(tmp_path_factory.mktemp("odd") / "docs")
    frame.repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def texts(odd_docs):
    return {r.doc_id: r.text or "" for r in odd_docs.collect()}


@pytest.fixture(scope="session")
def repeated(spark):
    """Two rows that are equal in id and text, one without an id, and a null text."""
    rows = [(1, "same text here"), (1, "same text here"), (None, "same text here"), (2, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")
