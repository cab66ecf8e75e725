"""Tasks without rows, tables without rows and batches without letters, for every text operator."""

import pytest

from spindle.llm import bpe, cws, katz, langid, licenses, mixing, pii, quality, sharding, simhash
from spindle.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TWO = [(1, "one two three mail a.b@c.de", "en", "s", 27), (2, "uno dos tres", "es", "s", 12)]
LETTERLESS = [(i, "12 34 !!", "en", "s", 8) for i in range(20)] + [(99, "a word", "en", "s", 6)]


def labels(spark):
    return spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")


def encoded(docs):
    path = tokenizer_path()
    return bpe.encode_texts(docs, path, bpe.ship(docs.sparkSession, bpe.build_lexicon(docs, path)))


OPERATORS = {
    "licenses": licenses.scan, "langid": langid.predict, "simhash": simhash.near_duplicates,
    "keep_one": simhash.keep_one, "katz": katz.score_texts, "cws": cws.next_likeness,
    "quality": lambda d: quality.rate(d, labels(d.sparkSession)), "pii": pii.find, "redact": pii.redact,
    "sharding": sharding.assign, "digests": lambda d: bpe.digests(d, tokenizer_path()), "encoded": encoded,
}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("rows", [[], TWO, LETTERLESS], ids=["none", "two", "letterless"])
def test_tasks_without_rows(spark, name, rows):
    docs = spark.createDataFrame(rows, DOCS).repartition(8)
    kept = 2 if name == "keep_one" and rows is LETTERLESS else len(rows)  # its copies go
    assert OPERATORS[name](docs).count() == kept


@pytest.mark.parametrize("rows", [[], TWO], ids=["none", "two"])
def test_mixing_and_pipeline_without_rows(spark, scratch, rows):
    import corpus_pipeline

    docs = spark.createDataFrame(rows, DOCS).repartition(8)
    assert mixing.replicate(docs).count() <= 4 * len(rows)
    docs.write.parquet(f"{scratch}/documents.parquet")
    labels(spark).write.parquet(f"{scratch}/labels.parquet")
    assert corpus_pipeline.run(spark, scratch).count() <= 2 * len(rows)
