import pytest
from pyspark.sql import functions as F

from meldstone.llm import language_id

DOCS = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DOCS)
    rows = language_id.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out and lang is not null")
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    accepted = held.where("accepted").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert accepted[0] >= right and accepted[1] > 0.95 * held.count()
    low, high = rows.agg(F.min("score"), F.max("score")).first()
    assert 0 <= low <= high <= 1
    assert rows.count() == docs.count()


@pytest.fixture(scope="module")
def model():
    english = b"the house of the man and the dog was there with their mother and that father in the town"
    german = "das haus der mutter und der hund war dort mit dem vater und die kinder in der stadt".encode()
    return language_id.LanguageModel({"en": english, "de": german})


@pytest.mark.parametrize("text", [None, "", "  \n", "123 ### 4.5", "_²_"])
def test_nothing_to_tell(model, text):
    assert model.guess(text) == ("und", 0.0, False)


def test_guesses(model):
    assert model.guess("The dog and the man of the town")[0] == "en"
    assert model.guess("DER HUND!! UND!! DIE!! KINDER!! DER!! STADT!! " * 5000)[0] == "de"
    assert model.guess("xx") == ("en", 0.0, False)  # a tie: the first language, not accepted
    assert language_id.LanguageModel({}).guess("text") == ("und", 0.0, False)
    assert language_id.LanguageModel({"fr": b"le la les"}).guess("le") == ("fr", 1.0, True)


SCHEMA = "doc_id bigint, text string, lang string, language string"


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(i, "the dog and the man of the town there", "en", "x") for i in range(20)]
    rows += [(i, "der hund und die kinder der stadt dort", "de", None) for i in range(20, 40)]
    rows += [(None, None, None, None), (41, "", "en", None), (42, "word", None, None), (None, "the man", "xx", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    report = language_id.language_report(docs.union(docs))
    assert report.count() == 2 * len(rows)
    assert {r["lang_pred"] for r in report.collect()} == {"en", "de", "und"}
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {(r["doc_id"], r["language"]) for r in kept.where("doc_id < 40").collect()} == {(r[0], r[3]) for r in rows[:40]}
    assert language_id.language_report(docs.limit(0)).count() == 0
    assert language_id.language_report(docs.where("lang is null")).where("lang_pred != 'und'").count() == 0


def test_sample_is_bounded_under_copies(spark):
    docs = spark.range(4000).selectExpr("id doc_id", "if(id % 2 = 0, 'same text', concat('text no ', id)) text", "'en' lang")
    model = language_id.learn(docs, sample_texts=10)
    assert 0 < len(model.dictionaries["en"]) < 2000


def test_language_of_few_texts_and_many_copies_is_learned(spark):
    words = ["casa", "perro", "ciudad", "madre", "padre"]
    skewed = spark.range(20_000).selectExpr(f"concat(array('{"','".join(words)}')[id % 5], ' de la') text", "'es' lang")
    plain = spark.range(300).selectExpr("concat('the word no ', id) text", "'en' lang")
    model = language_id.learn(skewed.union(plain))
    assert list(model.dictionaries) == ["es", "en"]
    assert all(word.encode() in model.dictionaries["es"] for word in words)


@pytest.mark.parametrize("texts", [1, 200, 201, 10**6, 209_715_201, 10**12])
def test_share_of_any_number_of_texts(texts):
    expected = (language_id._highest_hash(texts, 200) + 1 + (1 << 63)) * texts / (1 << 64)
    assert expected == pytest.approx(min(texts, 200), rel=1e-6)


def test_every_language_keeps_a_text(spark):
    docs = spark.range(50).selectExpr("concat('word ', repeat('x', cast(id as int))) text", "'en' lang")
    assert b"word" in language_id.learn(docs, sample_texts=0).dictionaries["en"]
