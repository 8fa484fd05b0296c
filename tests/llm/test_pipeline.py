"""Each stage against what it should do to its own input, and the whole against brute force."""

import base64
import hashlib
import os

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from meldstone.llm import language_id, pii
from tests.llm.test_decontamination import plain as plain_passages
from tests.llm.test_near_dedup import plain_components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def brute(docs, items, model):
    """The rows that all stages keep, with redacted text."""
    kept = [d for d in docs if model.guess(d[1]).accepted]
    classes = plain_components([(d[0], d[1]) for d in kept])
    kept = [d for d in kept if d[0] is None or classes[d[0]] == d[0]]
    leaks = {place for place, _ in plain_passages(kept, items, cut=False)}
    kept = [d for place, d in enumerate(kept) if place not in leaks]
    return [(d[0], pii.redacted(d[1], pii.find_spans(d[1]))) for d in kept]


def check(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_id.learn_from_documents(docs)
    items = rows_of(spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text"))
    want = brute(rows_of(docs.select("doc_id", "text")), items, model)
    with open(corpus_pipeline.RANK_FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f.read().splitlines())}
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc_id, text in want:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        expected.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    got = corpus_pipeline.run(spark, folder)
    result = rows_of(got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
    assert sorted(result, key=str) == sorted(expected, key=str)
    return result


def test_whole_table(spark):
    assert 0 < len(check(spark, SF)) < spark.read.parquet(f"{SF}/documents.parquet").count()


def write(spark, folder, docs, items, schema=SCHEMA):
    spark.createDataFrame(docs, schema).write.parquet(os.path.join(folder, "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(os.path.join(folder, "benchmark.parquet"))


def test_odd_rows(spark, tmp_path):
    base = "the house of the man and the dog was there with their mother and that father in the town by river {}"
    other = "das haus der mutter und der hund war dort mit dem vater und die kinder in der grossen stadt {}"
    docs = [(i, base.format("x" * i) + f" and then {i * 7919}", "en", "s", 5) for i in range(12)]
    docs += [(i, other.format("y" * i) + f" noch {i * 7919} mal", "de", None, None) for i in range(12, 24)]
    docs += [(None, None, None, None, None), (30, "", "en", "s", 0), (31, None, "en", None, None), (None, base.format("mail a@b.co"), "en", "", 1)]
    docs += [docs[3], docs[3], (40, "we meet the long item of a benchmark here with all of its many words in a row today and then go home with the dog", "en", "s", 1)]
    write(spark, str(tmp_path), docs, [(1, "the long item of a benchmark here with all of its many words in a row"), (None, None)])
    check(spark, str(tmp_path))


def test_empty_tables(spark, tmp_path):
    write(spark, str(tmp_path), [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("place", range(4))
def test_stages_keep_the_columns(spark, tmp_path, place):
    schema = SCHEMA + ", id string, record_key string, dropped string, language string, found string, pii string, key int"
    docs = [(i, f"the man and the dog of the town {i * 7919}", "en", "s", 5, "a", "b", "c", "d", "e", "f", i) for i in range(8)]
    write(spark, str(tmp_path), docs, [(1, "nothing of this is in there at all")], schema)
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.STAGES[place][1](spark, frame, str(tmp_path))
    assert out.columns == frame.columns
    assert set(rows_of(out)) <= set(docs)
