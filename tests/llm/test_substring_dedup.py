import numpy as np
import pandas as pd
import pytest

from meldstone.llm import substring_dedup as sd

SCHEMA = "doc_id bigint, text string, cut string"


def passage(rng, count):
    return " ".join("".join(rng.choice("abcdefghiéß") for _ in range(rng.randrange(2, 9))) for _ in range(count))


def test_gear_hash_equals_its_definition(rng):
    raw = np.array([rng.randrange(256) for _ in range(200)], dtype=np.uint8)
    got = sd.gear_hashes(raw)
    for i in range(len(raw)):
        want = sum(int(sd._GEAR[raw[i - j]]) << j for j in range(min(16, i + 1))) % 65536
        assert got[i] == want


def test_chunks_cover_the_text_and_resist_shifts(rng):
    text = passage(rng, 4000) + "é" * 5000 + "x" * 3000
    found = sd.chunks_of(text)
    assert [c[0] for c in found] == [0, *[c[1] for c in found[:-1]]] and found[-1][1] == len(text)
    assert all(len(text[c[0] : c[1]].encode()) <= sd.MOST_BYTES for c in found)
    moved = sd.chunks_of(text[:1000] + " inserted words " + text[1000:])
    digests = {c[3:] for c in found}
    assert sum(c[3:] not in digests for c in moved) < 8


def common_runs(a, b):
    """Places of ``a`` in runs of LEAST_WORDS words or more that ``b`` has too."""
    n = sd.LEAST_WORDS
    have = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)}
    return {i + k for i in range(len(a) - n + 1) if tuple(a[i : i + n]) in have for k in range(n)}


def word_places(text, spans):
    """Numbers of the words that lie in the spans of a report."""
    starts, at = [], 0
    for word in text.split():
        at = text.index(word, at)
        starts.append((at, at + len(word)))
        at += len(word)
    cut = [tuple(map(int, s.split(":"))) for s in spans.split(",") if s]
    return {i for i, (a, b) in enumerate(starts) if any(x <= a and b <= y for x, y in cut)}


def test_report_equals_plain_search(spark, rng):
    docs = [(i, passage(rng, rng.randrange(5, 200))) for i in range(40)]
    for k in range(40):
        common = passage(rng, rng.randrange(44, 130))
        docs += [(100 + 3 * k + c, f"{passage(rng, rng.randrange(60))} {common}\n {passage(rng, rng.randrange(60))}".strip()) for c in range(rng.choice([2, 3]))]
    docs += [(300 + i, docs[i][1]) for i in range(5)] + [(3, docs[3][1]), (4, "other text"), (None, None), (None, passage(rng, 90)), (401, ""), (402, " \n")]
    rows = sd.repeat_report(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)).collect()
    assert len(rows) == len(docs)
    records = {(i, t): t.split() for i, t in docs if i is not None}
    texts = {i: t for i, t in docs if i is not None and i != 4}
    for r in rows:
        if r["doc_id"] not in texts:
            continue
        text = texts[r["doc_id"]]
        own = text.split()
        want = set().union(*(common_runs(own, w) for (i, t), w in records.items() if i != r["doc_id"]))
        before = set().union(*(common_runs(own, w) for (i, t), w in records.items() if i < r["doc_id"]))
        assert word_places(text, r["shared_spans"]) == want and r["shared_words"] == len(want)
        assert word_places(text, r["repeated_spans"]) == before and r["repeated_words"] == len(before)


def test_runs_that_grow_together_count_the_words_between_once():
    run = {"kind": "shared", "n_words": 30, "between": 4, "head_chars": 0, "head_words": 0, "tail_chars": 0, "tail_words": 0}
    runs = [run | {"start": 0, "end": 100, "between": -1, "tail_chars": 15, "tail_words": 3}]
    runs += [run | {"start": 120, "end": 220, "head_chars": 10, "head_words": 2}]
    frame = pd.DataFrame({"doc_id": [1], "text_key": [2], "first_doc": [0], "runs": [runs]})
    out = next(sd._passages(iter([frame])))
    assert out["shared"][0] == [{"start": 0, "end": 220}] and out["shared_words"][0] == 64


@pytest.mark.parametrize(
    "own, other, side, want",
    [("a b c", "x b c", "head", (3, 2)), ("  a b", "a b", "head", (3, 2)), ("a  b ", "z b ", "head", (2, 1)), ("", "a", "head", (0, 0)),
     ("a b c", "a b x", "tail", (4, 2)), ("a b", "a b c", "tail", (3, 2)), ("ab", "a", "tail", (0, 0))],
)
def test_equal_words(own, other, side, want):
    assert sd.equal_words(own, other, side) == want


def test_removal_keeps_first_occurrences_and_columns(spark, rng):
    common, tail = passage(rng, 80), passage(rng, 30)
    docs = [(1, common, "a"), (2, f"{tail} {common} {tail}", None), (3, "short", "c"), (None, None, None), (4, "", "d")]
    frame = spark.createDataFrame(docs, SCHEMA)
    out = sd.remove_repeats(frame)
    assert out.columns == frame.columns
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[1]["text"] == common and rows[3]["text"] == "short" and rows[4]["text"] == "" and rows[None]["text"] is None
    assert len(rows[2]["text"]) < len(docs[1][1]) - len(common) / 2 and rows[2]["text"].startswith(tail[:20])
    assert rows[1]["cut"] == "a"
    assert sd.remove_repeats(frame.limit(0)).count() == sd.repeat_report(frame.limit(0)).count() == 0


@pytest.mark.parametrize("text", [None, "", " ", "\n\n", "a", "é", "x" * 100_000])
def test_odd_texts(text):
    found = sd.chunks_of(text)
    assert "".join((text or "")[a:b] for a, b, *_ in found) == ((text or "") if (text or "").strip() else "")


def test_passages_of_51_words_are_marked_whole_and_shorter_ones_left(spark, rng):
    docs, count = [], 300
    for i in range(count):
        common = passage(rng, 51 if i % 2 else 45)
        docs += [(2 * i + k, f"{passage(rng, rng.randrange(60))} {common} {passage(rng, rng.randrange(60))}", None) for k in (0, 1)]
    rows = sd.repeat_report(spark.createDataFrame(docs, SCHEMA)).collect()
    assert all(r["shared_words"] == (51 if r["doc_id"] // 2 % 2 else 0) for r in rows)
