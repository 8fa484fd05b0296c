import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meldstone.llm import spelling

DOCS = "doc_id bigint, text string"


def counts_by_hand(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def neighbours(word, letters):
    for i in range(len(word) + 1):
        if i < len(word):
            yield word[:i] + word[i + 1 :]
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word) and c != word[i]:
                yield word[:i] + c + word[i + 1 :]


def by_hand(counts):
    letters = sorted({c for w in counts for c in w})
    near = {w: {x for x in neighbours(w, letters) if x in counts} - {w} for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def report(docs):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_report(docs).collect()}


def rows_of(rng, words, most):
    """Texts that hold each word as often as a falling law says, in other documents each time."""
    tokens = [w for w in words for _ in range(rng.choice([5, 6, 7, 25, 30, 150, most]))]
    rng.shuffle(tokens)
    cuts = range(0, len(tokens), 400)
    return [(i, rng.choice([" ", ", ", "-", "\n", "…"]).join(tokens[c : c + 400])) for i, c in enumerate(cuts)]


@pytest.mark.parametrize("letters, lengths, partitions", [("ab", (6, 11), 5), ("abcé", (6, 8), 2), ("abcdefghijÿ", (6, 30), 7)])
def test_report_equals_brute_force(spark, letters, lengths, partitions, monkeypatch):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(*lengths))) for _ in range(300)}
    for w in list(words)[:200]:
        words |= set(rng.sample(list(neighbours(w, letters)), 2))
    rows = rows_of(rng, sorted(words), 700)
    rows += [(None, "Aaaaaa " * 3), (10**6, None), (10**6 + 1, ""), (rows[0][0], rows[0][1])]
    counts = counts_by_hand(rows)
    assert len(counts) > 200
    docs = spark.createDataFrame(rows, DOCS).withColumns({"word": F.lit("clash"), "n": F.lit(1)}).repartition(partitions)
    want = by_hand(counts)
    assert report(docs) == want
    assert any(v[1] != k and v[1] != v[0] for k, v in want.items()) or letters != "ab"


def test_entries_of_many_words_are_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 40)
    rng = random.Random(8)
    words = sorted({"stemming" + "".join(rng.choice("abcd") for _ in range(rng.randint(2, 4))) for _ in range(400)})
    rows = rows_of(rng, words, 90)
    assert report(spark.createDataFrame(rows, DOCS)) == by_hand(counts_by_hand(rows))


def test_bounds_hold_for_every_edit():
    """Whatever the edit, all grams outside of the bound are found at the same place from one end."""
    rng = random.Random(5)
    for letters, size in (("ab", 60), ("abc", 300), ("abcdefgh", 2000)):
        grams = {a + b for a in letters + "\x02" for b in letters + "\x03"}
        grams |= {g + rng.choice(letters + "\x03") for g in rng.sample(sorted(grams), len(grams) // 2) if g[-1] != "\x03"}
        grams |= {g + rng.choice(letters) for g in sorted(grams) if len(g) == 3 and g[-1] != "\x03"}
        dictionary = spelling.Grams(grams, 4)
        for _ in range(150):
            word = "".join(rng.choice(letters) for _ in range(rng.randint(6, 12)))
            marked = f"\x02{word}\x03"
            first, last = dictionary.decompose(marked)
            bound = dictionary.bound(marked, first, last)
            own = {(marked[a : b + 1], a) for a, b in zip(first, last)}
            for other in set(neighbours(word, letters)) - {word}:
                changed = f"\x02{other}\x03"
                f, l = dictionary.decompose(changed)
                shift = len(changed) - len(marked)
                theirs = {(changed[a : b + 1], a) for a, b in zip(f, l)} | {(changed[a : b + 1], a - shift) for a, b in zip(f, l)}
                assert len(own & theirs) >= len(own) - bound, (word, other)


def test_chains_lead_to_one_root(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 624}
    rows = [(i * 7919 + 1, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    want = by_hand(counts_by_hand(rows))
    assert report(spark.createDataFrame(rows, DOCS)) == want
    assert want["aaaaaa"][:2] == ("aaaaab", "aaabbb") and want["aabbbb"][0] is None


def test_no_words(spark):
    assert report(spark.createDataFrame([], DOCS)) == {}
    assert report(spark.createDataFrame([(1, "short only ab"), (2, None)], DOCS)) == {}
    assert report(spark.createDataFrame([(1, "single " * 5)], DOCS))["single"] == (None, "single", 5, 0, None)


def test_long_words(spark):
    long = "ab" * 4000
    rows = [(i, " ".join([long, long + "c"] + ["x" * 3000] * 2)) for i in range(6)] + [(9, " ".join([long[1:]] * 40))]
    assert report(spark.createDataFrame(rows, DOCS)) == by_hand_of(rows)


def by_hand_of(rows):
    counts = counts_by_hand(rows)
    near = lambda a, b: a != b and abs(len(a) - len(b)) <= 1 and any(
        a[:i] == b[:i] and (a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i + 1 :] == b[i + 1 :]) for i in range(max(len(a), len(b)))
    )
    out = {}
    for w in counts:
        others = [x for x in counts if near(w, x)]
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= 5 * counts[w] else None
        out[w] = (form, form or w, counts[w], len(others), counts.get(form))
    return out
