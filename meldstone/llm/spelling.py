"""Spelling variant grouping over a variable-length gram index.

Words are the runs of letters of all texts, counted with a partial sum per task. Two words
are near if one inserted, deleted or replaced code point leads from one to the other.

1. A dictionary of grams of 2 to 4 code points is grown level by level over the distinct
   words (each between two end marks): a gram is lengthened only while it is frequent, so
   rare grams stay short and common ones give way to longer, rarer ones. A gram is frequent
   above one ``SHARES``-th of all gram places; fewer than SHARES grams of each length can
   be, which bounds the dictionary that tasks receive.
2. A word decomposes into the longest dictionary gram at each place, without grams that lie
   inside of one before them. For every edit that can hit the word, the grams it may affect
   are counted from the dictionary's prefixes and suffixes: those over the place, those to
   the left that a longer gram could swallow once other letters follow, those to the right
   likewise. The largest count is the word's bound: a near word has all other grams as well,
   at the same distance from its beginning or from its end.
3. List merging: of the grams that two near words share, the rarest one is among the
   (bound + 1) rarest grams of either, so only those enter the index. Entries bear the gram,
   its place from the side that stays, and the length of the longer word. Words that meet in
   an entry are compared by a letter sum first, which an edit changes by one letter or the
   difference of two; what is left is verified on the words themselves.
4. Words without a gram outside of their bound find each other in a second index of plain
   pairs of letters, where an edit affects two grams and at least one is left.

An entry that many words share is dealt over pairs of blocks of at most ``BLOCK`` words, so
no task holds all of it.

Defined results: NULL and empty texts have no words; a NULL id counts as an empty one in
the edit rule; repeated rows count again; words may be of any length; a word without near
words has none in n_near and itself as root; a table without words gives no rows. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldstone.llm.common import batches_of, share_package
from meldstone.sources.storage import materialise

LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_FACTOR = 5
EDIT_EVERY = 199

SHORTEST_GRAM = 2
LONGEST_GRAM = 4
#: A gram is frequent above total / SHARES places, and above FEWEST in any case.
SHARES = 4000
FEWEST = 20
#: Words of an index entry that a task holds for each side.
BLOCK = 4096

_BEGIN, _END = "\x02", "\x03"
# Pairs of words compared at a time.
_PAIRS = 2_000_000
# Distinct words that a counting task holds before it hands them on.
_HELD_WORDS = 400_000
_BATCH_TEXTS = 500

# Latin-1 bytes of runs, A-Z in lower case; all other bytes part runs.
_RUNS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
_LETTERS = [chr(c) for c in range(97, 123)] + [chr(c) for c in range(0xC0, 0x100)]
_LETTER_VALUES = dict(zip(_LETTERS, np.random.default_rng(13).integers(1, 1 << 62, len(_LETTERS)).tolist(), strict=True))
_MASK = (1 << 64) - 1


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[bytes, int] = {}

    def given() -> pd.DataFrame:
        words = pd.Series([w.decode("latin-1") for w in held], dtype=object)
        return pd.DataFrame({"word": words, "n": pd.Series(list(held.values()), dtype="int64")})

    for batch in batches:
        for key, text in zip(batch["doc_id"], batch["text"], strict=True):
            if not text:
                continue
            start = zlib.crc32(b":" if key is None or key != key else b"%d:" % int(key))
            # What is not in Latin-1 becomes a question mark, which parts runs as well.
            runs = text.encode("latin-1", "replace").translate(_RUNS).split(b" ")
            for run, n in Counter(runs).items():
                if len(run) < LEAST_LENGTH:
                    continue
                h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
                if h % EDIT_EVERY == 0:
                    place = h % len(run)
                    run = run[:place] + run[place + 1 :]
                    if len(run) < LEAST_LENGTH:
                        continue
                held[run] = held.get(run, 0) + n
        if len(held) >= _HELD_WORDS:
            yield given()
            held = {}
    yield given()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    rows = docs.select("doc_id", "text")
    with batches_of(docs.sparkSession, _BATCH_TEXTS):
        counted = rows.mapInPandas(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
        return materialise(counted.where(F.col("n") >= LEAST_COUNT), "words")


class Grams:
    """A gram dictionary, closed under prefixes of SHORTEST_GRAM code points and more."""

    def __init__(self, grams: Iterable[str], longest: int):
        self.grams = frozenset(grams)
        self.longest = longest
        # What a dictionary gram can begin or end with, itself left out.
        self.beginnings = frozenset(g[:k] for g in self.grams for k in range(1, len(g)))
        self.endings = frozenset(g[-k:] for g in self.grams for k in range(1, len(g)))
        self._hashes: dict[str, int] = {}

    def decompose(self, marked: str) -> tuple[list[int], list[int]]:
        """First and last places of the grams of a marked word; both ascend."""
        first, last, reached, length = [], [], -1, len(marked)
        for i in range(length - SHORTEST_GRAM + 1):
            size = min(self.longest, length - i)
            while size > SHORTEST_GRAM and marked[i : i + size] not in self.grams:
                size -= 1
            if i + size - 1 > reached:
                reached = i + size - 1
                first.append(i)
                last.append(reached)
        return first, last

    def bound(self, marked: str, first: list[int], last: list[int]) -> int:
        """Largest number of grams that one edit between the end marks can affect."""
        worst, length = 0, len(marked)
        for i in range(1, length):
            # Left of place i: from here on a gram may swallow others once other letters follow.
            low = max(0, i - SHORTEST_GRAM + 1)
            for start in range(max(0, i - self.longest + 1), low):
                if marked[start:i] in self.beginnings:
                    low = start
                    break
            # An insertion before i leaves what begins at i; a replacement or deletion of i, what begins after it.
            for right in (i, i + 1) if i < length - 1 else (i,):
                high = right + SHORTEST_GRAM - 2
                for end in range(min(length - 1, right + self.longest - 2), high, -1):
                    if marked[right : end + 1] in self.endings:
                        high = end
                        break
                beyond = max(bisect_right(first, right - 1), bisect_right(last, high))
                worst = max(worst, beyond - bisect_left(first, low))
        return worst

    def hash(self, gram: str) -> int:
        if gram not in self._hashes:
            if len(self._hashes) > 200_000:
                self._hashes.clear()
            self._hashes[gram] = xxhash.xxh64_intdigest(gram) >> 1
        return self._hashes[gram]


def _gram_counts(size: int, frequent: frozenset[str] | None):
    """Per task: in how many places grams of ``size`` stand whose beginning is frequent."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[str] = Counter()
        for batch in batches:
            for word in batch["word"]:
                marked = _BEGIN + word + _END
                grams = (marked[i : i + size] for i in range(len(marked) - size + 1))
                found.update(grams if frequent is None else [g for g in grams if g[:-1] in frequent])
        yield pd.DataFrame({"gram": pd.Series(list(found), dtype=object), "n": pd.Series(list(found.values()), dtype="int64")})

    return count


def build_dictionary(words: DataFrame, longest: int = LONGEST_GRAM) -> tuple[Grams, dict[str, int]]:
    """The pruned dictionary, and how frequent each of its grams is."""
    counts: dict[str, int] = {}
    frequent, limit = None, 0
    for size in range(SHORTEST_GRAM, longest + 1):
        parts = words.mapInPandas(_gram_counts(size, frequent), "gram string, n bigint")
        level = {r["gram"]: r["n"] for r in parts.groupBy("gram").agg(F.sum("n").alias("n")).collect()}
        counts |= level
        limit = limit or max(FEWEST, sum(level.values()) // SHARES)
        frequent = frozenset(g for g, n in level.items() if n > limit)
        if not frequent:
            break
    return Grams(counts, longest), counts


def _mix(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[0]), dtype=np.uint64)
    for part in parts:
        h = (h ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


# Sides of an entry: the shorter or the longer word of a pair, or both where lengths are equal.
_SHORTER, _LONGER, _BOTH = 0, 1, 2
_ENTRIES = "entry bigint, side int, id bigint, letters bigint"


def _indexed(grams: Grams, counts: dict[str, int], layer: int):
    """Index entries of words (word, id); entries of different layers never meet."""

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            gram, place, length, number = [], [], [], []
            for k, word in enumerate(batch["word"]):
                marked = _BEGIN + word + _END
                first, last = grams.decompose(marked)
                bound = grams.bound(marked, first, last)
                texts = [marked[a : b + 1] for a, b in zip(first, last, strict=True)]
                rarest = sorted(range(len(texts)), key=lambda i: (counts.get(texts[i], 0), texts[i], i))[: bound + 1]
                gram += [grams.hash(texts[i]) for i in rarest]
                place += [first[i] for i in rarest]
                length += [len(word)] * len(rarest)
                number += [k] * len(rarest)
            letters = np.array([sum(map(_LETTER_VALUES.__getitem__, w)) & _MASK for w in batch["word"]], dtype=np.uint64)
            gram, place, length, number = (np.array(c, dtype=np.int64) for c in (gram, place, length, number))
            ids, letters = batch["id"].to_numpy()[number], letters.view(np.int64)[number]
            # The same place from the end, told apart from places from the beginning.
            from_end = ~(length - place)
            found = []
            for side, longer, ends in ((_BOTH, length, [place]), (_SHORTER, length + 1, [place, from_end]), (_LONGER, length, [place, from_end])):
                for end in ends:
                    kind = np.full(len(gram), 2 * layer + (side == _BOTH))
                    found.append(pd.DataFrame({"entry": _mix(kind, gram, end, longer), "side": side, "id": ids, "letters": letters}))
            yield pd.concat(found, ignore_index=True)

    return index


def _unbound(grams: Grams):
    """Words all of whose grams one edit may affect."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            marked = [_BEGIN + w + _END for w in batch["word"]]
            parts = [grams.decompose(m) for m in marked]
            loose = [grams.bound(m, *p) >= len(p[0]) for m, p in zip(marked, parts, strict=True)]
            yield batch[loose].astype({"word": object})

    return keep


class LetterSums:
    """Which differences of letter sums one edit can make."""

    def __init__(self):
        values = np.array(list(_LETTER_VALUES.values()), dtype=np.int64)
        both = (values[:, None] - values[None, :])[~np.eye(len(values), dtype=bool)]
        self.replaced, self.inserted = np.sort(both), np.sort(values)
        self._quick = {True: self._bits(self.replaced), False: self._bits(self.inserted)}

    @staticmethod
    def _bits(differences: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << 16, dtype=bool)
        bits[differences & 0xFFFF] = True
        return bits

    def possible(self, differences: np.ndarray, equal: bool) -> np.ndarray:
        """Places of the differences that one edit explains."""
        at = np.flatnonzero(self._quick[equal][differences & 0xFFFF])
        known = self.replaced if equal else self.inserted
        found = np.searchsorted(known, differences[at])
        return at[known[np.minimum(found, len(known) - 1)] == differences[at]]


def _met(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of words that share an entry and differ like near words; rows come sorted by (entry, i, j, side)."""
    sums, held = LetterSums(), None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if not len(rows):
            continue
        entry, i, j = (rows[c].to_numpy() for c in ("entry", "i", "j"))
        new = (entry[1:] != entry[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        starts = np.flatnonzero(np.concatenate([[True], new]))
        held = rows.iloc[starts[-1] :]
        yield from _pairs(rows.iloc[: starts[-1]], starts[:-1], sums)
    if held is not None:
        yield from _pairs(held, np.array([0]), sums)


def _pairs(rows: pd.DataFrame, starts: np.ndarray, sums: LetterSums) -> Iterator[pd.DataFrame]:
    """Pairs within the groups of ``rows`` that begin at ``starts``."""
    if not len(rows):
        return
    side, equal, ids, letters = (rows[c].to_numpy() for c in ("side", "equal", "id", "letters"))
    size = len(rows)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, size)))
    ends = np.append(starts[1:], size)[group]
    # Longer words stand behind the shorter ones they meet; words of one length meet those behind them.
    shorter = np.bincount(group[side == _SHORTER], minlength=len(starts))
    begin = np.where(side == _BOTH, np.arange(size) + 1, starts[group] + shorter[group])
    partners = np.where(side == _LONGER, 0, ends - begin)
    so_far = np.cumsum(partners)
    low = 0
    while low < size:
        before = so_far[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(so_far, before + _PAIRS, side="right")))
        count = partners[low:high]
        left = np.repeat(np.arange(low, high), count)
        right = begin[left] + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        difference = letters[right] - letters[left]
        for same in (True, False):
            chosen = np.flatnonzero(equal[left] == same)
            at = chosen[sums.possible(difference[chosen], same)]
            a, b = ids[left[at]], ids[right[at]]
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
        low = high


def _dealt(entries: DataFrame) -> DataFrame:
    """Entries with the pair (i, j) of blocks in which their words meet; (0, 0) but for wide entries."""
    wide = entries.groupBy("entry").agg(F.count("*").alias("words")).where(F.col("words") > BLOCK)
    wide = materialise(wide.select("entry", F.ceil(F.col("words") / BLOCK).cast("int").alias("blocks")), "wide-entries")
    blocks, side = F.col("blocks"), F.col("side")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    every = F.sequence(F.lit(0), blocks - 1)

    def at(side: Column, i: Column, j: Column) -> Column:
        return F.struct(side.alias("side"), i.alias("i"), j.alias("j"))

    # Words of one length stand on either side there.
    before = F.when(side != _LONGER, F.transform(every, lambda j: at(F.lit(_SHORTER), own, j)))
    behind = F.when(side != _SHORTER, F.transform(every, lambda i: at(F.lit(_LONGER), i, own)))
    spread = F.flatten(F.array_compact(F.array(before, behind)))
    single = F.array(at(side, F.lit(0), F.lit(0)))
    dealt = entries.join(wide, "entry", "left").withColumn("at", F.explode(F.when(blocks.isNull(), single).otherwise(spread)))
    return dealt.select("entry", "at.i", "at.j", "at.side", (side == _BOTH).alias("equal"), "id", "letters")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b): every two near words of ``words`` (word, n), once, with their counts, as a written table."""
    keyed = words.select("word", F.xxhash64("word").alias("id"))
    grams, counts = build_dictionary(words)
    entries = keyed.mapInPandas(_indexed(grams, counts, 0), _ENTRIES)
    plain, plain_counts = build_dictionary(words, SHORTEST_GRAM)
    unbound = keyed.mapInPandas(_unbound(grams), keyed.schema)
    entries = entries.unionByName(unbound.mapInPandas(_indexed(plain, plain_counts, 1), _ENTRIES))
    dealt = _dealt(materialise(entries, "entries"))
    dealt = dealt.repartition("entry", "i", "j").sortWithinPartitions("entry", "i", "j", "side")
    met = dealt.mapInPandas(_met, "a bigint, b bigint").distinct()
    for end in ("a", "b"):
        named = words.select(F.xxhash64("word").alias(end), F.col("word").alias(f"word_{end}"), F.col("n").alias(f"n_{end}"))
        met = met.join(named, end)
    near = met.where(F.levenshtein("word_a", "word_b", 1) == 1)
    return materialise(near.select(F.col("word_a").alias("a"), F.col("word_b").alias("b"), "n_a", "n_b"), "near-words")


def forms(words: DataFrame, near: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest count, where it is FORM_FACTOR times as frequent."""
    one_way = near.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n"))
    other_way = near.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("falling"), "other"))
    partners = one_way.unionByName(other_way).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    followed = -F.col("best.falling") >= FORM_FACTOR * F.col("n")
    return words.join(partners, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(followed, F.col("best.other")).alias("form"),
        F.when(followed, -F.col("best.falling")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: where the forms lead in the end.

    Counts grow with every form, so there is no way back; each round doubles the way gone.
    """
    ways = materialise(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "ways")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = ways.join(onward, "root", "left")
        moved = ahead.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        ways = materialise(moved, "ways")
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")


def spelling_report(docs: DataFrame) -> DataFrame:
    """One row per word: its form, the root that forms lead to, its count, its near words and its form's count."""
    share_package(docs.sparkSession)
    words = count_words(docs)
    formed = materialise(forms(words, near_pairs(words)), "forms")
    named = formed.join(roots(formed), "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
