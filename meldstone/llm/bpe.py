"""Byte-level BPE encoding and decoding by replaying merges over a block of words.

Texts are split into words; the distinct words not met before form a block.
Over a block an inverted index leads from a merge rank to the positions of pairs that
merge at this rank. Ranks are taken in ascending order; each is applied to all its
positions at once, and only the two neighbours of a merged pair get new index entries.
Words do not touch each other, so replaying blocks gives the ids that one replay over
the words of the whole corpus would. Blocks need no exchange, their size is bounded by
``BLOCK_BYTES``, and a lost task repeats its own batches only. Each Python worker keeps
the ids of frequent pieces of text, because they come back in each batch.

Defined results: NULL and empty texts have no tokens; a text is encoded whole whatever
its length, also when it is a single word; repeated rows get repeated ids; other columns
pass untouched. Texts of special tokens are ordinary text. Decoding ids outside of the
vocabulary raises.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meldstone.llm.common import bounded_task, remember, share_package

#: Characters of texts that are encoded together; a longer text is taken alone.
CHUNK_CHARS = 8_000_000
#: Bytes of distinct words replayed together.
BLOCK_BYTES = 4_000_000
#: Pieces of texts, and words, whose ids a Python worker remembers, in each of two generations.
KEPT_PIECES = 300_000

# A space before what could be white space to the pattern, or at the end.
_ODD_SPACE = re.compile(r" (?![!-~]|\w)")
# Marks a piece without a space before it; no text of Spark can hold a lone surrogate.
_FIRST = "\ud800"
# Alternatives of a pattern that takes a run of letters, or of marks, as one word.
_LETTER_RUNS, _MARK_RUNS = r" ?\p{L}+", r" ?[^\s\p{L}\p{N}]+"
# Marks that often end a piece.
_MARKS = frozenset(".,;:!?")

# No pair, no symbol: above every rank.
_NONE = 1 << 30


class Remembered:
    """Ids by text. What is not met again while the newer generation fills is forgotten."""

    def __init__(self):
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def age(self) -> None:
        if len(self.newer) >= KEPT_PIECES:
            self.newer, self.older = {}, self.newer

    def missing(self, texts: Iterable[str]) -> list[str]:
        """Those of ``texts`` that are not known; what the older generation knows moves on."""
        newer, older = self.newer, self.older
        fresh = [text for text in texts if text not in newer]
        if not older:
            return fresh
        newer.update({text: older[text] for text in fresh if text in older})
        return [text for text in fresh if text not in older]


class Vocabulary:
    """Ranks of byte strings, and the ids of words already replayed."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        alternatives = pattern.split("|")
        self.takes_runs = _LETTER_RUNS in alternatives and _MARK_RUNS in alternatives
        self.mark_ids = {mark: ranks[mark.encode()].to_bytes(4, "little") for mark in _MARKS}
        self.pieces, self.words = Remembered(), Remembered()
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = {
            ranks[token[:cut]] << 32 | ranks[token[cut:]]: rank
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        }
        # A last key beyond all others, so that every search ends at an entry.
        self.pair_keys = np.array([*sorted(pairs), np.iinfo(np.int64).max])
        self.pair_ranks = np.array([*(pairs[k] for k in self.pair_keys[:-1].tolist()), _NONE], dtype=np.int32)

    @classmethod
    def parse(cls, content: bytes, pattern: str) -> Vocabulary:
        """From the lines "base64 rank" of a rank file."""
        lines = (line.split() for line in content.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)

    def merge_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank at which each pair of symbols merges, _NONE if it never does."""
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], np.int32(_NONE))

    def encode_all(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [ids for chunk in self.encode_chunks(texts) for ids in chunk]

    def encode_chunks(self, texts: Iterable[str]) -> Iterator[list[bytes]]:
        """The same in lists, of the texts of a chunk each."""
        chunk, size = [], 0
        for text in texts:
            if chunk and size + len(text) > CHUNK_CHARS:
                yield self._encode_chunk(chunk)
                chunk, size = [], 0
            chunk.append(text)
            size += len(text)
        yield self._encode_chunk(chunk)

    def _encode_chunk(self, texts: list[str]) -> list[bytes]:
        """Texts are cut before each space that a visible character follows.

        There every match of the pattern ends, so the pieces can be encoded one by one.
        """
        self.pieces.age()
        self.words.age()
        cut = [self._pieces(text) for text in texts]
        ids = [list(map(self.pieces.newer.get, pieces)) for pieces in cut]
        waiting = [k for k, found in enumerate(ids) if not all(found)]
        self._learn(self.pieces.missing(set().union(*[cut[k] for k in waiting])))
        known = self.pieces.newer.__getitem__
        for k in waiting:
            ids[k] = list(map(known, cut[k]))
        return list(map(b"".join, ids))

    def _pieces(self, text: str) -> list[str]:
        """Pieces whose leading space is left out, but for the first, which bears a mark."""
        if _ODD_SPACE.search(text):
            return [_FIRST + word for word in self.pattern.findall(text)]
        pieces = text.split(" ")
        pieces[0] = _FIRST + pieces[0]
        return pieces

    def _learn(self, pieces: list[str]) -> None:
        """Ids of pieces not met before.

        Letters, with or without a mark behind them, are told without the pattern: the
        letters are one word and the mark is another. All other pieces go through it.
        """
        known, runs, marked, others = self.pieces.newer, {}, [], []
        for piece in pieces:
            if self._is_word(piece):
                runs[piece] = _word(piece)
            elif piece[-1] in _MARKS and self._is_word(piece[:-1]):
                marked.append(piece)
                runs[piece[:-1]] = _word(piece[:-1])
            else:
                others.append(piece)
        fresh = self.pieces.missing(runs)
        split = [self.pattern.findall(_word(piece)) for piece in others]
        words = self.words.missing(set().union(*split))
        found = self._ids([runs[piece] for piece in fresh] + words)
        known.update(zip(fresh, found[: len(fresh)], strict=True))
        self.words.newer.update(zip(words, found[len(fresh) :], strict=True))
        known.update([(piece, known[piece[:-1]] + self.mark_ids[piece[-1]]) for piece in marked])
        ids = self.words.newer.__getitem__
        known.update([(piece, b"".join(map(ids, parts))) for piece, parts in zip(others, split, strict=True)])

    def _is_word(self, piece: str) -> bool:
        """Whether a piece is a run of letters that the pattern takes whole; scripts beyond Latin are left to it."""
        if piece[:1] == _FIRST:
            piece = piece[1:]
        return self.takes_runs and piece.isalpha() and (piece.isascii() or max(piece) < "\u0250")

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word; those that are no token by themselves are replayed in blocks."""
        raws = [word.encode("utf-8", "surrogatepass") for word in words]
        ranks = list(map(self.ranks.get, raws))
        found = [b"" if rank is None else rank.to_bytes(4, "little") for rank in ranks]
        block, size = [], 0
        for place in [k for k, rank in enumerate(ranks) if rank is None]:
            block.append(place)
            size += len(raws[place])
            if size >= BLOCK_BYTES:
                self._replay_block(block, raws, found)
                block, size = [], 0
        if block:
            self._replay_block(block, raws, found)
        return found

    def _replay_block(self, block: list[int], raws: list[bytes], found: list[bytes]) -> None:
        for place, ids in zip(block, replay([raws[k] for k in block], self), strict=True):
            found[place] = ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _word(piece: str) -> str:
    """The text that a piece stands for."""
    return piece[1:] if piece[:1] == _FIRST else " " + piece


def _leftmost(places: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Sorted places without those whose left symbol the place before would take."""
    places = np.sort(places)
    if (places[1:] == places[:-1]).any():
        places = np.unique(places)
    taken = np.zeros(len(places), dtype=bool)
    taken[1:] = following[places[:-1]] == places[1:]
    if not taken.any():
        return places
    # In a run of touching places every second one stays, from the first on.
    order = np.arange(len(places))
    run_start = np.maximum.accumulate(np.where(taken, 0, order))
    return places[(order - run_start) % 2 == 0]


def replay(words: list[bytes], vocabulary: Vocabulary) -> list[bytes]:
    """Ids of every word after all merges, each as packed 32-bit integers."""
    lengths = np.array([len(w) for w in words])
    ends = np.cumsum(lengths)
    starts = ends - lengths
    total = int(ends[-1])
    word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    # Place ``total`` stands for what lies outside of a word.
    symbol = np.append(vocabulary.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)], np.int32(_NONE))
    following = np.arange(1, total + 2, dtype=np.int32)
    following[ends - 1] = following[total] = total
    previous = np.arange(-1, total, dtype=np.int32)
    previous[starts] = total
    # Rank at which the pair that starts at a place merges.
    rank_at = vocabulary.merge_ranks(symbol, symbol[following])

    # The inverted index: rank of a pair -> places where such pairs start, in pieces.
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def enter(places: np.ndarray, ranks: np.ndarray) -> None:
        paired = ranks != _NONE
        places, ranks = places[paired], ranks[paired]
        if not len(places):
            return
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        cuts = [*np.flatnonzero(np.diff(ranks, prepend=-1)).tolist(), len(ranks)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            rank = int(ranks[start])
            if rank not in index:
                index[rank] = []
                heappush(queue, rank)
            index[rank].append(places[start:end])

    enter(np.arange(total, dtype=np.int32), rank_at[:total])
    while queue:
        rank = heappop(queue)
        pieces = index.pop(rank)
        places = pieces[0] if len(pieces) == 1 else np.concatenate(pieces)
        places = places[rank_at[places] == rank]  # earlier merges may have taken a part
        if not len(places):
            continue
        if len(places) > 1:
            places = _leftmost(places, following)
        lowest, *changes = _around(places, rank, symbol, following, previous, vocabulary)
        if lowest < rank:
            # A pair that goes first appears: merge the first place of each word, the rest later.
            _, first = np.unique(word[places], return_index=True)
            index[rank] = [np.delete(places, first)]
            heappush(queue, rank)
            places = places[first]
            _, *changes = _around(places, rank, symbol, following, previous, vocabulary)
        right, beyond, new_right, ahead, new_left = changes
        symbol[places], symbol[right], rank_at[right] = rank, _NONE, _NONE
        following[places], previous[beyond] = beyond, places
        rank_at[places], rank_at[ahead] = new_right, new_left
        enter(np.concatenate([places, ahead]), np.concatenate([new_right, new_left]))

    kept = symbol[:total] != _NONE
    packed = symbol[:total][kept].astype("<u4").tobytes()
    counts = (np.cumsum(np.add.reduceat(kept.astype(np.int64), starts)) * 4).tolist()
    return [packed[a:b] for a, b in zip([0, *counts[:-1]], counts, strict=True)]


def _around(places, rank, symbol, following, previous, vocabulary):
    """What merging the pairs at ``places`` changes beside them.

    Gives the lowest rank of any pair that appears on the way, then the right symbols, the
    places after them, the ranks of the pairs there, the places before, the ranks there.
    """
    right, ahead = following[places], previous[places]
    beyond = following[right]
    merged = np.full(len(places), rank, dtype=np.int32)
    new_right = vocabulary.merge_ranks(merged, symbol[beyond])
    lowest = new_right.min()
    # Of two pairs side by side the second one merges as well; the first sees its result.
    touching = beyond[:-1] == places[1:]
    if touching.any():
        twice = vocabulary.merge_ranks(merged[:1], merged[:1])[0]
        lowest = min(lowest, twice)
        new_right[:-1][touching] = twice
        alone = np.append(True, ~touching)
        ahead, merged = ahead[alone], merged[alone]
    new_left = vocabulary.merge_ranks(symbol[ahead], merged)
    return min(lowest, new_left.min()), right, beyond, new_right, ahead, new_left


_NAME = "bpe"
# One vocabulary for each rank file in a Python worker.
_LOADED: dict[tuple[str, str], Vocabulary] = {}


def _loaded(content: bytes, pattern: str) -> Vocabulary:
    key = (hashlib.sha256(content).hexdigest(), pattern)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary.parse(content, pattern)
    remember(_NAME, _LOADED.clear)
    return _LOADED[key]


class Tokenizer:
    """Column functions for one rank file, which the driver reads and broadcasts (below 2 MB)."""

    def __init__(self, spark: SparkSession, rank_file: str, pattern: str):
        share_package(spark)
        with open(rank_file, "rb") as ranks:
            self._content = spark.sparkContext.broadcast(ranks.read())
        self._pattern = pattern

    def _vocabulary(self) -> Callable[[], Vocabulary]:
        content, pattern = self._content, self._pattern
        return lambda: _loaded(content.value, pattern)

    def encode(self, text: Column) -> Column:
        """Ids as binary: little-endian unsigned 32-bit integers, empty for NULL."""
        vocabulary = self._vocabulary()

        def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                for ids in vocabulary().encode_chunks(t or "" for t in texts):
                    yield pd.Series(ids, dtype=object)

        return F.pandas_udf(bounded_task(_NAME, encode), "binary")(text)

    def decode(self, ids: Column) -> Column:
        """Bytes that the ids stand for."""
        vocabulary = self._vocabulary()

        def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for packed in batches:
                yield pd.Series([vocabulary().decode(p or b"") for p in packed], dtype=object)

        return F.pandas_udf(bounded_task(_NAME, decode), "binary")(ids)

    def round_trip(self, text: Column) -> Column:
        """Struct of the ids and the bytes decoded from them, in one pass."""
        vocabulary = self._vocabulary()

        def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                # What a chunk gives leaves before the next one is encoded.
                for ids in vocabulary().encode_chunks(t or "" for t in texts):
                    yield pd.DataFrame({"ids": ids, "decoded": [vocabulary().decode(i) for i in ids]}, dtype=object)

        return F.pandas_udf(bounded_task(_NAME, both), "ids binary, decoded binary")(text)


def tokenize(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", result: str = "token_ids") -> DataFrame:
    """``docs`` with the packed ids of each text."""
    return docs.withColumn(result, tokenizer.encode(F.col(text)))


def token_report(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Per document: token count, digest of the ids, digest of the decoded bytes."""
    rows = docs.select("doc_id", tokenizer.round_trip(F.col("text")).alias("done"))
    return rows.select(
        "doc_id",
        F.expr("octet_length(done.ids) div 4").alias("n_tokens"),
        F.sha2("done.ids", 256).alias("ids_sha256"),
        F.sha2("done.decoded", 256).alias("decoded_sha256"),
    )
