"""Language identification by compression.

For each language a raw-content dictionary is cut from labelled texts. A text is reduced
to its distinct words in order of appearance (letters only, lower case), so that repeated
lines, tables and symbols weigh nothing; it is then compressed in blocks with every
dictionary, and the language whose dictionary gives the fewest bytes is predicted. The
margin is the share of bytes by which the runner-up is larger; a text with a narrow margin
is not accepted, though its prediction is reported.

Learning takes a bounded sample: texts whose hash falls below a share of the distinct texts
of a language that yields about ``SAMPLE_TEXTS`` of them, all if there are no more, and one
at least; the dictionary holds at most ``DICTIONARY_BYTES`` of them. Only the model, whose size is languages times DICTIONARY_BYTES, passes
through the driver. Prediction covers all rows and whole texts without any exchange.

Defined results: NULL texts, and texts without a letter, get ``und`` with score 0 and are
not accepted; so does every text if no labelled text was given. With one language, its
score is 1. Ties go to the language with more labelled texts, then to the smaller name.
Repeated rows get equal results; other columns pass untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldstone.llm.common import bounded_task, fold, free_name, share_package

UNKNOWN = "und"
SAMPLE_TEXTS = 200
DICTIONARY_BYTES = 65_536
BLOCK_BYTES = 2_048
#: Texts are accepted if the runner-up needs this share of bytes more.
MIN_MARGIN = 0.01

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def distinct_words(text: str) -> str:
    return " ".join(dict.fromkeys(w for w in _NOT_LETTERS.split(text.lower()) if w))


class Guess(NamedTuple):
    lang: str
    score: float
    accepted: bool


class LanguageModel:
    """Dictionaries by language, most frequent language first."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.dictionaries = dictionaries
        self._compressors: list[tuple[str, zstandard.ZstdCompressor]] | None = None

    def __getstate__(self):
        return self.dictionaries

    def __setstate__(self, dictionaries):
        self.__init__(dictionaries)

    def _ready(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        if self._compressors is None:
            log = DICTIONARY_BYTES.bit_length()
            parameters = zstandard.ZstdCompressionParameters(
                window_log=log,
                hash_log=log,
                chain_log=log,
                search_log=4,
                min_match=3,
                strategy=zstandard.STRATEGY_GREEDY,
                write_content_size=0,
                write_checksum=0,
                write_dict_id=0,
            )
            self._compressors = []
            for lang, content in self.dictionaries.items():
                dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                dictionary.precompute_compress(compression_params=parameters)
                compressor = zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary)
                self._compressors.append((lang, compressor))
        return self._compressors

    def sizes(self, words: str) -> list[tuple[int, str]]:
        """Compressed bytes by language, fewest first."""
        raw = words.encode("utf-8", "surrogatepass")
        blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
        found = [(sum(len(c.compress(b)) for b in blocks), lang) for lang, c in self._ready()]
        return sorted(found, key=lambda pair: pair[0])  # stable: ties keep the order of languages

    def guess(self, text: str | None) -> Guess:
        words = distinct_words(text or "")
        if not self.dictionaries or not any(c.isalpha() for c in words):
            return Guess(UNKNOWN, 0.0, False)
        (best, lang), *others = self.sizes(words)
        margin = (others[0][0] - best) / others[0][0] if others else 1.0
        return Guess(lang, margin, margin >= MIN_MARGIN)


def _highest_hash(texts: int, sample_texts: int) -> int:
    """The 64-bit hash up to which about ``sample_texts`` of ``texts`` hashes lie."""
    return (min(sample_texts, texts) << 64) // texts - (1 << 63) - 1


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_texts: int = SAMPLE_TEXTS) -> LanguageModel:
    """Dictionaries from the rows of ``labelled`` whose text and language are not NULL.

    About ``sample_texts`` distinct texts of each language are taken, of each its first
    DICTIONARY_BYTES characters, as more would not fit into a dictionary; counts and shares
    come from all rows. The driver holds one sample and one dictionary for each language.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    place = F.xxhash64("text")
    # Copies share a hash, so they neither count for the share nor take part in it twice.
    hashes = rows.groupBy("lang", place.alias("place")).agg(F.count("*").alias("n"))
    found = hashes.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("texts"), F.min("place").alias("least")).collect()
    if not found:
        return LanguageModel({})
    counts = {r["lang"]: r["n"] for r in found}
    highest = F.create_map(
        *[F.lit(x) for r in found for x in (r["lang"], max(r["least"], _highest_hash(r["texts"], sample_texts)))]
    )
    sample = (
        rows.where(place <= F.element_at(highest, F.col("lang")))
        .select("lang", F.col("text").substr(1, DICTIONARY_BYTES).alias("text"), place.alias("place"))
        .distinct()
    )
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in sample.toLocalIterator():
        texts.setdefault(row["lang"], []).append((row["place"], row["text"]))
    dictionaries = {}
    for name in sorted(texts, key=lambda name: (-counts[name], name)):
        content = " ".join(distinct_words(t) for _, t in sorted(texts[name])).encode("utf-8", "surrogatepass")
        dictionaries[name] = (content or b" ")[:DICTIONARY_BYTES].ljust(8)
    return LanguageModel(dictionaries)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", result: str = "language") -> DataFrame:
    """``docs`` with a struct of lang, score and accepted."""
    share_package(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shipped.value.guess(t) for t in texts], columns=Guess._fields)

    judged = F.pandas_udf(bounded_task("language_id", guess), "lang string, score double, accepted boolean")
    return docs.withColumn(result, judged(F.col(text)))


def held_out(doc_id: Column) -> Column:
    """Documents kept from learning: crc32 of the id, modulo 5, is 0."""
    return F.coalesce(fold(doc_id, 5) == 0, F.lit(False))


def learn_from_documents(docs: DataFrame) -> LanguageModel:
    return learn(docs.where(fold(F.col("doc_id"), 5) != 0))


def language_report(docs: DataFrame) -> DataFrame:
    """Predictions for all documents by a model learned from those not held out."""
    found = predict(docs.select("doc_id", "text"), learn_from_documents(docs))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.accepted").alias("accepted"),
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is told with a sufficient margin."""
    found = free_name(docs, "language")
    kept = predict(docs, learn_from_documents(docs), result=found).where(F.col(f"{found}.accepted"))
    return kept.drop(found)
