"""Repeated passages by content-defined chunking.

A gear rolling hash runs over the bytes of a text; a chunk ends behind a white-space byte
at which the hash of the last 16 bytes has ``CUT_BITS`` zero bits, so chunks hold about
seven words, never split a word of usual length, and are the same wherever the passage
stands: an insertion changes the chunks around it and no others. Chunks are grouped by a
128-bit digest. The first occurrence (smallest id, then text key, then place) stays, later
ones are repeats.

Runs of adjacent repeated chunks are seeds. The words before a run's first and behind its
last chunk are compared with those at another occurrence of that chunk (the first one, or
the last where the first is the record's own), and the run grows by what is equal, up to
``REACH`` characters on a side, the longest chunk, or to the next run. Only then the
minimum of ``LEAST_WORDS`` applies: shorter repeats stand by chance or custom.

Chunks are exchanged twice by digest: to count them (hot ones are reduced before the
exchange) and to look the counts up (a plain join, whose hot digests adaptive execution
splits). They are cut anew for the second time, which costs less than keeping them. Only
repeated chunks travel on to their documents. Texts are exchanged once, by record, to read
the surroundings of runs; these pieces have REACH characters and a chunk at most.

Defined results: NULL, empty and blank texts have no chunks; texts of any length are cut
whole; rows equal in id and text are one record, and each of them gets its result; rows
that share an id but not a text are separate records; other columns pass untouched.
Positions count code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import takewhile

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meldstone.llm.common import free_name, share_package, small_text_batches, words
from meldstone.sources.storage import materialise

CUT_BITS = 2
LEAST_BYTES = 24
MOST_BYTES = 256
LEAST_WORDS = 50
REACH = MOST_BYTES

_GAPS = " \t\n\v\f\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")

# One random 16-bit value for each byte; a shift by one place per byte forgets after 16.
_GEAR = np.random.default_rng(11).integers(0, 1 << 16, 256, dtype=np.uint16)
_CUT_MASK = np.uint16(((1 << CUT_BITS) - 1) << (16 - CUT_BITS))
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """At each byte the sum of the gear values of the last 16, older ones shifted further."""
    hashes = _GEAR[raw]
    for span in (1, 2, 4, 8):
        older = np.zeros_like(hashes)
        older[span:] = hashes[:-span] << np.uint16(span)
        hashes = hashes + older
    return hashes


def chunk_ends(raw: np.ndarray) -> list[int]:
    """Ends of the chunks of a text, in bytes."""
    total = len(raw)
    space = _SPACE[raw]
    cuts = np.flatnonzero(space & (gear_hashes(raw) & _CUT_MASK == 0)) + 1
    ends, last = [], 0
    for cut in [*cuts.tolist(), total]:
        while cut - last > MOST_BYTES:
            # No cut in reach: end behind the last white space, so that one word over and
            # over makes equal chunks; inside of a long word, between two characters.
            end = last + MOST_BYTES
            behind = np.flatnonzero(space[last:end])
            if len(behind) and behind[-1] + 1 >= LEAST_BYTES:
                end = last + int(behind[-1]) + 1
            else:
                while raw[end] & 0xC0 == 0x80:
                    end -= 1
            ends.append(end)
            last = end
        if cut - last >= LEAST_BYTES or cut == total > last:
            ends.append(cut)
            last = cut
    return ends


def chunks_of(text: str | None) -> list[tuple[int, int, int, int, int]]:
    """(start, end, words, high digest, low digest) of each chunk; positions in code points."""
    content = (text or "").encode("utf-8", "surrogatepass")
    if not content.strip():
        return []
    raw = np.frombuffer(content, dtype=np.uint8)
    ends = chunk_ends(raw)
    points = np.append(0, np.cumsum(raw & 0xC0 != 0x80))[[0, *ends]].tolist()
    found, last = [], 0
    for place, end in enumerate(ends):
        piece = content[last:end].strip()
        digest = xxhash.xxh3_128_digest(piece)
        high, low = int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)
        found.append((points[place], points[place + 1], len(piece.split()), high, low))
        last = end
    return found


CHUNK_SCHEMA = "doc_id bigint, text_key bigint, start int, end int, n_words int, high bigint, low bigint"


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = ["start", "end", "n_words", "high", "low"]
    for batch in batches:
        found = [chunks_of(text) for text in batch["text"]]
        counts = [len(f) for f in found]
        out = pd.DataFrame([c for f in found for c in f], columns=names)
        out.insert(0, "doc_id", batch["doc_id"].repeat(counts).array)
        out.insert(1, "text_key", batch["text_key"].repeat(counts).array)
        yield out


def _records(docs: DataFrame) -> DataFrame:
    # Ids travel as a pair (known, id): a NULL among them would turn a whole batch to floats.
    return docs.select(
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.xxhash64(F.col("doc_id").isNull(), "text").alias("text_key"), "text"
    )


def chunk_table(docs: DataFrame) -> DataFrame:
    """Every chunk of every record."""
    share_package(docs.sparkSession)
    small_text_batches(docs.sparkSession)
    return _records(docs).mapInPandas(_chunks, CHUNK_SCHEMA)


RECORD = ["doc_id", "text_key"]
SPANS = "array<struct<start:int,end:int>>"
KINDS = ["shared", "repeated"]
BOTH = "both"

RUN_SCHEMA = (
    "doc_id bigint, text_key bigint, first_doc bigint, kind string, start int, end int, n_words int, before int, after int, "
    "head_doc bigint, head_key bigint, head_start int, "
    "tail int, tail_words int, tail_doc bigint, tail_key bigint, tail_start int"
)
_RUN_NAMES = [field.split()[0] for field in RUN_SCHEMA.split(", ")]


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of adjacent repeated chunks of each record, with an occurrence of their first and last chunks elsewhere.

    ``before`` and ``after`` are the ends of the neighbouring runs (0, and -1 for none).
    """
    for batch in batches:
        rows = []
        for doc_id, text_key, first_doc, spans in batch[[*RECORD, "first_doc", "spans"]].itertuples(index=False, name=None):
            own = (doc_id, text_key)
            found: dict[tuple, list[str]] = {}
            for kind in KINDS:
                runs = []
                for s in spans:
                    if not s["shared"] if kind == "shared" else s["first"]:
                        continue
                    other = (s["other_doc"], s["other_key"], s["other_start"])
                    if kind == "repeated" and s["own_start"] is not None:
                        other = (*own, s["own_start"])
                    if runs and runs[-1]["end"] == s["start"]:
                        runs[-1]["end"], runs[-1]["n_words"] = s["end"], runs[-1]["n_words"] + s["n_words"]
                    else:
                        runs.append({"start": s["start"], "end": s["end"], "n_words": s["n_words"], "head": other})
                    runs[-1] |= {"tail": s["start"], "tail_words": s["n_words"], "tail_at": other}
                for place, r in enumerate(runs):
                    before = runs[place - 1]["end"] if place else 0
                    after = runs[place + 1]["start"] if place + 1 < len(runs) else -1
                    span = (r["start"], r["end"], r["n_words"], before, after)
                    found.setdefault((*span, *r["head"], r["tail"], r["tail_words"], *r["tail_at"]), []).append(kind)
            # A run that is both shared and repeated grows once.
            rows += [(*own, first_doc, kinds[0] if len(kinds) == 1 else BOTH, *run) for run, kinds in found.items()]
        yield pd.DataFrame(rows, columns=_RUN_NAMES)


def repeated_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks that stand in several places, with another place of each: the first, or the last if the first is in the record itself.

    ``own_start`` is the first place where that is in the record itself.
    """
    place = F.struct("doc_id", "text_key", "start")
    groups = chunks.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(place).alias("least"), F.max(place).alias("most"))
    met = chunks.join(groups.where("n > 1").drop("n"), ["high", "low"])
    inside = lambda c: (F.col(f"{c}.doc_id") == F.col("doc_id")) & (F.col(f"{c}.text_key") == F.col("text_key"))
    other = F.when(inside("least"), F.col("most")).otherwise(F.col("least"))
    return met.select(
        *RECORD, "start", "end", "n_words",
        (place == F.col("least")).alias("first"),
        (~(inside("least") & inside("most"))).alias("shared"),
        F.col("least.doc_id").alias("first_doc"),
        other["doc_id"].alias("other_doc"), other["text_key"].alias("other_key"), other["start"].alias("other_start"),
        F.when(inside("least"), F.col("least.start")).alias("own_start"),
    )


def equal_words(own: str, other: str, side: str) -> tuple[int, int]:
    """Characters of ``own`` and words that equal those of ``other``, from its start (tail) or its end (head)."""
    # Most surroundings differ at once.
    a, b = (own.rstrip(_GAPS)[-1:], other.rstrip(_GAPS)[-1:]) if side == "head" else (own.lstrip(_GAPS)[:1], other.lstrip(_GAPS)[:1])
    if a != b:
        return 0, 0
    have, want = list(_WORD.finditer(own)), _WORD.findall(other)
    step = -1 if side == "head" else 1
    count = sum(1 for _ in takewhile(lambda pair: pair[0][0] == pair[1], zip(have[::step], want[::step])))
    if count == 0:
        return 0, 0
    if side == "head":
        return len(own) - have[-count].start(), count
    return have[count].start() if count < len(have) else len(own), count


def _grown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Characters and words by which each side of a run grows, and the words up to the next run."""
    for batch in batches:
        rows = []
        for own, other, side, gap, skip, most in batch[["own", "other", "side", "gap", "skip", "most"]].itertuples(index=False, name=None):
            if side == "tail" and own[:skip] == other[:skip]:
                # The piece begins with the run's last chunk, usually the same to its last character.
                chars, count = equal_words(own[skip:], other[skip:], side)
            else:
                chars, count = equal_words(own, other, side)
                if side == "tail":
                    chars, count = (chars - skip, count - most) if count > most else (0, 0)
            between = len(_WORD.findall(own[skip:])) if side == "head" and 0 <= gap <= REACH else -1
            rows.append((chars, count, between))
        out = batch[[*RECORD, "kind", "start", "side"]].reset_index(drop=True)
        yield pd.concat([out, pd.DataFrame(rows, columns=["chars", "words", "between"])], axis=1)


_EDGE = ["kind", "start", "side", "gap", "skip", "most", "other_doc", "other_key", "other_from", "other_to"]


def extended(runs: DataFrame, docs: DataFrame) -> DataFrame:
    """(record, kind, start, side, chars, words, between): by how much each run grows."""
    left = lambda at, lowest: F.greatest(at - REACH, lowest)
    n = F.col("end") - F.col("tail")
    reach = F.when(F.col("after") >= 0, F.least(F.col("after") - F.col("end"), F.lit(REACH))).otherwise(F.lit(REACH))
    head = F.struct(
        F.lit("head").alias("side"),
        left(F.col("start"), F.col("before")).alias("own_from"), F.col("start").alias("own_to"),
        F.col("head_doc").alias("other_doc"), F.col("head_key").alias("other_key"),
        left(F.col("head_start"), F.lit(0)).alias("other_from"), F.col("head_start").alias("other_to"),
        F.when(F.col("before") > 0, F.col("start") - F.col("before")).otherwise(-1).alias("gap"),
        F.lit(0).alias("skip"), F.lit(0).alias("most"),
    )
    tail = F.struct(
        F.lit("tail").alias("side"),
        F.col("tail").alias("own_from"), (F.col("end") + reach).alias("own_to"),
        F.col("tail_doc").alias("other_doc"), F.col("tail_key").alias("other_key"),
        F.col("tail_start").alias("other_from"), (F.col("tail_start") + n + REACH).alias("other_to"),
        F.when(F.col("after") >= 0, F.col("after") - F.col("end")).otherwise(-1).alias("gap"),
        n.alias("skip"), F.col("tail_words").alias("most"),
    )
    edges = runs.select(*RECORD, "kind", "start", F.explode(F.array(head, tail)).alias("e")).select(*RECORD, "kind", "start", "e.*")
    edges = edges.where("own_to > own_from and other_to > other_from")
    # Own pieces come back with their edge. A place of others that many edges ask for is read once.
    own = edges.select(*RECORD, F.struct(F.col("own_from").alias("a"), F.col("own_to").alias("b"), F.struct(*_EDGE).alias("edge")).alias("p"))
    other = edges.select(F.col("other_doc").alias("doc_id"), F.col("other_key").alias("text_key"), F.col("other_from").alias("a"), F.col("other_to").alias("b"))
    other = other.distinct().select(*RECORD, F.struct("a", "b", F.lit(None).cast(own.schema["p"].dataType["edge"].dataType).alias("edge")).alias("p"))
    wanted = own.union(other).groupBy(*RECORD).agg(F.collect_list("p").alias("pieces"))
    # A record that stands in many rows is one.
    texts = _records(docs).groupBy(*RECORD).agg(F.first("text").alias("text"))
    cut = wanted.join(texts, RECORD).select(*RECORD, "text", F.explode("pieces").alias("p"))
    piece = F.substring("text", F.col("p.a") + 1, F.col("p.b") - F.col("p.a"))
    pieces = materialise(cut.select(*RECORD, "p.a", "p.b", "p.edge", piece.alias("piece")), "surroundings")
    mine = pieces.where("edge is not null").select(*RECORD, F.col("piece").alias("own"), "edge.*")
    theirs = pieces.where("edge is null").select(
        F.col("doc_id").alias("other_doc"), F.col("text_key").alias("other_key"), F.col("a").alias("other_from"),
        F.col("b").alias("other_to"), F.col("piece").alias("other"),
    )
    met = mine.join(theirs, ["other_doc", "other_key", "other_from", "other_to"])
    columns = met.select(*RECORD, "kind", "start", "side", "own", "other", "gap", "skip", "most")
    schema = "doc_id bigint, text_key bigint, kind string, start int, side string, chars int, words int, between int"
    return columns.mapInPandas(_grown, schema)


def _passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Grown runs of each record, joined where they meet, if long enough."""

    def joined(runs):
        spans = []
        for r in sorted(runs, key=lambda r: r["start"]):
            a, b = r["start"] - r["head_chars"], r["end"] + r["tail_chars"]
            n = r["n_words"] + r["head_words"] + r["tail_words"]
            if spans and a <= spans[-1][1]:
                last = spans[-1]
                # What both grew over lies between the two runs and counts once.
                double = max(0, last[3] + r["head_words"] - r["between"]) if r["between"] >= 0 else 0
                spans[-1] = [last[0], max(last[1], b), last[2] + n - double, r["tail_words"]]
            else:
                spans.append([a, b, n, r["tail_words"]])
        return [s for s in spans if s[2] >= LEAST_WORDS]

    for batch in batches:
        rows = []
        for doc_id, text_key, first_doc, runs in batch[[*RECORD, "first_doc", "runs"]].itertuples(index=False, name=None):
            found = [joined([r for r in runs if r["kind"] in (kind, BOTH)]) for kind in KINDS]
            lists = [[{"start": s[0], "end": s[1]} for s in spans] for spans in found]
            rows.append((doc_id, text_key, first_doc, *lists, *[sum(s[2] for s in spans) for spans in found]))
        yield pd.DataFrame(rows, columns=[*RECORD, "first_doc", *KINDS, "shared_words", "repeated_words"])


def find_repeats(docs: DataFrame) -> DataFrame:
    """For each record with repeated passages: the passages, and the smallest id that has a chunk of the record.

    ``shared`` are passages that another record has too; ``repeated`` are those that stand
    somewhere before, in another record or in this one.
    """
    met = repeated_chunks(chunk_table(docs))
    # Equal rows bring equal chunks; a set keeps one of each.
    fields = ["start", "end", "n_words", "first", "shared", "other_doc", "other_key", "other_start", "own_start"]
    spans = F.array_sort(F.collect_set(F.struct(*fields)))
    grouped = met.groupBy(*RECORD).agg(F.min("first_doc").alias("first_doc"), spans.alias("spans"))
    runs = materialise(grouped.mapInPandas(_runs, RUN_SCHEMA), "runs")
    grown = extended(runs, docs).groupBy(*RECORD, "kind", "start")
    of = lambda side, c: F.coalesce(F.max(F.when(F.col("side") == side, F.col(c))), F.lit(0))
    grown = grown.agg(
        *[of(side, c).alias(f"grown_{side}_{c}") for side in ("head", "tail") for c in ("chars", "words")],
        F.coalesce(F.max(F.when(F.col("side") == "head", F.col("between"))), F.lit(-1)).alias("between"),
    )
    whole = runs.join(grown, [*RECORD, "kind", "start"], "left")
    size = lambda side, c: F.coalesce(f"grown_{side}_{c}", F.lit(0)).alias(f"{side}_{c}")
    run = F.struct(
        "kind", "start", "end", "n_words", F.coalesce("between", F.lit(-1)).alias("between"),
        *[size(side, c) for side in ("head", "tail") for c in ("chars", "words")],
    )
    records = whole.groupBy(*RECORD).agg(F.min("first_doc").alias("first_doc"), F.collect_list(run).alias("runs"))
    schema = (
        f"doc_id bigint, text_key bigint, first_doc bigint, shared {SPANS}, repeated {SPANS}, "
        "shared_words bigint, repeated_words bigint"
    )
    return records.mapInPandas(_passages, schema).where("shared_words + repeated_words > 0")


def _keyed(docs: DataFrame, id_name: str, key_name: str) -> DataFrame:
    return docs.withColumn(id_name, F.coalesce("doc_id", F.lit(0))).withColumn(
        key_name, F.xxhash64(F.col("doc_id").isNull(), "text")
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; first occurrences stay."""
    id_name, key_name, cut = free_name(docs, "record_id"), free_name(docs, "record_key"), free_name(docs, "cut")
    found = find_repeats(docs).select(
        F.col("doc_id").alias(id_name), F.col("text_key").alias(key_name), F.col("repeated").alias(cut)
    )
    joined = _keyed(docs, id_name, key_name).join(found, [id_name, key_name], "left")
    # The pieces between the spans: from the end of one to the start of the next.
    text, spans = F.col("text"), F.col(cut)
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
    pieces = F.zip_with(starts, ends, lambda a, b: F.substring(text, a + 1, b - a))
    kept = F.when(spans.isNull() | (F.size(spans) == 0), text).otherwise(F.array_join(pieces, ""))
    return joined.withColumn("text", kept).select(*[F.col(f"`{c}`") for c in docs.columns])


def repeat_report(docs: DataFrame) -> DataFrame:
    """Per document: words, shared and repeated passages, and the smallest id that holds one."""
    rows = docs.select("doc_id", "text")
    found = find_repeats(rows).withColumnsRenamed({"doc_id": "_id", "text_key": "_key"})
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    base = _keyed(rows, "_id", "_key").select("doc_id", "_id", "_key", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    joined = base.join(found, ["_id", "_key"], "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("shared_words", F.lit(0)).alias("shared_words"),
        F.coalesce("repeated_words", F.lit(0)).alias("repeated_words"),
        F.coalesce(listed("shared"), F.lit("")).alias("shared_spans"),
        F.coalesce(listed("repeated"), F.lit("")).alias("repeated_spans"),
        F.when(F.col("shared_words") > 0, F.col("first_doc")).alias("first_doc"),
    )
