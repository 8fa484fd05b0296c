"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runs of these characters separate words; every other character belongs to a word.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share_package(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package.

    On a cluster the package is shipped with the application; there the added
    folder simply does not exist.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if root not in known:
        environment["PYTHONPATH"] = ":".join([root, *known])


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; NULL for a NULL key."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(parts)


def lower_ascii(text: Column) -> Column:
    """Text with A-Z in lower case and nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text, in order; an empty array for NULL and blank texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what runs inside; whole texts make large ones."""
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


def give_back() -> None:
    """Return memory that this Python worker no longer uses to the system.

    Workers outlive their tasks and are taken over by later stages, beside a JVM that fills
    its own share of the executor by then.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# What operators remember in this worker, by operator, and how to forget it.
_REMEMBERED: dict[str, Callable[[], None]] = {}


def remember(operator: str, forget: Callable[[], None]) -> None:
    """Note that ``operator`` keeps something between tasks."""
    _REMEMBERED[operator] = forget


def start_task(operator: str) -> None:
    """Forget what operators other than this one remember in this worker."""
    for other in [name for name in _REMEMBERED if name != operator]:
        _REMEMBERED.pop(other)()


def bounded_task(operator: str, work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over batches, for which what other operators left in this worker is forgotten first.

    What the task itself no longer needs goes back to the system at its end.
    """

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        # The worker's own module: this function is shipped by value, with copies of what it names.
        from meldstone.llm import common

        common.start_task(operator)
        try:
            yield from work(batches)
        finally:
            common.give_back()

    return run


_TEXT_ROWS = 2500


def small_text_batches(spark: SparkSession) -> None:
    """Let this session send whole texts to Python in batches of _TEXT_ROWS rows, unless it is set to fewer."""
    rows = int(spark.conf.get(_BATCH_ROWS))
    if rows <= 0 or rows > _TEXT_ROWS:
        spark.conf.set(_BATCH_ROWS, _TEXT_ROWS)
