"""Quality rules learned as an ordered decision list.

Statistics of each text are Spark expressions. Sequential covering learns, from the
statistics of labelled documents, rules that mark bad ones: a rule starts empty and grows by
the threshold condition of the highest FOIL gain on two thirds of the rows; it is then
pruned to the prefix that does best on the other third, and stays if there more than
``LEAST_PRECISION`` of what it covers is bad. Rows it covers leave, and the next rule is
grown on the rest. The rules are emitted as one ordered conditional expression.

Everything is DataFrame code over all labelled rows. Thresholds are quantiles; every row
carries the number of thresholds below each statistic, so one aggregation with a row per
statistic and bin gives the counts of all conditions at once. The driver sees these few
hundred counts, never rows.

Defined results: NULL, empty and blank texts have no words and fail the base check; NULL
labels and labels other than 0 and 1 are left out; a document with both labels counts for
both; without labelled rows there is no rule and the base check decides; rows that repeat
get equal results; other columns pass untouched.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldstone.llm.common import WORD_GAP, free_name, words
from meldstone.sources.storage import materialise

WINDOW = 5
QUANTILES = 24
LEAST_PRECISION = 0.7
#: Bad rows a rule must cover among those it is grown on.
LEAST_COVERED = 5

#: Fixed values of the base check.
LEAST_WORDS = 10
MOST_REPEAT_PERCENT = 20
SYMBOLS = "#*$%&|<>"

#: Statistics that conditions may use.
RATIOS = (
    "n_words", "mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "distinct_share",
    "words_per_line",
)


class Condition(NamedTuple):
    statistic: str
    above: bool
    threshold: float

    def column(self, stats: Column) -> Column:
        value = stats[self.statistic]
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.4g}"


Rule = tuple[Condition, ...]


def _holds(rule: Rule, stats: Column) -> Column:
    held = F.lit(True)
    for condition in rule:
        held = held & condition.column(stats)
    return held


def _repeated_words(found: Column, docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with the number of words that lie in a window occurring twice or more.

    Each array below is used twice by the next step, which keeps it a column of its own:
    inlined into the lambda that reads it, it would be computed once per element.
    """
    hashes, ordered, starts = (free_name(docs, n) for n in ("window_hashes", "window_order", "window_starts"))
    n = F.size(found)
    windows = F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice(found, i, F.lit(WINDOW))))
    rows = docs.withColumn(hashes, F.when(n >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    several = F.size(F.array_distinct(F.col(hashes))) < F.size(hashes)
    placed = F.sort_array(F.transform(F.col(hashes), lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    rows = rows.withColumn(ordered, F.when(several, placed))
    o = F.col(ordered)
    same = lambda s, other: F.coalesce(s["h"] == other["h"], F.lit(False))
    doubled = F.filter(o, lambda s, i: same(s, F.get(o, i - 1)) | same(s, F.get(o, i + 1)))
    rows = rows.withColumn(starts, F.sort_array(F.transform(doubled, lambda s: s["at"])))
    # A window adds the words that the one before it does not hold.
    s = F.col(starts)
    gains = F.transform(s, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(at - F.get(s, i - 1), F.lit(WINDOW))))
    total = F.aggregate(gains, F.lit(0), lambda sum_, gain: sum_ + gain)
    return rows.withColumn(name, F.coalesce(total, F.lit(0)).cast("long")).drop(hashes, ordered, starts)


def statistics(docs: DataFrame, text: str = "text", result: str = "stats") -> DataFrame:
    """``docs`` with a struct of the base counts and the ratios of ``RATIOS``."""
    parts, repeats = free_name(docs, "parts"), free_name(docs, "repeats")
    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(content, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.withColumn(parts, F.struct(content.alias("text"), words(content).alias("words"), lines.alias("lines")))
    t, found, kept = F.col(f"{parts}.text"), F.col(f"{parts}.words"), F.col(f"{parts}.lines")
    rows = _repeated_words(found, rows, repeats)
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    n_words, n_lines = F.size(found).cast("long"), F.size(kept).cast("long")
    word_chars = F.length(F.regexp_replace(t, WORD_GAP, "")).cast("long")
    n_symbols = (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long")
    n_dup_lines = (F.size(kept) - F.size(F.array_distinct(kept))).cast("long")
    n_upper = F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))
    counts = F.struct(
        n_words.alias("n_words"),
        word_chars.alias("word_chars"),
        n_symbols.alias("n_symbols"),
        n_dup_lines.alias("n_dup_lines"),
        F.col(repeats).alias("n_repeat_words"),
        share(word_chars, n_words).alias("mean_word_chars"),
        share(n_symbols, n_words).alias("symbols_per_word"),
        share(n_dup_lines, n_lines).alias("dup_line_share"),
        share(F.col(repeats), n_words).alias("repeat_share"),
        share(n_upper, word_chars).alias("upper_share"),
        share(F.size(F.array_distinct(found)), n_words).alias("distinct_share"),
        share(n_words, n_lines).alias("words_per_line"),
    )
    return rows.withColumn(result, counts).drop(parts, repeats)


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < LEAST_WORDS) | (100 * stats["n_repeat_words"] > MOST_REPEAT_PERCENT * stats["n_words"])


class _Binned(NamedTuple):
    rows: DataFrame  # bad, grow, bins
    cuts: dict[str, list[float]]


def _binned(labelled: DataFrame, label: str) -> _Binned | None:
    """Labelled rows with the bin of each statistic, written once; None if there are none."""
    stats = F.col("stats")
    rows = labelled.where(F.col(label).isin(0, 1))
    levels = F.array(*[F.lit((i + 1) / (QUANTILES + 1)) for i in range(QUANTILES)])
    found = rows.agg(*[F.percentile_approx(stats[s], levels, 10_000).alias(s) for s in RATIOS]).first()
    if found[0] is None:
        return None
    cuts = {s: sorted(set(map(float, found[s]))) for s in RATIOS}
    bins = [
        sum((F.when(stats[s] > c, 1).otherwise(0) for c in cuts[s]), F.lit(0)).cast("int").alias(s) for s in RATIOS
    ]
    third = F.pmod(F.xxhash64("doc_id", *[stats[s] for s in RATIOS]), F.lit(3))
    chosen = rows.select((F.col(label) == 0).alias("bad"), (third != 0).alias("grow"), F.array(*bins).alias("bins"))
    return _Binned(materialise(chosen, "labelled"), cuts)


def _covers(rule: Rule, cuts: dict[str, list[float]]) -> Column:
    """The rule on bins: a value above the i-th cut has a bin above i."""
    held = F.lit(True)
    for condition in rule:
        bin_ = F.element_at("bins", RATIOS.index(condition.statistic) + 1)
        place = cuts[condition.statistic].index(condition.threshold)
        held = held & (bin_ > place if condition.above else bin_ <= place)
    return held


def _gain(bad: int, good: int, bad_before: int, good_before: int) -> float:
    """FOIL gain: bad rows kept, times the bits by which they became purer."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad_before / (bad_before + good_before)))


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    while True:
        cells = (
            rows.where(_covers(rule, cuts))
            .select("bad", F.posexplode("bins").alias("statistic", "bin"))
            .groupBy("statistic", "bin")
            .agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
            .collect()
        )
        by_bin = {(c["statistic"], c["bin"]): (c["bad"], c["good"]) for c in cells}
        whole = [sum(v[k] for (s, _), v in by_bin.items() if s == 0) for k in (0, 1)]
        if not whole[0] or not whole[1]:
            return rule
        best = (0.0, None)
        for place, statistic in enumerate(RATIOS):
            below = [0, 0]
            for i, cut in enumerate(cuts[statistic]):
                here = by_bin.get((place, i), (0, 0))
                below = [below[0] + here[0], below[1] + here[1]]
                for above in (False, True):
                    bad, good = (whole[0] - below[0], whole[1] - below[1]) if above else below
                    if bad >= LEAST_COVERED:
                        best = max(best, (_gain(bad, good, *whole), Condition(statistic, above, cut)), key=lambda b: b[0])
        if best[1] is None or best[0] <= 1e-9:
            return rule
        rule = (*rule, best[1])
    return rule


def _pruned(rows: DataFrame, rule: Rule, cuts: dict[str, list[float]]) -> Rule:
    """The prefix that covers most bad and fewest good rows, empty if none is precise enough."""
    sums = []
    for k in range(1, len(rule) + 1):
        covered = _covers(rule[:k], cuts)
        sums += [F.count_if(covered & F.col("bad")).alias(f"bad{k}"), F.count_if(covered & ~F.col("bad")).alias(f"good{k}")]
    counts = rows.agg(*sums).first()
    best, value = (), 0.0
    for k in range(1, len(rule) + 1):
        bad, good = counts[f"bad{k}"], counts[f"good{k}"]
        if bad + good and bad / (bad + good) > LEAST_PRECISION and bad - good > value:
            best, value = rule[:k], bad - good
    return best


def learn_rules(labelled: DataFrame, label: str = "quality") -> list[Rule]:
    """An ordered list of rules for label 0 from rows with ``doc_id``, ``stats`` and a label."""
    binned = _binned(labelled, label)
    if binned is None:
        return []
    rest, rules = binned.rows, []
    while True:
        rule = _grow(rest.where("grow"), binned.cuts)
        rule = _pruned(rest.where("not grow"), rule, binned.cuts) if rule else ()
        if not rule:
            break
        rules.append(rule)
        rest = rest.where(~_covers(rule, binned.cuts))
    return rules


def decision(rules: list[Rule], stats: Column) -> Column:
    """Text of the first rule that holds, NULL if none does."""
    chosen = None
    for rule in rules:
        name = F.lit(" and ".join(map(str, rule)))
        held = _holds(rule, stats)
        chosen = F.when(held, name) if chosen is None else chosen.when(held, name)
    return F.lit(None).cast("string") if chosen is None else chosen


def rules_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts of all documents, the base check, and the verdict of the learned rules."""
    rows = materialise(statistics(docs.select("doc_id", "text")).select("doc_id", "stats"), "stats")
    known = labels.select("doc_id", "quality").dropna().distinct()
    rules = learn_rules(rows.join(known, "doc_id"))
    stats = F.col("stats")
    failed, rule = base_failed(stats), decision(rules, stats)
    return rows.select(
        "doc_id",
        *[stats[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & rule.isNull()).alias("kept"),
        rule.alias("rule"),
    )
