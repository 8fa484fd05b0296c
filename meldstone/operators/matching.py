"""Fuzzy matching of names within blocks.

Two names match when 1 - levenshtein / longer length >= 0.85, that is when their
distance is at most floor(3 * longer / 20). Records of a block are never paired
all with all. Names are first reduced to one representative per distinct value,
then two representatives meet only if they share a signature, and the signatures
are complete: every matching pair has at least one in common.

* Longer name below 20 characters (distance <= 2): the strings left after
  deleting as many characters as the distance allows (deletion neighbourhood).
* From 20 characters on: the shorter name is cut into distance + 1 segments, one
  of which must survive untouched at a nearby position of the longer name
  (partition-based similarity join).

Each name is cut in several ways, into distance + m segments for m = 1, 2, 3. At least m of
them survive, so the m - 1 most common ones can be left out without losing a pair; the cut
is kept whose remaining segments are the rarest.

Where no cut is rare, as among names that differ in a number only, segments would bring
nearly every name to nearly every other, many times over. The names of such lengths of a
block meet in tiles, each pair once, and are compared where they meet; so are names of
lengths that few names of the block have.

What all names of a block begin or end with changes no distance, so variants are made of
the rest and distances measured on it.

Records whose name has no letter or digit name nobody: they stay out of candidates and copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldstone.functions.text import cleanse_name
from meldstone.sources.storage import materialise

# Fixed value: similarity threshold 0.85, as the ratio 17 / 20 to stay in integers.
THRESHOLD = 0.85
SHORT_LIMIT = 20

# Names are cut into up to this many segments more than their distance.
MAX_EXTRA_SEGMENTS = 3

# Up to so many names of one length in a block are compared without looking for segments.
FEW = 200
# Names meet in tiles, too, if segments would bring a name to one in so many of its length.
DENSE = 8
# Names on each side of a tile.
TILE = 2000
# Ids of one name in a list.
LIST = 1000
# Up to so many last words of a block have their distances to each other noted.
WORDS = 64
# Short names of a block in one half of a tile.
SLAB = 10000


def allowed_distance(length: Column) -> Column:
    """Largest edit distance that still reaches the threshold."""
    return F.floor(length * 3 / 20).cast("int")


def similarity(distance: Column, longer: Column) -> Column:
    """1 - distance / longer; two empty names are the same name."""
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - distance.cast("double") / longer.cast("double"))


def _keyed(records: DataFrame) -> DataFrame:
    named = records.where(F.col("block_key").isNotNull()).select(
        "id", "block_key", cleanse_name(F.col("name")).alias("name")
    )
    return named.where(F.col("name") != "")


def representatives(records: DataFrame) -> DataFrame:
    """Smallest id per distinct (block, cleansed name)."""
    return (
        _keyed(records)
        .groupBy("block_key", "name")
        .agg(F.min("id").alias("id"))
        .withColumn("len", F.length("name"))
    )


def copies(records: DataFrame, reps: DataFrame) -> DataFrame:
    """(block_key, id_a, id_b): representative and copy for records that repeat a name of their block."""
    keyed = _keyed(records).withColumnRenamed("id", "id_b")
    heads = reps.select("block_key", "name", F.col("id").alias("id_a"))
    return (
        keyed.join(heads, ["block_key", "name"])
        .where(F.col("id_a") != F.col("id_b"))
        .select("block_key", "id_a", "id_b")
    )


def trimmed(reps: DataFrame) -> DataFrame:
    """``reps`` with ``rest``, the name without what all names of its block begin and end with.

    ``start`` is how many characters they begin with, ``lengths`` are the lengths below SHORT_LIMIT that they have.
    """

    def shared(x: str, y: str) -> Column:
        places = F.sequence(F.lit(0), F.least(F.length(x), F.length(y)))
        return F.size(F.filter(places, lambda i: F.substring(x, F.lit(1), i) == F.substring(y, F.lit(1), i))) - 1

    turned = F.reverse("name")
    ends = reps.groupBy("block_key").agg(
        F.min("name").alias("low"), F.max("name").alias("high"), F.min(turned).alias("low_end"),
        F.max(turned).alias("high_end"), F.min("len").alias("least"),
        F.collect_set(F.when(F.col("len") < SHORT_LIMIT, F.col("len"))).alias("lengths"),
    )
    start = shared("low", "high")
    end = F.least(shared("low_end", "high_end"), F.col("least") - start)
    cut = ends.select("block_key", start.alias("start"), end.alias("end"), "lengths")
    rest = F.substring("name", F.col("start") + 1, F.col("len") - F.col("start") - F.col("end"))
    return reps.join(cut, "block_key").withColumn("rest", rest).drop("end")


def _with_rest(reps: DataFrame) -> DataFrame:
    return reps if "rest" in reps.columns else reps.withColumn("rest", F.col("name"))


def _with_variants(names: DataFrame, budget: Column) -> DataFrame:
    """One row per string left of ``rest`` after deleting exactly ``budget`` (0 to 2) characters, or all it has.

    Of the ways to be left with a string, the one that keeps its characters as early as
    possible counts: no deleted character equals the one that is kept next.
    """
    names = names.withColumn("size", F.length("rest")).withColumn("budget", F.least(budget, F.col("size")))
    i, j, length, budget = F.col("i"), F.col("j"), F.col("size"), F.col("budget")
    first = F.when(budget == 0, F.array(F.lit(0))).when(budget == 1, F.sequence(F.lit(1), length))
    second = F.when(budget == 2, F.sequence(i + 1, length)).otherwise(F.array(F.lit(0)))

    def character(position: Column) -> Column:
        return F.substring("rest", position, F.lit(1))

    variant = (
        F.when(budget == 0, F.col("rest"))
        .when(budget == 1, F.concat(F.substring("rest", F.lit(1), i - 1), F.substring("rest", i + 1, length)))
        .otherwise(
            F.concat(
                F.substring("rest", F.lit(1), i - 1),
                F.substring("rest", i + 1, j - i - 1),
                F.substring("rest", j + 1, length),
            )
        )
    )
    return (
        names.withColumn("i", F.explode(first.otherwise(F.sequence(F.lit(1), length - 1))))
        .withColumn("j", F.explode(second))
        # Where the two stand side by side, the character after both is kept next for either.
        .where((i == 0) | (character(i) != character(F.when(j == i + 1, j + 1).otherwise(i + 1))))
        .where((j == 0) | (character(j) != character(j + 1)))
        .withColumn("variant", variant)
    )


def _partner_lengths(shortest: Column, longest: Column) -> Column:
    """Lengths l of a longer (or equal) partner that can still match a name of length len."""
    options = F.when(shortest <= longest, F.sequence(shortest, longest))
    return F.filter(options, lambda l: (l - F.col("len") <= allowed_distance(l)) & (allowed_distance(l) > 0))


def _spread(names: DataFrame) -> DataFrame:
    """Names over all shuffle partitions, since each expands to a hundred rows or more."""
    return names.repartition(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")


def _signed(reps: DataFrame) -> DataFrame:
    """Names below SHORT_LIMIT characters with their deletion variants as ``sig``.

    ``longest`` tells whether the name is as long as the longer one of the pairs it looks for.
    """
    return _with_signatures(_spread(_with_rest(reps).where(F.col("len") < SHORT_LIMIT))).select("sig", *_kept(reps), "longest")


def _with_signatures(short: DataFrame) -> DataFrame:
    targets = _partner_lengths(F.col("len"), F.least(F.col("len") + 2, F.lit(SHORT_LIMIT - 1)))
    budget = allowed_distance(F.col("l")) - (F.col("l") - F.col("len"))
    if "lengths" in short.columns:
        targets = F.array_intersect(targets, "lengths")
    variants = _with_variants(short.withColumn("l", F.explode(targets)), budget)
    return variants.withColumns({"sig": F.xxhash64("block_key", "l", "variant"), "longest": F.col("len") == F.col("l")})


def _kept(reps: DataFrame) -> list[str]:
    return ["block_key", "id", "name", "rest", "len"] + [c for c in reps.columns if c == "new"]


def _of_side(rows: DataFrame, side: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{c}_{side}") for c in rows.columns])


def short_signatures(reps: DataFrame) -> DataFrame:
    """(sig, id, longest): deletion variants of names below SHORT_LIMIT characters."""
    return _signed(reps).select("sig", "id", "longest")


_PAIR = ["block_key"] + [f"{c}_{side}" for side in "ab" for c in ("id", "name", "rest", "len")]


def _short_pairs(reps: DataFrame) -> DataFrame:
    """Pairs of short names, with names, once for each signature that they share."""
    signed = _signed(reps)
    a, b = _of_side(signed, "a"), _of_side(signed, "b")
    # The size estimate ignores the expansion above, so broadcasting is ruled out.
    met = a.join(b.hint("merge"), F.col("sig_a") == F.col("sig_b")).where(
        (F.col("block_key_a") == F.col("block_key_b"))
        & (F.col("id_a") < F.col("id_b"))
        & (F.col("longest_a") | F.col("longest_b"))
    )
    return met.withColumnRenamed("block_key_a", "block_key").select(*_PAIR)


def _short_candidates(reps: DataFrame) -> DataFrame:
    """(block_key, id_a, id_b): short names that share a signature, each pair once.

    Pairs are not exchanged. Names are dealt over tiles of two slabs of their block, a tile lies
    in one task, and the signatures are made there, so a pair that shares several is met
    again in the same task only.
    """
    spark = reps.sparkSession
    short = _with_rest(reps).where(F.col("len") < SHORT_LIMIT)
    slabs = materialise(short.groupBy("block_key").agg(F.ceil(F.count("*") / SLAB).cast("int").alias("slabs")), "slabs")
    tiles = slabs.agg(F.sum(F.expr("cast(slabs as long) * (slabs + 1) div 2"))).first()[0] or 0
    # More tasks than tiles, since hashes bring some tiles together.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * tiles)
    dealt = short.join(slabs, "block_key").withColumn("own", F.pmod(F.xxhash64("name"), "slabs").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("slabs") - 1))
    placed = dealt.withColumn("other", other).withColumns({"row": F.least("own", "other"), "column": F.greatest("own", "other")})
    tile = ["block_key", "row", "column"]
    signed = _with_signatures(placed.repartition(tasks, *tile))
    name = F.struct("id", F.xxhash64("rest").alias("told"), "own", "longest")
    sharing = signed.groupBy(*tile, "sig").agg(F.collect_list(name).alias("names")).where(F.size("names") > 1)
    met = sharing.withColumn("x", F.explode("names")).withColumn("y", F.explode("names")).where(
        "x.id < y.id AND (x.longest OR y.longest) AND (row = column OR x.own != y.own)"
    )
    pairs = met.select(*tile, F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"), "x.told", F.col("y.told").alias("told_b"))
    return pairs.distinct().select("block_key", "id_a", "id_b")


def _once(pairs: DataFrame) -> DataFrame:
    """Each pair once; names of one pair of ids are told apart by a hash.

    Columns that no later step reads are not exchanged.
    """
    told = F.xxhash64("block_key", "rest_a", "rest_b")
    others = [F.any_value(c).alias(c) for c in pairs.columns if c not in ("id_a", "id_b")]
    return pairs.groupBy("id_a", "id_b", told.alias("told")).agg(*others).drop("told")


def _segment_bounds(length: Column, count: Column) -> Column:
    """Array of (no, start, size): ``count`` segments of nearly equal size."""
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(
            i.alias("no"),
            (F.floor(i * length / count) + 1).cast("int").alias("start"),
            (F.floor((i + 1) * length / count) - F.floor(i * length / count)).cast("int").alias("size"),
        ),
    )


def _segments(names: DataFrame) -> DataFrame:
    """Segments of each name as the shorter side of partners of length l, one set per extra count m."""
    return (
        _spread(names)
        .withColumn("m", F.explode(F.array(*[F.lit(m) for m in range(1, MAX_EXTRA_SEGMENTS + 1)])))
        .withColumn("seg", F.explode(_segment_bounds(F.col("len"), allowed_distance(F.col("l")) + F.col("m"))))
        .withColumn("text", F.substring("name", F.col("seg.start"), F.col("seg.size")))
        .withColumn("sig", F.xxhash64("block_key", "l", "len", "m", "seg.no", "text"))
        .select("sig", "id", "block_key", "len", "l", "m")
    )


def segment_signatures(reps: DataFrame) -> DataFrame:
    """(sig, id, block_key, len, l, m): segments of each name as the shorter side, for all partner lengths l.

    They do not depend on other names, so they can be stored.
    """
    longest = F.col("len") + F.floor(F.col("len") * 3 / 17).cast("int") + 1
    targets = _partner_lengths(F.greatest(F.col("len"), F.lit(SHORT_LIMIT)), longest)
    return _segments(reps.withColumn("l", F.explode(targets)))


def _segment_probe(names: DataFrame) -> DataFrame:
    """Substrings of each name that segments of shorter partners of length ``shorter``, cut by m, could equal.

    A segment moved by d needs at least |d| edits before it and |gap - d| after
    it, which bounds how far it can have moved.
    """
    distance = allowed_distance(F.col("len"))
    gap = F.col("len") - F.col("shorter")
    low = F.col("seg.start") - F.floor((distance - gap) / 2).cast("int")
    high = F.col("seg.start") + F.floor((distance + gap) / 2).cast("int")
    starts = F.filter(
        F.sequence(low, high),
        lambda p: (p >= 1) & (p + F.col("seg.size") - 1 <= F.col("len")),
    )
    return (
        _spread(names)
        .withColumn("seg", F.explode(_segment_bounds(F.col("shorter"), distance + F.col("m"))))
        .withColumn("at", F.explode(starts))
        .withColumn("text", F.substring("name", F.col("at"), F.col("seg.size")))
        .select(F.xxhash64("block_key", "len", "shorter", "m", "seg.no", "text").alias("sig"), *_told_new(names))
        .distinct()
    )


def _told_new(names: DataFrame) -> list[str]:
    return ["id"] + [c for c in names.columns if c == "new"]


def _length_pairs(reps: DataFrame) -> DataFrame:
    """(block_key, len, n, l, n_l): lengths that pairs of long names can have, and how many names have them."""
    sizes = materialise(reps.groupBy("block_key", "len").agg(F.count("*").alias("n")), "lengths")
    partners = sizes.select("block_key", F.col("len").alias("l"), F.col("n").alias("n_l")).where(F.col("l") >= SHORT_LIMIT)
    near = (F.col("l") >= F.col("len")) & (F.col("l") - F.col("len") <= allowed_distance(F.col("l")))
    return materialise(sizes.join(partners, "block_key").where(near), "length-pairs")


def _selective_cuts(index: DataFrame) -> DataFrame:
    """(block_key, len, l, id, m, cost, sigs): the cut of each name whose most frequent needed segment is least frequent.

    With distance + m segments, the m - 1 most frequent ones are left out; ``cost`` is how
    often the others occur.
    """
    counted = index.join(index.groupBy("sig").agg(F.count("*").alias("n")).hint("merge"), "sig")
    cuts = counted.groupBy("block_key", "len", "l", "id", "m").agg(
        F.sort_array(F.collect_list(F.struct(F.col("n"), F.col("sig"))), asc=False).alias("segments")
    )
    needed = cuts.withColumn("segments", F.slice("segments", F.col("m"), F.size("segments")))
    hottest = F.element_at("segments", 1)["n"]
    best = needed.groupBy("block_key", "len", "l", "id").agg(
        F.min_by(F.struct("m", "segments"), F.struct(hottest, "m")).alias("best")
    )
    cost = F.aggregate("best.segments", F.lit(0).cast("long"), lambda total, s: total + s["n"])
    sigs = F.transform("best.segments", lambda s: s["sig"])
    return best.select("block_key", "len", "l", "id", "best.m", cost.alias("cost"), sigs.alias("sigs"))


_CHARACTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "


def _described(names: DataFrame) -> DataFrame:
    """``names`` with the characters that ``rest`` has once and twice (``ones``, ``twos``), and ``rest`` cut before its last word.

    ``heads`` (``twice``) and ``words`` are the characters of the two parts, ``allowed`` is the distance
    allowed to names that are not longer.
    """

    def bits(text: str, least: int) -> Column:
        of = lambda c: F.length(text) - F.length(F.replace(F.col(text), c)) >= least
        every = F.array(*[F.lit(c) for c in _CHARACTERS])
        return F.aggregate(every, F.lit(0).cast("long"), lambda b, c: b * 2 + of(c).cast("long"))

    last = F.substring_index("rest", " ", -1)
    word = F.when(F.length(last) < F.length("rest"), F.concat(F.lit(" "), last)).otherwise(last)
    cut = names.withColumn("word", word)
    cut = cut.withColumn("head", F.substring("rest", F.lit(1), F.length("rest") - F.length("word")))
    told = {"ones": bits("rest", 1), "twos": bits("rest", 2), "heads": bits("head", 1), "twice": bits("head", 2), "words": bits("word", 1)}
    return cut.withColumns(told | {"allowed": allowed_distance(F.col("len")), "size": F.length("head")})


def _with_words(names: DataFrame) -> DataFrame:
    """Described ``names`` with ``no``, the number of their last word; ``apart`` are its distances to the words of the block.

    ``at`` is the word's own place among these. Blocks of many last words have neither.
    """
    words = materialise(names.select("block_key", "word").distinct().withColumn("no", F.monotonically_increasing_id()), "words")
    few = words.groupBy("block_key").agg(F.count("*").alias("n")).where(F.col("n") <= WORDS).select("block_key")
    listed = words.join(few, "block_key").groupBy("block_key").agg(F.collect_list("word").alias("listed"))
    at = (F.array_position("listed", F.col("word")) - 1).cast("int")
    apart = F.transform("listed", lambda other: F.levenshtein(F.col("word"), other))
    known = words.join(listed, "block_key", "left").withColumns({"at": at, "apart": apart}).drop("listed")
    return materialise(names.join(known, ["block_key", "word"]), "described")


def _in_places(half: int, around: int) -> Column:
    """One half of 128 bits set by the characters of ``rest`` and their places, or by places up to ``around`` beside."""

    def bit(moved: int) -> str:
        no = f"(p + {moved}) * 11 + locate(substring(rest, p, 1), '{_CHARACTERS}')"
        return f"if(pmod({no}, 128) div 64 = {half}, shiftleft(1L, pmod({no}, 64)), 0L)"

    set_by = " | ".join(bit(moved) for moved in range(-around, around + 1))
    return F.expr(f"aggregate(sequence(0, length(rest)), 0L, (b, p) -> if(p = 0, b, b | {set_by}))")


def _in_order() -> str:
    """Whether described names x and y, placed, may be alike.

    A character that only one of them has takes an edit. So does one that the other has
    only two or more places away, if the allowed edits cannot move it that far; bits that
    several places share make these fewer, never more.
    """
    limit = "greatest(allowed_x, allowed_y)"
    lacking = "bit_count(ones_{0} & ~ones_{1}) + bit_count(twos_{0} & ~twos_{1})"
    moved = "bit_count(low_{0} & ~low_near_{1}) + bit_count(high_{0} & ~high_near_{1})"
    both = lambda told: f"{told.format('x', 'y')} <= {limit} AND {told.format('y', 'x')} <= {limit}"
    return f"{both(lacking)} AND ({limit} + abs(len_x - len_y) > 3 OR {both(moved)})"


def _may_be_alike() -> str:
    """Whether described names s and t, t not shorter, may be as near as allowed.

    A character that only one of them has takes an edit. Where last words have no character of
    the heads before them, edits of the words do not spare those of the heads: whatever part
    of one name an alignment puts beside the last word of the other, the part of a head in it
    is no help, so the distance is that of the words and what a head lacks at least.
    """
    lacking = "bit_count(ones_{0} & ~ones_{1}) + bit_count(twos_{0} & ~twos_{1})"
    head = "bit_count(heads_{0} & ~heads_{1}) + bit_count(twice_{0} & ~twice_{1})"
    mixed = "((heads_s | heads_t) & (words_s | words_t)) != 0"
    heads = f"least({head.format('s', 't')}, {head.format('t', 's')})"
    return (
        f"{lacking.format('s', 't')} <= allowed_t AND {lacking.format('t', 's')} <= allowed_t"
        f" AND ({mixed} OR coalesce(apart_s[at_t], 0) + {heads} <= allowed_t)"
    )


# Names that differ before the same last word only, in so few characters that they match.
_SURE = "(no_s = no_t AND greatest(size_s, size_t) <= allowed_t)"
# A list of the distance of the rests of names s and t, or NULL beyond the allowed one. A last word that both have changes none.
_TILE_DISTANCE = f"""CASE WHEN {_SURE} THEN array(levenshtein(head_s, head_t))
WHEN levenshtein(rest_s, rest_t, allowed_t) >= 0 THEN array(levenshtein(rest_s, rest_t, allowed_t)) END"""


def _tiled_pairs(names: DataFrame, lengths: DataFrame) -> DataFrame:
    """All pairs of names of the given lengths, each once, that reach the threshold, with their distance.

    Tasks hold some tiles each, whatever the size of the rows, since the work lies in the comparing.
    """
    names = _with_words(_described(_spread(names)))
    spark = names.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    tiles = lambda n: F.ceil(F.col(n) / TILE).cast("int")
    own = lambda n: F.pmod(F.xxhash64("name"), tiles(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), tiles(n) - 1))

    def placed(side: str, row: Column, column: Column) -> DataFrame:
        of_length = names if side == "s" else names.withColumnRenamed("len", "l")
        keys = ["block_key", "len" if side == "s" else "l"]
        both = of_length.join(lengths, keys).withColumn("row", row).withColumn("column", column)
        tile = F.xxhash64("block_key", "len", "l", "row", "column")
        length = F.col("len" if side == "s" else "l")
        kept = [c for c in _kept(names) if c != "len"] + ["head", "at", "apart"]
        # Never null, which shortens what is generated for each pair.
        sure = [F.coalesce(c, F.lit(0)).alias(c) for c in ("ones", "twos", "heads", "twice", "words", "allowed", "size", "no")]
        rows = both.select(tile.alias("tile"), *kept, *sure, length.alias("len"), F.col("l").alias("partner"), F.col("len").alias("other"))
        # By all that the join asks to be equal, or it exchanges once more, into as few tasks as the bytes fill.
        lengths_of_pair = ["len", "partner"] if side == "s" else ["other", "len"]
        return _of_side(rows.repartition(tasks, "tile", "block_key", *lengths_of_pair), side)

    shorter, longer = placed("s", own("n"), every("n_l")), placed("t", every("n"), own("n_l"))
    same_tile = (F.col("tile_s") == F.col("tile_t")) & (F.col("block_key_s") == F.col("block_key_t"))
    same_tile = same_tile & (F.col("len_s") == F.col("other_t")) & (F.col("partner_s") == F.col("len_t"))
    further, ordered = F.col("len_s") < F.col("len_t"), F.col("id_s") < F.col("id_t")

    def met(s: DataFrame, t: DataFrame, condition: Column) -> DataFrame:
        both = t.join(s.hint("merge"), same_tile).where((F.col("id_s") != F.col("id_t")) & condition & F.expr(_may_be_alike()))
        # As a filter it would be pushed into the join, which then reads the text of all pairs.
        return both.withColumn("distance", F.explode(F.expr(_TILE_DISTANCE)))

    if "new" in names.columns:
        pairs = met(shorter.where("new_s"), longer, further | ~F.col("new_t") | ordered)
        pairs = pairs.unionByName(met(shorter.where("NOT new_s"), longer.where("new_t"), further))
    else:
        pairs = met(shorter, longer, further | ordered)
    sides = [
        F.when(ordered, F.col(f"{c}_{x}")).otherwise(F.col(f"{c}_{y}")).alias(f"{c}_{side}")
        for side, x, y in (("a", "s", "t"), ("b", "t", "s"))
        for c in ("id", "name", "rest", "len")
    ]
    return pairs.select(F.col("block_key_s").alias("block_key"), *sides, "distance")


def _segment_pairs(names: DataFrame, cuts: DataFrame) -> DataFrame:
    """Pairs that share a needed segment, each once."""
    shorter = cuts.select(F.explode("sigs").alias("sig"), F.col("id").alias("id_s"))
    used = cuts.select("block_key", F.col("len").alias("shorter"), F.col("l").alias("len"), "m").distinct()
    longer = _of_side(_segment_probe(names.join(used, ["block_key", "len"])), "t").withColumnRenamed("sig_t", "sig")

    def met(s: DataFrame, t: DataFrame) -> DataFrame:
        both = s.join(t.hint("merge"), "sig").where(F.col("id_s") != F.col("id_t"))
        return both.select(F.least("id_s", "id_t").alias("id_a"), F.greatest("id_s", "id_t").alias("id_b"))

    if "new" in names.columns:
        fresh = names.where("new").select(F.col("id").alias("id_s"))
        pairs = met(shorter.join(fresh, "id_s", "left_semi"), longer)
        pairs = pairs.unionByName(met(shorter.join(fresh, "id_s", "left_anti"), longer.where("new_t")))
    else:
        pairs = met(shorter, longer)
    sided = lambda side: _of_side(names.select("block_key", "id", "name", "rest", "len"), side)
    named = pairs.distinct().join(sided("a"), "id_a").join(sided("b"), "id_b")
    same_block = (F.col("block_key_a") == F.col("block_key_b")) & (F.col("id_a") < F.col("id_b"))
    return named.where(same_block).withColumnRenamed("block_key_a", "block_key").select(*_PAIR)


def _all_alike(names: DataFrame) -> DataFrame:
    """(block_key, start, end): how many characters all names of a block begin and end with."""
    end = F.col("len") - F.col("start") - F.length("rest")
    return names.groupBy("block_key").agg(F.min("start").alias("start"), F.min(end).alias("end"))


def _surely_dense() -> Column:
    """Whether every cut of the names of a length needs a segment that all of them have, whatever the rest."""

    def common(m: int) -> Column:
        last = F.col("len") - F.col("end")
        alike = lambda s: (s["start"] + s["size"] - 1 <= F.col("start")) | (s["start"] > last)
        return F.size(F.filter(_segment_bounds(F.col("len"), allowed_distance(F.col("l")) + m), alike)) >= m

    sure = common(1)
    for m in range(2, MAX_EXTRA_SEGMENTS + 1):
        sure = sure & common(m)
    return sure


def _long_pairs(names: DataFrame, stored: DataFrame | None = None, near: bool = True) -> DataFrame:
    """Pairs of trimmed ``names`` whose longer one is long: those that share a segment, or that met in tiles.

    ``stored`` are the names' segment signatures, if there are any already. Those that share a
    segment are compared, too, unless ``near`` is false.
    """
    lengths = _length_pairs(names)
    if lengths.where(F.col("n") > FEW).isEmpty():
        return _tiled_pairs(names, lengths)
    # Where all names have too much in common, segments need not be counted to know that they tell nothing.
    told = (F.col("n") > FEW) & ~_surely_dense()
    counted = materialise(lengths.join(_all_alike(names), "block_key").withColumn("counted", told).drop("start", "end"), "counted")
    many = counted.where("counted").drop("counted")
    if many.isEmpty():
        return _tiled_pairs(names, lengths)
    # Written down, since the planner's estimate ignores the expansion into segments.
    if stored is None:
        index = materialise(_segments(names.join(many.select("block_key", "len", "l"), ["block_key", "len"])), "segments")
    else:
        index = stored.join(many, ["block_key", "len", "l"], "left_semi")
    cuts = materialise(_selective_cuts(index), "cuts")
    costs = cuts.groupBy("block_key", "len", "l").agg(F.sum("cost").alias("cost"))
    dense = F.col("cost") * DENSE >= F.col("n") * F.col("n")
    judged = materialise(many.join(costs, ["block_key", "len", "l"]).withColumn("dense", dense), "judged")
    tiled = counted.where("NOT counted").drop("counted").unionByName(judged.where("dense").select(*lengths.columns))
    sparse = judged.where("NOT dense")
    pairs = _tiled_pairs(names, tiled)
    if sparse.isEmpty():
        return pairs
    met = _with_distance(_segment_pairs(names, cuts.join(sparse, ["block_key", "len", "l"], "left_semi")))
    return pairs.unionByName(met.where(F.col("distance") >= 0) if near else met)


def candidate_pairs(reps: DataFrame) -> DataFrame:
    """(block_key, id_a, id_b): distinct pairs of representatives that may reach the threshold.

    Short names share a signature, long ones a segment; those that met in tiles do reach it.
    """
    names = materialise(trimmed(reps), "trimmed")
    return _short_candidates(names).unionByName(_long_pairs(names, near=False).select("block_key", "id_a", "id_b"))


def block_candidates(records: DataFrame) -> DataFrame:
    """(block_key, id_a, id_b), id_a < id_b: pairs of a block that may reach the threshold.

    ``records`` has columns id, name and block_key; a NULL block forms no pairs.
    Records repeating a name stand behind the smallest id that carries it.
    """
    reps = materialise(representatives(records), "names")
    return candidate_pairs(reps).unionByName(copies(records, reps))


def near_names(reps: DataFrame, once: bool = True) -> DataFrame:
    """(block_key, id_a, id_b, name_a, name_b, distance, similarity) of matching representatives.

    Pairs are compared where they meet, so only those that match are exchanged. Unless they
    are wanted ``once``, short names come once for each signature that they share, and no
    pair is exchanged.
    """
    names = materialise(trimmed(reps), "trimmed")
    short = _with_distance(_short_pairs(names)).where(F.col("distance") >= 0)
    return compared((_once(short) if once else short).unionByName(_long_pairs(names)))


def all_near_pairs(reps: DataFrame) -> DataFrame:
    """(id_a, id_b) of matching representatives found without signatures: each name compared with all of its block.

    The names of a block are dealt over tiles, so tasks hold bounded numbers of names and
    comparisons, however large a block is. The characters and places of two names tell most
    pairs apart, the distance of the others is measured.
    """
    spark = reps.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    sizes = reps.groupBy("block_key").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    places = {"low": _in_places(0, 0), "high": _in_places(1, 0), "low_near": _in_places(0, 1), "high_near": _in_places(1, 1)}
    told = materialise(_described(_spread(trimmed(reps))).withColumns(places), "told")
    dealt = told.join(sizes, "block_key").withColumn("own", F.pmod(F.xxhash64("name"), "tiles").cast("int"))
    others = F.sequence(F.lit(0), F.col("tiles") - 1)
    # A tile (row, column) with row <= column holds both ways of a pair, so each pair meets once.
    rows = dealt.withColumn("column", F.explode(F.filter(others, lambda t: t >= F.col("own")))).withColumn("row", F.col("own"))
    columns = dealt.withColumn("row", F.explode(F.filter(others, lambda t: t <= F.col("own")))).withColumn("column", F.col("own"))

    def placed(tiled: DataFrame, side: str) -> DataFrame:
        tile = F.xxhash64("block_key", "row", "column").alias("tile")
        tiled = tiled.select(tile, "block_key", "own", "id", "rest", "len", "allowed", "ones", "twos", *places)
        return _of_side(tiled.repartition(tasks, "tile", "block_key"), side)

    met = placed(columns, "y").join(placed(rows, "x").hint("merge"), F.col("tile_x") == F.col("tile_y"))
    once = (F.col("id_x") != F.col("id_y")) & ((F.col("own_x") != F.col("own_y")) | (F.col("id_x") < F.col("id_y")))
    alike = F.expr(f"{_in_order()} AND levenshtein(rest_x, rest_y, greatest(allowed_x, allowed_y)) >= 0")
    near = met.where((F.col("block_key_x") == F.col("block_key_y")) & once & alike)
    return near.select(F.least("id_x", "id_y").alias("id_a"), F.greatest("id_x", "id_y").alias("id_b"))


def new_pairs(names: DataFrame, short: DataFrame, segments: DataFrame) -> DataFrame:
    """As near_names, of pairs of ``names`` (with ``new``) of which one at least is new.

    ``short`` (id_a, id_b) are those short names that share a signature, ``segments`` the
    signatures of the long ones.
    """
    names = materialise(trimmed(names), "trimmed")
    sided = lambda side: _of_side(names.select("block_key", "id", "name", "rest", "len"), side)
    named = short.join(sided("a"), "id_a").join(sided("b"), "id_b").where("block_key_a = block_key_b")
    met = named.withColumnRenamed("block_key_a", "block_key").select(*_PAIR)
    return compared(_with_distance(met).where(F.col("distance") >= 0).unionByName(_long_pairs(names, segments)))


def _with_distance(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the ``distance`` of their names, or -1 beyond the allowed one."""
    distance = F.expr("levenshtein(rest_a, rest_b, cast(floor(greatest(len_a, len_b) * 3 / 20) as int))")
    return pairs.withColumn("distance", distance)


def compared(pairs: DataFrame) -> DataFrame:
    """The same of ``pairs`` (block_key, id_a, id_b, name_a, name_b, len_a, len_b, distance) that reach the threshold."""
    rated = pairs.withColumn("similarity", similarity(F.col("distance"), F.greatest("len_a", "len_b")))
    return rated.select("block_key", "id_a", "id_b", "name_a", "name_b", "distance", "similarity")


def same_names(records: DataFrame, reps: DataFrame) -> DataFrame:
    """(id_a, id_b, distance, similarity) of representatives and the records that repeat their name."""
    return copies(records, reps).select("id_a", "id_b", F.lit(0).alias("distance"), F.lit(1.0).alias("similarity"))


def _repeated(records: DataFrame) -> DataFrame:
    """(block_key, name, part, ids): ids of the names that several ids of a block bear, dealt over lists of about LIST."""
    named = _keyed(records).where(F.col("id").isNotNull()).distinct()
    shared = named.groupBy("block_key", "name").agg(F.ceil(F.count("*") / LIST).alias("parts"), F.count("*").alias("n"))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).alias("part")
    dealt = named.join(shared.where(F.col("n") > 1), ["block_key", "name"]).select("block_key", "name", part, "id")
    return dealt.groupBy("block_key", "name", "part").agg(F.collect_list("id").alias("ids"))


def _of_one_id(reps: DataFrame) -> DataFrame:
    """As near_names, of names of a block that have the same representative."""
    a, b = (_of_side(_with_rest(reps).withColumnRenamed("block_key", "block"), side) for side in "ab")
    met = a.join(b, (F.col("block_a") == F.col("block_b")) & (F.col("id_a") == F.col("id_b"))).where("name_a < name_b")
    return compared(_with_distance(met.withColumnRenamed("block_a", "block_key")).where(F.col("distance") >= 0))


def _of_every_record(near: DataFrame, lists: DataFrame) -> DataFrame:
    """(id_a, id_b, distance, similarity) of all records: those of ``near`` names, and those that share one of ``lists``.

    Lists meet before they are expanded, and are dealt by number, so a task expands bounded
    parts of a name, however many records bear it.
    """
    spark = near.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)

    def of(side: str) -> DataFrame:
        return lists.select("block_key", *[F.col(c).alias(f"{c}_{side}") for c in ("name", "part", "ids")])

    met = near.join(of("a"), ["block_key", "name_a"], "left").join(of("b"), ["block_key", "name_b"], "left")
    for side in "ab":
        met = met.withColumn(f"ids_{side}", F.coalesce(f"ids_{side}", F.array(f"id_{side}")))
    same = of("a").join(of("b"), "block_key").where("name_a = name_b AND part_a <= part_b")
    same = same.withColumns({"distance": F.lit(0), "similarity": F.lit(1.0)})
    columns = ["block_key", "name_a", "name_b", "part_a", "part_b", "ids_a", "ids_b", "distance", "similarity"]
    dealt = met.select(*columns).unionByName(same.select(*columns)).repartition(tasks, *columns[:5])
    # Two records of one list are met from either side.
    once = "x != y AND (x < y OR name_a != name_b OR part_a != part_b)"
    pairs = dealt.withColumn("x", F.explode("ids_a")).withColumn("y", F.explode("ids_b")).where(once)
    return pairs.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "distance", "similarity")


def fuzzy_matches(records: DataFrame, once: bool = True, every: bool = False) -> DataFrame:
    """(id_a, id_b, distance, similarity) of matching pairs.

    A record repeating a name is linked to the representative of that name; its
    other matches are those of the representative. With ``every`` it is paired with each
    of its matches and of the records that bear the same name. A step to which repeated
    pairs are the same as single ones takes them without ``once``, which spares their exchange.
    """
    reps = materialise(representatives(records), "names")
    near = near_names(reps, once)
    if every:
        lists = materialise(_repeated(records), "lists")
        if not lists.isEmpty():
            return _of_every_record(near.unionByName(_of_one_id(reps)), lists)
    near = near.select("id_a", "id_b", "distance", "similarity")
    return near if every else near.unionByName(same_names(records, reps))


def best_match(matches: DataFrame) -> DataFrame:
    """(id, match_id, similarity): best partner of each record, strictly above the threshold.

    Pairs may repeat. The smallest partner of each similarity is found where the pairs are
    made, so what is exchanged does not grow with the number of pairs.
    """
    strict = matches.where(F.col("similarity") > THRESHOLD)
    # Both ways from one reading, since the pairs would be made again for a second one.
    ways = [F.struct(F.col(x).alias("id"), F.col(y).alias("match_id"), "similarity") for x, y in (("id_a", "id_b"), ("id_b", "id_a"))]
    both = strict.select(F.inline(F.array(*ways)))
    # A minimum of plain columns is taken by hash, that of a struct by sorting all rows.
    smallest = both.groupBy("id", "similarity").agg(F.min("match_id").alias("match_id"))
    rank = F.struct(-F.col("similarity"), "match_id")
    return (
        smallest.groupBy("id")
        .agg(F.min_by(F.struct("match_id", "similarity"), rank).alias("best"))
        .select("id", "best.match_id", "best.similarity")
    )


def potential_duplicates(df: DataFrame, name: str = "corporate_name") -> DataFrame:
    """Number of rows whose name occurs more than once, every copy counted."""
    groups = df.groupBy(name).agg(F.count("*").alias("_copies")).where(F.col("_copies") > 1)
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("duplicate_records"),
        F.count("*").alias("duplicate_names"),
    )


def match_statistics(sources: dict[str, DataFrame]) -> DataFrame:
    """(source, entities) per source and in total."""
    result = None
    for name, df in sources.items():
        row = df.agg(F.count("*").alias("entities")).select(F.lit(name).alias("source"), "entities")
        result = row if result is None else result.unionByName(row)
    # One rollup over a row per source: the sources themselves are planned once.
    return result.rollup("source").agg(F.sum("entities").alias("entities")).select(
        F.coalesce("source", F.lit("total")).alias("source"), "entities"
    )
