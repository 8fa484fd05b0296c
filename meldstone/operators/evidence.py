"""Which similar names stand for one entity.

Names at 0.85 or more may still be two entities: ids that count up, branches, a common word
beside another common word. What two names do not share decides:

* A token with a digit that only one of them has tells them apart.
* The other tokens that only one has, in order, must be alike by themselves: at most one
  edit for every four characters. A long common part does not make up for it.
* Tokens weigh the inverse of the number of names of the block that hold them. A slip of
  the pen is rare: unless the rarest of these tokens is held by a single name, one side's
  must weigh ``SLIP`` times as much as the other's. Two words that are both in common use
  are two words.

Names that differ only in the order or number of their tokens pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meldstone.operators import matching
from meldstone.sources.storage import materialise

#: How much heavier the rarer spelling must be, unless only one name holds it.
SLIP = 5
#: Characters for each edit that the differing part may have.
CHARACTERS_PER_EDIT = 4


def tokens(name: Column) -> Column:
    return F.split(name, " ")


def token_holders(names: DataFrame) -> DataFrame:
    """(block_key, token, holders): in how many of the names (block_key, name) of a block a token stands."""
    each = names.select("block_key", F.explode(F.array_distinct(tokens(F.col("name")))).alias("token"))
    return each.groupBy("block_key", "token").agg(F.count("*").alias("holders"))


def by_numbers(reps: DataFrame) -> DataFrame:
    """``reps`` with blocks that names share only if they have the same tokens with a digit.

    A token with a digit that only one of two names has tells them apart, so no pair that
    stands for one entity lies between these blocks.
    """
    numbers = F.array_sort(F.array_distinct(F.filter(tokens(F.col("name")), lambda t: t.rlike("[0-9]"))))
    return reps.withColumn("block_key", F.concat("block_key", F.lit("\n"), F.array_join(numbers, " ")))


def in_own_blocks(pairs: DataFrame) -> DataFrame:
    """``pairs`` of by_numbers under the block keys they had before."""
    return pairs.withColumn("block_key", F.regexp_replace("block_key", "\n[^\n]*\\z", ""))


def differences(pairs: DataFrame) -> DataFrame:
    """``pairs`` (with name_a and name_b) and the tokens that only one side has, rest_a and rest_b."""
    a, b = tokens(F.col("name_a")), tokens(F.col("name_b"))
    return pairs.withColumns({"rest_a": F.array_except(a, b), "rest_b": F.array_except(b, a)})


def alike(rest_a: Column, rest_b: Column) -> Column:
    """Whether the differing tokens have no digit and are one slip per four characters apart at most."""
    x, y = F.concat_ws(" ", rest_a), F.concat_ws(" ", rest_b)
    longer = F.greatest(F.length(x), F.length(y))
    numbers = F.exists(F.concat(rest_a, rest_b), lambda t: t.rlike("[0-9]"))
    return ~numbers & (F.levenshtein(x, y) * CHARACTERS_PER_EDIT <= longer)


def evident_pairs(pairs: DataFrame, holders: DataFrame) -> DataFrame:
    """Those of ``pairs`` (block_key, id_a, id_b, name_a, name_b, ...) that stand for one entity.

    Only pairs with differing tokens are looked up; they are few, and each brings a token or
    two of either side.
    """
    told = differences(pairs)
    same = told.where((F.size("rest_a") == 0) & (F.size("rest_b") == 0))
    near = told.where(((F.size("rest_a") > 0) | (F.size("rest_b") > 0)) & alike(F.col("rest_a"), F.col("rest_b")))
    near = materialise(near, "near-names")

    def of_side(side: str) -> Column:
        return F.transform(f"rest_{side}", lambda t: F.struct(F.lit(side).alias("side"), t.alias("token")))

    looked_up = near.select("block_key", "id_a", "id_b", F.inline(F.concat(of_side("a"), of_side("b"))))
    weighed = looked_up.join(holders, ["block_key", "token"]).groupBy("id_a", "id_b").agg(
        *[F.min(F.when(F.col("side") == s, F.col("holders"))).alias(f"fewest_{s}") for s in ("a", "b")]
    )
    fewest, most = F.least("fewest_a", "fewest_b"), F.greatest("fewest_a", "fewest_b")
    slips = weighed.where((fewest == 1) | (most >= SLIP * fewest)).select("id_a", "id_b")
    return same.unionByName(near.join(slips, ["id_a", "id_b"], "left_semi")).drop("rest_a", "rest_b")


def evident_matches(records: DataFrame) -> DataFrame:
    """(id_a, id_b, distance, similarity) of records (id, name, block_key) that stand for one entity.

    A record repeating a name is linked to the representative of that name.
    """
    reps = materialise(matching.representatives(records), "names")
    named = in_own_blocks(matching.near_names(by_numbers(reps)))
    columns = ["id_a", "id_b", "distance", "similarity"]
    return evident_pairs(named, token_holders(reps)).select(*columns).unionByName(matching.same_names(records, reps))
