"""Resolving new records against those of earlier loads.

The index keeps the distinct names of each load, their signatures, and the similar pairs
they gave. A load computes signatures of its new names only and looks up partners of those
by the stored ones, or in tiles where signatures tell nothing; pairs of two old names are
neither looked for nor compared again. What stands for one
entity may change with a load, since the weight of a token depends on all names of its
block, and so may clusters: the pairs of the blocks that the load touched are judged again
and their clusters drawn anew, from pairs, not from names. After any number of loads the
clusters are those of one resolution of all records.

Each load writes folders of its own and counts once its note exists, so a load that died is
repeated from the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meldstone.operators import matching
from meldstone.operators.clusters import connected_components
from meldstone.operators.evidence import evident_pairs, token_holders
from meldstone.sources.bucketed import BucketedTable
from meldstone.sources.storage import list_folders, materialise, path_exists, touch

#: Buckets of the cluster labels, by block.
BUCKETS = 64

_NAMES, _SHORT, _CUT, _NEAR, _COPIES = "names", "short", "cut", "near", "copies"


class EntityIndex:
    """Names, signatures, pairs and clusters below ``path``; ids are of type ``id_type``."""

    def __init__(self, spark: SparkSession, path: str, id_type: T.DataType, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        columns = {"id": id_type, "id_a": id_type, "id_b": id_type, "cluster_id": id_type, "sig": T.LongType(),
                   "len": T.IntegerType(), "l": T.IntegerType(), "m": T.IntegerType(), "longest": T.BooleanType(), "distance": T.IntegerType(), "similarity": T.DoubleType()}
        layout = {
            _NAMES: "block_key name id len",
            _SHORT: "sig id longest",
            _CUT: "sig id block_key len l m",
            _NEAR: "block_key id_a id_b name_a name_b distance similarity",
            _COPIES: "block_key id_a id_b",
            "labels": "block_key id cluster_id",
        }
        self.schemas = {
            name: T.StructType([T.StructField(c, columns.get(c, T.StringType())) for c in listed.split()])
            for name, listed in layout.items()
        }
        self.labels = BucketedTable(spark, f"{self.path}/labels", self.schemas["labels"], "block_key", buckets, "load")

    def loads(self) -> list[str]:
        return [n for n in list_folders(self.spark, f"{self.path}/loads") if path_exists(self.spark, f"{self.path}/loads/{n}/_SUCCESS")]

    def _stored(self, table: str, loads: list[str]) -> DataFrame:
        if not loads:
            return self.spark.createDataFrame([], self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*[f"{self.path}/{table}/load={n}" for n in loads])

    def _write(self, table: str, load: str, rows: DataFrame) -> DataFrame:
        folder = f"{self.path}/{table}/load={load}"
        rows.select(*self.schemas[table].names).write.mode("overwrite").parquet(folder)
        return self._stored(table, [load])

    def clusters(self) -> DataFrame:
        """(id, cluster_id) of every record with a partner; cluster_id is the smallest id of the cluster."""
        return self.labels.newest([n for n in self.labels.versions() if n in self.loads()]).select("id", "cluster_id")

    def add(self, records: DataFrame, load: str) -> None:
        """Resolve ``records`` (id, name, block_key) against all loads before; names of loads sort by time.

        A load that is in already is left alone.
        """
        before = self.loads()
        if load in before:
            return
        if before and load < max(before):
            raise ValueError(f"load {load} is older than the newest one, {max(before)}")
        records = materialise(records.select("id", "name", "block_key"), "records")
        known = self._stored(_NAMES, before)
        reps = materialise(matching.representatives(records), "names")
        fresh = self._write(_NAMES, load, reps.join(known, ["block_key", "name"], "left_anti"))
        names = known.unionByName(fresh)
        copies = self._write(_COPIES, load, matching.copies(records, names))
        near = self._write(_NEAR, load, self._near(fresh, load, before, known))
        self._draw(load, before, fresh.select("block_key").union(copies.select("block_key")).distinct(), names, near, copies)
        touch(self.spark, f"{self.path}/loads/{load}/_SUCCESS")

    def _near(self, fresh: DataFrame, load: str, before: list[str], known: DataFrame) -> DataFrame:
        """Similar names, one of them new at least; blocks without a new name are not looked at."""
        short = self._write(_SHORT, load, matching.short_signatures(fresh))
        cut = self._write(_CUT, load, matching.segment_signatures(fresh))
        touched = fresh.select("block_key").distinct()
        names = known.join(touched, "block_key", "left_semi").withColumn("new", F.lit(False))
        names = names.unionByName(fresh.withColumn("new", F.lit(True)))
        every = short.unionByName(self._stored(_SHORT, before))
        x, y = (rows.select("sig", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "longest")]) for rows, s in ((short, "x"), (every, "y")))
        met = x.join(y, "sig").where((F.col("id_x") != F.col("id_y")) & (F.col("longest_x") | F.col("longest_y")))
        met = met.select(F.least("id_x", "id_y").alias("id_a"), F.greatest("id_x", "id_y").alias("id_b")).distinct()
        return matching.new_pairs(names, met, cut.unionByName(self._stored(_CUT, before)))

    def _draw(self, load: str, before: list[str], blocks: DataFrame, names: DataFrame, near: DataFrame, copies: DataFrame) -> None:
        """Clusters of the touched blocks, in place of those they had."""
        blocks = materialise(blocks, "blocks")

        def in_blocks(rows: DataFrame) -> DataFrame:
            return rows.join(blocks, "block_key", "left_semi")

        pairs = in_blocks(near.unionByName(self._stored(_NEAR, before)))
        links = evident_pairs(pairs, token_holders(in_blocks(names))).select("block_key", "id_a", "id_b")
        links = materialise(links.unionByName(in_blocks(copies.unionByName(self._stored(_COPIES, before)))), "links")
        of_block = links.select("block_key", F.col("id_a").alias("id")).union(links.select("block_key", "id_b")).distinct()
        drawn = connected_components(links.select("id_a", "id_b")).join(of_block, "id")
        buckets = self.labels.touched(blocks)
        kept = self.labels.newest([n for n in self.labels.versions() if n in before], buckets).join(blocks, "block_key", "left_anti")
        columns = self.schemas["labels"].names
        self.labels.write(drawn.select(*columns).unionByName(kept.select(*columns)), load, buckets)
