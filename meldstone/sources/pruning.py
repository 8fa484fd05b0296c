"""What a planned scan will read: partition filters and files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Scan:
    """A file scan of a plan: columns, filters on partitions, pushed filters, files left and files there."""

    columns: tuple[str, ...]
    partition_filters: tuple[str, ...]
    pushed_filters: tuple[str, ...]
    files_read: int
    files_present: int


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def scans(df: DataFrame) -> list[Scan]:
    """The file scans of ``df`` as planned, without running it.

    Partition filters are applied to the listing of files here, as they will be at run time;
    filters that a join supplies while it runs are not counted.
    """
    plan = df._jdf.queryExecution().sparkPlan()
    found = []
    for leaf in _items(plan.collectLeaves()):
        if leaf.getClass().getSimpleName() != "FileSourceScanExec":
            continue
        metadata = leaf.metadata()
        pushed = metadata.get("PushedFilters")
        listed = pushed.get().strip("[]") if pushed.isDefined() else ""
        found.append(
            Scan(
                columns=tuple(leaf.requiredSchema().fieldNames()),
                partition_filters=tuple(f.sql() for f in _items(leaf.partitionFilters())),
                pushed_filters=tuple(x for x in listed.split(", ") if x),
                files_read=leaf.selectedPartitions().totalNumberOfFiles(),
                files_present=len(leaf.relation().location().inputFiles()),
            )
        )
    return found
