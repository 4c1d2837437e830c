"""Channel-label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def electrode_name(label: Column) -> Column:
    """First word of a channel label in title case: ``FP1-F7`` -> ``Fp1``."""
    return F.initcap(F.regexp_extract(label, r"(?U)(\w+)", 1))


def suffix_repeats(labels: Column) -> Column:
    """Within one array of labels, number those that occur more than once: ``X, X`` -> ``X-0, X-1``."""

    def rename(label: Column, position: Column) -> Column:
        same = F.filter(labels, lambda other: other == label)
        before = F.filter(F.slice(labels, 1, position), lambda other: other == label)
        return F.when(F.size(same) > 1, F.concat_ws("-", label, F.size(before))).otherwise(label)

    return F.transform(labels, rename)
