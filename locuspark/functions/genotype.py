"""Genotype codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Homozygous calls, phased and unphased.
HOM_REF = ("0|0", "0/0")
HOM_ALT = ("1|1", "1/1")


def recode_gt(gt: Column) -> Column:
    """-1 for homozygous reference, 1 for homozygous alternative, null otherwise."""
    return F.when(gt.isin(*HOM_REF), F.lit(-1.0)).when(gt.isin(*HOM_ALT), F.lit(1.0))
