"""Rule-violation table — one output row per (input row, failed rule).

Two forms that return the same rows:

* ``rule_violations``: one pass over the input.  Each rule is a Column that
  yields a ``struct(code, description)`` when the rule fails and NULL
  otherwise; the non-NULL ones are exploded.  Membership tests against
  dimensions are computed once as boolean flags (``key_presence``).
* ``rule_violations_union``: the literal form, one filtered branch per rule
  glued with UNION ALL (re-scans the input per branch).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CODE, DESC = "error_code", "error_description"


@dataclass(frozen=True)
class Rule:
    code: str
    condition: Column  # TRUE = violation; NULL counts as no violation
    description: Column


def rule_violations(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str] | None = None) -> DataFrame:
    """One pass: ``keep`` columns + ``error_code`` + ``error_description``."""
    keep = list(keep) if keep is not None else list(df.columns)
    hits = F.array(*[
        F.when(r.condition, F.struct(F.lit(r.code).alias(CODE), r.description.alias(DESC)))
        for r in rules
    ])
    return (
        df.select(*keep, F.explode(F.array_compact(hits)).alias("__v"))
        .select(*keep, F.col(f"__v.{CODE}").alias(CODE), F.col(f"__v.{DESC}").alias(DESC))
    )


def violation_count(rules: Sequence[Rule]) -> Column:
    """Number of rules a row fails (the number of rows ``rule_violations``
    would emit for it), without exploding."""
    return F.size(F.array_compact(F.array(*[F.when(r.condition, F.lit(r.code)) for r in rules])))


def rule_violations_union(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str] | None = None) -> DataFrame:
    keep = list(keep) if keep is not None else list(df.columns)
    out = None
    for r in rules:
        branch = df.where(r.condition).select(
            *keep, F.lit(r.code).alias(CODE), r.description.alias(DESC)
        )
        out = branch if out is None else out.unionByName(branch)
    return out
