"""Label → code mapping and ordered text classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rosterlake.operators.joins import dim_join


def map_codes(
    label: Column, codes: Mapping[object, int], default: int = 0, null_code: int | None = None
) -> Column:
    """Code of a label; unmatched labels get ``default``, null its own code when one is given.

    A short literal mapping stays an expression inside code generation, without a join.
    """
    by_code: dict[int, list] = {}
    for value, code in codes.items():
        by_code.setdefault(code, []).append(value)
    out = F.when(label.isNull(), F.lit(default if null_code is None else null_code))
    for code, values in by_code.items():
        out = out.when(label.isin(values), F.lit(code))
    return out.otherwise(F.lit(default))


def map_codes_table(
    df: DataFrame, label: str, mapping: DataFrame, key: str, code: str, out: str, default: int = 0
) -> DataFrame:
    """The same for a mapping held in a table (one row per key)."""
    dim = mapping.select(F.col(key).alias("_label"), F.col(code).alias(out))
    joined = dim_join(df, dim, {label: "_label"}, "left")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(default)))


@dataclass(frozen=True)
class Rule:
    """Assign ``code`` where the title holds all parts (or equals ``equals``).

    With ``only_if`` the rule looks at the class given by the rules before it.
    """

    code: int
    parts: tuple[str, ...] = ()
    equals: str | None = None
    only_if: int | None = None

    def matches(self, title: Column) -> Column:
        if self.equals is not None:
            return title == F.lit(self.equals)
        hit = F.contains(title, F.lit(self.parts[0]))
        for part in self.parts[1:]:
            hit = hit & F.contains(title, F.lit(part))
        return hit


def classify(
    df: DataFrame, title: str, out: str, rules: Sequence[Rule], initial: int = 0
) -> DataFrame:
    """Ordered rules on a title, the last match wins.

    A run of plain rules is one ``when`` chain from the last rule to the first, so a row stops
    at its deciding rule. A rule with ``only_if`` starts a new stage over the class so far.
    """
    column = F.col(title)
    df = df.withColumn(out, F.lit(initial))
    run: list[Rule] = []

    def close(frame: DataFrame) -> DataFrame:
        if not run:
            return frame
        chain = None
        for rule in reversed(run):
            hit = rule.matches(column)
            chain = F.when(hit, F.lit(rule.code)) if chain is None else chain.when(hit, F.lit(rule.code))
        run.clear()
        return frame.withColumn(out, chain.otherwise(F.col(out)))

    for rule in rules:
        if rule.only_if is None:
            run.append(rule)
            continue
        df = close(df)
        hit = (F.col(out) == rule.only_if) & rule.matches(column)
        df = df.withColumn(out, F.when(hit, F.lit(rule.code)).otherwise(F.col(out)))
    return close(df)
