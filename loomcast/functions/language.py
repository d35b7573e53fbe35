"""Language labels: families and preferences. The three ways of forming a family differ on purpose, as their sources do."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Labels of one family.
CHINESE = ("zh", "yue", "cmn")


def family(label: Column) -> Column:
    """The part before the first hyphen, lower-cased."""
    return F.split_part(F.lower(F.trim(F.coalesce(label, F.lit("")))), F.lit("-"), F.lit(1))


def family_machine(label: Column) -> Column:
    """As `family`, with the mark of machine-made tracks taken off."""
    return F.split_part(F.regexp_replace(F.lower(F.trim(F.coalesce(label, F.lit("")))), "^ai-", ""), F.lit("-"), F.lit(1))


def family_folded(label: Column) -> Column:
    """As `family_machine`, the Chinese ones being one."""
    f = family_machine(label)
    return F.when(f.isin(*CHINESE), "zh").otherwise(f)


def matches(track: Column, content: Column) -> Column:
    """Whether a track is in the content's language; unknown languages never match."""
    a, b = family_machine(track), family_machine(content)
    known = ~a.isin("", "und") & ~b.isin("", "und")
    return known & ((a == b) | (a.isin(*CHINESE) & b.isin(*CHINESE)))


def rank(track: Column, wanted: list[str]) -> Column:
    """The place of a label among the wanted: exact before family before none."""
    exact = F.array_position(F.array(*map(F.lit, wanted)), track)
    loose = F.array_position(F.array(*[F.lit(w.lower().removeprefix("ai-").split("-")[0]) for w in wanted]), family_machine(track))
    return F.when(exact > 0, exact - 1).when(loose > 0, 100 + loose - 1).otherwise(1000)
