"""Encodability in a dictionary of units, compiled to regular expressions.

A greedy walk takes the longest unit at each place. Alternatives by first character, the longest
first among them, with a possessive repeat take the same ones and never go back, so one match
decides. The dictionary is small (it is a model's alphabet) and becomes a literal.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lipika.functions.text import VIRAMA, bound, characters

#: A dictionary beyond so many units isn't compiled into a pattern.
MOST_UNITS = 50_000


def _quoted(unit: str) -> str:
    return re.sub(r"([\\.\[\]{}()*+?^$|#&~-])", r"\\\1", unit).replace("\n", r"\n").replace("\t", r"\t")


class Dictionary:
    """Units of a model. Without units, everything counts as encodable."""

    def __init__(self, units: Iterable[str], exempt: str = " \t\n") -> None:
        self.units = sorted({u for u in units if u}, key=lambda u: (-len(u), u))
        self.exempt = exempt

    @classmethod
    def from_table(cls, units: DataFrame, column: str = "unit", exempt: str = " \t\n") -> Dictionary:
        """From a table of units, whose size is checked before it comes to the driver."""
        rows = units.select(column).distinct().limit(MOST_UNITS + 1).collect()
        if len(rows) > MOST_UNITS:
            raise ValueError(f"more than {MOST_UNITS} units")
        return cls((r[0] for r in rows if r[0]), exempt)

    def alternation(self, exempt_first: bool = False) -> str:
        """The longest unit, and the exempt characters after the units (or before).

        Units of one character that begin no longer one are a class; others stand behind their first
        character, longest first. So a place tries what begins like it, not the whole dictionary.
        """
        rest: dict[str, list[str]] = {}
        for u in self.units:
            rest.setdefault(u[0], []).append(u[1:])
        alone = "".join(_quoted(c) for c, tails in rest.items() if tails == [""])
        units = [f"[{alone}]"] if alone else []
        units += [f"{_quoted(c)}(?:{'|'.join(map(_quoted, tails))})" for c, tails in rest.items() if tails != [""]]
        exempt = [f"[{''.join(map(_quoted, self.exempt))}]"] if self.exempt else []
        return "|".join([*exempt, *units] if exempt_first else [*units, *exempt])

    def encodable(self, c: Column, exempt_first: bool = False) -> Column:
        """Whether the walk gets through the whole text."""
        return c.rlike(rf"\A(?:{self.alternation(exempt_first)})*+\z") if self.units else F.lit(True)

    def segments(self, c: Column) -> Column:
        """What the walk took, up to the first place where it fails."""
        return F.regexp_extract_all(c, F.lit(rf"\G(?:{self.alternation()})"), F.lit(0))

    def failure_offset(self, c: Column) -> Column:
        """Characters before the first failure; null where there is none."""
        done = F.length(F.regexp_extract(c, rf"\A(?:{self.alternation()})*+", 0))
        return bound(done, lambda d: F.when(d < F.length(c), d)) if self.units else F.lit(None).cast("int")

    def failing_words(self, c: Column) -> Column:
        """Words (at single spaces) that the walk doesn't get through, in order: one pass over the text."""
        within = Dictionary((u for u in self.units if " " not in u), self.exempt.replace(" ", "")).alternation()
        walk = f"(?:{within})*+" if within else ""
        return F.regexp_extract_all(c, F.lit(rf"\G(?:{walk} )*+({walk}[^ ]++)"), F.lit(1)) if self.units else F.array().cast("array<string>")

    def first_failure(self, c: Column, letters: str = "\u0c80-\u0cff", signs: str = "\u0cbe-\u0ccc") -> Column:
        """The whole cluster around the first failure: back over a virama and its base, on over viramas and signs."""
        at = self.failure_offset(c)
        head, tail = F.substring(c, F.lit(1), at), F.substring(c, at + 1, F.length(c))
        before = F.regexp_extract(head, rf"[{letters}]?{VIRAMA}?$", 0)
        before = F.when(F.regexp_extract(head, f"{VIRAMA}$", 0) != "", before).otherwise(F.regexp_extract(head, rf"[{letters}]?$", 0))
        after = F.regexp_extract(tail, rf"^(?s:.)(?:{VIRAMA}|(?<={VIRAMA})(?s:.)|[{signs}])*", 0)
        return F.when(at.isNotNull(), F.concat(before, after))

    def offending(self, c: Column) -> Column:
        """The characters that are no units by themselves, sorted, each once."""
        alone = "".join(_quoted(u) for u in self.units if len(u) == 1) + "".join(map(_quoted, self.exempt))
        return F.array_join(F.array_sort(F.array_distinct(F.filter(characters(c), lambda x: ~x.rlike(f"^[{alone}]$")))), "") if alone else c
