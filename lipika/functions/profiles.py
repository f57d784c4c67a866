"""What the text operators need to know about a script."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ScriptProfile:
    """Bodies of regular-expression character classes, and thresholds.

    ``letters`` are the script's characters, ``keep`` what else a clean line may hold, both
    written so that Java and RE2 read them alike; ``assigned`` is a whole Java class that
    leaves unassigned code points out. ``block_size`` is the denominator of coverage.
    """

    name: str
    letters: str
    assigned: str
    keep: str
    block_size: int
    min_letters: int = 8
    max_chars: int = 80
    min_ratio: float = 0.65
    min_chars: int = 6


_KEEP = r" .,;:?!\-/()\"'।॥%0-9"

KANNADA = ScriptProfile("kannada", "\u0c80-\u0cff", "[\u0c80-\u0cff&&[^\\p{Cn}]]", _KEEP, 128)
LATIN = ScriptProfile("latin", "A-Za-zÀ-ÖØ-öø-ÿ", "[A-Za-zÀ-ÖØ-öø-ÿ]", _KEEP, 128)
