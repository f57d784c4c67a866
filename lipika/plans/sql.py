"""Pieces of DuckDB SQL that say what the column functions compute."""

from __future__ import annotations

from lipika.functions.profiles import LATIN

L, KEEP = LATIN.letters, LATIN.keep.replace("'", "''")
SPACE = r"[ \t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def replaced(expression: str, *steps: tuple[str, str]) -> str:
    for pattern, by in steps:
        expression = f"regexp_replace({expression}, '{pattern}', '{by}', 'g')"
    return expression


def strip(expression: str) -> str:
    return replaced(expression, (f"^{SPACE}+|{SPACE}+$", ""))


def clean(expression: str) -> str:
    steps = [("<[^>]+>", " "), (r"https?://\S+", ""), (r"\[\d+\]", ""), (r"^[=*#\s]+", ""), ("[=*#]+$", ""), (f"[^{KEEP}{L}]", ""), (" +", " ")]
    return f"trim({replaced(expression, *steps)}, ' ')"


def letters(expression: str) -> str:
    return f"len(regexp_extract_all({expression}, '[{L}]'))"


def ratio(expression: str) -> str:
    return f"coalesce({letters(expression)} / nullif(length({expression}), 0), 0)"


_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"


def text_lines(expression: str) -> str:
    whole = f"string_split_regex({expression}, '{_ENDS}')"
    return f"CASE WHEN {expression} IS NULL OR {expression} = '' THEN [] WHEN {whole}[-1] = '' THEN {whole}[:-2] ELSE {whole} END"


LINES = f"""lines AS (SELECT doc_id, lang, source, {{'doc_id': doc_id, 'line_no': i}} AS pos, line FROM
  (SELECT doc_id, lang, source, CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS i, unnest(ls) AS line FROM (SELECT doc_id, lang, source, {text_lines('text')} AS ls FROM documents)))"""
CLEAN = f"{LINES}, clean AS (SELECT doc_id, lang, source, pos, {clean('line')} AS line FROM lines), kept AS (SELECT * FROM clean WHERE {letters('line')} >= {LATIN.min_letters})"
#: A place as two columns.
PLACE = "pos.doc_id AS doc_id, pos.line_no AS line_no"
