"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Only DataFrame functions, in one scan without a shuffle. Spark gives no positions of
regular-expression matches, so they come from two lists: a text split at the matches has
the gaps, and the running sum of the lengths of gaps and matches has every start. The sum
runs in blocks, and words near a span are read from the gaps beside it, so the time grows
with the text and with the number of matches ``n`` as ``n * BLOCK + (n / BLOCK)^2``.

The patterns that run are written so that no text costs more than linear time and no
recursion: possessive repeats, and look-behinds that begin a match only where the plain
pattern's leftmost match can begin. They find exactly what the plain ones find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lipika.llm._common import table

#: kind, what must occur in a text for the pattern to be tried, pattern, score of a confirmed span, words that speak for it
KINDS = (
    ("email", r"@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "mail|contact|kontakt|correo"),
    ("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.7, "ip|host|server|address|adresse"),
    ("card", r"[0-9][ -]?[0-9]", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])", 0.8, "card|visa|master|credit|karte|carte|tarjeta"),
    ("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", 0.7, "phone|tel|call|mobile|fax|anruf"),
    ("iban", r"[A-Z]{2}[0-9]{2}", r"(?<![0-9A-Za-z_])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![0-9A-Za-z_])", 0.9, "iban|account|konto|bank|compte|cuenta"),
    ("ssn", r"[0-9]-[0-9]", r"(?<![0-9A-Za-z_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z_])", 0.4, "ssn|social security|taxpayer"),
)
BASE = ("email", "ip", "card", "phone")
#: Spans of other kinds stay from this score on; base spans always stay.
THRESHOLD = 0.6
#: A word near a span adds so much to its score; near: so many code points before or after it.
CONTEXT_BONUS, CONTEXT_CHARS = 0.3, 40
#: Matches of a block of the running sum; neighbours that reach over the context, since no match is shorter than three signs.
BLOCK, NEIGHBOURS = 128, CONTEXT_CHARS // 3 + 1


def _bound(name: str, value: str, body: str) -> str:
    """SQL of ``body``, in which ``name`` is a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


_DIGIT = "int(substring(d, -k, 1))"
_WEIGHED = f"CASE WHEN k % 2 = 1 THEN {_DIGIT} WHEN {_DIGIT} > 4 THEN 2 * {_DIGIT} - 9 ELSE 2 * {_DIGIT} END"
_LUHN = _bound("d", "regexp_replace(m, '[^0-9]', '')", f"aggregate(sequence(1, length(d)), 0, (a, k) -> a + {_WEIGHED}) % 10 = 0")
_VALUE = "int(conv(substring(t, k, 1), 36, 10))"
_MOD_97 = _bound("p", "replace(m, ' ', '')", _bound("t", "substring(p, 5) || substring(p, 1, 4)", f"aggregate(sequence(1, length(t)), 0, (r, k) -> (r * CASE WHEN {_VALUE} > 9 THEN 100 ELSE 10 END + {_VALUE}) % 97) = 1"))
_PART = "regexp_replace(p, '^0+(?=[0-9])', '')"
#: What confirms a match ``m``.
_CONFIRMED = {
    "email": "true",
    "ip": f"forall(split(m, '[.]'), p -> length({_PART}) <= 3 AND int(substring({_PART}, 1, 3)) <= 255)",
    "card": _LUHN,
    "phone": "length(regexp_replace(m, '[^0-9]', '')) BETWEEN 9 AND 15",
    "iban": _MOD_97,
    "ssn": "true",
}


def _grown(begin: str, values: str) -> str:
    """SQL of the running sums of ``values`` from ``begin`` on."""
    return f"aggregate({values}, struct({begin} AS at, CAST(array() AS array<int>) AS list), (a, v) -> struct(a.at + v AS at, concat(a.list, array(a.at + v)) AS list), a -> a.list)"


#: Running sums of the array ``sizes``; arrays grow within a block and by blocks only.
_BLOCKS = f"sequence(0, (size(sizes) - 1) div {BLOCK})"
_SLICE = f"slice(sizes, int(b) * {BLOCK} + 1, {BLOCK})"
_TOTALS = _grown("0", f"transform({_BLOCKS}, b -> aggregate({_SLICE}, 0, (c, v) -> c + v))")
_RUNNING = _bound("totals", _TOTALS, f"flatten(transform({_BLOCKS}, b -> {_grown('CASE WHEN b > 0 THEN element_at(totals, int(greatest(b, 1))) ELSE 0 END', _SLICE)}))")


def _spans(kind: str, nth: int, score: float, words: str) -> Column:
    """Confirmed spans of one kind, as structs that sort by start and then by kind."""
    each = "sequence(1, size(x.m))"
    sizes = f"transform({each}, i -> length(x.g[i - 1]) + length(x.m[i - 1]))"
    # gaps and matches in turn, the gaps cut to what the context can hold of them
    before = f"flatten(transform({each}, i -> array(right(x.g[i - 1], {CONTEXT_CHARS}), x.m[i - 1])))"
    after = f"flatten(transform({each}, i -> array(x.m[i - 1], left(x.g[i], {CONTEXT_CHARS}))))"
    first = f"greatest(2 * (i - {NEIGHBOURS}) - 1, 1)"
    left = f"right(array_join(slice(y.l, {first}, 2 * i - {first}), ''), {CONTEXT_CHARS})"
    right = f"left(array_join(slice(y.r, 2 * i, {2 * NEIGHBOURS + 1}), ''), {CONTEXT_CHARS})"
    value = f"least(1D, {score}D + CASE WHEN lower({left} || '\n' || {right}) RLIKE '{words}' THEN {CONTEXT_BONUS}D ELSE 0D END)"
    span = f"named_struct('start', y.e[i - 1] - length(x.m[i - 1]), 'nth', {nth}, 'end', y.e[i - 1], 'kind', '{kind}', 'score', {value})"
    good = f"filter({each}, i -> {_bound('m', 'x.m[i - 1]', _CONFIRMED[kind])})"
    found = _bound("y", f"struct({_bound('sizes', sizes, _RUNNING)} AS e, {before} AS l, {after} AS r)", f"transform({good}, i -> {span})")
    if kind not in BASE:
        found = f"filter({found}, s -> s.score >= {THRESHOLD}D)"
    found = _bound("x", f"struct(m_{kind} AS m, g_{kind} AS g)", found)
    return F.expr(f"CASE WHEN size(m_{kind}) > 0 THEN {found} ELSE CAST(array() AS array<struct<start:int,nth:int,end:int,kind:string,score:double>>) END")


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans``: structs ``(start, nth, end, kind, score)`` in order.

    Positions count code points, the end is exclusive. A null text is an empty one and has
    no spans; every row of ``docs`` comes back once, in no order, with a null doc_id as with
    repeated ones; other columns are not read, whatever their names.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for kind, hint, pattern, *_ in KINDS:
        maybe = F.col("text").contains("@") if kind == "email" else F.col("text").rlike(hint)
        rows = rows.withColumn(f"m_{kind}", F.when(maybe, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    for kind, _, pattern, *_ in KINDS:
        rows = rows.withColumn(f"g_{kind}", F.when(F.size(f"m_{kind}") > 0, F.split("text", pattern, -1)))
    found = [_spans(kind, n, score, words) for n, (kind, _, _, score, words) in enumerate(KINDS)]
    return rows.select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of the documents."""
    rows = find_spans(table(spark, sf_dir, "documents"))
    counts = [F.size(F.filter(F.col("spans")["kind"], lambda k: k == kind)).cast("long").alias(f"n_{kind}") for kind in BASE]  # noqa: B023
    base = F.filter("spans", lambda s: s["nth"] < len(BASE))
    return rows.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_TURNED = "regexp_replace(replace(m, ' ', '')[5:] || replace(m, ' ', '')[1:4], '', '')"
_GOOD = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || left(ltrim(p, '0'), 3) AS INTEGER) > 255)) = 0",
    "card": f"length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(0, length({_DIGITS})), lambda i: CASE WHEN i % 2 = 0 THEN CAST(reverse({_DIGITS})[i + 1] AS INTEGER) WHEN CAST(reverse({_DIGITS})[i + 1] AS INTEGER) > 4 THEN 2 * CAST(reverse({_DIGITS})[i + 1] AS INTEGER) - 9 ELSE 2 * CAST(reverse({_DIGITS})[i + 1] AS INTEGER) END)) % 10 = 0",
    "phone": f"length({_DIGITS}) BETWEEN 9 AND 15",
    "iban": f"list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split({_TURNED}, ''), lambda c: CAST(strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1 AS BIGINT))), lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1",
    "ssn": "regexp_matches(lower(text[greatest(s - 40, 0) + 1:s] || chr(10) || text[s + length(m) + 1:s + length(m) + 40]), 'ssn|social security|taxpayer')",
}


def _sql() -> str:
    parts = []
    for n, (kind, pattern) in enumerate(_PLAIN.items()):
        parts.append(f"""
SELECT doc_id, {n} AS nth, '{kind}' AS kind, s, s + length(m) AS e FROM (
  SELECT doc_id, text, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i: CAST(list_sum(list_transform(gs[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS INTEGER))) AS s
  FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS gs FROM t)) WHERE {_GOOD[kind]}""")
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(parts)}),
g AS (SELECT doc_id, {", ".join(f"count(*) FILTER (nth = {n}) AS n_{k}" for n, k in enumerate(BASE))},
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, nth) FILTER (nth < {len(BASE)}) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, nth) AS spans FROM f GROUP BY doc_id)
SELECT t.doc_id, {", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (doc_id)
"""


QUERIES = {"op8_pii": op8_pii}
ORACLES = {"op8_pii": _sql()}
