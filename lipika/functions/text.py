"""Column functions over lines and texts. None starts a job; each takes and returns columns.

Patterns that also run in the SQL oracles stay within what RE2 and Java read alike. ``\\s`` and
``\\d`` are written out where the plain Java ones are ASCII only but Unicode is meant.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lipika.functions.profiles import KANNADA, ScriptProfile

#: White space as Python's str.strip and str.split know it.
SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: The same characters one by one.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
VIRAMA, ZWNJ, ZERO, ANUSVARA = "\u0ccd", "\u200c", "\u0ce6", "\u0c82"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(c, F.lit(SPACES))


def replace_all(c: Column, *steps: tuple[str, str]) -> Column:
    """Pattern by pattern, in order."""
    return reduce(lambda x, s: F.regexp_replace(x, s[0], s[1]), steps, c)


def text_lines(c: Column) -> Column:
    """Lines of a text; like ``splitlines``, a line end at the very end begins no further line."""
    whole = F.split(F.coalesce(c, F.lit("")), r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]", -1)
    return bound(whole, lambda w: F.when(F.element_at(w, -1) == "", F.slice(w, F.lit(1), F.size(w) - 1)).otherwise(w))


def clean_line(c: Column, profile: ScriptProfile) -> Column:
    """Tags to spaces; urls, ``[n]`` and heading marks out; only the script and the kept characters; single spaces."""
    # most lines lack what a step looks for, and a search for plain text is far cheaper than a pattern
    has = lambda text: lambda x: x.contains(text)
    first = lambda x: F.substring(x, 1, 1).rlike(r"[=*#\s]")
    last = lambda x: x.endswith("=") | x.endswith("*") | x.endswith("#")
    steps = [(has("<"), r"<[^>]+>", " "), (has("http"), r"https?://\S+", ""), (has("["), r"\[\d+\]", ""), (first, r"^[=*#\s]+", ""), (last, r"[=*#]+$", "")]
    line = reduce(lambda x, s: bound(x, lambda v: F.when(s[0](v), F.regexp_replace(v, s[1], s[2])).otherwise(v)), steps, c)
    # what stays is consumed with what goes: a search that tries every place afresh takes several times as long
    line = F.regexp_replace(line, rf"\G([{profile.keep}{profile.letters}]*+)[^{profile.keep}{profile.letters}]++", "$1")
    if profile.assigned != f"[{profile.letters}]":
        line = F.regexp_replace(line, rf"[{profile.letters}&&[^{profile.assigned}]]", "")
    return F.trim(bound(line, lambda v: F.when(v.contains("  "), F.regexp_replace(v, " +", " ")).otherwise(v)))


def script_count(c: Column, profile: ScriptProfile, assigned: bool = True) -> Column:
    """Number of the script's characters."""
    # how much shorter the text is without them: no array of single characters is made
    pattern = profile.assigned if assigned else f"[{profile.letters}]"
    return bound(c, lambda x: F.length(x) - F.length(F.regexp_replace(x, f"{pattern}+", "")))


def script_ratio(c: Column, profile: ScriptProfile) -> Column:
    """Share of the script's block among all characters; 0 for an empty text."""
    return bound(c, lambda x: F.coalesce(script_count(x, profile, assigned=False) / F.nullif(F.length(x), F.lit(0)), F.lit(0.0)))


def script_only(c: Column, profile: ScriptProfile) -> Column:
    """Whether a cluster consists of the script's characters alone."""
    return c.rlike(rf"^[{profile.letters}]+$")


def strip_wikitext(c: Column) -> Column:
    """Wiki markup out: templates (nested four deep), page breaks, references, comments, tags, links, quotes, headings.

    References and comments go before other tags, so that their bodies go too.
    """
    templates = [(r"[{]{2}(?:[Rr]unning|[Rr])(?:[Hh]eader|[Hh])[^}]*[}]{2}", "")] + [(r"[{]{2}[^{}]*[}]{2}", "")] * 4
    return replace_all(
        c,
        *templates,
        (r"<pb[^/]*/>", ""),
        (r"(?s)<ref[^>/]*>.*?</ref>", ""),
        (r"(?s)<!--.*?-->", ""),
        (r"<[^>]+>", " "),
        (r"\[{2}(?:[^\]|]*[|])?([^\]]*)\]{2}", "$1"),
        (r"\[https{0,1}://[^\s]+(?:\s+[^\]]{1,})?\]", ""),
        (r"'{2,3}", ""),
        (r"={2,}[^=]+=+", ""),
        (r"[ \t]+", " "),
    )


def _fit(x: Column, profile: ScriptProfile) -> Column:
    return (F.length(x) >= profile.min_chars) & (script_ratio(x, profile) >= profile.min_ratio)


def wikitext_sentences(c: Column, profile: ScriptProfile) -> Column:
    """Sentences of a wiki page: stripped lines and, within them, parts at dandas, long and in-script enough, cut at the longest length."""
    lines = F.filter(F.transform(text_lines(strip_wikitext(c)), strip), lambda x: _fit(x, profile))
    parts = F.flatten(F.transform(lines, lambda x: F.transform(F.split(x, "[।॥]"), strip)))
    return F.transform(F.filter(parts, lambda x: _fit(x, profile)), lambda x: F.substring(x, 1, profile.max_chars))


def wiki_sentences(c: Column, profile: ScriptProfile, min_ratio: float = 0.75, min_chars: int = 10) -> Column:
    """Sentences of raw dump lines; cut first, then judged by the ratio."""
    parts = F.transform(
        F.split(c, "[।॥\n]"),
        lambda x: strip(replace_all(x, (r"\[{2}(?:[^\]|]*[|])?([^\]]+)\]{2}", "$1"), (r"[{]{2}[^}]*[}]{2}", ""), (r"<[^>]+>", ""), (r"\[\d+\]", ""), (rf"{SPACE}+", " "))),
    )
    cut = F.transform(F.filter(parts, lambda x: F.length(x) >= min_chars), lambda x: F.substring(x, 1, profile.max_chars))
    return F.filter(cut, lambda x: script_ratio(x, profile) >= min_ratio)


def strip_verse(c: Column) -> Column:
    """A line without a verse number between double bars at its end; single spaces."""
    # stripped, so the closing bars are the last characters
    bare = F.rtrim(F.regexp_replace(strip(c), rf"[।|]{{2}}[{SPACE[1:-1]}0-9\u0966-\u096f\u0ce6-\u0cef]++[।|]{{2}}\z", ""), F.lit(SPACES))
    return bound(bare, lambda x: F.when(x.contains("  ") | x.contains("\t"), F.regexp_replace(x, r"[ \t]+", " ")).otherwise(x))


def verse_line(c: Column, profile: ScriptProfile, min_ratio: float = 0.35, min_chars: int = 4) -> Column:
    """The line without its verse number, or null where it is too short or too little in the script."""
    return bound(strip_verse(c), lambda x: F.when((F.length(x) >= min_chars) & (script_ratio(x, profile) >= min_ratio), x))


def strip_noise(c: Column) -> Column:
    """Digit zero to anusvara; tags, dandas, foreign digits, one-letter notes in brackets, plus signs and quotes out."""
    return replace_all(F.replace(c, F.lit(ZERO), F.lit(ANUSVARA)), (r"<[^>]+>", ""), ("[।॥०-९]", ""), ("\\([\u0c80-\u0cff]\\)", ""), (r"\+", ""), ("['\"ʼ]", ""))


def has_noise(c: Column) -> Column:
    """Whether ``strip_noise`` would find something; like the gate it models, it overlooks digit zero and the letter apostrophe."""
    return c.rlike("<[^>]+>|[।॥]|[०-९]|\\([\u0c80-\u0cff]\\)|\\+|['\"\ufffc]")


def strip_noise_lines(c: Column) -> Column:
    """``strip_noise`` line by line; blank lines and a line end at the end stay."""
    lines = F.transform(F.split(c, "\n", -1), lambda x: strip(F.regexp_replace(strip_noise(x), r"[ \t]+", " ")))
    return F.array_join(lines, "\n")


def strip_noise_page(c: Column) -> Column:
    """``strip_noise`` over a page's one text; exactly one line end at the end."""
    return F.concat(strip(F.regexp_replace(strip_noise(strip(c)), r"[ \t]+", " ")), F.lit("\n"))


def first_difference(before: Column, after: Column, clip: int = 100) -> Column:
    """Number and both sides of the first line that differs, clipped; null if none within the shorter text."""
    pairs = F.arrays_zip(text_lines(before).alias("a"), text_lines(after).alias("b"))
    numbered = F.transform(pairs, lambda p, i: F.struct((i + 1).alias("line"), F.substring(p["a"], 1, clip).alias("before"), F.substring(p["b"], 1, clip).alias("after"), (p["a"] != p["b"]).alias("differs")))
    return F.get(F.filter(numbered, lambda p: p["differs"]), 0).dropFields("differs")


def wordfinal_virama(c: Column) -> Column:
    """A virama that no consonant follows gets a zero-width non-joiner."""
    return F.regexp_replace(c, f"{VIRAMA}(?![\u0c95-\u0cb9\u0cde\u0ce0\u0ce1{ZWNJ}])", VIRAMA + ZWNJ)


def clean_ground_truth(c: Column) -> Column:
    """``strip_noise``, bars and Latin letters out, word-final viramas closed, single spaces."""
    return strip(F.regexp_replace(wordfinal_virama(replace_all(strip_noise(c), (r"\|", ""), ("[a-zA-Z]", ""))), rf"{SPACE}+", " "))


@F.pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Normalisation form C, for which there is no built-in function."""
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def clean_scan_truth(c: Column) -> Column:
    """NFC, without zero-width characters, single spaces."""
    return strip(F.regexp_replace(F.regexp_replace(nfc(c), "[\u200b\u200c\u200d]", ""), rf"{SPACE}+", " "))


def filter_tokens(c: Column, unsupported: str, single_only: bool = False) -> Column:
    """Tokens (at single spaces) without those that hold a character of the class body ``unsupported``.

    With ``single_only``, only tokens of one character go.
    """
    bad = lambda t: t.rlike(f"[{unsupported}]") & ((F.length(t) == 1) if single_only else F.lit(True))
    return F.array_join(F.filter(F.split(c, " "), lambda t: ~bad(t)), " ")


_PARTS = "struct<done:array<string>,cur:string,n:int>"


def split_at_boundary(c: Column, longest: int = 80) -> Column:
    """Parts of at most ``longest`` characters at single spaces; an overlong word stays whole."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("cur"), F.lit(0).alias("n")).cast(_PARTS)

    def step(a: Column, w: Column) -> Column:
        full = (a["n"] + F.length(w) + 1 > longest) & a["cur"].isNotNull()
        return (
            F.when(full, F.struct(F.concat(a["done"], F.array(a["cur"])).alias("done"), w.alias("cur"), F.length(w).alias("n")))
            .otherwise(F.struct(a["done"].alias("done"), F.coalesce(F.concat(a["cur"], F.lit(" "), w), w).alias("cur"), (a["n"] + F.length(w) + 1).alias("n")))
            .cast(_PARTS)
        )

    fold = lambda x: F.aggregate(F.split(x, " ", -1), start, step, lambda a: F.concat(a["done"], F.array(a["cur"])))
    return bound(c, lambda x: F.when(F.length(x) <= longest, F.array(x)).otherwise(fold(x)))


def pack_bytes(c: Column, most: int = 1000) -> Column:
    """Words joined to chunks of at most ``most`` UTF-8 bytes; an overlong word is a chunk by itself."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"), F.lit(0).alias("n")).cast(_PARTS)

    def step(a: Column, w: Column) -> Column:
        joined = F.when(a["cur"] == "", w).otherwise(F.concat(a["cur"], F.lit(" "), w))
        done = F.when(a["cur"] != "", F.concat(a["done"], F.array(a["cur"]))).otherwise(a["done"])
        return (
            F.when(F.octet_length(joined) <= most, F.struct(a["done"].alias("done"), joined.alias("cur"), F.lit(0).alias("n")))
            .otherwise(F.struct(done.alias("done"), w.alias("cur"), F.lit(0).alias("n")))
            .cast(_PARTS)
        )

    return F.aggregate(F.split(c, " ", -1), start, step, lambda a: F.when(a["cur"] != "", F.concat(a["done"], F.array(a["cur"]))).otherwise(a["done"]))


def box_lines(c: Column, width: Column, height: Column, most: int = 1000) -> Column:
    """Box-file lines of a text: one for each chunk, with a space after all but the last."""
    head = F.concat(F.lit("WordStr 0 0 "), width.cast("string"), F.lit(" "), height.cast("string"), F.lit(" 0 #"))
    return bound(pack_bytes(c, most), lambda chunks: F.transform(chunks, lambda x, i: F.concat(head, x, F.when(i < F.size(chunks) - 1, " ").otherwise(""))))


def paragraphs(c: Column) -> Column:
    """Runs of non-blank lines, each line stripped."""
    lines = F.transform(text_lines(c), strip)
    joined = F.regexp_replace(F.array_join(lines, "\n"), r"^\n+|\n+$", "")
    return bound(joined, lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, r"\n{2,}")))


def pack_pages(items: Column, budget: int = 900, joint: str = "\n\n") -> Column:
    """Paragraphs joined to pages of at most ``budget`` characters of text, at least one to a page."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("cur"), F.lit(0).alias("n")).cast(_PARTS)

    def step(a: Column, p: Column) -> Column:
        full = (a["n"] > 0) & (a["n"] + F.length(p) > budget)
        return (
            F.when(full, F.struct(F.concat(a["done"], F.array(a["cur"])).alias("done"), p.alias("cur"), F.length(p).alias("n")))
            .otherwise(F.struct(a["done"].alias("done"), F.coalesce(F.concat(a["cur"], F.lit(joint), p), p).alias("cur"), (a["n"] + F.length(p)).alias("n")))
            .cast(_PARTS)
        )

    return F.aggregate(items, start, step, lambda a: F.when(a["cur"].isNotNull(), F.concat(a["done"], F.array(a["cur"]))).otherwise(a["done"]))


def code_point_label(c: Column) -> Column:
    """``U+0C95`` of a character."""
    return F.concat(F.lit("U+"), F.when(F.ascii(c) > 0xFFFF, F.hex(F.ascii(c))).otherwise(F.lpad(F.hex(F.ascii(c)), 4, "0")))


def characters(c: Column) -> Column:
    """Code points of a text, in order."""
    return F.filter(F.split(c, ""), lambda x: x != "")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[int] = Counter()
    for batch in batches:
        for text in batch.column("text"):
            codes, n = np.unique(np.frombuffer((text.as_py() or "").encode("utf-32-le", "surrogatepass"), "<u4"), return_counts=True)
            total.update(dict(zip(codes.tolist(), n.tolist(), strict=True)))
    yield pa.RecordBatch.from_arrays([pa.array([chr(c) for c in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["ch", "n"])


def character_counts(texts: DataFrame) -> DataFrame:
    """Code points of ``text`` and how often each task met them, ``ch, n``: one row a character and task, to be summed."""
    return texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_counted, "ch string, n long")


def escape_html(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def safe_name(c: Column, longest: int = 80) -> Column:
    """A file name of letters, digits, dot, underscore and hyphen."""
    return F.substring(F.regexp_replace(c, r"[^A-Za-z0-9._-]", "_"), 1, longest)


def valid_id(c: Column) -> Column:
    return c.rlike("^[a-z0-9_]+$")


def style_tag(c: Column) -> Column:
    """The last path part of a style, in lower case, with underscores for blanks and hyphens."""
    return F.regexp_replace(F.lower(F.element_at(F.split(c, "/"), -1)), r"[ -]", "_")


def redact(c: Column, secret: str, shown: str) -> Column:
    """A path that isn't to be shown, replaced."""
    return F.replace(c, F.lit(secret), F.lit(shown))


def clip(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def context_windows(c: Column, middle: str = VIRAMA, profile: ScriptProfile = KANNADA) -> Column:
    """Distinct three-character contexts of ``middle`` between characters of the script."""
    # contexts overlap, so they are looked at, not consumed: one pass over the line
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"(?=([{profile.letters}]{middle}[{profile.letters}]))"), F.lit(1)))
