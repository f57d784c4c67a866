"""Queries over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lipika.functions import metrics as M
from lipika.functions import text as X
from lipika.functions.dictionary import Dictionary
from lipika.functions.profiles import LATIN
from lipika.operators import ordering as O
from lipika.operators import pairs as P
from lipika.operators import split as S
from lipika.plans import sql as Q
from lipika.plans.registry import Tables, query

L = LATIN.letters
PLACE = ("pos.doc_id", "pos.line_no")


def lines(t: Tables) -> DataFrame:
    return O.positions(t.documents.select("doc_id", "lang", "source", "text"), X.text_lines(F.col("text"))).drop("text")


def cleaned(t: Tables) -> DataFrame:
    # cleaned within the generator: a filter on the line then uses it, and doesn't clean again
    clean = F.transform(X.text_lines(F.col("text")), lambda x: X.clean_line(x, LATIN))
    return O.positions(t.documents.select("doc_id", "lang", "source", "text"), clean).drop("text")


def kept(t: Tables) -> DataFrame:
    return cleaned(t).where(X.script_count(F.col("line"), LATIN) >= LATIN.min_letters)


@query(
    f"""WITH {Q.CLEAN}, firsts AS (SELECT line, min(pos) AS pos, arg_min(source, pos) AS source FROM kept GROUP BY line),
a AS (SELECT source, count(*) AS n_lines FROM lines GROUP BY source), b AS (SELECT source, count(*) AS n_kept, sum(length(line)) AS n_chars FROM kept GROUP BY source),
c AS (SELECT source, count(*) AS n_unique, sum({Q.letters("line")}) AS n_letters FROM firsts GROUP BY source)
SELECT a.source, n_lines, coalesce(n_kept, 0) AS n_kept, CAST(coalesce(n_chars, 0) AS BIGINT) AS n_chars, coalesce(n_unique, 0) AS n_unique, CAST(coalesce(n_letters, 0) AS BIGINT) AS n_letters
FROM a LEFT JOIN b USING (source) LEFT JOIN c USING (source)"""
)
def corpus_line_stats(t: Tables) -> DataFrame:
    """Lines, usable lines and first occurrences of each source: the corpus build in one plan."""
    counted = lambda x: X.bound(X.clean_line(x, LATIN), lambda v: F.struct(v.alias("line"), X.script_count(v, LATIN).alias("n")))
    rows = O.positions(t.documents.select("doc_id", "source", "text"), F.transform(X.text_lines(F.col("text")), counted)).select("source", "pos", "line.line", "line.n")
    # counts by line and source, then each line's sources side by side: its array is as long as there are sources;
    # only a line's length and letters are wanted, so 128 bits of digest stand for it
    digest = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2")]
    counts = rows.groupBy(*digest, "source").agg(F.count("*").alias("c"), F.min("pos").alias("pos"), F.max("n").alias("n"), F.max(F.length("line")).alias("size"))
    lines_ = counts.groupBy("h1", "h2").agg(F.max("n").alias("n"), F.max("size").alias("size"), F.collect_list(F.struct("pos", "source", "c")).alias("of"))
    each = lines_.select("size", "n", F.array_min("of")["pos"].alias("first"), F.explode("of").alias("x"))
    good = F.col("n") >= LATIN.min_letters
    first = good & (F.col("x.pos") == F.col("first"))
    total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("long")
    return each.groupBy(F.col("x.source").alias("source")).agg(
        F.sum("x.c").alias("n_lines"), total(F.when(good, F.col("x.c"))).alias("n_kept"), total(F.when(good, F.col("x.c") * F.col("size"))).alias("n_chars"), F.count_if(first).alias("n_unique"), total(F.when(first, F.col("n"))).alias("n_letters")
    )


@query(f"WITH {Q.LINES} SELECT {Q.PLACE}, line FROM lines")
def lines_explode(t: Tables) -> DataFrame:
    return lines(t).select(*PLACE, "line")


@query(f"SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: x <> '')) AS n_nonempty, len(list_filter(string_split(text, chr(10)), lambda x: {Q.strip('x')} <> '')) AS n_nonblank FROM documents")
def line_counts(t: Tables) -> DataFrame:
    rows = F.split("text", "\n", -1)
    return t.documents.select("doc_id", F.size(F.filter(rows, lambda x: x != "")).cast("long").alias("n_nonempty"), F.size(F.filter(rows, lambda x: X.strip(x) != "")).cast("long").alias("n_nonblank"))


@query(f"WITH {Q.CLEAN} SELECT {Q.PLACE}, line FROM clean WHERE line <> ''")
def clean_lines(t: Tables) -> DataFrame:
    return cleaned(t).where("line <> ''").select(*PLACE, "line")


@query(f"WITH {Q.LINES}, s AS (SELECT pos, {Q.strip('line')} AS line FROM lines) SELECT {Q.PLACE}, line, {Q.ratio('line')} AS ratio FROM s WHERE length(line) >= 6 AND {Q.ratio('line')} >= 0.65")
def script_ratio_filter(t: Tables) -> DataFrame:
    rows = lines(t).select("pos", X.strip(F.col("line")).alias("line")).withColumn("ratio", X.script_ratio(F.col("line"), LATIN))
    return rows.where((F.length("line") >= LATIN.min_chars) & (F.col("ratio") >= LATIN.min_ratio)).select(*PLACE, "line", "ratio")


@query(f"WITH {Q.CLEAN} SELECT line, {Q.PLACE} FROM (SELECT line, min(pos) AS pos FROM kept GROUP BY line)")
def dedup_keep_first(t: Tables) -> DataFrame:
    return O.keep_first(kept(t)).select("line", *PLACE)


def _char_counts(t: Tables) -> DataFrame:
    return X.character_counts(t.documents).where(F.col("ch").rlike(f"^[{L}]$")).groupBy("ch").agg(F.sum("n").alias("n"))


_CHARS = f"c AS (SELECT ch, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[{L}]')) AS ch FROM documents) GROUP BY ch)"


@query(f"WITH {_CHARS} SELECT ch, 'U+' || lpad(upper(to_hex(unicode(ch))), 4, '0') AS code, n FROM c")
def char_frequency(t: Tables) -> DataFrame:
    return _char_counts(t).select("ch", X.code_point_label(F.col("ch")).alias("code"), "n")


@query(f"WITH {_CHARS} SELECT ch, n FROM c ORDER BY n DESC, ch LIMIT 15")
def char_top15(t: Tables) -> DataFrame:
    return _char_counts(t).orderBy(F.col("n").desc(), "ch").limit(15)


@query(f"WITH {_CHARS} SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS distinct_chars, round(count(*) * 100.0 / 128, 1) AS coverage FROM c")
def coverage_pct(t: Tables) -> DataFrame:
    return _char_counts(t).agg(F.sum("n").alias("total"), F.count("*").alias("distinct_chars"), F.round(F.count("*") * 100.0 / LATIN.block_size, 1).alias("coverage"))


@query(f"WITH {Q.LINES} SELECT source, count(*) AS n_lines FROM lines WHERE line <> '' GROUP BY source")
def lines_per_source(t: Tables) -> DataFrame:
    return lines(t).where("line <> ''").groupBy("source").agg(F.count("*").alias("n_lines"))


@query(f"WITH {Q.LINES} SELECT lang, source, count(*) AS n_lines, grouping(lang) + grouping(source) AS depth FROM lines WHERE line <> '' GROUP BY ROLLUP (lang, source)")
def lines_per_source_rollup(t: Tables) -> DataFrame:
    return lines(t).where("line <> ''").rollup("lang", "source").agg(F.count("*").alias("n_lines"), (F.grouping("lang") + F.grouping("source")).cast("long").alias("depth"))


_WIKI = [
    (r"[{]{2}(?:[Rr]unning|[Rr])(?:[Hh]eader|[Hh])[^}]*[}]{2}", ""),
    *[(r"[{]{2}[^{}]*[}]{2}", "")] * 4,
    (r"<pb[^/]*/>", ""),
    (r"(?s)<ref[^>/]*>.*?</ref>", ""),
    (r"(?s)<!--.*?-->", ""),
    ("<[^>]+>", " "),
    (r"\[{2}(?:[^\]|]*[|])?([^\]]*)\]{2}", r"\1"),
    (r"\[https{0,1}://[^\s]+(?:\s+[^\]]{1,})?\]", ""),
    ("''{2,3}", ""),
    (r"={2,}[^=]+=+", ""),
    (r"[ \t]+", " "),
]


@query(f"SELECT page_id, {Q.replaced('html', *_WIKI)} AS text FROM pages")
def html_strip(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.strip_wikitext(F.col("html")).alias("text"))


_FIT = "length({0}) >= 6 AND " + Q.ratio("{0}") + " >= 0.65"


@query(
    f"""WITH a AS (SELECT page_id, {Q.replaced("html", *_WIKI)} AS text FROM pages), l AS (SELECT page_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS x FROM (SELECT page_id, {Q.text_lines("text")} AS ls FROM a)),
s AS (SELECT page_id, i, {Q.strip("x")} AS x FROM l), p AS (SELECT page_id, i, generate_subscripts(ps, 1) AS j, unnest(ps) AS x FROM (SELECT page_id, i, string_split_regex(x, '[।॥]') AS ps FROM s WHERE {_FIT.format("x")})),
q AS (SELECT page_id, i, j, {Q.strip("x")} AS x FROM p)
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i, j) - 1 AS n, left(x, 80) AS sentence FROM q WHERE {_FIT.format("x")}"""
)
def html_sentences(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.posexplode(X.wikitext_sentences(F.col("html"), LATIN)).alias("n", "sentence")).withColumn("n", F.col("n").cast("long"))


_NOISE = [("<[^>]+>", ""), ("[।॥०-९]", ""), (r"\([ಀ-೿]\)", ""), (r"\+", ""), ("[''\"ʼ]", "")]


@query(f"WITH {Q.LINES} SELECT {Q.PLACE}, {Q.replaced('replace(line, chr(3302), chr(3202))', *_NOISE)} AS line FROM lines")
def noise_strip(t: Tables) -> DataFrame:
    return lines(t).select(*PLACE, X.strip_noise(F.col("line")).alias("line"))


@query(f"WITH {Q.LINES} SELECT source, count(*) FILTER (regexp_matches(line, '<[^>]+>|[।॥]|[०-९]|\\([ಀ-೿]\\)|\\+|[''\"￼]')) AS n_noisy, count(*) AS n_lines FROM lines GROUP BY source")
def needs_cleaning(t: Tables) -> DataFrame:
    return lines(t).groupBy("source").agg(F.count_if(X.has_noise(F.col("line"))).alias("n_noisy"), F.count("*").alias("n_lines"))


@query(f"WITH {Q.LINES} SELECT {Q.PLACE}, array_to_string(list_filter(string_split(line, ' '), lambda w: NOT regexp_matches(w, '[#*%$&|0-9]')), ' ') AS line FROM lines")
def token_filter(t: Tables) -> DataFrame:
    return lines(t).select(*PLACE, X.filter_tokens(F.col("line"), "#*%$&|0-9").alias("line"))


@query()
def split_at_80(t: Tables) -> DataFrame:
    """Parts of every cleaned line; a fold that SQL has no short form of."""
    rows = cleaned(t).where("line <> ''").select(*PLACE, F.posexplode(X.split_at_boundary(F.col("line"), LATIN.max_chars)).alias("part_no", "part"))
    return rows.where(X.script_count(F.col("part"), LATIN) >= LATIN.min_letters)


@query()
def box_chunks(t: Tables) -> DataFrame:
    """Every document's text in chunks of at most 1,000 UTF-8 bytes."""
    return t.documents.select("doc_id", F.posexplode(X.pack_bytes(F.regexp_replace("text", r"\s+", " "))).alias("chunk_no", "chunk")).withColumn("n_bytes", F.octet_length("chunk"))


UNITS = ["the", "th", "er", "in", "on", "ing", "ion", "ti", *"abcdefghiklmnoprstuvw", *"ABCDEFGHIKLMNOPRSTUVW", *".,!?'"]
_UNIT_SQL = "|".join([*(u if u.isalpha() else f"[{u}]" for u in Dictionary(UNITS).units), "[ ]"]).replace("'", "''")


@query(f"WITH {Q.CLEAN} SELECT source, count(*) FILTER (regexp_replace(line, '({_UNIT_SQL})', '', 'g') = '') AS n_encodable, count(*) AS n_lines FROM kept GROUP BY source")
def encodable_lines(t: Tables) -> DataFrame:
    return kept(t).groupBy("source").agg(F.count_if(Dictionary(UNITS).encodable(F.col("line"))).alias("n_encodable"), F.count("*").alias("n_lines"))


@query(
    f"""WITH {Q.CLEAN}, w AS (SELECT pos, generate_subscripts(ws, 1) - 1 AS i, unnest(ws) AS word FROM (SELECT pos, string_split(line, ' ') AS ws FROM kept)),
f AS (SELECT pos, i, word, length(regexp_extract(word, '^(?:{_UNIT_SQL})*')) AS done FROM w),
g AS (SELECT word[done + 1] AS bad, word, (pos.doc_id, pos.line_no, i) AS place FROM f WHERE done < length(word))
SELECT bad, count(*) AS n_words, arg_min(word, place) AS example FROM g GROUP BY bad"""
)
def unencodable_words(t: Tables) -> DataFrame:
    """The characters at which words first fail, how often, and the first such word."""
    units = Dictionary(UNITS)
    # only words that fail become rows; their order within a line is that of their places
    words = kept(t).select("pos", F.posexplode(units.failing_words(F.col("line"))).alias("i", "word"))
    words = words.select(F.substring("word", units.failure_offset(F.col("word")) + 1, F.lit(1)).alias("bad"), "word", F.struct("pos", "i").alias("at"))
    return words.groupBy("bad").agg(F.count("*").alias("n_words"), F.min_by("word", "at").alias("example"))


def _bigrams(t: Tables) -> DataFrame:
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), F.lit(0))))
    words = t.documents.select(word.alias("w")).distinct()
    return words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring("w", i, F.lit(2)))).alias("bigram")).distinct()


_BIGRAMS = "w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{2,}')) AS w FROM documents), b AS (SELECT DISTINCT unnest(list_transform(range(1, length(w)), lambda i: w[i:i + 1])) AS bigram FROM w), e AS (SELECT x || y AS bigram FROM (SELECT unnest(string_split('abcdefghijklmnopqrstuvwxyz', '')) AS x), (SELECT unnest(string_split('abcdefghijklmnopqrstuvwxyz', '')) AS y))"


def _grid(t: Tables) -> DataFrame:
    letters = t.spark.createDataFrame([(c,) for c in "abcdefghijklmnopqrstuvwxyz"], "x string")
    return letters.crossJoin(F.broadcast(letters.withColumnRenamed("x", "y"))).select(F.concat("x", "y").alias("bigram"))  # 26 by 26


@query(f"WITH {_BIGRAMS} SELECT bigram FROM b")
def bigram_attested(t: Tables) -> DataFrame:
    return _bigrams(t)


@query(f"WITH {_BIGRAMS} SELECT bigram FROM e EXCEPT SELECT bigram FROM b")
def enumerate_minus_attested(t: Tables) -> DataFrame:
    return P.attested_minus(_grid(t), _bigrams(t), "bigram")


@query(f"WITH {_BIGRAMS} SELECT bigram FROM e WHERE bigram IN (SELECT bigram FROM b) OR bigram[1] = bigram[2]")
def enumerate_intersect(t: Tables) -> DataFrame:
    """Attested pairs, and doubled letters whether attested or not."""
    return P.attested_only(_grid(t), _bigrams(t), "bigram", F.substring("bigram", 1, 1) == F.substring("bigram", 2, 1))


@query("WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-z]+')) AS word FROM documents), k AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-z]+')) AS word FROM benchmark) SELECT k.word, w.word IS NOT NULL AS known FROM k LEFT JOIN w USING (word)")
def new_words(t: Tables) -> DataFrame:
    """The benchmark's words, and whether the corpus has them."""
    words = lambda d: d.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[a-z]+"), F.lit(0)))).alias("word"))
    return P.new_and_known(words(t.benchmark).withColumn("pos", F.lit(0)), words(t.documents).distinct(), "word", "pos").select("word", "known")


@query("SELECT doc_id, quality, toxic, n_chars FROM documents JOIN labels USING (doc_id)")
def doc_label_pairs(t: Tables) -> DataFrame:
    return P.stem_pairs(t.documents.select("doc_id", "n_chars"), t.labels, "doc_id").select("doc_id", "quality", "toxic", "n_chars")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def docs_without_label(t: Tables) -> DataFrame:
    return P.without_truth(t.documents.select("doc_id", "source"), t.labels, "doc_id")


@query("SELECT source, count(*) AS n_docs, count(l.doc_id) AS n_labelled, coalesce(avg(l.quality), -1) AS mean_quality FROM documents d LEFT JOIN (SELECT DISTINCT doc_id, quality FROM labels) l USING (doc_id) GROUP BY source")
def label_flags(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "quality").distinct(), "doc_id", "left")
    return rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.count("quality").alias("n_labelled"), F.coalesce(F.avg("quality"), F.lit(-1.0)).alias("mean_quality"))


@query("SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY md5(text)")
def superseded_anti(t: Tables) -> DataFrame:
    """Documents that no earlier one supersedes by the same text; digests are shuffled, not texts."""
    return t.documents.groupBy(F.md5("text").alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n_copies")).drop("h")


PREFIXES = ["https://blog.", "https://", "http://m.", "http://tion", "ftp://"]


@query("SELECT page_id, url FROM pages WHERE " + " OR ".join(f"starts_with(url, '{p}')" for p in PREFIXES[2:]))
def prefix_semi(t: Tables) -> DataFrame:
    return P.prefix_semi(t.pages.select("page_id", "url"), "url", PREFIXES[2:])


@query("SELECT CASE " + " ".join(f"WHEN starts_with(url, '{p}') THEN '{p}'" for p in PREFIXES) + " END AS prefix, count(*) AS n_pages FROM pages GROUP BY 1")
def prefix_first_match(t: Tables) -> DataFrame:
    return t.pages.groupBy(P.prefix_first_match("url", PREFIXES).alias("prefix")).agg(F.count("*").alias("n_pages"))


@query(
    """WITH n AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM conversations WHERE role IN ('user', 'assistant')),
c AS (SELECT conv_id FROM n GROUP BY conv_id HAVING count(*) FILTER (role = 'user') = count(*) FILTER (role = 'assistant'))
SELECT u.conv_id, u.n, u.text AS question, a.text AS answer FROM n u JOIN n a ON u.conv_id = a.conv_id AND u.n = a.n WHERE u.role = 'user' AND a.role = 'assistant' AND u.conv_id IN (SELECT conv_id FROM c)"""
)
def turn_zip(t: Tables) -> DataFrame:
    """Questions and answers place by place, of conversations that have as many of either."""
    n = F.row_number().over(W.partitionBy("conv_id", "role").orderBy("turn")).cast("long")
    turns = t.conversations.where(F.col("role").isin("user", "assistant")).withColumn("n", n)
    side = lambda role, name: turns.where(F.col("role") == role).select("conv_id", "n", F.col("text").alias(name))
    return P.positional_zip(side("user", "question"), side("assistant", "answer"), "conv_id")[0].select("conv_id", "n", "question", "answer")


@query(
    """WITH k AS (SELECT DISTINCT lang, source FROM documents), r AS (SELECT lang, source, count(*) OVER (PARTITION BY lang) AS n, row_number() OVER (PARTITION BY lang ORDER BY md5('20260805/' || lang || '/' || source), source) AS r FROM k)
SELECT doc_id, d.lang, d.source, CASE WHEN n > 1 AND r <= greatest(1, CAST(round_even(n * (1 - CAST(0.9 AS DOUBLE)), 0) AS INTEGER)) THEN 'eval' ELSE 'train' END AS split FROM documents d JOIN r USING (lang, source)"""
)
def group_split(t: Tables) -> DataFrame:
    return S.group_split(t.documents.select("doc_id", "lang", "source"), "lang", "source")


@query(
    """WITH k AS (SELECT DISTINCT lang, source FROM documents), r AS (SELECT lang, source, count(*) OVER (PARTITION BY lang) AS n, row_number() OVER (PARTITION BY lang ORDER BY md5('20260805/' || lang || '/' || source), source) AS r FROM k),
s AS (SELECT d.lang, d.source, CASE WHEN n > 1 AND r <= greatest(1, CAST(round_even(n * (1 - CAST(0.9 AS DOUBLE)), 0) AS INTEGER)) THEN 'eval' ELSE 'train' END AS split, count(*) AS c FROM documents d JOIN r USING (lang, source) GROUP BY ALL)
SELECT coalesce(lang, 'TOTAL') AS lang, count(*) AS n_groups, count(*) FILTER (split = 'train') AS train_groups, count(*) FILTER (split = 'eval') AS eval_groups, CAST(coalesce(sum(c) FILTER (split = 'train'), 0) AS BIGINT) AS train_rows, CAST(coalesce(sum(c) FILTER (split = 'eval'), 0) AS BIGINT) AS eval_rows
FROM s GROUP BY ROLLUP (lang)"""
)
def group_split_summary(t: Tables) -> DataFrame:
    return S.split_summary(S.group_split(t.documents.select("doc_id", "lang", "source"), "lang", "source"), "lang", "source")


_FROM, _TO = "àâäáãåçéèêëîïíìôöóòõùûüúñýÀÂÄÁÃÅÇÉÈÊËÎÏÍÌÔÖÓÒÕÙÛÜÚÑÝ", "aaaaaaceeeeiiiiooooouuuunyAAAAAACEEEEIIIIOOOOOUUUUNY"


def _titles(t: Tables) -> DataFrame:
    """The heading of each page as reference and its title, which is often cut, as what was found; accents folded."""
    part = lambda tag: F.regexp_extract("html", rf"(?s)<{tag}>(.*?)</{tag}>", 1)
    fold = lambda c: F.regexp_replace(F.translate(c, _FROM, _TO), r"[^\x00-\x7f]", "?")
    return t.pages.select("page_id", F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"), fold(part("h1")).alias("truth"), fold(part("title")).alias("found"))


def _fold(x: str) -> str:
    return f"regexp_replace(translate(regexp_extract(html, '(?s)<{x}>(.*?)</{x}>', 1), '{_FROM}', '{_TO}'), '[^\\x00-\\x7f]', '?', 'g')"


_TITLES = f"""t AS (SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang, {_fold("h1")} AS truth, {_fold("title")} AS found FROM pages),
c AS (SELECT page_id, lang, CASE WHEN replace(truth, ' ', '') = '' THEN 0.0 ELSE least(CAST(levenshtein(replace(truth, ' ', ''), replace(found, ' ', '')) AS DOUBLE) / length(replace(truth, ' ', '')), 1.0) END AS cer FROM t)"""


@query(f"WITH {_TITLES} SELECT page_id, lang, cer FROM c")
def cer_titles(t: Tables) -> DataFrame:
    return _titles(t).select("page_id", "lang", M.cer(F.col("truth"), F.col("found")).alias("cer"))


@query(
    f"""WITH {_TITLES} SELECT page_id,
  CASE WHEN {Q.strip(Q.replaced("truth", (Q.SPACE + "+", " ")))} = '' THEN 0.0 ELSE least(CAST(levenshtein({Q.strip(Q.replaced("truth", (Q.SPACE + "+", " ")))}, {Q.strip(Q.replaced("found", (Q.SPACE + "+", " ")))}) AS DOUBLE) / length({Q.strip(Q.replaced("truth", (Q.SPACE + "+", " ")))}), 1.0) END AS cer_review FROM t"""
)
def cer_review_titles(t: Tables) -> DataFrame:
    return _titles(t).select("page_id", M.cer_review(F.col("truth"), F.col("found")).alias("cer_review"))


@query()
def wer_titles(t: Tables) -> DataFrame:
    """Word error rates and per-cent character error rates; the word distance has no SQL function."""
    return _titles(t).select("page_id", M.wer(F.col("truth"), F.col("found")).alias("wer"), M.cer_percent(F.col("truth"), F.col("found")).alias("cer_percent"))


@query(f"WITH {_TITLES} SELECT lang, count(*) AS n, round(avg(cer), 9) AS mean_cer FROM c GROUP BY lang")
def cer_mean_by_lang(t: Tables) -> DataFrame:
    return _titles(t).select("lang", M.cer(F.col("truth"), F.col("found")).alias("cer")).groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg("cer"), 9).alias("mean_cer"))


@query(f"WITH {_TITLES} SELECT CASE WHEN cer < 0.10 THEN 'good' WHEN cer < 0.35 THEN 'ok' ELSE 'bad' END AS class, count(*) AS n FROM c GROUP BY 1")
def cer_classes(t: Tables) -> DataFrame:
    return _titles(t).groupBy(M.error_class(M.cer(F.col("truth"), F.col("found"))).alias("class")).agg(F.count("*").alias("n"))


@query()
def confusion_top(t: Tables) -> DataFrame:
    """The 40 most frequent confusions of each language (a top-k report), by block alignment: headings against their folded form."""
    part = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    rows = t.pages.select(F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"), part.alias("truth"), F.translate(part, _FROM, _TO).alias("found"))
    ops = rows.withColumn("ops", M.align_ops("truth", "found"))
    pairs = ops.select("lang", F.explode(M.confusions(F.col("truth"), F.col("found"), F.col("ops"))).alias("p")).groupBy("lang", "p.truth_char", "p.found_char").agg(F.count("*").alias("n"))
    w = W.partitionBy("lang").orderBy(F.col("n").desc(), "truth_char", "found_char")
    ranked = pairs.withColumn("rank", F.row_number().over(w)).where("rank <= 40")
    return ranked.withColumn("bar", F.round(F.col("n") / F.max("n").over(W.partitionBy("lang")), 3))


@query(
    """WITH r AS (SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS r, greatest(1, count(*) OVER () // 100) AS step FROM documents) SELECT doc_id, source FROM r WHERE r % step = 0 AND r < 100 * step"""
)
def systematic_sample(t: Tables) -> DataFrame:
    return O.systematic_sample(t.documents.select("doc_id", "source"), "doc_id", 100)


@query("WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM documents) SELECT doc_id, source FROM r WHERE r = n // 2")
def middle_per_group(t: Tables) -> DataFrame:
    return O.middle_per_group(t.documents.select("doc_id", "source"), "source", "doc_id")


@query(
    """WITH g AS (SELECT lang, source, row_number() OVER (PARTITION BY lang ORDER BY source) AS g FROM (SELECT DISTINCT lang, source FROM documents)),
r AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS r FROM documents) SELECT doc_id, lang, source FROM r JOIN g USING (lang, source) WHERE r <= 40 AND g <= 2"""
)
def head_per_group(t: Tables) -> DataFrame:
    return O.head_per_group(t.documents.select("doc_id", "lang", "source"), ["lang", "source"], "doc_id", 40, 2)


@query(f"WITH {Q.LINES} SELECT {Q.PLACE}, line, (SELECT count(*) FROM lines) AS total FROM lines ORDER BY pos DESC LIMIT 100")
def last_lines(t: Tables) -> DataFrame:
    return O.last_lines(lines(t).select("pos", "line"), 100).select(*PLACE, "line", "total")


@query(
    """WITH s AS (SELECT doc_id, n_chars FROM documents ORDER BY md5('queue/' || doc_id), doc_id LIMIT 500),
q AS (SELECT doc_id, n_chars % 101 AS error, coalesce(CAST(l.quality AS DOUBLE) * 50, 100.0) AS confidence FROM s LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id))
SELECT doc_id, error, confidence FROM q ORDER BY error DESC, confidence, doc_id LIMIT 50"""
)
def review_queue(t: Tables) -> DataFrame:
    """A seeded sample, and of it the worst: by error, then by confidence, unknown as 100."""
    sample = O.hash_sample(t.documents.select("doc_id", "n_chars"), "queue", "doc_id", 500)
    rows = sample.join(t.labels.groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id", "left")
    rows = rows.select("doc_id", (F.col("n_chars") % 101).alias("error"), F.coalesce(F.col("quality") * 50.0, F.lit(100.0)).alias("confidence"))
    return rows.orderBy(F.col("error").desc(), "confidence", "doc_id").limit(50)


@query()
def page_pack(t: Tables) -> DataFrame:
    """A conversation's turns packed to pages of at most 900 characters."""
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    return t.conversations.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", F.posexplode(X.pack_pages(F.col("turns"))).alias("page_no", "page"))


@query("SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS html, left(text, 120) AS preview FROM documents")
def escaped_previews(t: Tables) -> DataFrame:
    """Texts as HTML, with the clipped previews of a report."""
    return t.documents.select("doc_id", X.escape_html(F.col("text")).alias("html"), X.clip(F.col("text"), 120).alias("preview"))


@query("WITH c AS (SELECT source AS directory, count(*) AS n_files FROM documents GROUP BY source) SELECT directory, n_files, directory = (SELECT min(directory) FROM c WHERE n_files = (SELECT max(n_files) FROM c)) AS is_largest FROM c")
def largest_source(t: Tables) -> DataFrame:
    from lipika.operators.checkpoints import most_files

    return most_files(t.documents.select(F.col("source").alias("directory")), "directory")


@query(
    f"""WITH {Q.LINES}, r AS (SELECT doc_id, generate_subscripts(w, 1) - 1 AS n, unnest(w) AS word FROM (SELECT doc_id, string_split(replace(text, chr(10), ' '), ' ') AS w FROM documents))
SELECT word, min(doc_id) AS doc_id, CAST(arg_min(n, (doc_id, n)) AS BIGINT) AS word_no, count(*) AS n_words FROM r WHERE regexp_matches(word, '^[{L}]+$') GROUP BY word"""
)
def word_list(t: Tables) -> DataFrame:
    """Words of script characters alone, each once at its first place."""
    words = t.documents.select("doc_id", F.posexplode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ", -1)).alias("n", "word")).where(X.script_only(F.col("word"), LATIN))
    first = words.groupBy("word").agg(F.min(F.struct("doc_id", F.col("n").cast("long").alias("word_no"))).alias("at"), F.count("*").alias("n_words"))
    return first.select("word", "at.doc_id", "at.word_no", "n_words")
