"""Queries of operators whose inputs the tables don't hold as such: their rows are derived from the tables, in Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lipika.functions import metrics as M
from lipika.functions import text as X
from lipika.functions.profiles import KANNADA, LATIN
from lipika.operators import checkpoints as C
from lipika.operators import generators as G
from lipika.operators import ordering as O
from lipika.operators import pairs as P
from lipika.operators import split as S
from lipika.operators import status as T
from lipika.plans import sql as Q
from lipika.plans.corpus import _TITLES, _titles, lines
from lipika.plans.registry import Tables, query
from lipika.sources import readers as R

K, V, Z = KANNADA.letters, X.VIRAMA, X.ZWNJ
#: Letters of the documents as letters of another script, with its virama and signs.
_LATIN, _SCRIPT = "etaoinshrdlu", "ಕ್ತಾಮನಿ್ಲರಸವ"
_SCRIPT_LINES = f"{Q.LINES}, kn AS (SELECT pos, translate(line, '{_LATIN}', '{_SCRIPT}') AS line FROM lines)"


def _script_lines(t: Tables) -> DataFrame:
    return lines(t).select("pos", F.translate("line", _LATIN, _SCRIPT).alias("line"))


PLACE = ("pos.doc_id", "pos.line_no")

# cleaning

_VERSE = f"{Q.strip('x')}"
_VERSE_SQL = Q.replaced(_VERSE, (rf"[।|][।|]{Q.SPACE[:-1]}0-9०-९೦-೯]+[।|][।|]{Q.SPACE}*$", ""), (f"{Q.SPACE}+$", ""), ("[ \t]+", " "))


@query(f"WITH {Q.LINES}, v AS (SELECT pos, line || CASE WHEN pos.line_no % 2 = 0 THEN ' ।। ೧೨ ।। ' ELSE '|| 7  ||' END AS x FROM lines), w AS (SELECT pos, {_VERSE_SQL} AS line FROM v) SELECT {Q.PLACE}, CASE WHEN length(line) >= 4 AND {Q.ratio('line')} >= 0.35 THEN line END AS line FROM w")
def verse_lines(t: Tables) -> DataFrame:
    """Lines that end in a verse number, without it."""
    line = F.concat("line", F.when(F.col("pos.line_no") % 2 == 0, " ।। ೧೨ ।। ").otherwise("|| 7  ||"))
    return lines(t).select(*PLACE, X.verse_line(line, LATIN).alias("line"))


def _closed(x: str) -> str:
    return f"regexp_replace(replace({x}, '{V}', '{V}{Z}'), '{V}{Z}([ಕ-ಹೞೠೡ{Z}])', '{V}\\1', 'g')"


@query(f"WITH {_SCRIPT_LINES} SELECT {Q.PLACE}, {_closed('line')} AS line FROM kn")
def closed_viramas(t: Tables) -> DataFrame:
    """Viramas that no consonant follows, closed by a non-joiner."""
    return _script_lines(t).select(*PLACE, X.wordfinal_virama(F.col("line")).alias("line"))


_NOISE = [("<[^>]+>", ""), ("[।॥०-९]", ""), (r"\([ಀ-೿]\)", ""), (r"\+", ""), ("[''\"ʼ]", "")]


def _noise(x: str) -> str:
    return Q.replaced(f"replace({x}, chr(3302), chr(3202))", *_NOISE)


@query(f"WITH {_SCRIPT_LINES} SELECT {Q.PLACE}, {Q.strip(Q.replaced(_closed(Q.replaced(_noise('line'), ('[|]', ''), ('[a-zA-Z]', ''))), (Q.SPACE + '+', ' ')))} AS line FROM kn")
def ground_truth_lines(t: Tables) -> DataFrame:
    return _script_lines(t).select(*PLACE, X.clean_ground_truth(F.col("line")).alias("line"))


@query(f"SELECT doc_id, {Q.strip(Q.replaced(_noise(Q.strip('text')), ('[ \t]+', ' ')))} || chr(10) AS page FROM documents")
def noise_strip_pages(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.strip_noise_page(F.col("text")).alias("page"))


@query(
    f"""WITH d AS (SELECT doc_id, {Q.text_lines("text")} AS a, {Q.text_lines("regexp_replace(text, '[0-9]', '', 'g')")} AS b FROM documents), e AS (SELECT doc_id, a, b, list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i])[1] AS i FROM d)
SELECT doc_id, CAST(i AS INTEGER) AS line, left(a[i], 100) AS before, left(b[i], 100) AS after FROM e WHERE i IS NOT NULL"""
)
def first_differences(t: Tables) -> DataFrame:
    """The first line of each document that loses digits."""
    found = X.first_difference(F.col("text"), F.regexp_replace("text", "[0-9]", ""))
    return t.documents.select("doc_id", found.alias("d")).where("d is not null").select("doc_id", "d.line", "d.before", "d.after")


@query(f"WITH {_SCRIPT_LINES}, c AS (SELECT pos, list_distinct(list_filter(list_transform(range(1, length(line) - 1), lambda i: line[i:i + 2]), lambda x: regexp_matches(x, '^[{K}]{V}[{K}]$'))) AS cs FROM kn) SELECT context, count(*) AS n FROM (SELECT unnest(cs) AS context FROM c) GROUP BY context")
def virama_contexts(t: Tables) -> DataFrame:
    """What stands around viramas, and in how many lines."""
    return _script_lines(t).select(F.explode(X.context_windows(F.col("line"))).alias("context")).groupBy("context").agg(F.count("*").alias("n"))


_KNOWN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ.,!? "


@query(f"WITH {Q.LINES} SELECT {Q.PLACE}, array_to_string(list_sort(list_distinct(list_filter(string_split(line, ''), lambda x: NOT contains('{_KNOWN}', x) AND x <> chr(9)))), '') AS offending FROM lines WHERE line <> ''")
def offending_characters(t: Tables) -> DataFrame:
    from lipika.functions.dictionary import Dictionary

    return lines(t).where("line <> ''").select(*PLACE, Dictionary([*_KNOWN.strip()]).offending(F.col("line")).alias("offending"))


@query("SELECT page_id, left(regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g'), 80) AS file, regexp_matches(url, '^[a-z0-9_]+$') AS valid, replace(url, 'https://', '<...>/') AS shown FROM pages")
def safe_names(t: Tables) -> DataFrame:
    url = F.col("url")
    return t.pages.select("page_id", X.safe_name(url).alias("file"), X.valid_id(url).alias("valid"), X.redact(url, "https://", "<...>/").alias("shown"))


@query("SELECT p_partkey, replace(replace(lower(p_type || ' Semi-Bold'), ' ', '_'), '-', '_') AS tag FROM part")
def style_tags(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.style_tag(F.concat(F.lit("Serif/"), "p_type", F.lit(" Semi-Bold"))).alias("tag"))


# paths, pairs and lists

_KIND = "CASE doc_id % 4 WHEN 0 THEN 'classical' WHEN 1 THEN 'inventory' WHEN 2 THEN 'rendered' ELSE 'odd' END"
_PATHS = f"l AS (SELECT doc_id, {_KIND} AS kind, CASE doc_id % 4 WHEN 2 THEN 'a_' || source || '.lstmf' WHEN 3 THEN 'x' || doc_id ELSE source || '/page' || doc_id % 50 || '_line' || doc_id || '.lstmf' END AS rest FROM documents)"


def _paths(t: Tables) -> DataFrame:
    kind = F.expr(_KIND)
    rest = F.expr("CASE doc_id % 4 WHEN 2 THEN concat('a_', source, '.lstmf') WHEN 3 THEN concat('x', doc_id) ELSE concat(source, '/page', doc_id % 50, '_line', doc_id, '.lstmf') END")
    return t.documents.select("doc_id", F.concat(F.lit("/work/lstmf/"), kind, F.lit("/"), rest).alias("path"))


@query(
    f"""WITH {_PATHS} SELECT doc_id, kind, CASE kind WHEN 'classical' THEN split_part(rest, '/', 1) || '/' || regexp_extract(split_part(rest, '/', 2), '^page[0-9]+')
  WHEN 'inventory' THEN split_part(rest, '/', 1) || '/' || regexp_replace(split_part(rest, '/', 2), '\\.[^.]*$', '') ELSE rest END AS "group", CASE WHEN kind IN ('classical', 'rendered') THEN kind ELSE 'other' END AS bucket FROM l"""
)
def path_groups(t: Tables) -> DataFrame:
    kind, group = S.group_of(F.col("path"))
    return _paths(t).select("doc_id", kind.alias("kind"), group.alias("group"), S.bucket_of(F.col("path"), ["classical", "rendered"]).alias("bucket"))


@query(f"WITH {_PATHS} SELECT doc_id FROM l WHERE kind = 'inventory' OR regexp_matches(rest, 'page1_|page2[0-9]_')")
def focused_list(t: Tables) -> DataFrame:
    return T.focused(_paths(t), "path", ["page1_", "page2[0-9]_"], "/inventory/").select("doc_id")


_STEM = "'p' || CAST(floor(doc_id / 4) AS BIGINT) || CASE WHEN doc_id % 4 = 0 THEN '' WHEN CAST(floor(doc_id / 4) AS BIGINT) % 2 = 0 THEN '_line' || doc_id % 4 ELSE '_x' || doc_id % 4 END"


@query(f"WITH s AS (SELECT doc_id, {_STEM} AS stem FROM documents) SELECT doc_id, stem FROM s WHERE stem NOT IN (SELECT regexp_extract(stem, '^(.+)_line[0-9]+$', 1) FROM s)")
def not_superseded_pages(t: Tables) -> DataFrame:
    """Page samples without those of which line samples exist."""
    return P.not_superseded(t.documents.select("doc_id", F.expr(_STEM).alias("stem")))


@query("SELECT doc_id FROM labels WHERE doc_id IN (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0)")
def listed_and_there(t: Tables) -> DataFrame:
    return P.exists_semi(t.labels.select("doc_id"), t.documents.where("doc_id % 3 <> 0"), "doc_id")


@query("SELECT o_custkey AS k, arg_min(o_orderkey, (o_orderpriority, o_orderkey)) AS path FROM orders GROUP BY o_custkey")
def first_by_priority(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("path"), F.struct("o_orderpriority", "o_orderkey").alias("priority"))
    return P.first_existing(rows, "k", "path", "priority")


@query("SELECT arg_min(o_orderkey, (o_orderpriority, o_orderkey)) AS path FROM orders WHERE o_orderstatus = 'F'")
def resume_pick(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_orderkey").alias("path"), F.struct("o_orderpriority", "o_orderkey").alias("priority"), (F.col("o_orderstatus") == "F").alias("there"))
    return C.resume_choice(rows, "path", "priority", "there")


@query("SELECT arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS path FROM orders")
def latest_file(t: Tables) -> DataFrame:
    return C.latest(t.orders.select(F.col("o_orderkey").alias("path"), "o_orderdate"), "path", "o_orderdate")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def latest_corrections(t: Tables) -> DataFrame:
    return P.latest_versions(t.orders.select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")


@query("SELECT d.doc_id, l.n, l.total FROM documents d LEFT JOIN (SELECT CAST(o_custkey AS BIGINT) AS doc_id, arg_max(o_orderstatus, o_orderkey) AS n, arg_max(o_totalprice, o_orderkey) AS total FROM orders GROUP BY 1) l USING (doc_id)")
def last_truth_of_each(t: Tables) -> DataFrame:
    """Entries with the last of what is found under their key."""
    found = t.orders.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("at"), F.col("o_orderstatus").alias("n"), F.col("o_totalprice").alias("total"))
    return T.last_wins(t.documents.select("doc_id"), found, "doc_id", "at")


@query("SELECT page_id, ends_with(u, '.git') OR starts_with(u, 'git@') OR regexp_matches(u, 'github\\.com|gitlab\\.com|bitbucket\\.org|codeberg\\.org') AS clonable FROM (SELECT page_id, lower(CASE page_id % 3 WHEN 0 THEN url || '.git' WHEN 1 THEN 'git@' || url ELSE url END) AS u FROM pages)")
def clonable_urls(t: Tables) -> DataFrame:
    url = F.expr("CASE page_id % 3 WHEN 0 THEN concat(url, '.git') WHEN 1 THEN concat('git@', url) ELSE url END")
    return t.pages.select("page_id", T.clonable(url).alias("clonable"))


# samples, guards and geometry


@query("SELECT l_orderkey, l_linenumber, p_size < 0.7 * l_quantity OR p_size < 16 OR l_quantity < 8 AS cut, CASE WHEN p_size < 16 THEN 'low' WHEN l_quantity * 2 < 40 THEN 'narrow' WHEN l_discount < 0.001 THEN 'blank' END AS scan FROM lineitem JOIN part ON p_partkey = l_partkey")
def fold_and_scan_guards(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    q, h = F.col("l_quantity"), F.col("p_size")
    return rows.select("l_orderkey", "l_linenumber", P.cut_by_fold(q, q, h).alias("cut"), T.scan_guard(q * 2, h, F.col("l_discount")).alias("scan"))


@query(
    """WITH r AS (SELECT l_orderkey AS page, l_linenumber AS n, CASE WHEN l_quantity < 10 THEN 'low' WHEN l_discount < 0.02 THEN 'blank' END AS why, left(l_returnflag || l_linestatus, 60) AS snippet FROM lineitem)
SELECT page, count(*) FILTER (why IS NULL) AS kept, coalesce(string_agg(n || ':' || why || ':' || snippet, ',' ORDER BY n, why, snippet) FILTER (why IS NOT NULL), '') AS rejected FROM r GROUP BY page"""
)
def page_rejects(t: Tables) -> DataFrame:
    reason = P.first_reason([(F.col("l_quantity") < 10, "low"), (F.col("l_discount") < 0.02, "blank")])
    rows = t.lineitem.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("n"), reason.alias("reason"), F.concat("l_returnflag", "l_linestatus").alias("text"))
    found = P.rejects_per_page(rows, "page", "n", "reason", "text")
    return found.select("page", "kept", F.array_join(F.transform("rejected", lambda r: F.concat_ws(":", r["n"], r["why"], r["snippet"])), ",").alias("rejected"))


@query("SELECT l_orderkey AS page, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey % 2, l_suppkey % 3, l_linenumber) - 1 AS n FROM lineitem")
def reading_order(t: Tables) -> DataFrame:
    boxes = t.lineitem.select(F.col("l_orderkey").alias("page"), (F.col("l_partkey") % 2).alias("block"), (F.col("l_suppkey") % 3).alias("par"), F.col("l_linenumber").alias("line"))
    return O.reading_order(boxes).select("page", F.col("line").alias("l_linenumber"), F.col("n").cast("long").alias("n"))


@query("SELECT l_orderkey AS page, CAST(l_linenumber AS INTEGER) AS line, CAST(l_quantity AS INTEGER) AS w FROM lineitem WHERE l_linenumber % 2 = 0")
def layout_words(t: Tables) -> DataFrame:
    """Lines of a layout in tab-separated columns, among rows of other levels and rows that don't parse."""
    level = F.when(F.col("l_linenumber") % 2 == 0, "4").otherwise(F.when(F.col("l_partkey") % 2 == 0, "5").otherwise("level"))
    fields = [level, F.lit(1), F.lit(2), F.lit(3), F.col("l_linenumber"), F.lit(0), F.lit(5), F.lit(6), F.col("l_quantity").cast("int"), F.lit(8), F.lit("-1"), F.lit("")]
    rows = t.lineitem.select(F.col("l_orderkey").alias("page"), F.array_join(F.array(*[f.cast("string") for f in fields]), "\t").alias("line"))
    return R.layout_words(rows).select("page", "line", "w")


@query("SELECT l_orderkey AS page, round(coalesce(avg(l_quantity) FILTER (l_linenumber % 3 > 0), 0), 6) AS confidence FROM lineitem GROUP BY 1")
def word_confidence(t: Tables) -> DataFrame:
    word = F.when(F.col("l_linenumber") % 3 > 0, "word").otherwise(" ")
    fields = [*[F.lit(5)] * 10, F.col("l_quantity"), word]
    rows = t.lineitem.select(F.col("l_orderkey").alias("page"), F.array_join(F.array(*[f.cast("string") for f in fields]), "\t").alias("line"))
    return R.word_confidence(rows).withColumn("confidence", F.round("confidence", 6))


@query("SELECT o_orderkey AS iter, o_custkey AS samples, CAST(o_orderkey % 100 AS DOUBLE) / 10 AS bcer FROM orders WHERE o_orderkey % 5 > 0")
def checkpoint_names(t: Tables) -> DataFrame:
    name = F.expr("concat('/ckpt/kan', CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE '' END, '_', o_orderkey % 100 div 10, '.', o_orderkey % 10, '_', o_custkey, '_', o_orderkey, '.checkpoint')")
    return R.checkpoint_files(t.orders.select(name.alias("file")), "kan").select("iter", "samples", "bcer")


@query("SELECT event_id, event_id * 100 AS iter, user_id AS samples, CAST(event_id % 100 AS DOUBLE) / 10 AS bcer FROM events WHERE event_type <> 'view'")
def log_progress(t: Tables) -> DataFrame:
    """Progress out of log lines, others left out."""
    line = F.expr("CASE WHEN event_type = 'view' THEN 'Encoding of string failed' ELSE concat('At iteration ', event_id * 100, '/', user_id, '/', event_id, ', mean rms=1%, BCER train=', event_id % 100 div 10, '.', event_id % 10, '%, skip') END")
    return t.events.select("event_id", R.training_progress(line).alias("p")).where("p is not null").select("event_id", "p.iter", "p.samples", "p.bcer")


@query("SELECT p_name || CASE WHEN p_partkey % 3 = 0 AND both_ THEN '-otf' WHEN both_ THEN '-ttf' ELSE '' END AS variant, CASE WHEN p_partkey % 3 = 0 THEN 'otf' ELSE 'ttf' END AS format, count(*) AS n FROM (SELECT *, min(p_partkey % 3 = 0) OVER w <> max(p_partkey % 3 = 0) OVER w AS both_ FROM part WINDOW w AS (PARTITION BY p_name)) GROUP BY ALL")
def font_variants(t: Tables) -> DataFrame:
    """Stems that have both formats are two variants; with their files."""
    ending = F.when(F.col("p_partkey") % 3 == 0, ".otf").otherwise(".TTF")
    files = t.part.select(F.concat(F.lit("/f/"), "p_partkey", F.lit("/"), "p_name", ending).alias("file"))
    variants = R.font_variants(files).select("variant", "stem", "format")
    each = files.select(F.regexp_extract("file", r"([^/]*)\.[A-Za-z]+$", 1).alias("stem"), F.lower(F.regexp_extract("file", r"\.([A-Za-z]+)$", 1)).alias("format"))
    return each.join(variants, ["stem", "format"]).groupBy("variant", "format").agg(F.count("*").alias("n"))


@query("SELECT event_type AS category, coalesce(round(avg(value) FILTER (value > 1000000), 6), -1) AS mean FROM events GROUP BY event_type")
def mean_with_default(t: Tables) -> DataFrame:
    rows = t.events.withColumn("value", F.when(F.col("value") > 1_000_000, F.col("value")))
    return rows.groupBy(F.col("event_type").alias("category")).agg(F.round(C.mean_or("value", -1.0), 6).alias("mean"))


@query("SELECT 'rolling' AS file, 'fallback' AS tier FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey BETWEEN 1 AND 2 AND o_orderkey > 2) WHERE n = 0")
def best_fallback(t: Tables) -> DataFrame:
    """No checkpoint under the widened cap: the rolling one."""
    runs = t.orders.where("o_orderkey > 2").select(F.col("o_orderkey").alias("iter"), F.col("o_totalprice").alias("bcer"), F.concat(F.lit("ckpt_"), "o_orderkey").alias("file"))
    return C.best_capped(runs, "bcer", "iter", "file", 1, "rolling")


# reports

_MODELS = ["title", "plain", "cut"]
_FOUND = "CASE m WHEN 'title' THEN found WHEN 'plain' THEN replace(found, 'e', '') ELSE left(found, 5) END"
_SCORES = f"{_TITLES}, m AS (SELECT page_id, lang, truth, m, {_FOUND} AS f FROM t, (SELECT unnest(['title', 'plain', 'cut']) AS m)), s AS (SELECT page_id, lang, m, CASE WHEN replace(truth, ' ', '') = '' THEN 0.0 ELSE least(CAST(levenshtein(replace(truth, ' ', ''), replace(f, ' ', '')) AS DOUBLE) / length(replace(truth, ' ', '')), 1.0) END AS cer FROM m)"


def _scores(t: Tables) -> DataFrame:
    models = t.spark.createDataFrame([(m,) for m in _MODELS], "m string")
    rows = T.sample_by_model(_titles(t), models).withColumn("f", F.expr(_FOUND))
    return rows.select("page_id", "lang", "m", M.cer(F.col("truth"), F.col("f")).alias("cer"))


@query(f"WITH {_SCORES} SELECT m AS model, count(*) AS n, round(avg(cer), 9) AS mean_cer FROM s GROUP BY m")
def model_means(t: Tables) -> DataFrame:
    """Every sample with every model, and the models' means."""
    return T.model_means(_scores(t).withColumnRenamed("m", "model"), "model", ["cer"])


@query(f"WITH {_SCORES}, l AS (SELECT DISTINCT lang FROM t UNION SELECT 'none'), a AS (SELECT l.lang, coalesce(round(avg(round(cer * 100)), 1), 999.0) AS mean_rate FROM l LEFT JOIN s ON s.lang = l.lang GROUP BY l.lang) SELECT lang, mean_rate, (SELECT round(avg(mean_rate), 1) FROM a) AS overall FROM a")
def style_means(t: Tables) -> DataFrame:
    """Means of rounded rates, 999 where there are none, and their mean."""
    scores = _scores(t)
    styles = scores.select("lang").distinct().unionByName(t.spark.createDataFrame([("none",)], "lang string"))
    return T.style_means(styles, scores.select("lang", F.round(F.col("cer") * 100).alias("rate")), "lang", "rate")


@query("WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('mix/' || doc_id), doc_id) AS r FROM documents), s AS (SELECT source, row_number() OVER (ORDER BY source) AS k FROM (SELECT DISTINCT source FROM documents)) SELECT doc_id, source FROM r JOIN s USING (source) WHERE (k = 1 AND r <= 20) OR (k = 2 AND r <= 10) OR (k = 3 AND r <= 7)")
def source_mix(t: Tables) -> DataFrame:
    """Thirty rows: two thirds and one third of two sources, and a quarter more of another."""
    names = [r.source for r in t.documents.select("source").distinct().orderBy("source").limit(3).collect()]
    return T.source_mix(t.documents.select("doc_id", "source"), "source", "doc_id", 30, T.review_shares(30, *names))


@query("SELECT lang, source, count(*) FILTER (starts_with(text, 'A')) AS line, count(*) FILTER (starts_with(text, 'T')) AS sent, count(*) FILTER (starts_with(text, 'I')) AS chars, count(*) FILTER (starts_with(text, 'A') OR starts_with(text, 'T') OR starts_with(text, 'I')) > 0 AS has_images FROM documents GROUP BY lang, source")
def variant_counts(t: Tables) -> DataFrame:
    return T.variant_counts(t.documents, ["lang", "source"], "text", {"line": "A", "sent": "T", "chars": "I"})


@query("WITH c AS (SELECT event_type AS k, count(*) AS n FROM events GROUP BY 1), f AS (SELECT coalesce(max(n) FILTER (k = 'view'), 0) >= 10 AS view_ready, coalesce(max(n) FILTER (k = 'refund'), 0) >= 1000000 AS refund_ready, coalesce(max(n) FILTER (k = 'nothing'), 0) >= 1 AS nothing_ready FROM c) SELECT *, CAST(view_ready AS BIGINT) + CAST(refund_ready AS BIGINT) + CAST(nothing_ready AS BIGINT) AS n_ready, view_ready AND refund_ready AND nothing_ready AS all_ready FROM f")
def readiness(t: Tables) -> DataFrame:
    counts = t.events.groupBy(F.col("event_type").alias("k")).agg(F.count("*").alias("n"))
    return T.readiness(counts, "k", "n", {"view": 10, "refund": 1_000_000, "nothing": 1})


@query("SELECT source, lang, n_files, n_bytes FROM (SELECT source, CASE WHEN grouping(lang) = 1 THEN '*' ELSE lang END AS lang, count(*) AS n_files, CAST(sum(n_chars) AS BIGINT) AS n_bytes, grouping(source) AS g FROM documents GROUP BY ROLLUP (source, lang)) WHERE g = 0")
def footprint(t: Tables) -> DataFrame:
    return T.footprint(t.documents.select("source", "lang", "n_chars"), "source", "lang", "n_chars")


_RESULT = "CASE WHEN event_type = 'view' THEN 'ok' WHEN event_type = 'click' THEN 'skip' ELSE 'fail:' || event_type || ' ' || user_id % 7 END"


@query(f"WITH r AS (SELECT {_RESULT} AS r FROM events), a AS (SELECT count(*) FILTER (r = 'ok') AS ok, count(*) FILTER (r = 'skip') AS skip, count(*) FILTER (r NOT IN ('ok', 'skip')) AS fail FROM r) SELECT *, ok + skip = 0 AND fail >= 20 AS bail FROM a")
def outcome_tally(t: Tables) -> DataFrame:
    return T.outcome_tally(t.events.select(F.expr(_RESULT).alias("r")), "r")


@query(f"SELECT r[6:] AS message, count(*) AS n FROM (SELECT {_RESULT} AS r FROM events) WHERE r NOT IN ('ok', 'skip') GROUP BY 1 ORDER BY n DESC, message LIMIT 5")
def top_errors(t: Tables) -> DataFrame:
    return T.top_errors(t.events.select(F.expr(_RESULT).alias("r")), "r")


# dictionaries and generators

_WORDS = "SELECT DISTINCT unnest(regexp_extract_all(text, '[a-z]+')) AS word FROM {}"


@query(f"SELECT word, count(*) AS n_tables FROM ({' UNION ALL '.join(_WORDS.format(t) for t in ('documents', 'benchmark', 'conversations'))}) GROUP BY word")
def merged_dictionary(t: Tables) -> DataFrame:
    words = lambda d: d.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[a-z]+"), F.lit(0)))).alias("word"))
    return T.merged_dictionary(words(t.documents), words(t.benchmark), words(t.conversations))


@query("WITH a AS (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents), b AS (SELECT DISTINCT unnest(string_split(p_name, '')) AS ch FROM part) SELECT ch, 'U+' || lpad(upper(to_hex(unicode(ch))), 4, '0') AS code FROM a WHERE ch <> '' AND ch NOT IN (SELECT ch FROM b)")
def missing_characters(t: Tables) -> DataFrame:
    return T.missing_characters(t.documents, t.part, "text", "p_name")


@query("SELECT CAST(coalesce(max(length(p_name)), 0) AS INTEGER) AS longest FROM part")
def longest_unit(t: Tables) -> DataFrame:
    return T.longest_unit(t.part, "p_name")


_CHARS = "SELECT chr(CAST(c AS INTEGER)) AS ch, upper(to_hex(c)) AS hex FROM range({}, {}) r(c)"


@query(
    f"""WITH v AS ({_CHARS.format(0xC85, 0xC8D)}), c AS ({_CHARS.format(0xC95, 0xCA9)}), s AS ({_CHARS.format(0xCBE, 0xCC5)}), d AS ({_CHARS.format(0xCE6, 0xCF0)})
SELECT 'vowel' AS kind, ch AS text, 'char_0' || hex AS id FROM v UNION ALL SELECT 'consonant', ch, 'char_0' || hex FROM c UNION ALL SELECT 'digit', ch, 'char_0' || hex FROM d
UNION ALL SELECT 'syllable', c.ch || s.ch, 'char_0' || c.hex || '_0' || s.hex FROM c, s UNION ALL SELECT 'conjunct', c.ch || '{V}' || e.ch, 'char_0' || c.hex || '_0CCD_0' || e.hex FROM c, c e UNION ALL SELECT 'half', ch || '{V}', 'char_0' || hex || '_0CCD' FROM c"""
)
def inventory_units(t: Tables) -> DataFrame:
    return G.inventory(t.spark, (0xC85, 0xC8C), (0xC95, 0xCA8), (0xCBE, 0xCC4), (0xCE6, 0xCEF))


@query("SELECT CAST((n - 1) // 12 AS BIGINT) AS line_no, string_agg(p_name, ' ' ORDER BY n) AS line FROM (SELECT p_name, row_number() OVER (ORDER BY p_partkey) AS n FROM part) GROUP BY 1")
def packed_lines(t: Tables) -> DataFrame:
    return G.packed_lines(t.part.select(F.col("p_partkey").alias("pos"), F.col("p_name").alias("word")))


@query("SELECT r_name AS style, n_name AS title, p - 1 AS page_no, n_name || ' ' || p AS text FROM region, nation, range(1, 4) x(p)")
def render_jobs(t: Tables) -> DataFrame:
    pages = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: F.concat_ws(" ", "n_name", k))
    jobs = G.render_jobs(t.region.select(F.col("r_name").alias("style")), t.nation.select(F.col("n_name").alias("title"), pages.alias("pages")))
    return jobs.select("style", "title", F.col("page_no").cast("long").alias("page_no"), "text")
