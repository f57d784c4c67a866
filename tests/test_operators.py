"""Ordering, pairing, splitting, choosing and geometry on small tables."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lipika.functions.profiles import KANNADA
from lipika.operators import checkpoints as C
from lipika.operators import generators as G
from lipika.operators import geometry as B
from lipika.operators import ordering as O
from lipika.operators import pairs as P
from lipika.operators import split as S


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_order(spark):
    docs = spark.createDataFrame([(1, "b\na\nb"), (0, "a\nc")], "doc_id long, text string")
    rows = O.positions(docs, F.split("text", "\n")).select("pos", "line")
    assert values(O.keep_first(rows), "line", "pos") == [("a", (0, 0)), ("b", (1, 0)), ("c", (0, 1))]
    assert [tuple(r) for r in O.last_lines(rows, 2).orderBy("pos").collect()] == [((1, 1), "a", 5), ((1, 2), "b", 5)]
    assert values(O.last_per_key(rows, "line", "pos", "pos"), "line", "pos") == [("a", (1, 1)), ("b", (1, 2)), ("c", (0, 1))]


@pytest.mark.parametrize("n", [0, 1, 7, 100, 1000])
def test_ranks_and_samples(spark, n):
    ids = random.Random(1).sample(range(10_000), n)
    rows = spark.createDataFrame([(i,) for i in ids], "k long").repartition(5)
    assert values(O.global_rank(rows, "k"), "k", "rank") == sorted(((k, r) for r, k in enumerate(sorted(ids))), key=str)
    if n:
        step = max(1, n // 10)
        assert sorted(r.k for r in O.systematic_sample(rows, "k", 10).collect()) == sorted(ids)[::step][:10]
        picks = sorted(ids) if n <= 5 else [sorted(ids)[i * (n - 1) // 4] for i in range(5)]
        assert sorted(r.k for r in O.even_picks(rows, "k", 5).collect()) == sorted(set(picks))
    assert O.hash_sample(rows, "s", "k", 5).count() == min(5, n)


def test_groups(spark):
    rows = spark.createDataFrame([("a", k) for k in range(5)] + [("b", k) for k in range(4)] + [("c", 0)], "g string, k int")
    assert values(O.middle_per_group(rows, "g", "k"), "g", "k") == [("a", 2), ("b", 2), ("c", 0)]
    assert values(O.head_per_group(rows, ["g"], "k", 2, 2), "g", "k") == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    boxes = spark.createDataFrame([("p", 2, 1, 1), ("p", 1, 2, 1), ("p", 1, 1, 2)], "page string, block int, par int, line int")
    assert values(O.reading_order(boxes), "n", "block", "par") == [(0, 1, 1), (1, 1, 2), (2, 2, 1)]


def test_pairs(spark):
    images = spark.createDataFrame([("a",), ("b",), ("p_line001",), ("p",)], "stem string")
    truth = spark.createDataFrame([("a", "x"), ("p", "y")], "stem string, gt string")
    assert values(P.stem_pairs(images, truth), "stem", "gt") == [("a", "x"), ("p", "y")]
    assert values(P.without_truth(images, truth), "stem") == [("b",), ("p_line001",)]
    assert values(P.not_superseded(images), "stem") == [("a",), ("b",), ("p_line001",)]
    assert values(P.with_flag(images, truth, "stem", "has"), "stem", "has") == [("a", True), ("b", False), ("p", True), ("p_line001", False)]
    assert values(P.exists_semi(images, truth, "stem"), "stem") == [("a",), ("p",)]


def test_positional_zip(spark):
    boxes = spark.createDataFrame([("p", 0, 1), ("p", 1, 2), ("q", 0, 3), ("r", 0, 4)], "page string, n int, x int")
    truth = spark.createDataFrame([("p", 0, "a"), ("p", 1, "b"), ("q", 0, "c"), ("q", 1, "d"), ("s", 0, "e")], "page string, n int, t string")
    good, bad = P.positional_zip(boxes, truth)
    assert values(good, "page", "n", "x", "t") == [("p", 0, 1, "a"), ("p", 1, 2, "b")]
    assert values(bad, "page", "n_boxes", "n_lines") == [("q", 1, 2), ("r", 1, 0), ("s", 0, 1)]


def test_prefixes(spark):
    paths = spark.createDataFrame([("ab1",), ("a2",), ("c",), (None,)], "path string")
    assert values(P.prefix_semi(paths, "path", ["ab", "c"]), "path") == [("ab1",), ("c",)]
    assert [r.f for r in paths.select(P.prefix_first_match("path", ["a", "ab"]).alias("f")).collect()] == ["a", "a", None, None]
    assert P.prefix_semi(paths, "path", []).count() == 0


def test_guards(spark):
    rows = spark.createDataFrame([(10, 10, "x"), (100, 20, "y"), (100, 48, "abc"), (2, 48, "abc"), (3, 48, "abc"), (5, 0, "a")], "w int, h int, t string")
    guards = [(F.col("h") < 16, "low"), (F.col("t") == "y", "bad"), (~P.ctc_feasible(F.col("w"), F.col("h"), F.length("t")), "ctc")]
    rows = rows.withColumn("reason", P.first_reason(guards))
    assert [r.reason for r in rows.collect()] == ["low", "bad", None, "ctc", None, "low"]
    assert P.guard_tally(rows, "reason", ["low", "bad", "ctc", "never"]).first().asDict() == {"n_rows": 6, "n_low": 2, "n_bad": 1, "n_ctc": 1, "n_never": 0, "n_usable": 2, "usable_percent": 33.3}
    gates = spark.createDataFrame([(0, 0), (5, 100), (6, 100)], "s int, t int").select(P.skip_gate(F.col("s"), F.col("t")).alias("g"))
    assert [r.g for r in gates.collect()] == ["empty", "ok", "warn"]
    box = spark.range(1).select(P.crop_box(F.lit(1.5), F.lit(2.0), F.lit(100.0), F.lit(5.0), F.lit(50), F.lit(60), 3).alias("b")).first().b
    assert tuple(box) == (0, 0, 50, 10)
    cut = spark.createDataFrame([(20.0, 9, 14), (20.0, 9, 17), (40.0, 9, 20), (20.0, 7, 20)], "want double, w int, h int").select(P.cut_by_fold(F.col("want"), F.col("w"), F.col("h")).alias("c"))
    assert [r.c for r in cut.collect()] == [True, False, True, True]
    rejects = P.rejects_per_page(spark.createDataFrame([("p", 0, None, "a"), ("p", 1, "low", "b" * 99)], "page string, n int, reason string, text string"), "page", "n", "reason", "text")
    assert rejects.first().kept == 1 and [tuple(x) for x in rejects.first().rejected] == [(1, "low", "b" * 60)]


def test_lookups_and_sets(spark):
    t = lambda data, schema: spark.createDataFrame(data, schema)
    assert values(P.with_default(t([("a",), ("b",)], "k string"), t([("a", 2)], "k string, v int"), "k", "v", 0), "k", "v") == [("a", 2), ("b", 0)]
    declared, found = t([("x", 0), ("y", 1)], "k string, pos long"), t([("y",), ("w",), ("z",), ("z",)], "k string")
    assert values(P.declared_then_extra(declared, found, "k"), "pos", "k", "present") == [(0, "x", False), (1, "y", True), (2, "w", True), (3, "z", True)]
    assert values(P.cross_cap(t([("s",)], "k string"), t([(3,), (1,), (2,)], "p int"), "p", 2), "k", "p") == [("s", 1), ("s", 2)]
    assert values(P.attested_minus(t([("a",), ("b",), ("b",)], "k string"), t([("a",)], "k string"), "k"), "k") == [("b",)]
    assert values(P.attested_only(t([("a",), ("b",), ("cc",)], "k string"), t([("a",)], "k string"), "k", F.length("k") == 2), "k") == [("a",), ("cc",)]
    assert values(P.new_and_known(t([("a", 1), ("b", 2), ("a", 0)], "k string, pos int"), t([("b",)], "k string"), "k", "pos"), "k", "pos", "known") == [("a", 0, False), ("b", 2, True)]
    assert values(P.first_existing(t([("a", "p2", 2), ("a", "p1", 1), ("b", "q", 5)], "k string, path string, rank int"), "k", "path", "rank"), "k", "path") == [("a", "p1"), ("b", "q")]
    assert values(P.outcome_or_missing(t([("a",), ("b",)], "k string"), t([("a", 0.5)], "k string, cer double"), "k", "cer"), "k", "cer") == [("a", "0.5"), ("b", "?")]
    assert values(P.latest_versions(t([("a", 1, "old"), ("a", 2, "new")], "k string, at int, v string"), "k", "at"), "k", "v") == [("a", "new")]
    shards = values(P.worker_shards(t([("f",), ("g",), ("h",), ("f",)], "font string"), "font", 2), "font", "worker")
    assert shards == [("f", 0), ("f", 0), ("g", 1), ("h", 0)]


def test_split(spark):
    paths = ["/x/lstmf/classical/t__f/page0001_line001.lstmf", "classical/t__f/page0001_line002.lstmf", "classical/t__f/cover.lstmf", "inventory/font/char_0C95.lstmf", "rendered/d/f.lstmf", "scan/page1/line1.lstmf", "alone"]
    kind, group = S.group_of(F.col("p"))
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select(kind.alias("k"), group.alias("g")).collect()
    assert [tuple(r) for r in rows] == [("classical", "t__f/page0001"), ("classical", "t__f/page0001"), ("classical", "t__f/cover.lstmf"), ("inventory", "font/char_0C95"), ("rendered", "d"), ("scan", "page1"), ("alone", "alone")]
    buckets = spark.createDataFrame([(p,) for p in paths], "p string").select(S.bucket_of(F.col("p"), ["classical", "inventory"]).alias("b")).collect()
    assert [r.b for r in buckets] == ["classical"] * 3 + ["inventory", "other", "other", "other"]

    data = [(k, f"g{g}", i) for k, n in (("a", 15), ("b", 25), ("one", 1), ("scan", 30), ("two", 2)) for g in range(n) for i in range(3)]
    split = S.group_split(spark.createDataFrame(data, "kind string, group string, i int"))
    sides = {}
    for r in split.collect():
        sides.setdefault((r.kind, r.group), set()).add(r.split)
    assert all(len(s) == 1 for s in sides.values())
    held = {k: sorted(g for (kk, g), s in sides.items() if kk == k and s == {"eval"}) for k in ("a", "b", "one", "scan", "two")}
    size = lambda n: max(1, round(n * (1 - 0.9)))
    assert {k: len(v) for k, v in held.items()} == {"a": size(15), "b": size(25), "one": 0, "scan": 0, "two": 1}
    rank = sorted((hashlib.md5(f"{S.SEED}/a/g{g}".encode()).hexdigest(), f"g{g}") for g in range(15))
    assert held["a"] == sorted(g for _, g in rank[: size(15)])
    total = S.split_summary(split).where("kind = 'TOTAL'").first()
    assert (total.n_groups, total.eval_groups, total.train_groups, total.eval_rows, total.train_rows) == (73, 4, 69, 12, 207)


def test_checkpoints(spark):
    rows = spark.createDataFrame([("c1", 0.5, 100), ("c2", 0.2, 200), ("c3", 0.2, 300), ("c4", 0.1, 1000)], "file string, bcer double, iter long")
    assert tuple(C.best(rows, "bcer", "iter", "file").first()) == ("c4", 0.1)
    assert tuple(C.best_capped(rows, "bcer", "iter", "file", 300, "rolling").first()) == ("c2", "cap")
    assert tuple(C.best_capped(rows, "bcer", "iter", "file", 60, "rolling").first()) == ("c1", "widened")
    assert tuple(C.best_capped(rows, "bcer", "iter", "file", 10, "rolling").first()) == ("rolling", "fallback")
    assert tuple(C.best_capped(rows.limit(0), "bcer", "iter", "file", 10, "rolling").first()) == ("rolling", "fallback")
    course = C.course(rows.withColumn("run", F.lit(1)), ["run"], "bcer", "iter").orderBy("iter").collect()
    assert [(r.best_so_far, r.is_new_best, r.since_best) for r in course] == [(0.5, True, 0), (0.2, True, 0), (0.2, False, 100), (0.1, True, 0)]
    flat = C.plateau(rows.where("iter < 1000").withColumn("run", F.lit(1)), ["run"], "bcer", "iter", 100).first()
    assert flat.best_iteration == 200 and flat.on_plateau
    files = spark.createDataFrame([("d1",), ("d2",), ("d2",), ("d3",), ("d3",)], "d string")
    assert values(C.most_files(files, "d"), "d", "n_files", "is_largest") == [("d1", 1, False), ("d2", 2, True), ("d3", 2, False)]
    assert C.resume_choice(spark.createDataFrame([("a", 1, False), ("b", 2, True), ("c", 3, True)], "p string, r int, e boolean"), "p", "r", "e").first().p == "b"
    assert C.latest(spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "p string, m int"), "p", "m").first().p == "b"
    assert rows.limit(0).agg(C.mean_or("bcer", 0.0).alias("m")).first().m == 0.0


def box(text, top, left, right, bottom):
    return (text, float(top), float(left), float(right), float(bottom))


def python_lines(chars):
    """The two passes over boxes, with mutable lines."""
    lines, current = [], None

    def overlap(a, b):
        shorter = min(a[4] - a[1], b[4] - b[1])
        return shorter > 0 and (min(a[4], b[4]) - max(a[1], b[1])) / shorter >= 0.5

    def grow(a, b):
        a[:] = [a[0] + b[0], min(a[1], b[1]), min(a[2], b[2]), max(a[3], b[3]), max(a[4], b[4])]

    for c in chars:
        if c[0] == "\n":
            current = None
        elif c[1] == c[4] and c[2] == c[3]:
            if current is not None:
                current[0] += c[0]
        elif current is not None and (overlap(current, c) or abs(c[1] - current[1]) <= 3):
            grow(current, c)
        else:
            current = list(c)
            lines.append(current)
    merged = []
    for line in sorted(lines, key=lambda x: x[1]):
        if merged and overlap(merged[-1], line):
            grow(merged[-1], line)
        else:
            merged.append(list(line))
    return [(t.strip(" \t\n\r"), x, y, r - x, b - y) for t, y, x, r, b in merged if t.strip() and r > x and b - y >= 16]


def test_boxes_to_lines(spark):
    rng = random.Random(9)
    pages = []
    for p in range(60):
        chars = []
        for k in range(rng.randint(0, 25)):
            top = rng.choice([0, 2, 5, 15, 30, 33, 60]) + rng.random()
            kind = rng.random()
            chars.append(box("\n", 0, 0, 0, 0) if kind < 0.1 else box(" ", top, k, k, top) if kind < 0.25 else box("ab"[k % 2], top, k * 5, k * 5 + rng.choice([0, 6]), top + rng.choice([10, 20, 30])))
        pages.append((f"p{p}", chars))
    rows = spark.createDataFrame([(p, i, *c) for p, chars in pages for i, c in enumerate(chars)], "page string, i int, ch string, top double, left double, right double, bottom double")
    found = {}
    for r in B.page_lines(rows).orderBy("page", "n").collect():
        found.setdefault(r.page, []).append((r.text, r.x, r.y, r.w, r.h))
    assert found == {p: lines for p, chars in pages if (lines := python_lines(chars))}


def test_islands(spark):
    rows = spark.createDataFrame([("u", k, float(v)) for k, v in enumerate([1, 5, 12, 40, 45, 2, 100])], "g string, k int, v double")
    assert values(B.islands(rows, "g", ["k"], "v", 10.0), "island", "n", "low", "high") == [(0, 3, 1.0, 12.0), (1, 2, 40.0, 45.0), (2, 1, 2.0, 2.0), (3, 1, 100.0, 100.0)]


def test_generators(spark):
    consonants = G.code_points(spark, 0x0C95, 0x0CAF)
    assert consonants.count() == 26  # one of the 27 is unassigned
    assert G.conjuncts(consonants).count() == 26 * 26
    inventory = G.inventory(spark, (0x0C85, 0x0C94), (0x0C95, 0x0CAF), (0x0CBE, 0x0CC4), (0x0CE6, 0x0CEF), ["x"])
    counts = {r.kind: r["count"] for r in inventory.groupBy("kind").count().collect()}
    assert counts == {"vowel": 14, "consonant": 26, "syllable": 26 * 7, "conjunct": 676, "half": 26, "digit": 10, "extra": 1}
    assert inventory.where("text = 'ಕ್ಖ'").first().id == "char_0C95_0CCD_0C96"
    words = spark.createDataFrame([(k, "ಾ" if k == 3 else f"w{k}") for k in range(14)], "pos int, word string")
    assert [r.line for r in G.packed_lines(words).orderBy("line_no").collect()] == ["w0 w1 w2 ◌ಾ w4 w5 w6 w7 w8 w9 w10 w11", "w12 w13"]
    jobs = G.render_jobs(spark.createDataFrame([("s1",), ("s2",)], "style string"), spark.createDataFrame([("t", ["p", "q"])], "title string, pages array<string>"))
    assert values(jobs, "style", "title", "page_no") == [("s1", "t", 0), ("s1", "t", 1), ("s2", "t", 0), ("s2", "t", 1)]
    assert KANNADA.block_size == 128


def test_positions_have_no_cap(spark):
    docs = spark.createDataFrame([(1 << 62, "a\nb"), (-(1 << 62), "b\n" * ((1 << 20) + 5) + "z"), ((1 << 62) + 1, "z\nc")], "doc_id long, text string")
    rows = O.positions(docs, F.split("text", "\n")).select("pos", "line")
    assert values(O.keep_first(rows), "line", "pos") == [("a", (1 << 62, 0)), ("b", (-(1 << 62), 0)), ("c", ((1 << 62) + 1, 1)), ("z", (-(1 << 62), (1 << 20) + 5))]


@pytest.mark.parametrize("pieces", [None, 1, 7])
def test_middles_and_ranks_by_pieces(spark, pieces):
    rows = spark.range(500).select((F.col("id") * 7 % 501).alias("v"), F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 3)).alias("g"))
    data = [tuple(r) for r in rows.collect()]
    middle = {g: sorted(v for v, x in data if x == g) for _, g in data}
    assert {(r.g, r.v) for r in O.middle_per_group(rows, "g", "v", pieces).collect()} == {(g, v[len(v) // 2]) for g, v in middle.items()}
    assert [r["rank"] for r in O.global_rank(rows, "v", pieces=pieces).orderBy("v").collect()] == list(range(500))
    assert O.middle_per_group(rows.limit(0), "g", "v", pieces).count() == 0
