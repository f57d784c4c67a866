"""Sources, sinks and streams on files made for the test."""

import bz2
import json

from pyspark.sql import functions as F

from lipika.functions.profiles import KANNADA
from lipika.sources import readers as R
from lipika.sources import writers as W
from lipika.streaming import logs as S

KAN = "ಕನ್ನಡ ಭಾಷೆ"


def values(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_texts(spark, tmp_path):
    for name, text in (("t1/b.txt", "x\n\n y\n"), ("t1/a.txt", "a\n \n"), ("t2/c.txt", "c"), ("t2/d.md", "no")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    files = R.text_files(spark, str(tmp_path))
    assert files.count() == 3
    name = F.element_at(F.split("file", "/"), -1).alias("name")
    assert values(R.first_of_title(files).select("title", name), "title", "name") == [("t1", "a.txt"), ("t2", "c.txt")]
    assert values(R.first_of_title(files, ["t2"]).select("title"), "title") == [("t2",)]
    assert values(R.file_lines(files).select(name, "pos", "line"), "name", "pos", "line") == [("a.txt", 0, "a"), ("a.txt", 1, " "), ("b.txt", 0, "x"), ("b.txt", 1, ""), ("b.txt", 2, " y"), ("c.txt", 0, "c")]
    assert values(R.line_counts(files).select(name, "n_nonempty", "n_nonblank"), "name", "n_nonempty", "n_nonblank") == [("a.txt", 2, 1), ("b.txt", 2, 2), ("c.txt", 1, 1)]
    assert values(R.source_status(files, ["a.txt", "z.txt"]), "name", "cached", "size", "lines") == [("a.txt", True, 4, 1), ("z.txt", False, None, None)]


def test_wiki_dump(spark, tmp_path):
    page = lambda ns, title, text: f"<page><title>{title}</title><ns>{ns}</ns><revision><text>{text}</text></revision></page>"
    xml = f"<mediawiki>{page(104, 'b', '[[x|' + KAN + ']]')}{page(0, 'a', KAN)}{page(104, 'a', KAN + '।' + KAN)}</mediawiki>"
    path = tmp_path / "dump.xml.bz2"
    path.write_bytes(bz2.compress(xml.encode()))
    pages = R.wiki_pages(spark, str(path))
    assert pages.count() == 3
    assert values(R.wiki_lines(pages, KANNADA), "title", "n", "line") == [("a", 0, KAN), ("a", 1, KAN), ("b", 0, KAN)]
    assert R.wiki_lines(pages, KANNADA, most=2).count() == 2
    quality = spark.createDataFrame([("b", 4), ("a", 3), ("c", 2)], "title string, quality int")
    assert [r.title for r in R.quality_pages(quality, 3, 1).collect()] == ["a"]


def test_tables_of_lines(spark):
    lines = spark.createDataFrame([(0, "3"), (1, "ಕ 1 0"), (2, "ನ್ನ"), (3, "")], "pos long, line string")
    assert values(R.unit_table(lines), "unit") == [("ಕ",), ("ನ್ನ",)]
    row = lambda *x: "\t".join(map(str, x))
    layout = [row(4, 1, 2, 1, 1, 0, 5, 6, 70, 8, -1, ""), row(5, 1, 2, 1, 1, 1, 5, 6, 7, 8, 91.5, '"word"'), row(5, 1, 2, 1, 1, 2, 5, 6, 7, 8, 88.5, "w2"), row(5, 1, 2, 1, 1, 3, 5, 6, 7, 8, 10, " "), row("level", "x"), row(4, 1, "bad", 1, 1, 0, 5, 6, 7, 8, -1, "")]
    rows = spark.createDataFrame([("p", x) for x in layout] + [("plain", "just text")], "page string, line string")
    assert values(R.layout_words(rows), "page", "block", "par", "line", "x", "y", "w", "h") == [("p", 2, 1, 1, 5, 6, 70, 8)]
    assert values(R.word_confidence(rows), "page", "confidence") == [("p", 90.0), ("plain", None)]


def test_checkpoints_and_logs(spark):
    files = spark.createDataFrame([(f"out/{n}", 9) for n in ("m_0.105_4947_49300.checkpoint", "m_checkpoint", "m_x_0.1_2_3.checkpoint", "m_1_2.checkpoint")], "file string, size long")
    assert values(R.checkpoint_files(files, "m"), "bcer", "samples", "iter", "size") == [(0.105, 4947, 49300, 9)]
    log = spark.createDataFrame([(0, "At iteration 100/200/201, mean rms=1%, BCER train=2.5%, BWER train=9%"), (1, "noise")], "pos long, line string")
    none = R.checkpoint_files(files.limit(0), "m")
    assert values(R.progress_or_log(none, log), "iter", "bcer") == [(100, 2.5)]
    assert values(R.progress_or_log(R.checkpoint_files(files, "m"), log), "iter", "bcer") == [(49300, 0.105)]


def test_registry(spark, tmp_path):
    rows = R.registry(spark, [{"id": "b", "font_files": ["x.ttf"], "degrade": True}, {"id": "a", "max_pages": 3}])
    assert values(rows, "pos", "id", "degrade", "max_pages") == [(0, "b", True, None), (1, "a", None, 3)]
    entry = R.registry(spark, [{"id": "c"}])
    assert values(W.registry_insert(rows, entry), "pos", "id") == [(0, "b"), (1, "a"), (2, "c")]
    for bad in ("a", "Not ok"):
        try:
            W.registry_insert(rows, R.registry(spark, [{"id": bad}]))
        except ValueError:
            continue
        raise AssertionError(bad)
    left, gone = W.registry_delete(rows, "b")
    assert values(left, "id") == [("a",)] and values(gone, "id") == [("b",)]
    try:
        import yaml
    except ImportError:
        return
    (tmp_path / "fonts.yml").write_text(yaml.safe_dump({"fonts": [{"id": "z"}]}))
    assert R.yaml_registry(spark, str(tmp_path / "fonts.yml")).first().id == "z"


def test_variants_pairs_images(spark, tmp_path):
    fonts = spark.createDataFrame([(f"f/{n}",) for n in ("A.ttf", "A.otf", "B.otf", "C-Variable.ttf", "D[wght].ttf", "readme.txt")], "file string")
    assert values(R.font_variants(fonts), "variant", "stem") == [("A-otf", "A"), ("A-ttf", "A"), ("B", "B")]
    for name in ("x.png", "x.tif", "x.gt.txt", "y.jpg", "z.gt.txt"):
        (tmp_path / name).write_bytes(b"1")
    pairs = R.pair_listing(spark, str(tmp_path)).collect()
    assert len(pairs) == 1 and pairs[0].image.endswith("x.png") and pairs[0].truth.endswith("x.gt.txt")
    images = spark.createDataFrame([("a", [[0, 200], [127, 128], [255, 255]])], "stem string, pixels array<array<int>>")
    assert values(R.image_geometry(images), "w", "h", "ink") == [(2, 3, 2 / 6)]


def test_history(spark, tmp_path):
    (tmp_path / "h.json").write_text(json.dumps([{"label": "x", "byCategory": {"digit": 25, "vowel": 47}, "total": 10, "correct": 4, "overall": 40, "ts": "2024-05-06T07:08:09Z"}]))
    history = R.run_history(spark, str(tmp_path / "h.json"))
    assert values(R.category_rows(history), "category", "percent") == [("digit", 25), ("vowel", 47)]
    rows = spark.createDataFrame([("v", True), ("v", False), ("v", True), ("d", False)], "category string, ok boolean")
    assert values(R.category_accuracy(rows), "category", "percent", "n") == [("d", 0, 1), ("v", 67, 3)]
    out = str(tmp_path / "log")
    for _ in range(2):
        W.append_history(history.select("label", "overall"), out)
    assert spark.read.json(out).count() == 2


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(k, f"l{k % 7}") for k in range(50)], "pos long, line string")
    W.write_lines(rows, str(tmp_path / "t"))
    names = sorted(p for p in (tmp_path / "t").iterdir() if p.name.startswith("part"))
    assert [x for p in names for x in p.read_text().split()] == [f"l{k % 7}" for k in range(50)]
    assert values(W.new_lines(spark.createDataFrame([("l1",), ("l11",)], "line string"), rows), "line") == [("l11",)]
    merged = W.merge_lines(rows, spark.createDataFrame([(0, "l3"), (1, "new"), (2, "new")], "pos long, line string"))
    assert values(merged, "pos", "line") == sorted([(k, f"l{k}") for k in range(7)] + [(51, "new")], key=str)
    split = spark.createDataFrame([("a", "train"), ("b", "eval")], "path string, split string")
    W.write_split(split, str(tmp_path / "s"))
    assert values(spark.read.text(str(tmp_path / "s")), "value", "split") == [("a", "train"), ("b", "eval")]
    W.write_manifest(split, str(tmp_path / "m"))
    W.write_csv(split, str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "m")).count() == 2 and spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["path", "split"]
    boxes = W.box_files(spark.createDataFrame([("s", "a b", 3, 4)], "stem string, gt string, w int, h int"))
    assert values(boxes, "stem", "n", "line") == [("s", 0, "WordStr 0 0 3 4 0 #a b")]


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.log").write_text("start\n\nAt iteration 10/20/20, BCER train=5.0%\n")
    (tmp_path / "in" / "2.log").write_text("At iteration 30/40/40, BCER train=2.0%\nAt iteration 50/60/60, BCER train=3.0%\n")
    lines = S.log_lines(spark, str(tmp_path / "in"))
    assert S.drained(lines, str(tmp_path), "append").count() == 4
    assert tuple(S.drained(S.running_best(S.progress_stream(lines)), str(tmp_path)).first()) == (2.0, 30, 50)
