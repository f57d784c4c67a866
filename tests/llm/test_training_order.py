"""Training order: a bijection, an exact round trip, and files of a fixed stride."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from lipika.llm import training_order as O


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000, 4097])
def test_permutation(n):
    order = O.Feistel(n)
    slots = order(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (order(slots, inverse=True) == np.arange(n)).all()
    if n >= 1000:
        assert abs(np.corrcoef(slots, np.arange(n))[0, 1]) < 0.1
        assert (O.Feistel(n, "other")(np.arange(n)) != slots).any()


TEXTS = ["Hello world, this is a text.", None, "", "Grüße 😀 " * 50, "a", "x" * 5000, "word " * 3000, "Hello world, this is a text."]


def test_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(k if k != 4 else None, t, "z", 0) for k, t in enumerate(TEXTS)], "doc_id long, text string, slot string, part int").repartition(3)
    found = O.sequences(docs, length=64, shard_slots=8)
    rows = sorted(found.collect(), key=lambda r: r.seq)
    code, end = O.encoding(O.VOCABULARY)
    assert [r.seq for r in rows] == list(range(len(rows))) and sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all(r.n_tokens == 64 for r in rows[:-1]) and all(r.shard == r.slot // 8 and r.byte_offset == r.slot % 8 * 128 for r in rows)
    ids = np.frombuffer(b"".join(bytes(r.tokens) for r in rows), "<u2")
    cuts = np.flatnonzero(ids == end)
    texts = [code.decode(part[:-1].tolist() if len(part) else []) for part in np.split(ids, cuts + 1)[:-1]]
    assert sorted(texts) == sorted(t for t in TEXTS if t)
    assert {d for r in rows for d in r.doc_ids} == {0, 3, None, 5, 6, 7}

    shards = O.write_shards(found, str(tmp_path / "out"), length=64, shard_slots=8).collect()
    assert sum(s.n_slots for s in shards) == len(rows)
    for r in rows:
        with open(tmp_path / "out" / f"shard-{r.shard:08d}.bin", "rb") as f:
            f.seek(r.byte_offset)
            assert f.read(2 * r.n_tokens) == bytes(r.tokens)
    again = O.write_shards(found, str(tmp_path / "out"), length=64, shard_slots=8).collect()
    assert all(s.written for s in shards) and not any(s.written for s in again)  # finished shards stay
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith(".")]


def test_query_writes_its_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(O, "shared_dir", lambda _: f"file://{tmp_path}")
    (tmp_path / "documents.parquet").mkdir()
    text = "word and number %d " * 40_000
    spark.createDataFrame([(1, text % ((7,) * 40_000)), (2, text % ((8,) * 40_000))], "doc_id long, text string").write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    found = O.op5_training_order(spark, str(tmp_path))
    slots = found.rdd.mapPartitions(lambda rows: [[r.slot for r in rows]]).filter(bool).collect()
    assert len(slots) > 1 and sorted(slots) == sorted(slots, key=min) and sum(sorted(slots), []) == list(range(sum(map(len, slots))))
    (out,) = tmp_path.glob("training-order-*")
    for r in found.collect():
        raw = (out / f"shard-{r.shard:08d}.bin").read_bytes()
        assert raw[r.byte_offset : r.byte_offset + 2 * r.n_tokens] == bytes(r.tokens)


def test_order_is_that_of_the_rows_not_of_their_split(spark, monkeypatch):
    monkeypatch.setattr(O, "GROUP_ROWS", 5)
    rows = [(k // 3, f"text {k % 7} " * (k + 1)) for k in range(40)] + [(1, "again " * 9000), (1, "again " * 9000), (None, "none"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [{(r.slot, r.seq, bytes(r.tokens), tuple(r.doc_ids)) for r in O.sequences(docs.repartition(n), length=32).collect()} for n in (1, 7)]
    assert found[0] == found[1]


def test_resumed_directory(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text {k} " * 50) for k in range(20)], "doc_id long, text string")
    write = lambda d, **x: O.sequences(d, length=16, shard_slots=4, directory=str(tmp_path), **x).collect()
    rows = write(docs)
    first = tmp_path / "shard-00000000.bin"
    kept, stamp = first.read_bytes(), first.stat().st_mtime_ns
    (tmp_path / "shard-00000001.bin").unlink()
    assert len(write(docs)) == len(rows)
    assert (tmp_path / "shard-00000001.bin").exists() and first.stat().st_mtime_ns == stamp and first.read_bytes() == kept
    with pytest.raises(ValueError, match="another order"):
        write(docs, key="other")
    with pytest.raises(ValueError, match="another order"):
        write(docs.where("doc_id > 3"))


@pytest.mark.parametrize("text", ["It's a test's 12.5 % x_1\n\n  two  \x1c spaces 。中文、字 ²3 a.b,c " * 300, "x" * 3000, " \n" * 2000, "word " * 3000])
def test_chunks_encode_as_the_whole(text):
    code, _ = O.encoding(O.VOCABULARY)
    for size in (1, 7, 100):
        parts = list(O.chunks(text, size))
        assert "".join(parts) == text
        assert [t for p in parts for t in code.encode_ordinary(p)] == code.encode_ordinary(text)


def test_memory_of_a_long_text():
    """One text of 16 MB: what a worker holds beside the text itself stays small."""
    script = """
import resource, sys, pyarrow as pa
sys.path.insert(0, %r)
from unittest import mock
import pyspark
from lipika.llm import training_order as O
O.encoding(O.VOCABULARY)
batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["some words, and more of them " * 560_000])], names=["doc_id", "text"])
with mock.patch("pyspark.TaskContext.get") as get:
    get.return_value.partitionId.return_value = 0
    n = sum(b.column("n_tokens").to_numpy().sum() for b in O._encoder(O.VOCABULARY)(iter([batch])))
print(n, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    done = subprocess.run([sys.executable, "-c", script % str(Path(__file__).parents[2])], capture_output=True, text=True, check=True)
    n, mb = map(int, done.stdout.split())
    assert n > 3_000_000 and mb < 250


def test_no_tokens(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert O.sequences(empty).count() == 0
    assert O.sequences(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).count() == 0
