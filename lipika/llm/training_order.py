"""Token-ID output: training-order materialisation.

Texts are encoded to token ids, each followed by a separator, and laid end to end in the
order of ``doc_id`` and the text's digest, however the table is split for reading; the stream
is cut to sequences of a fixed length. A keyed Feistel permutation with cycle-walking maps a
sequence's number to its global slot, so the whole training order is a shuffle that needs no
state and can be computed, and inverted, for any one slot. Ranges of slots are shards of a
fixed stride: a reader finds slot ``s`` in shard ``s div S`` at byte ``(s mod S) * stride``
and resumes there.

The ids are encoded once and stored. Only keys and lengths are sorted and summed; the places
that come of it are written as one small file beside each group of stored rows, so the ids
find their places without a join. The payload is shuffled once, to the range of slots that
its task assembles and, where a directory is given, writes. Repeating a lost task gives the
same bytes, since places come from stored files; a finished shard is not written again.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipika.llm._common import removed_at_exit, shared_dir, small_batches, stored, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-tokenisation of that byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LENGTH, SHARD_SLOTS = 1024, 256
KEY = "order-1"
ROUNDS = 6
#: Characters that are encoded at a time, tokens of a stored row, and stored rows that share one file of places.
CHUNK_CHARS, ROW_TOKENS, GROUP_ROWS = 1 << 16, 1 << 18, 1 << 16
#: Bytes of ids in a record batch, and in a page of the stored table: copies within a page cost little.
BATCH_BYTES, PAGE_BYTES = 1 << 20, 8 << 20
#: Where a text may be cut without changing its tokens: after a letter or number, before an ASCII sign that is none.
_CUT = re.compile(r"[^\W_](?=[\x00-/:-@\[-`{-\x7f])")

_MASK = (1 << 64) - 1
_encodings: dict = {}


def encoding(path: str):
    """The tokenizer of a rank file, made once a process."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = (tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1)
    return _encodings[path]


class Feistel:
    """A keyed permutation of ``range(n)``."""

    def __init__(self, n: int, key: str = KEY) -> None:
        self.n = n
        self.half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
        self.keys = [int.from_bytes(hashlib.sha256(f"{key}/{r}".encode()).digest()[:8], "little") for r in range(ROUNDS)]

    def _mix(self, x: np.ndarray, key: int) -> np.ndarray:
        x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(32))) & np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, inverse: bool) -> np.ndarray:
        low = np.uint64((1 << self.half) - 1)
        a, b = x >> np.uint64(self.half), x & low
        if inverse:
            for k in reversed(self.keys):
                a, b = b ^ self._mix(a, k), a
        else:
            for k in self.keys:
                a, b = b, a ^ self._mix(b, k)
        return (a << np.uint64(self.half)) | b

    def __call__(self, x: np.ndarray, inverse: bool = False) -> np.ndarray:
        """Slots of sequence numbers (or, inverted, numbers of slots); what leaves the range walks on."""
        y = self._once(np.asarray(x).astype(np.uint64), inverse)
        while (out := y >= np.uint64(self.n)).any():
            y[out] = self._once(y[out], inverse)
        return y.astype(np.int64)


def chunks(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters that encode to the same tokens as the whole."""
    at = 0
    while len(text) - at > size:
        cut = _CUT.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


_CODED = "part long, nth int, doc_id long, h1 long, h2 long, n_tokens long, ids binary"


def _encoder(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        code, end = encoding(path)
        kind = np.dtype("<u2") if end < 1 << 16 else np.dtype("<u4")
        part, nth, size = TaskContext.get().partitionId() << 24, 0, 0
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            nonlocal size
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            rows.clear()
            size = 0
            return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _CODED.split(", ")])

        def add(key: tuple, ids: list[np.ndarray]) -> None:
            nonlocal part, nth, size
            raw = np.concatenate(ids).tobytes()
            rows.append((part, nth, *key, len(raw) // kind.itemsize, raw))
            size += len(raw)
            nth += 1
            if nth == GROUP_ROWS:
                part, nth = part + 1, 0

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                text = text.as_py()
                if not text:
                    continue
                digest = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
                key = (doc_id.as_py(), int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))
                ids, n = [], 0
                for chunk in chunks(text):
                    ids.append(np.array(code.encode_ordinary(chunk), dtype=kind))
                    n += len(ids[-1])
                    if n >= ROW_TOKENS:
                        add(key, ids)
                        ids, n = [], 0
                        if size >= BATCH_BYTES:
                            yield out()
                add(key, [*ids, np.array([end], kind)])
                if size >= BATCH_BYTES or len(rows) >= 10_000:
                    yield out()
        if rows:
            yield out()

    return encode


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums of tokens along one range of the order."""
    from pyspark import TaskContext

    piece, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("n_tokens").to_numpy()
        ends = before + np.cumsum(n)
        if len(n):
            before = int(ends[-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), piece, np.int64)), batch.column("part"), batch.column("nth"), batch.column("n_tokens"), pa.array(ends - n)], names=["piece", "part", "nth", "n_tokens", "within"])


def _files(directory: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(directory) if "://" in directory else (fs.LocalFileSystem(), directory)


def _placer(directory: str):
    """Writes the places of each group of stored rows as one file of 64-bit numbers, ``GROUP_ROWS`` of them at most."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(directory)
        files.create_dir(root, recursive=True)
        part, places, done = None, [], []

        def finish() -> None:
            aside = f"{root}/.{uuid.uuid4().hex}"
            with files.open_output_stream(aside) as f:
                f.write(np.array(places, "<i8").tobytes())
            files.move(aside, f"{root}/{part}.places")
            done.append(part)

        for batch in batches:
            for p, start in zip(batch.column("part").to_pylist(), batch.column("start").to_pylist(), strict=True):
                if p != part:
                    if part is not None:
                        finish()
                    part, places = p, []
                places.append(start)
        if part is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], names=["part"])

    return write


def _slicer(directory: str, n_sequences: int, length: int, width: int, key: str):
    """Cuts each stored row where sequences begin, and finds the sequences' slots; the pieces are compressed."""
    order = Feistel(n_sequences, key)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(directory)
        codec = pa.Codec("zstd", compression_level=6)
        part, places = None, None
        doc, seq, at, count, data = [], [], [], [], []

        def out() -> pa.RecordBatch:
            slots = order(np.array(seq, np.int64))
            columns = [pa.array(slots), pa.array(at, pa.int32()), pa.array(count, pa.int32()), pa.array(doc, pa.int64()), pa.array(data, pa.binary())]
            for x in (doc, seq, at, count, data):
                x.clear()
            return pa.RecordBatch.from_arrays(columns, names=["slot", "at", "n", "doc_id", "ids"])

        for batch in batches:
            ids_ = batch.column("ids")
            for k, (p, nth, doc_id) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("part", "nth", "doc_id")], strict=True)):
                if p != part:
                    part = p
                    with files.open_input_stream(f"{root}/{p}.places") as f:
                        places = np.frombuffer(f.read(), "<i8")
                start, ids = int(places[nth]), ids_[k].as_py()
                n = len(ids) // width
                for s in range(start // length, (start + n - 1) // length + 1):
                    lo, hi = max(start, s * length), min(start + n, (s + 1) * length)
                    doc.append(doc_id)
                    seq.append(s)
                    at.append(lo - s * length)
                    count.append(hi - lo)
                    data.append(codec.compress(ids[(lo - start) * width : (hi - start) * width], asbytes=True))
                    if len(doc) * length * width >= BATCH_BYTES:
                        yield out()
        if doc:
            yield out()

    return cut


class _Shards:
    """Writes sequences in the order of slots as files ``shard-<number>.bin``: aside first, then moved into place.

    A shard that is there in its full size is finished and not written again.
    """

    def __init__(self, directory: str, stride: int, slots: int, n_sequences: int) -> None:
        self.files, self.root = _files(directory)
        self.files.create_dir(self.root, recursive=True)
        self.stride, self.slots, self.n_sequences = stride, slots, n_sequences
        self.shard, self.stream, self.aside, self.count = None, None, "", 0
        self.done: list[tuple[int, int, int, bool]] = []

    def add(self, shard: int, raw: bytes) -> None:
        if shard != self.shard:
            self.finish()
            self.shard, self.count, self.aside, self.stream = shard, 0, f"{self.root}/.{uuid.uuid4().hex}", None
            whole = min(self.slots, self.n_sequences - shard * self.slots) * self.stride
            if self.files.get_file_info(self._path()).size != whole:
                self.stream = self.files.open_output_stream(self.aside)
        if self.stream:
            self.stream.write(raw.ljust(self.stride, b"\0"))
        self.count += 1

    def _path(self) -> str:
        return f"{self.root}/shard-{self.shard:08d}.bin"

    def finish(self) -> None:
        if self.shard is not None:
            if self.stream:
                self.stream.close()
                self.files.move(self.aside, self._path())
            self.done.append((self.shard, self.count, self.count * self.stride, self.stream is not None))
            self.shard = None


_SEQUENCE = "slot long, shard long, byte_offset long, seq long, n_tokens int, doc_ids array<long>, tokens binary"


def _assembler(length: int, width: int, slots: int, n_sequences: int, key: str, directory: str | None):
    order = Feistel(n_sequences, key)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        done: list[tuple] = []
        slot, docs, parts = None, [], []
        shards = None

        def out() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            columns.insert(3, order(np.array(columns[0], np.int64), inverse=True))
            done.clear()
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _SEQUENCE.split(", ")])

        def close() -> None:
            nonlocal shards
            raw = b"".join(parts)
            if directory:
                shards = shards or _Shards(directory, length * width, slots, n_sequences)
                shards.add(slot // slots, raw)
            done.append((slot, slot // slots, slot % slots * length * width, len(raw) // width, list(docs), raw))

        for batch in batches:
            for s, d, n, ids in zip(*[batch.column(c).to_pylist() for c in ("slot", "doc_id", "n", "ids")], strict=True):
                if s != slot:
                    if slot is not None:
                        close()
                    slot, docs, parts = s, [], []
                docs.append(d)
                parts.append(codec.decompress(ids, decompressed_size=n * width, asbytes=True))
                if len(done) * length * width >= BATCH_BYTES:
                    yield out()
        if slot is not None:
            close()
        if shards:
            shards.finish()
        if done:
            yield out()

    return assemble


def sequences(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, shard_slots: int = SHARD_SLOTS, key: str = KEY, directory: str | None = None) -> DataFrame:
    """All sequences of the tokenised ``docs`` with their places in the training order.

    Returns ``slot, shard, byte_offset, seq, n_tokens, doc_ids, tokens``: ``tokens`` are
    little-endian ids of 16 bits (32 for vocabularies beyond), ``doc_ids`` names the document
    of each piece, in order. Every id of every text is in exactly one sequence; only the last
    sequence of the stream is shorter than ``length``. The stream's order is that of doc_id (nulls
    first) and the text's digest, so the same rows have the same slots however they are split.
    Cases: null and empty texts have no tokens, nor a separator; a doc_id that is null or repeated
    is carried as it is; no tokens, no rows. Other columns are not read. Slots are the numbers from
    0 up to the number of sequences, each once. Partitions are ranges of whole shards; with
    ``directory``, a path or URI that all executors share, the tasks that make the rows write them.
    A directory with finished shards of the same order is resumed; of another order, it is refused.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    width = 2 if encoding(vocabulary)[1] < 1 << 16 else 4
    coded = stored(rows.mapInArrow(_encoder(vocabulary), _CODED), "ids", "zstd", **{"parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(PAGE_BYTES)})
    order = ["doc_id", "h1", "h2", "part", "nth"]
    ranged = coded.select(*order, "n_tokens").repartitionByRange(*order).sortWithinPartitions(*order)
    sums = stored(ranged.select("part", "nth", "n_tokens").mapInArrow(_sums, "piece long, part long, nth int, n_tokens long, within long"), "places")
    # one row for each range of the order: as many as a stage has tasks
    sizes = sorted(tuple(r) for r in sums.groupBy("piece").agg(F.sum("n_tokens")).collect())
    ends = np.cumsum([n for _, n in sizes], dtype=np.int64)
    total = int(ends[-1]) if sizes else 0
    starts = spark.createDataFrame([(p, int(e) - n) for (p, n), e in zip(sizes, ends, strict=True)], "piece long, first long")
    places = f"{shared_dir(spark)}/places-{uuid.uuid4().hex}"
    placed = sums.join(F.broadcast(starts), "piece").select("part", "nth", (F.col("first") + F.col("within")).alias("start"))
    placed.repartition("part").sortWithinPartitions("part", "nth").select("part", "start").mapInArrow(_placer(places), "part long").write.format("noop").mode("overwrite").save()
    removed_at_exit(spark, places)

    n_sequences = -(-total // length)
    if directory:
        _same_order(directory, {"tokens": total, "length": length, "shard_slots": shard_slots, "key": key, "width": width, "texts": _digest(coded)})
    cut = coded.mapInArrow(_slicer(places, n_sequences, length, width, key), "slot long, at int, n int, doc_id long, ids binary")
    n_shards = max(1, -(-total // (length * shard_slots)))
    ranges = min(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shard = F.floor(F.col("slot") / shard_slots)
    ordered = cut.repartitionById(ranges, F.floor(shard * ranges / n_shards).cast("int")).sortWithinPartitions("slot", "at")
    return ordered.mapInArrow(_assembler(length, width, shard_slots, n_sequences, key, directory), _SEQUENCE)


def _digest(coded: DataFrame) -> str:
    """Of all keys and lengths, free of their order."""
    h = F.xxhash64("doc_id", "h1", "h2", "n_tokens")
    return "/".join(str(x) for x in coded.agg(F.bit_xor(h), F.coalesce(F.sum(F.shiftrightunsigned(h, 24)), F.lit(0))).first())


def _same_order(directory: str, what: dict) -> None:
    """Writes what decides the order beside the shards, or compares it with what is there."""
    files, root = _files(directory)
    files.create_dir(root, recursive=True)
    path = f"{root}/order.json"
    if files.get_file_info(path).is_file:
        with files.open_input_stream(path) as f:
            if json.loads(f.read()) != what:
                raise ValueError(f"{directory} holds the shards of another order")
    else:
        with files.open_output_stream(path) as f:
            f.write(json.dumps(what).encode())


def shards_written(docs: DataFrame) -> DataFrame:
    """``sequences`` of ``docs``; the rows' tasks write the shards to a folder ``training-order-<id>`` of the shared one."""
    return sequences(docs, directory=f"{shared_dir(docs.sparkSession)}/training-order-{uuid.uuid4().hex}")


def write_shards(found: DataFrame, directory: str, length: int = LENGTH, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Writes ``sequences`` as files ``shard-<number>.bin`` and returns ``shard, n_slots, n_bytes, written``.

    ``directory`` is a path or URI that all executors share. Rows are range-partitioned by slot; each
    shard is written by one task, aside and then moved into place, so a task that is repeated does no
    harm, and a shard that is there in full is left (``written`` is false). A sequence that is shorter
    than ``length`` is filled with zero bytes; the stride is fixed.
    """
    last = found.agg(F.max("slot").alias("slot"), F.max(F.octet_length("tokens") / F.col("n_tokens")).cast("int").alias("width")).first()
    n_sequences, width = (0 if last.slot is None else last.slot + 1), last.width or 2
    n_shards = max(1, -(-n_sequences // shard_slots))
    ranges = min(n_shards, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(directory, length * width, shard_slots, n_sequences)
        for batch in batches:
            for number, raw in zip(batch.column("shard").to_pylist(), batch.column("tokens"), strict=True):
                shards.add(number, raw.as_py())
        shards.finish()
        done = list(zip(*shards.done, strict=True)) or [[], [], [], []]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(done, kinds, strict=True)], names=["shard", "n_slots", "n_bytes", "written"])

    ordered = found.select("shard", "slot", "tokens").repartitionById(ranges, F.floor(F.col("shard") * ranges / n_shards).cast("int")).sortWithinPartitions("slot")
    return ordered.select("shard", "tokens").mapInArrow(write, "shard long, n_slots long, n_bytes long, written boolean")


def op5_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of all documents at their slots, written as shards."""
    return shards_written(table(spark, sf_dir, "documents"))


QUERIES = {"op5_training_order": op5_training_order}
ORACLES: dict[str, str] = {}
