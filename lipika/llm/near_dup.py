"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

Sketch: in round ``i`` every shingle is hashed to a random bin with the value
``i + fraction``; a bin keeps the least value it was ever given. From round ``t`` on, each
round places all shingles in the one bin ``i - t``, so after ``2t`` rounds no coordinate is
empty, and a document with many shingles stops after a round or two. Two documents agree in
a coordinate with the probability of their Jaccard similarity, with concentration bounds.

Candidates: documents that agree in all rows of a band. The number of bands follows from the
threshold, so that a pair right at it is missed with a probability of at most ``MISS``.

Verification: candidates that hang together form a cluster; each cluster's documents meet in
one task, or, if it is large, in blocks. A task compares *all* its pairs on their full shingle
sets, by products of incidence matrices, but skips parts that links already hold together, and
gives back a spanning forest, never the pairs. Of a large cluster every block first meets
itself and the first block, so each text is sent about twice; only documents that are then
outside the cluster's largest class meet each other and that class. Documents with equal sets
are one vertex throughout, so thousands of copies cost one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipika.llm._common import connected_components, few, fresh, small_batches, stored, table

#: Coordinates of a band, at most: so many that a pair at the threshold agrees in one band of four or more often.
ROWS = 6
MISS = 1e-6
#: A block of a large cluster: at most about so many documents and shingles; and a part of it that is compared at once.
BLOCK_DOCS, BLOCK_SHINGLES = 8192, 1 << 21
PART_DOCS, PART_SHINGLES = 512, 1 << 19
#: Columns of the incidence matrices that are multiplied at a time.
BLOCK_COLUMNS = 4096

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(2**64 - 1)
_SEEDS = np.arange(1 << 16, dtype=np.uint64) * _GOLD


def rows_for(percent: int) -> int:
    """Coordinates of a band: fewer where the threshold is low."""
    return min(ROWS, max(1, int(math.log(0.25) / math.log(percent / 100)))) if percent < 100 else ROWS


def bands_for(percent: int, rows: int, miss: float = MISS) -> int:
    """Bands of ``rows`` coordinates that leave a pair at the threshold unseen with at most ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows))) if percent < 100 else 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


class _Words(dict):
    """64-bit hashes of words; the cache is emptied when it is large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, n: int, words: _Words) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles of a whole text.

    Words are maximal runs of anything but ASCII white space, with A-Z in lower case. With
    fewer than ``n`` words the whole sequence is the one shingle; no word, no shingle.
    """
    w = np.fromiter(map(words.__getitem__, (text or "").encode("utf-8", "surrogatepass").lower().split()), np.uint64)
    if not len(w):
        return w
    n = min(n, len(w))
    h = np.full(len(w) - n + 1, _SEEDS[n])
    for k in range(n):
        h = _mix(h + w[k : len(w) - n + 1 + k])
    return np.unique(h)


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``t`` coordinates for each non-empty set."""
    lengths = np.array([len(s) for s in sets])
    items, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    sketch = np.full(len(sets) * t, _EMPTY)
    for i in range(2 * t):
        seed = _mix(_SEEDS[i + 1 : i + 2])
        x = _mix(items ^ seed)
        place = ((x >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(np.int64) if i < t else np.full(len(items), i - t)
        at = owner * t + place
        value = (x & np.uint64(0xFFFFFFFF)) | np.uint64(i << 32)
        free = sketch[at] > value
        np.minimum.at(sketch, at[free], value[free])
        open_ = (sketch.reshape(-1, t) == _EMPTY).any(axis=1)
        if not open_.any():
            break
        keep = open_[owner]
        items, owner = items[keep], owner[keep]
    return sketch.reshape(-1, t)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key for each band; the band's number is part of it."""
    h = np.broadcast_to((np.arange(bands, dtype=np.uint64) + np.uint64(1)) * _GOLD, (len(sketch), bands))
    for r in range(rows):
        h = _mix(h + sketch[:, r : bands * rows : rows])
    return h.view(np.int64)


def _signer(shingle: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            sets = [shingle_set(x, shingle, words) for x in batch.column("text").to_pylist()]
            full = [k for k, s in enumerate(sets) if len(s)]
            keys: list = [None] * len(sets)
            if full:
                for k, row in zip(full, band_keys(sketches([sets[k] for k in full], bands * rows), bands, rows), strict=True):
                    keys[k] = row
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            half = lambda at: [None if d is None else int.from_bytes(d[at : at + 8], "little", signed=True) for d in digests]  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(half(0), pa.int64()), pa.array(half(8), pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "h1", "h2", "bands"],
            )

    return sign


def _linked(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs across have 100 * intersection >= percent * union, on full sets."""
    n = len(left)
    sizes = np.array([len(s) for s in (*left, *right)], dtype=np.int64)
    _, at, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[at]
    row = np.repeat(np.arange(len(sizes)), sizes)
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((n, len(right)), dtype=np.int64)
    width = int(column[-1]) + 1 if len(column) else 0
    for first in range(0, width, BLOCK_COLUMNS):
        a, b = np.searchsorted(column, (first, first + BLOCK_COLUMNS))
        m = np.zeros((len(sizes), min(BLOCK_COLUMNS, width - first)), dtype=np.float32)
        m[row[a:b], column[a:b] - first] = 1
        common += (m[:n] @ m[n:].T).astype(np.int64)
    union = sizes[:n, None] + sizes[None, n:] - common
    return 100 * common >= percent * union


def _parts(sets: list[np.ndarray], split: int) -> list[tuple[int, int]]:
    """The sets in parts of bounded size, none across ``split``."""
    parts, start, shingles = [], 0, 0
    for k, s in enumerate(sets):
        if k > start and (k == split or k - start == PART_DOCS or shingles + len(s) > PART_SHINGLES):
            parts.append((start, k))
            start, shingles = k, 0
        shingles += len(s)
    return [*parts, (start, len(sets))]


def links_within(sets: list[np.ndarray], percent: int, split: int = 0, inner: bool = True, groups: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A forest of links ``(i, j)`` that connects what all links of these sets connect.

    Compared are the first ``split`` sets with the others and, if ``inner``, the others with each
    other. Sets of equal ``groups`` are connected already; parts that are connected are skipped.
    """
    labels = np.arange(len(sets)) if groups is None else np.unique(groups, return_inverse=True)[1]
    edges: list[tuple[int, int]] = []
    parts = _parts(sets, split)
    for y, (c, d) in enumerate(parts):
        for x in (y, *range(y)):
            a, b = parts[x]
            if c < split or not (inner or a < split):
                continue
            own = np.concatenate([labels[a:b], labels[c:d]])
            if (own == own[0]).all():
                continue
            linked = _linked(sets[a:b], sets[c:d], percent)
            for i in np.flatnonzero(linked.any(1)) + a:
                j = np.flatnonzero(linked[i - a]) + c
                for label, k in zip(*np.unique(labels[j], return_index=True), strict=True):
                    if label != labels[i]:
                        edges.append((int(i), int(j[k])))
                        labels[labels == label] = labels[i]
    return edges


def _linker(shingle: int, percent: int):
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, key, rows, sets = _Words(), None, [], []

        def flush() -> pa.RecordBatch:
            order = sorted(range(len(rows)), key=lambda k: rows[k])
            split = sum(1 for r in rows if r[0] == 0)
            groups = np.array([rows[k][2] for k in order])
            found = links_within([sets[k] for k in order], percent, split, key[1] == key[2], groups)
            pairs = [(rows[order[i]][1], rows[order[j]][1]) for i, j in found]
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cluster", "p", "q", "side", "doc_id", "group", "text")]
            for cluster, p, q, side, doc_id, group, text in zip(*columns, strict=True):
                if (cluster, p, q) != key:
                    if len(rows) > 1:
                        yield flush()
                    key, rows, sets = (cluster, p, q), [], []
                rows.append((side, doc_id, group))
                sets.append(shingle_set(text, shingle, words))
        if len(rows) > 1:
            yield flush()

    return link


def _compared(texts: DataFrame, meetings: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links ``a, b`` found where documents meet; ``meetings`` is stored: ``id, cluster, group`` and the array ``m`` of ``(p, q, side)``."""
    met = texts.join(few(meetings), F.col("doc_id") == F.col("id")).select("cluster", "group", "doc_id", "text", F.explode("m").alias("m"))
    met = met.select("cluster", "m.p", "m.q", "m.side", "doc_id", "group", "text").repartition("cluster", "p", "q").sortWithinPartitions("cluster", "p", "q")
    return stored(met.mapInArrow(_linker(shingle, percent), "a long, b long"), "links")


def _remaining(placed: DataFrame, links: DataFrame) -> DataFrame | None:
    """Meetings of large clusters, after each block has met itself and the first: what is outside the largest class, with all.

    Those outside are cut to blocks that meet in pairs ``p <= q``; the largest class is cut to
    blocks ``-1, -2, ...`` that meet each of them.
    """
    large = placed.where("parts > 1")
    if large.isEmpty():
        return None
    classes = connected_components(links)
    large = large.join(classes, "id", "left").withColumn("group", F.coalesce("component", "id"))
    sizes = large.groupBy("cluster", "group").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    parts = lambda n, s: F.greatest(F.ceil(n / BLOCK_DOCS), F.ceil(s / BLOCK_SHINGLES), F.lit(1)).cast("int")
    top = F.max(F.struct("n", F.col("group"), "s"))
    whole = sizes.groupBy("cluster").agg(top.alias("top"), F.sum("n").alias("n"), F.sum("s").alias("s")).where(F.col("n") > F.col("top.n"))
    whole = whole.select("cluster", F.col("top.group").alias("largest"), parts(F.col("n") - F.col("top.n"), F.col("s") - F.col("top.s")).alias("out"), parts(F.col("top.n"), F.col("top.s")).alias("within"))
    rows = large.join(whole, "cluster").withColumn("is_in", F.col("group") == F.col("largest"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("is_in"), F.col("within")).otherwise(F.col("out"))).cast("int")
    rows = rows.withColumn("own", own)
    outer, inner = F.sequence(F.lit(0), F.col("out") - 1), F.sequence(F.lit(1), F.col("within"))
    meeting = lambda p, q, side: F.struct(p.alias("p"), q.alias("q"), side.cast("int").alias("side"))
    with_others = F.transform(outer, lambda k: meeting(F.least("own", k), F.greatest("own", k), F.col("own") >= k))
    with_largest = F.transform(inner, lambda k: meeting(-k, F.col("own"), F.lit(1)))
    from_largest = F.transform(outer, lambda k: meeting(-F.col("own") - 1, k, F.lit(0)))
    meetings = stored(rows.select("id", "cluster", "group", F.when(F.col("is_in"), from_largest).otherwise(F.concat(with_others, with_largest)).alias("m")), "meetings")
    return None if meetings.isEmpty() else meetings


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """Classes of near-duplicates: per row of ``docs`` its ``doc_id, n_shingles, component_id, kept``.

    Documents with ``100 * |A and B| >= percent * |A or B|`` on their shingle sets are
    linked; the component is the smallest doc_id reachable. Defined cases: a null or empty
    text has no shingles and is linked with nothing; rows with equal sets are linked; rows
    that repeat a doc_id come back as often as they came; a row with a null doc_id can't name
    a class: its component is null and it is kept, and nothing is linked through it. Other
    columns of ``docs`` are never read, whatever their names. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    rows = rows_for(percent)
    bands = bands_for(percent, rows, miss)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(texts.mapInArrow(_signer(shingle, bands, rows), "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>"), "signed")

    # one vertex for each distinct set
    vertices = signed.where("doc_id is not null and h1 is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    vertex_rows = signed.where("doc_id is not null and h1 is not null").select("h1", "h2", "doc_id", "n_shingles", "bands").join(vertices.withColumnRenamed("rep", "doc_id"), ["h1", "h2", "doc_id"])
    members = vertex_rows.select("doc_id", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last").select("key", "hub")
    touching = members.join(buckets, "key").where("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    clusters = stored(connected_components(touching).withColumnRenamed("component", "cluster"), "clusters")

    # large clusters in blocks: each meets itself and the first
    sized = clusters.join(vertex_rows.select(F.col("doc_id").alias("id"), "n_shingles").groupBy("id").agg(F.max("n_shingles").alias("n_shingles")), "id")
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int")
    blocks = sized.groupBy("cluster").agg(parts.alias("parts"))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    first = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(k.alias("p"), k.alias("q"), (k == 0).cast("int").alias("side")))
    alone = F.array(F.struct(own.alias("p"), own.alias("q"), F.lit(1).alias("side")))
    placed = stored(sized.join(blocks, "cluster").select("id", "cluster", "n_shingles", "parts", F.col("id").alias("group"), F.when(own == 0, first).otherwise(alone).alias("m")), "placed")
    links = _compared(texts, placed.select("id", "cluster", "group", "m"), shingle, percent)
    rest = _remaining(placed.drop("group", "m"), links)
    if rest is not None:
        links = links.unionByName(_compared(texts, rest, shingle, percent))
    classes = connected_components(links).withColumnRenamed("id", "rep")

    named = vertices.join(classes, "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("component"))
    found = signed.select("doc_id", "n_shingles", "h1", "h2").join(named, ["h1", "h2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without those whose class has a smaller doc_id; columns unchanged."""
    (gone_id,) = fresh(docs, "gone_id")
    gone = stored(near_duplicates(docs, shingle, percent).where("not kept").select(F.col("doc_id").alias(gone_id)).distinct(), "gone")
    return docs.join(few(gone), F.col("doc_id") == F.col(gone_id), "left_anti")


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by 3-word shingles at 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


OP9_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS sh FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 85 * (p.n + q.n - i)),
g AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS id, doc_id AS hop FROM documents UNION SELECT r.id, g.b FROM r JOIN g ON g.a = r.hop),
m AS (SELECT id, min(hop) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d JOIN m ON m.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

QUERIES = {"op9_near_dup": op9_near_dup}
ORACLES = {"op9_near_dup": OP9_SQL}
