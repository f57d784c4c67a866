"""Embedding near-dedup: epsilon grid order join.

Cosine of at least ``t`` means a Euclidean distance of at most ``eps = sqrt(2 - 2t)`` between
unit vectors, and no projection to an axis can lie farther apart. Vectors are projected to
the leading principal axes, put in cells of width ``eps``, and sorted by cell (the epsilon
grid order). The sequence is cut into intervals with bounding boxes; only pairs of intervals
whose boxes come within ``eps`` meet, and each meeting is joined recursively, halving both
sides and leaving out provably distant halves, down to a product of two small matrices in
double precision. Meetings give back link counts and a spanning forest, not the pairs.
Equal vectors are one weighted vertex, so groups of copies cost one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipika.llm._common import connected_components, small_batches, stored, table

THRESHOLD = 0.98
AXES = 4
INTERVAL, LEAF = 512, 128
#: Neighbouring intervals that one group of meetings owns: a power of two, in bits.
RANGE_BITS = 4
#: The axes are fitted to about so many vectors, by a hash; any axes give whole results.
AXES_SAMPLE = 50_000
#: Among so many parts the intervals that touch one cell are spread.
SALTS = 8
#: Cosines this close to the threshold are computed again from the raw components.
SLACK = 1e-9


def _preparer(kind: str):
    """Usable vectors as bytes of components, with their dimension and a 128-bit digest."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _prepared(batch, kind)

    return prepare


def _prepared(batch: pa.RecordBatch, kind: str) -> pa.RecordBatch:
    ids, labels, dims, h1, h2, data = [], [], [], [], [], []
    for vec_id, label, values in zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), batch.column("embedding"), strict=True):
        if not values.is_valid or values.values.null_count or not len(values.values):
            continue
        x = values.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 is 0.0
        with np.errstate(over="ignore", invalid="ignore"):
            norm = np.sqrt(x @ x)
        if not np.isfinite(norm) or norm == 0:
            scale = np.abs(x).max()
            if not np.isfinite(scale) or scale == 0:
                continue
            x = x / scale  # components whose squares leave the range of doubles
        raw = x.astype(kind).tobytes()
        digest = xxhash.xxh3_128_digest(raw)
        ids.append(vec_id)
        labels.append(label)
        dims.append(len(x))
        h1.append(int.from_bytes(digest[:8], "little", signed=True))
        h2.append(int.from_bytes(digest[8:], "little", signed=True))
        data.append(raw)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(dims, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(data, pa.binary())],
        names=["vec_id", "label", "dim", "h1", "h2", "data"],
    )


def _doubles(raw: bytes, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(raw, kind).astype(np.float64).reshape(-1, dim)


def _unit(raw: list[bytes], dim: int, kind: str) -> np.ndarray:
    x = _doubles(b"".join(raw), dim, kind)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _by_dim(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    data = batch.column("data").to_pylist()
    for dim in np.unique(dims):
        at = np.flatnonzero(dims == dim)
        yield int(dim), at, _unit([data[k] for k in at], int(dim), kind)


def _moments(kind: str):
    """Count, sum and outer product of one partition's unit vectors, for each dimension."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, u in _by_dim(batch, kind):
                one = np.concatenate([[len(u)], u.sum(0), (u.T @ u).ravel()])
                total[dim] = total.get(dim, 0) + one
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["dim", "sums"])

    return moments


def _add_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, sums in zip(batch.column("dim").to_pylist(), batch.column("sums").to_pylist(), strict=True):
            total[dim] = total.get(dim, 0) + np.frombuffer(sums)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["dim", "sums"])


class Axes(dict):
    """Mean and leading principal axes by dimension; of one that no sampled vector has, the first coordinates."""

    def __init__(self, number: int) -> None:
        super().__init__()
        self.number = number

    def __missing__(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(dim), np.eye(dim)[:, : self.number]


def principal_axes(vectors: DataFrame, axes: int, kind: str, sample: int = AXES_SAMPLE) -> Axes:
    """Mean and leading principal axes of the unit vectors, for each dimension.

    Fitted to about ``sample`` vectors by their hashes, spread to a few tasks whose
    matrices are added; one matrix for each dimension comes to the driver.
    """
    share = min(1.0, sample / max(1, vectors.count()))
    chosen = vectors.where(F.pmod(F.xxhash64("h1", "h2"), F.lit(1 << 30)) <= int(share * (1 << 30)))
    sums = chosen.select("dim", "data").repartition(8).mapInArrow(_moments(kind), "dim int, sums binary").repartition(1).mapInArrow(_add_moments, "dim int, sums binary")
    found = Axes(axes)
    for row in sums.collect():
        v, d = np.frombuffer(bytes(row.sums)), row.dim
        n, mean, outer = v[0], v[1 : d + 1] / v[0], v[d + 1 :].reshape(d, d)
        values, basis = np.linalg.eigh(outer / n - np.outer(mean, mean))
        found[d] = (mean, basis[:, np.argsort(-values, kind="stable")[:axes]])
    return found


def _placer(axes: dict, width: float, n: int, kind: str):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros((batch.num_rows, n), np.int64)
            for dim, at, u in _by_dim(batch, kind):
                mean, basis = axes[dim]
                cells[at, : basis.shape[1]] = np.floor((u - mean) @ basis / width)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c) for c in cells.T]], names=[*batch.schema.names, *[f"c{k}" for k in range(n)]])

    return place


_BLOCK = "block long, label string, dim int, lo array<double>, hi array<double>, ids array<long>, weights array<long>, data binary"


def _cutter(axes: dict, size: int, kind: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, key, rows = TaskContext.get().partitionId(), 0, None, []

        def flush() -> pa.RecordBatch:
            label, dim = key
            mean, basis = axes[dim]
            z = (_unit([r[2] for r in rows], dim, kind) - mean) @ basis
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + number], pa.int64()), pa.array([label], pa.string()), pa.array([dim], pa.int32()),
                    pa.array([z.min(0).tolist()], pa.list_(pa.float64())), pa.array([z.max(0).tolist()], pa.list_(pa.float64())),
                    pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([[r[1] for r in rows]], pa.list_(pa.int64())), pa.array([b"".join(r[2] for r in rows)], pa.binary()),
                ],
                names=[x.split()[0] for x in _BLOCK.split(", ")],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("label", "dim", "rep", "weight", "data")]
            for label, dim, rep, weight, data in zip(*columns, strict=True):
                if rows and ((label, dim) != key or len(rows) == size):
                    yield flush()
                    number, rows = number + 1, []
                key = (label, dim)
                rows.append((rep, weight, data))
        if rows:
            yield flush()

    return cut


class _Side:
    """One interval of the sequence, with its vectors, unit vectors and projections."""

    def __init__(self, ids: list, weights: list, data: bytes, dim: int, axes: tuple, kind: str) -> None:
        self.ids, self.weights = np.array(ids, np.int64), np.array(weights, np.int64)
        self.raw = _doubles(data, dim, kind)
        self.unit = self.raw / np.sqrt((self.raw * self.raw).sum(1, keepdims=True))
        self.z = (self.unit - axes[0]) @ axes[1]


def _near(a: _Side, i: slice, b: _Side, j: slice, eps: float) -> bool:
    za, zb = a.z[i], b.z[j]
    gap = np.maximum(0, np.maximum(za.min(0) - zb.max(0), zb.min(0) - za.max(0)))
    return bool((gap * gap).sum() <= eps * eps)


def _join(a: _Side, i: slice, b: _Side, j: slice, eps: float, threshold: float, links: np.ndarray) -> None:
    """Marks the links between two intervals, halving them while they are large."""
    if not _near(a, i, b, j, eps):
        return
    n, m = i.stop - i.start, j.stop - j.start
    if n <= LEAF and m <= LEAF:
        cos = a.unit[i] @ b.unit[j].T
        for p, q in np.argwhere(np.abs(cos - threshold) < SLACK):
            x, y = a.raw[i.start + p], b.raw[j.start + q]
            cos[p, q] = (x @ y) / (np.sqrt(x @ x) * np.sqrt(y @ y))
        links[i, j] = cos >= threshold
        return
    halves = lambda s: [s] if s.stop - s.start <= LEAF else [slice(s.start, (s.start + s.stop) // 2), slice((s.start + s.stop) // 2, s.stop)]
    for p in halves(i):
        for q in halves(j):
            if a is not b or p.start <= q.start:
                _join(a, p, b, q, eps, threshold, links)


def _least_reachable(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a bipartite link matrix: the least id that each row and each column reaches."""
    top = np.iinfo(np.int64).max
    while True:
        new_left = np.minimum(left, np.where(links, right[None, :], top).min(1, initial=top))
        new_right = np.minimum(right, np.where(links, new_left[:, None], top).min(0, initial=top))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def _meet(own: _Side, other: _Side, eps: float, threshold: float) -> pa.RecordBatch | None:
    """Link counts and least reachable vertices of two intervals, or of one with itself."""
    links = np.zeros((len(own.ids), len(other.ids)), bool)
    _join(own, slice(0, len(own.ids)), other, slice(0, len(other.ids)), eps, threshold, links)
    if own is other:
        links |= links.T
        np.fill_diagonal(links, False)
    if not links.any():
        return None
    counts = [(own.ids, links @ other.weights)]
    if own is not other:
        counts.append((other.ids, own.weights @ links))
    a, b = _least_reachable(links, own.ids, other.ids)
    ids, n = np.concatenate([c[0] for c in counts]), np.concatenate([c[1] for c in counts])
    root = a if own is other else np.concatenate([a, b])
    some = n > 0
    return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(n[some]), pa.array(root[some])], names=["rep", "n", "root"])


def _meeter(axes: dict, eps: float, threshold: float, kind: str):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, among = None, {}, []

        def inside() -> Iterator[pa.RecordBatch]:
            """Meetings among the intervals of the range itself, once they are all there."""
            for block, owners in among:
                yield from filter(None, (_meet(own[o], own[block], eps, threshold) for o in owners))
            among.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("owners_range", "block", "is_other", "owners", "dim", "ids", "weights")]
            for k, (range_, block, is_other, owners, dim, ids, weights) in enumerate(zip(*columns, strict=True)):
                if range_ != key:
                    yield from inside()
                    key, own = range_, {}
                side = _Side(ids, weights, batch.column("data")[k].as_py(), dim, axes[dim], kind)
                if not is_other:  # the range's own intervals come first
                    own[block] = side
                    among.append((block, owners))
                    continue
                yield from inside()
                yield from filter(None, (_meet(own[o], side, eps, threshold) for o in owners))
        yield from inside()

    return meet


def _near_pairs(blocks: DataFrame, axes: int, eps: float) -> DataFrame:
    """Pairs ``a < b`` of intervals of one label and dimension whose boxes come within ``eps``.

    They meet by cells of the leading axes, as many axes as make about eight intervals a cell
    likely; the cells of a box are few then, as intervals are narrow where there are many.
    """
    boxes = blocks.select("block", "label", "dim", "lo", "hi")
    number = boxes.groupBy(F.col("label").alias("l"), F.col("dim").alias("d")).agg(F.count("*").alias("m")).where("m > 1")
    number = number.select("l", "d", F.least(F.lit(axes), F.ceil(F.log(8.0, F.col("m").cast("double")))).cast("int").alias("k"))
    boxes = boxes.join(number, (F.col("label") == F.col("l")) & (F.col("dim") == F.col("d")))
    cell = lambda side, k: F.floor(F.element_at(side, k + 1) / F.lit(eps))

    def touched(name: str, margin: int) -> DataFrame:
        rows = boxes.select(F.col("block").alias(name), "label", "dim", "k", F.col("lo").alias(f"lo_{name}"), F.col("hi").alias(f"hi_{name}"))
        for i in range(axes):
            used = (F.col("k") > i) & (F.size(f"lo_{name}") > i)
            some = F.sequence(F.when(used, cell(F.col(f"lo_{name}"), i) - margin).otherwise(0), F.when(used, cell(F.col(f"hi_{name}"), i) + margin).otherwise(0))
            rows = rows.withColumn(f"cell{i}", F.explode(some))
        return rows

    cells = ["label", "dim", *[f"cell{i}" for i in range(axes)], "salt"]
    a = touched("a", 0).withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)))
    b = touched("b", 1).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))).drop("k")
    gap = F.transform(F.arrays_zip("lo_a", "hi_a", "lo_b", "hi_b"), lambda z: F.greatest(F.lit(0.0), z["lo_a"] - z["hi_b"], z["lo_b"] - z["hi_a"]))
    near = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g) <= eps * eps
    return a.join(b, cells).where("a < b").where(near).select("a", "b").distinct()


def cosine_links(vectors: DataFrame, threshold: float = THRESHOLD, axes: int = AXES, interval: int = INTERVAL) -> DataFrame:
    """Links of vectors with equal labels and a cosine of ``threshold`` or more, in double precision.

    Returns ``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (columns
    ``vec_id, embedding, label``; others are not read). Cases: a vector that is null, empty,
    zero, or has null or non-finite components, or whose label is null, links with nothing,
    and vectors of different lengths never link; labels of any type are equal as their values are;
    vec_id is an integer; a row with a null vec_id names no vector:
    it has 0 links, a null component and is kept, and nothing is linked through it. Rows that
    repeat a vec_id with an equal vector are one vector and come back as often as they came.
    No rows give no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    eps = float(np.sqrt(2 - 2 * threshold)) + 1e-9
    elements = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = "<f4" if elements == "float" else "<f8"
    label = F.col("label") + F.lit(0.0) if vectors.schema["label"].dataType.simpleString() in ("float", "double") else F.col("label")  # -0.0 is 0.0
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>").alias("embedding"), label.cast("string").alias("label"))
    usable = rows.where("vec_id is not null and label is not null and embedding is not null")
    ready = stored(usable.mapInArrow(_preparer(kind), "vec_id long, label string, dim int, h1 long, h2 long, data binary"), "vectors")
    same = ["label", "dim", "h1", "h2"]
    vertices = ready.select("vec_id", *same).distinct().groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    lead = ready.withColumnRenamed("vec_id", "rep").join(vertices, [*same, "rep"]).dropDuplicates([*same, "rep"]).select("label", "dim", "rep", "weight", "data")
    basis = principal_axes(ready, axes, kind)

    cells = [f"c{k}" for k in range(axes)]
    placed = lead.mapInArrow(_placer(basis, eps, axes, kind), "label string, dim int, rep long, weight long, data binary, " + ", ".join(f"{c} long" for c in cells))
    ordered = placed.repartitionByRange("label", "dim", *cells, "rep").sortWithinPartitions("label", "dim", *cells, "rep")
    blocks = stored(ordered.mapInArrow(_cutter(basis, interval, kind), _BLOCK), "intervals")

    pairs = _near_pairs(blocks, axes, eps)
    odd = F.pmod(F.xxhash64(F.shiftright("a", RANGE_BITS), F.shiftright("b", RANGE_BITS)), F.lit(2)) == 1
    meetings = pairs.select(F.when(odd, F.col("a")).otherwise(F.col("b")).alias("owner"), F.when(odd, F.col("b")).otherwise(F.col("a")).alias("block"))
    meetings = meetings.unionByName(blocks.select(F.col("block").alias("owner"), "block"))
    # at most 2^RANGE_BITS owners in an array; an interval's own range has it once, with its owners there
    met = meetings.groupBy(F.shiftright("owner", RANGE_BITS).alias("owners_range"), "block").agg(F.collect_list("owner").alias("owners"))
    met = met.join(blocks.select("block", "dim", "ids", "weights", "data"), "block").withColumn("is_other", F.shiftright("block", RANGE_BITS) != F.col("owners_range"))
    met = met.repartition("owners_range").sortWithinPartitions("owners_range", "is_other", "block").select("owners_range", "block", "is_other", "owners", "dim", "ids", "weights", "data")
    found = stored(met.mapInArrow(_meeter(basis, eps, threshold, kind), "rep long, n long, root long"), "links")

    degrees = found.groupBy("rep").agg(F.sum("n").alias("n"))
    classes = connected_components(found.where("rep <> root"), "rep", "root").withColumnRenamed("id", "rep")
    named = vertices.join(degrees, "rep", "left").join(classes, "rep", "left")
    named = named.select(*same, (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    # equal vectors under different labels may share an id: counts add up, the smallest component names it
    by_id = ready.select("vec_id", *same).distinct().join(named, same).groupBy("vec_id").agg(F.sum("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = rows.select("vec_id").join(by_id, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings at cosine 0.98."""
    return cosine_links(table(spark, sf_dir, "embeddings"))


OP3_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0 AND len(list_filter(embedding, lambda y: y <> 0)) > 0),
e AS MATERIALIZED (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.x) = len(q.x) WHERE list_cosine_similarity(p.x, q.x) >= 0.98),
r AS (SELECT vec_id AS id, vec_id AS hop FROM embeddings UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.hop),
m AS (SELECT id, min(hop) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN m ON m.id = vec_id LEFT JOIN n ON n.a = vec_id
"""

QUERIES = {"op3_embedding_dedup": op3_embedding_dedup}
ORACLES = {"op3_embedding_dedup": OP3_SQL}
