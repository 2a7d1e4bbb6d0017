"""Hard negatives by angular triangle filtering.

Vectors become integers, floor(256 * x), and a score is an exact integer inner product. Every row keeps its norm and
its angles to ``REFERENCES`` directions (spherical k-means on a sample of at most ``SAMPLE`` rows, the ones of least
id hash). For two rows and any direction r, the triangle inequality on the sphere gives
|angle(a, r) - angle(b, r)| <= angle(a, b) <= angle(a, r) + angle(b, r): a cosine interval, and times the norms an
interval of the score, widened by more than the rounding of angles. Rows of a cell (nearest direction) are dealt into
chunks of at most about ``CHUNK`` rows, and sorted by angle into granules with the extremes of their angles and norms.

A search takes anchors with windows of scores. An anchor is first sent to the chunks of its own cell; the k-th best
score found there raises the window's lower end, and the anchor goes on only to the cells whose interval still meets a
window. In a task, only (anchor, granule) pairs whose interval meets a window are scored. Nothing is left out: rows that
are skipped cannot lie in a window. Positives are a search without limits among rows of the anchor's label; negatives
are a search among the other labels within low * p <= 100 * score <= high * p for each positive score p. Intervals cut
much where vectors form clusters, and little where they lie evenly in many dimensions; then the anchors meet all rows
block by block: a (chunk, anchor block) pair is one group of two bounded sides. The partial bests of a window are at
most k rows a chunk.

Anchors are many: they are dealt into blocks of about ``CHUNK`` by hash, each block's rows a copy of the chunks. Only
the directions and the extremes of their cells (a fixed number) pass the driver.

Rows with a null id, label or vector, or with a null or non-finite component, take no part, nor do rows whose squared
norm reaches 2**56, as 100 times their scores may not fit a long. A shorter vector counts as filled up with zeros. Rows
of equal id are rows of their own; ties go by id, then by place. Other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docindex.llm import textvec as tv
from docindex.llm.scratch import stored

SCALE = 256
REFERENCES = 16
SAMPLE = 4_096
CHUNK = 16_384
GRANULE = 128
TOGETHER = 256  # anchors scored at once
SLACK = 4e-6  # radians; angles are kept in 32 bits
_LARGEST = 2.0 ** 56
_NONE = np.iinfo(np.int64).min
_ANY = 1 << 60


# ---------------------------------------------------------------- vectors
def quantised(column: pa.Array):
    """(rows that take part, their integer vectors end to end, offsets) of an array of float lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_list(pa.float64()))
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    child = column.values
    values = child.to_numpy(zero_copy_only=False)  # nulls become nan
    values = np.floor(SCALE * values[offsets[0]: offsets[-1]])
    offsets = offsets - offsets[0]
    bad = ~np.isfinite(values)
    values = np.where(bad, 0, values)
    with np.errstate(over="ignore"):
        size = tv_sums(values * values, offsets)
    here = (tv.sums(bad, offsets) == 0) & (size < _LARGEST) & np.asarray(column.is_valid())
    return here, values, offsets


def tv_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row sums of float values; each row is added up by itself."""
    out = np.zeros(len(offsets) - 1)
    some = offsets[1:] > offsets[:-1]
    if some.any():
        out[some] = np.add.reduceat(values, offsets[:-1][some])
    return out


def matrix(packed: list, width: int = 0) -> np.ndarray:
    """Packed 32-bit vectors as rows of float64, filled up with zeros."""
    width = max([width, *(len(p) // 4 for p in packed)])
    if packed and all(len(p) == 4 * width for p in packed):
        return np.frombuffer(b"".join(packed), dtype="<i4").reshape(len(packed), width).astype(np.float64)
    out = np.zeros((len(packed), width))
    for row, p in zip(out, packed):
        row[: len(p) // 4] = np.frombuffer(p, dtype="<i4")
    return out


def directions(vectors: np.ndarray, k: int = REFERENCES, rounds: int = 8) -> np.ndarray:
    """Unit directions (at most k) by spherical k-means from a farthest-first start; the same on every run."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors[norms[:, 0] > 0] / norms[norms[:, 0] > 0]
    if not len(unit):
        return np.ones((1, max(1, vectors.shape[1] if vectors.ndim == 2 else 1)))
    chosen = [unit[0]]
    near = unit @ chosen[0]
    for _ in range(k - 1):
        far = int(near.argmin())
        if near[far] > 1 - 1e-9:
            break
        chosen.append(unit[far])
        near = np.maximum(near, unit @ chosen[-1])
    refs = np.array(chosen)
    for _ in range(rounds):
        cell = (unit @ refs.T).argmax(axis=1)
        for c in range(len(refs)):
            mean = unit[cell == c].sum(axis=0)
            size = np.linalg.norm(mean)
            if size > 1e-9:
                refs[c] = mean / size
    return refs


def angles(vectors: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Angles (rows, directions); a zero vector stands at a right angle to all, and its bounds are 0 by its norm."""
    width = max(vectors.shape[1], refs.shape[1])
    v = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
    r = np.pad(refs, ((0, 0), (0, width - refs.shape[1])))
    norms = np.linalg.norm(v, axis=1, keepdims=True)
    cosine = (v @ r.T) / np.where(norms > 0, norms, 1) / np.linalg.norm(r, axis=1)
    return np.arccos(np.clip(cosine, -1, 1))


def score_bounds(theta, norm, low, high, norm_low, norm_high):
    """(least, greatest) score of anchors (theta: rows x directions) with sets of rows, given the extremes of the sets'
    angles (sets x directions) and norms: two arrays of anchors x sets."""
    near = np.zeros((len(theta), len(low)))
    far = np.full((len(theta), len(low)), np.pi)
    for r in range(theta.shape[1]):
        t = theta[:, r, None]
        near = np.maximum(near, np.maximum(t - high[None, :, r], low[None, :, r] - t))
        far = np.minimum(far, t + high[None, :, r])
    most, least = np.cos(np.maximum(near - SLACK, 0)), np.cos(np.minimum(far + SLACK, np.pi))
    top = norm[:, None] * np.where(most > 0, norm_high, norm_low) * most
    bottom = norm[:, None] * np.where(least < 0, norm_high, norm_low) * least
    return bottom - 1 - np.abs(bottom) * 1e-9, top + 1 + np.abs(top) * 1e-9


# ---------------------------------------------------------------- index
_VECTORS = "row long, id long, label long, q binary, norm double"
_ANCHOR = "a_row long, a_id long, a_label long, a_cell int, a_norm double, a_q binary, a_angles binary"


def _quantise(batches):
    for batch in batches:
        here, values, offsets = quantised(batch.column(3))
        rows = np.flatnonzero(here)
        whole = values.astype(np.int64, copy=False) if not len(rows) else np.clip(values, -2.0 ** 31, 2.0 ** 31 - 1).astype("<i4")
        norm = np.sqrt(tv_sums(values * values, offsets))[rows]
        packed = [whole[offsets[i]: offsets[i + 1]].tobytes() for i in rows]
        kept = batch.select([0, 1, 2]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(packed, pa.binary()), pa.array(norm)], ["row", "id", "label", "q", "norm"])


def _placed(refs):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            theta = angles(matrix(batch.column(3).to_pylist()), refs).astype("<f4")
            cells = theta.argmin(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells), pa.array([t.tobytes() for t in theta], pa.binary())],
                [*batch.schema.names, "cell", "angles"])
    return run


def _extremes(batches):
    """One row a cell and direction of each task: rows, extremes of angle and norm."""
    seen: dict = {}
    for batch in batches:
        theta = np.frombuffer(b"".join(batch.column("angles").to_pylist()), dtype="<f4").reshape(batch.num_rows, -1) if batch.num_rows else None
        cells, norms = np.asarray(batch.column("cell")), np.asarray(batch.column("norm"))
        for c in np.unique(cells):
            at = cells == c
            new = [at.sum(), theta[at].min(axis=0), theta[at].max(axis=0), norms[at].min(), norms[at].max()]
            old = seen.get(c)
            seen[c] = new if old is None else [old[0] + new[0], np.minimum(old[1], new[1]), np.maximum(old[2], new[2]), min(old[3], new[3]), max(old[4], new[4])]
    rows = [(int(c), r, int(n), float(lo[r]), float(hi[r]), float(a), float(b)) for c, (n, lo, hi, a, b) in seen.items() for r in range(len(lo))]
    yield pa.RecordBatch.from_pylist([dict(zip("cell ref n lo hi small large".split(), x)) for x in rows], pa.schema(
        [("cell", pa.int32()), ("ref", pa.int32()), ("n", pa.int64()), *((k, pa.float64()) for k in ("lo", "hi", "small", "large"))]))


class Index:
    """Rows with their cells, chunks and angles in the shared folder, and the cells' extremes (a fixed number)."""

    def __init__(self, vectors: DataFrame, id: str, vector: str, label: str):
        given = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                               F.col(vector).alias("v"))
        whole = stored(given.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").mapInArrow(_quantise, _VECTORS), "vectors")
        sample = whole.orderBy(F.xxhash64("id"), "row").limit(SAMPLE).select("q").collect()
        self.refs = directions(matrix([bytes(r.q) for r in sample])) if sample else np.ones((1, 1))
        placed = stored(whole.mapInArrow(_placed(self.refs), f"{_VECTORS}, cell int, angles binary"), "placed")
        told = (placed.mapInArrow(_extremes, "cell int, ref int, n long, lo double, hi double, small double, large double")
                .groupBy("cell", "ref").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("small").alias("small"),
                                            F.max("large").alias("large")).orderBy("cell", "ref").collect())  # at most REFERENCES ** 2 rows
        self.cells = sorted({r.cell for r in told})
        n = len(self.refs)
        grid = lambda name: np.array([r[name] for r in told], dtype=float).reshape(-1, n)
        self.low, self.high, self.small, self.large = grid("lo"), grid("hi"), grid("small")[:, 0] if told else np.zeros(0), grid("large")[:, 0] if told else np.zeros(0)
        self.chunks = {r.cell: -(-r.n // CHUNK) for r in told}
        dealt = F.element_at(F.create_map(*(F.lit(x) for c in self.cells for x in (c, self.chunks[c]))), F.col("cell")) if told else F.lit(1)
        self.rows = placed.withColumn("chunk", F.pmod(F.xxhash64("row"), dealt).cast("int"))


def _route(index: Index, own: bool):
    """Send anchors to chunks: those of their own cell, or of the other cells whose interval meets a window."""
    cells, place = np.array(index.cells), {c: k for k, c in enumerate(index.cells)}
    low, high, small, large, n_chunks = index.low, index.high, index.small, index.large, [index.chunks[c] for c in index.cells]

    def run(batches):
        for batch in batches:
            home = np.array([place[c] for c in batch.column("a_cell").to_pylist()], dtype=np.int64)
            if own:
                meets = home[:, None] == np.arange(len(cells))
            elif batch.num_rows:
                theta = np.frombuffer(b"".join(batch.column("a_angles").to_pylist()), dtype="<f4").reshape(batch.num_rows, -1).astype(float)
                least, most = score_bounds(theta, np.asarray(batch.column("a_norm")), low, high, small, large)
                bottom = np.array([min(x) for x in batch.column("lows").to_pylist()], dtype=float)
                top = np.array([max(x) for x in batch.column("highs").to_pylist()], dtype=float)
                meets = (most >= bottom[:, None]) & (least <= top[:, None])
                meets[np.arange(len(home)), home] = False
            else:
                continue
            for c in range(len(cells)):
                at = np.flatnonzero(meets[:, c])
                for chunk in range(n_chunks[c] if len(at) else 0):
                    sent = batch.take(pa.array(at, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [*sent.columns, pa.array(np.full(len(at), cells[c], dtype=np.int32)), pa.array(np.full(len(at), chunk, dtype=np.int32))],
                        [*batch.schema.names, "cell", "chunk"])
    return run


_FOUND = "a_row long, slot int, b_row long, b_id long, score long"


def _score(same: bool, k: int):
    """Best k rows of a chunk for each window of each anchor that was sent there."""
    empty = pa.schema([("a_row", pa.int64()), ("slot", pa.int32()), ("b_row", pa.int64()), ("b_id", pa.int64()), ("score", pa.int64())])

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return empty.empty_table()
        theta_b = np.frombuffer(b"".join(rows["angles"].to_pylist()), dtype="<f4").reshape(rows.num_rows, -1)
        order = np.argsort(theta_b[:, rows["cell"][0].as_py()], kind="stable")
        theta_b, rows = theta_b[order].astype(float), rows.take(pa.array(order))
        heads = np.arange(0, rows.num_rows, GRANULE)
        low, high = np.minimum.reduceat(theta_b, heads, axis=0), np.maximum.reduceat(theta_b, heads, axis=0)
        norm_b = rows["norm"].to_numpy()
        small, large = np.minimum.reduceat(norm_b, heads), np.maximum.reduceat(norm_b, heads)
        b, b_row, b_id, b_label = matrix(rows["q"].to_pylist()), rows["row"].to_numpy(), rows["id"].to_numpy(), rows["label"].to_numpy()
        out = [[], [], [], [], []]
        for at in range(0, anchors.num_rows, TOGETHER):
            some = anchors.slice(at, TOGETHER)
            a = matrix(some["a_q"].to_pylist(), b.shape[1])
            wide = np.pad(b, ((0, 0), (0, a.shape[1] - b.shape[1]))) if a.shape[1] > b.shape[1] else b
            theta = np.frombuffer(b"".join(some["a_angles"].to_pylist()), dtype="<f4").reshape(len(a), -1).astype(float)
            norm, a_row, a_label = some["a_norm"].to_numpy(), some["a_row"].to_numpy(), some["a_label"].to_numpy()
            slots, lows, highs = (some[c].to_pylist() for c in ("slots", "lows", "highs"))
            least, most = score_bounds(theta, norm, low, high, small, large)
            meets = (most >= np.array([min(x) for x in lows], dtype=float)[:, None]) & (least <= np.array([max(x) for x in highs], dtype=float)[:, None])
            exact = norm.max() * norm_b.max() < 2.0 ** 52
            scores = np.full((len(a), len(b)), _NONE, dtype=np.int64)
            for g, lo in enumerate(heads):
                who = np.flatnonzero(meets[:, g])
                if len(who):
                    part = wide[lo: lo + GRANULE]
                    scores[who, lo: lo + GRANULE] = (a[who] @ part.T if exact else a[who].astype(np.int64) @ part.T.astype(np.int64)).astype(np.int64)
            other = (a_label[:, None] != b_label) if same else (a_label[:, None] == b_label)
            scores[other] = _NONE
            scores[a_row[:, None] == b_row] = _NONE
            for x in range(len(a)):
                s = scores[x]
                for slot, bottom, top in zip(slots[x], lows[x], highs[x]):
                    fit = np.flatnonzero((s >= bottom) & (s <= top) & (s != _NONE))
                    if len(fit) > k:
                        kth = np.partition(s[fit], len(fit) - k)[len(fit) - k]
                        fit = fit[s[fit] >= kth]
                    fit = fit[np.lexsort((b_row[fit], b_id[fit], -s[fit]))][:k]
                    for column, values in zip(out, (np.full(len(fit), a_row[x]), np.full(len(fit), slot, dtype=np.int32), b_row[fit], b_id[fit], s[fit])):
                        column.append(values)
        return pa.Table.from_arrays([pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(out, empty)], schema=empty)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("a_row", "slot").orderBy(F.desc("score"), "b_id", "b_row"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def search(index: Index, anchors: DataFrame, same: bool, k: int, n_anchors: int) -> DataFrame:
    """(a_row, slot, rank, b_row, b_id, score): the first k rows of each window of each anchor.

    ``anchors`` has the columns of ``_ANCHOR`` and arrays slots, lows and highs (one window each); rows of the anchor's
    own label take part if ``same``, else the others.
    """
    blocks = -(-n_anchors // CHUNK) or 1
    schema = f"{_ANCHOR}, slots array<int>, lows array<long>, highs array<long>, cell int, chunk int"
    rows = index.rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) if blocks > 1 else index.rows.withColumn("block", F.lit(0))
    key = ["cell", "chunk", "block"]

    def visit(who: DataFrame, own: bool) -> DataFrame:
        sent = who.mapInArrow(_route(index, own), schema).withColumn("block", F.pmod(F.xxhash64("a_row"), F.lit(blocks)).cast("int"))
        return stored(sent.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(_score(same, k), _FOUND), "found")

    first = visit(anchors, True)
    # The k-th best so far is a lower end for the rest.
    kth = _best(first, k).where(F.col("rank") == k).groupBy("a_row").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("kth"))
    raised = anchors.join(kth, "a_row", "left").withColumn(
        "lows", F.zip_with("slots", "lows", lambda s, low: F.greatest(low, F.coalesce(F.try_element_at(F.col("kth"), s), low)))).drop("kth")
    rest = visit(raised.select(*anchors.columns), False)
    return _best(first.union(rest), k)


def mine(vectors: DataFrame, anchors: Column | str, id: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """One row a hard negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on the column ``id``. A positive is one of the anchor's first rows of equal label, a
    negative one of the first rows of another label with low * p <= 100 * score <= high * p, p the positive's score.
    """
    index = Index(vectors, id, vector, label)
    chosen = F.expr(anchors) if isinstance(anchors, str) else anchors
    picked = index.rows.withColumnRenamed("id", id).where(chosen).withColumnRenamed(id, "id")
    who = stored(picked.select(*(F.col(c).alias(f"a_{c}") for c in ("row", "id", "label", "cell", "norm", "q", "angles"))), "anchors")
    n = who.count()
    every = who.select("*", F.array(F.lit(0)).alias("slots"), F.array(F.lit(-_ANY)).alias("lows"), F.array(F.lit(_ANY)).alias("highs"))
    best = stored(search(index, every, True, positives, n), "positives").select(
        "a_row", F.col("rank").alias("slot"), F.col("b_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # ceil(low * p / 100) and floor(high * p / 100): a window is empty where p is negative.
    p = F.col("positive_score")
    windows = best.where(p >= 0).groupBy("a_row").agg(F.sort_array(F.collect_list(F.struct(
        "slot", F.expr(f"(positive_score * {low} + 99) div 100").alias("lo"), F.expr(f"positive_score * {high} div 100").alias("hi")))).alias("w"))
    asked = stored(who.join(windows, "a_row").select(*who.columns, F.col("w.slot").alias("slots"), F.col("w.lo").alias("lows"), F.col("w.hi").alias("highs")), "windows")
    found = search(index, asked, False, negatives, n)
    return (found.join(best, ["a_row", "slot"]).join(who.select("a_row", "a_id"), "a_row").select(
        F.col("a_id").alias("anchor_id"), "positive_id", "rank", F.col("b_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
