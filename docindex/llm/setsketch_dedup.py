"""Near-duplicate detection with SetSketch registers.

A document's set holds the hashes of its distinct word shingles. Its sketch has ``BANDS * ROWS`` one-byte
registers: register i is the truncated, exponentially spaced rank ``floor(1 - log_b x)`` of the least of the
exponential values that the set's elements give to i. Registers of a union are the register-wise maxima, and two
sets agree in a register about as often as their Jaccard similarity.

1. One pass over the texts leaves (id, set size, 128-bit set signature, registers). Equal sets are one class from
   here on, so exact copies never meet in pairs.
2. Classes that agree in all registers of a band share a bucket. In each bucket the class with most copies is the
   pivot, and every class is paired with the pivot that it meets most often: at most one pair a class.
   These pairs are confirmed on the full sets.
3. Buckets that still hold several components are searched in full: members are cut into blocks, and in every pair of
   blocks each pair of members in different components is estimated from both sketches and the two known set sizes by
   maximum likelihood. Pairs whose estimate is ``MARGIN`` (over four standard errors) under the threshold go, the rest is
   confirmed on the full sets. Nothing is capped; pairs that links found before already connect are skipped, since
   they add nothing, so a block pair returns at most a spanning forest.

Recall of banding at the threshold itself: 1 - (1 - 0.8**7)**48 = 0.99999, higher above it.

Cases: null or empty texts have an empty set and are linked with nothing; a text with fewer words than a shingle has
the whole sequence as its one shingle; an empty table gives an empty result. In the report, rows of one id with several
texts are one node, and a row with a null id is linked with nothing, has a null component and is kept. The filter
(``keep_one``) goes by rows instead, null ids and repeated ids included. Ids may be of any type that has an order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docindex.llm import textvec as tv
from docindex.llm.graph import components
from docindex.llm.scratch import stored

BANDS, ROWS = 48, 7
M = BANDS * ROWS
BASE, RATE, TOP = 1.1, 20.0, 255
THRESHOLD, SHINGLE, MARGIN = 80, 5, 0.1
BLOCK, ELEMENTS, SALTS = 512, 1 << 21, 64
_G = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.arange(1, 65, dtype=np.uint64) * _G  # up to 64 words a shingle
_BAND_MIX = tv.mix(np.arange(1, ROWS + 1, dtype=np.uint64) * _G) | np.uint64(1)


def shingle_sets(buf, offsets, size: int):
    """Distinct shingle hashes of each text of a chunk, ascending: (hashes, first index of each text (n + 1))."""
    buf = tv.LOWER[buf]
    starts, ends, first = tv.word_spans(buf, offsets)
    words, doc = tv.span_hashes(buf, starts, ends), tv.owners(first)
    key = np.zeros(len(words), dtype=np.uint64)
    have = np.diff(first)
    left = np.repeat(first[1:], have) - np.arange(len(words))  # words from here to the end of the text
    short = np.repeat(have < size, have)
    for k in range(size):
        at = np.arange(len(words)) + k
        inside = left > k
        key[inside] = tv.mix(key[inside] + words[at[inside]] + _STEP[k])
    whole = np.zeros(len(words), dtype=bool)
    whole[first[:-1][have > 0]] = True
    use = np.where(short, whole, left >= size)
    key, doc = key[use], doc[use]
    order = np.argsort(key, kind="stable")
    order = order[np.argsort(doc[order].astype(np.uint16 if len(offsets) < 65536 else np.int64), kind="stable")]
    key, doc = key[order], doc[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    key, doc = key[new], doc[new]
    return key, np.searchsorted(doc, np.arange(len(offsets)))


def sketches(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers (texts, M) of the sets.

    The values that one element gives to the M registers are the marks of a Poisson process: arrival times in
    ascending order, each falling on a random register. Arrivals are drawn up to a ceiling that leaves a register
    unreached in one set of exp(8); for those sets it is raised until every register is reached. Then each register
    holds the true least arrival, whatever the ceiling was, and the registers of a union are the maxima of its parts'.
    """
    n, sizes = len(first) - 1, np.diff(first)
    least = np.full(n * M, np.inf)
    todo, ceiling = np.flatnonzero(sizes), (np.log(M) + 8) / np.maximum(sizes, 1)
    while len(todo):
        doc = np.repeat(todo, sizes[todo])
        begin = np.cumsum(sizes[todo]) - sizes[todo]
        state = keys[np.repeat(first[todo] - begin, sizes[todo]) + np.arange(len(doc))]
        at, limit = np.zeros(len(state)), ceiling[doc]
        while len(state):
            state = state + _G
            draw = tv.mix(state)
            at = at - np.log(((draw >> np.uint64(12)).astype(np.float64) + 1) * 2.0 ** -52) / M
            alive = at < limit
            state, at, limit, doc, draw = state[alive], at[alive], limit[alive], doc[alive], draw[alive]
            np.minimum.at(least, doc * M + ((draw & np.uint64(0xFFF)) * np.uint64(M) >> np.uint64(12)).astype(np.int64), at)
        todo = todo[np.isinf(least.reshape(n, M)[todo]).any(axis=1)]
        ceiling = ceiling * 2
    with np.errstate(divide="ignore"):
        rank = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    return np.clip(np.where(np.isfinite(rank), rank, 0), 0, TOP).astype(np.uint8).reshape(n, M)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """(texts, BANDS) bucket keys."""
    parts = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    return tv.mix((tv.mix(parts + _G) * _BAND_MIX).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _G).view(np.int64)


def estimate(greater, less, size_a, size_b) -> np.ndarray:
    """Maximum-likelihood Jaccard similarities from counts of greater and lesser registers and the set sizes."""
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)
    equal = M - greater - less
    p = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)
    slope = lambda x: (BASE - 1) / BASE / (1 - x * (BASE - 1) / BASE) / np.log(BASE)
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):  # the likelihood is concave: bisect its derivative
        j = (lo + hi) / 2
        x, y = np.maximum(u - v * j, 1e-12), np.maximum(v - u * j, 1e-12)
        rise, fall = v * slope(x), u * slope(y)
        d = -greater * rise / p(x) - less * fall / p(y) + equal * (rise + fall) / np.maximum(1 - p(x) - p(y), 1e-12)
        lo, hi = np.where(d > 0, j, lo), np.where(d > 0, hi, j)
    return (lo + hi) / 2


def signature(keys: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit signature of each whole set, independent of order."""
    total = np.zeros(len(keys) + 1, dtype=np.uint64)
    np.cumsum(tv.mix(keys + np.uint64(salt)), out=total[1:])
    return tv.mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def sketch_table(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for lo, hi, buf, offsets in tv.chunks(batch.column(1)):
                keys, first = shingle_sets(buf, offsets, shingle)
                sizes, sig = np.diff(first), [signature(keys, first, salt) for salt in (1, 2)]
                regs = sketches(keys, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(sizes, pa.int64()), *(pa.array(s) for s in sig),
                     pa.array([r.tobytes() for r in regs], pa.binary())], ["id", "n", "node", "sig", "regs"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text)).mapInArrow(tv.returning(run), f"id {kind}, n long, node long, sig long, regs binary")


def set_table(docs: DataFrame, key: str, text: str, shingle: int, wanted: DataFrame) -> DataFrame:
    """(node, set) of the classes in ``wanted`` (node, rep): recomputed from the representative's text."""
    def run(batches):
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for lo, hi, buf, offsets in tv.chunks(batch.column(1)):
                keys, first = shingle_sets(buf, offsets, shingle)
                # A representative's id may stand on other texts too: only its own set's signature counts.
                mine = np.flatnonzero(signature(keys, first, 1) == nodes[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[lo:hi][mine], pa.int64()), pa.array([keys[first[i]: first[i + 1]].tobytes() for i in mine], pa.binary())], ["node", "set"])

    texts = docs.select(F.col(key).alias("rep"), F.col(text).alias("text")).join(wanted.select("node", "rep"), "rep")
    return stored(texts.select("node", "text").mapInArrow(tv.returning(run), "node long, set binary"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) with 100 * |A and B| >= threshold * |A or B| on full sets.

    Rows stream through sorted by (a, salt): first A's set, then its partners' sets, so a task holds two
    sets at a time, and a set with many partners is spread over ``SALTS`` tasks.
    """
    def run(batches):
        now, mine = None, None
        for batch in tv.few(batches):
            out = []
            for a, salt, is_b, b, raw in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if not is_b:
                    now, mine = (a, salt), np.frombuffer(raw, dtype=np.uint64)
                elif now == (a, salt):
                    other = np.frombuffer(raw, dtype=np.uint64)
                    shared = _shared(mine, other)
                    if 100 * shared >= threshold * (len(mine) + len(other) - shared):
                        out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    partners = salted.join(sets.withColumnRenamed("node", "b"), "b").select("a", "salt", F.lit(True).alias("is_b"), "b", "set")
    own = salted.select("a", "salt").distinct().join(sets.withColumnRenamed("node", "a"), "a").select("a", "salt", F.lit(False).alias("is_b"), F.col("a").alias("b"), "set")
    dealt = own.union(partners).repartition("a", "salt").sortWithinPartitions("a", "salt", "is_b")
    return dealt.mapInArrow(tv.returning(run), "a long, b long")


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` plus the root of each node; a node without links is its own root."""
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two ascending sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int((large[at] == small).sum())


def _cross_pairs(bucket: int, crossed: bool, root, size, side, regs, threshold: int):
    """(i, j, estimate) of the pairs of one group that lie in different components and pass the estimate.

    i runs over the members outside the group's largest component: every pair of two components has one there.
    A pair that also agrees in an earlier band is left to that band's bucket, which holds both members too.
    """
    keys = band_keys(regs)
    keys = keys[:, : int(np.argmax(keys[0] == bucket))]
    _, number = np.unique(root, return_inverse=True)
    left, right, greater, less = [], [], [], []
    count = lambda flags: np.bitwise_count(np.packbits(flags, axis=1)).sum(axis=1, dtype=np.int64)
    for i in np.flatnonzero(number != np.bincount(number).argmax()):
        other = np.flatnonzero((root != root[i]) & (100 * np.minimum(size, size[i]) >= threshold * np.maximum(size, size[i]))
                               & ((side != side[i]) if crossed else True))
        other = other[~(keys[other] == keys[i]).any(axis=1)]
        if not len(other):
            continue
        # Registers agree at least as often as sets do, so most pairs go by that count alone.
        other = other[count(regs[other] == regs[i]) >= M * (threshold / 100 - MARGIN - 0.04)]
        left.append(np.full(len(other), i))
        right.append(other)
        greater.append(count(regs[i] > regs[other]))
        less.append(count(regs[i] < regs[other]))
    if not sum(map(len, left)):
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0)
    left, right, greater, less = (np.concatenate(x) for x in (left, right, greater, less))
    j = estimate(greater, less, size[left].astype(float), size[right].astype(float))
    good = j * 100 >= threshold - 100 * MARGIN
    return left[good], right[good], j[good]


def searched(members: DataFrame, reps: DataFrame, sets: DataFrame, roots: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) between different components within a bucket, found block pair by block pair.

    Every pair of members in different components whose estimate is within the margin is confirmed on the full sets,
    best estimate first, unless links found before in the same group already connect it: a group returns at most a
    spanning forest. A block holds at most ``BLOCK`` members and about ``ELEMENTS`` set elements.
    """
    def close(place, group, out):
        side, node, root, size = (np.array([row[k] for row in group]) for k in range(4))
        regs = np.frombuffer(b"".join(row[4] for row in group), dtype=np.uint8).reshape(-1, M)
        left, right, j = _cross_pairs(place[0], place[1] != place[2], root, size, side, regs, threshold)
        parent: dict = {}

        def top(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        for k in np.argsort(-j, kind="stable"):
            x, y = left[k], right[k]
            rx, ry = top(root[x]), top(root[y])
            if rx != ry:
                a, b = (np.frombuffer(group[i][5], dtype=np.uint64) for i in (x, y))
                both = _shared(a, b)
                if 100 * both >= threshold * (len(a) + len(b) - both):
                    parent[rx] = ry
                    out.append((min(node[x], node[y]), max(node[x], node[y])))

    def run(batches):
        now, group, out = None, [], []
        as_batch = lambda found: pa.RecordBatch.from_arrays([pa.array([int(x[k]) for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])
        for batch in tv.few(batches):
            for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
                if row[:3] != now:
                    if group:
                        close(now, group, out)
                    now, group = row[:3], []
                group.append(row[3:])
            yield as_batch(out)
            out = []
        if group:
            close(now, group, out)
        yield as_batch(out)

    labelled = _labelled(members.select("bucket", "node", "n"), roots)
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("elements") / ELEMENTS)).cast("int")
    mixed = (labelled.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("elements"))
             .where("r0 <> r1").select("bucket", blocks.alias("blocks")))
    rows = (labelled.join(mixed, "bucket").join(reps.select("node", "regs"), "node").join(sets, "node")
            .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                    (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "root", "n", "regs", "set"))
    dealt = rows.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    return dealt.mapInArrow(tv.returning(run), "a long, b long")


def _least_ids(linked: DataFrame) -> DataFrame:
    """(node, least): the least id of the component of each node, from (node, rep, root).

    Only classes that have links look for it, and a large component is spread over ``SALTS`` tasks. The least id goes to
    the salts that occur in its component, at most one row a class. Spark takes the exploded table to be as small as
    what it was before, so the hint keeps it from being broadcast: the driver would hold all of it.
    """
    linked = linked.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    least = (linked.groupBy("root", "salt").agg(F.min("rep").alias("m")).groupBy("root").agg(F.min("m").alias("least"), F.collect_list("salt").alias("salts"))
             .select("root", "least", F.explode("salts").alias("salt")))
    return linked.join(least.hint("merge"), ["root", "salt"]).select("node", "least")


def classes(docs: DataFrame, key: str, text: str, shingle: int, threshold: int, join_ids: bool):
    """(sketch: id, n, node, sig, regs of every row with an id; classes: n, node, sig, component_id).

    Equal sets are one class; a component's id is the least id of its classes. With ``join_ids`` classes that share an
    id are linked as well.
    """
    sketch = stored(sketch_table(docs, key, text, shingle), "sketch")
    reps = stored(sketch.where("id is not null and n > 0").groupBy("n", "node", "sig")
                  .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("regs").alias("regs")), "classes")

    def bands(batches):
        for batch in batches:
            regs = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype=np.uint8).reshape(-1, M)
            for lo in range(0, len(regs), 2000):
                keys = band_keys(regs[lo: lo + 2000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), *(pa.array(np.repeat(batch.column(c).to_numpy()[lo: lo + 2000], BANDS)) for c in range(3))],
                    ["bucket", "node", "n", "copies"])

    banded = reps.select("node", "n", "copies", "regs").mapInArrow(tv.returning(bands), "bucket long, node long, n long, copies long")
    buckets = (banded.groupBy("bucket").agg(F.min(F.struct((-F.col("copies")).alias("c"), F.col("node").alias("p"))).alias("top"), F.count(F.lit(1)).alias("size"))
               .where("size > 1").select("bucket", F.col("top.p").alias("pivot")))
    members = stored(banded.select("bucket", "node", "n").join(buckets, "bucket"), "buckets")
    sets = set_table(docs, key, text, shingle, reps.join(members.select("node").distinct(), "node", "left_semi"))
    # The pivot that a class meets most often.
    votes = members.where("node <> pivot").groupBy("node", "pivot").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("node").agg(F.max(F.struct("votes", "pivot")).alias("m")).select(F.col("m.pivot").alias("a"), F.col("node").alias("b"))
    links = stored(confirmed(best, sets, threshold), "links")
    if join_ids:  # ids that stand in several classes link those classes
        ids = sketch.where("id is not null and n > 0").select("id", "node")
        several = ids.groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("x")).where("b <> x").select("id", "b")
        if not several.isEmpty():
            links = links.union(ids.join(several, "id").select(F.col("node").alias("a"), "b").where("a <> b").distinct())
    roots = components(links)
    rest = stored(searched(members, reps, sets, roots, threshold), "links")
    if not rest.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(rest))
    named = _least_ids(reps.select("node", "rep").join(roots, "node"))
    out = reps.select("n", "node", "sig", "rep").join(named, "node", "left")
    return sketch, out.select("n", "node", "sig", F.coalesce("least", "rep").alias("component_id"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    threshold: int = THRESHOLD) -> DataFrame:
    """One row a document: key, n_shingles, component_id (least id reachable over confirmed links), kept."""
    sketch, found = classes(docs, key, text, shingle, threshold, True)
    out = sketch.select("id", "n", "node", "sig").join(found, ["node", "sig", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each group stays, every column as it was.

    Rows are told apart by (id, 64-bit hash of the text), so a row goes by its own text: rows with a null id are
    deduplicated too, and unrelated texts under one id both stay. Of a group the row of the least id stays (a null id comes last),
    of equal ids the one of the least hash. Rows that are equal in both are copies of one another: one of them stays;
    texts without a set are groups of their own.
    """
    text_hash = F.xxhash64(F.col(text))
    # The order of rows as text: ids first, in their own order if they are integers, then the hash.
    kind = docs.schema[key].dataType.typeName()
    ordered = F.lpad((F.col(key).cast("decimal(20,0)") + F.expr(f"CAST('{10 ** 19}' AS DECIMAL(20,0))")).cast("string"), 20, "0") if kind in ("long", "integer", "short", "byte") else F.col(key).cast("string")
    row = F.concat(F.when(F.col(key).isNull(), "1").otherwise("0"), F.coalesce(ordered, F.lit("")), F.lit("|"), F.hex(text_hash))
    numbered = docs.select(row.alias("row"), F.col(text).alias("text"))
    sketch, found = classes(numbered, "row", "text", shingle, threshold, False)
    gone = (sketch.select(F.col("id").alias("_row"), "n", "node", "sig").join(found, ["node", "sig", "n"])
            .where(F.col("_row") != F.col("component_id")).select("_row").distinct())
    names = [c for c in docs.columns]
    left = docs.withColumn("_row", row).join(gone, "_row", "left_anti")
    # Of rows with one id and one text hash, one stays.
    return left.dropDuplicates(["_row"]).select(*[F.col(f"`{c}`") for c in names])
