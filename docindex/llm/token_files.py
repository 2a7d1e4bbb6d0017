"""Token ids in raw binary shards with a minimal perfect hash index.

Format of a store (a folder in the shared file system):

* ``NNNNN.ids``  the ids of the shard's documents, end to end, little-endian, 2 bytes an id if the vocabulary has at
  most 65,536 entries, else 4; nothing else;
* ``NNNNN.docs`` an Arrow file, one row a document in payload order: key, first id within the shard, number of ids;
* ``NNNNN.mph``  the index: bit arrays of a cascade of hash levels, rank checkpoints, and for each slot the stored
  32-bit fingerprint and the document's row;
* the manifest, returned as a table: one row a shard with its least and greatest key, documents, ids and id width.

Documents are range-partitioned by (key, text hash) and sorted, so shards follow each other in ascending key order, a
null key first; a key that repeats many times can span shards. A task writes its shard's three files under
temporary names and renames them at its end, so a retried or speculative task rewrites the same bytes and a lost
executor loses nothing.

Index: at each level every key still without a place is hashed into twice as many bits as keys; keys alone on their
bit get it, the others go on. A key's slot is the rank of its bit: constant expected time, about six bits a key,
plus the fingerprint that tells absent keys and the row. A key that stands on several documents of a shard is indexed once, at
its first; ``lookup`` reads on from there. Null keys are stored but not indexed. Two different keys with one 64-bit
hash never separate; after ``LEVELS`` they are listed in the index by their row.

Null and empty texts are the end id alone; repeated rows are documents of their own; an empty table gives a store
without shards; other columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from docindex.llm import textvec as tv, tokens
from docindex.operators.rank import range_partitions
from docindex.session import scratch_path

END, LEVELS, GAMMA = 0, 48, 2
_MAGIC = b"MPHIDX01"
_G = np.uint64(0x9E3779B97F4A7C15)
_SALTS = np.arange(1, LEVELS + 1, dtype=np.uint64) * _G


# ---------------------------------------------------------------- minimal perfect hash
def key_hashes(keys: pa.Array) -> np.ndarray:
    """64-bit hashes of an array of keys (integers or strings, without nulls)."""
    if pa.types.is_integer(keys.type):
        return tv.mix(keys.cast(pa.int64()).to_numpy().view(np.uint64) + _G)
    data, offsets = tv.string_buffers(keys.cast(pa.large_string()))
    base = offsets[0]
    return tv.span_hashes(data[base: offsets[-1]], offsets[:-1] - base, offsets[1:] - base)


def _at(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    return (tv.mix(hashes ^ _SALTS[level]) % np.uint64(bits)).astype(np.int64)


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (tv.mix(hashes + np.uint64(77)) >> np.uint64(32)).astype(np.uint32)


def build_index(hashes: np.ndarray, rows: np.ndarray) -> bytes:
    """The serialised index of distinct keys, given as hashes and the row of each."""
    levels, left, own = [], hashes, rows
    slots_hash, slots_row = [], []
    with np.errstate(over="ignore"):
        for level in range(LEVELS):
            if not len(left):
                break
            bits = -(-len(left) * GAMMA // 64) * 64
            at = _at(left, level, bits)
            alone = np.bincount(at, minlength=bits) == 1
            placed = alone[at]
            order = np.argsort(at[placed])
            slots_hash.append(left[placed][order])
            slots_row.append(own[placed][order])
            levels.append(alone)
            left, own = left[~placed], own[~placed]
        words = [np.packbits(x, bitorder="little").view("<u8") for x in levels]
        all_words = np.concatenate(words) if words else np.zeros(0, dtype="<u8")
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(all_words).astype(np.int64))])[: len(all_words)]
        prints = _fingerprints(np.concatenate(slots_hash)) if slots_hash else np.zeros(0, dtype=np.uint32)
    docs = np.concatenate(slots_row) if slots_row else np.zeros(0, dtype=np.int64)
    head = np.array([len(levels), len(docs), len(own), *(len(x) for x in levels)], dtype="<i8")
    return b"".join([_MAGIC, head.tobytes(), all_words.tobytes(), ranks.astype("<i8").tobytes(), prints.astype("<u4").tobytes(),
                     docs.astype("<i8").tobytes(), left.astype("<u8").tobytes(), own.astype("<i8").tobytes()])


class Index:
    """A serialised index, searched in place."""

    def __init__(self, raw: bytes):
        if raw[:8] != _MAGIC:
            raise ValueError("not an index file")
        n_levels, n_docs, n_rest = np.frombuffer(raw, "<i8", 3, 8)
        self.sizes = np.frombuffer(raw, "<i8", n_levels, 32)
        at = 32 + 8 * n_levels
        n_words = int(self.sizes.sum()) // 64

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self.words, self.ranks = take("<u8", n_words), take("<i8", n_words)
        self.prints, self.docs = take("<u4", n_docs), take("<i8", n_docs)
        self.rest_hashes, self.rest_docs = take("<u8", n_rest), take("<i8", n_rest)

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of the documents with these key hashes, -1 where the fingerprint says that the key is not there."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        left, base = np.arange(len(hashes)), 0
        prints = _fingerprints(hashes)
        for level, bits in enumerate(self.sizes):
            at = _at(hashes[left], level, int(bits)).astype(np.int64)
            words, bit = self.words[base + at // 64], (at % 64).astype(np.uint64)
            here = (words >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(words & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            slot = (self.ranks[base + at // 64] + below)[here]
            found = left[here]
            out[found] = np.where(self.prints[slot] == prints[found], self.docs[slot], -1)
            left, base = left[~here], base + int(bits) // 64
        if len(left) and len(self.rest_hashes):
            order = np.argsort(self.rest_hashes)
            at = np.minimum(np.searchsorted(self.rest_hashes[order], hashes[left]), len(order) - 1)
            out[left] = np.where(self.rest_hashes[order][at] == hashes[left], self.rest_docs[order][at], -1)
        return out

    def row(self, key_hash: int) -> int:
        """Row of the document with this key's hash, or -1."""
        h = np.array([key_hash], dtype=np.uint64)
        base = 0
        for level, bits in enumerate(self.sizes):
            at = int(_at(h, level, int(bits))[0])
            word, bit = base + at // 64, at % 64
            if int(self.words[word]) >> bit & 1:
                slot = int(self.ranks[word]) + (int(self.words[word]) & ((1 << bit) - 1)).bit_count()
                return int(self.docs[slot]) if self.prints[slot] == _fingerprints(h)[0] else -1
            base += int(bits) // 64
        found = np.flatnonzero(self.rest_hashes == h[0])
        return int(self.rest_docs[found[0]]) if len(found) else -1


# ---------------------------------------------------------------- files
def _files(root: str):
    from pyarrow import fs

    if root.startswith("file:/") and not root.startswith("file://"):
        root = "file://" + root[5:]
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


def write(docs: DataFrame, root: str | None = None, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
          end: int = END, shards: int | None = None) -> tuple[str, list]:
    """Write a store; returns its folder and the manifest, a list of rows in key order (one a shard).

    ``shards`` defaults to one for each 256 MB of input, and to the session's number of shuffle partitions at least; a
    shard's memory in a task is its documents' keys and offsets (24 bytes a document), never its ids.
    """
    spark = docs.sparkSession
    root = root or scratch_path(spark, "token-files")
    path = tokenizer or tokens.default_path()
    n = shards or range_partitions(docs)

    def put(batches):
        context, shard = TaskContext.get(), TaskContext.get().partitionId()
        files, folder = _files(root)
        temp = f"{folder}/.{shard:05d}-{context.taskAttemptId()}"
        out, keys, counts, width = None, [], [], 2
        for batch in batches:
            if not batch.num_rows:
                continue
            coder = tokens.encoder(path)
            width = coder.width
            if out is None:
                files.create_dir(folder, recursive=True)
                out = files.open_output_stream(f"{temp}.ids")
            keys.append(batch.column(0))
            for _, _, buf, offsets in tv.chunks(batch.column(1), tokens.CHUNK_BYTES):
                ids, bounds = coder.ids(buf, offsets)
                out.write(np.insert(ids, bounds[1:], end).tobytes())
                counts.append(np.diff(bounds) + 1)
        schema = pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()),
                            ("least", pa.string()), ("greatest", pa.string())])
        if out is None:
            return
        out.close()
        keys = pa.chunked_array(keys).combine_chunks()
        counts = np.concatenate(counts)
        starts = np.cumsum(counts) - counts
        table = pa.table({"key": keys, "start": starts, "length": counts})
        with files.open_output_stream(f"{temp}.docs") as sink, pa.ipc.new_file(sink, table.schema) as ipc:
            ipc.write_table(table, max_chunksize=10_000)
        known = np.flatnonzero(keys.is_valid().to_numpy(zero_copy_only=False))
        some = keys.take(pa.array(known))
        hashes = key_hashes(some)
        new = np.ones(len(some), dtype=bool)
        new[1:] = hashes[1:] != hashes[:-1]  # sorted by key: repeats stand together
        with files.open_output_stream(f"{temp}.mph") as sink:
            sink.write(build_index(hashes[new], known[new]))
        for kind in ("ids", "docs", "mph"):
            files.move(f"{temp}.{kind}", f"{folder}/{shard:05d}.{kind}")
        ends = [str(some[i]) if len(some) else None for i in (0, -1)]
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((shard, len(keys), int(counts.sum()), width, *ends), schema)], schema=schema)

    order = [F.col(key).asc_nulls_first(), F.xxhash64(F.col(text))]
    dealt = docs.select(F.col(key), F.col(text)).repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = dealt.mapInArrow(tokens.returning(put), "shard int, n_docs long, n_ids long, width int, least string, greatest string").collect()
    return root, sorted(rows, key=lambda r: r["shard"])  # one row a shard


def _resolved(index: Index, keys: pa.Array, first: int, last_key, last_row: int) -> np.ndarray:
    """The row of each key of a batch of documents (rows ``first`` on), found through the index.

    The index knows the first row of a key; further rows of it follow one another. Null keys are not indexed and
    stand in order at the front of a shard. ``last_key`` and ``last_row`` are those of the document before the batch.
    """
    own = np.arange(first, first + len(keys))
    known = np.asarray(keys.is_valid())
    hashes = key_hashes(keys.filter(pa.array(known)))
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    rows = np.zeros(len(hashes), dtype=np.int64)
    rows[new] = index.rows(hashes[new])
    heads = np.flatnonzero(new)
    run = np.arange(len(hashes)) - np.repeat(heads, np.diff(np.append(heads, len(hashes))))
    rows = np.repeat(rows[new], np.diff(np.append(heads, len(hashes)))) + run
    out = own.copy()
    out[known] = rows
    if len(hashes) and last_key is not None and keys[0].as_py() == last_key:  # a key that goes on from the batch before
        going = int(np.argmax(np.append(new[1:], True))) + 1
        out[:going] = last_row + 1 + np.arange(going)
    return out


def read(spark: SparkSession, root: str, manifest: list, key: str = "doc_id", kind: str = "long", with_ids: bool = False) -> DataFrame:
    """One row a document, from the files: key, start (over the whole store), n_tokens, ids_crc32[, ids].

    Each shard's keys are resolved to their rows through its index, and the payload is read at the offsets of those rows.
    """
    bases, total = {}, 0
    for r in manifest:
        bases[r["shard"]] = (total, r["width"])
        total += r["n_ids"]
    extra = ", ids binary" if with_ids else ""

    def get(batches):
        files, folder = _files(root)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                base, width = bases[shard]
                with files.open_input_file(f"{folder}/{shard:05d}.mph") as f:
                    index = Index(f.read())
                with files.open_input_file(f"{folder}/{shard:05d}.docs") as source, files.open_input_file(f"{folder}/{shard:05d}.ids") as payload:
                    ipc, row, last_key = pa.ipc.open_file(source), 0, None
                    for k in range(ipc.num_record_batches):
                        rows = ipc.get_batch(k)
                        found = _resolved(index, rows.column(0), row, last_key, row - 1)
                        if (found != np.arange(row, row + rows.num_rows)).any():
                            raise ValueError(f"the index of shard {shard} does not lead to its documents")
                        row, last_key = row + rows.num_rows, rows.column(0)[rows.num_rows - 1].as_py() if rows.num_rows else last_key
                        lengths, starts = rows.column(2).to_pylist(), rows.column(1).to_pylist()
                        # The documents of a batch stand together: one read, cut at each document's offset.
                        whole = memoryview(payload.read_at((starts[-1] + lengths[-1] - starts[0]) * width, starts[0] * width)) if lengths else b""
                        raw = [bytes(whole[(p - starts[0]) * width: (p - starts[0] + n) * width]) for p, n in zip(starts, lengths)]
                        sums = [zlib.crc32(np.frombuffer(x, f"<u{width}").astype("<u4").tobytes()) for x in raw]
                        columns = [rows.column(0), pa.array(rows.column(1).to_numpy() + base), rows.column(2), pa.array(sums, pa.int64())]
                        names = [key, "start", "n_tokens", "ids_crc32"]
                        for lo in range(0, rows.num_rows, 1000) if with_ids else [0]:
                            hi = min(lo + 1000, rows.num_rows) if with_ids else rows.num_rows
                            more = [pa.array(raw[lo:hi], pa.binary())] if with_ids else []
                            yield pa.RecordBatch.from_arrays([c.slice(lo, hi - lo) for c in columns] + more, names + ["ids"] * with_ids)

    schema = f"`{key}` {kind}, start long, n_tokens long, ids_crc32 long{extra}"
    if not manifest:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame([(r["shard"],) for r in manifest], "shard int").repartition(len(manifest), "shard")
    return listed.mapInArrow(tv.returning(get), schema)


def lookup(root: str, manifest: list, key) -> list:
    """The ids of every document with this key, by index: no scan of a shard."""
    files, folder = _files(root)
    typed = pa.array([key])
    wanted, out = int(key_hashes(typed)[0]), []
    order = (lambda x: int(x)) if pa.types.is_integer(typed.type) else (lambda x: x.encode())
    for r in manifest:
        if r["least"] is None or not order(r["least"]) <= order(str(key)) <= order(r["greatest"]):
            continue
        with files.open_input_file(f"{folder}/{r['shard']:05d}.mph") as f:
            row = Index(f.read()).row(wanted)
        if row < 0:
            continue
        width = r["width"]
        with files.open_input_file(f"{folder}/{r['shard']:05d}.docs") as source, files.open_input_file(f"{folder}/{r['shard']:05d}.ids") as payload:
            ipc = pa.ipc.open_file(source)
            while row < r["n_docs"]:
                block = ipc.get_batch(row // 10_000)
                at = row % 10_000
                if block.column(0)[at].as_py() != key:
                    break
                start, length = block.column(1)[at].as_py(), block.column(2)[at].as_py()
                out.append(np.frombuffer(payload.read_at(length * width, start * width), f"<u{width}").astype(np.uint32))
                row += 1
    return out


def lookup_all(keys: DataFrame, root: str, manifest: list, key: str = "doc_id") -> DataFrame:
    """Rows (key, nr, ids as little-endian of the store's width) of every document with one of the keys.

    Each key goes to the shards whose range holds it; a task loads an index once a shard and reads each document at its
    offset, so the cost follows the keys that are asked for.
    """
    spark, kind = keys.sparkSession, keys.schema[key].dataType
    if not manifest:
        return spark.createDataFrame([], f"`{key}` {kind.simpleString()}, nr int, ids binary")
    whole = kind.typeName() in ("long", "integer", "short", "byte")
    ends = spark.createDataFrame([(r["shard"], r["least"], r["greatest"], r["n_docs"], r["width"]) for r in manifest if r["least"] is not None],
                                 "shard int, least string, greatest string, n_docs long, width int")  # one row a shard
    lo, hi = (F.col(c).cast("long") if whole else F.col(c) for c in ("least", "greatest"))
    asked = keys.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    dealt = asked.join(F.broadcast(ends), F.col(key).between(lo, hi)).select(key, "shard", "n_docs", "width").repartition("shard").sortWithinPartitions("shard")

    def get(batches):
        files, folder = _files(root)
        now, opened = None, []
        try:
            for batch in batches:
                out = ([], [], [])
                hashes = key_hashes(batch.column(0))
                for k, (wanted, shard, n_docs, width) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                    if shard != now:
                        for f in opened:
                            f.close()
                        with files.open_input_file(f"{folder}/{shard:05d}.mph") as f:
                            index = Index(f.read())
                        opened = [files.open_input_file(f"{folder}/{shard:05d}.{x}") for x in ("docs", "ids")]
                        now, ipc = shard, pa.ipc.open_file(opened[0])
                    row, nr = int(index.rows(hashes[k: k + 1])[0]), 0
                    while 0 <= row < n_docs:
                        block, at = ipc.get_batch(row // 10_000), row % 10_000
                        if block.column(0)[at].as_py() != wanted:
                            break
                        start, length = block.column(1)[at].as_py(), block.column(2)[at].as_py()
                        for column, value in zip(out, (wanted, nr, opened[1].read_at(length * width, start * width))):
                            column.append(value)
                        row, nr = row + 1, nr + 1
                yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())], [key, "nr", "ids"])
        finally:
            for f in opened:
                f.close()

    return dealt.mapInArrow(tv.returning(get), f"`{key}` {kind.simpleString()}, nr int, ids binary")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Write a store in the shared folder and read every document back from its files."""
    root, manifest = write(docs, None, key, text, **options)
    return read(docs.sparkSession, root, manifest, key, docs.schema[key].dataType.simpleString())
