"""Packing of documents into sequences of at most ``size`` tokens, in bounded space.

Each input partition is read once and keeps at most ``WINDOWS`` open windows. Whole windows of a long document are
emitted at once; what is left goes to the open window that it fits best (the least room that is enough). If none fits
and all windows are open, the fullest one is topped up with the head of the piece (when there is room for
``MIN_PIECE`` tokens) and emitted, and the rest is placed anew. At the end of a partition its open windows are strung
together and cut at ``size``: at most one partial window a partition is left. Those leftovers are merged the same way
in groups of ``FAN_IN`` partitions, round by round, until one is left in all; a group is at most ``FAN_IN`` windows.

So padding is the rooms under ``MIN_PIECE`` tokens plus one last window, whatever the input. Nothing is shuffled but
the leftovers. Pieces, with their ids, are written to the shared folder once, and the leftovers are read from there.

Null and empty texts give a document of the end token alone; repeated rows and ids are packed as documents of their
own; an empty table gives no pieces; other columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docindex.llm import textvec as tv, tokens
from docindex.llm.scratch import stored

SIZE, END, WINDOWS, MIN_PIECE, FAN_IN = 2048, 1, 32, 16, 64
_COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "place", "left_over", "ids"]
_FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, place long, left_over boolean, ids binary"


class Packer:
    """Open windows of one partition. A piece is (key, start, ids, document's tokens)."""

    def __init__(self, size: int, windows: int, min_piece: int):
        self.size, self.limit, self.min_piece = size, windows, min_piece
        self.open: list = []  # [room, pieces]

    def add(self, key, ids: np.ndarray):
        """Place one document; yields the windows (lists of pieces) that are complete."""
        total, start = len(ids), 0
        while total - start >= self.size:
            yield [(key, start, ids[start: start + self.size], total)]
            start += self.size
        while start < total:
            need = total - start
            best = min((w for w in self.open if w[0] >= need), key=lambda w: w[0], default=None)
            if best is None and len(self.open) >= self.limit:
                best = min(self.open, key=lambda w: w[0])
                if best[0] >= self.min_piece:
                    best[1].append((key, start, ids[start: start + best[0]], total))
                    start += best[0]
                self.open.remove(best)
                yield best[1]
                continue
            if best is None:
                best = [self.size, []]
                self.open.append(best)
            best[1].append((key, start, ids[start:], total))
            best[0] -= need
            start = total
            if not best[0]:
                self.open.remove(best)
                yield best[1]

    def rest(self):
        """The open windows' pieces, fullest window first."""
        pieces = [p for w in sorted(self.open, key=lambda w: w[0]) for p in w[1]]
        self.open = []
        return pieces


def strung(pieces, size: int):
    """Cut a stream of pieces into windows of ``size`` tokens; only the last one can be shorter."""
    window, room = [], size
    for key, start, ids, total in pieces:
        while len(ids):
            window.append((key, start, ids[:room], total))
            start, ids, room = start + len(window[-1][2]), ids[room:], room - len(window[-1][2])
            if not room:
                yield window
                window, room = [], size
    if window:
        yield window


def _batch(rows: list, key_field: pa.Field) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * (len(_COLUMNS) + 1)
    types = [key_field.type, *[pa.int64()] * 7, pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [key_field.name, *_COLUMNS])


def _rows(window, sequence: int, left_over: bool):
    offset = 0
    for key, start, ids, total in window:
        yield (key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset, sequence, left_over, ids.tobytes())
        offset += len(ids)


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None, size: int = SIZE, end: int = END,
           windows: int = WINDOWS, min_piece: int = MIN_PIECE) -> DataFrame:
    """One row a piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (little-endian, of the tokenizer's width)."""
    path = tokenizer or tokens.default_path()

    def pack(batches):
        own, packer = TaskContext.get().partitionId() << 32, Packer(size, windows, min_piece)
        made, rows, field, total = 0, [], None, 0
        for batch in batches:
            coder, field = tokens.encoder(path), batch.schema.field(0)
            keys = batch.column(0).to_pylist()
            for lo, hi, buf, offsets in tv.chunks(batch.column(1), tokens.CHUNK_BYTES):
                all_ids, bounds = coder.ids(buf, offsets)
                bounds = bounds.tolist()
                for i in range(hi - lo):
                    ids = np.append(all_ids[bounds[i]: bounds[i + 1]], np.array([end], dtype=coder.dtype))
                    for window in packer.add(keys[lo + i], ids):
                        rows += _rows(window, own + made, False)
                        made += 1
                if len(rows) >= 500:
                    yield _batch(rows, field)
                    rows = []
        for window in strung(packer.rest(), size):
            total = sum(len(p[2]) for p in window)
            rows += _rows(window, own + made, total < size)
            made += 1
        if rows:
            yield _batch(rows, field)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {_FIELDS}"
    done = stored(docs.select(F.col(key), F.col(text)).mapInArrow(tokens.returning(pack), schema), "pieces")
    out, left = done.where(~F.col("left_over")), done.where("left_over").withColumn("place", F.shiftright("place", 32))
    width = 0
    turn = 1
    while True:
        # ``place`` numbers the partition or group that a leftover comes from.
        groups = left.agg(F.max("place")).first()[0]
        if groups is None:
            break
        last = groups < FAN_IN
        if not width:
            width = 2 if left.select((F.length("ids") / F.col("length")).alias("w")).first()["w"] < 3 else 4

        def merge(batches, turn=turn, last=last, width=width):
            def close(group, number):
                made = 0
                for window in strung(group, size):
                    full = sum(len(p[2]) for p in window) == size
                    sequence = (turn << 56) + (number << 24) + made
                    for row in _rows(window, sequence, not full and not last):
                        yield row[:7] + (number,) + row[8:]
                    made += 1

            now, group, field = None, [], None
            for batch in batches:
                field, rows = batch.schema.field(1), []
                for number, k, start, total, raw in zip(*(batch.column(c).to_pylist() for c in range(5))):
                    if number != now and group:
                        rows += close(group, now)
                        group = []
                    now = number
                    group.append((k, start, np.frombuffer(raw, dtype=f"<u{width}"), total))
                if rows:
                    yield _batch(rows, field)
            if group:
                yield _batch(list(close(group, now)), field)

        dealt = (left.select(F.expr(f"place div {FAN_IN}").alias("number"), key, "start", "doc_tokens", "ids", "place", "sequence_id", "offset")
                 .repartition("number").sortWithinPartitions("number", "place", "sequence_id", "offset")
                 .select("number", key, "start", "doc_tokens", "ids"))
        merged = stored(dealt.mapInArrow(tv.returning(merge), schema), "merged")
        out = out.unionByName(merged.where(~F.col("left_over")))
        if last:
            break
        left, turn = merged.where("left_over"), turn + 1
    return out.drop("place", "left_over")


def sequences(packed: DataFrame) -> DataFrame:
    """One row a sequence: sequence_id, n_tokens, ids (its pieces' ids in order). A group is at most one window."""
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", "n_tokens", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids")))
