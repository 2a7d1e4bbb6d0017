"""Byte-level BPE encoding and decoding by a rank queue over linked lists.

A text is cut into pre-tokens by a pattern; a pre-token that is in the vocabulary is one id, any other starts as its
bytes and merges, again and again, the neighbouring pair whose joined bytes have the lowest rank (the leftmost of
equals). The pairs wait in a queue made for that: one bucket of positions for every merge rank, and above the buckets
a bitmap in two levels in which find-first-set gives the lowest rank that has entries. Positions are links of a doubly
linked list, so a merge changes two neighbours and pushes at most two new pairs; an entry whose pair has changed since
is recognised by the rank kept at its position and skipped. A pre-token of n bytes costs n pushes and n merges at
most, however long it is. All unknown pre-tokens of a chunk of texts go through one queue together (their lists are not
linked to each other), and the ids of short ones are kept in a bounded table for the rest of the task.

One pass over the texts, no shuffle; texts are taken ``CHUNK_CHARS`` at a time, and longer ones are cut where a
pre-token is sure to start, so memory follows the chunk or the longest pre-token. Null and empty texts have no ids and
no bytes; repeated rows are encoded alike; other columns are left out.
"""

from __future__ import annotations

import base64
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docindex.llm import textvec as tv

CHUNK_CHARS = 1 << 20  # text whose pre-tokens are looked up together
TABLE = 400_000  # pre-tokens kept in a task, about 80 MB; a full table starts anew
KEPT_CHARS = 32  # longer pre-tokens are not kept
_AS_LISTS = 1 << 20  # bytes merged together
_BITS = 8  # ranks of one word of the lower bitmap level, as a power of two


class RankQueue:
    """Ranks (bytes to id) and the merges that they allow."""

    def __init__(self, ranks: dict):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.shift = max(ranks.values()).bit_length()
        self.pairs = {ranks[t[:k]] << self.shift | ranks[t[k:]]: r for t, r in ranks.items()
                      for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}
        # Ranks of two neighbouring bytes, by b1 * 256 + b2.
        self.first = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)], dtype=np.int32)

    def merge(self, pieces: list) -> list:
        """The ids of each byte string, as little-endian 32-bit integers."""
        lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        ends = np.cumsum(lengths)
        buf = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        if not len(buf):
            return [b""] * len(pieces)
        n = len(buf)
        ranked = np.full(n, -1, dtype=np.int32)  # rank of the pair that starts at a position
        ranked[:-1] = self.first[buf[:-1].astype(np.int32) * 256 + buf[1:]]
        ranked[ends[lengths > 0] - 1] = -1
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends[lengths > 0] - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1
        # Lists are quicker, arrays hold a very long pre-token in a quarter of the memory.
        held = np.ndarray.tolist if n <= _AS_LISTS else lambda x: array("i", x.tobytes())
        token = held(self.single[buf])
        self._run(token, held(ranked), held(after), held(before), ranked)
        out = np.array(token, dtype=np.int32)
        alive = out >= 0
        bounds = np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])] * 4
        raw, bounds = out[alive].astype("<u4").tobytes(), bounds.tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _run(self, token, rank, after, before, start) -> None:
        """Merge until no bucket has an entry. ``token`` becomes -1 at positions that were merged into their left one."""
        waiting = np.flatnonzero(start >= 0)
        waiting = waiting[np.argsort(start[waiting], kind="stable")]
        kinds, firsts = np.unique(start[waiting], return_index=True)
        buckets = dict(zip(kinds.tolist(), [x.tolist() for x in np.split(waiting, firsts[1:])]))
        low = [0] * ((1 << self.shift >> _BITS) + 1)
        top, mask = 0, (1 << _BITS) - 1
        for r in buckets:
            low[r >> _BITS] |= 1 << (r & mask)
            top |= 1 << (r >> _BITS)
        pairs, shift = self.pairs.get, self.shift
        while top:
            word = (top & -top).bit_length() - 1
            bits = low[word]
            r = word << _BITS | (bits & -bits).bit_length() - 1
            bucket = buckets.pop(r)
            low[word] = bits & (bits - 1)
            if not low[word]:
                top &= top - 1
            bucket.sort()
            for k, i in enumerate(bucket):
                if rank[i] != r:
                    continue  # stale: merged away, or its pair has changed
                j = after[i]
                far = after[j]
                token[i], token[j], rank[j], after[i] = r, -1, -1, far
                least = r + 1
                made = -1
                if far >= 0:
                    before[far] = i
                    made = pairs(r << shift | token[far], -1)
                    if made >= 0:
                        if made in buckets:
                            buckets[made].append(i)
                        else:
                            buckets[made] = [i]
                            low[made >> _BITS] |= 1 << (made & mask)
                            top |= 1 << (made >> _BITS)
                        least = made
                rank[i] = made
                p = before[i]
                if p >= 0:
                    made = pairs(token[p] << shift | r, -1)
                    rank[p] = made
                    if made >= 0:
                        if made in buckets:
                            buckets[made].append(p)
                        else:
                            buckets[made] = [p]
                            low[made >> _BITS] |= 1 << (made & mask)
                            top |= 1 << (made >> _BITS)
                        if made < least:
                            least = made
                if least <= r:  # a new pair goes before the rest of this bucket
                    rest = bucket[k + 1:]
                    if rest:
                        buckets[r] = buckets.get(r, []) + rest
                        low[r >> _BITS] |= 1 << (r & mask)
                        top |= 1 << (r >> _BITS)
                    break


_HIGH = re.compile(f"[^\0-{chr(0x24F)}]")
_CLASS = re.compile(r"\\(p\{\w+\}|[sS])")


def low_cut(pattern: str):
    """``findall`` of the pattern for texts of characters up to U+024F only: its classes are spelled out for them, which
    the plain engine matches in half the time. None for a pattern with other escapes or with nested sets."""
    import regex

    out, at, inside = "", 0, False
    while at < len(pattern):
        m = _CLASS.match(pattern, at)
        if m and not (inside and m[0] == r"\S"):
            negated = m[0] == r"\S"
            some = [c for c in map(chr, range(0x250)) if regex.match(m[0].lower() if negated else m[0], c)]
            listed = "".join(f"\\x{ord(c):02x}" if ord(c) < 256 else c for c in some)
            out += listed if inside else f"[{'^' if negated else ''}{listed}]"
            at = m.end()
            continue
        if pattern[at] == "\\" or inside and pattern[at] == "[":
            return None
        inside = pattern[at] == "[" or inside and pattern[at] != "]"
        out += pattern[at]
        at += 1
    return re.compile(out).findall


class Codec:
    """Encoder and decoder of one rank file and one pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.queue = RankQueue(ranks)
        self.cut_any = regex.compile(pattern).findall
        self.cut_low = low_cut(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.bytes_of[r] = t
        self.table: dict = {}

    def cut(self, text: str) -> list:
        """The pre-tokens of a text."""
        return self.cut_low(text) if self.cut_low and not _HIGH.search(text) else self.cut_any(text)

    def _learn(self, pieces: set) -> dict:
        """Ids of pre-tokens that the table lacks."""
        known, ranks = {}, self.queue.ranks
        rest = []
        for p in pieces:
            r = ranks.get(p.encode())
            if r is None:
                rest.append(p)
            else:
                known[p] = r.to_bytes(4, "little")
        known.update(zip(rest, self.queue.merge([p.encode() for p in rest])))
        if len(self.table) > TABLE:
            self.table = {}
        self.table.update((p, ids) for p, ids in known.items() if len(p) <= KEPT_CHARS)
        return known

    def encode(self, texts: list) -> list:
        """Ids of each text, as little-endian 32-bit integers. The texts of a call are held together."""
        cut = [self.cut(t) for t in texts]
        unseen = set().union(*cut).difference(self.table)
        table = self.table
        if unseen:
            fresh = self._learn(unseen)
            if table is not self.table:  # started anew: what this call has seen before is in the old one
                table = {**table, **fresh}
            elif any(len(p) > KEPT_CHARS for p in fresh):
                table = {**{p: table[p] for t in cut for p in t if p in table}, **fresh}
        return [b"".join(map(table.__getitem__, t)) for t in cut]

    def encode_long(self, text: str) -> bytes:
        return b"".join(self.encode([part])[0] for part in parts(text, CHUNK_CHARS))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def parts(text: str, size: int):
    """Cut a text where a pre-token is sure to start: before a space that stands between two characters other than white space."""
    lo = 0
    while len(text) - lo > size:
        at = text.find(" ", lo + size)
        while 0 <= at and (at + 1 >= len(text) or text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[lo:at]
        lo = at
    yield text[lo:]


_loaded: dict = {}


def codec(path: str, pattern: str) -> Codec:
    """This worker's codec of a rank file."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Codec(path, pattern)
    return _loaded[path, pattern]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row a document: key, n_tokens, ids (little-endian unsigned 32-bit integers end to end)."""
    path, pattern = path or default_path(), pattern or default_pattern()

    def run(batches):
        c = codec(path, pattern)
        try:
            for batch in batches:
                for lo, hi, _, _ in tv.chunks(batch.column(1), CHUNK_CHARS):
                    texts = [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                    ids = c.encode(texts) if len(texts) > 1 else [c.encode_long(texts[0])]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(lo, hi - lo), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                        [key, "n_tokens", "ids"])
        finally:
            c.table = {}

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text)).mapInArrow(tv.returning(run), f"`{key}` {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``encoded`` with ``ids`` replaced by the bytes that they stand for (null ids: null). An unknown id is an error."""
    path, pattern, at = path or default_path(), pattern or default_pattern(), encoded.columns.index(ids)

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                piece = batch.slice(lo, 256)
                told = [None if x is None else c.decode(np.frombuffer(x, dtype="<u4")) for x in piece.column(at).to_pylist()]
                yield piece.set_column(at, batch.schema.field(at), pa.array(told, batch.schema.field(at).type))

    return encoded.mapInArrow(tv.returning(run), encoded.schema)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: key, n_tokens, digests of the ids and of the bytes decoded from them."""
    out = encode(docs, key, text).withColumn("ids_sha256", F.sha2("ids", 256))
    return decode(out).select(F.col(key), "n_tokens", "ids_sha256", F.sha2("ids", 256).alias("decoded_sha256"))
