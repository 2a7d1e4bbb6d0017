"""Alignment of two tokenizers over the same text, by anchors at space-marked tokens.

A (byte-level BPE) and B (pieces with byte fallback) both tokenise every text in full, a space in front of it. Where a
token that opens with a space starts at the same byte in A and in B, the tokens before it end together: that is an
anchor, and anchors cut a document into windows, each a few ids of A beside a few ids of B. A window's alignment (its
groups, which end where tokens of both end, and its links, the pairs of tokens that share a byte) depends on its ids
alone, so it is kept under the two id tuples and worked out once per distinct window of a task.

Plan: one pass over the texts writes, for each document, its counts, the digest of its groups and its distinct linked
id pairs with how often they occur. How many documents link a pair is a count over the exploded pairs (partial sums in
every task), a table of vocabulary pairs. It goes back to the documents' pairs by a join, and the sums return to one
row a document. Up to ``BROADCAST_BYTES`` (rows counted, each of a fixed size) that table is broadcast, and the sum per
document is a partial sum in the task that read it; beyond, the join is a shuffle on the pair and a pair that very many
documents hold is left to Spark's split of skewed partitions.

Null and empty texts, and texts whose joined tokens are not the text again (B may not know how to spell it), have no
tokens: zeros and an empty string of groups. Rows are documents: repeated rows count each. Other columns are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docindex.llm import textvec as tv, tokens
from docindex.llm.scratch import stored

BROADCAST_BYTES = 64 << 20
PAIR_BYTES = 32  # of one counted pair in a broadcast hash table
WINDOWS = 150_000  # windows kept in a task, about 50 MB; a full table starts anew
CHUNK_BYTES = 1 << 20
UNITS = 400_000  # units that each tokenizer keeps in a task, about 75 MB
_MARKS = frozenset(",.;:!?")


def _flat(spelled: list):
    """Byte strings end to end, with the start and the length of each."""
    lengths = np.array([len(s) for s in spelled], dtype=np.int64)
    return np.frombuffer(b"".join(spelled), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


class ByteTokens(tokens.Encoder):
    """A: a byte-level BPE; the strings of its special tokens are plain text."""

    limit = UNITS

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.added = []
        marks = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in marks} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(marks))}
        spelled = [b""] * (max(self.tokenizer.get_vocab().values()) + 1)
        for token, i in self.tokenizer.get_vocab().items():
            spelled[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.flat, self.start, self.length = _flat(spelled)


class PieceTokens(tokens.Encoder):
    """B: sentence pieces, for texts that start with the space that the library adds itself.

    Units (a word with its space, a line feed, a mark) are encoded many at a time, strung together by line feeds:
    no piece holds a line feed, and none may cross the places where units are cut, which is looked up in the vocabulary.
    """

    limit = UNITS

    def __init__(self, path: str):
        import sentencepiece

        self.pieces = p = sentencepiece.SentencePieceProcessor(model_file=path)
        n = p.get_piece_size()
        self.width = 2 if n <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        spelled, crossing = [], False
        for i in range(n):
            piece = p.id_to_piece(i)
            if p.is_byte(i):
                spelled.append(bytes([int(piece[3:5], 16)]))
                continue
            spelled.append(piece.replace("▁", " ").encode())
            if not (p.is_control(i) or p.is_unknown(i)):
                crossing |= "▁" in piece[1:].lstrip("▁") or "\n" in piece or any(
                    b in _MARKS and (a.isascii() and a.isalnum() or "À" <= a <= "ɏ") for a, b in zip(piece, piece[1:]))
        self.flat, self.start, self.length = _flat(spelled)
        told = p.encode("\nx")
        self.feed = told[1] if len(told) == 3 and spelled[told[0]] == b" " and spelled[told[1]] == b"\n" else None
        self.cuttable = not crossing and self.feed is not None
        self.added, self.table = [], {}

    def _whole(self, texts: list) -> list:
        return [np.array(i, dtype=self.dtype) for i in self.pieces.encode([t[1:] for t in texts], num_threads=1)]

    def _learn(self, units: list) -> None:
        self.table.update((u, np.array([self.feed], dtype=self.dtype).tobytes()) for u in units if u == b"\n")
        units = [u for u in units if u != b"\n"]
        for k in range(0, len(units), tokens.TOGETHER):
            some = units[k: k + tokens.TOGETHER]
            ids = np.array(self.pieces.encode("\n" + b"\n".join(some).decode("utf-8")), dtype=self.dtype)
            at = np.append(np.flatnonzero(ids == self.feed), len(ids))
            if len(at) != len(some) + 1:
                raise ValueError("the line feeds between units were not kept apart")
            raw = ids.tobytes()
            self.table.update((u, raw[(a + 1) * self.width: b * self.width]) for u, a, b in zip(some, at.tolist(), at[1:].tolist()))


_loaded: dict = {}


def _encoder(kind, path: str):
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]


def default_paths() -> tuple:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _spell(enc, ids: np.ndarray):
    """The bytes of ids end to end, and the length of each id."""
    size = enc.length[ids]
    begin = np.cumsum(size) - size
    return enc.flat[np.repeat(enc.start[ids] - begin, size) + np.arange(int(size.sum()))], size


def _gather(values: np.ndarray, lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[lo[i] : lo[i] + size[i]] end to end."""
    begin = np.cumsum(size) - size
    return values[np.repeat(lo - begin, size) + np.arange(int(size.sum()))]


class Aligner:
    """Both tokenizers and the windows that this task has aligned."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = _encoder(ByteTokens, path_a), _encoder(PieceTokens, path_b)
        self.base = len(self.b.length)  # a linked pair is a * base + b
        self.digits = _flat([b"%d," % i for i in range(max(len(self.a.length), self.base))])
        self.opens_a = self._opens(self.a)
        self.opens_b = self._opens(self.b)
        self.windows: dict = {}

    @staticmethod
    def _opens(enc):
        out = np.zeros(len(enc.length), dtype=bool)
        some = enc.length > 0
        out[some] = enc.flat[enc.start[some]] == 32
        return out

    def drop(self) -> None:
        """Forget what tasks learn; the tokenizers stay."""
        self.windows, self.a.table, self.b.table = {}, {}, {}

    def _align(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> list:
        """(groups as text, packed links, number of groups) of windows, given their ids end to end and their numbers of ids."""
        end_a, end_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        last = end_a[np.cumsum(size_a) - 1]  # where each window ends, in A and in B
        common, every = np.intersect1d(end_a, end_b, assume_unique=True), np.union1d(end_a, end_b)
        # Between two neighbouring ends lies one token of each side, and each linked pair has one such stretch.
        links = a[np.searchsorted(end_a, every)].astype(np.int64) * self.base + b[np.searchsorted(end_b, every)]
        links, n_links = links.astype("<i8").tobytes(), np.diff(np.searchsorted(every, last, side="right"), prepend=0)
        n_groups = np.diff(np.searchsorted(common, last, side="right"), prepend=0)
        # The text: every id's digits and what follows them (a comma, | after a group's last of A, ; after its last of B).
        group = np.concatenate([np.searchsorted(common, end_a) * 2, np.searchsorted(common, end_b) * 2 + 1])
        order = np.argsort(group, kind="stable")
        ids, group = np.concatenate([a, b])[order].astype(np.int64), group[order]
        closes = np.append(group[1:] != group[:-1], True)
        told, start, length = self.digits
        size = length[ids]
        stop = np.cumsum(size)
        text = told[np.repeat(start[ids] - (stop - size), size) + np.arange(int(stop[-1]))]
        text[stop - 1] = np.where(closes, np.where(group % 2 == 0, ord("|"), ord(";")), ord(","))
        text = text.tobytes()
        # A window's last token in this order is its last of B.
        cut = stop[np.searchsorted(group, 2 * (np.cumsum(n_groups) - 1) + 1, side="right") - 1].tolist()
        to = (np.cumsum(n_links) * 8).tolist()
        return [(text[p: q - 1], links[r:t], n) for p, q, r, t, n in zip([0, *cut], cut, [0, *to], to, n_groups.tolist())]

    def _known(self, a: np.ndarray, b: np.ndarray, lo_a, hi_a, lo_b, hi_b) -> list:
        """The alignments of windows a[lo_a:hi_a] beside b[lo_b:hi_b]; those that the table lacks are worked out together."""
        raw_a, raw_b, w, v = a.tobytes(), b.tobytes(), self.a.width, self.b.width
        keys = [(raw_a[p:q], raw_b[r:s]) for p, q, r, s in zip((lo_a * w).tolist(), (hi_a * w).tolist(), (lo_b * v).tolist(), (hi_b * v).tolist())]
        found = list(map(self.windows.get, keys))
        new = np.array([k for k, x in enumerate(found) if x is None], dtype=np.int64)
        if len(new):
            size_a, size_b = (hi_a - lo_a)[new], (hi_b - lo_b)[new]
            if len(self.windows) > WINDOWS:
                self.windows = {}
            for k, x in zip(new.tolist(), self._align(_gather(a, lo_a[new], size_a), _gather(b, lo_b[new], size_b), size_a, size_b)):
                self.windows[keys[k]] = found[k] = x
        return found

    def chunk(self, buf: np.ndarray, offsets: np.ndarray):
        """For texts that open with the added space (or are empty): arrays n_a, n_b, n_groups, n_links, list of digests,
        and the texts' distinct pairs: (bounds, pairs, occurrences)."""
        n = len(offsets) - 1
        sides = []
        good = offsets[1:] > offsets[:-1]
        uncut = self.a._uncut(buf, offsets) | self.b._uncut(buf, offsets)
        units = self.a.units(buf, offsets, uncut)
        for enc in (self.a, self.b):
            ids, first = enc.lay_out(buf, offsets, uncut, *units)
            told, size = _spell(enc, ids)
            spelled = np.concatenate([[0], np.cumsum(size)])[first]
            whole = np.diff(spelled) == np.diff(offsets)
            # Compare the bytes of the texts whose lengths agree.
            which = np.flatnonzero(whole & good)
            length = np.diff(offsets)[which]
            differ = _gather(told, spelled[:-1][which], length) != _gather(buf, offsets[:-1][which], length)
            whole[which] &= tv.sums(differ, np.concatenate([[0], np.cumsum(length)])) == 0
            good &= whole
            sides.append((ids, first))
        kept = np.flatnonzero(good)
        counts, flat = [], []
        for enc, (ids, first) in zip((self.a, self.b), sides):
            size = np.where(good, np.diff(first), 0)
            counts.append(size)
            chosen = _gather(ids, first[:-1][kept], size[kept])
            flat.append((chosen, np.cumsum(enc.length[chosen])))
        n_groups, n_links, digests = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), [""] * n
        if not len(kept):
            return counts, n_groups, n_links, digests, (np.zeros(n + 1, dtype=np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        (a, end_a), (b, end_b) = flat
        open_a = (end_a - self.a.length[a])[self.opens_a[a]]
        open_b = (end_b - self.b.length[b])[self.opens_b[b]]
        anchors = np.intersect1d(open_a, open_b, assume_unique=True)
        lo_a, lo_b = np.searchsorted(end_a, anchors, side="right"), np.searchsorted(end_b, anchors, side="right")
        hi_a, hi_b = np.append(lo_a[1:], len(a)), np.append(lo_b[1:], len(b))
        hashes = tv.span_hashes(np.frombuffer(a.tobytes(), np.uint8), lo_a * self.a.width, hi_a * self.a.width)
        hashes ^= tv.mix(tv.span_hashes(np.frombuffer(b.tobytes(), np.uint8), lo_b * self.b.width, hi_b * self.b.width))
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        known = self._known(a, b, lo_a[first], hi_a[first], lo_b[first], hi_b[first])
        groups = [k[0] for k in known]
        links = np.frombuffer(b"".join([k[1] for k in known]), dtype="<i8")
        size = np.array([len(k[1]) // 8 for k in known], dtype=np.int64)
        at = np.cumsum(size) - size
        # Each document opens with an anchor, so its windows follow one another.
        length = np.diff(offsets)[kept]
        bound = np.searchsorted(anchors, np.concatenate([[0], np.cumsum(length)]))
        n_groups[kept] = tv.sums(np.array([k[2] for k in known], dtype=np.int64)[which], bound)
        n_links[kept] = tv.sums(size[which], bound)
        for d, lo, hi in zip(kept.tolist(), bound.tolist(), bound[1:].tolist()):
            digests[d] = hashlib.sha256(b";".join([groups[w] for w in which[lo:hi].tolist()])).hexdigest()
        pair = _gather(links, at[which], size[which])
        owner = np.repeat(kept, n_links[kept])
        span = len(self.a.length) * self.base
        both = np.sort(owner * span + pair)
        heads = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        owner, pair = np.divmod(both[heads], span)
        return counts, n_groups, n_links, digests, (np.searchsorted(owner, np.arange(n + 1)), pair, np.diff(np.append(heads, len(both))))


def aligned(docs: DataFrame, key: str = "doc_id", text: str = "text", paths: tuple | None = None) -> DataFrame:
    """One row a document: key, n_a, n_b, n_groups, n_links, groups_sha256, pairs (a * size of B + b), times."""
    path_a, path_b = paths or default_paths()

    def run(batches):
        aligner = Aligner(path_a, path_b)
        try:
            for batch in batches:
                for lo, hi, buf, offsets in tv.chunks(batch.column(1), CHUNK_BYTES):
                    (n_a, n_b), n_groups, n_links, digests, (bounds, pairs, times) = aligner.chunk(buf, offsets)
                    bounds = pa.array(bounds, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(lo, hi - lo), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)),
                         pa.array(digests, pa.string()), pa.ListArray.from_arrays(bounds, pa.array(pairs, pa.int64())),
                         pa.ListArray.from_arrays(bounds, pa.array(times, pa.int32()))],
                        [key, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
        finally:
            aligner.drop()

    kind = docs.schema[key].dataType.simpleString()
    spaced = F.when(F.length(text) > 0, F.concat(F.lit(" "), F.col(text))).otherwise("")
    return docs.select(F.col(key), spaced).mapInArrow(
        tv.returning(run), f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def pair_counts(rows: DataFrame, base: int) -> DataFrame:
    """Table pair, documents, best: how many rows hold each pair, and whether that is the most of its A id."""
    counted = stored(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents")), "align-pairs")
    a = F.expr(f"pair div {base}")
    most = counted.groupBy(a.alias("a")).agg(F.max("documents").alias("most"))
    return counted.withColumn("a", a).join(most, "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", paths: tuple | None = None,
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row a document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best counts the links whose pair is held by as many documents as any pair of its A id; count_sum adds up the
    number of documents over the links.
    """
    paths = paths or default_paths()
    base = len(_encoder(PieceTokens, paths[1]).length)
    rows = stored(aligned(docs, key, text, paths).withColumn("row", F.monotonically_increasing_id()), "align")
    counts = stored(pair_counts(rows, base), "align-counts")
    small = counts.count() * PAIR_BYTES <= broadcast_bytes
    links = rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    sums = links.join(F.broadcast(counts) if small else counts, "pair").groupBy("row").agg(
        F.sum(F.expr("IF(best, times, 0)")).cast("long").alias("n_best"), F.sum(F.col("times") * F.col("documents")).alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        F.col(key), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
