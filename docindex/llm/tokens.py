"""Token ids of whole texts with a byte-level BPE of the tokenizers library, inside tasks.

A byte-level BPE encodes each of its pre-tokens (a word with the space before it, a number, a run of marks) by itself,
and where white space stands alone a pre-token starts at every space, around every line feed, and at a sentence mark
after a letter or digit. So a text is cut there into units, the distinct units of a chunk of texts are encoded by the
library once, their ids are kept in a bounded table until the task ends, and numpy lays the ids out in text order. Units are
told apart by a 64-bit hash within a chunk and by their bytes in the table. Texts with white space side by side, with a character outside the plain ranges (where
character classes could differ) or with the string of an added token go to the library whole. Either way the ids equal
``encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import os
import re

import numpy as np

from docindex.llm import textvec as tv

TABLE = 400_000  # units kept in a task, about 80 MB; a full table starts anew
TOGETHER = 256  # unseen units encoded in one string
CHUNK_BYTES = 1 << 20  # text taken at once
_STRUNG = re.compile(rb" [^\t\r\n ]+").fullmatch
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 13, 32]] = True
#: Bytes that never stand in a plain text: controls, and lead bytes above U+024F.
_STRANGE = np.zeros(256, dtype=bool)
_STRANGE[[*range(9), 11, 12, *range(14, 32), 127, *range(0xCA, 256)]] = True
#: After the lead byte C2: U+0080 to U+00A0, and the letters and marks among U+00AA, U+00AD, U+00B5, U+00BA.
_STRANGE_C2 = np.zeros(256, dtype=bool)
_STRANGE_C2[[*range(0x80, 0xA1), 0xAA, 0xAD, 0xB5, 0xBA]] = True

_MARK = np.zeros(256, dtype=bool)
_MARK[list(b",.;:!?")] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True

_loaded: dict = {}


class Encoder:
    limit = TABLE

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        pre = type(self.tokenizer.pre_tokenizer).__name__
        self.cuttable = (pre == "ByteLevel" and type(self.tokenizer.model).__name__ == "BPE" and self.tokenizer.normalizer is None
                         and not self.tokenizer.pre_tokenizer.add_prefix_space)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # tokens that start with a space
        self.opens[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.table: dict = {}

    def _whole(self, texts: list) -> list:
        return [np.array(e.ids, dtype=self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: list) -> None:
        """Encode unseen units. Those that open with a space stay apart when strung together: many in one call.

        The first token of such a unit, and no other of its tokens, starts with a space; that finds the unit's ids.
        """
        strung = [u for u in units if _STRUNG(u)]
        if strung:
            ids = np.concatenate(self._whole([b"".join(strung[k: k + TOGETHER]).decode("utf-8") for k in range(0, len(strung), TOGETHER)]))
            bounds = np.append(np.flatnonzero(self.opens[ids]), len(ids)) * self.width
            if len(bounds) == len(strung) + 1 and bounds[0] == 0:
                raw, bounds = ids.tobytes(), bounds.tolist()
                self.table.update(zip(strung, [raw[a:b] for a, b in zip(bounds, bounds[1:])]))
                units = [u for u in units if not _STRUNG(u)]
        for u, ids in zip(units, self._whole([u.decode("utf-8") for u in units])):
            self.table[u] = ids.tobytes()

    def _uncut(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Flags of the texts that go to the library whole."""
        if not self.cuttable:
            return np.ones(len(offsets) - 1, dtype=bool)
        bad = _STRANGE[buf]
        bad[1:] |= (buf[:-1] == 0xC2) & _STRANGE_C2[buf[1:]] | (buf[:-1] == 0xC9) & (buf[1:] > 0x8F)
        space = _SPACE[buf]
        side = np.zeros(len(buf), dtype=bool)
        side[1:] = space[1:] & space[:-1]
        first = offsets[:-1][offsets[:-1] < len(buf)]
        side[first] = False  # the space before belongs to another text
        out = tv.sums(bad | side, offsets) > 0
        raw = buf.tobytes()
        for a in self.added:
            at = raw.find(a)
            while at >= 0:
                out[np.searchsorted(offsets, at, side="right") - 1] = True
                at = raw.find(a, at + 1)
        return out

    def units(self, buf: np.ndarray, offsets: np.ndarray, uncut: np.ndarray):
        """Distinct units of the texts that are cut; and of all their units, in order, the text and the distinct unit."""
        head = (buf == 32) | (buf == 10)
        head[1:] |= buf[:-1] == 10
        marks = np.flatnonzero(_MARK[buf])
        marks = marks[marks > 1]
        before, second = buf[marks - 1], buf[marks - 2]
        letter = _ALNUM[before] | (before & 0xC0 == 0x80) & (second >= 0xC3) & ~((second == 0xC3) & ((before == 0x97) | (before == 0xB7)))
        head[marks[letter]] = True
        head[offsets[:-1][offsets[:-1] < len(buf)]] = True
        starts = np.flatnonzero(head)
        ends = np.append(starts[1:], len(buf))
        doc = np.searchsorted(offsets, starts, side="right") - 1
        if uncut.any():
            cut = ~uncut[doc]
            starts, ends, doc = starts[cut], ends[cut], doc[cut]
        hashes = tv.span_hashes(buf, starts, ends)
        order = np.argsort(hashes)
        new = np.ones(len(order), dtype=bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        raw, first = buf.tobytes(), order[new]
        return [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())], doc, which

    def lay_out(self, buf: np.ndarray, offsets: np.ndarray, uncut: np.ndarray, units: list, doc: np.ndarray, which: np.ndarray):
        """Ids of the texts, and the first id of each text (texts + 1), from their units."""
        n = len(offsets) - 1
        if len(self.table) > self.limit:
            self.table = {}
        packed = list(map(self.table.get, units))
        unseen = [k for k, p in enumerate(packed) if p is None]
        if unseen:
            self._learn([units[k] for k in unseen])
            for k in unseen:
                packed[k] = self.table[units[k]]
        sizes = np.array([len(p) for p in packed], dtype=np.int64) // self.width
        known = np.frombuffer(b"".join(packed), dtype=self.dtype)
        at = np.cumsum(sizes) - sizes
        lengths = sizes[which]
        total = int(lengths.sum())
        begins = np.cumsum(lengths) - lengths
        out = known[np.repeat(at[which] - begins, lengths) + np.arange(total)]
        counts = np.bincount(doc, weights=lengths, minlength=n).astype(np.int64)
        if uncut.any():
            rows, raw = np.flatnonzero(uncut), buf.tobytes()
            whole = dict(zip(rows.tolist(), self._whole([raw[offsets[i]: offsets[i + 1]].decode("utf-8") for i in rows])))
            bounds = np.concatenate([[0], np.cumsum(counts)])
            parts = [whole.get(i, out[bounds[i]: bounds[i + 1]]) for i in range(n)]
            out, counts = np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)
        return out, np.concatenate([[0], np.cumsum(counts)])

    def ids(self, buf: np.ndarray, offsets: np.ndarray):
        """Ids of one chunk of UTF-8 texts end to end, and the first id of each text (texts + 1)."""
        uncut = self._uncut(buf, offsets)
        return self.lay_out(buf, offsets, uncut, *self.units(buf, offsets, uncut))


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def returning(run):
    """``run`` (a generator over Arrow batches) that leaves neither a table of units nor freed memory behind."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            for e in _loaded.values():
                e.table = {}

    return tv.returning(wrapped)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
