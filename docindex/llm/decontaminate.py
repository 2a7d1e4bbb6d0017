"""Benchmark decontamination with DataFrame functions only.

Texts are normalised to lower-case words; a test item gives the windows of ``WINDOW`` consecutive words (an item of
fewer words is one window). The documents are read once: at each word position a hash of the window's first, middle
and last word is looked up in a hash set of the test windows' hashes, which travels with the plan to every task. The
few positions that pass are verified by joining the window's whole text with the test windows' texts.

The hash set is an exact one (8 bytes a window) up to ``EXACT_BYTES``, and beyond that a packed set of bits
(``BITS`` a window, two bits of one 60-bit block each) up to ``PACKED_BYTES``: about 2.5 million windows; one
other position in 80 passes by mistake and goes to the join. Only beyond that do all positions go to the join. The window
texts are broadcast to the join up to ``TEXT_BYTES`` (summed before), else they are shuffled: same rows, more movement.

Rows are told apart by (id, 64-bit hash of the text), so documents with a repeated or null id are judged on their own
text. Null and empty texts have no words and no hits; items without words have no windows; an empty benchmark hits
nothing; repeated rows are judged alike. Other columns are passed through or left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docindex.llm.scratch import stored

WINDOW = 13
EXACT_BYTES, PACKED_BYTES, TEXT_BYTES = 400_000, 8 << 20, 64 << 20
BITS, BLOCK_BITS, BYTE_BITS = 20, 60, 6  # six bits of a byte, so that it reads as ASCII
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normal_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased (other letters keep their case). lower() is right, and faster, on plain ASCII."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, _UPPER, _UPPER.lower())).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, _SEPARATOR + "+"), "")


def _windows_at(positions: Column, k: int) -> Column:
    words = F.col("words")
    return F.transform(positions, lambda i: F.struct((i - 1).alias("pos"), F.lit(k).alias("k"), F.array_join(F.slice(words, i, F.lit(k)), " ").alias("gram")))


def _anchor(i: Column, k: int) -> Column:
    """Hash of three words of the window of k words that starts at the 1-based position i."""
    words = F.col("words")
    return F.xxhash64(words[i - 1], words[i - 1 + k // 2], words[i + (k - 2)])


def _gram_and_anchor(k: int):
    return lambda i: F.struct(F.array_join(F.slice("words", i, F.lit(k)), " ").alias("gram"), _anchor(i, k).alias("anchor"))


def _all_positions(k: int) -> Column:
    return F.when(F.size("words") >= k, F.sequence(F.lit(1), F.size("words") - (k - 1))).otherwise(F.expr("CAST(array() AS array<int>)"))


class HashSet:
    """A set of 64-bit hashes that travels in the plan: exact, or packed bits with mistakes of one kind (false hits)."""

    def __init__(self, hashes: DataFrame, n: int, exact_bytes: int, packed_bytes: int):
        self.exact, self.packed = n * 8 <= exact_bytes, None
        self.blocks = max(1, n * BITS // BLOCK_BITS)
        size = self.blocks * (BLOCK_BITS // BYTE_BITS)
        self.usable = self.exact or size <= packed_bytes
        if self.exact:
            self.values = [r[0] for r in hashes.collect()]  # at most exact_bytes / 8
            least = "(-9223372036854775807L - 1L)"  # the one long that SQL cannot spell
            self.listed = ", ".join(f"{v}L" if v > -(1 << 63) else least for v in self.values) or "NULL"
        elif self.usable:
            h = F.col(hashes.columns[0])
            one = lambda at: F.expr(f"shiftleft(1L, CAST({at} AS int))")
            rows = (hashes.select(self._block(h).alias("block"), *(x.alias(f"b{j}") for j, x in enumerate(self._bits(h))))
                    .groupBy("block").agg(F.bit_or(one("b0").bitwiseOR(one("b1"))).alias("bits")).collect())  # one row a block
            packed = bytearray(size)
            for r in rows:
                for k in range(BLOCK_BITS // BYTE_BITS):
                    packed[r["block"] * (BLOCK_BITS // BYTE_BITS) + k] = r["bits"] >> (BYTE_BITS * k) & 63
            self.packed = F.lit(bytes(packed))  # one literal, used by every test

    def _block(self, h: Column) -> Column:
        return F.pmod(h, F.lit(self.blocks)).cast("int")

    def _bits(self, h: Column) -> list:
        return [F.pmod(F.xxhash64(h, F.lit(j)), F.lit(BLOCK_BITS)).cast("int") for j in range(2)]

    def among(self, k: int) -> Column:
        """The positions whose windows of k words may be in the set."""
        if not self.exact:
            return F.filter(_all_positions(k), lambda i: self.holds(_anchor(i, k)))
        # As SQL text: a long list of values is one parse there, and a call to the JVM each otherwise.
        positions = f"IF(size(words) >= {k}, sequence(1, size(words) - {k - 1}), CAST(array() AS array<int>))"
        anchor = f"xxhash64(words[i - 1], words[i - 1 + {k // 2}], words[i + {k - 2}])"
        return F.expr(f"filter({positions}, i -> {anchor} IN ({self.listed}))")

    def holds(self, h: Column) -> Column:
        """Whether a hash may be in the packed set."""
        out, begin = F.lit(True), self._block(h) * (BLOCK_BITS // BYTE_BITS) + 1
        for at in self._bits(h):
            byte = F.ascii(F.substring(self.packed, begin + F.floor(at / BYTE_BITS).cast("int"), F.lit(1)).cast("string"))
            out = out & (F.getbit(byte.cast("long"), F.pmod(at, F.lit(BYTE_BITS))) == 1)
        return out


def test_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, k, gram, anchor): the distinct windows of each test item; k is below ``window`` for a short item only."""
    items = benchmark.select(F.col(key).cast("string").alias("item"), normal_words(F.col(text)).alias("words"))
    parts = []
    for k in range(1, window + 1):
        own = items.where(F.size("words") >= k) if k == window else items.where(F.size("words") == k)
        both = F.transform(_all_positions(k), _gram_and_anchor(k))
        parts.append(own.select("item", F.lit(k).alias("k"), F.explode(both).alias("w")).select("item", "k", "w.gram", "w.anchor"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return stored(out.distinct(), "windows")


def document_hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, exact_bytes: int = EXACT_BYTES, packed_bytes: int = PACKED_BYTES,
                  text_bytes: int = TEXT_BYTES) -> DataFrame:
    """One row a document: id, text_hash, n_words, hit (0-based positions of hit words), items (ascending strings)."""
    windows = test_windows(benchmark, item_key, item_text, window)
    grams = windows.select("k", "gram", "anchor").distinct()
    counted = grams.groupBy("k").agg(F.count_distinct("anchor").alias("n"), F.sum(F.octet_length("gram") + 32).alias("bytes")).orderBy("k").collect()  # at most ``window`` rows
    small = sum(r["bytes"] for r in counted) <= text_bytes
    total, found = sum(r["n"] for r in counted), []
    for k, n, _ in counted:
        # The sets of all lengths share the bytes.
        known = HashSet(grams.where(F.col("k") == k).select("anchor").distinct(), n, exact_bytes * n // total, packed_bytes * n // total)
        found.append(_windows_at(known.among(k) if known.usable else _all_positions(k), k))
    none = F.expr("CAST(array() AS array<struct<pos:int,k:int,gram:string>>)")
    worded = docs.select(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), normal_words(F.col(text)).alias("words"))
    scanned = stored(worded.select("id", "text_hash", F.size("words").cast("long").alias("n_words"),
                                   F.concat(none, *found).alias("at")), "scan")
    texts = grams.select("gram").distinct()
    at = scanned.where(F.size("at") > 0).select("id", "text_hash", F.explode("at").alias("w")).select("id", "text_hash", "w.*")
    hits = stored(at.join(F.broadcast(texts) if small else texts, "gram").distinct(), "hits")
    words = hits.groupBy("id", "text_hash").agg(F.collect_list(F.struct("pos", "k")).alias("spans"))
    words = words.select("id", "text_hash", F.expr("array_distinct(flatten(transform(spans, x -> sequence(x.pos, x.pos + x.k - 1))))").alias("hit"))
    owners = windows.select("gram", "item").distinct()
    items = (hits.select("id", "text_hash", "gram").distinct().join(F.broadcast(owners) if small else owners, "gram")
             .groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("item")).alias("items")))
    both = words.join(items, words["id"].eqNullSafe(items["id"]) & (words["text_hash"] == items["text_hash"])).select(
        words["id"].alias("hit_id"), words["text_hash"].alias("hit_hash"), "hit", "items")
    return (scanned.drop("at").join(both, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left")
            .select("id", "text_hash", "n_words", F.coalesce("hit", F.expr("CAST(array() AS array<int>)")).alias("hit"),
                    F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items")))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **names) -> DataFrame:
    """One row a document: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = document_hits(docs, benchmark, key, **names).withColumn("n_hit", F.size("hit").cast("long"))
    return found.select(F.col("id").alias(key), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """``docs`` without the contaminated documents; every column as it was."""
    found = document_hits(docs, benchmark, key, text, **names)
    bad = (found.where(contaminated(F.size("hit").cast("long"), F.col("n_words")))
           .select(F.col("id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct())
    return docs.join(bad, docs[key].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(docs[text]) == bad["_bad_hash"]), "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """``docs`` with the hit words, and the separators before each, cut out of ``text``; a text without hits stays as it is."""
    found = document_hits(docs, benchmark, key, text, **names)
    hits = (found.where(F.size("hit") > 0).select(F.col("id").alias("_hit_id"), F.col("text_hash").alias("_hit_hash"), F.col("hit").alias("_hit"))
            .dropDuplicates(["_hit_id", "_hit_hash"]))
    joined = docs.join(hits, docs[key].eqNullSafe(hits["_hit_id"]) & (F.xxhash64(docs[text]) == hits["_hit_hash"]), "left")
    word = "[^" + _SEPARATOR[1:]
    pieces = F.regexp_extract_all(docs[text], F.lit(f"({_SEPARATOR}*{word}+)"), F.lit(1))
    left = F.array_join(F.filter(pieces, lambda x, i: ~F.array_contains(F.col("_hit"), i)), "")
    cut = F.when(F.col("_hit").isNull(), docs[text]).otherwise(F.concat(left, F.regexp_extract(docs[text], f"({_SEPARATOR}*)$", 1)))
    return joined.select(*(cut.alias(c) if c == text else docs[c] for c in docs.columns))
