"""Packing documents into fixed-length sequences by cutting-stock column generation.

1. One pass over the texts: token ids (plus an end id) of every document, cut
   into pieces of ``length`` tokens and a shorter last piece.  Texts of Latin
   letters are merged by ranks, whole; of others the ids of distinct words are kept
   per Python worker, as the tokenizer's own pre-tokenizer always cuts before a
   space or line end that stands alone.
2. A full piece is a sequence of its own.  The shorter ones are counted by
   length class (multiples of ``grain`` tokens, rounded up): a histogram of at most
   ``length / grain`` numbers, whatever the input.
3. On that histogram a linear program chooses how often to use each pattern
   of classes; knapsack dynamic programming prices new patterns until none
   improves (or the gap to the dual bound is below ``gap``).  Patterns are
   rounded down; the few pieces that remain (a bounded number) are
   packed by decreasing length.
4. Pieces are numbered within their class (an ordered scan) and the n-th
   piece of a class goes to the sequence that holds the n-th place for it.

Defined cases: null and empty texts are one end id; repeated rows are packed
each; a document is never split except at multiples of ``length``; an empty
table gives an empty result; other input columns are not carried.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabflow.llm.common import frugal, prepare, release, require, stored
from cabflow.operators.scan import Agg, keyed_scan

LENGTH, END_ID, GRAIN, GAP, MAX_PIVOTS = 2048, 1, 16, 1e-3, 4000
CACHE = 50_000
#: Bytes of text a Python worker works on at once.
SLICE = 500_000
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
# White space other than a single space or line end; text that the tokenizer reads as a special token.
_ODD = re.compile(r"[^\S \n]|  | \n|\n[ \n]|^[ \n]|[ \n]\Z|<\|endoftext\|>")
# Characters not known to split alike in every Unicode table: none below U+0250, nor general punctuation or currency signs.
_OTHER = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20cf]")
# ``public_tokenizers.PATTERN``, letters first (no two alternatives but the first of "'" and of white space begin alike),
# and all that looks nowhere ahead in one group, which needs no backtracking.
_SPLIT = r"(?: ?\p{L}+|'(?:[sdmt]|ll|ve|re)| ?\p{N}+| ?[^\s\p{L}\p{N}]+)|\s+(?!\S)|\s+"
_MAYBE_ODD = b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f\xc2\xe1\xe2\xe3"


class WordIds:
    """Ids of texts.  Where a vocabulary has its merges in the order of their ids
    (checked when the file is read), texts without characters of ``_OTHER`` are merged
    by ranks, each in one call.

    All others go by word: a batch is split and its words numbered in Arrow,
    words not met lately are tokenized, and ids are gathered with numpy offsets.
    Words of letters below U+0250 are merged by ranks, the rest by the tokenizer
    itself.  Two generations of at most ``CACHE`` words are kept."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.by_rank, self.line = rank_encoder(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def by_words(text: str) -> bool:
        """Does the tokenizer cut this text before every single space and line end?"""
        if "  " in text or " \n" in text or "\n\n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n" or "<|" in text:
            return False
        raw = text.encode("utf-8", "surrogatepass")
        return len(raw.translate(None, _MAYBE_ODD)) == len(raw) or not _ODD.search(text)

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words that a space (or their own line end) precedes."""
        young, old, new = self.young, self.old, []
        for w in words:
            if w not in young:
                b = old.get(w)
                if b is None:
                    new.append(w)
                else:
                    young[w] = b
        fast = [w for w in new if w[0] != "\n" and (w.isascii() or max(w) < "\u0250")] if self.by_rank else []
        young.update(zip(fast, self.ranked(fast)))
        slow = [w for w in new if w not in young]
        young.update(zip(slow, self.whole([w if w[0] == "\n" else " " + w for w in slow])))
        out = list(map(young.__getitem__, words))
        if len(young) > CACHE:
            self.old, self.young = young, {}
        return out

    def ranked(self, words: list[str]) -> list[bytes]:
        """Ids of the words in one call: a line end between two words is an id of
        its own, which no word holds."""
        if not words:
            return []
        ids = self.by_rank(" " + "\n ".join(words))
        ends = [*np.flatnonzero(ids == self.line).tolist(), len(ids)]
        if len(ends) != len(words):
            return []
        data = ids.astype("<u4").tobytes()
        return [data[4 * x:4 * y] for x, y in zip([0, *(e + 1 for e in ends[:-1])], ends)]

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        flat, begin = self.encoded(texts, 0)
        return [flat[x:y - 1].tobytes() for x, y in zip(begin.tolist(), [*begin[1:].tolist(), len(flat)])]

    def at_once(self, text: str | None) -> np.ndarray | None:
        """Ids of a whole text, merged by ranks; None where it must go by word."""
        if not text:
            return np.zeros(0, "<u4")
        if not self.by_rank or "<|" in text or not (text.isascii() or not _OTHER.search(text)):
            return None
        try:
            return self.by_rank(text)
        except ValueError:  # more white space in a row than its pattern can go back over
            return None

    def encoded(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, an end id after each, and where each text begins."""
        ids, end = list(map(self.at_once, texts)), np.array([end_id], "<u4")
        rest = [i for i, x in enumerate(ids) if x is None]
        if rest:
            flat, begin = self.gathered([texts[i] for i in rest], end_id)
            for i, x, y in zip(rest, begin.tolist(), [*begin[1:].tolist(), len(flat)]):
                ids[i] = flat[x:y - 1]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) + 1
        out = np.concatenate([np.zeros(0, "<u4"), *(part for x in ids for part in (x, end))])
        return out.astype("<u4", copy=False), np.cumsum(size) - size

    def gathered(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``encoded`` by word."""
        import pyarrow as pa
        import pyarrow.compute as pc
        kind = np.array([0 if not t else 1 if self.by_words(t) else 2 for t in texts], np.int8)
        split, odd = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
        pool = [array("I", [end_id]).tobytes(), *self.whole([texts[i] for i in odd.tolist()])]
        parts = np.ones(len(texts), np.int64)  # places of each text: words or the whole, then the end
        parts[odd] = 2
        if len(split):
            lists = pc.split_pattern(pc.replace_substring(pa.array([texts[i] for i in split.tolist()], pa.large_string()), "\n", " \n"), " ")
            starts = lists.offsets.to_numpy()
            parts[split] = np.diff(starts) + 1
            flat = lists.flatten()
            first = pool_at = len(pool)
            pool += self.whole(flat.take(pa.array(starts[:-1])).to_pylist())
            pool_at = len(pool)
            coded = flat.dictionary_encode()
            codes = coded.indices.to_numpy().astype(np.int64) + pool_at
            codes[starts[:-1]] = first + np.arange(len(split))
            used = np.zeros(len(coded.dictionary), bool)
            used[np.delete(codes, starts[:-1]) - pool_at] = True
            at = np.flatnonzero(used)
            place = np.cumsum(used) - 1
            rest = np.ones(len(codes), bool)
            rest[starts[:-1]] = False
            codes[rest] = pool_at + place[codes[rest] - pool_at]
            pool += self.words(coded.dictionary.take(pa.array(at)).to_pylist())
        begin = np.cumsum(parts) - parts
        order = np.zeros(int(parts.sum()), np.int64)
        order[begin[odd]] = 1 + np.arange(len(odd))
        if len(split):
            inside = np.repeat(kind == 1, parts)
            inside[begin + parts - 1] = False
            order[inside] = codes
        size = np.fromiter(map(len, pool), np.int64, len(pool)) // 4
        source = np.cumsum(size) - size
        length = size[order]
        target = np.cumsum(length) - length
        ids = np.frombuffer(b"".join(pool), "<u4")
        out = ids[np.repeat(source[order] - target, length) + np.arange(int(length.sum()))]
        return out, target[begin]


def rank_encoder(path: str):
    """A merge by ranks (tiktoken) of the vocabulary in ``path``, texts to arrays of
    ids, and the id of a line end; (None, 0) where ids do not stand for the order of merges."""
    import json

    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    if model.get("type") != "BPE" or spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or model.get("dropout"):
        return None, 0
    # Byte-level vocabularies write the bytes that do not print as letters from U+0100 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = {k: v for k, v in model["vocab"].items() if k not in special}
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ordered = [vocab.get(m, -1) for m in merges]
    if ordered != sorted(ordered) or ordered[0] < 256 or any(c not in letter for k in vocab for c in k):
        return None, 0
    ranks = {bytes(letter[c] for c in k): v for k, v in vocab.items()}
    encoding = tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})
    return lambda text: encoding.encode_to_numpy(text, disallowed_special=()), ranks[b"\n"]


_WORD_IDS: dict[str, WordIds] = {}


def runs(sizes: np.ndarray, most: float):
    """Slices of rows with about ``most`` bytes each (a larger row by itself)."""
    part = np.floor(np.cumsum(sizes) / most)
    cuts = [0, *(1 + np.flatnonzero(np.diff(part))).tolist(), len(sizes)]
    return [(s, e) for s, e in zip(cuts, cuts[1:]) if e > s]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
           length: int = LENGTH, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, start, length, ids_crc32,
    doc_tokens and, if asked for, their ids (little-endian 32-bit)."""
    require(docs, doc_id=doc_id, text=text)
    prepare(docs.sparkSession)
    path = tokenizer or default_tokenizer()

    def run(batches):
        if path not in _WORD_IDS:
            _WORD_IDS[path] = WordIds(path)
            release()
        words = _WORD_IDS[path]
        try:
            yield from cut(words, batches)
        finally:
            words.young, words.old = {}, {}  # the worker stays for other stages

    def cut(words, batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for b in batches:
            lengths = pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False)
            for s, e in runs(np.nan_to_num(lengths), SLICE):
                part = b.slice(s, e - s)
                ids, begin = words.encoded(part.column(1).to_pylist(), end_id)
                data = memoryview(ids.tobytes())
                rows = []
                for d, x, y in zip(part.column(0).to_pylist(), begin.tolist(), [*begin[1:].tolist(), len(ids)]):
                    for o in range(x, y, length):
                        p = data[4 * o:4 * min(o + length, y)]
                        rows.append((d, o - x, len(p) // 4, zlib.crc32(p), y - x, bytes(p) if keep_ids else None))
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 5 + [pa.binary()])],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    out = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(frugal(run), _PIECES)
    return out if keep_ids else out.drop("ids")


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best unbounded filling of ``capacity``: its value and its counts."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fits = np.searchsorted(sizes, c, "right")
        best[c], last[c] = best[c - 1], -1
        if fits:
            v = best[c - sizes[:fits]] + values[:fits]
            k = int(v.argmax())
            if v[k] > best[c]:
                best[c], last[c] = v[k], k
    counts, c = np.zeros(len(sizes), int), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[last[c]] += 1
            c -= sizes[last[c]]
    return float(best[capacity]), counts


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP,
                      max_pivots: int = MAX_PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one per column) and how often each is used, from the linear
    program min sum x, A x = demand, x >= 0 (revised simplex; ``sizes``
    ascending).  Any basis on the way is feasible, so stopping early only
    costs padding."""
    m = len(sizes)
    A = np.diag(capacity // sizes).astype(float)
    inverse, x = np.diag(1 / np.diag(A)), demand / np.diag(A)
    for _ in range(max_pivots):
        dual = inverse.sum(0)
        value, column = knapsack(dual, sizes, capacity)
        if value <= 1 + 1e-9 or x.sum() - (dual * demand).sum() / value <= gap * x.sum():
            break
        d = (inverse * column).sum(1)
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        r = int(ratio.argmin())
        step = ratio[r]
        x = np.maximum(x - step * d, 0)
        x[r] = step
        inverse[r] /= d[r]
        others = np.arange(m) != r
        inverse[others] -= np.outer(d[others], inverse[r])
        A[:, r] = column
    return A.astype(int), x


def places(demand: dict[int, int], capacity: int, gap: float = GAP) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Where the pieces of each class go.

    ``demand``: size class -> number of pieces.  Returns rows (class, first
    rank, end rank, per sequence, first sequence, place) and the number of
    sequences: ranks first..end-1 fill the pattern's sequences with ``per
    sequence`` pieces each; ``place`` orders the classes in a sequence.
    """
    sizes = np.array(sorted(demand), int)
    need = np.array([demand[s] for s in sizes], int)
    if not len(sizes):
        return [], 0
    A, x = column_generation(sizes, need.astype(float), capacity, gap)
    used, rows, total = np.zeros(len(sizes), int), [], 0

    def use(column, times):
        nonlocal total
        for place, k in enumerate(np.nonzero(column)[0][::-1]):
            n = int(column[k]) * times
            rows.append((int(sizes[k]), int(used[k]), int(used[k]) + n, int(column[k]), total, place))
            used[k] += n
        total += times

    order = np.argsort(-(x - np.floor(x)), kind="stable")
    for j in range(A.shape[1]):
        if times := int(np.floor(x[j] + 1e-9)):
            times = min(times, int(min((need - used)[A[:, j] > 0] // A[:, j][A[:, j] > 0])))
            if times > 0:
                use(A[:, j], times)
    for j in order:  # one more of the patterns that were cut most, where all their pieces remain
        if (A[:, j] <= need - used).all() and A[:, j].any():
            use(A[:, j], 1)
    left = need - used  # a bounded rest: what rounding left, by decreasing size
    while left.any():
        column, room = np.zeros(len(sizes), int), capacity
        for k in range(len(sizes) - 1, -1, -1):
            n = min(int(left[k]), room // int(sizes[k]))
            column[k], room = n, room - n * int(sizes[k])
        times = int(min(left[column > 0] // column[column > 0]))
        use(column, times)
        left = need - used
    return rows, total


def pack(cut: DataFrame, length: int = LENGTH, grain: int = GRAIN, gap: float = GAP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces (read several
    times: pass a stored one)."""
    spark = cut.sparkSession
    keep = cut.columns
    group = F.when(F.col("length") == length, F.lit(0)).otherwise(F.ceil(F.col("length") / grain)).cast("int")
    d = cut.withColumn("class", group)
    totals = {r["class"]: r["count"] for r in d.groupBy("class").count().collect()}  # at most length / grain + 1 rows
    every, full = sum(totals.values()), totals.pop(0, 0)
    rows, n = places(totals, length // grain, gap)
    # A class may hold most pieces: an ordered scan numbers them, in at most about four slots for each partition.
    width = max(256, every // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ranked = keyed_scan(d, ["class"], ["doc_id", "start", "ids_crc32"], [Agg("rank", "count", inclusive=True)], width).withColumn("rank", F.col("rank") - 1)
    # A bounded table: a row per class and pattern, and one per piece of the bounded rest.
    where = spark.createDataFrame([(0, 0, full, 1, n, 0)] + rows, "class int, from_rank long, to_rank long, per long, sequence long, place int")
    put = (ranked.join(F.broadcast(where.withColumnRenamed("class", "c")), (F.col("class") == F.col("c")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")))
           .withColumn("sequence_id", F.col("sequence") + F.floor((F.col("rank") - F.col("from_rank")) / F.col("per"))))
    within = Window.partitionBy("sequence_id").orderBy("place", "rank").rowsBetween(Window.unboundedPreceding, -1)
    alone = put.where("class = 0").withColumn("offset", F.lit(0).cast("long"))
    shared = put.where("class > 0").withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0)).cast("long"))
    return alone.unionByName(shared).select(*keep, F.col("sequence_id").cast("long").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                   length: int = LENGTH, end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence and offset of each."""
    return pack(stored(pieces(docs, doc_id, text, tokenizer, length, end_id, keep_ids)), length)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves (from ``keep_ids=True``): sequence_id and ids,
    not padded; a sequence has at most ``length`` tokens, so a group is small."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.unhex(F.array_join(F.transform(parts, lambda p: p["ids"]), "")).alias("ids"))
