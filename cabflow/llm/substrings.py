"""Repeated passages: super-k-mer partitioning of word windows, counted exactly.

A window is ``WINDOW`` consecutive words of a document.  A word goes if a window
that covers it also starts in a document with a smaller id.

1. A task joins the words of its texts by one space and gives every run of
   ``MER`` words a hash.  The least hash inside a window is its minimiser;
   consecutive windows with the same minimiser are one super-k-mer and travel as
   one packed string to the bucket their minimiser names.  Equal windows have
   equal minimisers, so they meet.
2. Equal super-k-mers of one task are settled on the spot: all but those of the
   smallest document lose these words whatever other tasks hold, so only one
   string travels, and a passage of a third of all documents reaches its bucket
   once for each slice of texts.  What a few slices send to one bucket is one
   compressed value (``HOLD``).
3. A bucket sorts its windows by a hash of their words and compares equal
   neighbours word by word; the smallest document of each distinct window
   decides.  Buckets are made by the size of the input, ``BUCKET`` characters
   each.  A bucket ``HEAVY`` times the mean (a frequent line in very many
   different contexts) gives its windows to a plain aggregate by window instead,
   which Spark combines before the shuffle and splits where it is skewed.
4. Spans of a document are merged and joined back to its text, which moves
   compressed.

Defined cases: null and empty texts have no words; texts shorter than a window
lose nothing.  A document without an id loses nothing and takes nothing from
others.  Repeated rows with one id are judged each for themselves: neither is
smaller.  Other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import prepare, require, stored

WINDOW = 13
#: Words of the runs that minimisers are chosen from.
MER = 4
#: Characters of packed strings in one bucket, on average.
BUCKET = 16_000_000
#: A bucket above this many times the mean is aggregated by window.
HEAVY = 4
#: Bytes of text a task works on at once (a longer text is cut, windows kept whole).
SLICE = 2_000_000
#: Characters of packed strings a task gathers before it compresses them by bucket.
HOLD = 24_000_000
#: Most windows of one super-k-mer (a text that repeats one word has no change of minimiser).
RUN = 64

_MOVE = "bucket int, size long, body binary"
_OUT = "doc_id long, tkey long, start long, stop long, bucket int, body binary"


def _table():
    import numpy as np
    return np.random.default_rng(12).integers(0, 1 << 63, 64 * 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x):
    import numpy as np
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _words(raw):
    """Starts and ends of the words in an array of bytes: runs of other than
    U+0020 and U+0009 to U+000D."""
    import numpy as np
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[0::2], edge[1::2]


def _parts(rows):
    """Slices of at most about ``SLICE`` bytes: lists of (doc, tkey, bytes, first
    word).  A long text is cut between words, each part repeating the last
    ``WINDOW - 1`` words of the one before."""
    import numpy as np
    out, size = [], 0
    for doc, key, text in rows:
        raw, word = text.encode("utf-8", "surrogatepass"), 0
        while len(raw) > SLICE:
            s, e = _words(np.frombuffer(raw, np.uint8)[:SLICE])
            if len(s) and e[-1] == SLICE:  # the last word may go on
                s, e = s[:-1], e[:-1]
            if len(s) < WINDOW:  # very long words: take as many as a window needs
                s, e = _words(np.frombuffer(raw, np.uint8))
                s, e = s[:WINDOW], e[:WINDOW]
            yield [(doc, key, raw[:e[-1]], word)]
            back = len(s) - (WINDOW - 1)
            if back <= 0:
                raw = b""
                break
            raw, word = raw[s[back]:], word + back
        if not raw:
            continue
        if size + len(raw) > SLICE and out:
            yield out
            out, size = [], 0
        out.append((doc, key, raw, word))
        size += len(raw)
    if out:
        yield out


def _super_kmers(part):
    """Super-k-mers of a slice: packed buffer, their byte spans in it, minimiser,
    hash, number of windows, index of the text and first word."""
    import numpy as np
    raw = np.frombuffer(b"\n".join(p[2] for p in part), np.uint8)
    begins = np.cumsum([0] + [len(p[2]) + 1 for p in part])[:-1]
    s, e = _words(raw)
    if len(s) < WINDOW:
        return None
    text = np.searchsorted(begins, s, "right") - 1
    # canonical buffer: the words, each with one space after it
    length = e - s
    ws = np.concatenate([[0], np.cumsum(length + 1)])
    keep = np.zeros(len(raw) + 1, np.int8)
    keep[s] += 1
    keep[e] -= 1
    letters = raw[np.cumsum(keep[:-1]).astype(bool)]
    packed = np.full(int(ws[-1]), 32, np.uint8)
    spot = np.arange(len(letters)) + np.repeat(np.arange(len(s)), length)
    packed[spot] = letters
    place = np.arange(len(letters)) - np.repeat(np.cumsum(length) - length, length)
    codes = _table()[(place & 63) * 256 + letters] + (place >> 6).astype(np.uint64)
    h = _mix(np.add.reduceat(codes, np.cumsum(length) - length))
    g = h[:len(h) - MER + 1].copy()
    for j in range(1, MER):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - MER + 1 + j]
    least = _mix(g)
    span, width = WINDOW - MER + 1, 1
    while width < span:  # sliding minimum by doubling
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    n = len(s) - WINDOW + 1
    least, valid = least[:n], text[:n] == text[WINDOW - 1:]
    change = np.ones(n, bool)
    change[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1]) | (text[1:n] != text[:n - 1])
    first = np.flatnonzero(change)
    long = np.diff(np.append(first, n))
    if long.max() > RUN:
        pieces = -(-long // RUN)
        first = np.repeat(first, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        long = np.diff(np.append(first, n))
    ok = valid[first]
    first, long = first[ok], long[ok]
    if not len(first):
        return None
    stop = first + long + WINDOW - 1
    roll = np.concatenate([[np.uint64(0)], np.cumsum(_mix(h + _mix(np.concatenate([h[1:], h[:1]]))), dtype=np.uint64)])
    whole = _mix(roll[stop - 1] - roll[first]) ^ _mix(h[first] + long.astype(np.uint64))
    base = np.array([p[3] for p in part], np.int64)
    own = np.searchsorted(text, np.arange(len(part)))  # first word of each text in the slice
    return packed.tobytes(), ws[first], ws[stop] - 1, least[first], whole, long, text[first], base[text[first]] + first - own[text[first]]


def _packer():
    """Compression of one value: its length, then zstd."""
    import pyarrow as pa
    codec = pa.Codec("zstd", compression_level=3)
    return lambda raw: len(raw).to_bytes(8, "little") + codec.compress(raw, asbytes=True)


def _unpacked(body) -> bytes:
    import pyarrow as pa
    n = int.from_bytes(body[:8], "little")
    return pa.Codec("zstd").decompress(body[8:], n, asbytes=True) if n else b""


def _planes(a) -> bytes:
    """An array as the bytes of its steps, all lowest bytes first: small steps leave planes of zeros."""
    import numpy as np
    return np.diff(a, prepend=0).astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _cut(buckets: int):
    """Texts to super-k-mers: rows (bucket, size, body), bodies compressed; spans
    that are settled on the spot go as bodies of size 0."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        pack = _packer()

        def row(b, size, arrays, texts=b""):
            head = np.array([len(a) for a in arrays] + [len(texts)], np.int64).tobytes()
            return b, size, pack(head + b"".join(map(_planes, arrays)) + texts)

        def emit(part, held):
            """Rows to send now; what goes to buckets is added to ``held``."""
            made = _super_kmers(part)
            if made is None:
                return [], 0
            packed, lo, hi, least, whole, long, text, start = made
            doc, key = np.array([p[0] for p in part], np.int64)[text], np.array([p[1] for p in part], np.int64)[text]
            order = np.lexsort((doc, whole, least))
            change = np.ones(len(order), bool)
            change[1:] = (whole[order][1:] != whole[order][:-1]) | (least[order][1:] != least[order][:-1])
            lead = order[np.flatnonzero(change)[np.cumsum(change) - 1]]  # the smallest document with this string
            same = np.zeros(len(order), bool)
            for i in np.flatnonzero(~change).tolist():
                a, b = order[i], lead[i]
                same[i] = packed[lo[a]:hi[a]] == packed[lo[b]:hi[b]]
            settled = same & (doc[order] > doc[lead])
            out, go = [], np.ones(len(lo), bool)
            if settled.any():
                o = order[settled]
                go[o] = False
                out.append(row(int(_mix(doc[o][:1].astype(np.uint64))[0] % np.uint64(buckets)), 0, [doc[o], key[o], start[o], start[o] + long[o] + WINDOW - 1]))
            # the rest travels; a string that one document repeats is one string with several places
            left = go[order]
            order, lead, same = order[left], lead[left], same[left]
            string = np.where(same, lead, order)
            to = (least[string] % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((string, to))
            order, string, to = order[by], string[by], to[by]
            edge = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            more = 0
            for s, e in zip(edge.tolist(), np.append(edge[1:], len(to)).tolist()):
                names, at = np.unique(string[s:e], return_inverse=True)
                texts = b"\n".join(packed[a:b] for a, b in zip(lo[names].tolist(), hi[names].tolist()))
                o = order[s:e]
                held.setdefault(int(to[s]), []).append((len(names), [at, doc[o], key[o], start[o]], texts))
                more += len(texts)
            return out, more

        def joined(b, parts):
            """What several slices send to bucket ``b`` as one row."""
            first = np.cumsum([0] + [n for n, _, _ in parts]).tolist()
            at, *rest = zip(*(arrays for _, arrays, _ in parts))
            texts = b"\n".join(t for _, _, t in parts)
            return row(b, len(texts), [np.concatenate([a + f for a, f in zip(at, first)]), *map(np.concatenate, rest)], texts)

        def sent(out):
            b, size, body = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(size, pa.int64()), pa.array(body, pa.binary())], ["bucket", "size", "body"])

        held, size = {}, 0
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tkey", "text")))
            for part in _parts(rows):
                out, more = emit(part, held)
                if out:
                    yield sent(out)
                size += more
                if size >= HOLD:
                    yield sent([joined(*x) for x in held.items()])
                    held, size = {}, 0
        if held:
            yield sent([joined(*x) for x in held.items()])
    return run


def _body(body, arrays: int):
    import numpy as np
    flat = _unpacked(body)
    sizes = np.frombuffer(flat, np.int64, arrays + 1)
    out, at = [], 8 * (arrays + 1)
    for n in sizes[:-1].tolist():
        steps = np.frombuffer(flat, np.uint8, 8 * n, at).reshape(8, n).T
        out.append(np.cumsum(np.ascontiguousarray(steps).view(np.int64).ravel()))
        at += 8 * n
    return out, flat[at:]


def _strings(bodies):
    """The bodies of a bucket as one: (string, doc, key, start) of every place and
    the strings, joined by newlines."""
    import numpy as np
    parts, texts, n = [], [], 0
    for body in bodies:
        (at, doc, key, start), text = _body(body, 4)
        parts.append((at + n, doc, key, start))
        texts.append(text)
        n += text.count(b"\n") + 1
    return [np.concatenate(c) for c in zip(*parts)], b"\n".join(texts)


def _windows(text):
    """Word numbers of the strings of a bucket (equal numbers: equal words), and
    for every window its first word, string and place in it."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    raw = np.frombuffer(text, np.uint8)
    s, e = _words(raw)
    words = pa.Array.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(np.append(s, len(raw)).astype(np.int64)), pa.py_buffer(text)])
    # a slot ends where the next word starts: cut the space or newline after it
    words = pc.binary_slice(words, 0, -1) if len(raw) == 0 or raw[-1] in (10, 32) else pc.binary_slice(pa.concat_arrays([words[:-1], pa.array([text[s[-1]:] + b" "], pa.large_binary())]), 0, -1)
    ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    lines = np.flatnonzero(raw == 10)
    string = np.searchsorted(lines, s, "right")
    n = len(s) - WINDOW + 1
    at = np.flatnonzero(string[:n] == string[WINDOW - 1:])
    own = np.searchsorted(string, string[at])
    return ids, at, string[at], at - own


def _settle(places, text):
    """Spans (doc, key, start, stop) of the windows that a smaller document has."""
    import numpy as np
    string, doc, key, start = places
    ids, at, of, offset = _windows(text)
    h = _mix(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    w = h[at].copy()
    for j in range(1, WINDOW):
        w = w * np.uint64(0x9E3779B97F4A7C15) + h[at + j]
    n = int(of.max()) + 1
    smallest = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(smallest, string, doc)
    order = np.argsort(w, kind="stable")
    w = w[order]
    near = np.flatnonzero(w[1:] == w[:-1])
    alike = np.zeros(len(order), bool)
    for s in range(0, len(near), 200_000):
        k = near[s:s + 200_000]
        alike[k + 1] = (ids[at[order[k]][:, None] + np.arange(WINDOW)] == ids[at[order[k + 1]][:, None] + np.arange(WINDOW)]).all(1)
    if int(alike.sum()) != len(near):  # different windows of one hash: order all by their words
        order = np.lexsort(tuple(ids[at + j] for j in range(WINDOW)))
        alike = np.zeros(len(order), bool)
        alike[1:] = np.logical_and.reduce([ids[at[order] + j][1:] == ids[at[order] + j][:-1] for j in range(WINDOW)])
    first = np.flatnonzero(~alike)
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(smallest[of[order]], first), np.diff(np.append(first, len(order))))
    # windows are in order of (string, offset); a place loses those with a smaller document
    lines = np.searchsorted(of, np.arange(n + 1))
    count = np.diff(lines)
    lowest = np.minimum.reduceat(least, lines[:-1]) if n else least
    hit = np.flatnonzero(doc > lowest[string])
    m = count[string[hit]]
    place = np.repeat(hit, m)
    window = np.repeat(lines[string[hit]], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    gone = doc[place] > least[window]
    place, word = place[gone], start[place[gone]] + offset[window[gone]]
    if not len(place):
        return None
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (word[1:] != word[:-1] + 1)
    a = np.flatnonzero(new)
    z = np.append(a[1:], len(place)) - 1
    return doc[place[a]], key[place[a]], word[a], word[z] + WINDOW


def _count(most: float):
    """Sorted rows of buckets to spans; the bodies of a bucket above ``most``
    characters come out as they are."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def spans(d, k, s, e):
            n = len(d)
            return pa.RecordBatch.from_arrays([pa.array(d), pa.array(k), pa.array(s), pa.array(e), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                                              ["doc_id", "tkey", "start", "stop", "bucket", "body"])

        def passed(b, bodies):
            n = len(bodies)
            return pa.RecordBatch.from_arrays([*[pa.nulls(n, pa.int64())] * 4, pa.array([b] * n, pa.int32()), pa.array(bodies, pa.binary())],
                                              ["doc_id", "tkey", "start", "stop", "bucket", "body"])

        def close(bodies):
            if not bodies:
                return
            places, text = _strings(bodies)
            found = _settle(places, text)
            if found is not None:
                yield spans(*found)

        now, size, held, heavy = None, 0, [], False
        for batch in batches:
            for b, n, body in zip(*(batch.column(c).to_pylist() for c in ("bucket", "size", "body"))):
                if n == 0:
                    (d, k, s, e), _ = _body(body, 4)
                    yield spans(d, k, s, e)
                    continue
                if b != now:
                    yield from close(held)
                    now, size, held, heavy = b, 0, [], False
                size += n
                held.append(body)
                if size > most or heavy:
                    yield passed(b, held)
                    held, heavy = [], True
        yield from close(held)
    return run


def _unpack(batches):
    """Windows of heavy buckets as rows: doc, key, word and the window's text."""
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        for body in batch.column("body").to_pylist():
            (string, doc, key, start), text = _body(body, 4)
            lines = [x.split(b" ") for x in text.split(b"\n")]
            d, k, s, w = [], [], [], []
            for i, di, ki, si in zip(string.tolist(), doc.tolist(), key.tolist(), start.tolist()):
                for j in range(len(lines[i]) - WINDOW + 1):
                    d.append(di), k.append(ki), s.append(si + j), w.append(b" ".join(lines[i][j:j + WINDOW]))
                if len(d) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in ((d, pa.int64()), (k, pa.int64()), (s, pa.int64()), (w, pa.binary()))], ["doc_id", "tkey", "start", "window"])
                    d, k, s, w = [], [], [], []
            if d:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in ((d, pa.int64()), (k, pa.int64()), (s, pa.int64()), (w, pa.binary()))], ["doc_id", "tkey", "start", "window"])


def repeated_spans(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Word spans [start, stop) that earlier documents hold: ``doc_id``, ``tkey``
    (xxhash64 of the text: rows may share an id), ``start``, ``stop``; spans of a
    document may touch and overlap."""
    require(docs, text=text, ident=ident)
    spark = docs.sparkSession
    prepare(spark)
    d = docs.select(F.col(ident).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("tkey"), F.col(text).alias("text"))
    d = d.where("doc_id is not null and text is not null")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chars = d.agg(F.sum(F.length("text"))).head()[0] or 0
    packed = 3.1 * chars  # a super-k-mer holds about 5.7 windows and 12 words more
    buckets = min(1 << 30, max(8 * n, math.ceil(packed / BUCKET)))
    moved = d.mapInArrow(_cut(buckets), _MOVE).repartition(n, "bucket").sortWithinPartitions("bucket")
    found = stored(moved.mapInArrow(_count(max(1_000_000, HEAVY * packed / buckets)), _OUT))
    light = found.where("bucket is null").select("doc_id", "tkey", "start", "stop")
    windows = found.where("bucket is not null").select("body").repartition(n).mapInArrow(_unpack, "doc_id long, tkey long, start long, window binary")
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"))
    late = windows.join(least, "window").where("doc_id > least")
    return light.unionByName(late.select("doc_id", "tkey", "start", (F.col("start") + WINDOW).alias("stop")))


def _packed_texts(batches):
    import pyarrow as pa
    pack = _packer()
    for batch in batches:
        texts = [None if t is None else pack(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tkey"), pa.array(texts, pa.binary())], ["doc_id", "tkey", "text"])


def _digest(batches):
    import hashlib
    import re

    import pyarrow as pa
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for batch in batches:
        out = []
        for doc, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
            words = word.findall(_unpacked(text).decode()) if text is not None else []
            kept, at = [], 0
            for s in spans or ():
                kept += words[at:s["start"]] if s["start"] > at else []
                at = max(at, s["stop"])
            kept += words[at:]
            out.append((doc, len(words), len(words) - len(kept), " ".join(kept)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))] if out
                                         else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())], ["doc_id", "n_words", "n_removed", "text"])


def remove_repeats(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``n_removed`` and ``text``, the words
    that stay joined by one space."""
    spans = repeated_spans(docs, text, ident)
    per = spans.groupBy("doc_id", "tkey").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    d = docs.select(F.col(ident).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("tkey"), F.col(text).cast("string").cast("binary").alias("text"))
    d = d.mapInArrow(_packed_texts, "doc_id long, tkey long, text binary")
    return d.join(per, ["doc_id", "tkey"], "left").select("doc_id", "text", "spans").mapInArrow(_digest, "doc_id long, n_words long, n_removed long, text string")


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
WITH w AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
wins AS (SELECT r, doc_id, i, array_to_string(list_slice(ws, i, i + 12), ' ') AS win FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
late AS (SELECT wins.r, wins.i FROM wins JOIN (SELECT win, min(doc_id) AS least FROM wins GROUP BY win) m ON wins.win = m.win WHERE doc_id > least),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS i FROM late),
lists AS (SELECT r, list(i) AS g FROM gone GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed,
    sha256(array_to_string(CASE WHEN g IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(g, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN lists USING (r)
"""
