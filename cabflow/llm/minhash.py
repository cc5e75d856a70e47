"""Near-duplicate documents: ProbMinHash signatures, banding, verification.

Words are runs of characters other than ASCII white space, lower-cased; a
text is its multiset of five-word shingles (a shorter text is one shingle).
Similarity is the probability Jaccard of the shingle counts, which for
shingles that occur once is the common Jaccard similarity.

Signature: every shingle starts a Poisson process whose rate is its count,
seeded by the shingle; an arrival picks a random slot, and a slot keeps the
shingle of its earliest arrival.  Once every slot is taken, a process stops
as soon as its next arrival comes after the latest slot, so a text of n
shingles costs about n plus ``SLOTS`` log ``SLOTS`` arrivals.  Two texts agree in a slot with a
probability equal to their similarity.  Slots are banded; texts that agree
in all slots of a band are candidates.

Linking, without all pairs of a group:

1. Texts with the same words are one class from the start (a 128-bit key).
2. Every class of a bucket is compared with the bucket's centre: the class whose
   buckets are the largest, which in a group of edited copies is the text they
   were made from.  Pairs whose signatures agree in ``LEAST_AGREE`` of the slots
   (5 standard deviations below the threshold) are verified on their shingles.
   Verified links are joined to components.
3. In buckets that still hold several components, ids and signatures of classes are
   dealt over cells of bounded size.  Classes with a partner of another component
   that agrees as much send their shingles to the cell, too, and are verified there, in the
   first band the pair shares; a link found joins two components at once, and only
   links leave a cell, fewer than it has rows.

So a pair of classes that shares a bucket is verified or already in one
component.  With ``BANDS`` bands of ``ROWS`` slots a pair at the threshold shares
no bucket with probability (1 - 0.8 ** ROWS) ** BANDS = 3e-6.

Defined cases: null and empty texts and texts without words link with
nothing; rows with a null id come back with a null class; rows that share an
id are one document of the classes; repeated rows and ties: the smallest id stands
for a class; an empty table gives an empty result; only the named columns
are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import components, dealt, frugal, map_groups, prepare, require, small_batches, stored

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 4  # a band's key holds 16 bits of each of its 4 rows
SLOTS = BANDS * ROWS
LEAST_AGREE, CELL = 0.6, 512
#: Characters whose words and shingles a task holds as arrays at once (a longer text is taken whole).
SLICE = 250_000

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x5851F42D4C957F2D)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer (two multiply-and-shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words and the number of words of each text.

    A word's hash is a polynomial of its bytes, taken from running sums, so
    the whole batch is hashed without a loop over words.
    """
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    lengths = np.array([len(r) + 1 for r in raw])
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    space = _SPACE[data]
    inside = ~space
    starts = np.nonzero(inside & np.concatenate([[True], space[:-1]]))[0]
    ends = np.nonzero(inside & np.concatenate([space[1:], [True]]))[0] + 1
    owner = np.searchsorted(np.cumsum(lengths), starts, "right")
    hashes = np.empty(len(starts), np.uint64)
    # Powers restart every 65,536 bytes, so that they come from one small table.
    power, inverse = _powers(1 << 16)
    step = len(power) - 1
    with np.errstate(over="ignore"):
        a = 0
        while a < len(starts):
            at = int(starts[a])
            b = max(a + 1, int(np.searchsorted(ends, at + step, "right")))
            piece = data[at:int(ends[b - 1])]
            if len(piece) > step:  # one word longer than the table: by itself
                hashes[a] = np.uint64(int.from_bytes(hashlib.blake2b(piece.tobytes(), digest_size=8).digest(), "little"))
                a = b
                continue
            sums = np.concatenate([[np.uint64(0)], np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[:len(piece)], dtype=np.uint64)])
            s, e = starts[a:b] - at, ends[a:b] - at
            hashes[a:b] = scramble((sums[e] - sums[s]) * inverse[s] + _GOLD * (e - s).astype(np.uint64))
            a = b
    return hashes, np.bincount(owner, minlength=len(texts))


_POWERS: list = []


def _powers(n: int):
    if not _POWERS:
        with np.errstate(over="ignore"):
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            _POWERS.append(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE), dtype=np.uint64)]))
            _POWERS.append(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, inverse), dtype=np.uint64)]))
    return _POWERS


def shingles(texts: list[str | None], words: int = WORDS):
    """Distinct shingle hashes of each text: (hash, count, owner, keys).

    ``keys`` holds two 64-bit numbers per text that depend on all its words
    in order, (0, 0) for a text without words.
    """
    hashes, n = word_hashes(texts)
    first = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), n)
    place = np.arange(len(hashes)) - first[doc]
    with np.errstate(over="ignore"):
        keys = np.zeros((len(texts), 2), np.uint64)
        for k in range(2):
            mixed = scramble(hashes + scramble(place.astype(np.uint64) * _GOLD + np.uint64(k + 1)))
            total = np.concatenate([[np.uint64(0)], np.cumsum(mixed, dtype=np.uint64)])
            keys[:, k] = total[first + n] - total[first]
        keys[n > 0, 0] |= np.uint64(1)
        count = np.maximum(n - words + 1, (n > 0).astype(int))  # a text shorter than a shingle is one shingle
        owner = np.repeat(np.arange(len(texts)), count)
        start = np.repeat(first, count) + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        h = np.zeros(len(owner), np.uint64)
        for j in range(words):
            there = (start + j) < (first + n)[owner]
            h = np.where(there, scramble(h * _M2 + hashes[np.minimum(start + j, max(len(hashes) - 1, 0))] + np.uint64(j + 1)), h)
    order = np.argsort(h)
    small = owner.astype(np.uint16) if len(texts) < 65536 else owner  # 16-bit keys are sorted by radix
    order = order[np.argsort(small[order], kind="stable")]
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    at = np.nonzero(new)[0]
    return h[at], np.diff(np.concatenate([at, [len(h)]])), owner[at], keys


def signatures(h: np.ndarray, weight: np.ndarray, owner: np.ndarray, texts: int, slots: int = SLOTS) -> np.ndarray:
    """(texts, slots) hashes of the shingles that won each slot; 0 where a text has none."""
    time = np.full(texts * slots, np.inf)
    winner = np.zeros(texts * slots, np.uint64)
    active, arrival, state = np.arange(len(h)), np.zeros(len(h)), h.copy()
    latest = np.full(texts, np.inf)
    with np.errstate(over="ignore"):
        while len(active):
            state = scramble(state + _GOLD)
            gap = -np.log(((state >> np.uint64(11)).astype(float) + 0.5) / 2.0 ** 53)
            arrival = arrival + gap / weight[active]
            go = arrival < latest[owner[active]]
            active, arrival, state = active[go], arrival[go], state[go]
            if not len(active):
                break
            slot = owner[active] * slots + (((scramble(state ^ _BASE) >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)).astype(np.int64)
            better = arrival < time[slot]
            s, t, w = slot[better], arrival[better], h[active[better]]
            order = np.argsort(t, kind="stable")[::-1]  # the earliest is written last and stays
            time[s[order]] = t[order]
            winner[s[order]] = w[order]
            latest = time.reshape(texts, slots).max(1)
    return winner.reshape(texts, slots)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit number for the slots of each band: 16 bits of each of its ``ROWS``
    winners.  So the keys are the signature, too, see ``agreement``."""
    return np.ascontiguousarray((signature & np.uint64(0xFFFF)).astype("<u2")).view("<i8")


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots of signatures given as band keys, row by row."""
    return (np.ascontiguousarray(a).view("<u2") == np.ascontiguousarray(b).view("<u2")).mean(-1)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two weighted sets (sorted hashes, counts):
    sum over shared i of 1 / sum over j of max(a_j / a_i, b_j / b_i)."""
    (ha, wa), (hb, wb) = a, b
    shared, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    x, y = wa[ia].astype(float), wb[ib].astype(float)
    if (x == 1).all() and (y == 1).all() and (wa == 1).all() and (wb == 1).all():
        return len(shared) / (len(ha) + len(hb) - len(shared))
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # For i, a's part of the sum is over j with ratio_j >= ratio_i, b's over the rest.
    ge = np.searchsorted(ratio, ratio, "left")
    above = np.concatenate([np.cumsum(x[::-1])[::-1], [0]])[ge] + wa.sum() - x.sum()
    below = np.concatenate([[0], np.cumsum(y)])[ge] + wb.sum() - y.sum()
    return float((1 / (above / x + below / y)).sum())


_SIGNED = "doc_id long, k1 long, k2 long, bands array<long>"


def _bands(column) -> np.ndarray:
    """A column of band keys as a matrix."""
    c = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1)


def signed(docs: DataFrame, doc_id: str, text: str, words: int = WORDS) -> DataFrame:
    """doc_id, text key and band keys of every row; key 0, 0 for no words."""

    def run(batches):
        import pyarrow as pa
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            for s, e in small_batches(texts, SLICE):
                h, w, owner, keys = shingles(texts[s:e], words)
                bands = band_keys(signatures(h, w, owner, e - s))
                k = keys.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(s, e - s), pa.array(k[:, 0]), pa.array(k[:, 1]),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32)), pa.array(bands.ravel()))],
                    names=["doc_id", "k1", "k2", "bands"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(frugal(run), _SIGNED)


def pack_set(h: np.ndarray, w: np.ndarray) -> bytes:
    """A shingle set as bytes: 48 bits of each hash (two shingles of a pair of
    texts meet by chance about once in 10**9 pairs), and counts only if one is over 1."""
    once = bool((w == 1).all())
    low = np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]
    return bytes([once]) + low.tobytes() + (b"" if once else w.astype("<u4").tobytes())


def unpack_set(data) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(data, np.uint8)
    n = (len(raw) - 1) // (6 if raw[0] else 10)
    h = np.zeros((n, 8), np.uint8)
    h[:, :6] = raw[1:1 + 6 * n].reshape(n, 6)
    return h.view("<u8").ravel(), np.ones(n, np.uint32) if raw[0] else np.frombuffer(raw[1 + 6 * n:].tobytes(), "<u4")


def likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose signatures (rep, bands) agree in ``LEAST_AGREE``
    of the slots: 192 bytes a text, before any shingle set moves."""
    sides = (pairs.join(reps.select(F.col("rep").alias("a"), F.col("bands").alias("sa")), "a")
             .join(reps.select(F.col("rep").alias("b"), F.col("bands").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batches):
        import pyarrow as pa
        for t in batches:
            if t.num_rows:
                keep = np.flatnonzero(agreement(_bands(t.column("sa")), _bands(t.column("sb"))) >= LEAST_AGREE)
                yield t.select(["a", "b"]).take(pa.array(keep))

    return sides.mapInArrow(run, "a long, b long")


def with_sets(rows: DataFrame, columns: list[str], words: int = WORDS) -> DataFrame:
    """``columns`` of rows with a ``text``, and its distinct shingles with counts as
    packed binary ``sh``."""

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = b.column("text").to_pylist()
            for s, e in small_batches(texts, SLICE):
                h, w, owner, _ = shingles(texts[s:e], words)
                cuts = np.searchsorted(owner, np.arange(e - s + 1))
                sets = pa.array([pack_set(h[x:y], w[x:y]) for x, y in zip(cuts, cuts[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(s, e - s) for c in columns], sets], names=[*columns, "sh"])

    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = ", ".join(f"{c} {kinds[c].simpleString()}" for c in columns)
    return rows.select(*columns, "text").mapInArrow(frugal(run), f"{schema}, sh binary")


def sets_of(wanted: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """rep and ``sh`` of the texts (rep, text) whose rep is ``wanted``.  The ids are
    written first: where they are few, Spark broadcasts them and no text moves."""
    ids = stored(wanted.select("rep").distinct())
    return stored(with_sets(texts.join(ids, "rep"), ["rep"], words))


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those of ``pairs`` (centre a, b) whose shingle sets (rep, sh) are similar enough.

    The members of a centre are dealt over cells of ``CELL``; a text's set travels
    once to each cell it is in, the centre's first."""
    size = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    cell = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / F.lit(CELL)))
    members = pairs.join(size, "a").select("a", cell.cast("int").alias("cell"), F.col("b").alias("rep"), F.lit(1).alias("role"))
    centres = members.select("a", "cell").distinct().select("a", "cell", F.col("a").alias("rep"), F.lit(0).alias("role"))
    placed = stored(members.unionByName(centres))

    def compare(t):
        import pyarrow as pa
        # repeated rows of an id are one text here
        rows = dict.fromkeys(zip(t.column("role").to_pylist(), t.column("rep").to_pylist(), t.column("sh").to_pylist()))
        heads = [unpack_set(sh) for role, _, sh in rows if role == 0]
        members = ((rep, unpack_set(sh)) for role, rep, sh in rows if role == 1)
        near = [rep for rep, s in members if any(similarity(h, s) >= threshold for h in heads)]
        if near:
            yield pa.RecordBatch.from_arrays([pa.array([t.column("a")[0].as_py()] * len(near), pa.int64()), pa.array(near, pa.int64())], names=["a", "b"])

    return map_groups(placed.join(sets, "rep").select("a", "cell", "role", "rep", "sh"), ["a", "cell"], compare, "a long, b long", ["role"])


def _pairs_of(t, keep):
    """Rows x of a cell with the rows y that may link with them: of another
    component, alike in ``LEAST_AGREE`` of the slots, this being the first band the
    pair shares.  ``keep(x, y)`` is called for each x."""
    n = t.num_rows
    part, block = t.column("part").to_numpy().copy(), t.column("block").to_numpy()
    bands = _bands(t.column("bands"))
    i, j, band = (t.column(c)[0].as_py() for c in ("cell_i", "cell_j", "band"))
    right = np.flatnonzero(block == j) if n > 1 else []
    for x in np.flatnonzero(block == i) if n > 1 else []:
        y = right[right > x] if i == j else right
        y = y[part[y] != part[x]]
        y = y[agreement(bands[y], np.broadcast_to(bands[x], bands[y].shape)) >= LEAST_AGREE]
        y = y[~(bands[y, :band] == bands[x, :band]).any(1)]
        if len(y):
            keep(x, y, part)


def _hopeful(t):
    """Rows of a cell that have a partner to be verified with."""
    import pyarrow as pa
    found = np.zeros(t.num_rows, bool)

    def keep(x, y, part):
        found[x] = True
        found[y] = True

    _pairs_of(t, keep)
    if found.any():
        yield from t.take(pa.array(np.flatnonzero(found))).to_batches()


def _linker(threshold: float):
    """Links between different components of one cell."""

    def cell(t):
        import pyarrow as pa
        ids, links = t.column("rep").to_numpy(), []
        sets = [unpack_set(v.as_buffer()) for v in t.column("sh").combine_chunks()]

        def keep(x, y, part):
            for k in y:
                if part[k] != part[x] and similarity(sets[x], sets[k]) >= threshold:
                    links.append((ids[x], ids[k]))
                    part[part == part[k]] = part[x]

        _pairs_of(t, keep)
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return cell


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, exact_id (smallest id with the
    same words), class_id (smallest id of the near-duplicate class) and kept."""
    require(docs, doc_id=doc_id, text=text)
    prepare(docs.sparkSession)
    every = stored(signed(docs, doc_id, text, words))
    some = every.where("doc_id is not null and not (k1 = 0 and k2 = 0)")
    firsts = some.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    members = stored(some.select("doc_id", "k1", "k2").join(firsts, ["k1", "k2"]))
    reps = stored(some.join(firsts, ["k1", "k2"]).where("doc_id = rep").dropDuplicates(["k1", "k2"]).select("rep", "bands"))
    bands = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = (bands.groupBy("band", "key").agg(F.min("rep").alias("least"), F.max("rep").alias("most"), F.count(F.lit(1)).alias("n")).where("least < most"))
    in_bucket = stored(bands.join(shared.select("band", "key", "n"), ["band", "key"]))
    weights = in_bucket.groupBy("rep").agg(F.sum("n").alias("weight"))
    weighed = in_bucket.join(weights, "rep")
    centres = (weighed.groupBy("band", "key").agg(F.max(F.struct("weight", (-F.col("rep")).alias("minus"))).alias("top"))
               .select("band", "key", (-F.col("top.minus")).alias("a")))
    stars = in_bucket.join(centres, ["band", "key"]).where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    texts = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).cast("string").alias("text"))
    pairs = stored(likely(stars, reps))
    sets = sets_of(pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))), texts, words)
    links = stored(verified(pairs, sets, threshold).distinct())
    first = components(links)
    # Buckets that still hold several components: ids and signatures first, sets only of texts that have a likely partner.
    tagged = in_bucket.select("band", "key", "rep").join(first.withColumnRenamed("id", "rep"), "rep", "left").withColumn("part", F.coalesce("component", "rep")).drop("component")
    open_ = tagged.groupBy("band", "key").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("band", "key")
    rest = stored(tagged.join(open_, ["band", "key"]))
    keys = ["band", "key", "cell_i", "cell_j"]
    columns = [*keys, "block", "rep", "part", "bands"]
    cells = dealt(rest, ["band", "key"], "rep", CELL).join(reps, "rep").select(*columns)
    hopeful = stored(map_groups(cells, keys, _hopeful, "band int, key long, cell_i int, cell_j int, block int, rep long, part long, bands array<long>"))
    more = sets_of(hopeful.join(sets, "rep", "left_anti"), texts, words)
    asked = hopeful.join(sets.unionByName(more), "rep").select(*columns, "sh")
    again = stored(map_groups(asked, keys, _linker(threshold), "a long, b long").distinct())
    parts = components(links.unionByName(again))
    classes = members.select("doc_id", "rep").join(parts.withColumnRenamed("id", "rep"), "rep", "left")
    out = classes.select("doc_id", F.col("rep").alias("exact_id"), F.coalesce("component", "rep").alias("class_id"))
    none = every.where("doc_id is null or (k1 = 0 and k2 = 0)").select("doc_id", F.col("doc_id").alias("exact_id"), F.col("doc_id").alias("class_id"))
    return out.unionByName(none).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stand for their class, with the columns they came
    with.  Rows without words or without an id link with nothing and stay;
    equal rows of the standing id stay once each."""
    gone = stored(near_duplicates(docs, doc_id, text).where("doc_id <> class_id").select(F.col("doc_id").alias("gone_id")).distinct())
    return docs.join(gone, docs[doc_id].cast("long") == gone["gone_id"], "left_anti")
