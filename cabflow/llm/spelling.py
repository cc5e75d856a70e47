"""Spelling variants: blocked Gram matrices of letter counts, verified edits.

Two words are near if they differ by exactly one inserted, deleted or replaced
letter.  Such words have letter-count vectors at a squared distance of at most
two, and lengths that differ by one at most.

1. The alphabet is dealt, by letter frequency, to ``PARTS`` parts.  An edit
   touches the counts of two letters at most, so all but two of the parts keep
   their counts: words that share the counts of ``PARTS - 2`` parts form a block
   and every near pair meets in one.  A block above ``CELL`` words is dealt over
   cells, each pair of words meeting in one of them.
2. Inside a block the words are ordered by length; NumPy products of the
   letter-count matrices of a length block with itself and with the next length
   give all squared distances.  Pairs at most two apart are verified letter by
   letter, and leave the task in the first block they share only.
3. A word's form is its near word of largest count, if that is at least
   ``ratio`` times its own; roots follow the forms, which end after as many
   steps as a count has digits, by doubling.

Defined cases: null and empty texts hold no words; a null id counts as empty
text in the noise rule; repeated rows count again; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import prepare, require, stored

PARTS = 4
CELL = 4_000
#: Rows a task holds at once besides a block that is larger.
CHUNK = 20_000
#: Letter products at once: rows of one side.
STRIP = 2_000
# The letters of a word, as code points (A-Z are lower-cased).
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]


def noised_words(docs: DataFrame, least_length: int = 7, least_count: int = 2, one_in: int = 31, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Distinct words of the whole texts with their counts (``word``, ``n``).

    Runs of letters, A-Z lower-cased; where ``one_in`` divides the crc32 of
    ``<id>:<run>``, the letter at that number modulo the length is deleted."""
    require(docs, text=text, ident=ident)
    prepare(docs.sparkSession)
    d = docs.select(F.coalesce(F.col(ident).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t")).where("t is not null")

    def count(batches):
        import re
        import zlib
        from collections import Counter

        import pyarrow as pa
        run = re.compile(f"[A-Za-zÀ-ÿ]{{{least_length},}}")
        lower = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})
        for batch in batches:
            total = Counter()
            for i, t in zip(batch.column("i").to_pylist(), batch.column("t").to_pylist()):
                seed = zlib.crc32(f"{i}:".encode())
                for r, n in Counter(run.findall(t)).items():
                    r = r.lower() if r.isascii() else r.translate(lower)
                    h = zlib.crc32(r.encode(), seed)
                    if h % one_in == 0:
                        at = h % len(r)
                        r = r[:at] + r[at + 1:]
                        if len(r) < least_length:
                            continue
                    total[r] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    words = d.mapInArrow(count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def letter_parts(words: DataFrame, parts: int = PARTS) -> list[int]:
    """The part of every letter: letters by frequency, dealt to and fro, so
    that the parts hold about as many letters each.  At most 90 counts reach
    the driver."""
    seen = words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).where("c <> ''")
    count = {ord(r["c"]): r["n"] for r in seen.collect()}
    ranked = sorted(range(len(LETTERS)), key=lambda k: (-count.get(LETTERS[k], 0), k))
    part = [0] * len(LETTERS)
    for place, k in enumerate(ranked):
        turn, step = divmod(place, parts)
        part[k] = step if turn % 2 == 0 else parts - 1 - step
    return part


def _hashes(part: list[int]):
    """For each choice of ``PARTS - 2`` parts, the random weights whose sum over
    a word's letters stands for its counts in these parts."""
    import numpy as np
    parts = max(part) + 1
    draw = np.random.default_rng(11).integers(1, 1 << 63, len(LETTERS), dtype=np.uint64)
    out = np.zeros((len(LETTERS), len(list(combinations(range(parts), parts - 2)))), np.uint64)
    for j, chosen in enumerate(combinations(range(parts), parts - 2)):
        inside = np.isin(part, chosen)
        out[inside, j] = draw[inside]
    return out


def _letters(words):
    """Letter number of every letter of the words, and the words' offsets."""
    import numpy as np
    number = np.full(256, 0, np.uint8)
    number[LETTERS] = np.arange(len(LETTERS))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = number[np.frombuffer("".join(words).encode("latin-1"), np.uint8)]
    return flat, np.concatenate([[0], np.cumsum(lengths)])


def _counts(flat, offsets):
    import numpy as np
    n = len(offsets) - 1
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    return np.bincount(row * len(LETTERS) + flat, minlength=n * len(LETTERS)).reshape(n, len(LETTERS))


def _grid(flat, offsets, longest: int = 64):
    """The words up to ``longest`` letters as rows of a matrix, padded by 255, at
    the left and at the right end; row 0 stands for the longer ones."""
    import numpy as np
    lengths = np.diff(offsets)
    short = lengths <= longest
    row = np.where(short, np.cumsum(short), 0)
    width = int(lengths[short].max(initial=0)) + 1
    out = []
    for shift in (np.zeros(len(lengths), np.int64), width - lengths):
        grid = np.full((int(short.sum()) + 1, width), 255, np.uint8)
        at = np.repeat(row, lengths)
        column = np.arange(len(flat)) - np.repeat(offsets[:-1] - shift, lengths)
        grid[at[at > 0], column[at > 0]] = flat[at > 0]
        out.append(grid)
    return row, out


def _one_edit(flat, offsets, a, b):
    """Which of the pairs (a[i], b[i]), b's word as long or one letter longer,
    are one edit apart."""
    import numpy as np
    la, lb = offsets[a + 1] - offsets[a], offsets[b + 1] - offsets[b]
    row, (left, right) = _grid(flat, offsets)
    ok = np.zeros(len(a), bool)
    for s in range(0, len(a), 100_000):
        x, y, m, extra = row[a[s:s + 100_000]], row[b[s:s + 100_000]], la[s:s + 100_000], (lb > la)[s:s + 100_000]
        here = ok[s:s + 100_000]
        of = np.flatnonzero(~extra & (x > 0) & (y > 0))
        here[of] = (left[x[of]] != left[y[of]]).sum(1) == 1
        # an inserted letter: equal up to it, and equal after it
        of = np.flatnonzero(extra & (x > 0) & (y > 0))
        ahead = (left[x[of]] != left[y[of]]).argmax(1)
        behind = (right[x[of]] != right[y[of]])[:, ::-1].argmax(1)
        here[of] = ahead + behind >= m[of]
    for i in np.flatnonzero((row[a] == 0) | (row[b] == 0)).tolist():  # very long words, one by one
        x, y = (flat[offsets[j]:offsets[j + 1]] for j in (a[i], b[i]))
        if len(x) == len(y):
            ok[i] = (x != y).sum() == 1
        else:
            ahead, behind = np.append(x != y[:-1], True).argmax(), np.append((x != y[1:])[::-1], True).argmax()
            ok[i] = ahead + behind >= len(x)
    return ok


def _near_in_chunk(words, starts, side, cross, weights):
    """Pairs of row numbers (shorter word first) whose vectors are as far apart as
    one edit takes them, block by block.

    ``starts``: first row of each block and the end; rows of a block are in
    order of length.  ``cross``: the block is a cell of two different sides,
    and only pairs of both count."""
    import numpy as np
    flat, offsets = _letters(words)
    lengths = np.diff(offsets)
    counts = _counts(flat, offsets)
    kind = np.float32 if lengths.max(initial=0) < 2_000 else np.float64  # whole numbers and halves stay exact
    half, ones = (counts * counts).sum(1, keepdims=True) / 2, np.ones((len(counts), 1))
    used = counts.any(0)
    # the product of a row of x and a row of y is minus half the squared distance
    x, y = np.hstack([counts[:, used], -half, ones]).astype(kind), np.hstack([counts[:, used], ones, -half]).astype(kind)
    keys = counts.astype(np.uint64) @ weights
    left, right, blocks = [], [], []
    for j, (s, e) in enumerate(zip(starts, starts[1:])):
        if e - s < 2:
            continue
        if e - s <= 64:
            spans = [(s, e, s, e)]
        else:
            edges = [s, *(s + 1 + np.flatnonzero(np.diff(lengths[s:e]))).tolist(), e]
            spans = []
            for k, (p, q) in enumerate(zip(edges, edges[1:])):
                follow = edges[k + 2] if k + 2 < len(edges) and lengths[q] == lengths[p] + 1 else q
                spans += [(r, min(r + STRIP, q), r, follow) for r in range(p, q, STRIP)]
        for p, q, r, t in spans:
            for u in range(r, t, STRIP):
                v = min(u + STRIP, t)
                g = x[p:q] @ y[u:v].T
                at = np.flatnonzero(g >= -1)
                at = at[g.ravel()[at] < 0]
                if not len(at):
                    continue
                a, b = np.divmod(at, v - u)
                a, b = a + p, b + u
                # one replaced letter: distance two; one inserted: distance one
                apart = -2 * g.ravel()[at]
                good = (a < b) & (lengths[b] - lengths[a] == 2 - apart)
                if cross[j]:
                    good &= side[a] != side[b]
                if good.any():
                    left.append(a[good])
                    right.append(b[good])
                    blocks.append(np.full(int(good.sum()), j))
    if not left:
        return None
    a, b, j = map(np.concatenate, (left, right, blocks))
    return a, b, j, keys, flat, offsets


def _pairs(weights):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def emit(t):
            name = [t.column(c).to_numpy() for c in ("k", "key", "cell_i", "cell_j")]
            words, side = t.column("word").to_pylist(), t.column("side").to_numpy()
            change = np.zeros(len(words), bool)
            for c in name:
                change[1:] |= c[1:] != c[:-1]
            starts = [0, *np.flatnonzero(change).tolist(), len(words)]
            lead = np.array(starts[:-1])
            found = _near_in_chunk(words, starts, side, name[2][lead] != name[3][lead], weights)
            if found is None:
                return
            a, b, j, keys, flat, offsets = found
            k = name[0][lead][j]
            # a pair may share several blocks: it counts in the first
            first = np.ones(len(a), bool)
            for m in range(1, keys.shape[1]):
                of = np.flatnonzero(k == m)
                first[of] = ~(keys[a[of], :m] == keys[b[of], :m]).any(1)
            a, b = a[first], b[first]
            ok = _one_edit(flat, offsets, a, b)
            w = t.column("word").combine_chunks()
            yield pa.RecordBatch.from_arrays([w.take(pa.array(a[ok])), w.take(pa.array(b[ok]))], ["a", "b"])

        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n < CHUNK:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            last = [t.column(c)[-1].as_py() for c in ("k", "key", "cell_i", "cell_j")]
            open_ = np.ones(n, bool)
            for c, v in zip(("k", "key", "cell_i", "cell_j"), last):
                open_ &= t.column(c).to_numpy() == v
            cut = int(np.argmax(open_))
            if cut:
                yield from emit(t.slice(0, cut))
                held, n = t.slice(cut).to_batches(), t.num_rows - cut
        if held:
            yield from emit(pa.Table.from_batches(held).combine_chunks())
    return run


def near_words(words: DataFrame, word: str = "word") -> DataFrame:
    """All pairs (``a``, ``b``) of distinct words one edit apart, each once,
    the shorter first."""
    spark = words.sparkSession
    prepare(spark)
    w = stored(words.where(F.col(word).isNotNull()).select(F.col(word).alias("word")).distinct())
    weights = _hashes(letter_parts(w))

    def keyed(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            names = batch.column("word").to_pylist()
            if not names:
                continue
            for s in range(0, len(names), CHUNK):
                some = names[s:s + CHUNK]
                flat, offsets = _letters(some)
                keys = (_counts(flat, offsets).astype(np.uint64) @ weights).astype(np.int64)
                size = pa.array(np.diff(offsets).astype(np.int32))
                for k in range(keys.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k, np.int32)), pa.array(keys[:, k]), pa.array(some, pa.string()), size], ["k", "key", "word", "size"])

    rows = w.mapInArrow(keyed, "k int, key long, word string, size int")
    # Only blocks above a cell are listed: at most rows / CELL of them.
    hot = rows.groupBy("k", "key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > CELL)
    rows = rows.join(hot.withColumnRenamed("k", "hk").withColumnRenamed("key", "hkey"), F.expr("k = hk and key = hkey"), "left")
    sides = F.coalesce(F.ceil(F.col("m") / F.lit(CELL)), F.lit(1)).cast("int")
    rows = rows.select("k", "key", "word", "size", sides.alias("s"))
    rows = rows.withColumn("side", F.pmod(F.xxhash64("word"), F.col("s")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
    rows = rows.select("k", "key", F.least("side", "o").alias("cell_i"), F.greatest("side", "o").alias("cell_j"), "size", "word", "side")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = rows.repartition(n, "k", "key", "cell_i", "cell_j").sortWithinPartitions("k", "key", "cell_i", "cell_j", "size", "word")
    return cells.mapInArrow(_pairs(weights), "a string, b string")


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """``word``, ``n``, ``form``, ``root``, ``n_near``, ``form_n`` for a table of
    distinct words and counts.

    Ties of the form go to the smallest word in code-point order."""
    w = stored(words.select("word", "n"))
    pairs = near_words(w)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    other = w.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("f")))
    near = both.join(other, "other").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    big = -F.col("best.m") >= ratio * F.col("n")
    d = stored(w.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                   F.when(big, F.col("best.f")).alias("form"), F.when(big, -F.col("best.m")).alias("form_n")))
    # Counts grow tenfold (``ratio``) a step and are longs, so 2 ** 6 steps reach the end.
    up = d.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(6):
        beyond = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        up = stored(up.join(beyond, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    d = d.join(up, "word", "left")
    return d.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The same rows in DuckDB: crc32 from its table, near words by their one-letter deletions.
ORACLE = """
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t),
runs AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS r FROM documents) WHERE length(r) >= 7),
keyed AS (SELECT doc_id, r, count(*) AS k, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || r)) AS b FROM runs GROUP BY doc_id, r),
hashed AS (SELECT r, k, xor(list_reduce(range(length(b) // 2), lambda c, i: xor(c >> 8, t[(xor(c & 255, ('0x' || substr(b, 2 * i + 1, 2))::INT) + 1)]), 4294967295), 4294967295) AS h
    FROM keyed, crc),
words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word, k FROM hashed),
w AS (SELECT word, sum(k)::BIGINT AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
one AS (SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word FROM cuts a JOIN w b ON a.cut = b.word UNION SELECT b.word, a.word FROM cuts a JOIN w b ON a.cut = b.word),
best AS (SELECT one.a AS word, count(*) AS n_near, min(struct_pack(m := -w.n, f := w.word)) AS best FROM one JOIN w ON one.b = w.word GROUP BY one.a),
d AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.m >= 10 * w.n THEN best.f END AS form, CASE WHEN -best.m >= 10 * w.n THEN -best.m END AS form_n
    FROM w LEFT JOIN best USING (word)),
follow AS (SELECT word, word AS root, 0 AS step FROM d UNION ALL SELECT follow.word, d.form, step + 1 FROM follow JOIN d ON follow.root = d.word WHERE d.form IS NOT NULL)
SELECT word, form, (SELECT arg_max(root, step) FROM follow f WHERE f.word = d.word) AS root, n, n_near, form_n FROM d
"""
