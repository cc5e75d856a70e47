"""Language identification by Bayesian evidence fusion.

Four kinds of evidence on the language of a text are multiplied:

* the text: byte trigrams of the whole lower-cased text under a hashed
  trigram model of each language, tempered because neighbouring trigrams are
  not independent;
* the declared markup language (``<html lang=...>`` or a column): how often
  texts of each language carry this declaration, counted over the corpus;
* the address suffix, and the host: a prior that is smoothed down a chain, from all
  rows to the suffix, the domain and the host, each level counted by grouped
  aggregation of the texts' own posteriors and drawn towards the level above
  with the strength of ``KAPPA`` rows.  A row's own share is taken out of its
  host's count first.

The trigram model is fitted on all distinct labelled texts of each language.  The
``LANGUAGES`` with most texts have a model each, the rest share one and come out as
``OTHER``; a label whose texts have no trigram has none.

Known languages alone leave no place for a text in none of them, so a text is
also rejected if it fits worse than half-way between its language's own texts
and chance.  The fit is the mean log-likelihood a trigram under the language
mixed with all known ones, so that a text in several of them stays; the
language's own texts stand at the ``LOW`` share of all of them (its rank right to a
ten-thousandth), each scored as if its own trigrams were not in the model; chance is
a trigram drawn evenly from all buckets.  Texts shorter than the language's median get more room, down to chance.
A row is accepted if its text has letters, fits, and its best language reaches
``ACCEPT``; a text that does not fit does not speak for its host, suffix or declaration.
``probability`` is among the known languages, also for a rejected row.

Scale: texts are read three times (to count trigrams, to score them for the floors,
to identify) and do not move, but for one copy of each that comes several times with
its label.  The last pass gives a narrow table (id, posterior, declared
value, host) that is written once; the counts are hash aggregates and go back
by equi-joins on host and suffix without a forced broadcast, so a host with a
third of all rows is split by Spark's skew join.

Defined cases: null and empty texts and texts without letters have no text
evidence, language null and are not accepted; a missing declaration, suffix
or host adds nothing; ties go to the language that sorts first; repeated rows count each;
an empty table gives an empty result, and without labelled rows every
language is null.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import frugal, prepare, small_batches, stored
from cabflow.llm.urlfilter import host_and_path

BUCKETS, LANGUAGES, OTHER = 1 << 16, 256, "other"
TEMPER, ALPHA, KAPPA, ACCEPT = 0.25, 0.5, 20.0, 0.5
LOW, CHANCE = 0.02, -float(np.log(BUCKETS))
_MULTIPLIER = np.uint32(2654435761)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets of a batch, the text of each, and the letters of each text.

    Every run of bytes other than letters is one space; a trigram lies within
    a text, which starts and ends with a space.
    """
    raw = [b" " + (t or "").encode("utf-8", "surrogatepass") + b" " for t in texts]
    data = _LOWER[np.frombuffer(b"".join(raw), np.uint8)]
    letter = _LETTER[data]
    data = np.where(letter, data, np.uint8(32))
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(r) for r in raw])
    first = np.ones(len(data), bool)
    first[1:] = doc[1:] != doc[:-1]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep |= first
    letters = np.bincount(doc[letter], minlength=len(texts))
    data, doc = data[keep].astype(np.uint32), doc[keep]
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int32), letters
    with np.errstate(over="ignore"):
        code = ((data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]) * _MULTIPLIER
    inside = doc[2:] == doc[:-2]
    return (code >> np.uint32(16))[inside].astype(np.int64), doc[2:][inside], letters


Model = tuple[list[str], np.ndarray, np.ndarray]


def fit(labelled: DataFrame, text: str, language: str, sample: int | None = None) -> Model:
    """Languages, log-likelihood table (BUCKETS, languages) and floors (see
    ``floors``) from all distinct texts of a language (from about ``sample``, chosen by
    hash, if the caller asks for that).  The counts that reach the driver are bounded
    by the languages, at most ``LANGUAGES`` and ``OTHER``."""
    rows = labelled.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(F.col(text).cast("string").alias("t"), F.col(language).cast("string").alias("l"))
    times = stored(rows.groupBy("l", F.xxhash64("t").alias("h")).agg(F.count(F.lit(1)).alias("n")))
    by = stored(times.groupBy("l").count())
    sizes = {r["l"]: r["count"] for r in by.orderBy(F.desc("count"), "l").limit(LANGUAGES).collect()}
    own = F.col("l").isin(list(sizes))
    rest = by.where(~own).agg(F.sum("count")).first()[0]
    if rest:
        sizes[OTHER] = sizes.get(OTHER, 0) + rest
    names = sorted(sizes)
    if not names:
        return [], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 2))
    called = F.when(own, F.col("l")).otherwise(OTHER).alias("l")
    texts = rows.select("t", called, F.xxhash64("t").alias("h"))
    if sample is not None:
        grain = 1 << 30
        texts = texts.where(F.pmod("h", F.lit(grain)) < F.create_map(*[F.lit(x) for k in names for x in (k, int(grain * min(1.0, sample / sizes[k])))])[F.col("l")])
    # Every row counts; of a text that comes n times, n - 1 are taken off again, so only such texts are looked up.
    often = stored(times.select(called, "h", "n").groupBy("l", "h").agg(F.sum("n").alias("n")).where("n > 1"))
    again = texts.join(often, ["l", "h"]).dropDuplicates(["l", "h"]).select("t", "l", (1 - F.col("n")).alias("times"))

    def count(batches):
        import pyarrow as pa
        table, places = np.zeros(BUCKETS * len(names), np.int64), {x: k for k, x in enumerate(names)}
        for b in batches:
            texts, at = b.column(0).to_pylist(), np.array([places[x] for x in b.column(1).to_pylist()], np.int64)
            times = b.column(2).to_numpy()
            for s, e in small_batches(texts, 250_000):
                grams, doc, _ = trigrams(texts[s:e])
                np.add.at(table, grams * len(names) + at[s:e][doc], times[s:e][doc])
        some = np.nonzero(table)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(table[some], pa.int64())], names=["cell", "n"])

    counts = np.zeros(BUCKETS * len(names))
    every = texts.select("t", "l", F.lit(1).cast("long").alias("times")).unionByName(again)
    for r in every.mapInArrow(frugal(count), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r["cell"]] = max(r["n"], 0)
    counts = counts.reshape(BUCKETS, len(names))
    trained = counts.sum(0) > 0
    names, counts = [x for x, y in zip(names, trained) if y], counts[:, trained]
    limits = floors(texts.where(F.col("l").isin(names)), names, counts)
    counts = counts + ALPHA
    return names, np.log(counts / counts.sum(0)).astype(np.float32), limits


def floors(rows: DataFrame, names: list[str], counts: np.ndarray) -> np.ndarray:
    """(languages, 2): fit of the worse of each language's own texts and their
    usual length in trigrams, from labelled rows (t, l, and h, a hash of t) whose distinct
    texts are in ``counts``; each is scored without its own trigrams and speaks once."""
    totals = counts.sum(0)
    shared = rows.sparkSession.sparkContext.broadcast((counts.astype(np.float32), ((counts + ALPHA) / (totals + ALPHA * BUCKETS)).mean(1)))

    def score(batches):
        import pyarrow as pa
        table, pool = shared.value
        places = {x: k for k, x in enumerate(names)}
        for b in batches:
            texts, at = b.column(0).to_pylist(), np.array([places[x] for x in b.column(1).to_pylist()], np.int32)
            for s, e in small_batches(texts, 250_000):
                grams, doc, _ = trigrams(texts[s:e])
                cell, own = np.unique(doc.astype(np.int64) * BUCKETS + grams, return_counts=True)
                doc, grams = cell // BUCKETS, cell % BUCKETS
                k, n = at[s:e][doc], np.bincount(doc, own, e - s)
                seen = table[grams, k].astype(np.float64)
                with_it = (seen + ALPHA) / (totals[k] + ALPHA * BUCKETS)
                without = (np.maximum(seen - own, 0) + ALPHA) / (np.maximum(totals[k] - n[doc], 0) + ALPHA * BUCKETS)
                mean = np.bincount(doc, own * np.log((without + pool[grams] + (without - with_it) / len(names)) / 2), e - s)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(at[s:e][some], pa.int32()), b.column(2).slice(s, e - s).take(pa.array(some)), pa.array(mean[some] / n[some], pa.float64()),
                                                  pa.array(n[some].astype(np.int64), pa.int64())], names=["k", "h", "mean", "n"])

    limits = np.tile([CHANCE, 1.0], (len(names), 1))
    by = (rows.select("t", "l", "h").mapInArrow(frugal(score), "k int, h long, mean double, n long").groupBy("k", "h").agg(F.min("mean").alias("mean"), F.min("n").alias("n"))
          .groupBy("k").agg(F.percentile_approx("mean", LOW).alias("edge"), F.percentile_approx("n", 0.5).alias("n")))
    for r in by.collect():  # one row a language
        limits[r["k"]] = max(r["edge"], CHANCE), r["n"]
    return limits


def reaches(fit: np.ndarray, n: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Whether texts (fit, number of trigrams, the row of ``floors`` of their language) fit well enough."""
    edge, usual = limits.T
    room = (edge - CHANCE) / 2 * np.sqrt(np.maximum(usual / np.maximum(n, 1), 1.0))
    return fit > np.maximum(edge - room, CHANCE)


def _matrix(column, n: int) -> np.ndarray:
    """A column of arrays of ``n`` numbers as rows; NaN for null."""
    out = np.full((len(column), n), np.nan)
    out[column.is_valid().to_numpy(zero_copy_only=False)] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
    return out


def _lists(rows: np.ndarray, there: np.ndarray):
    """Rows as a column of arrays, null where not ``there``."""
    import pyarrow as pa
    cuts = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32) if rows.shape[1] else np.zeros(len(rows) + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.ascontiguousarray(rows).ravel(), pa.float64()), mask=pa.array(~there))


def _softmax(logs: np.ndarray) -> np.ndarray:
    e = np.exp(logs - logs.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _with(rows: DataFrame, keep: list[str], more: str) -> str:
    return ", ".join([f"`{c}` {t}" for c, t in rows.select(*[f"`{c}`" for c in keep]).dtypes] + [more])


def text_evidence(rows: DataFrame, model: Model) -> DataFrame:
    """Replace column ``text`` by ``_li_fit``, the tempered log-likelihood of each
    language (less the largest; null without letters), ``_li_p``, what the text says
    for its host and declaration (its posterior; nothing where it does not fit a
    known language well enough), and ``_li_reached``, whether it does."""
    names, table, limits = model
    shared = rows.sparkSession.sparkContext.broadcast((table, np.exp(table).mean(1) if names else None))  # BUCKETS x languages floats: a fixed size
    keep = [c for c in rows.columns if c != "text"]

    def run(batches):
        import pyarrow as pa
        table, pool = shared.value
        for b in batches:
            texts = b.column("text").to_pylist()
            for s, e in small_batches(texts, 250_000):
                grams, doc, letters = trigrams(texts[s:e])
                n, L = e - s, len(names)
                score = np.stack([np.bincount(doc, table[:, k][grams], n) for k in range(L)], 1) if L else np.zeros((n, 0))
                reached = np.zeros(n, bool)
                if L:
                    best, many = score.argmax(1), np.bincount(doc, minlength=n)
                    mixed = np.bincount(doc, np.log((np.exp(table[grams, best[doc]]) + pool[grams]) / 2), n) / np.maximum(many, 1)
                    reached = reaches(mixed, many, limits[best]) & (letters > 0)
                fit = TEMPER * (score - score.max(1, keepdims=True)) if L else score
                says = _softmax(fit) * reached[:, None] if L else score
                there = (letters > 0) & (L > 0)
                part = b.slice(s, n)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], _lists(fit, there), _lists(says, there), pa.array(reached)], names=[*keep, "_li_fit", "_li_p", "_li_reached"])

    return rows.select(*[f"`{c}`" for c in rows.columns]).mapInArrow(frugal(run), _with(rows, keep, "_li_fit array<double>, _li_p array<double>, _li_reached boolean"))


def _sums(names: list[str]) -> list[Column]:
    return [F.sum(F.col("_li_p")[i]).alias(f"c{i}") for i in range(len(names))]


def _vector(names: list[str]) -> Column:
    return F.array(*[F.col(f"c{i}") for i in range(len(names))])


def _drawn(counts: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Shares of a level: its counts and ``KAPPA`` rows of the level above."""
    return (counts + KAPPA * above) / (counts.sum(1, keepdims=True) + KAPPA)


def _shares(df: DataFrame, keys: list[str], names: list[str], above: Column) -> DataFrame:
    """``keys`` and ``share`` of grouped sums c0, c1, ...: one row for each group."""
    rows, n = df.select(*keys, _vector(names).alias("c"), above.alias("up")), len(names)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                out = _drawn(_matrix(b.column("c"), n), _matrix(b.column("up"), n))
                yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], _lists(out, np.ones(len(out), bool))], names=[*keys, "share"])

    return rows.mapInArrow(run, _with(rows, keys, "share array<double>"))


def identify(rows: DataFrame, model: Model) -> DataFrame:
    """Fuse the evidence for rows with columns ``text``, ``declared`` and ``host``: adds
    language, probability and accepted to the others, which are kept as they are
    (but for any of these three names, which the result replaces, and names that
    start with ``_li_``, which are not allowed).

    Work for a row is linear in the number of languages."""
    names = model[0]
    prepare(rows.sparkSession)
    keep = [c for c in rows.columns if c not in ("text", "declared", "host", "language", "probability", "accepted")]
    rows = rows.select(*[f"`{c}`" for c in keep], "text", "declared", "host")
    seen = text_evidence(rows, model)
    if not names:
        return seen.select(*[f"`{c}`" for c in keep], F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("probability"), F.lit(False).alias("accepted"))
    labels = F.split("host", r"\.")
    seen = seen.withColumns({"_li_suffix": F.when(F.size(labels) > 1, F.element_at(labels, -1)),
                             "_li_domain": F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), "."))})
    seen = stored(seen)
    n, L = len(names), range(len(names))
    told = seen.where("_li_p is not null")
    # All rows: the prior that every chain starts from (one row, L numbers).
    total = told.agg(*_sums(names)).first()
    whole = [float(total[i] or 0.0) for i in L]
    start = [(w + 1.0) / (sum(whole) + n) for w in whole]
    prior = F.array(*[F.lit(x) for x in start])

    suffix = _shares(told.where("_li_suffix is not null").groupBy("_li_suffix").agg(*_sums(names)), ["_li_suffix"], names, prior)
    domain = told.where("_li_domain is not null").groupBy("_li_domain", "_li_suffix").agg(*_sums(names)).join(suffix, "_li_suffix")
    domain = _shares(domain, ["_li_domain"], names, F.col("share"))
    host = told.where("host is not null").groupBy("host", "_li_domain").agg(*_sums(names)).join(domain, "_li_domain", "left")
    host = stored(host.select(F.col("host").alias("_li_host"), _vector(names).alias("_li_count"), F.coalesce("share", prior).alias("_li_above")))
    # Declared language: how often texts of language i carry it.
    declared = told.where("declared is not null").groupBy(F.col("declared").alias("_li_declared")).agg(*_sums(names))
    all_declared = told.where("declared is not null").agg(*_sums(names), F.countDistinct("declared").alias("kinds")).first()
    share = F.array(*[(F.col(f"c{i}") + 1.0) / F.lit(float(all_declared[i] or 0.0) + float(all_declared["kinds"] or 0) + 1.0) for i in L])
    declared = stored(declared.select("_li_declared", share.alias("_li_share")))
    fused = seen.join(host, F.col("host") == F.col("_li_host"), "left").join(declared, F.col("declared") == F.col("_li_declared"), "left")
    fused = fused.select(*[f"`{c}`" for c in keep], "_li_fit", "_li_p", "_li_reached", "_li_count", "_li_above", "_li_share")

    def fuse(batches):
        import pyarrow as pa
        label = np.array(names, object)
        for b in batches:
            if not b.num_rows:
                continue
            fit, own, counts, above, share = (_matrix(b.column(f"_li_{c}"), n) for c in ("fit", "p", "count", "above", "share"))
            known = b.column("_li_fit").is_valid().to_numpy(zero_copy_only=False)
            # The row's own share does not speak for its host.
            others = np.maximum(counts - np.where(np.isnan(own), 0.0, own), 0.0)
            chain = np.where(np.isnan(counts), np.array(start), _drawn(others, above))
            post = _softmax(np.where(known[:, None], fit, 0.0) + np.log(chain) + np.log(np.where(np.isnan(share), 1.0, share)))
            best = post.argmax(1)
            top = post[np.arange(len(post)), best]
            accepted = known & (top >= ACCEPT) & b.column("_li_reached").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(np.where(known, label[best], None), pa.string()),
                                              pa.array(top, pa.float64(), mask=~known), pa.array(accepted)], names=[*keep, "language", "probability", "accepted"])

    return fused.mapInArrow(frugal(fuse), _with(rows, keep, "language string, probability double, accepted boolean"))


def page_rows(pages: DataFrame, url: str = "url", html: str = "html") -> list[Column]:
    """text, declared and host columns of web pages: the visible text of the
    markup, its ``lang`` attribute and the host of the address."""
    bare = F.regexp_replace(F.col(html), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    tag = F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1))
    host, _ = host_and_path(url)
    return [bare.alias("text"), F.when(tag != "", tag).alias("declared"), F.when(host != "", host).alias("host")]


def document_rows(docs: DataFrame, text: str = "text", declared: str = "lang", source: str = "source") -> list[Column]:
    """The same columns of documents: their source stands for the host."""
    col = lambda c: F.col(c).cast("string")
    return [col(text).alias("text"), col(declared).alias("declared"), col(source).alias("host")]


def identify_corpus(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Language of every document and page: kind, doc_id, page_id, language,
    probability, accepted."""
    model = fit(docs, "text", "lang")
    a = docs.select(F.lit("document").alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), *document_rows(docs))
    b = pages.select(F.lit("page").alias("kind"), F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), *page_rows(pages))
    return identify(a.unionByName(b), model)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents whose language is accepted, with the columns they came with."""
    model = fit(docs, "text", "lang")
    cols = docs.columns
    rows = docs.select(F.struct(*cols).alias("row"), *document_rows(docs)).select("row", "text", "declared", "host")
    # The rejected are few and written first, so their size is known to the
    # planner and the texts need not be shuffled while it is small.
    keyed = rows.select(F.col("row.doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text", "declared", "host")
    bad = stored(identify(keyed, model).where("not accepted").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct())
    on = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"].cast("string")) == bad["bad_hash"])
    return docs.join(bad, on, "left_anti")
