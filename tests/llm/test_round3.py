"""Spelling variants, repeated passages, conversation trie: brute force, hot groups, odd inputs."""
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from cabflow.llm import common, convtrie, langid, packing, spelling, substrings, topk, urlfilter

DOC = "doc_id long, text string, word string, n long, bucket int"
CONV = "conv_id long, turn long, role string, text string, c long, depth long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOC)


def convs(spark, rows):
    return spark.createDataFrame([(*r, 5, 6) for r in rows], CONV)


# ------------------------------------------------------------------ spelling

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words, ratio=10):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def some_words(rng, n):
    out = {}
    while len(out) < n:
        w = "".join(rng.choice("abcéÿ") for _ in range(rng.randint(1, 6)))
        out[w] = rng.choice([1, 2, 3, 25, 40, 300, 5000, 70_000])
    return out


@pytest.mark.parametrize("cell", [4_000, 7])
def test_variants_against_brute_force(spark, monkeypatch, cell):
    """Also with blocks cut into cells of 7 words, chunks of 50 rows and strips of 20."""
    monkeypatch.setattr(spelling, "CELL", cell)
    if cell < 100:
        monkeypatch.setattr(spelling, "CHUNK", 50)
        monkeypatch.setattr(spelling, "STRIP", 20)
    words = some_words(random.Random(cell), 600)
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute_variants(words) and len(got) == 600
    assert any(r.root != (r.form or r.word) for r in got)  # a chain of two forms


def test_variants_long_words_and_large_blocks(spark, monkeypatch):
    """Words of thousands of letters, and more anagrams than a strip in one length block."""
    monkeypatch.setattr(spelling, "STRIP", 32)
    words = {"".join(p): 1 + i for i, p in enumerate(itertools.permutations("abcdef"))}
    words |= {"ab" * 3000: 5, "ab" * 3000 + "a": 70, "ab" * 2999 + "ac": 3}
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    long = {r.word: r for r in got if len(r.word) > 100}
    assert long["ab" * 3000].form == "ab" * 3000 + "a" and long["ab" * 3000].n_near == 2
    assert all(r.n_near == 0 for r in got if len(r.word) == 6)  # anagrams are two replacements apart


def test_noised_words_odd(spark):
    rows = [(1, None), (2, ""), (3, "Letters, LETTERS!  Étéries étéries lettre"), (3, "Letters, LETTERS!  Étéries étéries lettre"), (None, "somewords somewords"),
            (4, "x" * 70_000 + " " + "x" * 70_000), (5, "漢字漢字漢字漢字 ab×cd÷efg 1234567")]
    want = collections.Counter()
    for i, t in rows:
        for r in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            r = "".join(c.lower() if c < "\x80" else c for c in r)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            r = r[:h % len(r)] + r[h % len(r) + 1:] if h % 31 == 0 else r
            if len(r) >= 7:
                want[r] += 1
    got = spelling.noised_words(docs(spark, rows))
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in want.items() if n >= 2}
    out = spelling.variants(got)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == got.count()
    assert spelling.variants(spelling.noised_words(docs(spark, rows).where("doc_id > 99"))).count() == 0


def test_noise_deletes_letters(spark):
    """Over many ids, the letter crc32 names goes from every 31st run."""
    got = spelling.noised_words(docs(spark, [(i, "Wordswithletters") for i in range(400)]), least_count=1)
    want = collections.Counter()
    for i in range(400):
        r = "wordswithletters"
        h = zlib.crc32(f"{i}:{r}".encode())
        want[r[:h % 16] + r[h % 16 + 1:] if h % 31 == 0 else r] += 1
    assert {r.word: r.n for r in got.collect()} == want and len(want) > 5


# ---------------------------------------------------------------- substrings

def brute_removed(rows, k=13):
    """(doc_id, n_words, n_removed, sha256) of every row."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for j in range(len(w) - k + 1):
            if i is not None:
                key = tuple(w[j:j + k])
                least[key] = min(i, least.get(key, i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for j in range(len(w) - k + 1):
            if i is not None and least[tuple(w[j:j + k])] < i:
                gone.update(range(j, j + k))
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return sorted(out, key=repr)


def passages(rng, n):
    """Texts that share passages, lines and words; some repeat inside themselves."""
    pool = [[rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) for _ in range(rng.randint(5, 60))] for _ in range(12)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rng.randint(0, 6)):
            w += rng.choice(pool) if rng.random() < 0.5 else [rng.choice(["a", "b", "ö", "漢"]) + str(rng.randint(0, 30)) for _ in range(rng.randint(1, 30))]
        rows.append((rng.randint(0, n // 2) * 3, "".join(x + rng.choice([" ", "\n", " \t "]) for x in w)))
    return rows


@pytest.mark.parametrize("heavy, size, run", [(4, 2_000_000, 64), (1e-9, 2_000_000, 64), (4, 700, 3)])
def test_repeats_against_brute_force(spark, monkeypatch, heavy, size, run):
    """Also with every bucket heavy, and with texts cut into small slices and short runs."""
    monkeypatch.setattr(substrings, "HEAVY", heavy)
    monkeypatch.setattr(substrings, "SLICE", size)
    monkeypatch.setattr(substrings, "RUN", run)
    if heavy < 1:
        count = substrings._count
        monkeypatch.setattr(substrings, "_count", lambda most: count(1))
    rows = passages(random.Random(run), 160)
    rows += [(900, None), (901, ""), (None, rows[0][1]), (-5, rows[1][1]), (902, "w " * 3000), (903, "w " * 500), (904, "x" * 5000 + " " + "y " * 40), (904, "x" * 5000 + " " + "y " * 40)]
    got = substrings.digest(substrings.remove_repeats(docs(spark, rows).repartition(5))).collect()
    assert sorted(map(tuple, got), key=repr) == brute_removed(rows)
    assert sum(r.n_removed for r in got) > 1000


def test_windows_that_share_a_hash_are_told_apart():
    """With all hashes equal, windows are still compared by their words."""
    rng = random.Random(3)
    text = b"\n".join(b" ".join(rng.choice([b"a", b"b"]) for _ in range(16)) for _ in range(60))
    n = text.count(b"\n") + 1
    places = [np.arange(n), np.arange(n)[::-1].copy(), np.zeros(n, np.int64), np.zeros(n, np.int64)]
    want = substrings._settle(places, text)
    old, substrings._mix = substrings._mix, lambda x: x * 0
    try:
        got = substrings._settle(places, text)
    finally:
        substrings._mix = old
    key = lambda r: sorted(zip(*(c.tolist() for c in r)))
    assert want is not None and key(got) == key(want)


def test_repeats_empty_table(spark):
    out = substrings.digest(substrings.remove_repeats(docs(spark, [(1, "a")]).where("doc_id > 1")))
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and out.count() == 0


# ---------------------------------------------------------------------- trie

def brute_trie(rows):
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append(((turn is not None, turn or 0), role or "", text or ""))
    seqs = {}
    for c in by:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        seqs[c] = tuple(t[1:] for t in sorted(by.get(base, []))[:h]) + tuple(t[1:] for t in sorted(by[c])[h:])
    members = collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = set()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if seqs[c] == p)
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def talk(rng, n):
    rows = []
    for c in range(-3, n):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "bot", None]), rng.choice(["hi", "so", "ünü", "", None])))
    return rows


@pytest.mark.parametrize("local", [4_096, 3, 0])
def test_trie_against_brute_force(spark, local):
    """Also with every component split down to single nodes."""
    rows = talk(random.Random(1), 45)
    rows += [(40, t, "user", "deep") for t in range(100, 130)] + [(60, None, "a", "b"), (60, None, "a", "b"), (60, None, "a", None), (None, 1, "a", "b")]
    got = convtrie.conversation_trie(convs(spark, rows), local=local).collect()
    assert {tuple(r) for r in got} == brute_trie(rows) and len(got) > 60


def test_trie_of_one_long_conversation(spark):
    """A path of 300 nodes with a few branches, in components of at most 10."""
    rows = [(0, t, "u", str(t % 7)) for t in range(300)] + [(5, t, "u", str(t % 7)) for t in range(200)]
    got = convtrie.conversation_trie(convs(spark, rows), local=10, branch=False).collect()
    by = {(r.conv_id, r.depth): r for r in got}
    assert len(got) == 301 and by[0, 0].n_convs == 2 and by[0, 200].n_convs == 2 and by[0, 201].n_convs == 1
    assert by[0, 0].n_leaves == 1 and by[0, 0].saved_tokens == 200 and by[0, 150].saved_tokens == 51
    assert by[0, 200].ends_sha256 == hashlib.sha256(b"5").hexdigest()


def test_trie_turnless_and_empty(spark):
    # a short conversation whose base is not there and whose turns all lie before its branch
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    got = convtrie.conversation_trie(convs(spark, [(c, 0, "u", "x"), (c, 1, "u", "y")])).collect()
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert convtrie.conversation_trie(convs(spark, [(None, 0, "u", "x")])).count() == 0
    assert convtrie.conversation_trie(convs(spark, [(1, 0, "u", "x")]).where("conv_id > 1")).count() == 0


# ------------------------------------------------------------------- packing

def test_ranked_words_equal_the_tokenizer():
    """Words merged by ranks, also of letters near U+0250, and the two generations of the cache."""
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    t, rng = Tokenizer.from_file(path), random.Random(6)
    ids = packing.WordIds(path)
    assert ids.by_rank is not None
    old, packing.CACHE = packing.CACHE, 300
    try:
        for _ in range(12):
            texts = [" ".join("".join(rng.choice("abcdeéñßſəɐɏ'.,12") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 60))) for _ in range(40)]
            texts += ["", None, "one", "\n" * 3, "漢字 🙂 x", "a\u00a0b c"]
            for s, got in zip(texts, ids.ids(texts)):
                assert np.frombuffer(got, "<u4").tolist() == t.encode(s or "", add_special_tokens=False).ids, repr(s)
    finally:
        packing.CACHE = old


def test_latin_texts_are_merged_whole():
    """Texts of Latin letters are not cut into words of a cache nor given to the slower tokenizer, whatever their
    white space, and their ids are the tokenizer's; texts with other letters between them keep their place."""
    from tokenizers import Tokenizer
    path = packing.default_tokenizer()
    t, rng = Tokenizer.from_file(path), random.Random(8)
    ids = packing.WordIds(path)
    points = [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205f), *range(0x20a0, 0x20d0)]
    latin = [f"a{x}b 1{x}2 .{x}. {x} {x}{x}\n{x} x  {x}y{x}" for x in map(chr, points)]
    latin += ["".join(rng.choice("ab  \n\t\r\u00a0'’s'll—éß,.12½") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    latin += ["", None, "two  spaces\n\nand a paragraph ", "don't we'll I'M", "x" * 70_000, "a" + " \n" * 40_000 + "b"]
    want = {s: t.encode(s or "", add_special_tokens=False).ids for s in latin}
    whole, slow = ids.whole, []
    ids.whole = lambda texts: slow.extend(texts) or whole(texts)
    for s, got in zip(latin, ids.ids(latin)):
        assert np.frombuffer(got, "<u4").tolist() == want[s], repr(s)
    assert not slow and not ids.young
    mixed = ["plain", "漢字 of  two", None, "don't", "<|endoftext|> x", "привет мир", "", "a b\n\nc", "w" + " " * 1_200_000 + "w"]
    flat, begin = ids.encoded(mixed, 1)
    for s, x, y in zip(mixed, begin.tolist(), [*begin[1:].tolist(), len(flat)]):
        assert flat[x:y].tolist() == t.encode(s or "", add_special_tokens=False).ids + [1], repr(s)[:60]
    flat, begin = ids.encoded([], 1)
    assert len(flat) == len(begin) == 0


def test_packing_odd(spark):
    """Nulls, empty and very long texts, repeated rows, null ids, clashing columns: an exact round trip."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(packing.default_tokenizer())
    rows = [(1, None), (2, ""), (3, "word " * 9000 + "x" * 40_000), (4, "same text"), (4, "same text"), (None, "no id"), (5, " \n\t ")] + [(i, f"short text {i}") for i in range(10, 60)]
    d = spark.createDataFrame([(i, x, 1, 2, "c", 3) for i, x in rows], "doc_id long, text string, sequence_id long, offset long, class string, rank long")
    out = packing.pack_documents(d, keep_ids=True).collect()
    want = collections.Counter()
    for i, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), 2048):
            p = np.array(ids[s:s + 2048], "<u4").tobytes()
            want[i, s, len(p) // 4, zlib.crc32(p), len(ids)] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out) == want
    by = collections.defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 2048
    assert sorted(by) == list(range(len(by)))


# ---------------------------------------------------------------- language ID

def brute_fusion(rows, model):
    """(language, probability, accepted) of rows (text, declared, host), one by one."""
    names, table, limits = model
    n, pool, seen = len(names), np.exp(table).mean(1), []
    for text, declared, host in rows:
        grams, _, letters = langid.trigrams([text])
        if not letters[0]:
            seen.append(None)
            continue
        score = np.array([sum(float(table[g, k]) for g in grams) for k in range(n)])
        k = int(score.argmax())
        mean = sum(np.log((np.exp(table[g, k]) + pool[g]) / 2) for g in grams) / len(grams)
        ok = bool(langid.reaches(np.array([mean]), np.array([len(grams)]), limits[[k]])[0])
        fit = langid.TEMPER * (score - score.max())
        p = np.exp(fit) / np.exp(fit).sum()
        seen.append((fit, p if ok else np.zeros(n), ok))
    part = lambda h: (None, None) if h is None or "." not in h else (h.split(".")[-1], ".".join(h.split(".")[-2:]))
    total = lambda pick: sum((s[1] for r, s in zip(rows, seen) if s and pick(r)), np.zeros(n))
    drawn = lambda c, up: (c + langid.KAPPA * up) / (c.sum() + langid.KAPPA)
    prior = (total(lambda r: True) + 1) / (total(lambda r: True).sum() + n)
    kinds = len({r[1] for r, s in zip(rows, seen) if s and r[1] is not None})
    said = total(lambda r: r[1] is not None)
    out = []
    for r, s in zip(rows, seen):
        if s is None:
            out.append((None, None, False))
            continue
        fit, own, ok = s
        chain = prior
        if r[2] is not None:
            suffix, domain = part(r[2])
            up = prior
            if domain:
                up = drawn(total(lambda x: part(x[2])[0] == suffix), up)
                up = drawn(total(lambda x: part(x[2])[1] == domain), up)
            chain = drawn(np.maximum(total(lambda x: x[2] == r[2]) - own, 0), up)
        share = (total(lambda x: x[1] == r[1]) + 1) / (said + kinds + 1) if r[1] is not None else np.ones(n)
        post = np.exp(fit) * chain * share
        post /= post.sum()
        k = int(post.argmax())
        out.append((names[k], float(post[k]), bool(ok and post[k] >= langid.ACCEPT)))
    return out


def test_fusion_against_brute_force(spark):
    """Texts, declarations and hosts that disagree, nulls, names that clash."""
    rng, words = random.Random(12), {"aa": "kala mito suna peko", "bb": "grunt blick spratz drell", "cc": "oui eau ceau lieu"}
    say = lambda k, n: " ".join(rng.choice(words[k].split()) for _ in range(n))
    model = langid.fit(spark.createDataFrame([(say(k, 12), k) for k in words for _ in range(40)], "t string, l string"), "t", "l")
    rows = [(say(rng.choice("aa bb cc".split()), rng.randint(1, 3)) if rng.random() < 0.8 else rng.choice(["zzz", "", None, "12", "漢字", say("aa", 2) + " " + say("bb", 2)]),
             rng.choice([None, "aa", "bb", "xx"]), rng.choice([None, "", "h", "a.b.aa", "c.b.aa", "d.cc", "e.f.cc"])) for _ in range(120)]
    df = spark.createDataFrame([(i, t, d, h, "p", 1.5, "s") for i, (t, d, h) in enumerate(rows)], "id long, text string, declared string, host string, p string, probability double, fit string")
    out = langid.identify(df, model)
    assert out.columns == ["id", "p", "fit", "language", "probability", "accepted"]
    for r, (language, probability, accepted) in zip(out.orderBy("id").collect(), brute_fusion(rows, model)):
        assert r.language == language and r.accepted == accepted and (probability is None) == (r.probability is None)
        assert probability is None or abs(r.probability - probability) < 1e-9
    assert {r.accepted for r in out.collect()} == {True, False}


def test_many_languages_cost_in_proportion(spark):
    """A row with 256 languages at most 64 times one with 4."""
    import time
    rng = np.random.default_rng(1)
    rows = spark.range(3000).selectExpr("id", "concat('wort ', id, ' text') as text", "'d' as declared", "concat('h', id % 7, '.org') as host").repartition(4)

    def seconds(n):
        names = [f"l{i:03d}" for i in range(n)]
        table = np.log(rng.random((langid.BUCKETS, n)) + 0.1).astype(np.float32)
        model = names, table - np.log(np.exp(table).sum(0)), np.tile([-12.0, 5.0], (n, 1))
        t = time.time()
        assert langid.identify(rows, model).where("language is not null").count() == 3000
        return time.time() - t
    seconds(4)
    assert seconds(256) < 64 * seconds(4)


# ---------------------------------------------------------------------- top k

def test_bounds_stop_reading():
    """Queries on even vectors end before the lists do, and the scores are right."""
    rng = np.random.default_rng(5)
    X = np.floor(256 * rng.normal(size=(2000, 64)) / 8).astype(int)
    ids, read = np.arange(2000), {}
    got = topk.nra(X, ids, X[:40], ids[:40], 5, read)
    for q in range(40):
        want = sorted((-int(X[j] @ X[q]), j) for j in range(2000) if j != q)[:5]
        assert sorted((-s, j) for i, j, s in got if i == q) == want
    assert len(read) == 40 and max(read.values()) <= 0.95


def test_large_finite_components_take_part(spark):
    rows = [(0, [2.0 ** 30, 1.0]), (1, [1.0, 1.0]), (2, [-(2.0 ** 40), 0.0]), (3, [3e18, 0.0]), (50, [1.0, 0.5])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    top = topk.top_k(v, v.where("vec_id % 50 = 0"), k=3).collect()
    got = {q: [(r.vec_id, r.score) for r in sorted(top, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 50)}
    assert got[0] == [(1, 2 ** 46 + 65536), (50, 2 ** 46 + 128 * 256), (2, -(2 ** 63))]
    assert got[50] == [(0, 2 ** 46 + 128 * 256), (1, 65536 + 128 * 256), (2, -(2 ** 56))]


# ----------------------------------------------------------------- URL filter

def test_scores_against_dense_iteration(spark):
    """A random graph and a chain of 90 hosts, iterated to the end."""
    rng = random.Random(2)
    links = {(f"h{rng.randint(0, 40)}", f"h{rng.randint(0, 40)}"): rng.randint(1, 5) for _ in range(150)}
    links |= {(f"c{i}", f"c{i + 1}"): 1 for i in range(90)} | {("h3", "c0"): 9, ("c90", "h5"): 1}
    links = {k: n for k, n in links.items() if k[0] != k[1]}
    hosts = sorted({h for k in links for h in k})
    at, n = {h: i for i, h in enumerate(hosts)}, len(hosts)
    W = np.zeros((n, n))
    for (a, b), k in links.items():
        W[at[a], at[b]] = k
    out = W.sum(1, keepdims=True)
    W = np.divide(W, out, where=out > 0, out=np.zeros_like(W))
    seed = np.zeros(n)
    seed[[at["h1"], at["h3"]]] = 0.25, 0.75
    own = np.array([{"h5": 1.0, "h7": 0.4}.get(h, 0.0) for h in hosts])
    x, y = seed.copy(), own.copy()
    for _ in range(2000):
        x = 0.15 * seed + 0.85 * (x @ W + x[out[:, 0] == 0].sum() * seed)
        y = own + (1 - own) * 0.85 * (W @ y)
    e = spark.createDataFrame([(a, b, k) for (a, b), k in links.items()], "src string, dst string, links long")
    got = urlfilter.propagate(e.selectExpr("'t' as kind", "*"), spark.createDataFrame([("t", "h1", 0.25), ("t", "h3", 0.75)], "kind string, host string, seed double"), tolerance=1e-8)
    assert all(abs(r.score - x[at[r.host]]) < 1e-7 for r in got.collect()) and got.count() == n
    got = urlfilter.reach(e, spark.createDataFrame([(h, float(v)) for h, v in zip(hosts, own)], "host string, own double"), tolerance=1e-8)
    assert all(abs(r.score - y[at[r.host]]) < 1e-7 for r in got.collect()) and got.count() == n
    with pytest.raises(RuntimeError):
        urlfilter.reach(e, spark.createDataFrame([(h, float(v)) for h, v in zip(hosts, own)], "host string, own double"), rounds=5)


def test_substrings_send_one_value_a_bucket_for_several_slices(spark):
    """What several slices send to a bucket is one value: bodies decode to their places and strings, and are smaller than slice by slice."""
    import pyarrow as pa
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3_000)]
    texts = [" ".join(rng.choices(vocabulary, k=300)) for _ in range(120)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(120), pa.int64()), pa.array([rng.getrandbits(63) - (1 << 62) for _ in texts], pa.int64()), pa.array(texts)], ["doc_id", "tkey", "text"])
    keys = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
    sizes = {}
    for slice_bytes in (20_000, 2_000_000):
        was, substrings.SLICE = substrings.SLICE, slice_bytes
        try:
            sent = list(substrings._cut(16)([batch]))
        finally:
            substrings.SLICE = was
        rows = [r for b in sent for r in b.to_pylist()]
        assert sorted(r["bucket"] for r in rows) == sorted({r["bucket"] for r in rows})  # one value a bucket
        windows = set()
        for r in rows:
            (at, doc, key, start), text = substrings._body(r["body"], 4)
            lines = text.decode().split("\n")
            assert r["size"] == len(text)
            for i, d, k, s in zip(at.tolist(), doc.tolist(), key.tolist(), start.tolist()):
                words = lines[i].split(" ")
                assert k == keys[d] and words == texts[d].split(" ")[s:s + len(words)]
                windows |= {(d, s + j) for j in range(len(words) - substrings.WINDOW + 1)}
        assert windows == {(d, j) for d in range(120) for j in range(300 - substrings.WINDOW + 1)}
        sizes[slice_bytes] = sum(len(r["body"]) for r in rows)
    assert sizes[20_000] < 1.1 * sizes[2_000_000]


def test_substrings_texts_move_compressed(spark):
    """Null, empty and odd texts come back whole from the packed form."""
    rows = [(1, None), (2, ""), (3, "a\tb\x00 é 文 " * 40), (4, " "), (None, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(substrings.remove_repeats(df).collect(), key=str)
    want = [(d, len(w), 0, " ".join(w)) for d, t in rows for w in [re.findall(r"[^\x20\x09-\x0D]+", t or "")]]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(substrings.remove_repeats(df)._jdf.queryExecution(), "simple")
    assert "_packed_texts" in plan


def test_long_texts_reach_workers_in_small_batches(spark):
    """Arrow batches are bounded by bytes, so long texts come few at once and narrow rows still 10,000; a session's own limit stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    biggest = lambda t: max(r.n for r in spark.range(8_000).selectExpr("id", t).coalesce(1).mapInArrow(sizes, "n long").collect())
    try:
        spark.conf.unset(key)
        common.prepare(spark)
        assert biggest("repeat('x', 2000) t") < 2_500 and biggest("'x' t") == 8_000
        spark.conf.set(key, "1m")
        common.prepare(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


def test_packing_leaves_no_words_in_the_worker():
    """The words of a task go when it ends, as its worker stays for other stages; the tokenizer stays."""
    import pyarrow as pa
    path = packing.default_tokenizer()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array(["a few words here", "and more of them"])], ["doc_id", "text"])

    class Docs:
        """Takes the place of a table: keeps the function that tasks run."""
        columns, sparkSession = ["doc_id", "text"], None

        def select(self, *_):
            return self

        def drop(self, *_):
            return self

        def mapInArrow(self, run, _):
            self.run = run
            return self

    was, packing.prepare = packing.prepare, lambda _: None
    column, packing.F = packing.F, type("F", (), {"col": staticmethod(lambda _: type("C", (), {"cast": lambda s, _: s, "alias": lambda s, _: s})())})
    try:
        out = [r for b in packing.pieces(Docs()).run([batch]) for r in b.to_pylist()]
    finally:
        packing.prepare, packing.F = was, column
    assert [r["length"] for r in out] == [len(x) // 4 + 1 for x in packing.WordIds(path).ids(batch.column(1).to_pylist())]
    assert not packing._WORD_IDS[path].young and not packing._WORD_IDS[path].old
