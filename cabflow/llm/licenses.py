"""License scans: templates with optional and replaceable regions as token automata.

A template is wording with marks: ``[[ ... ]]`` may be absent, ``{{a,b}}``
stands for a to b arbitrary words, ``<<x|y>>`` for one of several wordings.
It is compiled to a nondeterministic automaton over words; a text holds the
license if some run of its consecutive words is accepted, so mandatory wording
must match word for word.

Words are runs of ASCII digits and letters (A-Z lower-cased) and of all
characters beyond ASCII; everything else separates them.  A batch of texts is
one byte array: word borders and 64-bit word hashes come from array
operations, words of the vocabulary become small numbers, and an automaton
runs only where the first mandatory words of its template stand.  The longest run from a start
counts.  Hash hits are compared with the real word before they count.

Results per text: all places of the base phrases, spans of templates, and a
score: the share of the text's words inside any match.

Defined cases: null and empty texts have no words, no label and score 0;
places may overlap and each counts; repeated rows are scanned each; an empty
table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import prepare, require, small_batches
from cabflow.llm.minhash import _powers, scramble

# Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Wording of well-known public licenses and notices.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license [[,]] version 2.0"),
    ("apache-2.0", "licensed under the apache license version 2.0 [[the license]] you may not use this file except in compliance with the license"),
    ("mit", "[[released|licensed|distributed]] under the [[terms of the]] mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
            "[[the software]] to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
            "distribute sublicense and or sell copies of the software"),
    ("gpl-3.0", "[[this work is]] licensed under the [[terms of the]] gnu general public license [[as published by the free software foundation]] "
                "[[either]] version 3 [[of the license]] [[or at your option any later version]]"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("cc-by-nc", "[[licensed|released|available]] under [[a|the]] [[creative commons|cc]] by nc {{0,1}} 4.0"),
    ("cc-by-nc", "licensed under cc by nc [[sa|nd]] <<4.0|3.0|2.5|2.0>>"),
    ("cc-by", "licensed under [[a|the]] <<creative commons attribution|cc by>> <<4.0|3.0|2.5|2.0>> [[international|unported]] [[license]]"),
    ("copyright", "copyright [[c]] {{1,6}} all rights reserved"),
)
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
WORD_BYTE[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ANY = 0  # words outside the vocabulary, and the label of a free step


def tokens(wording: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", wording.lower())


class Automaton:
    """States with word steps and free steps; built from one template."""

    def __init__(self, label: str, template: str, number):
        self.label = label
        self.steps: list[list[tuple[int, int]]] = [[]]  # state -> (word, next); ANY fits every word
        self.skips: list[list[int]] = [[]]
        at, self.first = 0, []
        for optional, free, choice, plain in re.findall(r"\[\[(.*?)\]\]|\{\{(.*?)\}\}|<<(.*?)>>|([^\[{<]+)", template):
            if free:
                least, most = map(int, free.split(","))
                for k in range(most):
                    new = self._state()
                    self.steps[at].append((ANY, new))
                    if k >= least:
                        self.skips[at].append(new)
                    at = new
                continue
            end = self._state()
            for words in (optional or choice or plain).split("|"):
                here = at
                ws = [number(w) for w in tokens(words)]
                for w in ws[:-1]:
                    new = self._state()
                    self.steps[here].append((w, new))
                    here = new
                if ws:
                    self.steps[here].append((ws[-1], end))
            if optional or not tokens(optional or choice or plain):
                self.skips[at].append(end)
            at = end
        self.final = at
        # Words that can start a match, and those that can come second.
        start = self._closure({0})
        self.first = sorted({w for s in start for w, _ in self.steps[s]})
        self.second = {a: {w for s in self._closure({n for s in start for x, n in self.steps[s] if x == a}) for w, _ in self.steps[s]} for a in self.first}

    def _state(self) -> int:
        self.steps.append([])
        self.skips.append([])
        return len(self.steps) - 1

    def _closure(self, states: set[int]) -> set[int]:
        todo, seen = list(states), set(states)
        while todo:
            for n in self.skips[todo.pop()]:
                if n not in seen:
                    seen.add(n)
                    todo.append(n)
        return seen

    def longest(self, words: np.ndarray, start: int, end: int) -> int:
        """End of the longest accepted run from ``start``, or -1."""
        states, best = self._closure({0}), -1
        for i in range(start, end):
            w = int(words[i])
            states = self._closure({n for s in states for x, n in self.steps[s] if x == w or x == ANY})
            if not states:
                break
            if self.final in states:
                best = i + 1
        return best


class Scanner:
    """Base phrases and templates over batches of texts."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.vocabulary: dict[str, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.phrases = [([number(w) for w in tokens(p)], label) for p, label in phrases]
        self.automata = [Automaton(label, t, number) for label, t in templates]
        words = sorted(self.vocabulary)
        raw = np.frombuffer(("\n".join(words) + "\n").encode(), np.uint8)
        hashes = _hashes(raw, *_borders(raw))
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], np.array([self.vocabulary[w] for w in words])[order]
        self.spelled = [None] + [w.encode() for w in sorted(self.vocabulary, key=self.vocabulary.get)]
        # A first look by the low 16 bits leaves few words for the search.
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def scan(self, texts: list[str | None]) -> list[tuple]:
        """Per text: n_words, base places [(word, label)], spans [(label, first word, end word)], matched words."""
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        data = LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
        starts, ends = _borders(data)
        cuts = np.cumsum([len(r) + 1 for r in raw])
        last = np.searchsorted(starts, cuts)  # words of text i are first[i]:last[i]
        first = np.concatenate([[0], last[:-1]])
        hashes = _hashes(data, starts, ends)
        ids = np.zeros(len(starts), np.int64)
        near = np.nonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])[0]
        at = np.minimum(np.searchsorted(self.hashes, hashes[near]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[near]
        near, at = near[hit], at[hit]
        ids[near] = self.numbers[at]
        known = np.nonzero(ids)[0]
        doc = np.searchsorted(last, known, "right")
        base: dict[int, list] = {}
        spans: dict[int, list] = {}
        real = lambda a, b: all(data[starts[i]:ends[i]].tobytes() == self.spelled[ids[i]] for i in range(a, b) if ids[i])
        padded = np.concatenate([ids, np.zeros(8, np.int64)])
        for words, label in self.phrases:
            ok = np.ones(len(known), bool)
            for k, w in enumerate(words):
                ok &= (padded[known + k] == w)
            ok &= known + len(words) <= last[np.minimum(doc, len(last) - 1)]
            for i, d in zip(known[ok].tolist(), doc[ok].tolist()):
                if real(i, i + len(words)):
                    base.setdefault(d, []).append((i - int(first[d]), label, len(words)))
        for m in self.automata:
            for w in m.first:
                second = np.array(sorted(m.second[w]))
                ok = (ids[known] == w) & (np.isin(padded[known + 1], second) | (ANY in m.second[w]))
                for i, d in zip(known[ok].tolist(), doc[ok].tolist()):
                    end = m.longest(ids, i, int(last[d]))
                    if end > 0 and real(i, end):
                        spans.setdefault(d, []).append((m.label, i - int(first[d]), end - int(first[d])))
        out = []
        for d, n in enumerate((last - first).tolist()):
            b, s = base.get(d, []), spans.get(d, [])
            covered = set()
            if b or s:
                for i, _, k in b:
                    covered.update(range(i, i + k))
                for _, x, y in s:
                    covered.update(range(x, y))
            out.append((n, [(i, label) for i, label, _ in b], s, len(covered)))
        return out


def _borders(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word (``data`` ends with a separator)."""
    step = np.diff(WORD_BYTE[data].astype(np.int8), prepend=np.int8(0))
    return np.nonzero(step == 1)[0], np.nonzero(step == -1)[0]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word; very long words (not in any vocabulary) get 0."""
    power, inverse = _powers(1 << 22)
    step, out, a = len(power) - 1, np.zeros(len(starts), np.uint64), 0
    with np.errstate(over="ignore"):
        while a < len(starts):
            at = int(starts[a])
            b = max(a + 1, int(np.searchsorted(ends, at + step, "right")))
            piece = data[at:int(ends[b - 1])]
            if len(piece) <= step:
                sums = np.concatenate([[np.uint64(0)], np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[:len(piece)], dtype=np.uint64)])
                s, e = starts[a:b] - at, ends[a:b] - at
                out[a:b] = scramble((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
            a = b
    return out


_SCANNER: list[Scanner] = []
_SPANS = "doc_id long, n_words long, base array<struct<word:long,label:string>>, spans array<struct<label:string,first:long,end:long>>, score double"


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, base places, template spans (word positions, end exclusive) and score."""
    require(docs, doc_id=doc_id, text=text)
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        if not _SCANNER:
            _SCANNER.append(Scanner())
        base_t = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
        span_t = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            for s, e in small_batches(texts, 1_000_000):
                rows = _SCANNER[0].scan(texts[s:e])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(s, e - s), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([[{"word": i, "label": x} for i, x in sorted(r[1])] for r in rows], base_t),
                     pa.array([[{"label": x, "first": a, "end": z} for x, a, z in sorted(r[2], key=lambda q: (q[1], q[2], q[0]))] for r in rows], span_t),
                     pa.array([r[3] / r[0] if r[0] else 0.0 for r in rows], pa.float64())],
                    names=["doc_id", "n_words", "base", "spans", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, _SPANS)


def digest(scanned: DataFrame) -> DataFrame:
    """The digest columns of ``scan_licenses``."""
    base = F.array_distinct(F.transform("base", lambda p: p["label"]))
    more = F.array_distinct(F.concat(base, F.transform("spans", lambda p: p["label"])))
    words = F.transform("base", lambda p: p["word"])
    return scanned.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(words).alias("first_word"),
                          F.array_max(words).alias("last_word"), F.array_join(F.sort_array(base), ",").alias("base_labels"),
                          F.array_join(F.sort_array(more), ",").alias("labels"), "score")
