"""Token counts of a unigram tokenizer, without making the tokens.

The vocabulary is the pieces and scores of a public SentencePiece file.  An
Aho-Corasick automaton lists, for every position of a string, the pieces that
end there; dynamic programming carries two numbers per position, the best sum
of scores and the piece count of the path that reaches it.  Rules: a path
replaces another only if its score is strictly higher, and paths are compared
in the order of the start of their last piece, so ties go to the longest last
piece; a character no piece covers costs the lowest score minus 10 and counts
as many byte pieces as its UTF-8 form has bytes.

A text gets a leading space mark, and its spaces become space marks.  No
piece runs from a letter into a space mark or holds a character unknown to
the vocabulary (checked when it is loaded), so the path falls apart at spaces
and line ends, and each distinct word is computed once per Python worker.
The stored scores are whole numbers: sums in double precision are exact
and do not depend on where a text is cut.

Defined cases: null and empty texts have 0 tokens and score 0; repeated rows
are counted each; an empty table gives an empty result; the result has only
the columns named below.  Memory per worker: the automaton and a cache of at
most ``CACHE`` words.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.llm.common import prepare, require

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 400_000
SCHEMA = "doc_id long, n_tokens long, score double, n_words long"


def load_pieces(path: str) -> dict[str, float]:
    """Normal pieces of a SentencePiece file with their scores (no control,
    unknown or byte pieces)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class UnigramCounter:
    """Piece count and best score of strings under a unigram vocabulary."""

    def __init__(self, pieces: dict[str, float]):
        import ahocorasick
        self.unknown = min(pieces.values()) - UNKNOWN_PENALTY
        self.single = {p for p in pieces if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for p, score in pieces.items():
            self.automaton.add_word(p, (len(p), score))
        self.automaton.make_automaton()
        # May the path be cut before a space mark that follows another character, and around a line end?
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", p) or "\n" in p for p in pieces)
        self.words: dict[str, tuple[int, float]] = {}

    def path(self, s: str) -> tuple[int, float]:
        ends: list[list] = [[] for _ in s]
        for end, match in self.automaton.iter(s):
            ends[end].append(match)
        best, count = [0.0], [0]
        single, unknown = self.single, self.unknown
        for i, ch in enumerate(s):
            top, n = None, 0
            for length, score in sorted(ends[i], reverse=True):  # earliest start first
                x = best[i + 1 - length] + score
                if top is None or x > top:
                    top, n = x, count[i + 1 - length] + 1
            if ch not in single:
                x = best[i] + unknown
                if top is None or x > top:
                    top, n = x, count[i] + len(ch.encode("utf-8", "surrogatepass"))
            best.append(top)
            count.append(n)
        return count[-1], best[-1]

    def _word(self, w: str) -> tuple[int, float]:
        r = self.words.get(w)
        if r is None:
            if len(self.words) >= CACHE:
                self.words.clear()
            r = self.words[w] = self.path(w if w[:1] == "\n" else MARK + w)
        return r

    def count(self, text: str | None) -> tuple[int, float, int]:
        """(tokens, score, words between spaces and line ends)."""
        if not text:
            return 0, 0.0, 0
        if not self.cuts or "  " in text or MARK in text or text[0] == " ":
            marked = MARK + text.replace(" ", MARK)
            parts = re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", marked) if self.cuts else [marked]
            n, score = 0, 0.0
            for p in parts:
                a, b = self.path(p)
                n += a
                score += b
            return n, score, len(text.split())
        words = text.replace("\n", " \n").split(" ")
        found = list(map(self.words.get, words))
        if None in found:
            found = [x if x is not None else self._word(w) for w, x in zip(words, found)]
        n, score = map(sum, zip(*found))
        return n, float(score), len(words)


_COUNTERS: dict[str, UnigramCounter] = {}


def counter(path: str) -> UnigramCounter:
    """One per Python worker and vocabulary file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = UnigramCounter(load_pieces(path))
    return _COUNTERS[path]


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, score, n_words.

    ``vocabulary`` is the path of the SentencePiece file on every node.
    Narrow, one pass, no shuffle.
    """
    require(docs, doc_id=doc_id, text=text)
    prepare(docs.sparkSession)
    path = vocabulary or default_vocabulary()

    def run(batches):
        import pyarrow as pa
        c = counter(path)
        for b in batches:
            rows = [c.count(t) for t in b.column(1).to_pylist()]
            n, score, words = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(score, pa.float64()), pa.array(words, pa.int64())],
                                             names=["doc_id", "n_tokens", "score", "n_words"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, SCHEMA)
