"""Language of a text by unigram pieces, summed over all segmentations.

Each language is a distribution over the pieces of a fixed public vocabulary
(all its pieces of letters, lower-cased, and every single letter met in
training).  The probability of a word is the sum over all ways to cut it into
pieces, computed by the forward algorithm; the probability of a text is the
product over its words.  Piece probabilities are learnt by expectation
maximisation: the backward pass gives each piece's expected count, again over
all segmentations.

Training takes about ``SAMPLE_DOCS`` documents per language, drawn by a hash of
the id and so the same at every run, and of these the words of at most
``FIT_LETTERS`` letters; everything else covers all rows and whole words.
Scoring is in Python on Arrow batches: a worker scores each distinct word once,
and the words it has met are a memory bounded by letters.  A very long word is
scored in stretches that carry the probabilities of the last places on, so that
the sum stays whole and memory does not grow with the word.

A text that is null or has no letter is ``und`` with score 0; so is every text
if there is nothing to learn from.  Ties go to the first language in
alphabetical order.  Repeated rows are scored each, rows with a null id too
(they are in fold 0), an empty table gives no rows, and extra columns, whatever
their names, are not returned.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from itertools import chain
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import byte_slices, fold_of
from vitrine.llm.tokens import vocabulary_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SAMPLE_DOCS = 400
ROUNDS = 4
FIT_LETTERS = 1000
FOLDS, HELD_OUT = 4, 2
#: A letter or piece never met in a language has this expected count.
UNSEEN = 0.05

_LETTERS_HELD = 4 << 20
_ROUND_BYTES = 4 << 20
#: Letters whose lattice is held at once.
_STRETCH = 50_000
_find_words = re.compile(r"[^\W\d_]+").findall


def public_pieces(path: str) -> list[str]:
    """Letter pieces of a byte-level vocabulary file, lower-cased and without the space in front."""
    found = set()
    with open(path, "rb") as lines:
        for line in lines:
            try:
                piece = base64.b64decode(line.split()[0]).decode().strip(" ").lower()
            except UnicodeDecodeError:
                continue
            if piece.isalpha():
                found.add(piece)
    return sorted(found)


class Lattice(NamedTuple):
    """All pieces inside some words; the places of a word follow each other, from its begin to behind its last letter."""

    begins: np.ndarray  # first and last place of each word
    ends: np.ndarray
    start: np.ndarray  # places and id of each piece
    end: np.ndarray
    piece: np.ndarray


def _grouped(step: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per step in ascending order: its edges by place, and where each place begins among them."""
    order = np.lexsort((place, step))
    bounds = np.flatnonzero(np.diff(step[order], prepend=-1))
    for some in np.split(order, bounds[1:]):
        yield some, np.flatnonzero(np.diff(place[some], prepend=-1))


def _log_sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Log of the sum of ``exp(values)`` of each group of rows."""
    top = np.maximum.reduceat(values, firsts)
    sizes = np.diff(firsts, append=len(values))
    return top + np.log(np.add.reduceat(np.exp(values - np.repeat(top, sizes, axis=0)), firsts))


def _blocks(words: list[str]) -> Iterator[list[int]]:
    """Places of words of similar length, about ``_STRETCH`` letters together."""
    some, held = [], 0
    for i in sorted(range(len(words)), key=lambda i: len(words[i])):
        if some and held + len(words[i]) > _STRETCH:
            yield some
            some, held = [], 0
        some.append(i)
        held += len(words[i])
    if some:
        yield some


class PieceModel:
    """Piece probabilities per language; row 0 of the table is a letter outside the vocabulary."""

    def __init__(self, pieces: list[str], languages: list[str]):
        self.pieces, self.languages = pieces, languages
        self.table = np.full((len(pieces) + 1, len(languages)), 1.0 / (len(pieces) + 1))

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("pieces", "languages", "table")}

    @cached_property
    def _finder(self) -> ahocorasick.Automaton:
        finder = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, piece in enumerate(self.pieces):
            finder.add_word(piece, i + 1)
        finder.make_automaton()
        return finder

    @cached_property
    def _sizes(self) -> np.ndarray:
        return np.array([1] + [len(p) for p in self.pieces])

    def lattice(self, words: list[str]) -> Lattice:
        lengths = np.array([len(w) for w in words])
        ends = np.cumsum(lengths + 1) - 1
        # the blank behind a word is its last place, and no piece crosses it
        whole = " ".join(words)
        found = np.fromiter(chain.from_iterable(self._finder.iter(whole)), dtype=np.int64).reshape(-1, 2)
        end, piece = found[:, 0] + 1, found[:, 1]
        unknown = np.ones(len(whole) + 1, dtype=bool)
        unknown[ends] = False
        unknown[end[self._sizes[piece] == 1] - 1] = False
        letters = np.flatnonzero(unknown)
        end = np.concatenate([end, letters + 1])
        piece = np.concatenate([piece, np.zeros(len(letters), dtype=np.int64)])
        return Lattice(ends - lengths, ends, end - self._sizes[piece], end, piece)

    def forward(self, cuts: Lattice, logs: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        """Log probability of what lies before each place, over all segmentations.

        ``known`` has the values of the first places, if the first word begins earlier.
        """
        alpha = np.full((cuts.ends[-1] + 1, len(self.languages)), -np.inf)
        alpha[cuts.begins] = 0.0
        first = 0
        if known is not None:
            first = len(known) - 1
            alpha[:len(known)] = known
        step = cuts.end - cuts.begins[np.searchsorted(cuts.begins, cuts.start, "right") - 1]
        for some, firsts in _grouped(step, cuts.end):
            if step[some[0]] > first:
                alpha[cuts.end[some[firsts]]] = _log_sums(alpha[cuts.start[some]] + logs[cuts.piece[some]], firsts)
        return alpha

    def backward(self, cuts: Lattice, logs: np.ndarray) -> np.ndarray:
        """Log probability of what lies behind each place in its word, over all segmentations."""
        beta = np.full((cuts.ends[-1] + 1, len(self.languages)), -np.inf)
        beta[cuts.ends] = 0.0
        step = cuts.ends[np.searchsorted(cuts.begins, cuts.start, "right") - 1] - cuts.start
        for some, firsts in _grouped(step, cuts.start):
            beta[cuts.start[some[firsts]]] = _log_sums(beta[cuts.end[some]] + logs[cuts.piece[some]], firsts)
        return beta

    def _long_word(self, word: str, logs: np.ndarray) -> np.ndarray:
        """Log probability of one word, a stretch at a time."""
        reach = int(self._sizes.max())
        known = np.zeros((1, len(self.languages)))
        for begin in range(0, len(word), _STRETCH):
            back = begin - (len(known) - 1)
            alpha = self.forward(self.lattice([word[back:begin + _STRETCH]]), logs, known)
            known = alpha[-reach - 1:]
        return known[-1]

    def log_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word per language."""
        out = np.zeros((len(words), len(self.languages)))
        logs = np.log(self.table)
        for some in _blocks(words):
            if len(words[some[0]]) > _STRETCH:
                out[some[0]] = self._long_word(words[some[0]], logs)
            else:
                cuts = self.lattice([words[i] for i in some])
                out[some] = self.forward(cuts, logs)[cuts.ends]
        return out

    def fit(self, counts: list[Counter], rounds: int = ROUNDS) -> PieceModel:
        """Expectation maximisation on word counts per language."""
        words = sorted(set().union(*counts))
        weights = np.array([[c[w] for c in counts] for w in words], dtype=np.float64)
        blocks = [(self.lattice([words[i] for i in some]), weights[some]) for some in _blocks(words)]
        for _ in range(rounds):
            expected = np.full_like(self.table, UNSEEN)
            logs = np.log(self.table)
            for cuts, weight in blocks:
                alpha, beta = self.forward(cuts, logs), self.backward(cuts, logs)
                word = np.searchsorted(cuts.begins, cuts.start, "right") - 1
                flow = alpha[cuts.start] + logs[cuts.piece] + beta[cuts.end] - alpha[cuts.ends][word]
                share = np.exp(flow) * weight[word]
                for g in range(len(self.languages)):
                    expected[:, g] += np.bincount(cuts.piece, share[:, g], len(expected))
            self.table = expected / expected.sum(axis=0)
        return self


def training_sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``lang, text`` of about ``sample_docs`` labelled documents per language outside the held-out fold."""
    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(fold_of("doc_id", FOLDS) != HELD_OUT)
    counts = {r["lang"]: r["held"] for r in labelled.groupBy("lang").agg(F.count("*").alias("held")).collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1 << 30))
    chosen = F.lit(False)
    for lang, held in counts.items():
        chosen = chosen | ((F.col("lang") == lang) & (draw < int(min(1.0, sample_docs / held) * (1 << 30))))
    return labelled.where(chosen).select("lang", "text")


def word_counts(sample: DataFrame) -> DataFrame:
    """``lang, word, n`` of the words of at most ``FIT_LETTERS`` letters."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", _ROUND_BYTES):
            met: Counter = Counter()
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                met.update((lang, w) for w in _find_words(text.lower()) if len(w) <= FIT_LETTERS)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in met], pa.string()), pa.array([k[1] for k in met], pa.string()),
                 pa.array(list(met.values()), pa.int64())], names=["lang", "word", "n"])

    return sample.mapInArrow(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, vocabulary: str | None = None) -> PieceModel | None:
    counts: dict[str, Counter] = {}
    for row in word_counts(training_sample(docs, sample_docs)).collect():  # bounded by the sample
        counts.setdefault(row["lang"], Counter())[row["word"]] = row["n"]
    languages = sorted(counts)
    if not languages:
        return None
    letters = set().union(*(set(w) for k in languages for w in counts[k]))
    pieces = sorted(letters.union(public_pieces(vocabulary or vocabulary_path(VOCABULARY))))
    return PieceModel(pieces, languages).fit([counts[k] for k in languages])


class Scorer:
    """Scores of texts, with each distinct word scored once."""

    def __init__(self, model: PieceModel):
        self.model, self.rows, self.letters = model, {}, 0
        self.scores = np.zeros((0, len(model.languages)))

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the log probabilities per language, and the number of words, of each text."""
        if self.letters > _LETTERS_HELD:
            self.rows, self.letters, self.scores = {}, 0, self.scores[:0]
        words = [_find_words(t.lower()) if t else [] for t in texts]
        new = list(set().union(*words).difference(self.rows))
        if new:
            first = len(self.scores)
            self.scores = np.concatenate([self.scores, self.model.log_scores(new)])
            self.rows.update(zip(new, range(first, first + len(new))))
            self.letters += sum(map(len, new))
        rows = self.rows
        counts = np.array([len(w) for w in words])
        total = np.zeros((len(texts), self.scores.shape[1]))
        for k, own in enumerate(words):
            if own:
                total[k] = self.scores[[rows[w] for w in own]].sum(axis=0)
        return total, counts


def predict_languages(docs: DataFrame, model: PieceModel | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    base = docs.select("doc_id", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text")
    if model is None:
        return base.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    languages = np.array(model.languages, dtype=object)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in byte_slices(batches, "text", _ROUND_BYTES):
            total, counts = scorer.texts(batch.column("text").to_pylist())
            best = total.argmax(axis=1)
            score = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            none = counts == 0
            lang = languages[best]
            lang[none], score[none] = "und", 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(predicted, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame) -> DataFrame:
    return predict_languages(docs, train(docs))
