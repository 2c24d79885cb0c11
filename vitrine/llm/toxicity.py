"""Toxicity of texts: boosted trees over dense features, with isotonic calibration.

The features are rates that hold for any length of text: words of the lexicon,
also behind digits, symbols, stretched, dotted or spaced letters (these count as
hits like plain ones), how many of them stand near a second-person word,
capitals, punctuation and disguised words.  The
lexicon is a fixed list of insults and, in any language, the words of which the
training rows show with certainty that most texts that hold them are toxic.
The rows that fit the trees are read with words found in other rows.  Trees and
calibration are fitted on separate parts of about ``SAMPLE_ROWS`` labelled
rows, drawn by a hash of the id; scoring covers every whole text, in time
linear in its length.

Null texts are empty texts; empty texts get the score of their (zero) features.
Without both labels among the training rows the score is the share of label 1,
or 0.  Labels that are null are left out; of a ``doc_id`` with several labels
the largest holds.  Repeated rows are scored each.  Empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm.common import byte_slices, fold_of, plain_text, without_clashes
from vitrine.sources.scratch import cut_lineage

FOLDS, HELD_OUT = 5, 0
SAMPLE_ROWS = 16_000
CALIBRATION_PART = 4  # one row in four
TREES, DEPTH = 15, 3
NEAR = 5
CERTAINTY = 1.64  # of the interval of a word's share of toxic texts; three texts of three pass
SMOOTHING = 20  # words that a text counts as longer in the smoothed share of hits

# Common insults, and second-person words of four languages.
INSULTS = (
    "idiot moron stupid dumb loser scum trash garbage clown pathetic worthless disgusting imbecile jerk creep vermin "
    "filth degenerate retard bastard bitch asshole dumbass shithead fucker cunt whore slut pig parasite "
    "dummkopf arschloch abschaum schwachkopf idioten connard salaud imbécile débile ordure idiota imbécil estúpido "
    "basura asqueroso").split()
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos tú ti usted "
    "ustedes vosotros").split()
DISGUISES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

FEATURES = ("hits", "hit_rate", "disguised_hits", "near_second_person", "second_person_rate", "capital_rate",
            "shouted_rate", "exclamation_rate", "question_rate", "punctuation_rate", "digit_rate", "disguised_rate")

_ROUND_BYTES = 4 << 20
_UNDISGUISED = (str.maketrans(DISGUISES), str.maketrans(DISGUISES | {"1": "l", "!": "l"}))
_EDGES = ".,;:!?\"'()[]{}<>*#_-"
_PEOPLE = frozenset(SECOND_PERSON)
_find_words = re.compile(r"[^\W\d_]+").findall
_is_mixed = re.compile(r"[^\W\d_][0-9@$!|*#._-]+[^\W_]").search
_has_stretch = re.compile(r"(.)\1\1").search
_squeezed = re.compile(r"(.)\1{2,}").sub
_STRETCHED = "|".join(3 * c for c in "abcdefghijklmnopqrstuvwxyz")
_spelling = re.compile(r"[\w@$!|][.,;:!?]?").fullmatch


def _byte_classes() -> np.ndarray:
    """Class of each byte: 1 capital, 2 exclamation, 3 question, 4 other punctuation, 5 digit, 0 the rest."""
    table = np.zeros(256, dtype=np.uint8)
    table[[i for i in range(33, 127)]] = 4
    table[ord("A"):ord("Z") + 1] = 1
    table[ord("a"):ord("z") + 1] = 0
    table[ord("0"):ord("9") + 1] = 5
    table[ord("!")], table[ord("?")] = 2, 3
    return table


_CLASSES = _byte_classes()


class Reader:
    """Reads the features of texts: looks at each distinct token of a slice once, then adds up by text."""

    def __init__(self, lexicon: frozenset[str]):
        self.lexicon = lexicon
        self.words, self.people = pa.array(sorted(lexicon)), pa.array(SECOND_PERSON)
        self.spelled = ahocorasick.Automaton()
        for word in lexicon:
            if len(word) > 3:
                self.spelled.add_word(word, len(word))
        self.spelled.make_automaton()

    def _revealed(self, token: str) -> bool:
        """Whether a lower-case token hides a word of the lexicon behind digits, symbols, dots or stretched letters."""
        for form in {f.translate(table) for f in (token, token.strip(_EDGES)) for table in _UNDISGUISED}:
            bare = "".join(filter(str.isalpha, form))
            if bare in self.lexicon:
                return True
            if _has_stretch(bare) and not self.lexicon.isdisjoint((_squeezed(r"\1", bare), _squeezed(r"\1\1", bare))):
                return True
        return False

    def _broken(self, token: str) -> tuple[int, ...]:
        """Marks of a token that is not a word between punctuation marks."""
        core = token.strip(_EDGES)
        low = core.lower()
        words = _find_words(low)
        hits, people = sum(w in self.lexicon for w in words), sum(w in _PEOPLE for w in words)
        hidden = int(not hits and self._revealed(token.lower()))
        return (len(words), hits + hidden, hidden, people, int(core.isupper() and len(core) > 2),
                int(_is_mixed(core) is not None))

    def marks(self, tokens: pa.StringArray) -> np.ndarray:
        """One row for each token: words, hits, disguised hits, second-person words, shouted and mixed tokens."""
        cores = pc.utf8_trim(tokens, characters=_EDGES)
        low = pc.utf8_lower(cores)
        alpha = pc.utf8_is_alpha(low).to_numpy(zero_copy_only=False)
        hit, person, upper, stretched = (x.to_numpy(zero_copy_only=False) for x in (
            pc.is_in(low, self.words), pc.is_in(low, self.people), pc.utf8_is_upper(cores),
            pc.match_substring_regex(low, _STRETCHED)))
        out = np.zeros((len(tokens), 6), dtype=np.int64)
        out[:, 0] = alpha
        out[:, 1], out[:, 3] = alpha & hit, alpha & person
        out[:, 4] = alpha & upper & (pc.utf8_length(cores).to_numpy() > 2)
        for i in np.flatnonzero(alpha & stretched & ~hit):
            out[i, 1] = out[i, 2] = self._revealed(low[i].as_py())
        for i in np.flatnonzero(~alpha):
            out[i] = self._broken(tokens[i].as_py())
        return out

    def _spelled_words(self, letters: str) -> list[int]:
        """Where a run of single characters spells a word of the lexicon."""
        found = []
        if not len(self.spelled):
            return found
        for form in {letters.translate(table) for table in _UNDISGUISED}:
            found += [(end, end - size + 1) for end, size in self.spelled.iter(form)]
        places, ended = [], -1
        for end, begin in sorted(found):
            if begin > ended:
                places.append(begin)
                ended = end
        return places

    def _runs(self, distinct: pa.StringArray, code: np.ndarray, text_of: np.ndarray) -> Iterator[tuple[int, str]]:
        """Runs of at least four single characters within a text: their first token's place, and the characters."""
        spelling = np.zeros(len(distinct), dtype=np.int8)  # 1: a character, 2: with a mark that ends the run
        letters = np.zeros(len(distinct), dtype="<U1")
        for i in np.flatnonzero(pc.utf8_length(distinct).to_numpy() < 3):
            token = distinct[i].as_py()
            if _spelling(token):
                spelling[i] = len(token)
                low = token[0].lower()
                letters[i] = low if len(low) == 1 else token[0]
        kind = spelling[code]
        there = np.flatnonzero(kind)
        if len(there) < 4:
            return
        parts = (np.diff(there) != 1) | (np.diff(text_of[there]) != 0) | (kind[there[:-1]] == 2)
        begins = np.concatenate([[0], np.flatnonzero(parts) + 1, [len(there)]])
        for a, b in zip(begins, begins[1:]):
            if b - a >= 4:
                yield int(there[a]), "".join(letters[code[there[a:b]]].tolist())

    def features(self, texts: pa.StringArray) -> np.ndarray:
        """One row of ``FEATURES`` for each text."""
        n = len(texts)
        raw = np.frombuffer("".join(texts.to_pylist()).encode(), dtype=np.uint8)
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        classes = np.bincount(np.repeat(np.arange(n) * 6, sizes) + _CLASSES[raw], minlength=6 * n).reshape(n, 6)
        split = pc.utf8_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        distinct, code = coded.dictionary, coded.indices.to_numpy()
        text_of = np.repeat(np.arange(n), np.diff(split.offsets.to_numpy()))
        marks = self.marks(distinct)
        marked = np.flatnonzero(marks[:, 1:].any(axis=1) | (marks[:, 0] != 1))
        odd = np.zeros(len(distinct), dtype=bool)
        odd[marked] = True
        sums = np.zeros((n, 6))
        sums[:, 0] = np.bincount(text_of, minlength=n)
        there = np.flatnonzero(odd[code])  # all other tokens are one word each
        here = marks[code[there]]
        here[:, 0] -= 1
        for k in range(6):
            sums[:, k] += np.bincount(text_of[there], weights=here[:, k], minlength=n)
        at_hits, at_people = [there[here[:, 1] > 0]], there[here[:, 3] > 0]
        runs = np.zeros(n)
        for place, run in self._runs(distinct, code, text_of):
            text = text_of[place]
            runs[text] += 1
            spelled = self._spelled_words(run)
            sums[text, 1:3] += len(spelled)
            at_hits.append(np.array(spelled, dtype=np.int64) + place)
        hits = np.concatenate(at_hits)
        # second-person words within NEAR tokens of the same text; the offset keeps texts apart
        apart = text_of * (2 * NEAR + 2)
        people = at_people + apart[at_people]
        first, last = (np.searchsorted(people, hits + apart[hits] + d, side) for d, side in ((-NEAR, "left"), (NEAR, "right")))
        near = np.bincount(text_of[hits], weights=first < last, minlength=n)
        words, size = np.maximum(1, sums[:, 0]), np.maximum(1, sizes)
        return np.column_stack([
            sums[:, 1] / (words + SMOOTHING), sums[:, 1] / words, sums[:, 2], near, sums[:, 3] / words,
            classes[:, 1] / size, sums[:, 4] / words, *(classes[:, k] / size for k in (2, 3, 4, 5)),
            (sums[:, 5] + runs) / words])


def with_features(docs: DataFrame, lexicons: list[frozenset[str]]) -> DataFrame:
    """The columns but the text, and ``features``; column ``lexicon`` says which of several lexicons reads a row."""
    kept = [c for c in docs.columns if c != "text"]

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [Reader(x) for x in lexicons]  # of this task, so nothing stays in a worker
        for batch in byte_slices(batches, "text", _ROUND_BYTES):
            chosen = batch.column("lexicon").to_pylist() if "lexicon" in kept else [0] * batch.num_rows
            chosen, rows = np.array(chosen), np.zeros((batch.num_rows, len(FEATURES)))
            for i, reader in enumerate(readers):
                at = np.flatnonzero(chosen == i)
                rows[at] = reader.features(batch.column("text").take(pa.array(at)))
            flat = pa.array(rows.reshape(-1))
            offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.ListArray.from_arrays(offsets, flat)], names=[*kept, "dense"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.select(*kept, plain_text().alias("text")).mapInArrow(
        featured, f"{schema}, dense array<double>").withColumn("features", array_to_vector("dense")).drop("dense")


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, text, toxic, lexicon`` of about ``sample_rows`` labelled documents outside the held-out fold.

    ``lexicon`` is the half of the sample whose words read this row: always the other one, and
    rows of one text are in one half, so a text's own words do not speak for it.
    """
    known = (labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(fold_of("doc_id", FOLDS) != HELD_OUT)
             .groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic")))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity sample")), F.lit(1 << 30))
    part = min(1.0, sample_rows / max(1, known.count()))
    chosen = known.where(draw < int(part * (1 << 30)))
    return cut_lineage(docs.select("doc_id", plain_text().alias("text")).join(chosen, "doc_id").withColumn(
        "lexicon", F.pmod(F.xxhash64("text", F.lit("half")), F.lit(2)).cast("int")))


def _surely_toxic(toxic: Column, rows: Column) -> Column:
    """Whether the share of toxic texts among those with a word is above one half, by the lower end of its interval."""
    z = CERTAINTY
    share = toxic / rows
    middle = share + z * z / (2 * rows)
    width = z * F.sqrt((share * (1 - share) + z * z / (4 * rows)) / rows)
    return F.coalesce((middle - width) / (1 + z * z / rows) > 0.5, F.lit(False))


def telling_words(rows: DataFrame) -> list[frozenset[str]]:
    """Words that nearly only toxic texts hold: by the texts of the other half for halves 0 and 1, and by all.

    Equal texts count once.  There are as many words as pass the test; their number is bounded by the sample.
    """
    texts = rows.groupBy("text").agg(F.max("toxic").alias("toxic"), F.min("lexicon").alias("half"))
    words = texts.select("toxic", "half", F.explode(F.array_distinct(
        F.split(F.lower("text"), r"[^\p{L}]+"))).alias("w")).where(F.length("w") > 2)
    counted = words.groupBy("w").agg(*(
        F.sum(F.when(F.col("half") == h, x).otherwise(0)).cast("double").alias(f"{name}{h}")
        for h in (0, 1) for name, x in (("toxic", F.col("toxic")), ("rows", F.lit(1)))))
    tests = [_surely_toxic(F.col(f"toxic{h}"), F.nullif(F.col(f"rows{h}"), F.lit(0.0))) for h in (1, 0)]
    tests.append(_surely_toxic(F.col("toxic0") + F.col("toxic1"), F.col("rows0") + F.col("rows1")))
    found = counted.select("w", *(t.alias(f"by{i}") for i, t in enumerate(tests))).where("by0 OR by1 OR by2").collect()
    return [frozenset(r["w"] for r in found if r[f"by{i}"]) for i in range(3)]


class ToxicityModel:
    """A fitted lexicon, boosted trees and their calibration; or a constant where nothing could be fitted."""

    def __init__(self, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS):
        rows = training_rows(docs, labels, sample_rows)
        shares = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        total = sum(shares.values())
        self.constant = shares.get(1.0, 0) / total if total else 0.0
        self.trees = self.calibration = None
        self.lexicon = frozenset(INSULTS)
        if len(shares) < 2:
            return
        *halves, whole = (self.lexicon | words for words in telling_words(rows))
        self.lexicon = whole
        known = cut_lineage(with_features(rows, halves).withColumn(
            "calibrates", F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(CALIBRATION_PART)) == 0))
        fitted, held = known.where("NOT calibrates"), known.where("calibrates")
        if fitted.select("toxic").distinct().count() < 2:
            fitted = known
        self.trees = GBTClassifier(
            labelCol="toxic", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7,
            checkpointInterval=-1).fit(fitted)
        scored = self._raw(held)
        if held.select("toxic").distinct().count() == 2:
            self.calibration = IsotonicRegression(labelCol="toxic", featuresCol="raw", predictionCol="score").fit(scored)

    def _raw(self, rows: DataFrame) -> DataFrame:
        out = self.trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])
        return out.drop("features", "rawPrediction", "probability", "prediction")

    def score(self, docs: DataFrame) -> DataFrame:
        """The columns of ``docs`` but the text, and ``score``."""
        if self.trees is None:
            return docs.drop("text").withColumn("score", F.lit(float(self.constant)))
        raw = self._raw(with_features(docs, [self.lexicon]))
        if self.calibration is None:
            return raw.withColumnRenamed("raw", "score")
        # the trees order texts that the calibration puts on one step
        stepped = self.calibration.transform(raw)
        return stepped.withColumn("score", F.least(F.greatest(
            0.98 * F.col("score") + 0.02 * F.col("raw"), F.lit(0.0)), F.lit(1.0))).drop("raw")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    model = ToxicityModel(docs, labels)
    return model.score(docs.select("doc_id", "text")).select(
        "doc_id", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model does not reject; all columns stay.

    The decision is per text, so copies of a text stay or go together.
    """
    model = ToxicityModel(docs, labels)
    rows = without_clashes(docs, ["toxic_key"]).withColumn("toxic_key", F.md5(plain_text().cast("binary")))
    rejected = model.score(rows.select("toxic_key", "text")).where("score >= 0.5").select("toxic_key").distinct()
    return rows.join(rejected, "toxic_key", "left_anti").drop("toxic_key")
