"""Near duplicates by Order MinHash, verified by banded alignment.

A text is a sequence of words (runs of letters and digits in lower case) and
of k-mers of ``WORDS`` words.  A k-mer is labelled with its occurrence number in
the text, so each labelled k-mer is unique there and repeated passages count.
A sketch takes the ``SAMPLED`` labelled k-mers of smallest hash and keeps them
in text order; texts whose sketches agree in two of ``TABLES`` hash functions are
candidates (99.9 % of the pairs at a similarity of 0.8, more above; texts that
only share a passage seldom do).  A candidate pair is verified by the longest chain of common
labelled k-mers that runs in the same order in both texts and inside the
diagonal band that the threshold allows.  The similarity is the length of the
chain over the number of labelled k-mers of both texts without it twice: the
Jaccard similarity of word shingles, held to the order.  0.8 or more links.

Equal texts are one node from the start.  In a bucket every text is compared
with one lead first, the text that shares its sketches with most others, in
``LEAD_TURNS`` turns; texts of one bucket that are then still in different
components are compared with each other where their rarest k-mers and the
number of k-mers that any other component holds allow the similarity, so no
candidate is left out and a large group of near copies does not become all its
pairs.

A text of fewer than ``WORDS`` words has one k-mer, the text.  Texts without a
word (null and empty texts too) are in groups of their own, apart from equal
texts, which are copies: null counts as empty.  Rows that repeat ``doc_id`` and
text are one document.  Extra columns pass through ``one_of_each``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.llm.common import byte_slices, plain_text, without_clashes
from vitrine.llm.components import components
from vitrine.sources.scratch import cut_lineage

WORDS = 5
SIMILARITY = 0.8
SAMPLED = 3
TABLES = 14
LEAD_TURNS = 2
BIT_WORDS = 8

_ROUND_BYTES = 4 << 20
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_find_words = re.compile(r"[^\W_]+").findall


def _odd_numbers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1 << 62, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_WORD_FACTORS = _odd_numbers(WORDS, 1)
_TABLE_FACTORS = _odd_numbers(TABLES, 2)
_TABLE_SHIFTS = _odd_numbers(TABLES, 3)
_PLACE_FACTORS = _odd_numbers(SAMPLED, 4)
_OCCURRENCE = _odd_numbers(1, 5)[0]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def labelled_kmers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrence-labelled k-mers of all texts in text order, and how many each text has."""
    words: list[str] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        own = _find_words(text.lower())
        if own:
            own += [""] * (WORDS - len(own))
        words += own
        counts[k] = len(own)
    kmers = np.maximum(counts - (WORDS - 1), 0)
    if not words:
        return np.zeros(0, dtype=np.uint64), kmers
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    hashes = pd.util.hash_array(np.asarray(distinct, dtype=object), categorize=False)[codes]
    length = len(hashes) - (WORDS - 1)
    rolled = np.zeros(length, dtype=np.uint64)
    for k in range(WORDS):
        rolled += hashes[k:k + length] * _WORD_FACTORS[k]
    # k-mers that start in the last words of a text would run into the next
    begins = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(texts)), kmers)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(kmers) - kmers, kmers) + np.repeat(begins, kmers)
    rolled = _mixed(rolled[at])
    # occurrence number: place in the run of equal k-mers of one text
    keyed = rolled ^ _mixed(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keyed, kind="stable")
    ordered = keyed[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    run = np.arange(len(ordered)) - np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))
    seen = np.empty(len(ordered), dtype=np.uint64)
    seen[order] = run
    return _mixed(rolled + seen * _OCCURRENCE), kmers


def sketch(labelled: np.ndarray, kmers: np.ndarray) -> np.ndarray:
    """One row per text and a column per table; texts without k-mers have zeros."""
    out = np.zeros((len(kmers), TABLES), dtype=np.uint64)
    full = np.flatnonzero(kmers)
    if not len(full):
        return out
    sizes = kmers[full]
    begins = np.cumsum(sizes) - sizes
    for t in range(TABLES):
        values = _mixed((labelled ^ _TABLE_SHIFTS[t]) * _TABLE_FACTORS[t])
        least, places = [], []
        for _ in range(SAMPLED):
            smallest = np.minimum.reduceat(values, begins)
            hits = np.flatnonzero(values == np.repeat(smallest, sizes))
            place = np.zeros(len(full), dtype=np.int64)
            place[np.searchsorted(begins, hits, side="right") - 1] = hits
            least.append(smallest)
            places.append(place)
            values[hits] = _TOP
        least, order = np.array(least), np.argsort(np.array(places), axis=0, kind="stable")
        in_text_order = np.take_along_axis(least, order, axis=0)
        code = np.full(len(full), np.uint64(t + 1))
        for k in range(SAMPLED):
            code = _mixed(code + in_text_order[k] * _PLACE_FACTORS[k])
        out[full, t] = code
    return out


def parity_bits(labelled: np.ndarray, kmers: np.ndarray) -> np.ndarray:
    """``BIT_WORDS`` words per text: each k-mer flips one bit.

    Bits that differ between two texts are at most the k-mers that only one of
    them has.
    """
    width = 64 * BIT_WORDS
    owner = np.repeat(np.arange(len(kmers)), kmers)
    place = (_mixed(labelled) % np.uint64(width)).astype(np.int64)
    odd = np.bincount(owner * width + place, minlength=len(kmers) * width) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).reshape(len(kmers), BIT_WORDS)


def aligned_similarity(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> float:
    """Similarity of two sequences of labelled k-mers; 0.0 as soon as it must be below ``threshold``."""
    if not len(a) or not len(b):
        return 0.0
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = len(a) + len(b)
    if len(in_a) < threshold * (both - len(in_a)):
        return 0.0
    band = int(both * (1 - threshold) / (1 + threshold)) + 1
    order = np.argsort(in_a)
    in_a, in_b = in_a[order], in_b[order]
    chain: list[int] = []  # smallest last place of a chain of each length
    for place in in_b[np.abs(in_a - in_b) <= band].tolist():
        k = bisect_left(chain, place)
        if k == len(chain):
            chain.append(place)
        else:
            chain[k] = place
    return len(chain) / (both - len(chain))


def _text_key() -> Column:
    return F.unhex(F.md5(plain_text().cast("binary")))


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id, key, n, bands`` of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", _ROUND_BYTES):
            labelled, kmers = labelled_kmers(batch.column("text").to_pylist())
            codes = sketch(labelled, kmers)
            offsets = pa.array(np.arange(len(kmers) + 1, dtype=np.int32) * TABLES)
            bands = pa.ListArray.from_arrays(offsets, pa.array(codes.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(kmers), bands],
                names=["doc_id", "key", "n", "bands"])

    return docs.select("doc_id", _text_key().alias("key"), plain_text().alias("text")).mapInArrow(
        sketches, f"doc_id {id_type}, key binary, n bigint, bands array<bigint>")


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``key, text`` of the given nodes ``key, first_id``, once each."""
    rows = docs.select("doc_id", plain_text().alias("text"))
    return (rows.join(nodes, rows["doc_id"].eqNullSafe(nodes["first_id"]))
            .where(_text_key() == F.col("key")).dropDuplicates(["key"]).select("key", "text"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of text keys whose similarity reaches the threshold."""
    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}  # the k-mers of the texts of a few pairs

        def kmers_of(key: bytes, text: str) -> np.ndarray:
            if key not in known:
                if len(known) > 64:
                    known.clear()
                known[key] = labelled_kmers([text])[0]
            return known[key]

        for batch in byte_slices(batches, "text_b", _ROUND_BYTES):
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")]
            kept = [aligned_similarity(kmers_of(a, ta), kmers_of(b, tb)) >= SIMILARITY
                    for a, b, ta, tb in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    joined = (pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
              .join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b"))
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(aligned, "a binary, b binary")


def _shared(found: DataFrame) -> DataFrame:
    """The rows ``bucket, key, ..`` whose bucket has several ``members``."""
    several = found.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    return found.join(several, "bucket")


def candidate_buckets(nodes: DataFrame) -> DataFrame:
    """``bucket, key, n, central``: texts of one bucket agree in two tables.

    The buckets of single tables are only met by texts that share them, so few
    tables are left to pair per text.  ``central`` adds up the members of all
    single tables' buckets of the text.
    """
    single = _shared(nodes.where("n > 0").select("key", "n", F.explode("bands").alias("bucket")))
    tables = single.groupBy("key", "n").agg(
        F.array_sort(F.collect_set("bucket")).alias("met"), F.sum("members").alias("central")).where("size(met) > 1")
    paired = F.expr("""flatten(transform(sequence(1, size(met) - 1),
        i -> transform(slice(met, i + 1, size(met)), other -> xxhash64(met[i - 1], other))))""")
    return _shared(tables.select("key", "n", "central", F.explode(paired).alias("bucket"))).drop("members")


#: A similarity of s needs the shorter text to have at least s of the k-mers of the longer.
_ALIKE = f"least(n, n_other) >= {SIMILARITY}D * greatest(n, n_other)"
#: Two texts share no more k-mers than the fewest that one of them shares with any other component.
_REACHABLE = f"{1 + SIMILARITY}D * least(common, common_other) >= {SIMILARITY}D * (n + n_other) - 1e-6D"
#: Bits that differ are k-mers outside the intersection.
_BITS_ALIKE = (" + ".join(f"bit_count(bits[{k}] ^ bits_other[{k}])" for k in range(BIT_WORDS))
               + f" <= {(1 - SIMILARITY) / (1 + SIMILARITY)}D * (n + n_other) + 1e-6D")


def _lead_pairs(members: DataFrame, nodes: DataFrame, groups: DataFrame | None, turn: int) -> DataFrame:
    """``a, b``: each text with the leads of its buckets, where they are still apart.

    The lead is the most central text of the bucket, of several the first by a
    hash of the turn.  In the first turn a text meets the most central of its
    leads alone.
    """
    order = F.struct(-F.col("central"), F.xxhash64("key", F.lit(turn)), "key").alias("lead")
    leads = members.groupBy("bucket").agg(F.min(order).alias("lead"))
    met = members.join(leads, "bucket").select("key", "n", "lead")
    if groups is None:
        met = met.groupBy("key", "n").agg(F.min("lead").alias("lead"))
    met = met.withColumn("lead", F.col("lead.key"))
    met = met.where("key <> lead").select("key", "n", "lead").distinct().join(
        nodes.select(F.col("key").alias("lead"), F.col("n").alias("n_other")), "lead").where(_ALIKE)
    if groups is not None:
        own = groups.select(F.col("node").alias("key"), F.col("component").alias("own"))
        theirs = groups.select(F.col("node").alias("lead"), F.col("component").alias("theirs"))
        met = met.join(own, "key", "left").join(theirs, "lead", "left").where(
            "coalesce(own, key) <> coalesce(theirs, lead)")
    return met.select(F.least("key", "lead").alias("a"), F.greatest("key", "lead").alias("b")).distinct()


def _rare_pairs(apart: DataFrame) -> DataFrame:
    """``a, b``: the texts ``key, component, text`` of different components that can reach the threshold.

    Of two texts at the threshold each holds one of the rarest fifth of the
    other's k-mers among its own rarest fifth (the prefix filter of exact set
    joins), so no pair is lost.  K-mers that no other component holds are the
    rarest: two texts of different components share none of them, so a text
    with many of its own meets nothing, however many texts share the rest.
    Parity bits of the k-mers bound the similarity of the others from above
    (the bitmap filter of exact set joins) before a pair is made.
    """
    def kmers_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", _ROUND_BYTES):
            labelled, kmers = labelled_kmers(batch.column("text").to_pylist())
            ends = np.concatenate([[0], np.cumsum(kmers)]).astype(np.int32)
            bits = pa.array(parity_bits(labelled, kmers).reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("component"), pa.array(kmers),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(labelled.view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(kmers) + 1, dtype=np.int32) * BIT_WORDS), bits)],
                names=["key", "component", "n", "kmers", "bits"])

    sets = cut_lineage(apart.select("key", "component", "text").mapInArrow(
        kmers_of, "key binary, component binary, n bigint, kmers array<bigint>, bits array<bigint>"))
    rows = sets.select("key", "component", "n", F.explode("kmers").alias("kmer"))
    crossing = rows.groupBy("kmer").agg(
        F.count("*").alias("held"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    shared = rows.join(crossing.select("kmer", "held"), "kmer")
    rank = Window.partitionBy("key").orderBy("held", "kmer")
    kept = shared.withColumn("rank", F.row_number().over(rank)).withColumn(
        "common", F.count("*").over(Window.partitionBy("key")))
    prefix = cut_lineage(kept.where(f"n - common + rank <= n - ceil({SIMILARITY}D * n) + 1")
                         .select("key", "component", "n", "kmer", "common").join(sets.select("key", "bits"), "key"))
    left = prefix.select("kmer", F.col("key").alias("a"), F.col("component").alias("component_a"), "n", "common", "bits")
    right = prefix.select("kmer", F.col("key").alias("b"), F.col("component").alias("component_b"),
                          F.col("n").alias("n_other"), F.col("common").alias("common_other"),
                          F.col("bits").alias("bits_other"))
    return left.join(right, "kmer").where(
        f"a < b AND component_a <> component_b AND {_ALIKE} AND {_REACHABLE} AND {_BITS_ALIKE}").select(
        "a", "b").distinct()


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, key, group_id``: the smallest ``doc_id`` of the group each row belongs to."""
    rows = cut_lineage(sketched(docs))
    nodes = cut_lineage(rows.groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.max("n").alias("n"), F.any_value("bands").alias("bands")))
    members = cut_lineage(candidate_buckets(nodes))
    texts = cut_lineage(_texts_of(docs, nodes.select("key", "first_id").join(
        members.select("key").distinct(), "key", "left_semi")))

    # a few turns of texts against the leads of their buckets join most of a large group
    tested = links = groups = None
    for turn in range(LEAD_TURNS):
        pairs = _lead_pairs(members, nodes, groups, turn)
        pairs = cut_lineage(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        found = _verified(pairs, texts)
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = cut_lineage(found if groups is None else found.unionByName(
            groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        groups = components(links)

    # members of one bucket that are still apart are compared with each other
    placed = members.join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    apart = placed.join(mixed.select("bucket"), "bucket", "left_semi").select("key", "component").distinct()
    rest = cut_lineage(_rare_pairs(texts.join(apart, "key")).join(tested, ["a", "b"], "left_anti"))
    more = _verified(rest, texts)
    groups = components(more.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    named = nodes.select("key", "first_id").join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("group_id"))
    by_key = named.join(smallest, "component").select("key", "group_id")
    return rows.select("doc_id", "key").join(by_key, "key").select("doc_id", "key", "group_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with the smallest ``doc_id`` of each group; all columns stay.

    A document that repeats as a row stays once.  Of rows with a null
    ``doc_id``, which have no order, one row of each text stays.
    """
    groups = near_duplicate_groups(docs).where(
        F.col("doc_id").eqNullSafe(F.col("group_id"))).select(
        F.col("doc_id").alias("near_id"), F.col("key").alias("near_key"))
    rows = without_clashes(docs, ["near_id", "near_key", "text_key"]).withColumn("text_key", _text_key())
    kept = rows.join(groups.distinct(), rows["doc_id"].eqNullSafe(groups["near_id"])
                     & (rows["text_key"] == groups["near_key"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "text_key"]).drop("text_key")
