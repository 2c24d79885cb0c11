"""Documents packed into sequences of bounded length, in document order.

The ids of all documents, in ``doc_id`` order, are one stream.  Dynamic
programming chooses where to cut it: a sequence pays for its padding up to the
limit and for what its cut breaks (nothing at the end of a document, little at
the end of a sentence, more elsewhere).  The cheapest predecessor of a cut is
the front of a monotone queue, so the work is linear in the number of cuts.

Each partition packs its own range of documents; a partition is cut into
stretches of about ``STRETCH`` ids, and the last sequences of a stretch are
planned again with the next one, so memory stays bounded and only the end of a
partition leaves a sequence short.  Empty and null texts are one end id.  Rows
with a repeated ``doc_id`` are packed one after the other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from vitrine.llm.common import byte_slices
from vitrine.llm.tokens import ROUND_BYTES, encoder, in_order, vocabulary_path

LIMIT = 2048
END_ID = 1
#: A cut inside a sentence is possible at every 16th id, so full sequences are short by 15 at most.
GRID = 16
SENTENCE_COST = 4
INSIDE_COST = 16
STRETCH = 1 << 20
REPLANNED = 8

PIECES = ("doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


def cut_places(places: list[int], costs: list[int], limit: int = LIMIT) -> list[int]:
    """Cheapest cuts of the stream ``0 .. places[-1]``; neighbours in ``places`` are at most ``limit`` apart.

    ``places`` are the possible cuts in order, ``costs`` what each breaks.  A
    sequence from ``a`` to ``b`` costs ``limit - (b - a)`` plus the cost of ``b``.
    """
    place, price = [0, *places], [0, *costs]
    total = [0] * len(place)  # cheapest cost up to the place, plus the place
    back = [0] * len(place)
    queue, head = [0], 0  # predecessors in range, by rising total
    for j in range(1, len(place)):
        least = place[j] - limit
        while place[queue[head]] < least:
            head += 1
        i = queue[head]
        back[j] = i
        own = total[j] = total[i] + limit + price[j]
        while len(queue) > head and total[queue[-1]] > own:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(place) - 1
    while j:
        cuts.append(place[j])
        j = back[j]
    return cuts[::-1]


def possible_cuts(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray) -> tuple[list[int], list[int]]:
    """Places and costs of cuts in a stretch of ids."""
    cost = np.full(len(ids) + 1, -1, dtype=np.int64)
    cost[GRID::GRID] = INSIDE_COST
    cost[np.flatnonzero(ends_sentence[ids]) + 1] = SENTENCE_COST
    cost[doc_ends] = 0
    cost[len(ids)] = 0
    places = np.flatnonzero(cost >= 0)
    places = places[places > 0]
    return places.tolist(), cost[places].tolist()


def sentence_ends(path: str) -> np.ndarray:
    """Which ids of the vocabulary end a sentence or a line."""
    words = encoder(path).tokenizer.get_vocab()
    ends = np.zeros(max(words.values()) + 1, dtype=bool)
    for word, i in words.items():
        ends[i] = word[-1] in ".!?" or word == "Ċ"  # the last is how a line feed is written
    return ends


class Packer:
    """Packs one partition's stream of documents, stretch by stretch."""

    def __init__(self, part: int, ends_sentence: np.ndarray, limit: int):
        self.sequence, self.ends_sentence, self.limit = part << 40, ends_sentence, limit
        self.held: list[tuple] = []  # (doc_id, ids before it, ids, all ids of the document)
        self.size = 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.held.append((doc_id, 0, ids, len(ids)))
        self.size += len(ids)

    def pack(self, last: bool) -> list[tuple]:
        """Pieces of the sequences that are settled; the rest stays for the next stretch."""
        if not self.held:
            return []
        ids = np.concatenate([h[2] for h in self.held])
        lengths = np.array([len(h[2]) for h in self.held])
        begins = np.cumsum(lengths) - lengths
        cuts = cut_places(*possible_cuts(ids, begins + lengths, self.ends_sentence), self.limit)
        if not last:
            cuts = cuts[:-REPLANNED]
        pieces, k, at = [], 0, 0
        for cut in cuts:
            begin = at
            while at < cut:
                doc_id, before, own, whole = self.held[k]
                first = at - int(begins[k])
                stop = min(cut - int(begins[k]), len(own))
                pieces.append((doc_id, before + first, stop - first, zlib.crc32(own[first:stop]), whole,
                               self.sequence, at - begin))
                at += stop - first
                k += stop == len(own)
            self.sequence += 1
        rest = self.held[k:]
        if rest and at > begins[k]:
            doc_id, before, own, whole = rest[0]
            done = at - int(begins[k])
            rest[0] = (doc_id, before + done, own[done:], whole)
        self.held, self.size = rest, int(len(ids)) - at
        return pieces


def pack_documents(docs: DataFrame, limit: int = LIMIT, end_id: int = END_ID,
                   vocabulary: str | None = None) -> DataFrame:
    """One row per piece of a document in a sequence, with the digest of its ids."""
    vocabulary = vocabulary or vocabulary_path()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = [c.split()[0] for c in PIECES.split(", ")]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        packer = Packer(TaskContext.get().partitionId(), sentence_ends(vocabulary), limit)
        arrow_id = None

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], arrow_id), *(pa.array(c, pa.int64()) for c in columns[1:])], names=names)

        for batch in byte_slices(batches, "text", ROUND_BYTES):
            arrow_id = batch.schema.field("doc_id").type
            ids, edges = words.encode(batch.column("text"), end_id)
            for doc_id, begin, stop in zip(batch.column("doc_id").to_pylist(), edges, edges[1:]):
                packer.add(doc_id, ids[begin:stop])
                if packer.size >= STRETCH and (pieces := packer.pack(last=False)):
                    yield rows(pieces)
        if pieces := packer.pack(last=True):
            yield rows(pieces)
        words.shrink()

    return in_order(docs).mapInArrow(packed, PIECES.format(id=id_type))
