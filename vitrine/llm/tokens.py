"""Token ids of whole documents as Parquet list columns, with selective reads.

``write_tokens`` encodes texts and writes one row per document, ordered by
``doc_id`` over all files: metadata columns, the number of tokens, and the ids
as a list column.  Ids are dictionary coded (a vocabulary below 2^16 takes two
bytes an id) and fall back to delta coding where a dictionary grows too large.
Row groups and pages are small enough that a reader of few documents, or of
metadata alone, skips most bytes through the column and page indexes.

Null and empty texts have no ids but the end id.  Rows with the same ``doc_id``
are kept, ordered by a hash of their text; rows with a null id come first.
Extra columns are not written unless asked for.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine.llm.common import byte_slices, plain_text, starts_by_part
from vitrine.sources.scratch import new_path

VOCABULARY = "byte_bpe_50k.json"

#: Distinct words whose ids an encoder remembers within a task; beyond that it goes on with the more used half.
#: What it keeps from one task of a worker to the next.  Both bound memory, not results.
WORDS_HELD, WORDS_KEPT = 600_000, 200_000

#: Bytes of text that one round of encoding holds.
ROUND_BYTES = 4 << 20

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 500


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids by the tokenizers library, with each distinct word encoded once.

    The byte-level pre-tokenizer always starts a new piece at a space or line
    feed that precedes a character other than white space, and at a punctuation
    mark other than the apostrophe that follows a letter.  So the ids of a text
    are the ids of the words between these places one after the other.  The
    distinct words of a round that the encoder has not met are encoded together
    as one text, whose ids are cut where the bytes of the words end.  Texts with
    rarer white space or with the string of an added token are encoded whole.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        words = self.tokenizer.get_vocab()
        # a byte-level piece has one character for each of its bytes
        self.bytes_of = np.zeros(max(words.values()) + 1, dtype=np.int64)
        for word, i in words.items():
            self.bytes_of[i] = len(word)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.unsplit = "|".join([_RARE_WHITE, *added])
        self._keep([], np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64))

    def _keep(self, words: list[str], ids: np.ndarray, edges: np.ndarray, used: np.ndarray) -> None:
        """Remember exactly these words; those of entry ``i`` have the ids between two edges."""
        self.known = dict(zip(words, range(len(words))))
        self.ids, self.edges, self.used = ids, edges, used

    def shrink(self, most: int = WORDS_KEPT) -> None:
        """Forget all but about ``most`` of the words that were used most."""
        if len(self.known) <= most:
            return
        kept = np.sort(np.argpartition(-self.used, most - 1)[:most]) if most else np.zeros(0, dtype=np.int64)
        words = list(self.known)  # in the order of their entries
        ids, edges = _gathered(self.ids, self.edges, kept)
        self._keep([words[i] for i in kept], ids, edges, self.used[kept] // 2)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def _learn(self, words: list[str], sizes: np.ndarray) -> None:
        """Ids of words; those that begin with a mark are encoded behind a letter, as they stand in texts."""
        behind = np.array([w[0] not in " \n" for w in words])
        ids = self._whole(["".join([" a" + w if b else w for w, b in zip(words, behind)])])[0]
        stops = np.cumsum(sizes + 2 * behind)
        begins = stops - sizes
        ends = np.concatenate([[0], np.cumsum(self.bytes_of[ids])])
        first, last = np.searchsorted(ends, begins), np.searchsorted(ends, stops)
        if not (np.array_equal(ends[first], begins) and np.array_equal(ends[last], stops)):
            raise ValueError("this vocabulary does not start a piece where words begin")
        edges = np.concatenate([[0], np.cumsum(last - first)])
        ids = ids[np.repeat(first - edges[:-1], last - first) + np.arange(edges[-1])]
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.edges = np.concatenate([self.edges, self.edges[-1] + edges[1:]])
        self.ids = np.concatenate([self.ids, ids])
        self.used = np.concatenate([self.used, np.zeros(len(words), dtype=np.int64)])

    def _entries(self, words: pa.StringArray) -> np.ndarray:
        """Places of the words among those known; new ones are learned."""
        texts = words.to_numpy(zero_copy_only=False).tolist()
        at = np.fromiter(map(self.known.get, texts, repeat(-1)), dtype=np.int64, count=len(texts))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = np.arange(len(new)) + len(self.known)
            self._learn([texts[i] for i in new], pc.binary_length(words).to_numpy()[new])
        return at

    def encode(self, texts: pa.StringArray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each begins and the last ends."""
        if len(self.known) > WORDS_HELD:
            self.shrink(WORDS_HELD // 2)
        n = len(texts)
        whole = pc.match_substring_regex(texts, self.unsplit).to_numpy(zero_copy_only=False)
        words, begins = _words(texts, whole)
        # the first word of a text has nothing before it; it and whole texts are encoded by themselves
        own = self._whole(words.take(pa.array(begins[:-1])).to_pylist())
        rest = np.ones(len(words), dtype=bool)
        rest[begins[:-1]] = False
        coded = words.filter(pa.array(rest)).dictionary_encode()
        entries = self._entries(coded.dictionary)
        code = coded.indices.to_numpy()
        self.used[entries] += np.bincount(code, minlength=len(entries))

        # one list of pieces over all texts: what is known, the texts' own beginnings, the end id
        last = [np.array([] if end_id is None else [end_id], dtype=np.uint32)]
        ids = np.concatenate([self.ids, *own, *last])
        known = len(self.edges) - 1
        bounds = np.concatenate([self.edges, self.edges[-1] + np.cumsum([len(x) for x in own + last])])
        pieces = np.empty(len(words), dtype=np.int64)
        pieces[begins[:-1]], pieces[rest] = known + np.arange(n), entries[code]
        pieces = np.insert(pieces, begins[1:], known + n)
        found, at = _gathered(ids, bounds, pieces)
        return found, at[begins + np.arange(n + 1)]


#: White space other than space, tab, line feed and carriage return.
_RARE_WHITE = r"[\x0b\x0c\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_IS_WHITE, _IS_MARK, _IS_LETTER = (np.zeros(256, dtype=bool) for _ in range(3))
_IS_WHITE[list(b" \t\n\r")] = True
_IS_MARK[[i for i in range(33, 127) if not chr(i).isalnum() and chr(i) != "'"]] = True
_IS_LETTER[[i for i in range(128) if chr(i).isalpha()]] = True


def _words(texts: pa.StringArray, whole: np.ndarray) -> tuple[pa.StringArray, np.ndarray]:
    """Words of all texts, and the place of each text's first one, at least one a text; ``whole`` texts are one word."""
    sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer("".join(texts.to_pylist()).encode(), dtype=np.uint8)
    # the byte after and the two before; what they are beyond a text's ends does not matter, as its begin is an edge
    after = np.append(data[1:], 32)
    before, earlier = np.concatenate([[32], data[:-1]]), np.concatenate([[32, 32], data[:-2]])[:len(data)]
    cut = ((data == 32) | (data == 10)) & ~_IS_WHITE[after]
    letter = _IS_LETTER[before] | ((earlier == 0xC3) & (before != 0x97) & (before != 0xB7))
    cut |= _IS_MARK[data] & letter
    ends = edges[1:][sizes > 0] - 1
    cut[ends] &= ~((data[ends] == 32) | (data[ends] == 10))  # white space at the end of a text begins no word
    cut[edges[:-1][sizes > 0]] = False
    for i in np.flatnonzero(whole):
        cut[edges[i]:edges[i + 1]] = False
    inner = np.flatnonzero(cut)
    # each text has a first word, empty where a space or line feed begins the next one at once
    led = np.zeros(len(texts), dtype=bool)
    some = np.flatnonzero((sizes > 1) & ~whole)
    led[some] = np.isin(data[edges[some]], (32, 10)) & ~_IS_WHITE[data[edges[some] + 1]]
    text_of = np.searchsorted(edges, inner, side="right") - 1
    counts = 1 + led + np.bincount(text_of, minlength=len(texts))
    begins = np.concatenate([[0], np.cumsum(counts)])
    starts = np.repeat(edges[:-1], counts)
    starts[np.arange(len(inner)) + np.cumsum(1 + led)[text_of]] = inner
    offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
    return pa.StringArray.from_buffers(len(starts), offsets, pa.py_buffer(data)), begins


def _gathered(ids: np.ndarray, edges: np.ndarray, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the pieces one after the other, and their edges there."""
    sizes = (edges[1:] - edges[:-1])[pieces]
    after = np.concatenate([[0], np.cumsum(sizes)])
    return ids[np.repeat(edges[pieces] - after[:-1], sizes) + np.arange(after[-1])], after


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def in_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` dealt out by ranges of ``doc_id`` and sorted."""
    rows = docs.select("doc_id", plain_text().alias("text"))
    keys = ("doc_id", F.xxhash64("text"))  # the hash splits and orders rows of one id
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_tokens(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 0) -> None:
    """Write ``doc_id, part, start_in_part, n_tokens, ids`` of all documents in ascending ``doc_id`` order."""
    vocabulary = vocabulary or vocabulary_path()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, words = TaskContext.get().partitionId(), 0, encoder(vocabulary)
        for batch in byte_slices(batches, "text", ROUND_BYTES):
            ids, edges = words.encode(batch.column("text"), end_id)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.full(batch.num_rows, part, dtype=np.int32)),
                pa.array(start + edges[:-1]), pa.array(np.diff(edges)),
                pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids.view(np.int32))),
            ], names=["doc_id", "part", "start_in_part", "n_tokens", "ids"])
            start += int(edges[-1])
        words.shrink()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    (in_order(docs)
     .mapInArrow(encoded, f"doc_id {id_type}, part int, start_in_part bigint, n_tokens bigint, ids array<int>")
     .write.option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "true")
     .option("parquet.dictionary.page.size", str(1 << 20)).option("parquet.block.size", str(ROW_GROUP_BYTES))
     .option("parquet.page.size", str(PAGE_BYTES)).option("parquet.page.row.count.limit", str(PAGE_ROWS))
     .parquet(path))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` without reading an id; ``start`` counts the ids of all documents before."""
    rows = spark.read.parquet(path).drop("ids")
    parts = starts_by_part(rows.groupBy("part").agg(F.sum("n_tokens").alias("held")), "part", "held", "before")
    return rows.join(parts, "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids`` of the documents from ``first`` to ``last``; files, row groups and pages outside are skipped."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return rows.select("doc_id", "n_tokens", "ids")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of all documents, from the written ids."""
    rows = spark.read.parquet(path)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")
            offsets = lists.offsets.to_pylist()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets, offsets[1:])]
            n = pa.array(np.diff(np.array(offsets, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("start_in_part"), n,
                 pa.array(crc, pa.int64())], names=["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    read = rows.select("doc_id", "part", "start_in_part", "ids").mapInArrow(
        digests, f"doc_id {id_type}, part int, start_in_part bigint, n_tokens bigint, ids_crc32 bigint")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    parts = starts_by_part(totals, "part", "held", "before")
    return read.join(parts, "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")


def tokens_round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write all documents below the shared folder and give the digests of what the files hold."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary)
    return token_digests(docs.sparkSession, path)
