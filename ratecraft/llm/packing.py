"""Packing by shortest-pack-first over the length histogram.

1. Tasks tokenise whole texts and cut a document longer than a sequence into
   full sequences and a rest.  Each piece gets its number among the pieces of
   its length in its task; that is written with the piece, so its identity
   survives retries.
2. The histogram of lengths (one row per length, at most ``max_tokens``) goes to
   the driver.  Lengths are placed longest first into the shortest open pack
   that they fit; only counts of packing patterns are updated, so the work
   depends on the number of lengths, not of documents.
3. Pieces meet patterns by rank: task offsets turn a piece's number into its
   rank among all pieces of its length, and a rank falls into one slot of one
   pattern.

Defined cases: a NULL or empty text is the end token alone; a NULL doc_id is
kept; repeated rows are packed each; strings of special tokens in a text are
ordinary text; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecraft.llm.arrow_text import ragged, slices
from ratecraft.llm.common import materialise, tokenizer_path

MAX_TOKENS = 2048
END = 1
VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 200_000     # per task

RUN = 4 << 20              # bytes of text tokenised at a time

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"
_PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordTokenizer:
    """Token ids of texts, by way of their words.

    The tokenizer lower-cases and its pieces never span white space nor the
    border between a plain letter and punctuation, so a text's ids are those of its
    words in turn and each distinct word is encoded once.  Only the letters a to z
    make a border: others may turn into a letter and a mark (the capital I with a
    dot when it is lower-cased, some letters when they are composed), and a mark
    belongs to the punctuation after it.  A vocabulary without these properties is
    refused.
    """

    BORDER = (r"([a-z])([.,;:!?#$%&*]+)(\s|$)", r"\1 \2\3")
    PROBES = ("Ab, b. c!? D;", "a \u00a0 b\t\n c", "it's, we'll.", "x1. y,2 z:", "\u0130. e\u0301, \u00e9. \u0958, q&", "ab cd abcd  ab")
    MARK = "|"       # between words that are encoded together; a token of its own
    TOGETHER = 1000

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        self.cached = cached
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        mark = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        self.mark = mark[0]
        self._forget()
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        for probe in (*self.PROBES, f"ab {self.MARK} cd"):
            words = self._words(pa.array([probe])).flatten().to_pylist()
            if len(mark) != 1 or [i for w in words for i in ids(w)] != ids(probe):
                raise ValueError(f"{path}: not a lower-casing vocabulary of words")

    def _words(self, texts: pa.Array) -> pa.Array:
        return pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts, "")), *self.BORDER))

    def _forget(self):
        self.words, self.ids, self.ends = pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, words: pa.Array) -> None:
        marked = np.asarray(pc.match_substring(words, self.MARK)).astype(bool)
        alone, rest = words.filter(pa.array(marked)).to_pylist(), words.filter(pa.array(~marked))
        texts = rest.to_pylist()
        joined = [f" {self.MARK} ".join([*texts[i:i + self.TOGETHER], ""]) for i in range(0, len(texts), self.TOGETHER)]
        codes = [np.array(c.ids, np.uint32) for c in self.tokenizer.encode_batch(joined + alone, add_special_tokens=False)]
        together = np.concatenate([np.zeros(0, np.uint32), *codes[:len(joined)]])
        marks = together == self.mark
        ends = np.cumsum(~marks)[marks]
        own = [len(c) for c in codes[len(joined):]]
        last = int(ends[-1]) if len(ends) else 0
        self.words = pa.concat_arrays([self.words, rest, pa.array(alone, pa.string())])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends, self.ends[-1] + last + np.cumsum(own, dtype=np.int64)])
        self.ids = np.concatenate([self.ids, together[~marks], *codes[len(joined):]])

    def __call__(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by ``end``; their offsets)."""
        words = self._words(texts)
        coded = words.flatten().dictionary_encode()
        if len(self.words) > self.cached:
            self._forget()
        new = coded.dictionary.filter(pc.is_null(pc.index_in(coded.dictionary, value_set=self.words)))
        if len(new):
            self._learn(new)
        known = np.asarray(pc.index_in(coded.dictionary, value_set=self.words)).astype(np.int64)
        # the end token is a word after the last
        starts, sizes = np.append(self.ends[:-1], len(self.ids)), np.append(np.diff(self.ends), 1)
        counts = np.asarray(pc.list_value_length(words)).astype(np.int64)
        which = np.insert(known[np.asarray(coded.indices)], np.cumsum(counts), len(self.words))
        lengths = sizes[which]
        ids = np.append(self.ids, np.uint32(end))[ragged(starts[which], lengths)]
        return ids, np.concatenate([[0], np.cumsum(lengths)[np.cumsum(counts + 1) - 1]])


def pieces(docs: DataFrame, path: str | None = None, max_tokens: int = MAX_TOKENS, end: int = END,
           run_bytes: int = RUN, cached: int = CACHED_WORDS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, part, nth): the pieces of all documents."""
    path = path or tokenizer_path(VOCABULARY)

    def cut(batches):
        encode, seen, part = WordTokenizer(path, cached), defaultdict(int), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for run in slices(batch, "text", run_bytes):
                ids, ends = encode(run.column("text"), end)
                for doc_id, a, b in zip(run.column("doc_id").to_pylist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                    for first in range(a, b, max_tokens):
                        size = min(max_tokens, b - first)
                        rows.append((doc_id, first - a, size, zlib.crc32(ids[first:first + size].tobytes()), b - a, part, seen[size]))
                        seen[size] += 1
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        # the worker goes on to other tasks
        del encode
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, _PIECES)


def patterns(histogram: dict[int, int], size: int = MAX_TOKENS) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) of every slot, from {length: pieces}.

    Open packs are grouped by their room; a group is (lengths so far, count).
    """
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, groups in open_packs.items() if groups), default=0)
            if room < length:
                # no open pack takes it: new packs, each with as many as fit
                fits = size // length
                whole, rest = divmod(left, fits)
                if whole:
                    open_packs[size - fits * length].append(((length,) * fits, whole))
                if rest:
                    open_packs[size - rest * length].append(((length,) * rest, 1))
                break
            lengths, count = open_packs[room].pop()
            used = min(count, left)
            if used < count:
                open_packs[room].append((lengths, count - used))
            open_packs[room - length].append((lengths + (length,), used))
            left -= used
    slots, ranks, sequence = [], defaultdict(int), 0
    for room in sorted(open_packs):
        for lengths, count in open_packs[room]:
            offset = 0
            for length in lengths:
                slots.append((length, ranks[length], ranks[length] + count, sequence, offset))
                ranks[length] += count
                offset += length
            sequence += count
    return slots


def pack(docs: DataFrame, path: str | None = None, max_tokens: int = MAX_TOKENS, end: int = END,
         run_bytes: int = RUN, cached: int = CACHED_WORDS) -> DataFrame:
    """The pieces of all documents with their sequence and offset.

    ``run_bytes`` of text are tokenised at a time and ``cached`` words kept: less memory, more time."""
    cut = materialise(pieces(docs, path, max_tokens, end, run_bytes, cached), "pack-pieces")
    counts = materialise(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "pack-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}   # at most max_tokens rows
    slots = np.array(sorted(patterns(histogram, max_tokens)), np.int64).reshape(-1, 5)
    # one sorted key for (length, rank): ranks stay under 2^48
    keys = (slots[:, 0] << 48) + slots[:, 1]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["part", "length"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("nth")).alias("rank"))

    def place(batches):
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            slot = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(slots[slot, 3] + rank - slots[slot, 1]), pa.array(slots[slot, 4])],
                [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, _PACKED)
