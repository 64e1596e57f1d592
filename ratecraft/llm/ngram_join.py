"""N-gram Jaccard join by T-occurrence search with DivideSkip.

Two documents link when ``100 * |x & y| >= percent * |x | y|`` on their sets of
distinct word shingles.

1. Documents with equal sets form a class, represented by its smallest doc_id.
2. A fixed-size table counts shingles by hash bucket over all documents.  It
   orders shingles from rare to frequent; the order only steers the work.
3. If two sets link, the first ``n - ceil(percent * n / 100) + 1`` shingles of
   each (in that order) share one.  Those shingles are dealt out by hash; all
   classes that hold one and are near enough in size make a group, and a group
   belongs to its smallest class, its hub.  Two classes that link are thus
   together in some hub's block.
   Only texts of such classes are shuffled: a bit table of fixed size lets the
   others pass by.
4. In a block, every class looks up the inverted lists of its shingles: short
   lists are merged, long ones probed by binary search for the candidates that
   can still reach the required overlap (DivideSkip).  The counts are the exact
   overlaps.  Classes already connected need no lookup of their own.
5. A block larger than ``max_block`` is dealt out in slices, each with the hub.
   What is then not connected to the hub is looked up against every slice.

Components come from the links of all blocks.

Defined cases: NULL, empty and white-space texts have no shingles and link with
nothing; rows with a NULL doc_id keep a row of their own with a NULL component;
repeated rows are one class; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.arrow_text import slices
from ratecraft.llm.common import materialise, parallelism
from ratecraft.llm.components import components
from ratecraft.llm.shingles import mixed, shingle_sets

WORDS = 3
PERCENT = 90
MAX_BLOCK = 512          # classes looked up in one task besides the hub and those asked for
COUNT_BITS = 21          # the count table has 2^21 entries, 8 MB, whatever the input
HOT_SHINGLE = 1000       # and four times the mean: bucket counts from which a shingle's group may be large
ID_BITS = 23             # the bit table of ids has 2^23 bits, 1 MB
_CHUNK = 1 << 12
_PROBES = 1 << 14        # binary searches done together
_RUN = 1 << 20           # bytes of text worked on at a time


def overlap_needed(n: np.ndarray | int, m: np.ndarray | int, percent: int):
    """Least overlap with which sets of n and m shingles link."""
    return -((-percent * (n + m)) // (100 + percent))


def bucket_counts(docs: DataFrame, words: int) -> np.ndarray:
    """Shingles by hash bucket over all documents: 2^COUNT_BITS numbers, whatever the input."""
    def count(batches):
        counts = np.zeros(1 << COUNT_BITS, np.int32)
        for batch in batches:
            for run in slices(batch, "text", _RUN):
                found = np.concatenate([np.zeros(0, np.uint64), *shingle_sets(run.column("text"), words)])
                counts += np.bincount(_bucket(found), minlength=len(counts)).astype(np.int32)
        chunks = [zlib.compress(c.tobytes(), 1) for c in counts.reshape(-1, _CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.binary())], ["chunk", "counts"])

    def add(key, part):
        total = np.zeros(_CHUNK, np.int64)
        for c in part.column("counts"):
            total += np.frombuffer(zlib.decompress(c.as_py()), np.int32)
        packed = zlib.compress(np.minimum(total, (1 << 31) - 1).astype(np.int32).tobytes(), 1)
        return pa.table({"chunk": [key[0].as_py()], "counts": [packed]}, schema=pa.schema([("chunk", pa.int32()), ("counts", pa.binary())]))

    table = np.zeros(1 << COUNT_BITS, np.int32)
    sums = docs.select("text").mapInArrow(count, "chunk int, counts binary").groupBy("chunk").applyInArrow(add, "chunk int, counts binary")
    for chunk, counts in sums.collect():
        table[chunk * _CHUNK:(chunk + 1) * _CHUNK] = np.frombuffer(zlib.decompress(counts), np.int32)
    return table


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def prefixes(docs: DataFrame, counts, words: int, percent: int) -> DataFrame:
    """(id, n, d1, d2, rare, often) of every row: its set's size and digest, and its first shingles.

    The first shingles are the rarest by bucket count, as many as make linked
    sets share one.  They stand in ``rare``, or in ``often`` if their bucket holds
    so many that a group of documents with one of them might be large.
    """
    limit = HOT_SHINGLE + 4 * float(counts.value.mean())

    def first(batches):
        for batch in batches:
            for run in slices(batch, "text", _RUN):
                out = [[] for _ in range(5)]
                for s in shingle_sets(run.column("text"), words):
                    n = len(s)
                    held = counts.value[_bucket(s)]
                    chosen = np.argsort(held, kind="stable")[:n - -(-percent * n // 100) + 1 if n else 0]
                    hot = held[chosen] > limit
                    values = s.view(np.int64)
                    digest = (int(values.sum()), int(mixed(s).view(np.int64).sum())) if n else (0, 0)
                    for o, v in zip(out, (n, *digest, values[chosen[~hot]], values[chosen[hot]]), strict=True):
                        o.append(v)
                kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
                yield pa.RecordBatch.from_arrays([run.column("doc_id"), *(pa.array(o, k) for o, k in zip(out, kinds, strict=True))],
                                                 ["id", "n", "d1", "d2", "rare", "often"])

    return docs.select("doc_id", "text").mapInArrow(first, "id long, n long, d1 long, d2 long, rare array<long>, often array<long>")


class Block:
    """Inverted lists over the sets of a block, and the classes' components so far."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.sizes = sets, np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")          # so each list is in order of its members
        self.owner, flat = owner[order], flat[order]
        self.keys, self.first = np.unique(flat, return_index=True)
        self.stop = np.append(self.first[1:], len(flat))
        self.pairs = np.repeat(np.arange(len(self.keys)), self.stop - self.first) * len(sets) + self.owner
        self.root = np.arange(len(sets))

    def search(self, q: int, percent: int) -> np.ndarray:
        """The members that link with member q (T-occurrence search, DivideSkip)."""
        n = int(self.sizes[q])
        need = -(-percent * n // 100)                    # least overlap with any partner
        lists = np.searchsorted(self.keys, self.sets[q])
        lengths = self.stop[lists] - self.first[lists]
        longest = int(lengths.max())
        # DivideSkip: so many of the longest lists are probed, the rest merged
        long = min(need - 1, int(need / (0.02 * math.log2(longest) + 1))) if longest > 1 else 0
        if long > 0:
            cut = np.argpartition(lengths, len(lengths) - long)
            short, probed = lists[cut[:-long]], lists[cut[-long:]]
        else:
            short, probed = lists, lists[:0]
        candidates, found = self._merge(short)
        enough = found >= need - len(probed)
        candidates, found = candidates[enough], found[enough]
        required = overlap_needed(n, self.sizes[candidates], percent)
        at = 0
        while at < len(probed) and len(candidates):
            # a member is looked up in a list by its place among all (list, member) pairs
            some = probed[at:at + max(1, _PROBES // len(candidates))]
            at += len(some)
            wanted = some[:, None] * len(self.sets) + candidates
            spot = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
            found = found + (self.pairs[spot] == wanted).sum(axis=0)
            alive = found + (len(probed) - at) >= required
            candidates, found, required = candidates[alive], found[alive], required[alive]
        return candidates[(found >= required) & (candidates != q)]

    def _merge(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(members, occurrences) over some lists."""
        if not len(lists):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(lists) <= 8:
            members = np.fromiter(heapq.merge(*(self.owner[self.first[i]:self.stop[i]].tolist() for i in lists)), np.int64)
        else:
            members = np.sort(np.concatenate([self.owner[self.first[i]:self.stop[i]] for i in lists]))
        return np.unique(members, return_counts=True)

    def join(self, q: int, others: np.ndarray) -> None:
        roots = np.unique(np.append(self.root[others], self.root[q]))
        self.root[np.isin(self.root, roots)] = roots[0]


def linked_components(sets: list[np.ndarray], percent: int, asked: list[int] | None = None) -> np.ndarray:
    """A label per member; equal for members that links inside the block connect.

    Without ``asked``, all members are looked up but those of the largest
    component: their links to others are found from the others' side.
    """
    block = Block(sets)
    if asked is not None:
        for q in asked:
            block.join(q, block.search(q, percent))
        return block.root
    done = np.zeros(len(sets), bool)
    while True:
        labels, sizes = np.unique(block.root, return_counts=True)
        open_ = np.flatnonzero(~done & (block.root != labels[sizes.argmax()]))
        if not len(open_) and not done.any():
            open_ = np.arange(1)
        if not len(open_):
            return block.root
        q = int(open_[0])
        block.join(q, block.search(q, percent))
        done[q] = True


def block_links(blocks: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b) links that connect what a block connects, from (block, id, body, asked).

    Members that are ``asked`` are looked up against the whole block; a block
    where none is looks all up.
    """
    def links(ids, sets, asked):
        if len(set(ids)) < 2:
            return
        root = linked_components(sets, percent, np.flatnonzero(asked).tolist() or None)
        least: dict[int, int] = {}
        for i, r in sorted(zip(ids, root.tolist(), strict=True)):
            if least.setdefault(r, i) != i:
                yield least[r], i

    def solve(batches):
        current, ids, sets, asked = None, [], [], []     # the block being read
        for batch in batches:
            found = []
            for run in slices(batch, "body", _RUN // 4):
                texts = pa.array([zlib.decompress(b.as_py()).decode() for b in run.column("body")], pa.string())
                keys, members, flags = (run.column(c).to_pylist() for c in ("block", "id", "asked"))
                for key, i, s, flag in zip(keys, members, shingle_sets(texts, words), flags, strict=True):
                    if key != current:
                        found += links(ids, sets, asked)
                        current, ids, sets, asked = key, [], [], []
                    ids.append(i)
                    sets.append(s)
                    asked.append(flag)
            yield _pairs(found)
        yield _pairs(list(links(ids, sets, asked)))

    dealt = blocks.repartition(parallelism(blocks.sparkSession), "block").sortWithinPartitions("block")
    return dealt.select("block", "id", "body", "asked").mapInArrow(solve, "a long, b long")


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def hub_pairs(reps: DataFrame, percent: int) -> DataFrame:
    """(hub, id): the classes of each hub's block, from (id, n, rare, often).

    Sets whose sizes are too far apart cannot link, so the classes with one
    shingle fall into groups by size, each with a hub of its own."""
    def grouped(shingle, n, ids):
        """Pairs from rows by shingle and size: a gap in the sizes parts two groups."""
        starts = np.flatnonzero(np.r_[True, (shingle[1:] != shingle[:-1]) | (100 * n[:-1] < percent * n[1:])])
        hubs = np.repeat(np.minimum.reduceat(ids, starts), np.diff(np.r_[starts, len(ids)]))
        return np.unique(np.stack([hubs, ids], axis=1)[hubs != ids], axis=0), int(starts[-1])

    def runs(batches):
        held = None
        for batch in batches:
            rows = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("shingle", "n", "id")])
            rows = rows if held is None else np.concatenate([held, rows], axis=1)
            if not rows.shape[1]:
                continue
            # the last group may go on in the next batch
            pairs, last = grouped(*rows)
            held = rows[:, last:]
            if last:
                pairs, _ = grouped(*rows[:, :last])
                yield _pairs_batch(pairs)
        if held is not None:
            yield _pairs_batch(grouped(*held)[0])

    def _pairs_batch(pairs):
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["hub", "id"])

    parts = parallelism(reps.sparkSession)
    rare = (reps.select(F.explode("rare").alias("shingle"), "n", "id").repartition(parts, "shingle")
            .sortWithinPartitions("shingle", "n").mapInArrow(runs, "hub long, id long"))
    # a shingle that many classes may hold: sizes in steps that linked sets differ by one of at
    # most, hubs by aggregation, then a join that can be split between tasks
    step = F.floor(F.log(F.col("n").cast("double")) / (-1.0001 * math.log(percent / 100)) if percent < 100 else F.col("n"))
    often = (reps.select(F.explode("often").alias("shingle"), F.array(step, step + 1).alias("steps"), "id")
             .select("shingle", F.explode("steps").alias("step"), "id"))
    hubs = materialise(often.groupBy("shingle", "step").agg(F.min("id").alias("hub"), F.max("id").alias("last"))
                       .where("hub <> last").select("shingle", "step", "hub"), "join-hubs")
    often = often.join(hubs, ["shingle", "step"]).where("hub <> id").select("hub", "id")
    return materialise(rare.unionByName(often).distinct(), "join-pairs")


def blocks_of(pairs: DataFrame, max_block: int) -> DataFrame:
    """(hub, id, slices, slice): every hub's block, itself included, in slices of about ``max_block``."""
    sizes = materialise(pairs.groupBy("hub").agg(F.count("*").alias("size")), "join-sizes")
    n = F.ceil((F.col("size") + 1) / max_block).cast("long")
    members = pairs.join(sizes, "hub").unionByName(sizes.select("hub", F.col("hub").alias("id"), "size"))
    return members.select("hub", "id", n.alias("slices")).withColumn("slice", F.pmod(F.xxhash64("id"), "slices"))


def id_bits(ids: DataFrame) -> np.ndarray:
    """A bit table of the hashes of ids: 2^ID_BITS bits, whatever the input.

    It lets most other documents pass by before a join; more ids make it less
    selective, never wrong."""
    def mark(batches):
        bits = np.zeros(1 << ID_BITS, bool)
        for batch in batches:
            bits[_id_bit(np.asarray(batch.column("id")))] = True
        packed = np.packbits(bits).reshape(-1, _CHUNK)
        some = np.flatnonzero(packed.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([zlib.compress(packed[k].tobytes(), 1) for k in some], pa.binary())],
                                         ["chunk", "bits"])

    def unite(key, part):
        total = np.zeros(_CHUNK, np.uint8)
        for c in part.column("bits"):
            total |= np.frombuffer(zlib.decompress(c.as_py()), np.uint8)
        return pa.table({"chunk": [key[0].as_py()], "bits": [zlib.compress(total.tobytes(), 1)]}, schema=pa.schema([("chunk", pa.int32()), ("bits", pa.binary())]))

    packed = np.zeros(((1 << ID_BITS) // 8 // _CHUNK, _CHUNK), np.uint8)
    for chunk, bits in ids.select("id").mapInArrow(mark, "chunk int, bits binary").groupBy("chunk").applyInArrow(unite, "chunk int, bits binary").collect():
        packed[chunk] = np.frombuffer(zlib.decompress(bits), np.uint8)
    return packed.ravel()


def _id_bit(ids: np.ndarray) -> np.ndarray:
    return (mixed(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - ID_BITS)).astype(np.int64)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, body) of the documents whose ids may be among ``ids``; body is the packed text.

    Texts are shuffled twice, by id and by block, so packing them once saves
    more than the shuffle's own compression of single rows."""
    table = docs.sparkSession.sparkContext.broadcast(id_bits(ids))

    def keep(batches):
        for batch in batches:
            at = _id_bit(np.asarray(batch.column("id")))
            some = batch.filter(pa.array((table.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1))
            bodies = [zlib.compress((t.as_py() or "").encode(), 5) for t in some.column("text")]
            yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(bodies, pa.binary())], ["id", "body"])

    return docs.select(F.col("doc_id").alias("id"), "text").mapInArrow(keep, "id long, body binary")


def jaccard_labels(docs: DataFrame, reps: DataFrame, words: int, percent: int, max_block: int) -> DataFrame:
    """(node, component) of the classes that link with another one."""
    dealt = materialise(blocks_of(hub_pairs(reps, percent), max_block), "join-blocks")

    def solve(rows: DataFrame, name: str) -> DataFrame:
        """rows: (block, id, asked)."""
        # the same plan at every size
        with_text = texts_of(docs, rows).join(rows.hint("merge"), "id")
        return materialise(block_links(with_text, words, percent), name)

    # every slice has the hub
    everywhere = F.when(F.col("id") == F.col("hub"), F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).otherwise(F.array("slice"))
    first = dealt.select("hub", "id", F.explode(everywhere).alias("slice"))
    links = solve(first.select(F.xxhash64("hub", "slice").alias("block"), "id", F.lit(False).alias("asked")), "join-links")

    # what a sliced block has left unconnected to its hub meets every slice
    labels = materialise(components(links), "join-components")
    sliced = dealt.where("slices > 1")
    outside = (sliced.join(labels.withColumnRenamed("node", "id"), "id", "left")
               .join(labels.select(F.col("node").alias("hub"), F.col("component").alias("of_hub")), "hub", "left")
               .where("component is null or of_hub is null or component <> of_hub").select("hub", "id", "slices"))
    outside = materialise(outside.where("id <> hub"), "join-outside")
    if not outside.isEmpty():
        left = materialise(outside.groupBy("hub").agg(F.ceil(F.count("*") / max_block).cast("long").alias("chunks")), "join-chunks")
        numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        asked = outside.join(left, "hub").select(
            "hub", "id", numbers("slices").alias("slice"), F.pmod(F.xxhash64("id"), "chunks").alias("chunk"), F.lit(True).alias("asked"))
        rest = sliced.join(left, "hub").select("hub", "id", "slice", numbers("chunks").alias("chunk"), F.lit(False).alias("asked"))
        again = (asked.unionByName(rest).groupBy("hub", "slice", "chunk", "id").agg(F.max("asked").alias("asked"))
                 .select(F.xxhash64("hub", "slice", "chunk").alias("block"), "id", "asked"))
        # the components so far stand for the links that made them
        known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = materialise(components(known.unionByName(solve(again, "join-again").select("a", "b"))), "join-components")
    return labels


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, max_block: int = MAX_BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = docs.sparkSession.sparkContext.broadcast(bucket_counts(docs, words))
    rows = materialise(prefixes(docs, counts, words, percent), "join-prefixes")
    counts.unpersist()
    # equal sets are one class, under its least doc_id
    classes = materialise(rows.where("n > 0 and id is not null").groupBy("n", "d1", "d2").agg(
        F.min("id").alias("rep"), F.min_by("rare", "id").alias("rare"), F.min_by("often", "id").alias("often")), "join-classes")
    reps = classes.select(F.col("rep").alias("id"), "n", "rare", "often")
    labels = jaccard_labels(docs.where("doc_id is not null"), reps, words, percent, max_block)
    named = classes.select("n", "d1", "d2", "rep").join(labels, F.col("rep") == F.col("node"), "left").select(
        "n", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    return rows.select("id", "n", "d1", "d2").join(materialise(named, "join-named"), ["n", "d1", "d2"], "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are the smallest doc_id of their group (rows without doc_id stay)."""
    groups = jaccard_components(docs, **options).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(groups, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))


ORACLE = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
           THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes s ON a = s.doc_id JOIN sizes t ON b = t.doc_id
  WHERE 100 * common >= 90 * (s.n + t.n - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.seen = e.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id
JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) r ON d.doc_id = r.node
"""
