"""Repeated passages by merged suffix orders of shards.

A byte of a text goes if a string of ``width`` bytes that covers it also starts
anywhere else, in any text.  Matches never cross texts and are judged on the
input.

1. Every window of ``width`` bytes has a minimizer, its least k-byte string by
   hash; neighbouring windows mostly share it.  Equal windows have equal
   minimizers, so windows whose minimizer occurs once in all texts cannot repeat.
2. What is left of a text are runs of windows with a common minimizer.  Runs
   that are byte for byte equal repeat as a whole; one of them stands for all.
3. Different runs with one minimizer are dealt to the same task.  It cuts them
   into shards and sorts each shard's suffixes once.  A shard keeps their transform
   (for every suffix, in order, the character before it) and where the suffix that
   begins with that character stands.  The shards are then merged by their
   interleave, the sequence that says which shard the next suffix of the common
   order is from: read along it, the transforms' characters are counted into place,
   which gives the interleave for a prefix one character longer.  No suffixes are
   compared or sorted anew.  Where a character or the interval before differs, an
   interval (the suffixes with a common prefix) ends; intervals with one member
   drop out with all that would follow from them.  At ``width`` bytes the intervals
   that are left are the repeated windows.
4. A minimizer with more than ``max_group`` bytes of different runs has its
   windows counted by digest instead, spread over all tasks.

A character of the transforms is a string of 8 bytes, so a window of 200 bytes takes
24 refinements; the alphabet is what the shards hold, merged from their orders.

Defined cases: NULL is an empty text; texts shorter than ``width`` keep all
bytes; repeated rows are texts of their own, so what they share repeats; a NULL
doc_id is kept and rows may share a doc_id; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.arrow_text import slices, utf8
from ratecraft.llm.common import materialise, parallelism
from ratecraft.llm.shingles import _ODD, _ODD_INVERSE, _powers, mixed

WIDTH = 200
K = 50                   # bytes of a minimizer
MAX_GROUP = 4 << 20      # bytes of different runs with one minimizer that a task merges
_RUN = 1 << 20           # bytes worked on at a time
_SHARD = 1 << 18         # bytes of a shard
STRIDE = 8               # bytes of a transform's character
_TOGETHER = 1 << 21      # bytes of small groups merged together
_PLACE = np.uint64((1 << 26) - 1)


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every w neighbours."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def window_runs(data: np.ndarray, ends: np.ndarray, width: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, minimizer) of every run of windows with one minimizer occurrence."""
    n = len(data)
    empty = np.zeros(0, np.int64)
    parts = [(empty, empty, empty, empty)]
    # first positions of windows that a text holds whole
    change = np.zeros(n + 1, np.int64)
    holds = np.maximum(np.diff(ends) - width + 1, 0)
    np.add.at(change, ends[:-1], (holds > 0).astype(np.int64))
    np.add.at(change, ends[:-1] + holds, -(holds > 0).astype(np.int64))
    whole = np.cumsum(change)[:n] > 0
    for base in range(0, max(n - width + 1, 0), _RUN):
        part = data[base:base + _RUN + width - 1]
        if len(part) < width:
            break
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, len(part)))])
        h = mixed((sums[k:] - sums[:-k]) * _powers(_ODD_INVERSE, len(part))[:len(part) - k + 1])
        least = sliding_least((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), width - k + 1)
        at = (least & _PLACE).astype(np.int64)
        valid = whole[base:base + len(at)]
        starts = valid.copy()
        starts[1:] &= ~valid[:-1] | (at[1:] != at[:-1])
        firsts = np.flatnonzero(starts)
        # a run ends where the next one starts or windows stop being whole
        stops = valid.copy()
        stops[:-1] &= ~valid[1:] | starts[1:]
        sizes = np.flatnonzero(stops) + 1 - firsts
        text = np.searchsorted(ends, firsts + base, side="right") - 1
        parts.append((text, firsts + base - ends[text], sizes, h[at[firsts]].view(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


class Shard:
    """The suffixes of some strings in order of their first ``width`` bytes, and their transform.

    Where a string ends its suffixes are shorter; their place among others is open,
    as they cannot start a window."""

    def __init__(self, strings: list[bytes], width: int):
        data = np.frombuffer(b"".join(strings), np.uint8)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        n, ends = len(data), np.cumsum(sizes)
        at = np.arange(n, dtype=np.int32)
        self.room = np.repeat(ends.astype(np.int32), sizes) - at
        self.since = at - np.repeat((ends - sizes).astype(np.int32), sizes)
        self.code = np.zeros(n, np.uint64)
        padded = np.append(data, np.zeros(STRIDE, np.uint8))
        for i in range(STRIDE):
            self.code |= np.where(self.room > i, padded[i:i + n], 0).astype(np.uint64) << np.uint64(56 - 8 * i)
        self.order = np.argsort(self.code, kind="stable").astype(np.int32)
        self._sort(width)

    def _sort(self, width: int) -> None:
        """By prefixes that double, until no two suffixes share one or they are ``width`` long."""
        n, order = len(self.order), self.order
        ranks, start = np.zeros(n, np.int32), _starts(self.code[order])
        ranks[order] = start
        depth = STRIDE
        while depth < width:
            step = min(depth, width - depth)
            several = np.flatnonzero(_several(start)).astype(np.int32)
            if not len(several):
                break
            these = order[several]
            behind = np.zeros(len(these), np.int32)
            longer = self.room[these] > step
            behind[longer] = ranks[these[longer] + step] + 1
            key = start[several] * np.int64(n + 1) + behind
            by = np.argsort(key, kind="stable")
            order[several] = these[by]
            start[several] = several[_starts(key[by])]
            ranks[order[several]] = start[several]
            depth += step

    def transform(self, alphabet: np.ndarray) -> None:
        """``character``: of each suffix in order, the 8 bytes before it; ``before``: the place of the suffix they begin (-1: none)."""
        place = np.empty(len(self.order), np.int32)
        place[self.order] = np.arange(len(self.order), dtype=np.int32)
        has = self.since[self.order] >= STRIDE
        earlier = np.where(has, self.order - STRIDE, 0)
        # the numbers of the characters in text order, found along the sorted suffixes
        number = np.empty(len(self.order), np.uint32)
        number[self.order] = np.searchsorted(alphabet, self.code[self.order])
        self.character = number[earlier]
        self.before = np.where(has, place[earlier], -1)
        self.code = self.since = None


def _starts(keys: np.ndarray) -> np.ndarray:
    """For sorted keys, where the run of equal ones begins that each is in."""
    new = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
    return np.flatnonzero(new).astype(np.int32)[np.cumsum(new, dtype=np.int32) - 1] if len(keys) else np.zeros(0, np.int32)


def _several(start: np.ndarray) -> np.ndarray:
    """Which have the same start as a neighbour."""
    same = np.r_[False, start[1:] == start[:-1], False]
    return same[1:] | same[:-1]


def _counted(characters: np.ndarray) -> np.ndarray:
    """The places in stable order of the characters, by counting passes over 16 bits."""
    by = np.argsort((characters & 0xFFFF).astype(np.uint16), kind="stable")
    high = (characters >> 16).astype(np.uint16)
    return by[np.argsort(high[by], kind="stable")] if high.any() else by


def repeated_windows(shards: list[Shard], width: int) -> list[np.ndarray]:
    """Per shard, which positions start a window that starts elsewhere too."""
    # the shards' distinct characters are sorted; a stable sort of their runs only merges them
    runs = [s.code[s.order[s.room[s.order] >= STRIDE]] for s in shards]
    alphabet = np.sort(np.concatenate([r[np.r_[True, r[1:] != r[:-1]]] if len(r) else r for r in runs]), kind="stable")
    alphabet = alphabet[np.r_[True, alphabet[1:] != alphabet[:-1]]] if len(alphabet) else alphabet
    depth = width % STRIDE or STRIDE
    live, prefixes = [], []
    for s in shards:
        live.append(np.flatnonzero(s.room[s.order] >= depth).astype(np.int32))        # places of suffixes in their shard's order
        prefixes.append(s.code[s.order[live[-1]]] >> np.uint64(64 - 8 * depth))
        s.transform(alphabet)
    prefixes = np.concatenate(prefixes)
    by = np.argsort(prefixes, kind="stable")
    interleave = np.repeat(np.arange(len(shards), dtype=np.uint16), [len(x) for x in live])[by]
    interval = _starts(prefixes[by])
    del prefixes, by, runs
    while True:
        # intervals of one suffix drop out
        stays = _several(interval)
        own = np.split(np.argsort(interleave, kind="stable"), np.cumsum([len(x) for x in live])[:-1])
        live = [x[stays[o]] for x, o in zip(live, own, strict=True)]
        if depth >= width or not stays.any():
            break
        interleave, interval = interleave[stays], interval[stays]
        # the transforms' characters along the interleave
        characters, has = np.zeros(len(interleave), np.uint32), np.zeros(len(interleave), bool)
        along = np.argsort(interleave, kind="stable")
        characters[along] = np.concatenate([s.character[x] for s, x in zip(shards, live, strict=True)])
        has[along] = np.concatenate([s.before[x] >= 0 for s, x in zip(shards, live, strict=True)])
        characters, interleave, interval = characters[has], interleave[has], interval[has]
        by = _counted(characters)
        characters, interleave, interval = characters[by], interleave[by], interval[by]
        interval = _starts(characters.astype(np.int64) << 32 | interval)
        del by, along, has, characters
        for i, s in enumerate(shards):
            marked = np.zeros(len(s.order), bool)
            places = s.before[live[i]]
            marked[places[places >= 0]] = True
            live[i] = np.flatnonzero(marked).astype(np.int32)
        depth += STRIDE
    out = []
    for s, x in zip(shards, live, strict=True):
        hit = np.zeros(len(s.order), bool)
        if depth >= width:
            hit[s.order[x]] = True
        out.append(hit)
    return out


def _runs_of(hit: np.ndarray) -> list[tuple[int, int]]:
    """(start, length) of the stretches of True."""
    edges = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    return [(a, b - a) for a, b in edges.reshape(-1, 2).tolist()]


def _keyed(docs: DataFrame) -> DataFrame:
    """(id, d, body): a row's identity is 128 bits of its doc_id and text, so only equal rows share one."""
    return docs.select(*_identity(docs), F.coalesce("text", F.lit("")).alias("body"))


def _identity(docs: DataFrame) -> list:
    row = (F.col("doc_id").cast("string").isNull(), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return [F.xxhash64(F.lit(1), *row).alias("id"), F.xxhash64(F.lit(2), *row).alias("d")]


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def candidates(rows: DataFrame, width: int, k: int) -> DataFrame:
    """(id, d, body, runs): texts with the runs whose minimizer occurs elsewhere too."""
    def find(batches):
        for batch in batches:
            for part in slices(batch, "body", _RUN):
                text, lo, n, h = window_runs(*utf8(part.column("body")), width, k)
                at = pa.array(text)
                yield _batch({"id": part.column("id").take(at), "d": part.column("d").take(at), "h": pa.array(h),
                              "lo": pa.array(lo, pa.int32()), "n": pa.array(n, pa.int32())})

    found = materialise(rows.mapInArrow(find, "id long, d long, h long, lo int, n int"), "repeats-minimizers")
    # counted with map-side combination; written, as only a join right after its shuffles can split a minimizer that many rows have
    several = materialise(found.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h"), "repeats-several")
    runs = found.join(several, "h", "left_semi").groupBy("id", "d").agg(F.collect_set(F.struct("lo", "n", "h")).alias("runs"))
    return materialise(rows.join(runs, ["id", "d"]).select("id", "d", F.col("body").cast("binary").alias("body"), "runs"), "repeats-texts")


def run_classes(texts: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """((h, s, id, d, lo, n) of every run, s its digest; (h, s, times, rep) of equal runs)."""
    def digest(batches):
        for batch in batches:
            out = {c: [] for c in ("id", "d", "h", "s", "lo", "n")}
            for i, d, body, runs in zip(*(batch.column(c).to_pylist() for c in ("id", "d", "body", "runs")), strict=True):
                for r in runs:
                    lo, n = r["lo"], r["n"]
                    s = hashlib.blake2b(body[lo:lo + n + width - 1], digest_size=16).digest()
                    for c, v in zip(out.values(), (i, d, r["h"], s, lo, n), strict=True):
                        c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32())
            yield _batch({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})

    # a row that is there twice has its runs twice
    every = materialise(texts.mapInArrow(digest, "id long, d long, h long, s binary, lo int, n int"), "repeats-runs")
    classes = every.groupBy("h", "s").agg(F.count("*").alias("times"), F.min(F.struct("id", "d", "lo", "n")).alias("rep"))
    return every, materialise(classes, "repeats-classes")


def merged_repeats(strings: DataFrame, width: int) -> DataFrame:
    """(id, d, lo, n): repeated windows of the runs that occur once, from (h, times, id, d, lo, s) with the bytes s."""
    def solve(group: list[tuple]) -> list[tuple]:
        shards, cuts, held, size = [], [], [], 0
        for row in group:
            held.append(row)
            size += len(row[5])
            if size >= _SHARD:
                cuts.append(held)
                held, size = [], 0
        if held:
            cuts.append(held)
        shards = [Shard([r[5] for r in c], width) for c in cuts]
        found = []
        for rows, hit in zip(cuts, repeated_windows(shards, width), strict=True):
            at = 0
            for _, times, i, d, lo, s in rows:
                if times == 1:
                    found += [(i, d, lo + a, n) for a, n in _runs_of(hit[at:at + len(s)])]
                at += len(s)
        return found

    def merge(batches):
        held, size, last = [], 0, None
        for batch in batches:
            found = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("h", "times", "id", "d", "lo", "s")), strict=True):
                if size >= _TOGETHER and row[0] != last:
                    found += solve(held)
                    held, size = [], 0
                held.append(row)
                size, last = size + len(row[5]), row[0]
            yield _ranges(found)
        if held:
            yield _ranges(solve(held))

    dealt = strings.repartition(parallelism(strings.sparkSession), "h").sortWithinPartitions("h")
    return dealt.select("h", "times", "id", "d", "lo", "s").mapInArrow(merge, "id long, d long, lo int, n int")


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return _batch({c: pa.array(v, t) for c, v, t in zip(("id", "d", "lo", "n"), columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)})


def counted_repeats(strings: DataFrame, width: int) -> DataFrame:
    """As ``merged_repeats``, by counting digests of single windows: for groups too large for a task."""
    def windows(batches):
        for batch in batches:
            for times, i, d, lo, s in zip(*(batch.column(c).to_pylist() for c in ("times", "id", "d", "lo", "s")), strict=True):
                w = [hashlib.blake2b(s[a:a + width], digest_size=16).digest() for a in range(len(s) - width + 1)]
                k = len(w)
                yield _batch({"w": pa.array(w, pa.binary()), "times": pa.array([times] * k), "id": pa.array([i] * k),
                              "d": pa.array([d] * k, pa.int64()), "lo": pa.array(range(lo, lo + k), pa.int32())})

    every = materialise(strings.mapInArrow(windows, "w binary, times long, id long, d long, lo int"), "repeats-windows")
    several = materialise(every.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w"), "repeats-several")
    return every.where("times = 1").join(several, "w", "left_semi").select("id", "d", "lo", F.lit(1).alias("n"))


def repeated_ranges(docs: DataFrame, width: int = WIDTH, k: int = K, max_group: int = MAX_GROUP) -> tuple[DataFrame, DataFrame]:
    """((id, d, lo, n): stretches of repeated windows; (id, d, body) of the texts that may have some)."""
    texts = candidates(_keyed(docs), width, k)
    every, classes = run_classes(texts, width)
    whole = every.join(classes.where("times > 1").select("h", "s"), ["h", "s"], "left_semi").select("id", "d", "lo", "n")
    # groups where a run that occurs once meets another run
    groups = materialise(classes.groupBy("h").agg(F.count("*").alias("classes"), F.min("times").alias("least"),
                                                  F.sum(F.col("rep.n") + width - 1).alias("bytes"))
                         .where("classes > 1 and least = 1").select("h", "bytes"), "repeats-groups")
    reps = classes.join(groups, "h").select("h", "times", "bytes", "rep.*")
    asked = reps.groupBy("id", "d").agg(F.collect_list(F.struct("h", "times", "bytes", "lo", "n")).alias("asked"))

    def cut(batches):
        for batch in batches:
            out = {c: [] for c in ("h", "times", "bytes", "id", "d", "lo", "s")}
            for i, d, body, asked in zip(*(batch.column(c).to_pylist() for c in ("id", "d", "body", "asked")), strict=True):
                for r in asked:
                    values = (r["h"], r["times"], r["bytes"], i, d, r["lo"], body[r["lo"]:r["lo"] + r["n"] + width - 1])
                    for c, v in zip(out.values(), values, strict=True):
                        c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield _batch({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})

    bodies = texts.select("id", "d", "body").join(asked, ["id", "d"])
    strings = materialise(bodies.mapInArrow(cut, "h long, times long, bytes long, id long, d long, lo int, s binary"), "repeats-strings")
    ranges = whole.unionByName(merged_repeats(strings.where(F.col("bytes") <= max_group), width))
    large = strings.where(F.col("bytes") > max_group)
    if not large.isEmpty():
        ranges = ranges.unionByName(counted_repeats(large, width))
    return materialise(ranges, "repeats-ranges"), texts


def remove_repeats(docs: DataFrame, width: int = WIDTH, k: int = K, max_group: int = MAX_GROUP, kept: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256, kept) of every row; kept holds the remaining bytes, or NULL if not asked for."""
    ranges, texts = repeated_ranges(docs, width, k, max_group)
    per = ranges.groupBy("id", "d").agg(F.collect_set(F.struct("lo", "n")).alias("ranges"))

    def remove(batches):
        for batch in batches:
            out = {c: [] for c in ("id", "d", "n_removed", "spans", "sha", "kept")}
            for i, d, body, ranges in zip(*(batch.column(c).to_pylist() for c in ("id", "d", "body", "ranges")), strict=True):
                change = np.zeros(len(body) + 1, np.int64)
                for r in ranges:
                    change[r["lo"]] += 1
                    change[r["lo"] + r["n"] + width - 1] -= 1
                gone = np.cumsum(change)[:-1] > 0
                rest = np.frombuffer(body, np.uint8)[~gone].tobytes()
                spans = [{"start": a, "end": a + n} for a, n in _runs_of(gone)]
                for c, v in zip(out.values(), (i, d, int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), rest if kept else None), strict=True):
                    c.append(v)
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), span, pa.string(), pa.binary())
            yield _batch({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)})

    removed = materialise(texts.select("id", "d", "body").join(per, ["id", "d"]).mapInArrow(
        remove, "id long, d long, n_removed long, spans array<struct<start: long, end: long>>, sha string, kept binary")
        .dropDuplicates(["id", "d"]), "repeats-removed")
    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", *_identity(docs),
                       F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("own"),
                       *([body.cast("binary").alias("body")] if kept else []))
    none = F.array().cast("array<struct<start: long, end: long>>")
    return rows.join(removed, ["id", "d"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("spans", none).alias("spans"),
        F.coalesce("sha", "own").alias("kept_sha256"), (F.coalesce("kept", "body") if kept else F.col("kept")).alias("kept"))


def repeats_digest(docs: DataFrame, **options) -> DataFrame:
    """The contract's columns."""
    return remove_repeats(docs, kept=False, **options).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
