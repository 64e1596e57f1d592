"""Operators on documents: oracles, brute force, and odd rows."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratecraft.llm import line_dedup, mixing, ngram_join, packing, repeats, topk_search
from ratecraft.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "word " * 30_000
ODD = [(1, None, None, None, 0), (2, "", "en", "a", 0), (3, " \n\t", "en", "a", 3), (4, "a b c d e", "de", "b", 9), (5, "a b c d e", "de", None, 9),
       (5, "a b c d e", "de", None, 9), (None, "a b c d e", None, "b", 9), (6, LONG, "en", "a", len(LONG)), (7, "x\n" * 50, "fr", "b", 100),
       (8, "Ünï Çødé\n\n" + "same line of forty characters and some more.\n" * 2, "fr", "c", 0)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(-1) for c in ("n_lines", "size", "hash", "block", "rank", "id", "start")})


def oracle(sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.sql(sql)
    return [c for c in rel.columns], rel.fetchall()


def same_as_oracle(df, sql):
    names, rows = oracle(sql)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(rows, key=repr)


@pytest.mark.parametrize("operator", [line_dedup.line_dedup_digest, mixing.mix, ngram_join.jaccard_components,
                                      packing.pack, repeats.repeats_digest, topk_search.search])
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0


# ---- lines ----------------------------------------------------------------------
def test_lines_as_oracle(docs):
    same_as_oracle(line_dedup.line_dedup_digest(docs), line_dedup.ORACLE)


def test_lines_of_odd_rows(spark, odd):
    out = line_dedup.dedup_lines(odd)
    assert set(odd.columns) <= set(out.columns) and out.count() == len(ODD)
    line = "A line that is long enough to be counted as one."
    rows = [(i, f"own {i}\n  {line.upper() if i % 2 else line}\t\n{line}") for i in range(6)] + [(None, line), (9, line[:39])]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[5].n_dropped == 0 and got[0].text == "own 0" and got[0].n_dropped == 2 and got[0].n_lines == 3
    assert got[None].text == "" and got[9].n_dropped == 0
    four = spark.createDataFrame(rows[:4], "doc_id long, text string")
    assert line_dedup.dedup_lines(four).agg(F.sum("n_dropped")).first()[0] == 0


# ---- mixing ---------------------------------------------------------------------
def test_mix_as_oracle(docs):
    same_as_oracle(mixing.mix(docs), mixing.ORACLE)


def test_mix_meets_targets(spark, odd):
    rows = [(i, "w " * (i % 7 + 1), "s" + str(i % 5)) for i in range(300)] + [(i, "w " * 40, "hot") for i in range(300, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df).toPandas()
    assert (out.taken <= 2 * out["size"]).all()
    per = out.groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"), n=("size", "size"))
    for r in mixing.mix(df).groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.count("*").alias("n")).collect():
        assert abs(r.taken - r.target * round(r.n / (100 if r.source_size == 4000 else 60))) <= 2 + r.n // 60
    assert len(per) >= 2
    assert mixing.mix(odd).count() == len(ODD)
    taken = {r.doc_id: r.taken for r in mixing.mix(odd).collect()}
    assert taken[1] == taken[2] == taken[3] == 0


def test_mix_copies(spark, odd):
    out = mixing.apply_mix(odd)
    assert out.columns == odd.columns
    rows = [(i, "a b c", "s") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    n = collections.Counter(r.doc_id for r in mixing.apply_mix(df).collect())
    assert sum(n.values()) == 150 and set(n.values()) <= {1, 2}


# ---- n-gram join ----------------------------------------------------------------
@pytest.mark.parametrize("block", [512, 3])
def test_join_as_oracle(docs, block):
    same_as_oracle(ngram_join.jaccard_components(docs, max_block=block), ngram_join.ORACLE)


def test_join_hot_path_and_chains(spark, monkeypatch):
    # documents in chains: neighbours link, ends do not; every shingle counts as frequent
    monkeypatch.setattr(ngram_join, "HOT_SHINGLE", -1e9)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for k in range(12):
        words = base[:]
        words[0:2 * k] = [f"k{i}" for i in range(2 * k)]
        rows.append((100 + k, " ".join(words)))
    df = spark.createDataFrame(rows + [(7, " ".join(base)), (8, "other words here " * 9), (9, None)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(df, max_block=2).collect()}
    assert all(got[i] == 7 for i in range(100, 112)) and got[8] == 8 and got[9] == 9


def test_join_odd_rows(odd):
    rows = ngram_join.jaccard_components(odd).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got[1] == (0, 1) and got[3] == (0, 3) and got[5] == (3, 4) and got[6] == (1, 6) and got[None] == (3, None)
    kept = [r.doc_id for r in ngram_join.drop_near_copies(odd).collect()]
    assert 5 not in kept and 4 in kept and None in kept


def test_search_returns_what_reaches_the_overlap():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 400, rng.integers(20, 200)).astype(np.uint64)) for _ in range(60)]
    sets += [np.unique(np.append(s[:-1], 1000)).astype(np.uint64) for s in sets[:20]]
    block = ngram_join.Block(sets)
    for q, x in enumerate(sets):
        want = [i for i, y in enumerate(sets) if i != q and 100 * len(np.intersect1d(x, y)) >= 90 * len(np.union1d(x, y))]
        assert sorted(block.search(q, 90).tolist()) == want


# ---- packing --------------------------------------------------------------------
def test_pack_ids_and_layout(spark, docs, odd):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(packing.VOCABULARY))
    t.encode_special_tokens = True
    for df, expected in ((docs, 200), (odd, len(ODD))):
        source = [(r.doc_id, r.text) for r in df.collect()]
        pieces = packing.pack(df).toPandas()
        want = collections.Counter()
        for i, text in source:
            ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
            want.update((i, a, min(2048, len(ids) - a), zlib.crc32(ids[a:a + 2048].tobytes()), len(ids)) for a in range(0, len(ids), 2048))
        got = collections.Counter((None if math.isnan(r.doc_id) else int(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces.itertuples())
        assert got == want and len(source) == expected
        for _, s in pieces.sort_values("offset").groupby("sequence_id"):
            assert s.offset.tolist() == [0, *s.length.cumsum().tolist()[:-1]] and s.length.sum() <= 2048


def test_words_make_the_same_ids_as_texts():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(packing.VOCABULARY))
    t.encode_special_tokens = True
    texts = ["it's the 'rest'. don't! we're", None, "", "a|b | c||", "<|endoftext|> x, y;; z", "É é.  foo,̸ bar", "İI ΑΣ. x'S",
             "hello,world 12a3.", "字 字。 a b", " lead", "trail ", "é,", "≠ ≮"]
    ids, ends = packing.WordTokenizer(tokenizer_path(packing.VOCABULARY))(pa.array(texts), 1)
    for i, text in enumerate(texts):
        assert ids[ends[i]:ends[i + 1]].tolist() == t.encode(text or "", add_special_tokens=False).ids + [1], text


def test_every_letter_before_every_closing_mark():
    """Each letter of Unicode ends a word before each mark that may be split off: ids as from whole texts."""
    import sys
    import unicodedata

    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path(packing.VOCABULARY))
    t.encode_special_tokens = True
    encode = packing.WordTokenizer(tokenizer_path(packing.VOCABULARY))
    letters = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == "L" and not 0xAC00 <= c < 0xD7A4 and not 0x3400 <= c < 0x9FFF and c < 0x11000]
    for mark in ".,;:!?#$%&*":
        texts = [" ".join(f"{c}{mark}" for c in letters[i:i + 40]) + f" \u0130stanbul, \u0130{mark}{mark}" for i in range(0, len(letters), 40)]
        ids, ends = encode(pa.array(texts), 1)
        for i, code in enumerate(t.encode_batch(texts, add_special_tokens=False)):
            assert ids[ends[i]:ends[i + 1]].tolist() == code.ids + [1], texts[i]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="not a lower-casing vocabulary"):
        packing.WordTokenizer(tokenizer_path("byte_bpe_50k.json"))


def test_patterns_place_every_piece_once():
    rng = np.random.default_rng(2)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(rng.integers(1, 2049, 3000), return_counts=True))} | {7: 5000}
    slots = packing.patterns(histogram)
    ranks, fill = collections.defaultdict(list), collections.defaultdict(int)
    for length, lo, hi, first, offset in slots:
        ranks[length].append((lo, hi))
        for s in range(first, first + hi - lo):
            assert fill[s] == offset
            fill[s] += length
    assert all(n <= 2048 for n in fill.values())
    for length, n in histogram.items():
        parts = sorted(ranks[length])
        assert parts[0][0] == 0 and parts[-1][1] == n and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


# ---- repeats --------------------------------------------------------------------
def brute_repeats(rows, width):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[p:p + width] for _, b in texts for p in range(len(b) - width + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - width + 1):
            if seen[b[p:p + width]] > 1:
                gone[p] += 1
                gone[p + width] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_group", [4 << 20, 1000])
def test_repeats_as_brute_force(docs, max_group):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((tuple(r) for r in repeats.repeats_digest(docs, max_group=max_group).collect()), key=repr)
    want = brute_repeats(rows, 200)
    assert got == want and sum(r[2] for r in want) > 0


@pytest.mark.parametrize("width,k", [(16, 5), (9, 3), (8, 4)])
def test_repeats_in_small_alphabets(spark, width, k):
    rng = np.random.default_rng(width)
    rows = [(i, "".join(rng.choice(list("ab"), rng.integers(0, 300)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "é" * 50), (53, "é" * 50), (None, "a" * 100), (54, "a" * 300), (55, "x" * 20), (55, "x" * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in repeats.repeats_digest(df, width=width, k=k).collect()), key=repr)
    assert got == brute_repeats(rows, width)


def test_repeats_spans_and_kept_bytes(spark, odd):
    passage = "<a passage that two documents share, and it is long enough to count>"
    df = spark.createDataFrame([(1, "one " + passage + " end"), (2, passage), (3, "three")], "doc_id long, text string")
    got = {r.doc_id: r for r in repeats.remove_repeats(df, width=60, k=10).collect()}
    assert bytes(got[2].kept) == b"" and bytes(got[3].kept) == b"three" and bytes(got[1].kept) == b"one  end"
    assert [(s.start, s.end) for s in got[1].spans] == [(4, 4 + len(passage))]
    assert repeats.repeats_digest(odd).count() == len(ODD)


def test_rows_without_id_whose_short_hashes_collide(spark):
    """Two texts with one 32-bit hash, and rows that share a doc_id or have none, are rows of their own."""
    shared = "p" * 90 + "q" * 90 + "r" * 90
    texts = spark.range(300_000).select(F.concat(F.lit(shared), F.sha2(F.col("id").cast("string"), 256)).alias("t"))
    twins = texts.groupBy(F.hash("t").alias("h")).agg(F.collect_list("t").alias("ts")).where(F.size("ts") > 1).first().ts
    rows = [(None, t) for t in twins] + [(7, t) for t in twins] + [(7, "other " * 60), (None, "x" + "other " * 50), (None, None), (7, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in repeats.repeats_digest(df).collect()), key=repr)
    assert len(twins) > 1 and got == brute_repeats(rows, 200)


def test_minimizers_are_counted_without_a_window(spark, monkeypatch):
    """A passage of many texts and a text of one character: no window deals all rows of a minimizer to one task."""
    passage = " ".join(f"word{j}" for j in range(40))
    rows = [(i, f"{i} {passage} {i * i}") for i in range(60)] + [(100, "a" * 3000), (101, "a" * 500 + "b"), (102, "alone " * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plans, write = [], repeats.materialise
    monkeypatch.setattr(repeats, "materialise", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, name))
    got = sorted((tuple(r) for r in repeats.repeats_digest(df).collect()), key=repr)
    assert got == brute_repeats(rows, 200) and sum(r[2] for r in got) > 0
    assert plans and not any("Window" in p for p in plans)


# ---- search ---------------------------------------------------------------------
def brute_search(rows, every, k):
    bags = [(i, collections.Counter(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))) for i, t in rows]
    n, mean = len(bags), sum(sum(c.values()) for _, c in bags) / len(bags)
    df = collections.Counter(w for _, c in bags for w in c)
    out = {}
    for q, query in bags:
        if q is None or q % every:
            continue
        scores = []
        for i, c in bags:
            norm = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + norm) for w in query if w in c)
            if s > 0 and i is not None:
                scores.append((-s, i))
        out[q] = sorted((round(s, 9), i) for s, i in scores)[:k]
    return out


@pytest.mark.parametrize("shard_bytes", [32 << 20, 100_000])
def test_search_as_brute_force(spark, docs, odd, shard_bytes):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = topk_search.search(docs, every=10, shard_bytes=shard_bytes).toPandas()
    want = brute_search(rows, 10, 10)
    assert set(got.query_id) == {q for q, v in want.items() if v}
    for q, g in got.sort_values("rank").groupby("query_id"):
        assert g.doc_id.tolist() == [i for _, i in want[q]] and g["rank"].tolist() == list(range(1, len(g) + 1))
        assert (-g.score).tolist() == pytest.approx([s for s, _ in want[q]])
    few = topk_search.search(odd, every=1, k=3)
    assert {r.query_id for r in few.collect()} == {4, 5, 6, 7, 8}


@pytest.mark.parametrize("topics,most", [(1, 1.0), (12, 0.7)])
def test_search_never_costs_more_than_all_postings(topics, most):
    """No posting is scored twice; where blocks differ (a shard sorted by topic) most are skipped.  The best are those of all scores."""
    rng = np.random.default_rng(8)
    p = 1 / np.arange(1, 401)
    texts = [" ".join(f"t{i * topics // 3000}w{x}" if rng.random() < 0.7 else f"all{x}" for x in rng.choice(400, rng.integers(20, 200), p=p / p.sum()))
             for i in range(3000)]
    words, counts, distinct, sizes = topk_search.counted_words(pa.array(texts))
    df = dict(zip(*np.unique(words, return_counts=True)))
    shard = topk_search.Shard(np.arange(3000), words, counts, distinct, sizes, float(sizes.mean()))
    ends = np.cumsum(distinct)
    for q in range(0, 3000, 100):
        asked = words[ends[q] - distinct[q]:ends[q]]
        weights = np.array([math.log1p((3000 - df[w] + 0.5) / (df[w] + 0.5)) for w in asked])
        order = np.lexsort((asked, -weights))
        asked, weights = asked[order], weights[order]
        weight = dict(zip(asked.tolist(), weights.tolist()))
        part = counts * 2.2 / (counts + np.repeat(1.2 * (0.25 + 0.75 * sizes / sizes.mean()), distinct))
        every = np.add.reduceat([weight.get(w, 0.0) for w in words.tolist()] * part, ends - distinct)
        ids, scores = shard.search(asked, weights, 10)
        best = np.lexsort((np.arange(3000), -every.round(9)))[:10]
        assert ids.tolist() == best.tolist() and scores == pytest.approx(every[best])
    assert 0 < shard.scored <= most * shard.held


def test_search_of_many_queries_is_that_of_each(monkeypatch):
    """A piece of queries scored together: the documents and scores of single searches, bit for bit, above any floor; most without reading their lists."""
    rng = np.random.default_rng(4)
    p = 1 / np.arange(1, 3001)
    texts = [" ".join(f"w{x}" for x in rng.choice(3000, rng.integers(20, 200), p=p / p.sum())) for _ in range(2000)] + ["", "w1 w2", "w1 w2"]
    n = len(texts)
    words, counts, distinct, sizes = topk_search.counted_words(pa.array(texts))
    df = dict(zip(*np.unique(words, return_counts=True)))
    ends, queries = np.cumsum(distinct), []
    for q in [*range(0, n, 20), n - 3, n - 1]:
        asked = np.append(words[ends[q] - distinct[q]:ends[q]], [7] * (q % 3 == 0))      # a word that no document has
        weights = np.array([math.log1p((n - df.get(w, 1) + 0.5) / (df.get(w, 1) + 0.5)) for w in asked.tolist()])
        order = np.lexsort((asked, -weights))
        queries.append((asked[order], weights[order]))
    shard = lambda: topk_search.Shard(np.arange(n)[::-1].copy(), words, counts, distinct, sizes, float(sizes.mean()))
    one = shard()
    want = [one.search(a, w, 10) for a, w in queries]
    for floors in (np.zeros(len(queries)), np.array([s[min(4, len(s) - 1)] if len(s) else 0.0 for _, s in want]), np.full(len(queries), 1e9)):
        many = shard()
        got = many.search_many(np.concatenate([a for a, _ in queries]), np.concatenate([w for _, w in queries]), np.array([len(a) for a, _ in queries]), floors, 10)
        assert len(got) == len(want)
        for (ids, scores), (i, s), floor in zip(got, want, floors, strict=True):
            assert ids.tolist() == i[s >= floor].tolist() and scores.tolist() == s[s >= floor].tolist()
        assert many.held < 0.1 * one.held and len(many.matrix) > 10 or floors[0] == 1e9
    # in pieces of few queries, as where a shard has very many documents
    monkeypatch.setattr(topk_search, "CELLS", 7 * n)
    got = many.search_many(np.concatenate([a for a, _ in queries]), np.concatenate([w for _, w in queries]), np.array([len(a) for a, _ in queries]), np.zeros(len(queries)), 10)
    assert all(ids.tolist() == i.tolist() and scores.tolist() == s.tolist() for (ids, scores), (i, s) in zip(got, want, strict=True))


def test_search_with_floors_from_a_share_of_the_rows(spark, docs):
    rows = lambda df: sorted(map(tuple, df.collect()))
    want = rows(topk_search.search(docs, every=5, k=2))
    assert rows(topk_search.search(docs, every=5, k=2, sampled_from=0)) == want


def test_search_report_as_oracle(docs):
    same_as_oracle(topk_search.search_report(docs), topk_search.ORACLE)
