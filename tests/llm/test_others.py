"""Language ID, pages, vectors, components and the pipeline."""

import hashlib
import html
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ratecraft.llm import html_extract, language_id, line_dedup, mixing, packing, vector_dedup, warc
from ratecraft.llm.common import materialise
from ratecraft.llm.components import components
from ratecraft.llm.dom import Nodes
from ratecraft.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


def same_as_oracle(df, name, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    rel = con.sql(sql)
    assert sorted(rel.columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*rel.columns).collect()), key=repr) == sorted(rel.fetchall(), key=repr)


def test_very_deep_pages_are_read_in_linear_time():
    for html, runs in (("<div>" * 40_000 + "text" + "</div>" * 40_000, 1), ("<div>" * 20_000 + "<li>x" * 20_000, 20_000), ("<p>a<ul><li>b" * 10_000, 20_000)):
        began = time.process_time()
        nodes = Nodes()
        nodes.read(html)
        assert len(nodes.features()) == len(nodes.tag) and sum(t is not None for t in nodes.text) == runs
        assert time.process_time() - began < 2


def test_registry():
    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES if q != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES and set(ORACLE) <= set(QUERIES)


# ---- components -----------------------------------------------------------------
def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5000 + i) for i in range(1, 50)] + [(3, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


# ---- language -------------------------------------------------------------------
@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{MID}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return language_id.fit(documents, sample_docs=150, rounds=2)


def test_languages_of_held_out_rows(documents, model):
    got = language_id.predict(documents, model).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.98 and got.score.between(0, 1).all()
    assert got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1).all()


def test_thousands_of_language_values(spark):
    """Dirty values of lang make neither a deep plan nor a wrong share."""
    rows = [(i, f"word{i % 7} and others", f"x{i % 3000}") for i in range(6000)]
    languages, _, p = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_docs=1, rounds=1)
    assert 2500 < len(languages) <= 3000 and p.shape[1] == len(languages)


def test_language_of_odd_texts(spark, documents, model):
    rows = [(1, None), (2, ""), (3, "123 % ́"), (4, "字字"), (None, "the of and"), (5, "x" * 3000), (5, "the of and " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang_pred", F.lit("xx")).withColumn("score", F.lit(2))
    got = [(r.doc_id, r.lang_pred, r.score) for r in language_id.predict(df, model).collect()]
    assert [(g[1], g[2]) for g in got[:3]] == [("und", 0.0)] * 3
    assert got[3][1] in model[0] and 0 <= got[3][2] <= 1 and got[4][1] == "en" and got[6][1:] == ("en", pytest.approx(1.0))
    kept = language_id.keep_identified(df, model)
    assert kept.columns == df.columns and kept.count() >= 3
    none = language_id.fit(documents.where("false"))
    assert {r.lang_pred for r in language_id.predict(df, none).collect()} == {"und"}


def test_forward_sums_all_segmentations():
    pieces = ["▁a", "▁ab", "▁", "a", "ab", "b", "bc", "c"]
    p = language_id._with_limits(np.random.default_rng(0).random((len(pieces), 2)) / 10)

    def every(word):
        if not word:
            return np.ones(2)
        total = np.zeros(2)
        for n in range(1, len(word) + 1):
            if word[:n] in pieces:
                total += p[pieces.index(word[:n])] * every(word[n:])
            elif n == 1:
                total += language_id.UNKNOWN * every(word[1:])
        return total
    segmenter = language_id.Segmenter(pieces)
    for word in ("a", "abc", "aabcab", "xaby"):
        for part, size, spans in segmenter.groups([word]):
            assert language_id.forward(size, spans, p, 1)[size, 0] == pytest.approx(every("▁" + word))
        c = language_id.Classifier(["x", "y"], pieces, p[:-2])
        c.segmenter = segmenter
        assert np.exp(c._long(word)) == pytest.approx(every("▁" + word))



def test_score_does_not_depend_on_the_batch():
    pieces = ["▁a", "▁", "a", "b", "c"]
    classify = language_id.Classifier(["x", "y"], pieces, np.random.default_rng(1).random((len(pieces), 2)) / 10)
    texts = ["a b", "c", "", "b c ab", "12", "", "b c", ""]
    alone = [classify(pa.array([t])) for t in texts]
    for n in range(1, len(texts) + 1):
        lang, score = classify(pa.array(texts[:n]))
        assert lang == [a[0][0] for a in alone[:n]] and score == pytest.approx([a[1][0] for a in alone[:n]])
    assert classify(pa.array(["", "1"]))[0] == ["und", "und"]



def test_long_words_are_learnt_from():
    """A piece covers each character of a word, however long the word and small its probability."""
    pieces = ["▁", "▁a", "a", "ab", "b", "bab"]
    segmenter = language_id.Segmenter(pieces)
    sizes = np.array([*map(len, pieces), 1, 0])          # unknown characters, no piece
    p = language_id._with_limits(np.array([[1e-5], [2e-5], [1e-5], [3e-5], [1e-5], [1e-9]]))
    for word in ("ab" * 12, "ab" * 13, "abx" * 40, "ab" * 100, "b" * 3000):
        counts = language_id.expected_counts([word, "ab"], np.array([2.0, 0.0]), segmenter, p)
        assert counts @ sizes == pytest.approx(2 * (len(word) + 1)) and counts[-1] == 0
    # as the short words' way, where that has no underflow
    for word in ("a", "babab", "abxab" * 4):
        counts = np.zeros(len(p))
        language_id._add_long(counts, word, 3.0, segmenter, p[:, 0])
        assert counts == pytest.approx(language_id.expected_counts([word], np.array([3.0]), segmenter, p))


# ---- pages ----------------------------------------------------------------------
@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def extractor(pages):
    return html_extract.fit(pages)


def test_articles_are_extracted_whole(pages, extractor):
    got = {r.page_id: r for r in html_extract.extract(pages, extractor).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", inner))).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_extraction_of_composed_pages(pages, extractor):
    composer = html_extract.Composer(["Some sentence of a page, with words in it.", "Another one follows here.", "The third is short."], 5)
    nodes = Nodes()
    for _ in range(100):
        nodes.read(composer.page())
    got = html_extract.texts(nodes, html_extract.decode(nodes, extractor.predict(nodes.features())))
    want = html_extract.texts(nodes, nodes.positives())
    assert np.mean([a == b for a, b in zip(got, want)]) > 0.9


def test_nothing_is_kept_below_a_dropped_node(pages, extractor):
    nodes = Nodes()
    for r in pages.limit(50).collect():
        nodes.read(r.html)
    kept = html_extract.decode(nodes, extractor.predict(nodes.features()))
    assert all(kept[p] for i, p in enumerate(nodes.parent) if kept[i] and p >= 0)


def test_odd_pages(spark, extractor):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain words"), (3, "u", "<p>a<b>b</p>c</b><div"), (4, "u", "<script>never closed <p>x"),
            (5, "u", "</p></div>" * 100), (6, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (7, "u", "<a title='x>" * 500), (7, "u", "&lt;b&gt; &amp; &#233; &nbsp;x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("z"))
    got = html_extract.extract(df, extractor).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got) and got[0].text == got[1].text == ""
    assert html_extract.extract(df.where("false")).count() == 0
    nodes = Nodes()
    nodes.read("<p>a<i>b</i> c<p>d &lt;x&gt;<br>e<!-- no --><script>no</script><ul><li>f<li>g</ul>")
    assert html_extract.texts(nodes, np.ones(len(nodes.tag), bool)) == ["ab c d <x> e f g"]


@pytest.mark.parametrize(("page", "want"), [
    ("<p>let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p><p>next", "let x=2 be next"),
    ("<div><object data=a><p>fall back</p></object> b</div>", "fall back b"),
    ("<div><object data=a>never closed</div><p>rest", "never closed rest"),
    ("<p>a<svg><path d='M0'/><use href=b>c</p><p>rest", "ac rest"),
    ("<p>x <svg viewBox=0 /> y</p>", "x y"),
    ("<div><noscript>no scripts</div><p>rest", "no scripts rest"),
    ("<p>a <math><mi>x</p><template>t</template><p>rest<script>no", "a x t rest")])
def test_only_scripts_and_raw_text_are_never_text(page, want):
    nodes = Nodes()
    nodes.read(page)
    assert html_extract.texts(nodes, np.ones(len(nodes.tag), bool)) == [want]



def test_sample_has_pages_of_every_size(spark):
    rows = [(i, f"<article><p>Page {i} says this. " + "And it goes on. " * (4000 if i % 2 else 1) + "</p></article>") for i in range(40)]
    df = spark.createDataFrame(rows + [(40, None)], "page_id long, html string")
    sample = html_extract.sample_of(df)
    assert sorted(sample) == sorted(h for _, h in rows)
    few = html_extract.sample_of(df, sample_bytes=200_000)
    assert few == sample[:len(few)] and sum(map(len, few)) >= 200_000 > sum(map(len, few[:-1]))
    large = df.where("length(html) > 20000")
    assert len(html_extract.sample_of(large)) == 20 and html_extract.sample_of(df.where("false")) == []



def test_archive_round_trip(spark, pages):
    same_as_oracle(warc.round_trip(pages), "pages", warc.ORACLE)
    index = warc.write_archive(pages)
    for r in warc.read_records(index.where("page_id % 3 = 0"), max_gap=10, max_read=10_000).join(pages, "page_id").collect():
        assert bytes(r.payload).decode() == r.html
    assert warc.read_records(index.where("page_id % 3 = 0")).count() == pages.where("page_id % 3 = 0").count()


def test_archive_of_odd_pages(spark):
    rows = [(1, "http://a b", "x" * 1000), (2, None, "x" * 1000), (3, "u", "y"), (4, "u", "y"), (None, "n%41\n", "x" * 1000), (5, "u", None),
            (2, None, "x" * 1000), (6, "é", "é" * 2_000_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0)).withColumn("size", F.lit(0))
    got = warc.round_trip(df).collect()
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in got) == Counter(
        {(1, "revisit", 2): 1, (2, "response", None): 2, (3, "response", None): 1, (4, "response", None): 1, (None, "response", None): 1,
         (5, "response", None): 1, (6, "response", None): 1})
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in got}[6] == (4_000_000, hashlib.sha1(("é" * 2_000_000).encode()).hexdigest())
    assert warc.round_trip(df.where("false")).count() == 0


def test_ranges_are_merged():
    rows = [("f", 0, 10), ("f", 10, 5), ("f", 100, 5), ("f", 106, 4), ("g", 0, 1)]
    got = [(p, a, b, len(r)) for p, a, b, r in warc.byte_ranges(rows, max_read=50, max_gap=20)]
    assert got == [("f", 0, 15, 2), ("f", 100, 110, 2), ("g", 0, 1, 1)]
    assert [len(r) for *_, r in warc.byte_ranges(rows[:2], max_read=10, max_gap=20)] == [1, 1]


# ---- vectors --------------------------------------------------------------------
@pytest.mark.parametrize("block", [2048, 40])
def test_vectors_as_oracle(spark, block):
    same_as_oracle(vector_dedup.near_duplicates(spark.read.parquet(f"{SF}/embeddings.parquet"), block=block), "embeddings", vector_dedup.ORACLE)


@pytest.mark.parametrize("held,block", [(48, 64), (1, 20), (2, 16)])
def test_groups_of_vectors(spark, monkeypatch, held, block):
    monkeypatch.setattr(vector_dedup, "HELD", held)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 24))
    x[50:150] = x[0] + 0.2 * rng.normal(size=(100, 24))
    x[150:200] = x[1]
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    got = vector_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=block).toPandas().set_index("vec_id")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (u @ u.T >= 0.9) & ~np.eye(300, dtype=bool)
    assert (got.n_links.sort_index().to_numpy() == links.sum(axis=1)).all()
    label = np.arange(300)
    while True:
        new = np.array([min(label[i], label[links[i]].min(initial=300)) for i in range(300)])
        if (new == label).all():
            break
        label = new
    assert (got.component_id.sort_index().to_numpy() == label).all() and (got.kept == (got.index == got.component_id)).all()


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, float("nan")]), (6, [1.0]), (7, [3.0]), (None, [1.0, 0.0]),
            (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1e-200, 1e-200]), (10, [1e300, 1e300]), (11, []), (12, [1.0, None]), (13, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit(0)).withColumn("rep", F.lit(0))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(df).collect()}
    assert got[1] == (3, 1, True) and got[8] == (3, 1, False) and got[7] == (1, 6, False) and got[9] == (1, 9, True) and got[10] == (1, 9, False)
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 11, 12, 13)) and got[None] == (0, None, False)
    assert vector_dedup.near_duplicates(df.where("false")).count() == 0


# ---- pipeline -------------------------------------------------------------------
def brute_lines(rows):
    holders = {}
    for i, text, *_ in rows:
        for line in text.split("\n"):
            key = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
            if len(key) >= 40:
                holders.setdefault(key, set()).add(i)
    frequent = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    for i, text, *rest in rows:
        kept = [x for x in text.split("\n") if frequent.get(re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r")), i) == i]
        yield (i, "\n".join(kept), *rest)


def brute_copies(rows, words, percent):
    sets = {}
    for i, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[i] = {tuple(w[j:j + words]) for j in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((label[a], label[b]))
                for i in ids:
                    if label[i] == y:
                        label[i] = x
    return [r for r in rows if label[r[0]] == r[0]]


def test_pipeline_stages_against_brute_force(spark):
    """Every stage on what the one before it kept; learnt and packed parts by their invariants."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    rows = {0: docs}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        rows[k + 1] = materialise(stage(spark, rows[k], SF), f"test-{name}")
        kept[name] = rows[k + 1]
        if name != "pack":
            assert rows[k + 1].columns == columns
    texts = lambda df: sorted(tuple(r) for r in df.select("doc_id", "text").collect())
    # every clean document has a language; those without a letter go
    assert {r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text)} == {r.doc_id for r in kept["language"].collect()}
    assert texts(kept["lines"]) == sorted(brute_lines(texts(kept["language"])))
    assert texts(kept["copies"]) == sorted(brute_copies(texts(kept["lines"]), words=5, percent=80))
    copies = Counter(r.doc_id for r in kept["mix"].collect())
    taken = {r.doc_id: (r.size, r.taken) for r in mixing.mix(kept["copies"]).collect()}
    assert all(copies[i] == 0 if not size else abs(copies[i] - t / size) <= 0.5 for i, (size, t) in taken.items())
    pieces = kept["pack"].toPandas()
    assert pieces.groupby("doc_id").length.sum().index.tolist() == sorted(copies)
    assert (pieces.groupby("sequence_id").length.sum() <= packing.MAX_TOKENS).all()
    ran = corpus_pipeline.run(spark, SF)
    assert sorted(ran.columns) == sorted(kept["pack"].columns) and ran.count() == len(pieces)
    assert line_dedup.MIN_DOCS == 5


def test_pipeline_stages_on_odd_rows(spark):
    """NULL texts and ids, repeated rows, columns of other names' meaning, an empty table: every stage has a result."""
    long = "many words of one very long text " * 9000
    line = "a line of more than forty characters that five documents share"
    rows = [(1, None, None, None, 0), (2, "", "en", "a", 0), (3, long, "en", "a", len(long)), (3, long, "en", "a", len(long)), (None, "no id but words here", "en", None, 20),
            (4, "12 34", "de", "b", 5)] + [(i, f"{line}\nown words of number {i} and some more", "en", "b", 100) for i in range(10, 16)]
    names = ("n_dropped", "component_id", "hash", "score", "_row", "block", "id")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(-1) for c in names})
    for docs in (df, df.where("false")):
        got = {}
        for name, stage in corpus_pipeline.STAGES:
            after = materialise(stage(spark, docs, SF), f"odd-{name}")
            if name != "pack":
                assert after.columns == df.columns
            got[name], docs = after.collect(), after
        if not got["language"]:
            assert not any(got.values())
            continue
        # texts without letters go; the id-less row and both repeated rows stay until copies are weighed
        assert sorted(str(r.doc_id) for r in got["language"]) == sorted(["3", "3", "None", *map(str, range(10, 16))])
        assert {r.doc_id: r.text.startswith(line) for r in got["lines"] if (r.doc_id or 0) >= 10} == {i: i == 15 for i in range(10, 16)}
        assert [r.doc_id for r in got["copies"]].count(3) == 2 and None in [r.doc_id for r in got["copies"]]
        assert sum(r.length for r in got["pack"] if r.start == 0) > 0


def test_copies_stage_takes_five_words_and_four_fifths(spark):
    """One word changed in L distinct ones: 5-word Jaccard (L - 9) / (L + 1), so 0.8 at L = 49; the 3-word value is below 0.9 until 59."""
    sizes = (47, 48, 49, 50, 53, 58, 59, 80)
    rows = []
    for k, size in enumerate(sizes):
        words = [f"w{k}x{j}" for j in range(size)]
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(words[:20] + ["other"] + words[21:]))]
    df = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id for r in corpus_pipeline.copies(spark, df, SF).collect()}
    assert left == {10 * k for k in range(len(sizes))} | {10 * k + 1 for k, size in enumerate(sizes) if size < 49}
    # and the given rows, by all pairs
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sets = {}
    for i, text in docs.select("doc_id", "text").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((label[a], label[b]))
                label = {i: x if v == y else v for i, v in label.items()}
    assert sorted(r.doc_id for r in corpus_pipeline.copies(spark, docs, SF).collect()) == sorted(i for i in sets if label[i] == i)
