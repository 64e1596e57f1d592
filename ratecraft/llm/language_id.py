"""Language ID by unigrams of vocabulary pieces, summed over all segmentations.

A text is lower-cased and its runs of letters are its words.  Each language has
a probability for every piece of a fixed public vocabulary; a word's probability
is the sum over all ways to cut it into pieces, found by the forward algorithm.
Words are independent, so a text's log probability is the sum over its words and
every distinct word of a batch is scored once, all words of a length together.

Training is expectation maximisation (forward-backward) on word counts of at
most about ``sample_docs`` documents per language, chosen by a hash of the text.
Words over ``LONG_WORD`` letters count like all others, by sums in logarithms.
The model has one number per piece and language.

Defined cases: a NULL text or one without letters is ``und`` with score 0; so is
everything if no row can be learnt from; a NULL doc_id counts as the empty text
in the held-out rule; ties go to the language first by code point; characters
outside the vocabulary have one small probability in all languages; extra
columns are ignored (``keep_identified`` keeps them).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.arrow_text import slices
from ratecraft.llm.common import materialise, tokenizer_path
from ratecraft.llm.shingles import _ODD, _ODD_INVERSE, _powers, mixed

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_DOCS = 500      # documents per language, on average, that the model is fitted on
ROUNDS = 3
SMOOTHING = 0.1         # added to every expected count
UNKNOWN = 1e-7          # probability of a character outside the vocabulary
UND = "und"
CACHED_WORDS = 150_000  # per task
LONG_WORD = 24          # letters; longer words go one by one, without underflow and in time proportional to their length
_RUN = 2 << 20          # bytes of text worked on at a time


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def vocabulary(path: str) -> list[str]:
    """The pieces that can make up lower-case words, word starts marked by U+2581."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({model.id_to_piece(i).lower() for i in ids})


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, index of every word of all texts, number of words of each text)."""
    letters = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{M}]+", " ")
    split = pc.ascii_split_whitespace(pc.utf8_trim(letters, " "))
    coded = split.flatten().dictionary_encode()
    counts = np.asarray(pc.list_value_length(split)).astype(np.int64)
    which = np.asarray(coded.indices).astype(np.int64)
    # a text without letters splits into one empty word; marks alone are no word
    word = pc.match_substring_regex(coded.dictionary, r"\p{L}") if len(coded.dictionary) else pa.array([], pa.bool_())
    word = np.asarray(word).astype(bool)
    keep = word[which]
    owner = np.repeat(np.arange(len(counts)), counts)[keep]
    renumber = np.cumsum(word) - 1
    return coded.dictionary.filter(pa.array(word)), renumber[which[keep]], np.bincount(owner, minlength=len(counts))


class Segmenter:
    """Piece numbers of all substrings of words."""

    def __init__(self, pieces: list[str]):
        points, sizes = self._points(pieces)
        hashes = self._hashes(points, np.cumsum(sizes) - sizes, np.cumsum(sizes))
        order = np.argsort(hashes)
        self.hashes, self.number = hashes[order], order
        self.longest = int(sizes.max())
        self.unknown = len(pieces)

    @staticmethod
    def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32), sizes

    @staticmethod
    def _sums(points: np.ndarray) -> np.ndarray:
        codes = mixed((points.astype(np.uint64) + np.uint64(1)) * _ODD)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _powers(_ODD, len(points)))])

    @classmethod
    def _hashes(cls, points, starts, stops) -> np.ndarray:
        sums = cls._sums(points)
        return mixed((sums[stops] - sums[starts]) * _powers(_ODD_INVERSE, len(points) + 1)[starts] + (stops - starts).astype(np.uint64))

    def groups(self, words: list[str], most: int = 1 << 19):
        """(positions, spans) of words of one length: spans[i, j] numbers the piece [i, j) of each word.

        A number is -1 where there is no such piece; single characters without
        one are ``unknown``.
        """
        points, sizes = self._points(["▁" + w for w in words])
        first, sums = np.cumsum(sizes) - sizes, self._sums(points)
        back = _powers(_ODD_INVERSE, len(points) + 1)
        order = np.argsort(sizes, kind="stable")
        for size in np.unique(sizes).tolist():
            same = order[np.searchsorted(sizes[order], size):np.searchsorted(sizes[order], size, side="right")]
            step = max(1, most // (size * min(size, self.longest)))
            for at in range(0, len(same), step):
                part = same[at:at + step]
                spans = {}
                for i in range(size):
                    for j in range(i + 1, min(size, i + self.longest) + 1):
                        a, b = first[part] + i, first[part] + j
                        h = mixed((sums[b] - sums[a]) * back[a] + np.uint64(j - i))
                        spot = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                        number = np.where(self.hashes[spot] == h, self.number[spot], -1)
                        if j == i + 1:
                            number[number < 0] = self.unknown
                        if (number >= 0).any():
                            spans[i, j] = number
                yield part, size, spans

    def of_word(self, word: str):
        """(characters of a marked word, function giving (starts, numbers) of its pieces that may end before j)."""
        points, sizes = self._points(["▁" + word])
        sums, back = self._sums(points), _powers(_ODD_INVERSE, len(points) + 1)

        def ending(j: int) -> tuple[np.ndarray, np.ndarray]:
            i = np.arange(max(0, j - self.longest), j)
            h = mixed((sums[j] - sums[i]) * back[i] + (j - i).astype(np.uint64))
            spot = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            number = np.where(self.hashes[spot] == h, self.number[spot], -1)
            if number[-1] < 0:
                number[-1] = self.unknown
            return i, number

        return int(sizes[0]), ending


def _by_length(words: list[str], most: int = LONG_WORD) -> tuple[list, list]:
    short = [(i, w) for i, w in enumerate(words) if len(w) <= most]
    return short, [(i, w) for i, w in enumerate(words) if len(w) > most]


def forward(size: int, spans: dict, p: np.ndarray, n: int) -> np.ndarray:
    """alpha[j] (words x languages): probability of a word's first j characters over all segmentations."""
    alpha = np.zeros((size + 1, n, p.shape[1]))
    alpha[0] = 1.0
    longest = max(j - i for i, j in spans)
    for j in range(1, size + 1):
        for i in range(max(0, j - longest), j):
            if (i, j) in spans:
                alpha[j] += alpha[i] * p[spans[i, j]]
    return alpha


def expected_counts(words: list[str], weights: np.ndarray, segmenter: Segmenter, p: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece in weighted words of one language (p: one column)."""
    counts = np.zeros(len(p))
    short, long = _by_length(words)
    own = np.array([weights[i] for i, _ in short])
    for part, size, spans in segmenter.groups([w for _, w in short]):
        alpha = forward(size, spans, p, len(part))[:, :, 0]
        beta = np.zeros_like(alpha)
        beta[size] = 1.0
        longest = max(j - i for i, j in spans)
        for i in range(size - 1, -1, -1):
            for j in range(i + 1, min(size, i + longest) + 1):
                if (i, j) in spans:
                    beta[i] += beta[j] * p[spans[i, j], 0]
        scale = own[part] / np.maximum(alpha[size], 1e-300)
        for (i, j), number in spans.items():
            counts += np.bincount(np.where(number < 0, 0, number), alpha[i] * beta[j] * p[number, 0] * scale * (number >= 0),
                                  minlength=len(p))
    for i, w in long:
        _add_long(counts, w, weights[i], segmenter, p[:, 0])
    return counts


def _add_long(counts: np.ndarray, word: str, weight: float, segmenter: Segmenter, p: np.ndarray) -> None:
    """Add a long word's expected counts, by forward and backward values in logarithms."""
    with np.errstate(divide="ignore"):
        log_p = np.log(p)                                # -inf for no piece
    size, ending = segmenter.of_word(word)
    alpha, beta = np.full(size + 1, -np.inf), np.full(size + 1, -np.inf)
    alpha[0] = beta[size] = 0.0
    for j in range(1, size + 1):
        i, number = ending(j)
        alpha[j] = np.logaddexp.reduce(alpha[i] + log_p[number])
    if not np.isfinite(alpha[size]):
        return
    for j in range(size, 0, -1):                         # all that starts at j has been added to beta[j]
        i, number = ending(j)
        after = log_p[number] + beta[j]
        beta[i] = np.logaddexp(beta[i], after)
        np.add.at(counts, number, np.where(number < 0, 0.0, weight * np.exp(alpha[i] + after - alpha[size])))


def _with_limits(probabilities: np.ndarray) -> np.ndarray:
    """Rows for unknown characters (one before the last) and for no piece (the last, number -1)."""
    n = probabilities.shape[1]
    return np.vstack([probabilities, np.full((1, n), UNKNOWN), np.zeros((1, n))])


def fit(docs: DataFrame, path: str | None = None, sample_docs: int = SAMPLE_DOCS, rounds: int = ROUNDS) -> tuple[list[str], list[str], np.ndarray]:
    """(languages, pieces, probabilities): learnt from text and lang of the rows that are not held out."""
    pieces = vocabulary(path or tokenizer_path(VOCABULARY))
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    totals = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}    # one row per language
    languages = sorted(totals, key=lambda x: x.encode())
    if not languages:
        return [], pieces, np.zeros((len(pieces), 0))
    shares = [min(1.0, sample_docs / totals[lang]) for lang in languages]
    share = F.coalesce(F.try_element_at(F.map_from_arrays(F.lit(languages), F.lit(shares)), F.col("lang")), F.lit(0.0))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)

    def count(batches):
        for batch in batches:
            for run in slices(batch, "text", _RUN):
                words, which, counts = words_of(run.column("text"))
                lang = run.column("lang").dictionary_encode()
                key = np.repeat(np.asarray(lang.indices).astype(np.int64), counts) * max(1, len(words)) + which
                key, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(key // max(1, len(words)))), words.take(pa.array(key % max(1, len(words)))),
                     pa.array(n.astype(np.int64))], ["lang", "word", "n"])

    counted = materialise(rows.where(draw < share).mapInArrow(count, "lang string, word string, n long")
                          .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    probabilities = np.full((len(pieces), len(languages)), 1.0 / len(pieces))

    for _ in range(rounds):
        p = _with_limits(probabilities)

        def expect(batches, p=p):
            segmenter, totals = Segmenter(pieces), np.zeros_like(p)
            for batch in batches:
                lang = np.asarray(pc.index_in(batch.column("lang"), pa.array(languages)))
                words, weights = np.array(batch.column("word").to_pylist(), object), np.asarray(batch.column("n")).astype(float)
                for k in np.unique(lang):
                    own = lang == k
                    totals[:, k] += expected_counts(words[own].tolist(), weights[own], segmenter, p[:, k:k + 1])
            piece, lang = np.nonzero(totals[:len(pieces)])
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(totals[piece, lang])], ["piece", "lang", "n"])

        # one row per piece and language at most
        sums = counted.mapInArrow(expect, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full_like(probabilities, SMOOTHING)
        counts[sums["piece"], sums["lang"]] += sums["n"]
        probabilities = counts / counts.sum(axis=0)
    return languages, pieces, probabilities


class Classifier:
    def __init__(self, languages: list[str], pieces: list[str], probabilities: np.ndarray):
        self.languages, self.pieces = languages, pieces
        self.p = _with_limits(probabilities)
        self.segmenter = None
        self._forget()

    def _forget(self) -> None:
        """Log probabilities of the words met so far, a row each."""
        self.words, self.logs = pa.array([], pa.string()), np.zeros((0, len(self.languages)))

    def _learn(self, words: pa.Array) -> None:
        logs = np.zeros((len(words), len(self.languages)))
        short, long = _by_length(words.to_pylist())
        for part, size, spans in self.segmenter.groups([w for _, w in short]):
            index = np.array([short[i][0] for i in part.tolist()])
            logs[index] = np.log(np.maximum(forward(size, spans, self.p, len(part))[size], 1e-300))
        for i, w in long:
            logs[i] = self._long(w)
        self.words, self.logs = pa.concat_arrays([self.words, words]), np.concatenate([self.logs, logs])

    def __call__(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, posterior probability under equal priors) of each text."""
        self.segmenter = self.segmenter or Segmenter(self.pieces)
        words, which, counts = words_of(texts)
        if not self.languages or not len(words):
            return [UND] * len(texts), np.zeros(len(texts))
        if len(self.words) > CACHED_WORDS:
            self._forget()
        new = words.filter(pc.is_null(pc.index_in(words, value_set=self.words)))
        if len(new):
            self._learn(new)
        logs = self.logs[np.asarray(pc.index_in(words, value_set=self.words)).astype(np.int64)]
        # reduceat has no empty sums: only texts with words take part
        known = counts > 0
        total = np.zeros((len(counts), len(self.languages)))
        total[known] = np.add.reduceat(logs[which], (np.cumsum(counts) - counts)[known], axis=0)
        best = total.argmax(axis=1)
        score = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.languages[b] if k else UND for b, k in zip(best, known, strict=True)], np.where(known, score, 0.0)

    def _long(self, word: str) -> np.ndarray:
        """Log probabilities of a long word, with the forward values rescaled on the way."""
        size, ending = self.segmenter.of_word(word)
        alpha, scale = np.zeros((size + 1, self.p.shape[1])), np.zeros(self.p.shape[1])
        alpha[0] = 1.0
        for j in range(1, size + 1):
            i, number = ending(j)
            alpha[j] = (alpha[i] * self.p[number]).sum(axis=0)
            top = alpha[j].max()
            if 0 < top < 1e-100:
                alpha[max(0, j - self.segmenter.longest):j + 1] /= top
                scale += np.log(top)
        return np.log(np.maximum(alpha[size], 1e-300)) + scale


def predict(docs: DataFrame, model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    classify = Classifier(*model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", _RUN):
                lang, score = classify(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                                                 ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model, min_score: float = 0.5) -> DataFrame:
    """The rows whose language is found with at least ``min_score``, all columns as they are."""
    classify = Classifier(*model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", _RUN):
                lang, score = classify(part.column("text"))
                yield part.filter(pa.array([name != UND and s >= min_score for name, s in zip(lang, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, **options) -> DataFrame:
    return predict(docs, fit(docs, **options))
