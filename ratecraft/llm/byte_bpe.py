"""Byte-level BPE encoding and decoding.

The ranks of a public vocabulary become a model of the tokenizers library: each
byte is written as one printable character, and a pair may merge if its bytes
together are in the vocabulary, at that entry's rank.  Texts are split by the
public pattern and every match is encoded by itself, so the ids are those that
the ranks alone define.

Tasks encode Arrow batches.  A long text is cut where a match certainly ends (in
front of white space or of full-width punctuation that follows a letter), which
changes no id and bounds the memory; only a single match is never cut.  Offsets
count characters of the whole text; the tokens of a character that is split
between several have its place each.

Decoding turns ids into bytes by the reversed table, for all ids of a batch at
once.  Bytes are joined before they are read as characters, so a split character
comes back whole; ``pieces`` gives it to the token that ends it.  Bytes that are
no UTF-8 (a document cut amid a character) are U+FFFD in text and stay as they
are in ``decoded``.

Defined cases: a NULL or empty text has no tokens and decodes to nothing; a NULL
doc_id is kept; repeated rows are encoded each; strings of special tokens are
ordinary text; bytes of a text that are no UTF-8 count as U+FFFD; ids outside of
the vocabulary decode to nothing and are counted (``n_unknown``); other columns
are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import codecs
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.arrow_text import ragged, slices
from ratecraft.llm.common import tokenizer_path

RANKS = "byte_bpe_50k.tiktoken"
_RUN = 1 << 20             # bytes of text encoded at a time
_PART = 1 << 18            # characters after which a long text may be cut
_IDS = 1 << 19             # ids decoded at a time

# ---- fixed values: the public pattern, white space as it counts it, full-width punctuation ----
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WIDE = "\\u3001\\u3002\\uff01\\uff0c\\uff1a\\uff1b\\uff1f"
# -----------------------------------------------------------------------------------------------
_CUT = re.compile(f"(?<=[^{_SPACE}])(?=[{_SPACE}])|(?<=[^\\W_])(?=[{_WIDE}])")


def byte_characters() -> list[str]:
    """The printable character of each byte: itself where it is one, else the next from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = (b for b in range(256) if b not in own)
    table = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteTokenizer:
    """Encodes and decodes by the ranks at ``path``."""

    def __init__(self, path: str, pattern: str = PATTERN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks, shown = read_ranks(path), byte_characters()
        show = lambda token: "".join(shown[b] for b in token)
        pairs = [(show(token[:i]), show(token[i:])) for token in sorted(ranks, key=ranks.get) for i in range(1, len(token))
                 if token[:i] in ranks and token[i:] in ranks]
        self.tokenizer = Tokenizer(models.BPE(vocab={show(t): r for t, r in ranks.items()}, merges=pairs, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # the reversed table: bytes of all tokens by id, one after the other
        hidden = {c: b for b, c in enumerate(shown)}
        tokens = {i: bytes(hidden[c] for c in t) for t, i in self.tokenizer.get_vocab().items()}
        sizes = [len(tokens.get(i, b"")) for i in range(max(tokens, default=-1) + 1)]
        self.known = np.array([i in tokens for i in range(len(sizes))] + [False])
        self.sizes = np.array(sizes + [0], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)

    def encode(self, texts: list[str], offsets: bool) -> list[tuple[np.ndarray, ...]]:
        """Per text its ids or, with ``offsets``, (ids, starts, ends) in characters."""
        parts = [(k, at, part) for k, text in enumerate(texts) for at, part in cut(text)]
        run = self.tokenizer.encode_batch if offsets else self.tokenizer.encode_batch_fast
        found = [[] for _ in texts]
        for (k, at, _), code in zip(parts, run([p for _, _, p in parts], add_special_tokens=False), strict=True):
            columns = [np.array(code.ids, np.int32)]
            if offsets:
                columns += list(np.array(code.offsets, np.int64).reshape(-1, 2).T + at)
            found[k].append(columns)
        width = 3 if offsets else 1
        return [tuple(np.concatenate([p[c] for p in of] or [np.zeros(0, np.int64)]) for c in range(width)) for of in found]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after the other."""
        outside = len(self.sizes) - 1
        ids = np.where((ids >= 0) & (ids < outside), ids, outside)
        return self.bytes[ragged(self.starts[ids], self.sizes[ids])]

    def unknown(self, ids: np.ndarray) -> np.ndarray:
        outside = len(self.sizes) - 1
        return ~self.known[np.where((ids >= 0) & (ids < outside), ids, outside)]


def cut(text: str, size: int = _PART) -> list[tuple[int, str]]:
    """(first character, part): a text in parts of about ``size`` characters that are encoded by themselves."""
    parts, at = [], 0
    while len(text) - at > size and (end := _CUT.search(text, at + size)) and end.start() < len(text):
        parts.append((at, text[at:end.start()]))
        at = end.start()
    return [*parts, (at, text[at:])] if text else []


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *values]), kind))


def encode(docs: DataFrame, path: str | None = None, offsets: bool = True) -> DataFrame:
    """(doc_id, ids) of every row, with ``offsets`` also (starts, ends): each token's place in characters."""
    path = path or tokenizer_path(RANKS)

    def run(batches):
        tokenizer = ByteTokenizer(path)
        for batch in batches:
            for part in slices(batch, "text", _RUN):
                texts = [(b or b"").decode("utf-8", "replace") for b in part.column("text").cast(pa.binary()).to_pylist()]
                columns = [list(c) for c in zip(*tokenizer.encode(texts, offsets), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[_lists(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.int64()))]],
                    ["doc_id", "ids", "starts", "ends"][:len(columns) + 1])

    more = ", starts array<long>, ends array<long>" if offsets else ""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, ids array<int>{more}")


def token_texts(tokens: list[bytes]) -> list[str]:
    """The characters that each token ends: those of a split character come with the last of its tokens."""
    reader = codecs.getincrementaldecoder("utf-8")("replace")
    return [reader.decode(t, final=i == len(tokens) - 1) for i, t in enumerate(tokens)]


def decode(tokens: DataFrame, path: str | None = None, text: bool = True, pieces: bool = False) -> DataFrame:
    """(doc_id, ids, decoded, n_unknown) of rows (doc_id, ids); ``text`` and ``pieces`` (characters by token) if asked for.

    A NULL list counts as an empty one."""
    path = path or tokenizer_path(RANKS)
    names = ["doc_id", "ids", "decoded", "n_unknown", *["text"] * text, *["pieces"] * pieces]

    def run(batches):
        tokenizer = ByteTokenizer(path)
        for batch in batches:
            lists = batch.column("ids")
            ids = np.asarray(pc.fill_null(lists.flatten(), -1)).astype(np.int64)
            ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)).astype(np.int64))
            starts = np.concatenate([[0], ends[:-1]])
            bad = np.concatenate([[0], np.cumsum(tokenizer.unknown(ids))])
            rows = [b"".join(tokenizer.decode(ids[i:min(i + _IDS, b)]).tobytes() for i in range(a, b, _IDS))
                    for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            out = [batch.column("doc_id"), lists, pa.array(rows, pa.binary()), pa.array(bad[ends] - bad[starts])]
            if text:
                out.append(pa.array([r.decode("utf-8", "replace") for r in rows], pa.string()))
            if pieces:
                out.append(pa.array([token_texts([tokenizer.decode(ids[i:i + 1]).tobytes() for i in range(a, b)])
                                     for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(out, names)

    kinds = {"text": "string", "pieces": "array<string>"}
    more = "".join(f", {c} {kinds[c]}" for c in names[4:])
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id long, ids array<int>, decoded binary, n_unknown long{more}")


def round_trip_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The contract's columns: every text is encoded, and its ids decoded again."""
    back = decode(encode(docs, path, offsets=False), path, text=False)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
