"""Best-fit packing of token sequences under several capacities.

A bin (sequence) has three capacities: tokens, documents and attention cost (the sum of squared
piece lengths). Pieces are taken from long to short; each goes to the open bin that fits it under
every constraint with the least weighted norm of what would remain, else to a new bin. All pieces
of one length are placed at once: after a bin takes a piece it is the tightest still, so filling
bins in the order of their norms is the same as placing one by one.

Texts are tokenised once; the slim table of pieces (no text) is written to the shared folder with
a 64-bit hash of each piece. Packing then needs no global state: pieces are dealt out uniformly, by that hash,
into groups of about ``group_pieces``, and each group is packed by one task. A group of 65,536
pieces fills over ten thousand bins, so the bins left part-filled at its end do not count.

Tokenising caches words: texts of Latin-1 characters are cut into words by the tokenizer's own
rule and each distinct word is encoded once a worker (a bounded cache); any other text goes to
the tokenizer whole. Both ways give the same ids, which the tests hold against each other.

Defined cases: null text is empty: one piece of the end id; an empty table packs into no bins;
repeated rows and null ids are packed one by one; a longer document is cut into full bins and a rest;
of bins that fit equally well the oldest takes the piece; other columns are left out.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import materialize
from .common import numbered, small_batches, table, tidied

MAX_TOKENS = 4096
END_ID = 1
GROUP_PIECES = 1 << 16
#: Words that a worker remembers before it forgets them all.
CACHE = 600_000

#: Texts of these characters only are in NFC and lower-cased letter by letter alike everywhere.
PLAIN = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xff]")
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\t\n\r a-z0-9ªµºß-öø-ÿ²³¹¼½¾]+")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Places(dict):
    """A place for each word, given out as words are asked for; new: those that have no ids yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        k = self[word] = len(self)
        self.new.append(word)
        return k


class Encoder:
    """Token ids of whole texts; words: cut texts into words by WORD (for the word_bpe_49k file alone).

    The ids of all words seen lie in one flat array; a text's ids are gathered from there at once.
    """

    def __init__(self, path: str, words: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.words = Tokenizer.from_file(path), words
        # for words that are cut and lower-cased already: the same model behind a split at spaces
        self.model = Tokenizer.from_file(path)
        self.model.normalizer = normalizers.Sequence([])
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[k for w, k in vocabulary.items() if w.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.places, self.known = Places(), 0
        self.ids, self.starts = np.zeros(1 << 16, dtype=np.uint32), np.zeros(1 << 16, dtype=np.int64)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    @staticmethod
    def _room(x: np.ndarray, n: int) -> np.ndarray:
        return x if len(x) >= n else np.concatenate([x, np.zeros(max(n, len(x)), dtype=x.dtype)])

    def learn(self) -> None:
        """Encodes new words as texts of many, a space after each; the last token of a word says so."""
        new, self.places.new = self.places.new, []
        for at in range(0, len(new), 1_000):
            part = new[at : at + 1_000]
            ids = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype=np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part):
                raise ValueError("words and tokens do not agree")
            first = int(self.starts[self.known])
            self.ids = self._room(self.ids, first + len(ids))
            self.ids[first : first + len(ids)] = ids
            self.starts = self._room(self.starts, self.known + len(part) + 1)
            self.starts[self.known + 1 : self.known + len(part) + 1] = first + ends
            self.known += len(part)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        cut, odd, rows = [], [], []
        if self.known > CACHE:
            self.forget()
        place = self.places.__getitem__
        for i, t in enumerate(texts):
            if self.words and not PLAIN.search(t) and "<|" not in t:
                found = WORD.findall(t.lower())
                cut.append(i)
                rows.append(np.fromiter(map(place, found), dtype=np.int64, count=len(found)))
            else:
                odd.append(i)
        self.learn()
        for i, k in zip(cut, rows, strict=True):
            begins, sizes = self.starts[k], self.starts[k + 1] - self.starts[k]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            out[i] = self.ids[np.arange(total) + np.repeat(begins - ends + sizes, sizes)]
        for i, ids in zip(odd, self.whole([texts[i] for i in odd]) if odd else [], strict=True):
            out[i] = ids
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str) -> Encoder:
    key = (path, os.path.basename(path) == "word_bpe_49k.json")
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, max_tokens: int = MAX_TOKENS, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): every document cut into pieces, the end id included."""
    path = path or tokenizer_path()

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in batches:
            at, piece, start, length, crc, body = [], [], [], [], [], []
            for i, ids in enumerate(encode([t or "" for t in b.column(1).to_pylist()])):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for k, s in enumerate(range(0, len(ids), max_tokens)):
                    part = ids[s : s + max_tokens]
                    at.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        body.append(part.astype(np.int32))
            cols = [b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                cols.append(pa.array(body, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=["id", "piece", "start", "length", "ids_crc32", "ids"][: len(cols)])

    schema = f"id {dict(docs.dtypes)[id_col]}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return small_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, *, max_tokens: int = MAX_TOKENS, max_docs: int | None = None, max_cost: int | None = None, weights: tuple[float, float, float] = (1.0, 1e-4, 1e-4)) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each piece. max_docs, max_cost None: no bound beside max_tokens.

    A piece that breaks a capacity by itself gets a bin of its own.
    """
    docs_cap, cost_cap = max_docs or max_tokens, max_cost or max_tokens**2
    caps = np.array([max_tokens, docs_cap, cost_cap], dtype=float)
    n = len(lengths)
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    if not n:
        return bins, offsets
    order = np.argsort(-lengths, kind="stable")
    sizes, firsts, counts = np.unique(-lengths[order], return_index=True, return_counts=True)
    shortest = int(lengths.min())
    used = np.zeros((n, 3), dtype=np.int64)  # of every bin: tokens, documents, cost
    open_bins, made = np.zeros(0, dtype=np.int64), 0
    for size, first, count in zip(-sizes, firsts, counts, strict=True):
        size, items = int(size), order[first : first + count]
        each = np.array([size, 1, size * size])
        room = (np.array([max_tokens, docs_cap, cost_cap]) - used[open_bins]) // each
        fits = room.min(axis=1) if len(open_bins) else np.zeros(0, dtype=np.int64)
        feasible = np.flatnonzero(fits > 0)
        if len(feasible):
            left = (np.array([max_tokens, docs_cap, cost_cap]) - used[open_bins[feasible]] - each) / caps
            best = feasible[np.argsort((left * left) @ np.array(weights), kind="stable")]
            take = fits[best]
            before = np.cumsum(take) - take
            take = np.clip(count - before, 0, take)
        else:
            best, take = feasible, feasible
        rest = int(count - take.sum())
        whole = max(1, min(max_tokens // size, docs_cap, cost_cap // (size * size)))
        fresh = -(-rest // whole)
        chosen = np.concatenate([open_bins[best], np.arange(made, made + fresh)])
        share = np.concatenate([take, np.full(fresh, whole, dtype=np.int64)])
        if fresh:
            share[-1] = rest - whole * (fresh - 1)
        to = np.repeat(chosen, share)
        rank = np.arange(count) - np.repeat(np.cumsum(share) - share, share)
        bins[items], offsets[items] = to, used[to, 0] + rank * size
        used[chosen] += share[:, None] * each
        open_bins = np.concatenate([open_bins, np.arange(made, made + fresh)])
        made += fresh
        open_bins = open_bins[(used[open_bins, 0] + shortest <= max_tokens) & (used[open_bins, 1] < docs_cap)]
    return bins, offsets


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, max_tokens: int = MAX_TOKENS, max_docs: int | None = None, max_cost: int | None = None, group_pieces: int = GROUP_PIECES, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    cut = pieces(docs, id_col=id_col, text_col=text_col, path=path, max_tokens=max_tokens, with_ids=with_ids)
    if with_ids:
        cut = cut.withColumn("body", F.xxhash64("ids"))
    cut = materialize(cut, "slices")
    by = ["id", "piece", "start", "length", "ids_crc32", *["body"] * with_ids]
    # equal pieces stand for each other and are told apart by number, so the dealing depends on the pieces alone
    cut = materialize(numbered(cut, by).withColumn("u", F.xxhash64(*by, "_copy")).drop("_copy", "body"), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))

    @tidied
    def place(key, t):
        lengths = t.column("length").to_numpy()
        order = np.lexsort((t.column("piece").to_numpy(), t.column("u").to_numpy()))
        bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
        bins[order], offsets[order] = best_fit(lengths[order], max_tokens=max_tokens, max_docs=max_docs, max_cost=max_cost)
        out = t.select([c for c in t.column_names if c not in ("u", "group")])
        return out.append_column("sequence_id", pa.array(bins + (key[0].as_py() << 40))).append_column("offset", pa.array(offsets))

    body = ", ids array<int>" * with_ids
    out = cut.withColumn("group", F.pmod("u", F.lit(groups))).groupBy("group").applyInArrow(place, f"id {dict(docs.dtypes)[id_col]}, piece int, start long, length long, ids_crc32 long{body}, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from pack(..., with_ids=True); a sequence is bounded by its capacity."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
