"""Language identification by word-first backoff.

A known word scores its log frequency in each language. An unseen word falls back to its
longest known character n-grams (5 down to 1, with word-edge marks): the mean log frequency of
the known n-grams of that one length. A text gets the language of the largest sum.

The model is fitted on a bounded sample of labelled rows: about ``sample_docs`` texts a language,
drawn by a hash of doc_id and text (a filter, no sort and no group in one task), counted in the
executors and summed by a shuffle. Its size is bounded by ``max_words`` and ``max_grams``, of which
each language has an equal share for its own most frequent pieces (the last ones, of one count, by a
hash), found from the histogram of its counts: a language of few rows keeps all its pieces. So the
broadcast model does not grow with the corpus. Every text is scored whole.

The language is that of the largest sum over all words. The score is its share of each single word's
probability, on the mean over the words: a sum over hundreds of words would be certain of anything, even of a
text half in one language and half in another, or in none of them.

Defined cases: null text, or text without a letter, is ``und`` with score 0; without any labelled
row everything is ``und``; rows with a null label or text never train; a tie goes to the language
that sorts first; repeated rows get equal answers; very long texts count whole; an empty table gives no rows;
other columns are untouched, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.store import discard, materialize
from .common import small_batches, table, tidied

MAX_GRAM = 5
SAMPLE_DOCS = 2_000
MAX_WORDS = 200_000
MAX_GRAMS = 200_000
#: Unseen words remembered by a worker before it forgets them all.
MEMO = 200_000
ALPHA = 0.05
UNDETERMINED = "und"

RUNS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return RUNS.findall(text.lower())


def has_letter(runs: list[str]) -> bool:
    """\\w also holds digits such as superscripts, which are no letters."""
    return any(w.isalpha() or any(map(str.isalpha, w)) for w in runs)


def grams(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    w = f"\x02{word}\x03"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


class Model:
    """words: word -> row of word_scores; levels[n]: n-gram -> row, and scores. counts: pieces and a matrix of counts, one column a language."""

    def __init__(self, langs: list[str], word_counts: tuple[list[str], np.ndarray], gram_counts: tuple[list[str], np.ndarray]):
        self.langs = langs
        self.words, self.word_scores = self._scores(*word_counts)
        pieces, counts = gram_counts
        sizes = np.array([len(g) for g in pieces], dtype=np.int64)
        self.levels = {}
        for n in range(1, MAX_GRAM + 1):
            at = np.flatnonzero(sizes == n)
            self.levels[n] = self._scores([pieces[i] for i in at], counts[at])

    @staticmethod
    def _scores(pieces: list[str], counts: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
        m = counts + ALPHA
        if len(pieces):
            m = np.log(m / m.sum(axis=0, keepdims=True))
        return {w: i for i, w in enumerate(pieces)}, m.astype(np.float32)

    def backoff(self, word: str) -> np.ndarray:
        for n in range(min(MAX_GRAM, len(word) + 2), 0, -1):
            rows, scores = self.levels[n]
            known = [rows[g] for g in grams(word, n) if g in rows]
            if known:
                return scores[known].mean(axis=0)
        return np.zeros(len(self.langs), dtype=np.float32)

    def scorer(self):
        return Scorer(self)


class Scorer:
    """Answers for one worker: its memo of unseen words is bounded."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.rows = dict(self.model.words)
        self.fill = len(self.model.words)
        self.scores = np.vstack([self.model.word_scores.reshape(len(self.model.words), len(self.model.langs)), np.zeros((1024, len(self.model.langs)), dtype=np.float32)])

    def _row(self, word: str) -> int:
        k = self.rows.get(word)
        if k is None:
            if self.fill == len(self.scores):
                self.scores = np.vstack([self.scores, np.zeros_like(self.scores[: max(1024, len(self.scores) // 2)])])
            k, self.rows[word] = self.fill, self.fill
            self.scores[k] = self.model.backoff(word)
            self.fill += 1
        return k

    def __call__(self, text: str | None) -> tuple[str, float]:
        runs = words(text) if text else []
        if not self.model.langs or not has_letter(runs):
            return UNDETERMINED, 0.0
        if self.fill > len(self.model.words) + MEMO:
            self._forget()
        get, row = self.rows.get, self._row
        rows = np.fromiter([k if (k := get(w)) is not None else row(w) for w in runs], dtype=np.int64, count=len(runs))
        total = self.scores[rows].sum(axis=0, dtype=np.float64)
        best = int(total.argmax())
        own = self.scores[rows]
        each = np.exp(own - own.max(axis=1, keepdims=True))
        return self.model.langs[best], float((each[:, best] / each.sum(axis=1)).mean(dtype=np.float64))


def held_out(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2


@tidied
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        by: dict[str, Counter] = {}
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
            by.setdefault(lang, Counter()).update(words(text))
        for lang, c in by.items():
            g: Counter = Counter()
            for w, k in c.items():
                for n in range(1, MAX_GRAM + 1):
                    for x in grams(w, n):
                        g[x] += k
            for is_word, counts in ((True, c), (False, g)):
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(counts), "is_word": [is_word] * len(counts), "piece": list(counts), "n": list(counts.values())}, schema=pa.schema([("lang", pa.string()), ("is_word", pa.bool_()), ("piece", pa.string()), ("n", pa.int64())]))


def least_level(sizes: dict[int, int], most: int) -> tuple[int, float]:
    """(count, part): all pieces of a higher count and that part of those with this one fill a share of most pieces; (0, 0) if all fit."""
    for n in sorted(sizes, reverse=True):
        if sizes[n] > most:
            return n, most / sizes[n]
        most -= sizes[n]
    return 0, 0.0


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """A model from the rows of labelled that have a text and a label."""
    d = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    per = {r.lang: r.n for r in d.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not per:
        return Model([], ([], np.zeros((0, 0))), ([], np.zeros((0, 0))))
    langs = sorted(per)
    share = F.element_at(F.create_map(*[x for k, n in per.items() for x in (F.lit(k), F.lit(min(1.0, sample_docs / n)))]), F.col("lang"))
    sample = d.filter(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < share * F.lit(1 << 30)).select("lang", "text")
    counts = small_batches(sample).mapInArrow(_count, "lang string, is_word boolean, piece string, n long").groupBy("is_word", "piece").agg(F.sum("n").alias("total"), *[F.coalesce(F.sum(F.when(F.col("lang") == k, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, k in enumerate(langs)])
    counts = materialize(counts, "langid")
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"n{i}").alias("n")) for i in range(len(langs))]))
    sizes = counts.select("is_word", each.alias("x")).filter("x.n > 0").groupBy("is_word", "x.i", "x.n").count().collect()
    chance = F.pmod(F.xxhash64("piece"), F.lit(1 << 30))
    found = []
    for is_word, most in ((True, max_words), (False, max_grams)):
        keep = F.lit(False)
        for i in range(len(langs)):
            level, part = least_level({r.n: r["count"] for r in sizes if r.is_word == is_word and r.i == i}, max(1, most // len(langs)))
            keep |= (F.col(f"n{i}") > level) | ((F.col(f"n{i}") == level) & (chance < int(part * (1 << 30))))
        rows = counts.filter(F.col("is_word") == is_word).filter(keep).select("piece", *[f"n{i}" for i in range(len(langs))]).toArrow()
        found.append((rows.column(0).to_pylist(), np.stack([c.to_numpy() for c in rows.columns[1:]], axis=1).astype(np.float64)))
    discard(counts)
    return Model(langs, *found)


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, lang_pred, score: one row for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for b in batches:
            found = [score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=["id", "lang_pred", "score"])

    kept = small_batches(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    return kept.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: Model, least_score: float, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs, all columns, whose text has a language with at least that score; where docs has a column for the
    language, rows without one get the predicted one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    lang_at = docs.columns.index(lang_col) if dict(docs.dtypes).get(lang_col) == "string" else None

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for b in batches:
            found = [score(t) for t in b.column(at).to_pylist()]
            if lang_at is not None:
                langs = [own if own is not None else x for own, (x, _) in zip(b.column(lang_at).to_pylist(), found, strict=True)]
                b = b.set_column(lang_at, b.schema.field(lang_at), pa.array(langs, b.column(lang_at).type))
            yield b.filter(pa.array([x != UNDETERMINED and y >= least_score for x, y in found], pa.bool_()))

    return small_batches(docs).mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out("doc_id")))
    return identify(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
