"""Keyword extraction: frequency, TF-IDF and embeddings, and the pass that joins them with given keywords."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon
from ..functions.text import clean_text, let, normalize_keywords
from .ship import ship
from .store import materialize

#: A word that more than this share of all documents holds tells nothing about one of them.
COMMON = 0.2
#: A word of four a-z letters or more, with neither letter, digit nor underscore beside it.
WORD = r"(?<![\p{L}\p{N}_])[a-z]{4,}(?![\p{L}\p{N}_])"


def _words(text: Column) -> Column:
    """Runs of letters, digits and underscores, lower-cased; null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+"), lambda w: w != "")


def _long_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def common_words(docs: DataFrame, *, text_col: str = "text", share: float = COMMON) -> list[str]:
    """The words that over `share` of the documents hold: no more than the mean number of words of a document over share, so few.

    This is the default list of noise, found from the corpus itself; lexicon.read_words() reads another one from a file.
    """
    d = docs.select(F.explode(F.array_distinct(_long_words(F.col(text_col)))).alias("w"))
    n = docs.count()
    return sorted(r.w for r in d.groupBy("w").agg(F.count("*").alias("df")).filter(F.col("df") > share * n).collect())


def word_counts(words: Column) -> Column:
    """array<struct<neg, first, w>> of the distinct words of an array: minus their number, first place; counted inside the row.

    The words are sorted with their places; each run of equal ones gives one entry.
    """

    def runs(pairs: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: (i == 0) | (F.get(pairs, i)["w"] != F.get(pairs, i - 1)["w"]))
        return let(starts, lambda s: F.transform(s, lambda i, k: F.struct((i - F.coalesce(F.get(s, k + 1), F.size(pairs))).alias("neg"), F.get(pairs, i)["i"].alias("first"), F.get(pairs, i)["w"].alias("w"))))

    pairs = F.array_sort(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    return F.when(F.size(words) > 0, let(pairs, runs))


def word_keywords(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", top: int = 5, noise: list[str] | None = None) -> DataFrame:
    """(id, keyword, n, rank): the words of four a-z letters or more, most frequent first, then first seen.

    Words are runs of ASCII letters between anything else, after lower-casing. noise None: the corpus's common words. Counted,
    ranked and cut inside the row; the only shuffle is that of the common words' counts.
    """
    banned = common_words(docs, text_col=text_col) if noise is None else noise
    found = F.filter(word_counts(_long_words(F.col(text_col))), lambda x: ~x["w"].isin(*(banned or [""])))
    best = F.slice(F.array_sort(found), 1, top)
    return docs.select(F.col(id_col), F.posexplode(best).alias("at", "x")).select(id_col, F.col("x.w").alias("keyword"), (-F.col("x.neg")).cast("long").alias("n"), (F.col("at") + 1).alias("rank"))


def tfidf_keywords(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", top: int = 5, max_features: int = 500, min_df: int = 1, max_df: float = 0.8, noise: list[str] | None = None, stopwords: list[str] | None = None) -> DataFrame:
    """(id, keyword, score, rank): one- and two-word terms weighed tf * (ln((1+n)/(1+df)) + 1), scaled to length one per document.

    noise None: the corpus's common words. The vocabulary has max_features terms; the terms of a document are counted inside its
    row, and only those of the vocabulary leave it.
    """
    banned = common_words(docs, text_col=text_col) if noise is None else noise
    stop = lexicon.STOPWORDS if stopwords is None else stopwords
    n = docs.count()
    words = F.filter(_words(clean_text(F.col(text_col))), lambda w: (F.length(w) >= 2) & ~w.isin(*(stop or [""])))
    terms = let(words, lambda w: F.concat(w, F.transform(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1)))))
    tf = docs.select(F.col(id_col).alias("id"), F.explode(word_counts(terms)).alias("x")).select("id", F.col("x.w").alias("keyword"), (-F.col("x.neg")).alias("tf"))
    df = tf.groupBy("keyword").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).filter((F.col("df") >= min_df) & (F.col("df") <= max_df * n))
    vocabulary = df.orderBy(F.desc("total"), "keyword").limit(max_features)  # at most max_features rows
    s = tf.join(F.broadcast(vocabulary), "keyword").withColumn("x", F.col("tf") * (F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1))
    s = s.withColumn("norm", F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("id")))).select("id", "keyword", F.round(F.col("x") / F.col("norm"), 6).alias("score"))
    order = Window.partitionBy("id").orderBy(F.desc("score"), "keyword")
    s = s.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= 2 * top)
    s = s.filter((F.col("score") > 0) & (F.length("keyword") >= 3) & ~F.col("keyword").isin(*(banned or [""])) & ~F.col("keyword").rlike(r"^[0-9 ]+$"))
    return s.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(F.col("id").alias(id_col), "keyword", "score", "rank")


def hashed_embedding(texts: list[str], size: int = 256) -> np.ndarray:
    """Unit vectors of texts without a model: signed hashes of the character trigrams of their words."""
    import zlib

    out = np.zeros((len(texts), size))
    for i, t in enumerate(texts):
        for w in t.lower().split():
            w = f" {w} "
            for k in range(len(w) - 2):
                h = zlib.crc32(w[k : k + 3].encode())
                out[i, h % size] += 1.0 if h & 0x80000000 else -1.0
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def embedding_keywords(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", top: int = 5, least: float = 0.3, diversity: float = 0.5, embed=None, stopwords: list[str] | None = None) -> DataFrame:
    """(id, keyword, score, rank): the one- and two-word terms nearest to the text as a whole, by maximal marginal relevance.

    embed: a function from texts to unit vectors, such as a sentence model's; None: hashed_embedding. Texts under 50 characters
    have no keywords; terms of a similarity of `least` or less are dropped after the choice.
    """
    ship(docs.sparkSession)
    stop, embed = frozenset(lexicon.STOPWORDS if stopwords is None else stopwords), embed or hashed_embedding
    kind = dict(docs.dtypes)[id_col]

    def choose(text: str | None) -> list[tuple[str, float]]:
        if not text or len(text) < 50:
            return []
        words = re.findall(r"\w\w+", text.lower())
        terms = sorted({w for w in words if w not in stop} | {f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if a not in stop and b not in stop})
        if not terms:
            return []
        v = embed([text, *terms])
        near, among = v[1:] @ v[0], v[1:] @ v[1:].T if len(terms) <= 2_000 else None
        chosen = [int(near.argmax())]
        worst = np.full(len(terms), -np.inf)
        while len(chosen) < min(top, len(terms)):
            worst = np.maximum(worst, among[chosen[-1]] if among is not None else v[1:] @ v[1 + chosen[-1]])
            score = (1 - diversity) * near - diversity * worst
            score[chosen] = -np.inf
            chosen.append(int(score.argmax()))
        return [(terms[i], float(near[i])) for i in sorted(chosen, key=lambda i: (-near[i], terms[i])) if near[i] > least]

    def run(batches):
        for b in batches:
            rows = [(i, k, round(s, 6), r) for i, t in zip(b["id"], b["text"], strict=True) for r, (k, s) in enumerate(choose(t), 1)]
            yield pd.DataFrame(rows, columns=["id", "keyword", "score", "rank"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, keyword string, score double, rank int")
    return out.withColumnRenamed("id", id_col)


def union_keywords(keywords: Column, extracted: Column) -> Column:
    """The union of two keyword arrays, in order, without repeats; the first alone, as it is, where nothing was extracted."""
    none = F.array().cast("array<string>")
    return F.when(F.size(F.coalesce(extracted, none)) > 0, F.array_distinct(F.concat(F.coalesce(keywords, none), extracted))).otherwise(F.coalesce(keywords, none))


def has_abstracts(papers: DataFrame, least: int = 5) -> bool:
    """Are there `least` abstracts of over 50 characters, so that keywords can be looked for in them?"""
    return papers.filter(F.length("abstract") > 50).limit(least).count() >= least


def with_keywords(papers: DataFrame, *, method: str = "tfidf", top: int = 5, synonyms: dict[str, str] | None = None, noise: list[str] | None = None, distinct: bool = True, embed=None) -> DataFrame:
    """papers with keywords_normalized: the given keywords normalised, joined with those extracted from the abstracts.

    method: tfidf, words, embedding or none. Rows are told apart by a number, so ids may repeat.
    """
    p = papers.withColumn("keywords_normalized", normalize_keywords(F.coalesce("keywords", F.array().cast("array<string>")), synonyms, distinct))
    if method == "none" or not has_abstracts(p):
        return p
    p = materialize(p.withColumn("_row", F.monotonically_increasing_id()), "papers")
    docs = p.select("_row", "abstract")
    how = {"id_col": "_row", "text_col": "abstract", "top": top}
    if method == "tfidf":
        found = tfidf_keywords(docs, **how, min_df=max(1, int(0.05 * docs.count())), noise=noise)
    elif method == "words":
        found = word_keywords(docs, **how, noise=noise)
    elif method == "embedding":
        found = embedding_keywords(docs, **how, embed=embed)
    else:
        raise ValueError(f"no such method: {method}")
    found = found.groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "keyword"))), lambda x: x["keyword"]).alias("_found"))
    return p.join(found, "_row", "left").withColumn("keywords_normalized", union_keywords(F.col("keywords_normalized"), F.col("_found"))).drop("_row", "_found")
