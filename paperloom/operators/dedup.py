"""Duplicates by DOI, by exact title, by similar title and by embedding; what is missing filled from look-ups."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import completeness, normalize_doi, normalize_title
from .components import connected_components
from .ship import ship
from .store import discard, materialize
from .titles import pairs_of, plain_form

#: Rounds over whole edge tables before what is undecided is folded component by component.
GREEDY_ROUNDS = 12


def keep_first(df: DataFrame, key: str, order: str, richest: str | None = None) -> DataFrame:
    """One row for each value of key, all rows without one: the longest `richest` if given, then the least `order`."""
    by = F.struct((-F.length(F.coalesce(F.col(richest), F.lit("")))) if richest else F.lit(0), F.col(order))
    with_key, without = df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())
    # a pre-aggregated minimum, so that a key that a third of all rows share costs no task a sort of them
    best = with_key.groupBy(key).agg(F.min_by(F.struct(*df.columns), by).alias("_row")).select("_row.*")
    return best.unionByName(without)


def greedy_keep(edges: DataFrame) -> DataFrame:
    """(removed, kept): going through the nodes in order, one is removed if it has an edge to a node kept before; kept is the
    first such. edges: (a, b) with a before b, of any ordered type.

    Rounds over written tables: a node without undecided neighbours before it is kept, its neighbours go. Long chains that
    are undecided after GREEDY_ROUNDS are folded component by component.
    """
    spark, kind = edges.sparkSession, dict(edges.dtypes)["a"]
    every = materialize(edges.select("a", "b").distinct(), "greedy")
    left, gone = every, spark.createDataFrame([], f"n {kind}")
    for _ in range(GREEDY_ROUNDS):
        if not left.limit(1).count():
            break
        free = left.select(F.col("a").alias("n")).distinct().join(left.select(F.col("b").alias("n")).distinct(), "n", "left_anti")
        removed = materialize(left.join(free, left["a"] == free["n"], "left_semi").select(F.col("b").alias("n")).distinct(), "greedy-removed")
        gone = gone.unionByName(removed)
        rest = left.join(removed, left["a"] == removed["n"], "left_anti").join(removed, F.col("b") == removed["n"], "left_anti")
        rest = materialize(rest.join(materialize(free, "greedy-kept"), F.col("a") == F.col("n"), "left_anti"), "greedy")
        if left is not every:
            discard(left)
        left = rest
    else:
        if left.limit(1).count():
            ship(spark)
            c = connected_components(left)
            own = left.join(c.select(F.col("node").alias("b"), "root"), "b")

            def fold(t: pa.Table) -> pa.Table:
                key = lambda x: tuple(x.values()) if isinstance(x, dict) else x
                a, b = ([key(x) for x in t.column(c).to_pylist()] for c in ("a", "b"))
                before: dict = {}
                for x, y in zip(a, b, strict=True):
                    before.setdefault(y, []).append(x)
                out: set = set()
                for n in sorted(before):
                    if any(x not in out for x in before[n]):
                        out.add(n)
                at = {y: i for i, y in enumerate(b) if y in out}
                return pa.table([t.column("b").take(pa.array(list(at.values()), pa.int64()))], names=["n"])

            gone = gone.unionByName(own.select("root", "a", "b").groupBy("root").applyInArrow(lambda t: fold(t), f"n {kind}"))
    out = every.join(gone.distinct(), every["b"] == F.col("n"), "left_semi")
    kept = out.join(gone.select(F.col("n").alias("_n")).distinct(), out["a"] == F.col("_n"), "left_anti")
    return kept.groupBy(F.col("b").alias("removed")).agg(F.min("a").alias("kept"))


def similar_titles(df: DataFrame, threshold: float = 0.85, id_col: str = "id", title_col: str = "title") -> DataFrame:
    """(earlier, later, ratio) of different titles with a ratio of at least threshold. Equal titles are one.

    Titles that differ in marks alone, which the ratio does not see, have a ratio of 1. At a threshold of 1 they are all there is:
    the characters of two titles match in one order only if they are equal.
    """
    ship(df.sparkSession)
    t = df.select(normalize_title(F.col(title_col)).alias("t"), id_col).filter("t <> ''").groupBy("t").agg(F.min(id_col).alias("id"))
    # the same for ASCII, so that plain titles need no Python
    t = t.select("id", F.when(F.col("t").rlike(r"[^\x00-\x7F]"), plain_form(F.col("t"))).otherwise(F.col("t")).alias("t"))
    if threshold >= 1:
        t = t.groupBy("t").agg(F.sort_array(F.collect_list("id")).alias("ids")).filter("size(ids) > 1")
        t = t.select("ids", F.posexplode("ids").alias("at", "earlier")).select("earlier", F.explode(F.filter("ids", lambda x, i: i > F.col("at"))).alias("later"), F.lit(1.0).alias("ratio"))
        return t.filter("earlier < later")
    return pairs_of(materialize(t.withColumn("n", F.length("t")), "titles"), threshold)


def fuzzy_title_dedup(df: DataFrame, threshold: float = 0.85, id_col: str = "id", title_col: str = "title") -> DataFrame:
    """(removed, kept, ratio): greedy in order of id; a title is removed if it is similar to one kept before. Equal titles go to
    the first of them."""
    pairs = materialize(similar_titles(df, threshold, id_col, title_col), "titles")
    near = greedy_keep(pairs.select(F.col("earlier").alias("a"), F.col("later").alias("b")))
    near = near.join(pairs, (F.col("removed") == F.col("later")) & (F.col("kept") == F.col("earlier"))).select("removed", "kept", "ratio")
    t = df.select(F.col(id_col).alias("removed"), normalize_title(F.col(title_col)).alias("t")).filter("t <> ''")
    first = t.groupBy("t").agg(F.min("removed").alias("kept"))
    equal = t.join(first, "t").filter("removed > kept").select("removed", "kept", F.lit(1.0).alias("ratio"))
    return near.unionByName(equal)


def deduplicate(papers: DataFrame, threshold: float = 0.85, *, compat: bool = False) -> tuple[DataFrame, DataFrame]:
    """(papers kept, (reason, removed_id, kept_id, sim)): of one DOI the longest abstract stays, of equal and similar titles the most
    complete entry, among equals the one that was read first (least ingest_seq, then id).

    compat: order alone decides, as in a plain pass over the list: the first of a DOI stays whatever its abstract; a similar
    title takes the place of the one kept before if it is more complete.
    Papers without a DOI or without a title are no duplicates by it. papers needs id, title, abstract, doi, keywords; equal ids
    are told apart by ingest_seq.
    """
    if "ingest_seq" not in papers.columns:
        papers = papers.withColumn("ingest_seq", F.lit(None).cast("long"))
    # a key of its own for every row: entries are read in some order, or else one by id and content
    seq = F.coalesce(F.col("ingest_seq"), F.xxhash64("id", "title", "doi", "abstract"))
    p = papers.withColumn("_seq", seq).withColumn("_doi", normalize_doi(F.col("doi"))).withColumn("_t", normalize_title(F.col("title"))).withColumn("_rich", completeness(F.col("abstract"), F.col("doi"), F.col("keywords")))
    p = materialize(p, "papers")
    slim = p.select(F.col("_seq").alias("seq"), F.col("id").alias("pid"), F.col("_doi").alias("doi"), F.col("_t").alias("t"), F.col("_rich").alias("rich"), F.length(F.coalesce("abstract", F.lit(""))).alias("long"), "title")
    order = F.struct(F.lit(0) if compat else -F.col("long"), "seq")
    by_doi = slim.filter("doi is not null").groupBy("doi").agg(F.min_by(F.struct("seq", "pid"), order).alias("best"))
    dois = materialize(slim.join(by_doi, "doi").filter("seq <> best.seq").select("seq", F.col("pid").alias("removed_id"), F.col("best.pid").alias("kept_id"), F.lit("doi_dup").alias("reason"), F.lit(None).cast("double").alias("sim")), "doi-dups")
    rest = materialize(slim.join(dois.select("seq"), "seq", "left_anti"), "rest")
    first = F.struct(F.col("seq").alias("rich"), "seq") if compat else F.struct((-F.col("rich")).alias("rich"), "seq")
    named = rest.filter("t <> ''").withColumn("rank", first)
    best = named.groupBy("t").agg(F.min("rank").alias("best"))
    equal = named.join(best, "t").filter("rank.seq <> best.seq").select("seq", F.col("best.seq").alias("kept_seq"), F.lit(1.0).alias("sim"))
    one = materialize(named.join(best, (named["t"] == best["t"]) & (named["rank.seq"] == best["best.seq"]), "left_semi"), "titles")
    pairs = materialize(similar_titles(one, threshold, "seq", "title"), "similar")
    ranked = pairs.join(one.select(F.col("seq").alias("earlier"), F.col("rank").alias("re")), "earlier").join(one.select(F.col("seq").alias("later"), F.col("rank").alias("rl")), "later")
    near = greedy_keep(ranked.select(F.least("re", "rl").alias("a"), F.greatest("re", "rl").alias("b"))).select(F.col("removed.seq").alias("seq"), F.col("kept.seq").alias("kept_seq"))
    near = near.join(pairs, (F.least("seq", "kept_seq") == F.col("earlier")) & (F.greatest("seq", "kept_seq") == F.col("later"))).select("seq", "kept_seq", F.col("ratio").alias("sim"))
    titles = equal.unionByName(near)
    if compat:  # within what one place holds, the most complete entry takes it
        place = titles.select("seq", "kept_seq", "sim").unionByName(titles.select(F.col("kept_seq").alias("seq"), "kept_seq", F.lit(1.0).alias("sim")).distinct())
        place = place.join(rest.select("seq", "rich"), "seq")
        winner = place.groupBy("kept_seq").agg(F.min_by("seq", F.struct(-F.col("rich"), "seq")).alias("winner"))
        titles = place.join(winner, "kept_seq").filter("seq <> winner").select("seq", F.col("winner").alias("kept_seq"), "sim")
    ids = lambda end, name: rest.select(F.col("seq").alias(end), F.col("pid").alias(name))
    titles = titles.join(ids("seq", "removed_id"), "seq").join(ids("kept_seq", "kept_id"), "kept_seq").select("seq", "removed_id", "kept_id", F.concat(F.lit("title_sim_"), F.format_string("%.2f", "sim")).alias("reason"), "sim")
    removed = materialize(dois.unionByName(titles), "removed")
    kept = p.join(removed.select(F.col("seq").alias("_gone")), p["_seq"] == F.col("_gone"), "left_anti").select(papers.columns)
    return kept, removed.select("reason", "removed_id", "kept_id", "sim")


def removal_counts(removed: DataFrame) -> DataFrame:
    """One row: how many went, and by which reason."""
    return removed.agg(F.count("*").alias("n_removed"), F.count_if(F.col("reason") == "doi_dup").alias("n_doi"), F.count_if(F.col("reason").startswith("title_sim")).alias("n_title"), F.count_if(F.col("reason").startswith("embedding_sim")).alias("n_embedding"))


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return dot / F.nullif(norm(a) * norm(b), F.lit(0.0))


def bands(n: int, over: float, recall: float) -> tuple[int, int]:
    """Bits a band and bands: a band is met by chance by about one other vector, and a pair at the limit shares one with this recall."""
    bits = min(30, max(8, math.ceil(math.log2(max(2, n)))))
    agree = (1 - math.acos(over) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def embedding_pairs(vectors: DataFrame, over: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = 0.999) -> DataFrame:
    """(a, b, similarity) of vectors with a cosine over the limit, a < b.

    Candidates agree on all bits of a band of random hyperplanes: a pair exactly at the limit does so in some band with the
    recall stated, a closer one almost surely; the exact cosine is computed for candidates. Equal vectors are one for this and
    come as pairs with the first of them. Null vectors and such of length zero have no pairs.
    """
    ship(vectors.sparkSession)
    v = vectors.select(F.col(id_col).alias("id"), F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("v")).filter("v is not null")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    v = v.withColumn("norm", norm).filter("norm > 0").select("id", F.transform("v", lambda x: x / F.col("norm")).alias("u"))
    v = materialize(v, "unit")
    one = materialize(v.groupBy("u").agg(F.min("id").alias("id")), "vectors")
    bits, n = bands(one.count(), over, recall)

    @F.pandas_udf("array<long>")
    def keys(u: pd.Series) -> pd.Series:
        x = np.stack(u.to_numpy())
        planes = np.random.default_rng(bits * 1000 + n).standard_normal((x.shape[1], bits * n))
        signs = (x @ planes > 0).reshape(len(x), n, bits)
        return pd.Series(list(signs @ (1 << np.arange(bits, dtype=np.int64))))

    at = one.select("id", F.posexplode(keys("u")).alias("band", "key"))
    at = materialize(at, "bands")
    x, y = at.withColumnRenamed("id", "a"), at.withColumnRenamed("id", "b")
    p = x.join(y, ["band", "key"]).filter("a < b").select("a", "b").distinct()
    side = lambda end, name: one.select(F.col("id").alias(end), F.col("u").alias(name))
    similarity = F.aggregate(F.zip_with("ua", "ub", lambda p, q: p * q), F.lit(0.0), lambda s, z: s + z)
    p = p.join(side("a", "ua"), "a").join(side("b", "ub"), "b").select("a", "b", similarity.alias("similarity")).filter(F.col("similarity") > over)
    same = v.join(one.select("u", F.col("id").alias("a")), "u").filter("id > a").select("a", F.col("id").alias("b"), F.lit(1.0).alias("similarity"))
    return p.unionByName(same)


def embedding_dedup(vectors: DataFrame, over: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = 0.999) -> DataFrame:
    """(removed, kept): greedy in order of id; a removed vector removes none."""
    return greedy_keep(embedding_pairs(vectors, over, id_col, vec_col, recall))


def fill_missing(df: DataFrame, found: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """df with what is missing in the given columns (null, empty) filled from found, joined by key."""
    f = found.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns])
    kinds = dict(df.dtypes)

    def own(c: str) -> Column:
        if kinds[c] == "string":
            return F.nullif(df[c], F.lit(""))
        return F.when(F.size(df[c]) > 0, df[c]) if kinds[c].startswith("array") else df[c]

    return df.join(f, df[key] == f["_key"], "left").select(*[F.coalesce(own(c), F.col(f"_{c}"), df[c]).alias(c) if c in columns else df[c] for c in df.columns])


def needs_enrichment() -> Column:
    """A DOI, and no abstract, no year or no journal."""
    has = F.col("doi").isNotNull() & ~F.lower(F.trim("doi")).isin("", "nan")
    return has & (F.coalesce(F.col("abstract"), F.lit("")).eqNullSafe("") | F.col("year").isNull() | F.coalesce(F.col("journal"), F.lit("")).eqNullSafe(""))


def is_rich() -> Column:
    """An abstract of over 100 characters, and keywords."""
    return (F.length(F.coalesce("abstract", F.lit(""))) > 100) & (F.size(F.coalesce("keywords", F.array().cast("array<string>"))) > 0)


def enrich(papers: DataFrame, lookup: DataFrame, columns: tuple[str, ...] = ("abstract", "year", "journal", "volume", "pages", "publisher", "url", "keywords", "authors", "title"), unless: Column | None = None) -> DataFrame:
    """papers with what they lack from look-ups by DOI (one row a DOI, compared in lower case); rows for which `unless` holds are left alone."""
    wanted = needs_enrichment() & ~(F.lit(False) if unless is None else unless)
    found = keep_first(lookup.filter("doi is not null").withColumn("doi", normalize_doi(F.col("doi"))).select("doi", *columns), "doi", "doi", "abstract")
    p = papers.withColumn("_doi", F.when(wanted, normalize_doi(F.col("doi"))))
    return fill_missing(p, found.withColumnRenamed("doi", "_doi"), "_doi", list(columns)).select(papers.columns)


def expand_citations(edges: DataFrame, seeds: DataFrame, limit: int | None = None, per_seed: int | None = None) -> DataFrame:
    """(paper_id): papers that cite or are cited by the seeds, seeds left out. edges: citing, cited. per_seed: at most so many
    neighbours of each seed, the least ids first, where the request says so."""
    both = edges.select(F.col("citing").alias("x"), F.col("cited").alias("y")).unionByName(edges.select(F.col("cited").alias("x"), F.col("citing").alias("y")))
    near = both.join(seeds.select(F.col("paper_id").alias("x")), "x", "left_semi")
    if per_seed is not None:
        near = near.distinct().withColumn("at", F.row_number().over(Window.partitionBy("x").orderBy("y"))).filter(F.col("at") <= per_seed)
    out = near.select(F.col("y").alias("paper_id")).join(seeds, "paper_id", "left_anti").distinct()
    return out if limit is None else out.orderBy("paper_id").limit(limit)


def new_papers(found: DataFrame, corpus: DataFrame, limit: int | None = None) -> DataFrame:
    """Papers of found that the corpus has neither by id nor by DOI, one row an id; at most `limit`, the least ids first."""
    own = normalize_doi(F.col("doi"))
    known = corpus.select(own.alias("_known")).filter("_known is not null").distinct()
    out = found.join(corpus.select("id").distinct(), "id", "left_anti").withColumn("_doi", own)
    out = out.join(known, out["_doi"] == known["_known"], "left_anti").drop("_doi").dropDuplicates(["id"])
    return out if limit is None else out.orderBy("id").limit(limit)
