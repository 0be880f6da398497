"""Keyword frequencies, trends, co-occurrence and co-authorship.

A corpus is a DataFrame of papers: paper_id, year, keywords array<string>, authors array<string>,
journal, citation_count. Counts are partial aggregates before any shuffle; frequencies, trends, bursts and
declines all derive from one written table by keyword and year; pairs are made inside a paper's own array, so
no self-join of occurrences and no shuffle by paper is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize


def occurrences(corpus: DataFrame, distinct: bool = True) -> DataFrame:
    """(paper_id, pos, keyword, year)."""
    kws = F.array_distinct("keywords") if distinct else F.col("keywords")
    return corpus.select("paper_id", "year", F.posexplode(kws).alias("pos", "keyword"))


def keyword_years(corpus: DataFrame, distinct: bool = True) -> DataFrame:
    """(keyword, year, n), written: the one aggregate behind frequencies, trends, bursts, declines and pivots. A null year counts too.

    Rows with a null keyword stand for the papers themselves: how many a year has, and (n_with) how many of them with keywords.
    """
    kws = F.coalesce(F.array_distinct("keywords") if distinct else F.col("keywords"), F.array().cast("array<string>"))
    # one pass: a paper is a row of its own beside those of its keywords
    rows = corpus.select("year", (F.size(kws) > 0).cast("int").alias("with"), F.explode(F.concat(F.array(F.lit(None).cast("string")), F.filter(kws, lambda k: k.isNotNull()))).alias("keyword"))
    return materialize(rows.groupBy("keyword", "year").agg(F.count("*").alias("n"), F.sum("with").alias("n_with")), "keyword-years")


def freq_of(table: DataFrame) -> DataFrame:
    return table.filter("keyword is not null").groupBy("keyword").agg(F.sum("n").alias("total_count"))


def yearly_of(table: DataFrame) -> DataFrame:
    return table.filter("keyword is not null and year is not null").select("keyword", "year", "n")


def years_of(table: DataFrame) -> DataFrame:
    """Papers of each year in which any paper has a keyword."""
    return table.filter("keyword is null and year is not null and n_with > 0").select("year", F.col("n").alias("n_papers"))


def papers_of(table: DataFrame) -> int:
    return table.filter("keyword is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def keyword_freq(corpus: DataFrame, distinct: bool = True) -> DataFrame:
    return occurrences(corpus, distinct).groupBy("keyword").agg(F.count("*").alias("total_count"))


def keyword_yearly(corpus: DataFrame, distinct: bool = True) -> DataFrame:
    return occurrences(corpus, distinct).filter("year is not null").groupBy("keyword", "year").agg(F.count("*").alias("n"))


def papers_per_year(corpus: DataFrame) -> DataFrame:
    """Papers of each year in which any paper has a keyword."""
    has = F.max((F.size(F.coalesce("keywords", F.array())) > 0).cast("int"))
    return corpus.filter("year is not null").groupBy("year").agg(F.count("*").alias("n_papers"), has.alias("has")).filter("has = 1").drop("has")


def trends_of(table: DataFrame, *, rising_over: float = 1.3, declining_under: float = 0.7) -> DataFrame:
    """(keyword, total_count, trend, cagr_3yr): rates of the first two, last two and the two observed years before those."""
    w = Window.orderBy("year")  # one row a year
    years = years_of(table).select("year", "n_papers", F.row_number().over(w).alias("i"), F.count("*").over(Window.partitionBy()).alias("k"))
    band = {"early": F.col("i") <= 2, "late": F.col("i") > F.col("k") - 2, "prev": (F.col("i") > F.col("k") - 4) & (F.col("i") <= F.col("k") - 2)}
    papers = years.agg(F.max("k").alias("n_years"), *[F.greatest(F.lit(1), F.coalesce(F.sum(F.when(c, F.col("n_papers"))), F.lit(0))).alias(f"p_{b}") for b, c in band.items()])
    # one aggregate over keyword and year gives the totals and the rates
    y = table.filter("keyword is not null").join(F.broadcast(years.drop("n_papers")), "year", "left")
    t = y.groupBy("keyword").agg(F.sum("n").alias("total_count"), *[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(f"k_{b}") for b, c in band.items()]).join(F.broadcast(papers))
    rate = {b: F.col(f"k_{b}") / F.col(f"p_{b}") for b in band}
    few = F.coalesce(F.col("n_years"), F.lit(0)) < 4
    trend = F.when(few, "insufficient_data").when(rate["late"] > rising_over * rate["early"], "rising").when(rate["late"] < declining_under * rate["early"], "declining").otherwise("stable")
    cagr = F.when(few, None).when(rate["late"] == 0, -1.0).when(rate["prev"] == 0, F.lit(float("inf"))).otherwise(F.round(F.sqrt(rate["late"] / F.when(rate["prev"] != 0, rate["prev"])) - 1, 3))
    return t.select("keyword", "total_count", trend.alias("trend"), cagr.alias("cagr_3yr"))


def keyword_trends(corpus: DataFrame, *, rising_over: float = 1.3, declining_under: float = 0.7, distinct: bool = True) -> DataFrame:
    return trends_of(keyword_years(corpus, distinct), rising_over=rising_over, declining_under=declining_under)


def top_trends(trends: DataFrame, n: int = 100) -> DataFrame:
    return trends.orderBy(F.desc("total_count"), "keyword").limit(n)


def pivot_of(table: DataFrame, years: list[int]) -> DataFrame:
    """One column a year."""
    return yearly_of(table).groupBy("keyword").pivot("year", years).agg(F.sum("n")).select("keyword", *[F.coalesce(F.col(str(y)), F.lit(0)).alias(f"y{y}") for y in years])


def keyword_table(table: DataFrame, trends: DataFrame) -> DataFrame:
    """keyword, total_count, one column a year, trend, cagr_3yr: the exported frequency table, most frequent first."""
    years = [r.year for r in years_of(table).orderBy("year").collect()]
    wide = pivot_of(table, years).select("keyword", *[F.col(f"y{y}").alias(str(y)) for y in years])
    none = [F.coalesce(F.col(f"`{y}`"), F.lit(0)).alias(str(y)) for y in years]
    return trends.join(wide, "keyword", "left").select("keyword", "total_count", *none, "trend", "cagr_3yr").orderBy(F.desc("total_count"), "keyword")


def explode_pairs(df: DataFrame, items: str, a: str, b: str, *keep: str) -> DataFrame:
    """Unordered pairs of an array, by position: first one end, then the other, so that no row holds all pairs of a long array."""
    one = df.select(*keep, F.col(items).alias("_items"), F.posexplode(items).alias("_i", "_x")).filter(F.col("_i") < F.size("_items") - 1)
    two = one.select(*keep, "_x", F.explode(F.slice("_items", F.col("_i") + 2, F.size("_items"))).alias("_y"))
    return two.select(*keep, F.least("_x", "_y").alias(a), F.greatest("_x", "_y").alias(b))


def cooccurrence(corpus: DataFrame, top_k: int | None = 200, min_weight: int = 2, distinct: bool = True, freq: DataFrame | None = None) -> DataFrame:
    """(keyword_a, keyword_b, weight, year_range_start, year_range_end) among the top_k keywords.

    The vocabulary, top_k words, cuts every paper's own array before any pair is made; nothing is shuffled by paper. freq: the
    keywords' frequencies, if they are at hand.
    """
    kws = F.array_distinct("keywords") if distinct else F.col("keywords")
    papers = corpus.select("year", kws.alias("k"))
    if top_k is not None:
        freq = keyword_freq(corpus, distinct) if freq is None else freq
        words = [r.keyword for r in freq.orderBy(F.desc("total_count"), "keyword").limit(top_k).collect()]
        papers = papers.select("year", F.filter("k", lambda x: x.isin(*(words or [""]))).alias("k"))
    p = explode_pairs(papers.filter(F.size("k") > 1), "k", "keyword_a", "keyword_b", "year")
    out = p.groupBy("keyword_a", "keyword_b").agg(F.count("*").alias("weight"), F.min("year").alias("year_range_start"), F.max("year").alias("year_range_end"))
    return out.filter(F.col("weight") >= min_weight)


def author_network(corpus: DataFrame, min_weight: int = 2) -> DataFrame:
    p = explode_pairs(corpus.select("authors"), "authors", "author_a", "author_b")
    return p.groupBy("author_a", "author_b").agg(F.count("*").alias("weight")).filter(F.col("weight") >= min_weight)


def top_values(corpus: DataFrame, column: str, n: int) -> DataFrame:
    return corpus.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def citation_stats(corpus: DataFrame) -> DataFrame:
    c = corpus.filter("citation_count <> 0").select(F.col("citation_count").alias("c"))
    return c.agg(F.round(F.avg("c"), 1).alias("citations_mean"), F.median("c").alias("citations_median"), F.max("c").alias("citations_max"))


def corpus_summary(corpus: DataFrame) -> DataFrame:
    return corpus.agg(
        F.count("*").alias("total_papers"), F.min("year").alias("year_min"), F.max("year").alias("year_max"),
        F.count_if(F.size(F.coalesce("keywords", F.array())) > 0).alias("n_with_keywords"),
        F.coalesce(F.sum(F.size(F.array_distinct(F.coalesce("keywords", F.array())))), F.lit(0)).alias("n_keyword_uses"),
        *[F.count_if(F.length(c) > 0).alias(f"n_with_{c}") for c in ("abstract", "doi") if c in corpus.columns],
    )


def top_list(counts: DataFrame, name: str, n: str, top: int) -> list[list]:
    """The first `top` rows of (name, n) as lists, for a report."""
    return [[r[0], r[1]] for r in counts.select(name, n).orderBy(F.desc(n), name).limit(top).collect()]


def bursts(yearly: DataFrame, years: DataFrame, gamma: float = 1.0) -> DataFrame:
    """(keyword, burst_start, burst_end, intensity): islands of years at half the base level, from their first year at the full level.

    yearly: keyword, year, n; years: the observed years, one small row each.
    """
    axis = years.select("year", F.row_number().over(Window.orderBy("year")).alias("i"), F.count("*").over(Window.partitionBy()).alias("k"))
    totals = yearly.groupBy("keyword").agg(F.sum("n").alias("total"))
    grid = totals.join(F.broadcast(axis)).join(yearly, ["keyword", "year"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    grid = grid.filter("k >= 3 and total > 0").withColumn("base", F.greatest(F.col("total") / F.col("k"), F.lit(0.5)))
    goes_on = F.col("n") >= 0.5 * F.col("base") * gamma
    starts = (F.col("n") >= F.col("base") * gamma) & (F.col("n") >= 2)
    w = Window.partitionBy("keyword").orderBy("i")
    grid = grid.withColumn("island", F.sum(F.when(goes_on, 0).otherwise(1)).over(w)).filter(goes_on)
    island = Window.partitionBy("keyword", "island")
    grid = grid.withColumn("first_start", F.min(F.when(starts, F.col("i"))).over(island)).filter("i >= first_start")
    return grid.groupBy("keyword", "island").agg(F.min("year").alias("burst_start"), F.max("year").alias("burst_end"), F.round(F.max("n") / F.first("base"), 2).alias("intensity")).drop("island")


def temporal_decline(yearly: DataFrame, years: DataFrame, n_papers: int, *, floor: int = 10, share: float = 0.05, decline: float = 0.3) -> DataFrame:
    """(keyword, early, late, decline_ratio, peak_year, peak_count): strong in the first three years, gone in the last three."""
    axis = years.select("year", F.row_number().over(Window.orderBy("year")).alias("i"), F.count("*").over(Window.partitionBy()).alias("k"))
    y = yearly.join(F.broadcast(axis), "year").filter("k >= 6")
    g = y.groupBy("keyword").agg(
        F.coalesce(F.sum(F.when(F.col("i") <= 3, F.col("n"))), F.lit(0)).alias("early"), F.coalesce(F.sum(F.when(F.col("i") > F.col("k") - 3, F.col("n"))), F.lit(0)).alias("late"),
        F.min(F.struct((-F.col("n")).alias("n"), "year")).alias("peak"), F.max("year").alias("last"),
    )
    g = g.filter((F.col("early") >= max(floor, int(share * n_papers))) & (F.col("late") <= decline * F.col("early")))
    return g.select("keyword", "early", "late", F.round(F.col("late") / F.col("early"), 3).alias("decline_ratio"), F.col("peak.year").alias("peak_year"), (-F.col("peak.n")).alias("peak_count"))
