"""Every registered query of the engine against its SQL, and hand-derived cases of single functions."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from paperloom.config import adaptive
from paperloom.functions import text as T
from paperloom.operators import biblio, dedup, graph
from paperloom.operators.components import connected_components
from paperloom.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t[:-8]} AS SELECT * FROM '{SF}/{t}'")
    return c


def canon(df):
    df = df[sorted(df.columns)]
    one = lambda v: None if v is None or v != v else round(v, 6) if isinstance(v, float) else v if isinstance(v, str) else int(v)
    return sorted((tuple(map(one, r)) for r in df.itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    if name in registry.ORACLE:
        want = duck.execute(registry.ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert canon(got) == canon(want)


def column(spark, values, f, kind="string"):
    return [r.y for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_functions(spark):
    words = ["nanotubes", "classes", "glass", "processings", "editing", "physics", "analyses"]
    assert column(spark, words, T.stem) == ["nanotub", "classe", "glass", "process", "edit", "physics", "analysis"]
    assert column(spark, ["Ada B Lovelace", "Lovelace, Ada", "Plato"], T.normalize_author) == ["Lovelace, Ada B", "Lovelace, Ada", "Plato"]
    assert column(spark, ["Blood-Brain Barrier", "the", "CRISPR/Cas9", "人工"], T.normalize_keyword) == ["blood brain barrier", None, "crisprcas9", None]
    assert column(spark, ["lenia", "genome", "gene edit", "system"], T.names_a_gap) == [False, True, True, False]
    assert column(spark, ["Éa  中-b!", None], T.normalize_title) == ["éa 中b", None]
    assert column(spark, ["see 10.1234/ab.C.", "none"], T.extract_doi) == ["10.1234/ab.C", ""]
    assert column(spark, ["in 1999", "D:20240101", ""], T.extract_year) == [1999, None, None]
    assert (T.title_ratio("tide", "diet"), T.title_ratio("diet", "tide"), T.title_ratio("!", "?"), T.title_ratio(None, "x")) == (0.25, 0.5, 1.0, 0.0)
    t = adaptive(spark.createDataFrame([(200, 40, 5)], "n_papers long, n_keywords long, year_span int")).first()
    assert (t.cluster_size_by_papers, t.cluster_size, t.edge_weight, t.gamma, t.years_needed, t.proximity, t.bridge_ratio, t.is_small, t.is_short, t.is_sparse, t.is_very_sparse) == (10, 2, 4, 1.5, 3, 0.5, 0.2, False, False, True, False)


@pytest.mark.parametrize("counts,want", [([0, 0, 1, 4, 3, 1], [(2021, 2023, 2.67)]), ([1, 1, 1], []), ([5, 0, 5], [(2018, 2018, 1.5), (2020, 2020, 1.5)])])
def test_bursts(spark, counts, want):
    y = spark.createDataFrame([("k", 2018 + i, n) for i, n in enumerate(counts) if n], "keyword string, year int, n long")
    years = spark.createDataFrame([(2018 + i,) for i in range(len(counts))], "year int")
    assert sorted((r.burst_start, r.burst_end, r.intensity) for r in biblio.bursts(y, years).collect()) == want


def test_graph_and_duplicates(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 4), (7, 7), (9, 8), (8, 4)], "a int, b int")
    assert {(r.node, r.root) for r in connected_components(e).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (8, 4), (9, 4)}
    assert connected_components(e.limit(0)).count() == 0
    two = [(a, b, 5) for g in ("abc", "xyz") for a in g for b in g if a < b] + [("c", "x", 1)]
    w = spark.createDataFrame(two, "keyword_a string, keyword_b string, weight long")
    found = graph.communities(w, 1.0)
    assert {r.node: r.community for r in found.collect()} == dict.fromkeys("abc", "a") | dict.fromkeys("xyz", "x")
    assert graph.modularity(w, found) > 0.4 > graph.modularity(w, graph.components(w).withColumnRenamed("component", "community")) == 0.0
    titles = ["A study of gene therapy in mice", "A study of gene therapy in mice!", "A study of gene therapy in rats", "Other", None, "??"]
    d = spark.createDataFrame(list(enumerate(titles)), "id int, title string")
    assert {(r.removed, r.kept) for r in dedup.fuzzy_title_dedup(d).collect()} == {(1, 0), (2, 0)}
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(r.removed, r.kept) for r in dedup.embedding_dedup(v).collect()] == [(2, 1)]
