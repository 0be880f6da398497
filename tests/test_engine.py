"""Duplicates, graph and keyword operators against plain versions, the services' requests, and whole runs from a file to the report."""

import hashlib
import heapq
import json
import random
import types
import zlib
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.config import Config
from paperloom.functions import lexicon
from paperloom.functions import text as T
from paperloom.operators import biblio, dedup, frontier, gaps, graph, keywords, quality, report, store
from paperloom.operators import titles as titles_of
from paperloom.plans import catalog
from paperloom.plans.pipeline import Pipeline, Timeout, clean
from paperloom.sources import readers, sinks
from paperloom.streaming import incremental


def titles(rng, n):
    """Titles of 1 to 80 characters, many of them edits of others."""
    words = "study of gene therapy in mice rats cells for deep learning on graphs a the new model data".split()
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            t = list(rng.choice(out))
            for _ in range(rng.randrange(0, max(2, len(t) // 7))):
                k, c = rng.randrange(len(t)), rng.choice("abcdefg ")
                t[k : k + rng.randrange(2)] = c
                if not t:
                    t = ["x"]
            out.append("".join(t))
        else:
            out.append(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 12)))[: rng.randrange(1, 80)])
    return out


def test_similar_titles_match_all_pairs(spark):
    """No pair of a ratio of 0.85 is lost by the q-grams, of short and long titles."""
    rng = random.Random(4)
    rows = list(enumerate(titles(rng, 220)))
    norm = {i: " ".join("".join(c for c in t.lower() if c.isalnum() or c in "_ ").split()) for i, t in rows}
    first = {}
    for i, t in norm.items():
        if t:
            first.setdefault(t, i)
    ids = sorted(first.values())
    want = {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if T.title_ratio(norm[b], norm[a]) >= 0.85}
    d = spark.createDataFrame(rows, "id int, title string")
    got = dedup.similar_titles(d, 0.85).collect()
    assert {(r.earlier, r.later) for r in got} == want and len(want) > 40
    # greedy in order, by the plain pass
    kept, removed = [], {}
    for b in ids:
        near = [a for a in kept if (a, b) in want]
        if near:
            removed[b] = near[0]
        else:
            kept.append(b)
    equal = {i: first[t] for i, t in norm.items() if t and first[t] != i}
    found = {r.removed: r.kept for r in dedup.fuzzy_title_dedup(d, 0.85).collect()}
    assert found == removed | equal


def test_similar_titles_of_every_length_without_spark():
    """No pair is lost by the bounds, of titles below and above 200 characters, where the ratio passes over common ones."""
    rng = random.Random(9)
    words = ["".join(rng.choice("etaoinshrdluzqxj7") for _ in range(rng.randrange(2, 7))) for _ in range(60)]
    every = 0
    for size, edits in ((6, 2), (40, 12), (70, 20), (300, 40)):
        found = [" ".join(rng.choice(words) for _ in range(rng.randrange(max(1, size * 3 // 4), size + 1))) for _ in range(14)]
        for t in list(found) * 3:
            t = list(t)
            for _ in range(rng.randrange(1, edits)):
                k = rng.randrange(len(t))
                t[k : k + rng.randrange(4)] = rng.choice("etzq ")
            found.append("".join(t))
        found = ["", *dict.fromkeys(T.plain_title(x) for x in found)]
        ids = rng.sample(range(1000), len(found))
        by = sorted(zip(ids, found, strict=True))
        want = {(a, b) for i, (a, x) in enumerate(by) for b, y in by[i + 1 :] if SequenceMatcher(None, y, x).ratio() >= 0.85}
        got = [x[:2] for x in titles_of.near_pairs(ids, found, np.zeros(len(ids), dtype=np.int64), 0.85)]
        assert len(got) == len(set(got)) and set(got) == want
        every += len(want)
        side = np.array([rng.randrange(2) for _ in ids])
        of = dict(zip(ids, side, strict=True))
        assert {x[:2] for x in titles_of.near_pairs(ids, found, side, 0.85)} == {(a, b) for a, b in want if of[a] != of[b]}
    assert every > 100


def edited(rng, size, edits, letters="etaoin shrdlu"):
    """A title and one that differs from it in so many places."""
    x = [rng.choice(letters) for _ in range(size)]
    y = list(x)
    for _ in range(edits):
        k = rng.randrange(len(y))
        y[k : k + rng.randrange(3)] = rng.choice(letters) * rng.randrange(1, 3)
    return "".join(x), "".join(y)


def test_blocks_of_titles_are_those_of_difflib():
    """Titles of 1 GB meet their near copies without a step for each common character, and all the same have difflib's ratio."""
    rng = random.Random(3)
    for _ in range(150):
        x, y = edited(rng, rng.choice((1, 9, 150, 199, 200, 201, 420)), rng.randrange(40), rng.choice(("ab", "etaoin shrdlu", "".join(map(chr, range(97, 250))))))
        want = sum(b.size for b in SequenceMatcher(None, y, x).get_matching_blocks())
        found = titles_of._Ratio(x)
        assert found.matches(y, 0) == found.matches(y, want) == want and found.matches(y, want + 1) in (0, want)


def test_short_titles_meet_in_a_band_without_spark():
    """Bands of one word and of several find the common subsequences that are long enough, and no others; no title pays for all columns of all."""
    rng = random.Random(8)
    found = [t for k in range(60) for t in edited(rng, (3, 40, 120, 190, 260, 500)[k % 6], rng.randrange(1, 90))]
    alphabet = {c: k for k, c in enumerate(sorted({c for t in found for c in t}))}
    n = np.array([len(t) for t in found])
    many = titles_of._Common([np.array([alphabet[c] for c in t], dtype=np.int32) for t in found], n, len(alphabet))
    x, y = (np.array(v) for v in zip(*[(i, j) for i in range(len(found)) for j in range(len(found)) if i != j], strict=True))
    common = np.array([titles_of._common(found[i], found[j]) for i, j in zip(x, y, strict=True)])
    for off in (-2, 0, 1):
        match = np.clip(common + off, 0, np.minimum(n[x], n[y]))
        assert set(many(x, y, match)) == set(np.flatnonzero(common >= match))
    assert ((n[x] + n[y] - 2 * common) > 64).any()


def test_titles_of_thousands_of_characters_take_no_rows_for_grams(spark, monkeypatch):
    """Long titles that differ in a few places, and ones that differ in marks alone; chunks are dealt to several tasks."""
    rng = random.Random(5)
    # without a rare character here and there the ratio sees nothing behind the first difference
    base = ["".join(str(i // 250 % 10) if i % 250 == 0 else rng.choice("abcdefghijklmnopqrstuvwxyz  ") for i in range(3000)) for _ in range(6)]
    rows = list(enumerate([*base, *[b[:1000] + "a z" + b[1010:] for b in base], "caf\u0301e", "cafe", *[x * 9 for x in "abc"]]))
    written = []
    real = dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df, name="t": written.append(df.columns) or real(df, name))
    d = spark.createDataFrame(rows, "id int, title string")
    got = {(r.earlier, r.later): r.ratio for r in dedup.similar_titles(d, 0.85).collect()}
    assert set(got) == {*((i, i + 6) for i in range(6)), (12, 13)} and got[12, 13] == 1.0 and not any("gram" in c for c in written)
    assert [(r.earlier, r.later) for r in dedup.similar_titles(d, 1.0).collect()] == [(12, 13)]


def test_equal_titles_alone_take_no_grams(spark, monkeypatch):
    """At a threshold of 1 no different titles are alike, so long ones cost no grams, no tables and no pairs."""
    rows = [(f"p{i}", f"{'an unbroken line of words ' * 2000}{i % 3}", "x" * i, None, i) for i in range(9)]
    written = []
    monkeypatch.setattr(dedup, "materialize", lambda df, name="t": written.append(name) or df.cache())
    d = spark.createDataFrame([(r[4], r[1]) for r in rows], "id long, title string")
    found = dedup.similar_titles(d, 1.0)
    assert found.dtypes == [("earlier", "bigint"), ("later", "bigint"), ("ratio", "double")] and found.count() == 0 and not written
    kept, removed = dedup.deduplicate(paper_rows(spark, rows), 1.0)
    assert {r.id for r in kept.collect()} == {"p6", "p7", "p8"} and removed.count() == 6


def test_greedy_keep_folds_long_chains(spark, monkeypatch):
    rng = random.Random(2)
    edges = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(90)} | {(i, i + 1) for i in range(60, 120)})
    kept, removed = set(), {}
    for n in range(121):
        near = [a for a, b in edges if b == n and a in kept]
        if near:
            removed[n] = min(near)
        else:
            kept.add(n)
    e = spark.createDataFrame(edges, "a int, b int")
    for rounds in (40, 2):
        monkeypatch.setattr(dedup, "GREEDY_ROUNDS", rounds)
        assert {r.removed: r.kept for r in dedup.greedy_keep(e).collect()} == removed
    assert dedup.greedy_keep(e.limit(0)).count() == 0


def paper_rows(spark, rows):
    return readers.from_list(spark, [dict(zip(("id", "title", "abstract", "doi", "ingest_seq", "keywords"), r, strict=False)) for r in rows])


def test_deduplicate_keeps_the_more_complete(spark):
    rows = [
        ("a", "A study of gene therapy in mice", "short", "10.1/X", 1), ("b", "Another title altogether", "a much longer abstract", "https://doi.org/10.1/x", 2), ("c", "A study of gene therapy in rats", "an abstract of some length", None, 3),
        ("d", "A study of gene therapy in rats!", "", None, 4), ("e", "Unlike any of them", None, None, 5), ("f", None, None, None, 6), ("g", "", None, "nan", 7), ("h", "A study of gene therapy in mice", "short", None, 8),
    ]
    kept, removed = dedup.deduplicate(paper_rows(spark, rows))
    log = {r.removed_id: (r.kept_id, r.reason) for r in removed.collect()}
    assert {r.id for r in kept.collect()} == {"b", "c", "e", "f", "g"} and kept.columns == readers.COLUMNS
    assert log["a"] == ("b", "doi_dup") and log["d"] == ("c", "title_sim_1.00") and log["h"][0] == "c" and log["h"][1] == "title_sim_0.87"
    counts = dedup.removal_counts(removed).first()
    assert (counts.n_removed, counts.n_doi, counts.n_title) == (3, 1, 2)
    plain, gone = dedup.deduplicate(paper_rows(spark, rows), compat=True)
    assert {r.id for r in plain.collect()} == {"c", "e", "f", "g"} and {r.removed_id: r.reason for r in gone.collect()}["b"] == "doi_dup"
    # a DOI that a third of all papers share
    many = [(f"p{i}", f"title {i:05d} {zlib.crc32(str(i).encode())}", "x" * (i % 7), "10.1/hot" if i % 3 == 0 else None, i) for i in range(600)]
    kept, _ = dedup.deduplicate(paper_rows(spark, many), 1.0)
    assert kept.count() == 401


def test_embedding_pairs_match_all_pairs(spark):
    rng = random.Random(3)
    base = [[rng.gauss(0, 1) for _ in range(32)] for _ in range(60)]
    rows = [(i, v) for i, v in enumerate(base)] + [(100 + i, [x + rng.gauss(0, 0.05 * (i % 8)) for x in v]) for i, v in enumerate(base)] + [(300, base[0]), (301, base[0]), (302, None), (303, [0.0] * 32)]
    norm = lambda v: sum(x * x for x in v) ** 0.5
    cos = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)) / norm(a) / norm(b)
    ok = [(i, v) for i, v in rows if v and any(v)]
    want = {(a, b) for k, (a, u) in enumerate(ok) for b, v in ok[k + 1 :] if cos(u, v) > 0.95}
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.a, r.b): r.similarity for r in dedup.embedding_pairs(d).collect()}
    # equal vectors meet others through the first of them only
    assert set(got) == {p for p in want if p[0] not in (300, 301) and (p[1] not in (300, 301) or p[0] == 0)} and len(got) > 30
    assert all(abs(s - cos(dict(ok)[a], dict(ok)[b])) < 1e-9 for (a, b), s in got.items())
    removed = {r.removed: r.kept for r in dedup.embedding_dedup(d).collect()}
    assert removed[300] == removed[301] == 0 and all(removed[100 + i] == i for i in (0, 1, 2) if (i, 100 + i) in want)
    bits, n = dedup.bands(10**9, 0.95, 0.999)
    assert bits == 30 and 100 < n < 300


def test_weighted_distances_match_dijkstra(spark):
    rng = random.Random(6)
    edges = {tuple(sorted(rng.sample("abcdefghijkl", 2))): rng.randrange(1, 6) for _ in range(20)}
    near = {}
    for (a, b), w in edges.items():
        near.setdefault(a, []).append((b, w))
        near.setdefault(b, []).append((a, w))
    want = {}
    for s in ("a", "c"):
        queue, seen = [(0, s)], {}
        while queue:
            x, n = heapq.heappop(queue)
            if n in seen or x > 7:
                continue
            seen[n] = x
            for m, w in near.get(n, ()):
                heapq.heappush(queue, (x + w, m))
        want |= {(s, n): x for n, x in seen.items()}
    e = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "keyword_a string, keyword_b string, weight long")
    got = {(r.source, r.node): r.distance for r in graph.distances(e, spark.createDataFrame([("a",), ("c",)], "node string"), 7).collect()}
    assert got == want


def test_communities_of_a_larger_graph(spark):
    """Planted groups are found again, whatever the number of nodes, and the result does not change."""
    rng = random.Random(9)
    groups = [[f"g{g}n{i}" for i in range(12)] for g in range(8)]
    edges = {tuple(sorted(rng.sample(g, 2))): 3 for g in groups for _ in range(40)} | {tuple(sorted((rng.choice(groups[k]), rng.choice(groups[(k + 1) % 8])))): 1 for k in range(8) for _ in range(2)}
    e = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "keyword_a string, keyword_b string, weight long")
    found = graph.communities(e, 1.0)
    own = {r.node: r.community for r in found.collect()}
    truth = e.select(F.col("keyword_a").alias("node")).union(e.select("keyword_b")).distinct().withColumn("community", F.regexp_extract("node", "g[0-9]+", 0))
    assert graph.modularity(e, found) >= graph.modularity(e, truth) - 0.05
    assert own == {r.node: r.community for r in graph.communities(e.repartition(7), 1.0).collect()}
    pruned = graph.prune(e, 10)
    assert 0 < pruned.count() <= e.count() and graph.prune(e, 1_000).count() == e.count()


def test_keyword_operators(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(["cats chase mice and cats sleep", "dogs chase cats", "mice eat cheese cheese cheese", None, "", "cats dogs mice birds"])]
    d = spark.createDataFrame(rows, "doc_id int, text string")
    assert keywords.common_words(d, share=0.4) == ["cats", "mice"]
    got = {(r.doc_id, r.rank): (r.keyword, r.n) for r in keywords.word_keywords(d, noise=[]).collect()}
    assert got[0, 1] == ("cats", 2) and got[2, 1] == ("cheese", 3) and got[0, 2] == ("chase", 1) and not any(i in (3, 4) for i, _ in got)
    few = keywords.tfidf_keywords(d, noise=[], min_df=2).collect()
    assert {r.keyword for r in few} <= {"cats", "chase", "dogs", "mice"} and not keywords.tfidf_keywords(d, noise=[], max_features=0).count()
    long = spark.createDataFrame([(1, "graph neural networks learn graph structure " * 3), (2, "short")], "doc_id int, text string")
    found = keywords.embedding_keywords(long, top=3).collect()
    assert {r.doc_id for r in found} == {1} and 1 <= len(found) <= 3 and all(r.score > 0.3 for r in found) and any("graph" in r.keyword for r in found)
    (tmp_path / "noise.txt").write_text("# own list\ncats\n\nDogs # pets\n")
    assert lexicon.read_words(str(tmp_path / "noise.txt")) == ["cats", "dogs"]
    p = paper_rows(spark, [(f"p{i}", f"t{i}", "A long abstract about protein folding in living cells and protein design." if i else None, None, i, ["the", "LNPs", "lnp"]) for i in range(7)])
    out = {r.id: r.keywords_normalized for r in keywords.with_keywords(p, method="words", noise=[]).collect()}
    assert out["p0"] == ["lipid nanoparticle"] and out["p1"][:2] == ["lipid nanoparticle", "protein"] and not keywords.has_abstracts(p.limit(3))
    assert all(r.keywords_normalized == ["lipid nanoparticle", "lipid nanoparticle"] for r in keywords.with_keywords(p, method="none", distinct=False).collect())


def test_long_arrays_make_no_row_of_all_pairs(spark):
    c = spark.createDataFrame([(1, 2020, ["k"], [f"a{i:04d}" for i in range(400)]), (2, 2021, None, ["a0001", "a0000"])], "paper_id int, year int, keywords array<string>, authors array<string>")
    assert [(r.author_a, r.author_b, r.weight) for r in biblio.author_network(c).collect()] == [("a0000", "a0001", 2)]
    assert biblio.author_network(c, 1).count() == 400 * 399 // 2
    t = biblio.keyword_years(c)
    assert biblio.papers_of(t) == 2 and [(r.year, r.n_papers) for r in biblio.years_of(t).collect()] == [(2020, 1)] and biblio.freq_of(t).count() == 1


def test_thresholds_as_documented(spark):
    """The registered queries relax some limits; the documented ones, on graphs made for them."""
    edges = spark.createDataFrame([("rare keyword", "hub", 2), ("hub", "other", 9), ("far end", "middle one", 2), ("middle one", "hub", 2)], "keyword_a string, keyword_b string, weight long")
    fk = spark.createDataFrame([("F1", 0.9, 0.5, "hub"), ("F2", 0.9, 0.5, "far end")], "community string, score double, growth double, node string")
    freq = spark.createDataFrame([("rare keyword", 1), ("middle one", 4), ("other", 50)], "keyword string, total_count long")
    assert [(r.keyword, r.proximity) for r in gaps.density_gaps(edges, fk, freq, 100).collect()] == [("rare keyword", 1.0)]
    assert [(r.f1, r.f2, r.distance, r.score) for r in gaps.semantic_gaps(edges, fk).collect()] == [("F1", "F2", 2, 0.45)]
    assert [(r.distance, r.score) for r in gaps.semantic_gaps(edges, fk, by_weight=True).collect()] == [(4.0, 0.225)]
    years = spark.createDataFrame([(y,) for y in range(2015, 2021)], "year int")
    y = spark.createDataFrame([("gone", 2015, 20), ("gone", 2020, 2), ("few", 2015, 9), ("stays", 2016, 30), ("stays", 2019, 30)], "keyword string, year int, n long")
    assert [(r.keyword, r.early, r.late, r.decline_ratio, r.peak_year) for r in biblio.temporal_decline(y, years, 100).collect()] == [("gone", 20, 2, 0.1, 2015)]
    none = spark.createDataFrame([], "rank int, gap_type string, label string, gap_score double, opportunity string")
    assert [r.label for r in gaps.ranked_or_inferred(none, edges, fk).collect()] == ["Bridge: F1 <-> F2", "Broker: middle one"]
    assert gaps.ranked_or_inferred(none, edges, fk.limit(0)).count() == 0
    assert (quality.confidence(100, 9, 90), quality.confidence(10, 9, 90), quality.confidence(10, 2, 0), quality.item_confidence(0.4), quality.item_confidence(0.2), quality.item_confidence(0.9, inferred=True)) == ("HIGH", "MEDIUM", "LOW", "MEDIUM", "LOW", "LOW (inferred)")
    assert T.years_of("2019 - 2024") == (2019, 2024) == T.years_of("2019\u20132024") and T.years_of("soon") is None
    assert T.year_filter("pubmed", (2019, 2024)) == "2019:2024[dp]" and T.year_filter("semantic_scholar", (2019, 2024)) == "" and T.doi_filters(["10.1/A", "10.1/a ", "", "10.1/b"], 1) == ["doi:10.1/a", "doi:10.1/b"]


def pdf(text, title=""):
    stream = zlib.compress(("BT /F1 12 Tf " + " ".join(f"({x}) Tj T*" for x in text.split("\n")) + " ET").encode("latin-1"))
    info = f"<< /Title ({title}) /ModDate (D:20240101) /Keywords (Cells; genes) >>" if title else "<< >>"
    return b"%PDF-1.4\n1 0 obj\n" + info.encode() + b"\nendobj\n2 0 obj\n<< /Length 9 /Filter /FlateDecode >>\nstream\n" + stream + b"\nendstream\nendobj\n%%EOF"


def test_pdf_folder(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.pdf").write_bytes(pdf("An \\(odd\\) title of a paper on cells\nsee 10.1234/ab.C. of 2021"))
    (tmp_path / "in" / "deep" / "b.PDF").write_bytes(pdf("too short", "Given title of this very paper"))
    (tmp_path / "in" / "c.pdf").write_bytes(b"no pdf at all")
    (tmp_path / "in" / "d.txt").write_text("x")
    got = {r.file.rsplit("/", 1)[1]: r for r in readers.read(spark, "pdf", str(tmp_path / "in")).collect()}
    assert set(got) == {"a.pdf", "b.PDF", "c.pdf"}
    assert (got["a.pdf"].title, got["a.pdf"].doi, got["a.pdf"].year, got["a.pdf"].extraction_quality) == ("An (odd) title of a paper on cells", "10.1234/ab.c", 2021, "high")
    assert got["b.PDF"].title == "Given title of this very paper" and got["b.PDF"].keywords == ["cells", "genes"] and got["c.pdf"].extraction_quality == "failed" and got["c.pdf"].error
    d = readers.read(spark, "pdf", str(tmp_path / "in"))
    assert readers.valid(d).count() == 2
    assert sinks.digest(spark, str(tmp_path / "in")) == sinks.digest(spark, str(tmp_path / "in"))


def crossref_item(doi, **more):
    return {"DOI": doi, "title": ["T " + doi], "author": [{"family": "Doe", "given": "Jane"}, {"family": "Group"}], "issued": {"date-parts": [[2019]]}, "container-title": ["J"], "abstract": "found", "subject": ["Cells"], **more}


def test_services_behind_a_function(spark, tmp_path):
    item = types.FunctionType(crossref_item.__code__, {})  # goes with the function to workers that do not know this file

    def fetch(service, request, page):
        if service == "openalex":
            return None
        if request.startswith("doi:"):
            return json.dumps({"message": {"items": [item(d[4:].upper()) for d in request.split(",") if "unknown" not in d]}})
        if request.startswith("title:"):
            return json.dumps({"message": {"items": [item("10.5/first"), item("10.5/second")]}})
        assert request == "gene therapy&from-pub-date:2018-01-01,until-pub-date:2020-12-31" and service == "crossref"
        return json.dumps({"message": {"items": [item(f"10.{page}/{k:02d}", **({"created": {"date-parts": [[1999]]}, "issued": {}} if k == 7 else {})) for k in range(60)]}})

    got = readers.search_any(spark, "基因治疗", fetch, max_results=100, years=(2018, 2020), lang="zh")
    assert got.count() == 59 and {r.source for r in got.select("source").distinct().collect()} == {"crossref"} and got.first().authors == ["Doe, Jane", "Group"]
    assert readers.search_any(spark, "x", lambda *a: None).count() == 0
    calls = []

    def flaky(service, request, page):
        calls.append(page)
        if len(calls) < 3:
            raise OSError("busy")
        return "ok"

    assert readers.retried(flaky, wait=0.0)("crossref", "x", 1) == "ok" and readers.retried(lambda *a: 1 / 0, tries=2, wait=0.0)("crossref", "x", 1) is None
    (tmp_path / "a.csv").write_text("doi,title,abstract,year,journal,keywords\n10.7/A,,,,,\n10.7/unknown,U,,,,\n10.7/rich,R," + "long " * 40 + ",,,k\n,none,,,,\n")
    rows = {r.title: r for r in readers.read(spark, "csv", str(tmp_path / "a.csv"), fetch=fetch).collect()}
    assert rows["T 10.7/A"].year == 2019 and rows["T 10.7/A"].journal == "J" and rows["T 10.7/A"].keywords == ["cells"] and rows["U"].year is None and rows["R"].year is None and len(rows) == 4
    assert readers.lookup_title(spark, "any", fetch).first().doi == "10.5/first"
    (tmp_path / "c.json").write_text(json.dumps({"seed": "s", "data": [{"paperId": "p1", "title": "One"}, {"citingPaper": {"paperId": "p2", "title": "Two", "externalIds": {"DOI": "10.1/Two"}}}, {"citedPaper": {"paperId": "s"}}, {"title": "no id"}]}))
    found = readers.read(spark, "citations", str(tmp_path / "c.json"))
    assert {(r.id, r.seed_paper_id) for r in found.collect()} == {("p1", "s"), ("p2", "s"), ("s", "s")}
    corpus = paper_rows(spark, [("s", "Seed", None, None), ("q", "Q", None, "https://doi.org/10.1/TWO")])
    assert [r.id for r in dedup.new_papers(found, corpus, 50).collect()] == ["p1"]
    (tmp_path / "cr.json").write_text(json.dumps({"message": {"items": [item("10.9/Z", volume="3", page="1-2", publisher="P", URL="u", type="journal-article")]}}))
    (r,) = readers.read(spark, "crossref", str(tmp_path / "cr.json")).collect()
    assert (r.doi, r.title, r.year, r.journal, r.volume, r.pages, r.publisher, r.url, r.entry_type, r.keywords) == ("10.9/z", "T 10.9/Z", 2019, "J", "3", "1-2", "P", "u", "journal-article", ["cells"])
    (tmp_path / "x.jsonl").write_text('{"id":"1","year":"2020","citation_count":"many"}\n{"id":"2","year":"x"}\nnot json\n\n')
    x = {r.id: (r.year, r.citation_count) for r in readers.read(spark, "jsonl", str(tmp_path / "x.jsonl")).collect()}
    assert x == {"1": (2020, 0), "2": (None, None)} and readers.malformed_lines(spark, str(tmp_path / "x.jsonl")) == 1
    with pytest.raises(ValueError):
        readers.read(spark, "none", "x")


def bibliography(n, first=0, year=2015):
    topics = [["gene therapy", "crispr", "lnp"], ["deep learning", "graph", "protein"], ["cell culture", "microscopy", "imaging"]]
    rng = random.Random(first + 1)
    out = []
    for i in range(first, first + n):
        words = rng.sample(topics[i % 3], 2) + ([rng.choice(topics[(i + 1) % 3])] if rng.random() < 0.2 else [])
        text = f"This abstract number {i} tells of {' and '.join(words)} in many words that go on for a while"
        out.append(f"@article{{k{i}, title={{{hashlib.sha256(str(i).encode()).hexdigest()}}}, author={{Doe, Jane and Roe, R{i % 4}}}, year={year + i % 8}, journal={{J{i % 5}}}, doi={{10.1/{i}}}, keywords={{{'; '.join(words)}}}, abstract={{{text}}}}}")
    return "\n".join(out)


@pytest.mark.parametrize("compat", [False, True])
def test_run_from_bibtex_to_summary(spark, tmp_path, compat):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.bib").write_text(bibliography(90) + "\n" + bibliography(3))
    out = tmp_path / "out"
    p = Pipeline(spark, str(out), Config(compat=compat, adaptive=not compat), cache=True)
    with pytest.raises(FileNotFoundError):
        p.run(start=3)
    stats = p.run("bibtex", str(tmp_path / "in"), years="2015-2022", method="words", noise=["this", "abstract", "number", "tells", "many", "words", "that", "while"])
    assert stats["total_papers"] == 90 and stats["n_doi"] == 3 and stats["n_with_abstract"] == 90 and len(stats["top_keywords_20"]) > 5 and stats["author_collab_pairs"] > 0
    clean_csv = next((out / "clean_corpus.csv").glob("part-*.csv")).read_bytes()
    assert clean_csv.startswith(b"\xef\xbb\xbfid,title,authors,year")
    back = readers.read(spark, "clean", str(out / "clean_corpus.csv"))
    assert back.count() == 90 and back.filter("size(keywords_normalized) > 1 and year between 2015 and 2022 and authors[0] = 'Doe, Jane'").count() == 90
    front, gap = json.loads((out / "frontiers.json").read_text()), json.loads((out / "gaps.json").read_text())
    assert front["topology"]["n_communities"] >= 2 and gap["gap_summary"]["top_n"] == len(gap["gaps"])
    context = json.loads((out / "report" / "report_context.json").read_text())
    assert context["corpus_stats"]["n_papers"] == 90 and context["corpus_stats"]["abstract_pct"] == 100.0 and context["network"]["nodes"] and len(context["papers"]) == 90
    summary = (out / "report" / "summary.txt").read_text()
    assert "Papers: 90, years 2015-2022" in summary and "Confidence: HIGH" in summary and "--- Gaps ---" in summary and (out / "report" / "report.md").read_text().startswith("# Frontiers")
    assert {x["trend"] for x in stats["top_keywords_20"]} <= {"rising", "declining", "stable"} and json.loads((out / "trends.json").read_text())["years"] == list(range(2015, 2023))
    if compat:
        return
    assert p.check()["verdict"] in ("good", "fair") and p.check()["thresholds"]["n_papers"] == 90
    # the same again takes the phases from before; another setting does not
    changed = (out / "gaps.json").stat().st_mtime_ns
    p.run("bibtex", str(tmp_path / "in"), years="2015-2022", method="words", noise=["this", "abstract", "number", "tells", "many", "words", "that", "while"])
    assert (out / "gaps.json").stat().st_mtime_ns == changed
    (tmp_path / "more.bib").write_text(bibliography(10, 200))
    assert p.append("bibtex", str(tmp_path / "more.bib"), method="none")["total_papers"] == 100
    assert p.expand(paper_rows(spark, [("n1", "A wholly new paper", None, None), ("n2", "Known by its DOI", None, "10.1/5")]), method="none")["total_papers"] == 101
    with pytest.raises(Timeout):
        Pipeline(spark, str(out), phase_seconds=0.01).run(start=3, stop=3)


def test_clean_by_parts(spark):
    p = paper_rows(spark, [("a", "First of the titles", None, "10.1/a", 1), ("b", "Second and other", "x" * 60, None, 2), ("c", "Third one here", None, None, 3)])
    p = p.withColumn("error", F.when(F.col("id") == "c", "damaged")).withColumn("year", F.lit(2020))
    known = paper_rows(spark, [("x", "T", "an abstract from elsewhere", "10.1/A")]).withColumn("journal", F.lit("J"))
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.01])], "id string, embedding array<double>")
    out, removed = clean(p, method="none", lookup=known, vectors=vectors, years="2019-2021")
    assert [(r.id, r.abstract, r.journal) for r in out.collect()] == [("a", "an abstract from elsewhere", "J")] and [(r.reason, r.removed_id) for r in removed.collect()] == [("embedding_sim", "b")]
    assert clean(p, method="none", years="1990-1999")[0].count() == 0


def test_report_parts(spark):
    p = readers.from_list(spark, [{"id": str(i), "title": "t" * 300, "year": 2020 + i % 2, "keywords": ["k"], "authors": ["a" * 90, "b" * 90]} for i in range(3)])
    (r, *_) = report.paper_rows(p, 2).collect()
    assert len(r.title) == 200 and len(r.authors) == 100 and report.paper_rows(p, 2).count() == 2
    assert [(x.year, len(x.titles)) for x in report.papers_by_year(p, "k", 1).collect()] == [(2020, 1), (2021, 1)] and report.search(p, "title", "TTT").count() == 3
    b = spark.createDataFrame([("k", 2020, 2021, 3.0), ("k", 2023, 2023, 9.0), ("m", 2022, 2023, 5.0)], "keyword string, burst_start int, burst_end int, intensity double")
    years = spark.createDataFrame([(y,) for y in range(2020, 2025)], "year int")
    assert frontier.active_bursts(b, years) == 2 and frontier.active_bursts(b, years.limit(1)) == 2
    freq = spark.createDataFrame([("k", 4), ("m", 5)], "keyword string, total_count long")
    assert [r.keyword for r in frontier.burst_list(b, freq, freq.withColumn("cagr_3yr", F.lit(0.1))).collect()] == ["m", "k"]


def test_stream_appends_and_runs_again(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.bib").write_text(bibliography(40))
    p = Pipeline(spark, str(tmp_path / "out"))
    p.run("bibtex", str(tmp_path / "in"), method="none", stop=2)
    assert catalog.register_views(p, "run_") == ["run_raw_corpus", "run_corpus", "run_removed"] and spark.sql("SELECT count(*) FROM run_corpus").first()[0] == 40
    catalog.register_functions(spark)
    assert spark.sql("SELECT title_ratio('tide', 'diet')").first()[0] == 0.25
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "1.json").write_text(json.dumps({"id": "n1", "title": "Something else entirely", "year": 2020}) + "\n")
    incremental.rerun(spark, str(tmp_path / "inbox"), p, str(tmp_path / "ck"), method="none", stop=2).awaitTermination(120)
    assert p.table("corpus").count() == 41
    incremental.rerun(spark, str(tmp_path / "inbox"), p, str(tmp_path / "ck"), method="none", stop=2).awaitTermination(120)
    assert p.table("corpus").count() == 41
    e = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 01:10:00", "b", 4.0)], "t string, event_type string, value double").withColumn("ts", F.to_timestamp("t"))
    assert sorted((r.event_type, r.n, r.total) for r in incremental.windowed_counts(e).collect()) == [("a", 2, 3.0), ("b", 1, 4.0)]


def test_scratch_tables_go(spark, tmp_path):
    import os

    with store.scratch(spark) as made:
        kept = store.materialize(spark.range(3), "kept")
        gone = store.materialize(spark.range(3), "gone")
        made.remove(kept._paperloom_path)
    there = lambda df: os.path.isdir(df._paperloom_path.removeprefix("file://"))
    assert there(kept) and not there(gone) and kept.count() == 3
    assert T.hue(F.lit(3)) is not None and sinks.to_json({"x": float("inf")}).count("Infinity") == 1
