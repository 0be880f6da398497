"""Readers on small files of every awkward kind."""

import json

from pyspark.sql import functions as F

from paperloom.sources import readers, sinks
from paperloom.streaming import incremental

BIB = """% a comment
@string{x = "y"}
@article{k1,
  title = {A {Nested} title}, author = {Ada B Lovelace and Plato},
  year = 2024, month = jan,
  % inside
  journal = "Quoted, name", keywords = {One; two, Three},
  url = {https://doi.org/10.1234/AB.c}
}
@misc{k2, title={No year here but 1999}}
"""
RIS = "TY  - JOUR\nT1  - First\nTI  - Second\nAU  - Doe, Jane\nAU  - Ada Lovelace\nPY  - 2024/01/01\nSP  - 1\nEP  - 9\nKW  - A; b\nKW  - C\nER  - \nTY  - XXXX\nTI  - Open end\n"


def test_readers(spark, tmp_path):
    (tmp_path / "a.bib").write_text(BIB)
    (tmp_path / "a.ris").write_text(RIS)
    (tmp_path / "a.csv").write_text('DOI,Title,author,Year,keywords\nhttps://doi.org/10.1/X,"T, 1","Doe, Jane; Roe, Ann",2020,"a; b"\nnan,T2,,x,\n')
    (tmp_path / "o.json").write_text(json.dumps({"results": [{"id": "W1", "title": "T", "publication_year": 2020, "ids": {"doi": "https://doi.org/10.1/Y"}, "authorships": [{"author": {"display_name": "Ada Lovelace"}}], "abstract_inverted_index": {"world": [1], "hello": [0]}, "keywords": [], "concepts": [{"level": 0, "display_name": "Biology"}, {"level": 2, "display_name": "Cell"}]}]}))
    (tmp_path / "p.jsonl").write_text('{"id":"1","title":"t","year":2020}\nnot json\n')
    b = {r.id: r for r in readers.read_bibtex(spark, str(tmp_path / "a.bib")).collect()}
    assert set(b) == {"k1", "k2"} and b["k1"].title == "A Nested title" and b["k1"].authors == ["Lovelace, Ada B", "Plato"] and b["k1"].keywords == ["one", "two", "three"]
    assert b["k1"].doi == "10.1234/ab.c" and b["k1"].journal == "Quoted, name" and (b["k1"].year, b["k2"].year) == (2024, 1999)
    r = {x.title: x for x in readers.read_ris(spark, str(tmp_path / "a.ris")).collect()}
    assert r["First"].authors == ["Doe, Jane", "Lovelace, Ada"] and r["First"].pages == "1-9" and r["First"].keywords == ["a", "b", "c"] and r["First"].year == 2024
    assert r["Open end"].entry_type == "misc"
    c = {x.title: x for x in readers.read_csv(spark, str(tmp_path / "a.csv")).collect()}
    assert c["T, 1"].authors == ["Doe, Jane", "Roe, Ann"] and c["T, 1"].doi == "10.1/x" and c["T2"].doi is None and c["T2"].year is None
    o = readers.read_openalex(spark, str(tmp_path / "o.json")).first()
    assert o.abstract == "hello world" and o.authors == ["Lovelace, Ada"] and o.keywords == ["cell"] and o.doi == "10.1/y"
    assert readers.read_jsonl(spark, str(tmp_path / "p.jsonl")).filter("id is not null").count() == 1
    ris = readers.read_ris(spark, str(tmp_path / "a.ris"))
    sinks.write_clean(ris.withColumn("keywords_normalized", F.col("keywords")), str(tmp_path / "out"))
    back = {r.title: r for r in readers.read_clean(spark, str(tmp_path / "out")).collect()}
    assert len(readers.read_clean(spark, str(tmp_path / "out")).columns) == 13 and back["First"].authors == ["Doe, Jane", "Lovelace, Ada"] and back["First"].keywords_raw == ["a", "b", "c"] and back["First"].year == 2024
    sinks.write_raw(ris, str(tmp_path / "raw"))
    assert sorted(r.title for r in readers.read_jsonl(spark, str(tmp_path / "raw")).collect()) == ["First", "Open end"]
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "1.json").write_text('{"id":"1"}\n')
    incremental.append_papers(spark, str(tmp_path / "inbox"), str(tmp_path / "corpus"), str(tmp_path / "ck")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "corpus")).count() == 1


def test_payloads_of_services(spark, tmp_path):
    (tmp_path / "s2.json").write_text(json.dumps({"data": [{"paperId": "p1", "title": "T", "authors": [{"name": "Ada Lovelace"}], "year": 2021, "venue": {"name": "V"}, "abstract": None, "externalIds": {"DOI": "10.1/Z"}, "citationCount": 3}, {"paperId": "p2", "venue": "W"}]}))
    (tmp_path / "p.xml").write_text("""<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID Version="1">7</PMID><Article><Journal><JournalIssue><PubDate><Year>2019</Year></PubDate></JournalIssue><Title>J</Title></Journal><ArticleTitle>On cells</ArticleTitle>
<ELocationID EIdType="pii">x</ELocationID><ELocationID EIdType="doi">10.1/Q</ELocationID><Abstract><AbstractText>One.</AbstractText><AbstractText>Two.</AbstractText></Abstract><AuthorList><Author><LastName>Doe</LastName><ForeName>Jane</ForeName></Author></AuthorList></Article><KeywordList><Keyword>Cell</Keyword></KeywordList></MedlineCitation></PubmedArticle></PubmedArticleSet>""")
    s = {r.id: r for r in readers.read_semantic_scholar(spark, str(tmp_path / "s2.json")).collect()}
    assert s["p1"].journal == "V" and s["p2"].journal == "W" and s["p1"].doi == "10.1/z" and s["p1"].authors == ["Lovelace, Ada"] and s["p1"].citation_count == 3 and s["p1"].abstract is None
    (p,) = readers.read_pubmed(spark, str(tmp_path / "p.xml")).collect()
    assert (p.id, p.title, p.abstract, p.year, p.journal, p.doi, p.authors, p.keywords) == ("pmid:7", "On cells", "One. Two.", 2019, "J", "10.1/q", ["Doe, Jane"], ["cell"])
