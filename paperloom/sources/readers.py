"""Readers of bibliographic files and of the payloads of services; all give rows of one paper schema.

A service's payloads come from files, or from `fetch`, a function that the caller supplies (it may use the network; nothing here
does): it runs in the executors, a page or a batch of DOIs at a time.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon
from ..functions.text import doi_filters, extract_doi, extract_year, first_non_empty, inverted_abstract, normalize_author, normalize_doi, page_range, person, split_keywords, split_stored, translate_query, year_between, year_filter
from ..operators.dedup import enrich, is_rich, needs_enrichment
from ..operators.ship import ship
from ..schemas import CLEAN, PAPER, columns_of

COLUMNS = list(columns_of(PAPER))
_ENTRY = re.compile(r"@(\w+)\s*[{(]\s*", re.IGNORECASE)


def paper(df: DataFrame, **columns: Column) -> DataFrame:
    """df with the columns of PAPER, null where not given."""
    return df.select(*[(columns[c] if c in columns else F.lit(None)).cast(t).alias(c) for c, t in columns_of(PAPER).items()])


def bibtex_entries(text: str) -> list[dict]:
    """Fields of each entry: nested braces, quotes, bare words, # joins; comment lines and @string, @comment, @preamble are left out."""
    text = "\n".join(x for x in (text or "").splitlines() if not x.lstrip().startswith("%"))
    out, at = [], 0
    while m := _ENTRY.search(text, at):
        depth, end = 1, m.end()
        while end < len(text) and depth:
            depth += {"{": 1, "}": -1, "(": 0, ")": 0}.get(text[end], 0)
            end += 1
        body, at = text[m.end() : end - 1], end
        if m[1].lower() in ("string", "comment", "preamble"):
            continue
        key, _, rest = body.partition(",")
        entry = {"entry_type": m[1].lower(), "id": key.strip()}
        i = 0
        while f := re.compile(r"\s*,?\s*([\w-]+)\s*=\s*").match(rest, i):
            i, value = f.end(), ""
            if i < len(rest) and rest[i] in '{"':
                closing, depth, start = ("}" if rest[i] == "{" else '"'), 0, i + 1
                i += 1
                while i < len(rest) and not (depth == 0 and rest[i] == closing):
                    depth += {"{": 1, "}": -1}.get(rest[i], 0)
                    i += 1
                value, i = rest[start:i], i + 1
            else:
                bare = re.compile(r"[^,\s]*").match(rest, i)
                value, i = bare[0], bare.end()
            entry[f[1].lower()] = re.sub(r"\s+", " ", value.replace("{", "").replace("}", "")).strip()
        out.append(entry)
    return out


def ris_records(text: str) -> list[dict]:
    """Fields of each record, all values of a tag in order; the last record may lack its end."""
    out, now = [], {}
    for line in (text or "").lstrip("﻿").splitlines():
        m = re.match(r"([A-Z][A-Z0-9])  -\s?(.*)", line)
        if not m:
            continue
        if m[1] == "ER":
            out.append(now)
            now = {}
        elif m[1] == "TY":
            now["entry_type"] = [lexicon.RIS_TYPES.get(m[2].strip(), "misc")]
        elif m[1] in lexicon.RIS_TAGS:
            now.setdefault(lexicon.RIS_TAGS[m[1]], []).append(m[2].strip())
    return [r for r in [*out, now] if r]


def _parsed(spark: SparkSession, path: str, parse, value: str) -> DataFrame:
    ship(spark)

    @F.pandas_udf(f"array<map<string,{value}>>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([parse(t) for t in texts])

    return spark.read.text(path, wholetext=True).select(F.explode(run("value")).alias("m"))


def read_bibtex(spark: SparkSession, path: str) -> DataFrame:
    d = _parsed(spark, path, bibtex_entries, "string")
    g = lambda k: F.try_element_at("m", F.lit(k))
    every = F.array_join(F.map_values("m"), " ")
    return paper(
        d, **{c: g(c) for c in ("id", "entry_type", "title", "journal", "booktitle", "volume", "number", "pages", "abstract", "publisher", "url")}, raw=F.col("m"), source=F.lit("bibtex"),
        authors=F.transform(F.split(g("author"), r"\s+and\s+"), lambda x: normalize_author(x)), keywords=split_keywords(g("keywords")),
        year=F.coalesce(extract_year(g("year")), extract_year(every)), doi=normalize_doi(F.coalesce(F.nullif(g("doi"), F.lit("")), extract_doi(g("url")))),
    )


def read_ris(spark: SparkSession, path: str) -> DataFrame:
    d = _parsed(spark, path, ris_records, "array<string>")
    g = lambda k: F.try_element_at("m", F.lit(k))
    one = lambda k: F.get(F.filter(g(k), lambda x: x != ""), 0)
    return paper(
        d, id=F.sha2(F.concat_ws("|", one("title"), one("year")), 256), **{c: one(c) for c in ("entry_type", "title", "volume", "number", "abstract", "publisher", "url")}, source=F.lit("ris"),
        journal=F.coalesce(one("journal"), one("journal_abbrev")), pages=page_range(one("pages_start"), one("pages_end")), year=extract_year(one("year")), doi=normalize_doi(one("doi")),
        authors=F.transform(g("author"), lambda x: normalize_author(x)), keywords=F.flatten(F.transform(g("keywords"), lambda x: split_keywords(x))),
    )


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headers in several spellings; authors split at ';' where there is one, else at ','."""
    d = spark.read.csv(path, header=True, multiLine=True, escape='"')
    names = {c.strip().lstrip("﻿").lower(): c for c in d.columns}
    g = lambda *keys: first_non_empty(*[F.col(f"`{names[k]}`") for k in keys if k in names])
    a = g("authors", "author")
    people = F.filter(F.transform(F.when(F.instr(a, ";") > 0, F.split(a, ";")).otherwise(F.split(a, ",")), lambda x: normalize_author(F.trim(x))), lambda x: x != "")
    title = F.nullif(g("title"), F.lit(""))
    return paper(d, id=F.sha2(F.concat_ws("|", title, g("doi")), 256), title=title, authors=people, year=g("year").try_cast("int"), journal=F.nullif(g("journal"), F.lit("")), abstract=F.nullif(g("abstract"), F.lit("")), keywords=split_keywords(g("keywords")), doi=normalize_doi(g("doi")), source=F.lit("csv"))


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Papers as JSON lines; malformed lines are left out (malformed_lines() counts them). Bad years and counts become null and 0."""
    text = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    loose = PAPER.replace("year int", "year string").replace("citation_count int", "citation_count string")
    r = text.select(F.from_json("value", loose + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r")).select("r.*").filter("_bad is null").drop("_bad")
    return r.withColumn("year", F.col("year").try_cast("int")).withColumn("citation_count", F.when(F.col("citation_count").isNotNull(), F.coalesce(F.col("citation_count").try_cast("int"), F.lit(0)))).select(*COLUMNS)


def malformed_lines(spark: SparkSession, path: str) -> int:
    text = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    return text.filter(F.from_json("value", "_bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})["_bad"].isNotNull()).count()


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned corpus that sinks.write_clean() wrote: the thirteen columns, typed again."""
    types = columns_of(CLEAN)
    d = spark.read.schema(", ".join(f"{c} string" for c in types)).csv(path, header=True, multiLine=True, escape='"', enforceSchema=True)
    cast = lambda c, t: split_stored(F.coalesce(F.col(c), F.lit(""))) if t.startswith("array") else F.col(c).try_cast(t)
    return d.select(*[cast(c, t).alias(c) for c, t in types.items()])


def from_list(spark: SparkSession, papers: list[dict]) -> DataFrame:
    """Papers given one by one, as pasted; unknown fields are left out."""
    rows = [tuple(p.get(c) for c in COLUMNS) for p in papers]
    return spark.createDataFrame(rows, PAPER)


def valid(papers: DataFrame) -> DataFrame:
    """Without rows that report an error or a failed extraction."""
    return papers.filter((F.coalesce("error", F.lit("")) == "") & ~F.coalesce("extraction_quality", F.lit("")).eqNullSafe("failed"))


# ---- PDF -----------------------------------------------------------------------------------------------------------

_STREAM = re.compile(rb"<<(.*?)>>\s*stream\r?\n(.*?)\r?\nendstream", re.DOTALL)
_STRING = r"\((?:\\.|[^\\()])*\)"
_SHOWN = re.compile(rf"({_STRING}|\[(?:[^\[\]\\]|\\.)*\])\s*(?:Tj|TJ|'|\")|(T\*|Td|TD|ET)", re.DOTALL)
_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "b": "", "f": ""}
PDF_PAGES, PDF_CHARS = 2, 5_000


def _pdf_string(raw: str) -> str:
    body = re.sub(r"\\([0-7]{1,3}|.)", lambda m: chr(int(m[1], 8)) if m[1][0] in "01234567" else _ESCAPES.get(m[1], m[1]), raw[1:-1], flags=re.DOTALL)
    if body.startswith("\xfe\xff"):
        return body[2:].encode("latin-1").decode("utf-16-be", "replace")
    return body


def pdf_text(content: bytes) -> tuple[str, dict[str, str]]:
    """The text that a plain PDF shows (content streams, bare or deflated, in file order) and its information fields, names in lower
    case. Encodings by embedded fonts are not undone."""
    if not content.startswith(b"%PDF"):
        raise ValueError("no PDF")
    info = {k.decode("latin-1").lower(): _pdf_string(v.decode("latin-1")) for k, v in re.findall(rb"/(Title|Author|Subject|Keywords|ModDate|CreationDate)\s*(\((?:\\.|[^\\()])*\))", content, re.IGNORECASE | re.DOTALL)}
    pages = []
    for head, body in _STREAM.findall(content):
        if b"FlateDecode" in head:
            try:
                body = zlib.decompress(body)
            except zlib.error:
                continue
        text = body.decode("latin-1")
        if not re.search(r"\bBT\b", text):
            continue
        parts = []
        for m in _SHOWN.finditer(text):
            parts += ["\n"] if m[2] else [_pdf_string(x) for x in re.findall(_STRING, m[1], re.DOTALL)]
        pages.append(re.sub(r"\n\s*\n+", "\n", "".join(parts)).strip())
    return "\n".join(pages[:PDF_PAGES])[:PDF_CHARS], info


def _pdf(content: bytes) -> dict[str, str]:
    try:
        text, info = pdf_text(content)
        if not text and not info:
            raise ValueError("no text")
        first = next((line.strip() for line in text.split("\n") if len(line.strip()) > 20), "")
        return {"title": info.get("title", "").strip() or first, "author": info.get("author", ""), "date": info.get("moddate", ""), "keywords": info.get("keywords", ""), "text": text, "error": ""}
    except Exception as e:  # a damaged file is a row with an error, it ends no job
        return {"error": str(e) or type(e).__name__}


def read_pdf(spark: SparkSession, path: str) -> DataFrame:
    """One row a PDF of a file or folder (with the folders inside): title, DOI, year and keywords from its information and its first
    pages. extraction_quality is high with a DOI or a title of over 20 characters, low without, failed with an error."""
    ship(spark)

    @F.pandas_udf("map<string,string>")
    def run(contents: pd.Series) -> pd.Series:
        return pd.Series([_pdf(bytes(c)) for c in contents])

    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]").load(path).select("path", run("content").alias("m"))
    g = lambda k: F.try_element_at("m", F.lit(k))
    text = F.coalesce(g("text"), F.lit(""))
    doi = F.nullif(extract_doi(text), F.lit(""))
    failed = F.coalesce(g("error"), F.lit("")) != ""
    quality = F.when(failed, "failed").when(doi.isNotNull() | (F.length(g("title")) > 20), "high").otherwise("low")
    return paper(
        d, id=F.sha2("path", 256), file=F.col("path"), title=g("title"), doi=normalize_doi(doi), year=F.coalesce(extract_year(g("date")), extract_year(text)), abstract=F.nullif(F.substring(text, 1, 1_000), F.lit("")),
        authors=F.filter(F.transform(F.split(F.coalesce(g("author"), F.lit("")), r"\s*(?:;|\band\b)\s*"), lambda x: normalize_author(x)), lambda x: x != ""), keywords=split_keywords(F.coalesce(g("keywords"), F.lit(""))),
        extraction_quality=quality, error=F.nullif(g("error"), F.lit("")), source=F.lit("pdf"),
    )


# ---- services --------------------------------------------------------------------------------------------------------


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def _items(payloads: DataFrame, schema: str, items: str) -> DataFrame:
    return payloads.select(F.from_json("value", schema).alias("p")).select(F.explode(f"p.{items}").alias("r")).select("r.*")


def parse_openalex(payloads: DataFrame) -> DataFrame:
    """Result pages of a works search. payloads: value, one text each."""
    schema = "results array<struct<id:string,title:string,publication_year:int,cited_by_count:int,ids:struct<doi:string>,authorships:array<struct<author:struct<display_name:string>>>,primary_location:struct<source:struct<display_name:string>>,abstract_inverted_index:map<string,array<int>>,keywords:array<struct<display_name:string>>,concepts:array<struct<level:int,display_name:string>>>>"
    r = _items(payloads, schema, "results")
    own = F.filter(F.transform("keywords", lambda k: F.lower(k["display_name"])), lambda k: F.length(k) > 2)
    broad = F.slice(F.transform(F.filter("concepts", lambda c: c["level"] >= 2), lambda c: F.lower(c["display_name"])), 1, 5)
    n = F.size(F.coalesce(own, F.array()))
    both = F.slice(F.array_distinct(F.concat(F.coalesce(own, F.array().cast("array<string>")), F.coalesce(broad, F.array().cast("array<string>")))), F.lit(1), F.greatest(n, F.least(F.lit(8), n + 3)))
    return paper(r, id=F.col("id"), title=F.col("title"), year=F.col("publication_year"), citation_count=F.col("cited_by_count"), doi=normalize_doi(F.col("ids.doi")), journal=F.col("primary_location.source.display_name"), abstract=inverted_abstract(F.col("abstract_inverted_index")), authors=F.transform("authorships", lambda a: normalize_author(a["author"]["display_name"])), keywords=both, source=F.lit("openalex"))


def parse_crossref(payloads: DataFrame) -> DataFrame:
    """Result pages of a works query, or of a look-up by DOIs."""
    schema = "message struct<items:array<struct<DOI:string,title:array<string>,author:array<struct<family:string,given:string>>,issued:struct<`date-parts`:array<array<int>>>,`published-print`:struct<`date-parts`:array<array<int>>>,created:struct<`date-parts`:array<array<int>>>,`container-title`:array<string>,abstract:string,subject:array<string>,volume:string,page:string,publisher:string,URL:string,type:string,`is-referenced-by-count`:int>>>"
    r = _items(payloads, schema, "message.items")
    year = F.coalesce(*[F.get(F.get(F.col(f"`{c}`.`date-parts`"), 0), 0) for c in ("published-print", "issued", "created")])
    return paper(
        r, id=F.col("DOI"), doi=normalize_doi(F.col("DOI")), title=F.get("title", 0), authors=F.filter(F.transform("author", lambda a: person(a["family"], a["given"])), lambda x: x.isNotNull()), year=year, journal=F.get("container-title", 0),
        abstract=F.col("abstract"), keywords=F.transform("subject", lambda s: F.lower(s)), volume=F.col("volume"), pages=F.col("page"), publisher=F.col("publisher"), url=F.col("URL"), entry_type=F.col("type"), citation_count=F.col("is-referenced-by-count"), source=F.lit("crossref"),
    )


_S2 = "paperId:string,title:string,authors:array<struct<name:string>>,year:int,venue:string,abstract:string,externalIds:struct<DOI:string>,citationCount:int"


def _s2_paper(r: DataFrame, **more: Column) -> DataFrame:
    venue = F.when(F.col("venue").startswith("{"), F.get_json_object("venue", "$.name")).otherwise(F.col("venue"))
    return paper(r, id=F.col("paperId"), paper_id=F.col("paperId"), title=F.col("title"), year=F.col("year"), abstract=F.col("abstract"), journal=F.nullif(venue, F.lit("")), doi=normalize_doi(F.col("externalIds.DOI")), citation_count=F.col("citationCount"), authors=F.transform("authors", lambda a: normalize_author(a["name"])), source=F.lit("semantic_scholar"), **more)


def parse_semantic_scholar(payloads: DataFrame) -> DataFrame:
    """Result pages of a paper search; a venue is a name or a structure with one."""
    return _s2_paper(_items(payloads, f"data array<struct<{_S2}>>", "data"))


def parse_citations(payloads: DataFrame) -> DataFrame:
    """Papers that cite a seed or are cited by it: {"seed": id, "data": [...]}, each paper at the top or inside citingPaper or citedPaper."""
    schema = f"seed string, data array<struct<{_S2},citingPaper:struct<{_S2}>,citedPaper:struct<{_S2}>>>"
    r = payloads.select(F.from_json("value", schema).alias("p")).select("p.seed", F.explode("p.data").alias("x"))
    plain = F.struct(*[F.col(f"x.{f.split(':')[0]}").alias(f.split(":")[0]) for f in re.split(r",(?![^<]*>)", _S2)])
    r = r.select("seed", F.coalesce(F.when(F.col("x.paperId").isNotNull(), plain), F.col("x.citingPaper"), F.col("x.citedPaper")).alias("p")).filter("p.paperId is not null").select("seed", "p.*")
    return _s2_paper(r, seed_paper_id=F.col("seed"))


def parse_pubmed(payloads: DataFrame) -> DataFrame:
    """Article sets (XML)."""
    article = "ArticleTitle:string,Abstract:struct<AbstractText:array<string>>,AuthorList:struct<Author:array<struct<LastName:string,ForeName:string>>>,Journal:struct<Title:string,JournalIssue:struct<PubDate:struct<Year:string>>>,ELocationID:array<struct<_VALUE:string,_EIdType:string>>"
    schema = f"PubmedArticle array<struct<MedlineCitation:struct<PMID:string,Article:struct<{article}>,KeywordList:struct<Keyword:array<string>>>>>"
    r = payloads.select(F.explode(F.from_xml("value", schema)["PubmedArticle"]).alias("r")).select("r.MedlineCitation.PMID", "r.MedlineCitation.Article.*", F.col("r.MedlineCitation.KeywordList.Keyword").alias("Keyword"))
    doi = F.get(F.filter("ELocationID", lambda e: e["_EIdType"] == "doi"), 0)["_VALUE"]
    people = F.filter(F.transform("AuthorList.Author", lambda a: person(a["LastName"], a["ForeName"])), lambda x: x.isNotNull())
    return paper(r, id=F.concat(F.lit("pmid:"), F.col("PMID")), title=F.col("ArticleTitle"), abstract=F.array_join("Abstract.AbstractText", " "), authors=people, journal=F.col("Journal.Title"), year=F.col("Journal.JournalIssue.PubDate.Year").try_cast("int"), doi=normalize_doi(doi), keywords=F.transform("Keyword", lambda k: F.lower(F.trim(k))), source=F.lit("pubmed"))


def read_openalex(spark: SparkSession, path: str) -> DataFrame:
    return parse_openalex(_payloads(spark, path))


def read_crossref(spark: SparkSession, path: str) -> DataFrame:
    return parse_crossref(_payloads(spark, path))


def read_semantic_scholar(spark: SparkSession, path: str) -> DataFrame:
    return parse_semantic_scholar(_payloads(spark, path))


def read_pubmed(spark: SparkSession, path: str) -> DataFrame:
    return parse_pubmed(_payloads(spark, path))


def read_citations(spark: SparkSession, path: str) -> DataFrame:
    return parse_citations(_payloads(spark, path))


#: Services in the order in which they are asked: parser, results a page.
SERVICES: dict[str, tuple[Callable[[DataFrame], DataFrame], int]] = {"openalex": (parse_openalex, 50), "crossref": (parse_crossref, 100), "semantic_scholar": (parse_semantic_scholar, 100), "pubmed": (parse_pubmed, 100)}
#: fetch(service, request, page) -> payload text, or None where there is nothing.
Fetch = Callable[[str, str, int], str | None]


def retried(fetch: Fetch, tries: int = 3, wait: float = 1.0) -> Fetch:
    """fetch, asked again after a failure, each time after twice the wait; the last failure counts as nothing."""

    def run(service: str, request: str, page: int) -> str | None:
        import time

        for k in range(tries):
            try:
                return fetch(service, request, page)
            except Exception:  # any failure of a service
                if k + 1 < tries:
                    time.sleep(wait * 2**k)
        return None

    return run


def _fetched(requests: DataFrame, service: str, fetch: Fetch) -> DataFrame:
    """(value): the payload of each row (request, page)."""
    ship(requests.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [fetch(service, r, int(p)) for r, p in zip(b["request"], b["page"], strict=True)]
            yield pd.DataFrame({"value": [x for x in found if x]}, dtype="object")

    return requests.mapInPandas(run, "value string")


def search(spark: SparkSession, query: str, fetch: Fetch, *, service: str = "openalex", max_results: int = 200, years: tuple[int, int] | None = None, lang: str = "en") -> DataFrame:
    """What a service finds: at most max_results papers, in the order of their ids. lang zh: known terms are put into English first.
    A service that takes no range of years has its results filtered."""
    parse, size = SERVICES[service]
    text = spark.range(1).select(translate_query(F.lit(query)).alias("q")).first().q if lang == "zh" else query
    request = "&".join(x for x in (text, year_filter(service, years)) if x)
    pages = spark.range(1, -(-max_results // size) + 1, numPartitions=4).select(F.lit(request).alias("request"), F.col("id").cast("int").alias("page"))
    found = parse(_fetched(pages, service, fetch)).filter(year_between(F.col("year"), years))
    return found.orderBy("id").limit(max_results)


def search_any(spark: SparkSession, query: str, fetch: Fetch, **how) -> DataFrame:
    """The results of the first service that has any; no rows if none has."""
    from ..operators.store import materialize

    for service in SERVICES:
        found = materialize(search(spark, query, fetch, service=service, **how), "found")
        if found.limit(1).count():
            return found
    return from_list(spark, [])


def lookup(papers: DataFrame, fetch: Fetch, batch: int = 50) -> DataFrame:
    """What Crossref knows of the DOIs of papers that lack something, asked in batches; unknown ones give no row."""
    wanted = papers.filter(needs_enrichment()).select(normalize_doi(F.col("doi")).alias("doi")).distinct()
    ship(papers.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [fetch("crossref", f, 1) for f in doi_filters(list(b["doi"]), batch)]
            yield pd.DataFrame({"value": [x for x in found if x]}, dtype="object")

    return parse_crossref(wanted.mapInPandas(run, "value string"))


def lookup_title(spark: SparkSession, title: str, fetch: Fetch) -> DataFrame:
    """The first hit for a title."""
    return parse_crossref(_fetched(spark.createDataFrame([(f"title:{title}", 1)], "request string, page int"), "crossref", fetch)).limit(1)


def read_enriched_csv(spark: SparkSession, path: str, fetch: Fetch) -> DataFrame:
    """A CSV of papers with what they lack filled by DOI; rows with a long abstract and keywords are left alone."""
    from ..operators.store import materialize

    d = materialize(read_csv(spark, path), "csv")
    return enrich(d, lookup(d.filter(~is_rich()), fetch), unless=is_rich())


def read(spark: SparkSession, mode: str, path: str | None = None, *, query: str | None = None, fetch: Fetch | None = None, **how) -> DataFrame:
    """Papers by mode: bibtex, ris, pdf, csv, jsonl, clean, openalex, crossref, semantic_scholar, pubmed or citations from a path, search with
    a query and fetch."""
    if mode == "search":
        return search_any(spark, query, fetch, **how)
    if mode == "csv" and fetch is not None:
        return read_enriched_csv(spark, path, fetch)
    readers = {"bibtex": read_bibtex, "ris": read_ris, "pdf": read_pdf, "csv": read_csv, "jsonl": read_jsonl, "clean": read_clean, "openalex": read_openalex, "crossref": read_crossref, "semantic_scholar": read_semantic_scholar, "pubmed": read_pubmed, "citations": read_citations}
    if mode not in readers:
        raise ValueError(f"no such mode: {mode}; there are {', '.join(readers)} and search")
    return readers[mode](spark, path)
