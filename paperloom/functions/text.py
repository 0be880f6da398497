"""Scalar functions as column expressions; none of them leaves the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, whatever the optimizer inlines."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cols], F.lit(""))


def normalize_author(name: Column) -> Column:
    """'Last, First Middle' of any of 'Last, First', 'First Middle Last' and one word."""
    n = F.trim(F.regexp_replace(name, r"\s+", " "), F.lit(", "))
    parts = F.split(n, " ")
    after = F.array_join(F.filter(F.transform(F.split(F.regexp_replace(n, r"^[^,]*,", ""), ","), lambda x: F.trim(x)), lambda x: x != ""), " ")
    plain = F.when(F.size(parts) <= 1, n).otherwise(F.concat_ws(", ", F.element_at(parts, -1), F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), " ")))
    return F.when(F.instr(n, ",") > 0, F.concat_ws(", ", F.trim(F.substring_index(n, ",", 1)), F.nullif(after, F.lit("")))).otherwise(plain)


def extract_doi(text: Column) -> Column:
    return F.rtrim(F.regexp_extract(text, r"(?i)(10\.\d{4,9}/[-._;()/:A-Z0-9]+)", 1), F.lit("."))


def normalize_doi(doi: Column) -> Column:
    """Lower case, without the resolver's address; '' and 'nan' are no DOI."""
    d = F.lower(F.trim(F.regexp_replace(doi, r"(?i)^\s*(?:https?://(?:dx\.)?doi\.org/|doi:\s*)", "")))
    return F.when(~d.isin("", "nan"), d)


def extract_year(text: Column) -> Column:
    return F.regexp_extract(text, r"\b((?:19|20)\d{2})\b", 1).try_cast("int")


def split_keywords(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"[;,]\s*"), lambda x: F.lower(F.trim(x))), lambda x: x != "")


def split_stored(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: x != "")


def normalize_title(title: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(title), r"(?U)[^\w\s]", ""), r"(?U)\s+", " "))


def stem(word: Column) -> Column:
    """Light plural and -ing stripping with exceptions; both endings may go."""
    w = F.lower(F.trim(word))
    lemma = F.element_at(F.create_map(*[F.lit(x) for kv in lexicon.LEMMAS.items() for x in kv]), w)
    n = F.length(w)
    singular = F.when(w.endswith("es") & (n > 4) & ~w.endswith("sses"), F.left(w, n - 2)).when(w.endswith("s") & ~w.endswith("ss") & (n > 3), F.left(w, n - 1)).otherwise(w)
    base = F.when(singular.endswith("ing") & (F.length(singular) > 6), F.left(singular, F.length(singular) - 3)).otherwise(singular)
    return F.when(w.isin(*lexicon.LEMMAS), lemma).when(w.isin(*lexicon.UNSTEMMED), w).otherwise(base)


def normalize_keyword(keyword: Column, synonyms: dict[str, str] | None = None) -> Column:
    """Clean, synonym, stop word, stem word by word, synonym again; null where nothing is left."""
    known = lexicon.synonym_map() if synonyms is None else synonyms
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    k = F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.trim(keyword)), r"[^a-z0-9\s\-]", ""), r"\s+", " "))
    words = F.split(k, " ")
    stemmed = F.when(F.size(words) > 1, F.array_join(F.transform(F.filter(words, lambda w: ~w.isin(*lexicon.STOPWORDS)), stem), " ")).otherwise(stem(k))
    found = lambda x: F.when(x.isin(*known), F.element_at(table, x))
    return F.when(F.length(k) < 2, None).when(k.isin(*known), F.element_at(table, k)).when(k.isin(*lexicon.STOPWORDS), None).otherwise(F.nullif(F.coalesce(found(stemmed), stemmed), F.lit("")))


def normalize_keywords(keywords: Column, synonyms: dict[str, str] | None = None, distinct: bool = True) -> Column:
    out = F.filter(F.transform(keywords, lambda k: normalize_keyword(k, synonyms)), lambda k: k.isNotNull())
    return F.array_distinct(out) if distinct else out


# What is taken out of a text before its keywords are looked for, in this order.
NO_KEYWORDS = [r"</?[a-z]+[^>]*>", r"\b10\.\d{4,}/[^\s]+", r"https?://\S+", r"\b\d+\b", r"\b[a-z]\b", r"\s+"]


def clean_text(text: Column) -> Column:
    """Tags, DOIs, URLs, whole numbers and lone letters out; white space collapsed."""
    return F.trim(reduce(lambda c, r: F.regexp_replace(c, f"(?U){r}", " "), NO_KEYWORDS, F.coalesce(text, F.lit(""))))


def inverted_abstract(index: Column) -> Column:
    """The text of a map word -> positions."""
    pairs = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("at"), e["key"].alias("word")))))
    return F.array_join(F.transform(F.array_sort(pairs), lambda p: p["word"]), " ")


def translate_query(text: Column) -> Column:
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), lexicon.ZH_EN.items(), text)


def page_range(start: Column, end: Column) -> Column:
    return F.concat_ws("-", F.nullif(start, F.lit("")), F.nullif(end, F.lit("")))


def person(family: Column, given: Column) -> Column:
    """'Family, Given' of a service's two fields; one of them alone where the other is missing, null without both."""
    return F.nullif(F.concat_ws(", ", F.nullif(F.trim(family), F.lit("")), F.nullif(F.trim(given), F.lit(""))), F.lit(""))


def completeness(abstract: Column, doi: Column, keywords: Column) -> Column:
    """How much an entry tells: characters of abstract and DOI, one more for keywords."""
    return F.length(F.coalesce(abstract, F.lit(""))) + F.length(F.coalesce(doi, F.lit(""))) + (F.size(F.coalesce(keywords, F.array().cast("array<string>"))) > 0).cast("int")


def years_of(text: str | None) -> tuple[int, int] | None:
    """(first, last) of '2019-2024', with a hyphen or a dash; None, which is no filter, of anything else."""
    import re

    m = re.match(r"\s*(\d{4})\s*[-\u2013]\s*(\d{4})", text or "")
    return (int(m[1]), int(m[2])) if m else None


def year_between(year: Column, years: tuple[int, int] | None) -> Column:
    """Inclusive; rows without a year fail a filter that is there."""
    return F.lit(True) if years is None else F.coalesce(year.between(*years), F.lit(False))


#: How each service writes a range of years.
YEAR_FILTERS = {"openalex": "publication_year:{0}-{1}", "crossref": "from-pub-date:{0}-01-01,until-pub-date:{1}-12-31", "pubmed": "{0}:{1}[dp]"}


def year_filter(service: str, years: tuple[int, int] | None) -> str:
    """The request's part that asks a service for a range of years; empty where it takes none."""
    return YEAR_FILTERS.get(service, "").format(*years) if years else ""


def doi_filters(dois: list[str], batch: int = 50) -> list[str]:
    """The filters of a look-up of many DOIs, `batch` in each."""
    known = list(dict.fromkeys(d.strip().lower() for d in dois if d and d.strip()))
    return [",".join(f"doi:{d}" for d in known[i : i + batch]) for i in range(0, len(known), batch)]


def hue(index: Column) -> Column:
    """The colour of the index-th community, far from its neighbours'."""
    return F.pmod(index * 137, F.lit(360)).cast("int")


def clamp(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def node_size(n: Column) -> Column:
    return F.round(F.greatest(F.lit(5.0), F.least(F.lit(40.0), 5 + 8 * F.log(n + 1))), 1)


def names_a_gap(keyword: Column) -> Column:
    """Is the keyword specific enough: four characters, no general word, and either two words or six characters."""
    k = F.lower(F.trim(keyword))
    return (F.length(k) >= 4) & ~k.isin(*lexicon.GENERIC) & ((F.size(F.split(k, r"\s+")) >= 2) | (F.length(k) >= 6))


def plain_title(title: str) -> str:
    import re

    return re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", title.lower())).strip()


def title_ratio(a: str | None, b: str | None) -> float:
    """Matching-blocks ratio of two titles, normalised alike; a is the later one."""
    from difflib import SequenceMatcher

    if not a or not b:
        return 0.0
    return SequenceMatcher(None, plain_title(a), plain_title(b)).ratio()
