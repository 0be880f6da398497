"""The typed tables of a bibliographic corpus."""

from __future__ import annotations

import re

PAPER = """id string, entry_type string, title string, authors array<string>, year int, journal string,
booktitle string, volume string, number string, pages string, doi string, abstract string,
keywords array<string>, publisher string, url string, citation_count int, source string,
paper_id string, seed_paper_id string, file string, extraction_quality string, error string,
raw map<string,string>, ingest_seq bigint"""

CLEAN = """id string, title string, authors array<string>, year int, journal string, volume string, pages string,
doi string, abstract string, keywords_raw array<string>, keywords_normalized array<string>, citation_count int, source string"""


def columns_of(schema: str) -> dict[str, str]:
    """Name and type of each column, in order."""
    return dict(re.match(r"(\w+) (.*)", c.strip()).groups() for c in re.split(r",(?![^<]*>)", schema.replace("\n", " ")))
