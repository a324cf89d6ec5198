"""Schemas of the records that flow through the engine."""

from __future__ import annotations

CITATION_ITEM = "struct<doi:string,pmid:string,s2_id:string,title:string,year:int>"
CITATIONS = f"struct<source:string,retrieved_at:string,items:array<{CITATION_ITEM}>>"
RAW_ITEM = (
    "idx long, title string, doi string, pmid string, abstract string, authors array<string>, year string, "
    "venue string, keywords array<string>"
)
RESOLVED = (
    "idx long, title string, doi string, pmid string, s2_id string, abstract string, year string, venue string, "
    "authors array<string>, alt_dois array<string>, source string, keywords array<string>, fields array<string>, "
    "types array<string>, mesh array<string>, mesh_major array<string>, mesh_qualifiers array<string>"
)
REFERENCE = (
    "struct<schema:string,uri:string,doi:string,pmid:string,s2_id:string,year:string,venue:string,authors:array<string>,"
    f"alt_dois:array<string>,citation:string,outbound_citations:{CITATIONS}>"
)
NODE = (
    "id string, uuid string, slug string, title string, uri string, abstract string, citation string, status string, "
    f"type string, tags array<string>, metadata struct<reference:{REFERENCE}>"
)
EDGE = "id string, source_id string, target_id string, relationship string"
MUTATION = (
    "id string, timestamp timestamp, actor string, actor_id string, entity_type string, entity_id string, "
    "operation string, diff string, metadata string"
)
OUTCOME = "idx long, slug string, created boolean, linked int, skipped int, stored int, errors array<string>"
RIS_RECORD = (
    "idx long, title string, abstract string, doi string, year string, venue string, url string, "
    "authors array<string>, keywords array<string>"
)
CATALOG_REFERENCE = "struct<paperId:string,title:string,year:string,externalIds:struct<DOI:string,PubMed:string>>"
CATALOG_ENTRY = (
    "paperId string, title string, abstract string, year string, venue string, externalIds struct<DOI:string,PubMed:string>, "
    "authors array<struct<name:string>>, fieldsOfStudy array<string>, s2FieldsOfStudy array<struct<category:string>>, "
    f"publicationTypes array<string>, references array<{CATALOG_REFERENCE}>"
)
_DATE = "struct<`date-parts`:array<array<string>>>"
CATALOG_WORK = (
    "DOI string, title array<string>, `container-title` array<string>, author array<struct<given:string,family:string>>, "
    f"published {_DATE}, `published-print` {_DATE}, `published-online` {_DATE}, subject array<string>, abstract string"
)
