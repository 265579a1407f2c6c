"""Schemas of the stages, as DDL."""

from __future__ import annotations

SNAPSHOT = (
    "identifier string, version string, date_modified string, date_created string, date_published string, in_language struct<identifier: string>, "
    "is_part_of struct<identifier: string>, namespace struct<identifier: int>, size struct<value: double, unit_text: string>, chunks array<string>"
)
RAW_PAGE = (
    "identifier bigint, name string, url string, date_modified string, namespace struct<identifier: int>, version struct<identifier: bigint>, "
    "main_entity struct<identifier: string>, is_part_of struct<identifier: string>, in_language struct<identifier: string>, "
    "article_body struct<html: string, wikitext: string>"
)
INFOBOXES = "array<struct<title: string, data: array<struct<key: string, values: array<string>>>>>"
METADATA = (
    "wikiname string, page_id bigint, title string, url string, date_modified string, in_language string, wikidata_id string, "
    f"bytes_html bigint, wikitext string, version bigint, infoboxes {INFOBOXES}, has_math boolean"
)
PUBLISHED = [
    ("url", "string"), ("title", "string"), ("text", "string"), ("id", "string"), ("language_code", "string"), ("wikidata_id", "string"),
    ("bytes_html", "bigint"), ("wikitext", "string"), ("version", "bigint"), ("infoboxes", "string"), ("has_math", "boolean"),
]
SAMPLE_RESULT = (
    "article_id string, article_title string, article_length int, bucket int, "
    "timing struct<extraction_seconds: double, semhash_dedup_seconds: double, total_seconds: double>, "
    "extraction struct<entities: int, relations: int, tokens: struct<prompt_tokens: bigint, completion_tokens: bigint, total_tokens: bigint>>, "
    "semhash_dedup struct<entities: int, relations: int, entity_cleanup_percent: double, relation_cleanup_percent: double, "
    "entity_clusters: int, edge_clusters: int, tokens: bigint>"
)
SCRIPT_MAP = "subset string, scripts string"
