"""Schemas of the tables that operators exchange."""

from __future__ import annotations

PAGE = "title string, ns int, id string, text string"
MARKDOWN = "page_id string, md string"
SECTION = "title string, content string"
RECORD = "title string, text string, source_file string"
IMAGE = "url string, title string, file_name string, page string, tag string"
FETCH = "file_name string, status string, error string"
