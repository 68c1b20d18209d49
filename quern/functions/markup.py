"""Markdown cleaning and conversion to plain text."""

from __future__ import annotations

from quern.functions.rules import CLOSE, FIELD, OPEN, STOP, Rules, delete

_BOX_NAMES = ("[Ii]nfobox", "信息框", "基礎資訊", "資訊框")
_MEDIA_NAMES = ("Category", "File", "Image", "图像", "图片", "圖片", "文件", "檔案")
_VERBS = "在是有為的"
_QUOTED, _MARK, _SHOWN = '"[^"]*"', "#{1,6}", r"\[(.*?)\]"

#: Markup that a rendered page or foreign Markdown still holds. Order matters: a later rule sees what
#: earlier ones left.
CLEAN = Rules(
    ("<!--.*?-->", "", "s"),
    ("filepath:.*?\n", ""),
    *delete((r"\{\{" + name + r".*?\n\}\}" for name in _BOX_NAMES), "s"),
    *delete((r"\{\{.*?\}\}", r"\{\|.*?\|\}"), "s"),
    *delete(rf"\[\[{name}:.*?\]\]" for name in _MEDIA_NAMES),
    (rf"\|group={_QUOTED}" + r"\}{2}", ""),
    (r"\[\^.+?\]", ""),
    ("<ref.*?</ref>", "", "s"),
    ("<ref.*?/>", ""),
    ("<[^>]+>", ""),
    (r"!\[.*?\]\(.*?\)", ""),
    (r"\[\[[^]|]+\|([^]|]+)\]\]", r"\1"),
    (r"\[\[([^]|]+)\]\]", r"\1"),
    *((q + "(.*?)" + q, r"\1") for q in ("'''", "''")),
    *(("=" * n + "(.*?)" + "=" * n, r"\1") for n in range(5, 0, -1)),
    (r"\{{3}[^}]*\}{3}", ""),
    (r"\|[^=|\n]*=", ""),
    (rf"[{FIELD}]+\s*=\s*[^\n]*", ""),
    *((r"\}\}\s*" + verb, verb) for verb in _VERBS),
    (r"\}\}\s*", ""),
    (r"\|\s*\|", ""),
    (r"\|\s*$", "", "m"),
    (r"^\s*\|", "", "m"),
)

_EMPTY_PAIRS = (r"\(\)", r"\[\]", r"\{\}", "（）", "「」", "『』")
_BULLET, _NUMBER = r"[*+\-]", r"\d+\."

_PLAIN_HEAD = Rules(
    ("^" + _MARK + r"\s+(.*?)$", r"\1", "m"),
    *((rf"^\s*{mark}\s+(.*?)\s*$", r"、\1", "m") for mark in (_BULLET, _NUMBER)),
    (r"([^\n])\n、", r"\1 •"),
    (r"^\s*、", "", "m"),
    *((rf"^\s+{mark}\s+(.*?)$", r"，\1", "m") for mark in (_BULLET, _NUMBER)),
    (_SHOWN + r"\([^)]*\)", r"\1"),
    *((m + "(.*?)" + m, r"\1") for m in (r"\*\*", r"\*", "__", "_")),
    ("`([^`]*)`", r"\1"),
    ("```[^`]*```", "", "s"),
    ("[ -‍ ⁠﻿]", " "),
    (r"[\t ]+", " "),
    ("　+", ""),
    *delete(p[: len(p) // 2] + r"\s*" + p[len(p) // 2 :] for p in _EMPTY_PAIRS),
    *delete(OPEN + inner + CLOSE for inner in (r"[\s，；]*", r"[\s，]*", r"\s*[;；]\s*")),
    (rf"[{FIELD}]+\s*=\s*", ""),
    (rf"\|\s*[{FIELD}]+\s*=", ""),
    (r"=\s*[^=\n]*\n", "\n"),
    (r"^\s*[|=]\s*$", "", "m"),
    (r"\s+[|=]\s+", " "),
    *((rf"[{pair}]{{2,}}", pair[1]) for pair in (",，", ".。", ";；", "!！", "?？")),
    *delete("#" * n + r"\s*\d+\.\d+\s+" for n in (3, 2, 1)),
    *((mark + r"\d+\.\d+\s+", "，") for mark in (r"\\n", r"\n")),
    (rf"([，；{STOP}])\s+", r"\1"),
    (rf"\s+([，；{STOP}])", r"\1"),
    (OPEN + r"[A-Za-z=\s]*" + CLOSE, ""),
)

#: Entities in the order in which they are replaced: a decoded ampersand can start a later one.
ENTITIES = tuple(zip("&lt; &gt; &amp; &quot; &apos; &nbsp; &#39; &mdash; &ndash; &ldquo; &rdquo;".split(), ["<", ">", "&", '"', "'", " ", "'", "—", "–", '"', '"']))


def clean_markdown(text: str) -> str:
    """Text without templates, tables, media, references, tags, emphasis and field residue."""
    return CLEAN(text)


def decode_entities(text: str) -> str:
    for entity, char in ENTITIES:
        text = text.replace(entity, char)
    return text


def markdown_to_text(text: str) -> str:
    """Plain text of Markdown: lists joined, marks and empty brackets gone, punctuation collapsed."""
    return decode_entities(_PLAIN_HEAD(text))
