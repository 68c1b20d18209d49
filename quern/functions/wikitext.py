"""Wikitext to Markdown, one page at a time."""

from __future__ import annotations

import html
import re

from quern.functions.rules import Rules

_VARIANT = re.compile(r"-\{(.*?)\}-", re.DOTALL)
_MAINLAND = re.compile(r".*zh-(?:cn|hans):(.*?)(?:;zh|;|\}-).*", re.DOTALL)
_ANY, _CODE = "(.*?)", "[a-z]{2}"
_LE = re.compile(r"\{{2}Le\|" + _ANY + r"\|" + _ANY + r"(?:\|" + _ANY + r")?\}{2}")
_LINK = re.compile(r"\{{2}link-" + _CODE + r"\|([^{|}]+)\|[^{|}]+\}{2}")
_TEMPLATE = re.compile(r"\{{2}(?!lang|link-" + _CODE + r").*?\}{2}")
_SURROGATE = re.compile("[\ud800-\udfff]")


def _each_span(pattern: re.Pattern[str], to: object, text: str) -> str:
    """Replace the first match by ``to(match)``, again and again, until there is none.

    What is put in can only join with the character before it to a new opening, so the search goes on from there and
    text further back is done with.
    """
    done: list[str] = []
    while m := pattern.search(text):
        back = max(0, m.start() - 1)
        done.append(text[:back])
        text = text[back : m.start()] + to(m) + text[m.end() :]
    return "".join(done) + text


def _variant(m: re.Match[str]) -> str:
    inner = m.group().replace(" ", "")
    named = _MAINLAND.match(inner)
    if named:
        return named.group(1)
    inner = inner[2:-2]
    return "" if "zh-cn" in inner or "zh-hans" in inner else inner


def resolve_variants(text: str) -> str:
    """Keep the mainland form of each ``-{...}-``, or its content where it names no variant."""
    return _each_span(_VARIANT, _variant, text)


def resolve_templates(text: str) -> str:
    """Link templates to their words; other templates go, those of ``lang`` stay."""
    text = _LE.sub(lambda m: m.group(3) or m.group(1), text)
    text = _LINK.sub(r"\1", text)
    return "\n".join(_drop_templates(line) if "{{" in line else line for line in text.split("\n"))


def _drop_templates(line: str) -> str:
    return _each_span(_TEMPLATE, lambda m: "", line)  # a removal can bring a new pair of braces together


def _balanced(text: str, opening: str, closing: str, keep: object) -> str:
    """Replace each outermost balanced span by ``keep(span)``; an unclosed opening stays."""
    marks = re.compile(re.escape(opening) + "|" + re.escape(closing))
    out, depth, start, done = [], 0, 0, 0
    for m in marks.finditer(text):
        if m.group() == opening:
            start = m.start() if depth == 0 else start
            depth += 1
        elif depth:
            depth -= 1
            if depth == 0:
                out += [text[done:start], keep(text[start : m.end()])]
                done = m.end()
    return "".join(out) + text[done:]


_INTERLANGUAGE = re.compile(r"\s*(?:\[\[[a-z][a-z][\w-]*:[^:\]]+\]\]\s*)+\Z")
_INLINE = Rules(
    ("<!--.*?-->", "", "s"),
    (r"<ref\b[^>/]*/>|<ref\b.*?</ref>", "", "s"),
    ("<(nowiki|math)\\b.*?</\\1>", "", "s"),
    ("<[^>]*>", "", "s"),
    (r"\[\[Category:[^\]\[]*\]\]", ""),
    (r"\[(?:https?|ftp)://\S+ ([^]]*)\]", r"\1"),
    (r"\[(?:https?|ftp)://[^]\s]*\]", ""),
    (r"\[([^|\][]*)\|([^|\][]*)\]", r"[\2]"),
    (r"(?m)^\s*(?:\{\||\|-|\|\}).*$", ""),
    (r"\|\||!!", "\n"),
    (r'(?:style|class|align|valign|bgcolor|width|colspan|rowspan)\s*=\s*"[^"]*"', ""),
    (r"\[\]", ""),
)
_FILE_SPAN = re.compile(r"\[\[(?:File|Image):", re.IGNORECASE)


def _caption(span: str) -> str:
    return span.rsplit("|", 1)[1].removesuffix("]]") if _FILE_SPAN.match(span) and "|" in span else "" if _FILE_SPAN.match(span) else span


def strip_markup(text: str) -> str:
    """Entities decoded, balanced templates and media removed, inline markup reduced to its words."""
    text = html.unescape(text)
    text = _INTERLANGUAGE.sub("", text)
    text = _balanced(text, "{{", "}}", lambda span: "")
    text = _balanced(text, "[[", "]]", _caption)
    for _ in range(3):
        before, text = text, _INLINE(text)
        if text == before:
            break
    return text.replace("[", "").replace("]", "")


_TABLES = Rules((r":*\{\|.*?\|\}", "", "s"), (r"\[\[File:.*\]\]", ""), ("<gallery.*?</gallery>", "", "s"))
_PIPED = re.compile(r"(.)\{\{([^\n{}]*?\|[^\n{}]*?)\}\}")
_LINES = Rules((r"\* *\n|'{2,}", ""), ("\n+", "\n"), ("\n[:;]|\n +", "\n"), ("\n==", "\n\n=="))


def clean_wikitext(text: str, strict: bool = False) -> str:
    """Wikitext without templates, tables, galleries and inline markup.

    A piped template that survived keeps what stands before it and its words; with ``strict`` its place
    takes the literal marks that a doubled escape leaves there, and the character before it is lost.
    """
    text = _TABLES(resolve_templates(resolve_variants(text)))
    text = _PIPED.sub(lambda m: r"\1[[\2]]", text) if strict else _PIPED.sub(r"\1[[\2]]", text)
    return _LINES(strip_markup(text)).replace("\n。", "。\n")


_HEADINGS = tuple((("=" * n), n) for n in (5, 4, 3, 2))


def render_markdown(title: str, text: str, markdown: bool = True) -> str:
    """The page as Markdown: title, numbered headings by nesting, list items close together."""
    gap = "\n\n" if markdown else "\n"
    out = [("# " if markdown else "") + title + gap]
    counters = {2: 0, 3: 0, 4: 0, 5: 0}
    after_item = False
    for line in text.split("\n"):
        item = False
        heading = next(((mark, n) for mark, n in _HEADINGS if line.startswith(mark)), None)
        if heading:
            mark, n = heading
            counters[n] += 1
            for deeper in range(n + 1, 6):
                counters[deeper] = 0
            m = re.search(f"{mark}(.+?){mark}", line)
            path = [str(counters[k]) for k in range(2, n + 1) if counters[k]]
            line = ".".join(path) + " " + (m.group(1).strip() if m else "")
            if markdown:
                line = "#" * (len(path) + 1) + " " + line
        elif line.startswith("***"):
            line, item = "  * " + line[3:].strip(), True
        elif line.startswith("**"):
            line, item = " * " + line[2:].strip(), True
        elif line[:1] in ("*", "#") and line:
            line, item = "* " + line[1:].strip(), True
        if after_item and not item:
            out.append("\n")
        after_item = item
        out.append(line + ("\n" if item else gap))
    return "".join(out)


def page_to_markdown(title: str, text: str, strict: bool = False, markdown: bool = True) -> str:
    title, text = (_SURROGATE.sub("", x) for x in (title, clean_wikitext(text, strict)))
    return render_markdown(title, text, markdown)

