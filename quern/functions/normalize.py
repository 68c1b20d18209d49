"""Normalisation of a section's plain text."""

from __future__ import annotations

import re

from quern.functions.rules import ANY_QUOTE, CLOSE, FIELD, HAN, HAN_COMMON, LATIN, OPEN, PAUSE, STOP, Rules, delete, distinct, one_blank

_ROUND = (("（", "）"), (r"\(", r"\)"))
_QUOTES = '"“”'
_PAIRED = _QUOTES + "‘’"
_EDGE = ANY_QUOTE + ":：;；"
_VERB = "(?:在|是|有|為|的)"
_WORDS = "A-Za-z_\\-"


def _brackets(inner: str, tail: str = "") -> list[tuple[str, str, str]]:
    """Delete full- and half-width brackets around ``inner``."""
    return delete(a + inner.replace("CLOSE", b) + tail + b for a, b in _ROUND)


_PARAGRAPH = Rules(
    (rf"([{STOP}])\s*[、，]", r"\1"),
    (rf"[、，]\s*([{STOP}])", r"\1"),
    ("。{2,}", "。"),
    ("，{2,}", "，"),
    *((rf"方面，{'#' * n}\s*\d+\.\d+\s+", "方面，") for n in (3, 2, 1)),
    ("(可以指|包括)：。", r"\1："),
)

_JOINED = Rules(("。。+", "。"), ("，，+", "，"), (r"方面，\s*$", "", "m"), (r"\n+", " "), (r"[\t ]+", " "))

_FIELDS = Rules(
    (rf"(?:[{FIELD}]+\d*\s+){{4,}}", ""),
    (rf"[{FIELD}]+_url\s*https?://\S+", ""),
    *_brackets(rf"[\s{PAUSE}]*"),
    *_brackets(f"[^0-9{LATIN}{HAN_COMMON}]{{1,10}}"),
    (rf"([{STOP}])\s*[{PAUSE}]+", r"\1"),
    (f"^[{PAUSE}]+", ""),
    ("：。", "："),
    (rf"([{STOP}])\1+", r"\1"),
    (f"[{PAUSE}]{{2,}}", "，"),
    (f"([{STOP}])[,{PAUSE}]+", r"\1"),
    ("^，+", ""),
    *_brackets(f"[^CLOSE{HAN_COMMON}]*", rf"[\s,。{PAUSE}{_QUOTES}]*"),
    *_brackets(rf"[\s,。{LATIN}{PAUSE}{_QUOTES}]*"),
    *_brackets(rf"[\s：{PAUSE}]*"),
    *_brackets(rf"[\s,{LATIN}]*", "，?"),
    ("([、，：])。", r"\1"),
    (r"[:：]\s*$", ""),
    (rf"[:：]\s*[\s{PAUSE}]+", "："),
    *delete(f"可能[{chars}][:：]" for chars in ("是為意指", "是为意指")),
    (r"(?:stat\d+-\s*)+", ""),
    (r"!+u?t?STR\w+!~" + r"\w+\\?" + r"u?t?STR\w+!~" + r"\w+~+", ""),
    (r"\b\w+\.(?:bmp|gif|jpe?g|png|svg|webp)[.。]", "", "i"),
    (r"\s+", " "),
)

_MATCH_WORDS = ("小組賽 分組賽 預賽 淘汰賽 復活賽 半決賽 銅牌賽 決賽", "小组赛 分组赛 预赛 淘汰赛 复活赛 半决赛 铜牌赛 决赛")
_LIFE_SHARED = "居住地 出生地 信仰 配偶 父母 子女 母校 任期 前任 出生"
_LIFE_WORDS = (_LIFE_SHARED + " 國籍 學校 學歷 政黨 畢業院校 繼任 職業", _LIFE_SHARED + " 国籍 学校 学历 政党 毕业院校 继任 职业")


def _any(words: str) -> str:
    """Alternatives, longest first where one starts another."""
    return "(?:" + "|".join(sorted(words.split(), key=len, reverse=True)) + ")"


_MARKS = Rules((r"\.(?<!\d\.)(?!\d)", ""), ("[" + re.escape("@#$%^&*=|~`<>") + "]", ""), (r"\s+", " "))

_SPACING = Rules(
    (rf"([,.;:!?；：{STOP}])\s+([{LATIN}{HAN}])", r"\1\2"),
    # a letter, white space and a mark; what starts with the rarest is scanned fastest
    (rf"\s(?<=[{LATIN}{HAN}]\s)\s*(?=[,.;:!?；：{STOP}])", ""),
    (r"\s+", " "),
)

#: Start of a run of Latin words. With possessive repeats it keeps the scan linear and finds the same.
_RUN = rf"(?<![{_WORDS}])(?<![{_WORDS}]\s)"

_RESIDUE = Rules(
    (_RUN + rf"(?:[{_WORDS}]++\s++){{3,}}+" + _VERB, ""),
    (rf"(?:[{_WORDS}]+\s+\d+\s+){{2,}}", ""),
    ("[—_=\\-]{3,}", ""),
    *delete(_any(words) + "[^。]*" for words in _MATCH_WORDS),
    *delete(f"(?:date of|{_any(words)})[^。]{{0,30}}。" for words in _LIFE_WORDS),
    (rf"stat\s+[0-9{_WORDS}]+", ""),
    (f"{OPEN}[^{HAN_COMMON}]{{1,20}}{CLOSE}", ""),
    (rf"{OPEN}[,、，\s及和與或]{{1,5}}{CLOSE}", ""),
    (f"{OPEN}[Ss]ee[^)）]*{CLOSE}", ""),
    (rf"{OPEN}[:：。\s{PAUSE}]+{CLOSE}", ""),
    (rf"(?<=\s)[{_EDGE}](?=\s)", ""),
    (f"^[{_EDGE}]+", ""),
    (f"[{_EDGE}]+$", ""),
    (_RUN + rf"(?:[{_WORDS}]++\s++){{4,}}+" + _VERB, ""),
    (rf"(?:[0-9{_WORDS}]+\s+){{3,}}", ""),
    (r"[*+\-]\s+", ""),
    (f"[{_PAIRED}](.*?)[{_PAIRED}]", r"“\1”"),
    *delete(rf"(?<=\s){q}(?=\s)" for q in "“”"),
    (r"\s+", " "),
)

_LEAD = re.compile(r"(?:, |[][(){}（）\"'。，、；：！？])")
_LEAD_LAST = re.compile(r"^[!?，、；：。\s]+")
_NO_TITLE = set("，；：" + STOP)


def _strip_lead(text: str, most: int | None = None) -> str:
    """Drop leading marks one by one, trimming after each."""
    done = 0
    while text and (most is None or done < most):
        m = _LEAD.match(text)
        if not m:
            break
        text, done = text[m.end() :].strip(), done + 1
    return text


def normalize(text: str, title: str = "") -> tuple[str, str]:
    """(title, text): one line of running text; a short first line becomes the title where there is none."""
    lines = text.split("\n")
    if len(lines) > 1 and not title:
        head = re.sub(r"^#{1,6}\s*", "", lines[0].strip()).strip()
        if len(head) < 20 and not _NO_TITLE & set(head):
            title, lines = head, lines[1:]
    lines = [line.strip() for line in one_blank("\n".join(lines)).split("\n")]
    body = "\n".join(line for line in lines if len(line) >= 2)
    chars = distinct(body)
    if body:
        body, chars = _PARAGRAPH.run(body, chars)
        if not body.endswith(("：", *STOP)):
            body, chars = body + "。", chars + "。"
    for rules in (_JOINED, _FIELDS, _MARKS, _SPACING, _RESIDUE):
        body, chars = rules.run(body.strip(), chars)
    body = body.strip()
    body = _strip_lead(body, 10)
    body = _strip_lead(_LEAD_LAST.sub("", body))
    return title, body
