import random
import re
import time

import pytest

from quern.functions import captions, convert, markup, native, normalize, wikitext
from quern.functions.rules import Rules


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ("a<!-- x\ny -->b", "ab"),
        ("filepath: some/where\nrest", "rest"),
        ("{{Infobox\n|a\n}}正文", "正文"),
        ("{{一\n二}}文{| t\n|}字", "文字"),
        ("甲[[File:a.jpg|thumb]]乙[[圖片:b]]丙", "甲乙丙"),
        ("甲[^1]乙<ref name=x>y\nz</ref>丙<ref a/>丁", "甲乙丙丁"),
        ("<b a='1'>粗</b>![alt](http://x)尾", "粗尾"),
        ("[[目標|顯示]]與[[連結]]", "顯示與連結"),
        ("'''粗'''和''斜''", "粗和斜"),
        ("==標題==與=甲=", "標題與甲"),
        ("|名=值", "值"),
        ("key = 整行都去\n下一行", "\n下一行"),
        ("甲}} 是乙}}  丙", "甲是乙丙"),
        ("甲| |乙|\n|丙", "甲乙丙"), ("|甲|\n乙", "甲\n乙"),
    ],
)
def test_clean_markdown(source, wanted):
    assert markup.clean_markdown(source) == wanted


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ("# 標題\n文", "標題\n文"),
        ("文\n* 甲\n* 乙", "文 •甲 •乙"),
        ("1. 甲\n2. 乙", "甲 •乙"),
        ("[字](http://x) **粗** _斜_ `碼`", "字 粗 斜 碼"),
        ("a b​c　d", "a b cd"),
        ("甲（ ）乙「」丙( ; )丁", "甲乙丙丁"),
        ("甲,,乙..丙!!", "甲，乙。丙！"),
        ("甲， 乙 。丙", "甲，乙。丙"),
        ("甲(ab c)乙", "甲乙"),
        ("&amp;quot;x&lt;&mdash;", '"x<—'),
    ],
)
def test_markdown_to_text(source, wanted):
    assert markup.markdown_to_text(source) == wanted


@pytest.mark.parametrize(
    ("source", "title", "wanted"),
    [
        ("短標題\n這是第一句。", "", ("短標題", "這是第一句。")),
        ("這是，第一行\n這是第二行", "", ("", "這是，第一行 這是第二行。")),
        ("標題\n這是內容", "已有", ("已有", "標題 這是內容。")),
        ("一句。，又一句，。", "", ("", "一句。又一句。")),
        ("。，、開頭（，）字", "", ("", "開頭字。")),
        ("數字1.5與字.字", "", ("", "數字1.5與字字。")),
        ("有\"引號\"的字", "", ("", "有“引號”的字。")),
        ("甲 foo bar baz qux 乙", "", ("", "甲 乙。")),
        ("他出生於某處。他寫作", "", ("", "他他寫作。")),
        ("半決賽結果很好。後文", "", ("", "。後文。".lstrip("。"))),
        ("字\n單\n兩字", "", ("字", "兩字。")),
        ("", "", ("", "")),
    ],
)
def test_normalize(source, title, wanted):
    assert normalize.normalize(source, title) == wanted


def test_long_latin_text_is_linear():
    began = time.time()
    for join in (" ", "- ", ", "):
        normalize.normalize(join.join(["word"] * 20_000))
        wikitext.clean_wikitext("{{" + join.join(["word"] * 20_000))
    assert time.time() - began < 30


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ("-{zh-hans:软件;zh-tw:軟體}-", "软件"),
        ("-{zh-tw:軟體;zh-cn:软件}-", "软件"),
        ("-{ 原 樣 }-", "原樣"),
        ("-{zh-hans}-後", "後"),
    ],
)
def test_variants(source, wanted):
    assert wikitext.resolve_variants(source) == wanted


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ("{{Le|一|二|三}}{{Le|四|五}}", "三四"),
        ("{{link-de|顯示|原文}}", "顯示"),
        ("{{a}}{{lang|x}}{{b\n}}", "{{lang|x}}{{b\n}}"),
        ("{{x{{a}}}}", "}}"),
        ("{{{a}}b}}", "{b}}".replace("{b}}", "b}}")),
    ],
)
def test_templates(source, wanted):
    assert wikitext.resolve_templates(source) == wanted


def test_piped_template_kept_or_lost():
    assert wikitext.clean_wikitext("前{{lang|字}}後") == "前字後"
    assert wikitext.clean_wikitext("前{{lang|字}}後", strict=True) == r"\1\2後"


def test_render_numbers_headings_and_joins_items():
    got = wikitext.render_markdown("題", "起\n== 甲 ==\n==== 深 ====\n* 一\n** 二\n尾\n== 乙 ==\n===x===")
    assert got == "# 題\n\n起\n\n## 1 甲\n\n### 1.1 深\n\n* 一\n * 二\n\n尾\n\n## 2 乙\n\n### 2.1 x\n\n"


def test_tags_and_captions():
    tag = "|".join(["[[File:Euclid.jpg", "right", "thumb", "200px", "[[歐幾里得]]，西元前三世紀]]"])
    assert captions.find_file_tags(f"x {tag} y [[File:b.png]] [[File:open") == [tag, "[[File:b.png]]"]
    assert captions.caption_of(tag) == "歐幾里得，西元前三世紀"
    assert captions.caption_of("[[File:a.jpg|thumb|alt=替代]]") == "替代"
    assert captions.caption_of("[[File:a.jpg|thumb|120px]]") is None
    assert captions.caption_of("[[File:a.jpg|甲|left|乙|thumb]]") == "甲|乙|thumb"
    assert captions.caption_of("[[File:a.jpg|甲|left|link=x]]") == "甲"


@pytest.mark.parametrize(
    ("source", "wanted"),
    [
        ("{{Circa|1000}}年", "约1000年"),
        ("{{le|中文|en}}{{Link-en|甲|b}}", "中文甲"),
        ("{{convert|5774|ft|m}}", "5774英尺（或1760米）"),
        ("{{convert|10|m|ft|0}}", "10米（或33英尺）"),
        ("{{convert|x|ft|m}}{{convert|3|kg|lb}}{{convert|3|ft}}", "xft3kg{{convert|3|ft}}"),
        ("{{lang-ja|日|translit=nichi}}{{lang-ko|韓}}", "nichi韓"),
        ("甲<ref>乙", "甲"),
        ("甲&lt;ref x", "甲"),
        ("&lt;span a&gt;字&lt;/span&gt;&amp;'x'", "字&x"),
        ("[[a|[[b]]]]", "b"),
    ],
)
def test_clean_caption(source, wanted):
    assert captions.clean_caption(source) == wanted


def test_units_round_half_to_even():
    assert captions.convert_units("2.5", "m", "m") == "2.5m"
    assert captions.convert_units("0.1524", "m", "ft") == "0.1524米（或0英尺）"


def test_conversion_prefers_longer_phrases():
    assert convert.seed("tw")("头发发展后来") == "頭髮發展後來"
    assert convert.seed("cn")("軟體歷史") == "软件历史"
    assert convert.Converter([])("字") == "字"
    assert convert.space_scripts("中文abc123字(x)") == "中文 abc123 字 (x)"


def test_native_rules_match_python_ones(spark):
    """The JVM forms against the Python ones on random markup."""
    r = random.Random(7)
    pieces = ["[[", "]]", "|", "{{", "}}", "a", "字", " ", "\n", "<ref>", "</ref>", "<ref/>", ",", "，", "。", ".", "!", "{|", "|}", "&amp;", "lt;", "　", " "]
    texts = ["".join(r.choices(pieces, k=r.randint(0, 25))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    pairs = {
        "links": (native.unwrap_links, Rules((r"\[{2}[^]|]+\|([^]|]+)\]{2}", r"\1"), (r"\[{2}([^]|]+)\]{2}", r"\1"))),
        "templates": (native.strip_templates, Rules((r"\{\{.*?\}\}", "", "s"))),
        "references": (native.strip_references, Rules(("<ref.*?</ref>", "", "s"), ("<ref.*?/>", ""))),
        "punctuation": (native.collapse_punctuation, Rules(*[(f"[{a}{b}]{{2,}}", b) for a, b in (",，", ".。", ";；", "!！", "?？")])),
        "entities": (native.decode_entities, markup.decode_entities),
        "space": (native.collapse_space, lambda t: Rules((r"\s+", " "))(t).strip()),
        "stops": (native.dedupe_stops, Rules((r"([。！？])\1+", r"\1"))),
    }
    rows = df.select("t", *[f(df.t).alias(k) for k, (f, _) in pairs.items()]).collect()
    for row in rows:
        for k, (_, python) in pairs.items():
            assert row[k] == python(row.t), (k, row.t)


def test_rules_are_skipped_only_where_they_cannot_match():
    from quern.functions import rules

    chains = [markup.CLEAN, markup._PLAIN_HEAD, normalize._PARAGRAPH, normalize._JOINED, normalize._FIELDS, normalize._MARKS, normalize._SPACING, normalize._RESIDUE, wikitext._TABLES, wikitext._INLINE, wikitext._LINES]
    assert sum(bool(chars) for chain in chains for _, _, chars in chain.compiled) > 100
    r = random.Random(5)
    parts = [*"[]{}|<>=#*+-_'\"`()（）「」『』，。；：、！？,.;:!?&$%^~@ \t\n　", "ab ", "Stat 1", "12", "3.5", "一二", "方面，", "可以指", "是", "date of", "出生", "<ref", "/>", "</ref>", "[[", "]]", "File:", "''", "==", "jpg。", "http://x", "\n## ", "{|", "|}", "決賽"]
    for _ in range(3000):
        text = "".join(r.choices(parts, k=r.randint(0, 30)))
        for chain in chains:
            for pattern, to, chars in chain.compiled:
                assert not chars or any(c in text for c in chars) or pattern.search(text) is None
            plain = text
            for pattern, to, _ in chain.compiled:
                plain = pattern.sub(to, plain)
            assert chain(text) == plain
    assert rules.needed("a+[xy]?(b|[cd])") in (("a",), ("b", "c", "d")) and rules.needed("x*") == () and rules.needed("(?:a|)") == ()


def test_long_texts_are_scanned_by_what_they_hold():
    from quern.functions import convert, rules

    chains = [markup.CLEAN, markup._PLAIN_HEAD, normalize._PARAGRAPH, normalize._JOINED, normalize._FIELDS, normalize._MARKS, normalize._SPACING, normalize._RESIDUE, wikitext._TABLES, wikitext._INLINE, wikitext._LINES, convert._SPACING]
    r = random.Random(6)
    parts = [*"[]{}|<>=#*+-_'\"`()（）「」『』，。；：、！？,.;:!?&$%^~@ \t\n　\x1f\x85 ", "ab ", "ſtat 1", "12", "3.5", "一二", "方面，", "date of", "出生地", "決賽", "<ref", "/>", "a.JPG。", "𠀀", "\ud800", "。。", "  "]
    for k in range(400):
        some = r.sample(parts, r.randint(1, len(parts)))
        text = "天地玄黃 宇宙。" * (80 * (k % 2)) + "".join(r.choices(some, k=r.randint(0, 60)))
        assert set(rules.distinct(text)) == set(text)
        for chain in chains:
            plain = text
            for pattern, to, _ in chain.compiled:
                plain = pattern.sub(to, plain)
            assert chain(text) == plain, (text, chain.source)
    # as the two rules were before
    slow = [(re.compile(r"(?<!\d)\.(?!\d)"), ""), (re.compile(rf"([A-Za-z{rules.HAN}])\s+([,.;:!?；：。！？])"), r"\1\2"), (re.compile(rf"([{convert._CJK}])([A-Za-z0-9`$%^&*\-=+\\|/@#])"), r"\1 \2")]
    fast = [normalize._MARKS.compiled[0], normalize._SPACING.compiled[1], convert._SPACING.compiled[7]]
    for _ in range(3000):
        text = "".join(r.choices("ab1。.,;！ \t\n天地#-", k=r.randint(0, 25)))
        for (old, to), (new, also, _) in zip(slow, fast):
            assert old.sub(to, text) == new.sub(also, text)
    # what no text of Han characters and blanks can match is not tried on it
    han = "天地玄黃 宇宙 洪荒。 " * 100
    tried = [p.pattern for chain in (normalize._FIELDS, normalize._RESIDUE) for (p, _, _), (met, _, _) in zip(chain.compiled, chain.steps) if met(han, rules.distinct(han))]
    assert tried == [r"([。！？])\1+", r"\s+", r"\s+"]


def test_white_space_is_joined_without_a_pattern():
    from quern.functions import rules

    assert [change for _, change, _ in normalize._FIELDS.steps][-1] is rules.one_space
    for text in ("", " ", "\n\t", "a", " a\x1f\x85b　c ", " a  b"):
        assert rules.one_space(text) == re.sub(r"\s+", " ", text) and rules.one_blank(text) == re.sub("[\t ]+", " ", text)


def test_lone_dots_are_sought_from_the_dot():
    assert normalize._MARKS.compiled[0][0].pattern.startswith(r"\.")
    assert [normalize._MARKS(t) for t in (".", "a.b", "1.b", "a.1", "1.1", "..", "1..1", "一.二.3.5.")] == ["", "ab", "1.b", "a.1", "1.1", "", "1..1", "一二.3.5."]


def test_repeated_marks_are_squeezed_without_a_pattern():
    from quern.functions import rules

    chain = Rules((r"([。！？])\1+", r"\1"), ("[.。]{2,}", "。"), ("，，+", "，"))
    assert not any(getattr(change, "func", None) for _, change, _ in chain.steps)
    for text in ("", "。", "。。。！！？", ".。..", "....", "a，，，b，", "。！。！！"):
        assert [change(text) for _, change, _ in chain.steps] == [re.sub(p, to, text) for p, to in chain.source]
    assert rules.squeeze("。。。a。。", "。") == "。a。"
