"""Sections of Markdown documents by heading, with titles from the heading stack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.native import replace, strip

MIN_SECTION_LENGTH = 20
MARK = "#{1,6}"
OUTLINE = r"(?U)\A\d+(?:[.]\d+)*\s*"

_BOTH = "附件 另看 其他 引用 talk"
_TRADITIONAL = "參考 延伸閱讀 註釋 注釋 註解 腳註 註腳 注腳 註記 注記 附註 備註 說明 連結 外部資源 外部網站 官方網站 官網 相關網站 參見 參看 相關條目 相關主題 相關詞條 另見 相關文章 相關頁面 關聯條目 類似條目 來源 文獻 資源 出處 書目 附錄 圖片引用 圖表引用 外部鏈接 外部鏈結 補充資料 版權 授權 許可 聲明 版本歷史 修訂歷史 編輯歷史 討論"
_SIMPLIFIED = "参考 延伸阅读 注释 注解 脚注 注脚 注记 附注 备注 说明 链接 外部资源 外部网站 官方网站 官网 相关网站 参见 参看 相关条目 相关主题 相关词条 另见 相关文章 相关页面 关联条目 类似条目 来源 文献 资源 出处 书目 附录 图片引用 图表引用 外部链结 补充资料 版权 授权 许可 声明 版本历史 修订历史 编辑历史 讨论 外部连结 资料引用"
#: Words of titles whose sections are no prose; any may stand anywhere in the joined title.
STOP_TITLES = tuple(dict.fromkeys(f"{_BOTH} {_TRADITIONAL} {_SIMPLIFIED}".split()))


def is_stopped(title: Column, words: tuple[str, ...] = STOP_TITLES) -> Column:
    """Whether a joined title holds a stop word, in any letter case; an empty title does not."""
    return title.rlike("(?iu)" + "|".join(words))


def sections_column(value: Column) -> Column:
    """``array<struct<title, content>>`` of a Markdown text, before any filter.

    A heading is a line of 1 to 6 ``#`` and a text; leading outline numbers go. A title joins the
    stack of headings with ``-``; the stack is cut to the heading's level less one before it is pushed.
    Text before the first heading has an empty title; a text without headings has no sections.
    """
    lines = F.split(value, "\n", -1)
    head = rf"(?U)(?d)\A({MARK})\s*(.+)"
    # patterns are tried on lines that start with a mark only
    marked = F.filter(F.transform(lines, lambda line, i: F.struct(i.alias("at"), line.alias("line"))), lambda x: F.startswith(x["line"], F.lit("#")))
    parsed = F.transform(marked, lambda x: F.struct(x["at"].alias("at"), F.length(F.regexp_extract(x["line"], head, 1)).alias("level"), strip(replace(F.regexp_extract(x["line"], head, 2), OUTLINE)).alias("title")))
    heads = F.filter(parsed, lambda h: h["level"] > 0)
    empty = F.struct(F.array().cast("array<string>").alias("stack"), F.array().cast("array<string>").alias("paths"))

    def push(state: Column, h: Column) -> Column:
        stack = F.concat(F.slice(state["stack"], F.lit(1), F.least(F.size(state["stack"]), h["level"] - 1)), F.array(h["title"]))
        return F.struct(stack.alias("stack"), F.concat(state["paths"], F.array(F.array_join(stack, "-"))).alias("paths"))

    both = F.struct(lines.alias("lines"), heads.alias("heads"), F.aggregate(heads, empty, push)["paths"].alias("paths"))

    def cut(b: Column) -> Column:
        n = F.size(b["heads"])

        def section(k: Column) -> Column:
            start = F.when(k == 0, 0).otherwise(F.get(b["heads"], k - 1)["at"] + 1)
            stop = F.when(k == n, F.size(b["lines"])).otherwise(F.get(b["heads"], k)["at"])
            title = F.when(k == 0, "").otherwise(F.get(b["paths"], k - 1))
            return F.struct(title.alias("title"), strip(F.array_join(F.slice(b["lines"], start + 1, stop - start), "\n")).alias("content"))

        none = F.array().cast("array<struct<title:string,content:string>>")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n), section)).otherwise(none)

    # bound through an array of one, so that the heading fold is worked out once
    return F.flatten(F.transform(F.array(both), cut))


def explode_sections(docs: DataFrame, value: str = "value", min_length: int = MIN_SECTION_LENGTH, words: tuple[str, ...] | None = STOP_TITLES) -> DataFrame:
    """One row a section, of ``docs``' other columns, ``section_no``, ``section_title`` and ``content``.

    Sections of ``min_length`` characters or fewer and, unless ``words`` is None, of stopped titles go.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != value]
    out = docs.select(*rest, F.posexplode(sections_column(F.col(value))).alias("section_no", "section"))
    out = out.select("*", F.col("section.title").alias("section_title"), F.col("section.content").alias("content")).drop("section")
    out = out.filter(F.length("content") > min_length)
    return out if words is None else out.filter((F.col("section_title") == "") | ~is_stopped(F.col("section_title"), words))
