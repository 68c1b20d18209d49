"""Named queries over the given tables and the SQL that each is held against.

The tables hold no wiki markup and no Han text, so most queries first build markup from whole columns,
by the same concatenation in both engines. Where a chain of many rules is applied, texts are first reduced to lines of
plain words, or of Han characters letter by letter, which no rule changes: what the rules do to the markup put between
them then has a closed form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import native
from quern.functions.captions import caption_of, convert_units, find_file_tags
from quern.functions.convert import seed, space_scripts
from quern.functions.markup import clean_markdown, markdown_to_text
from quern.functions.wikitext import page_to_markdown
from quern.operators import fetch, images, pages, quality, records, sections, shards
from quern.operators.udf import text_column
from quern.runtime import prepare, read_table
from quern.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


# ---- sources and page filters -------------------------------------------------------------------

_PREFIX = {"fr": "File:", "de": "Help:", "es": "Notes:"}


@query("""
select doc_id, title from (
    select doc_id, text, case lang when 'fr' then 'File:' when 'de' then 'Help:' when 'es' then 'Notes:' else '' end || source as title from documents)
where split_part(title, ':', 1) not in ('File', 'Help') and not starts_with(text, '#') and length(text) >= 30
""")
def page_title_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = F.create_map(*[F.lit(x) for pair in _PREFIX.items() for x in pair])
    titled = _docs(spark, sf_dir).withColumn("title", F.concat(F.coalesce(prefix[F.col("lang")], F.lit("")), "source"))
    return pages.articles(titled).select("doc_id", "title")


@query(r"select page_id, regexp_extract(html, '<title>(.*?)</title>', 1) as title from pages")
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"))


@query("select strftime(max(o_orderdate), '%Y%m') as month from orders")
def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = read_table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyyMM").alias("month"))
    return files.newest(months, "month", 6)


@query("select d.doc_id::varchar as file_name from documents d where not exists (from labels l where l.doc_id = d.doc_id)")
def already_fetched_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("file_name"))
    return fetch.not_yet_fetched(rows, read_table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("file_name")))


@query("select d.doc_id::varchar as file_name from documents d where exists (from labels l where l.doc_id = d.doc_id)")
def local_copies_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("file_name"))
    return fetch.available_locally(rows, read_table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("file_name")))


# ---- texts that rules leave alone ---------------------------------------------------------------

_HAN_LETTERS = "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏閏餘"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Lines of words, of Han words with blanks between them, and of Han characters alone, in SQL.
_WORDS_SQL = "trim(regexp_replace(regexp_replace(text, '[^A-Za-z\\n]+', ' ', 'g'), ' *\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10))"
_SPACED_SQL = f"translate(lower({_WORDS_SQL}), '{_LETTERS}', '{_HAN_LETTERS}')"
_HAN_SQL = f"replace({_SPACED_SQL}, ' ', '')"


def _words() -> Column:
    # letters one by one: a class of single characters is looked up in one table, ranges are tried one after the other
    other = f"[^{_LETTERS}{_LETTERS.upper()}\n]++"
    return F.trim(F.regexp_replace(F.regexp_replace("text", other, " "), " *\n[ \n]*", "\n"), F.lit(" \n"))


def _spaced() -> Column:
    return F.translate(F.lower(_words()), _LETTERS, _HAN_LETTERS)


def _han() -> Column:
    return F.replace(_spaced(), F.lit(" "), F.lit(""))


def _ended_lines(end: str, between: str) -> Column:
    """Lines of Han characters with ``between`` for line ends and ``end`` at the end, unless there are none; they are worked out once."""
    end_lines = lambda han: F.when(han == "", "").otherwise(F.concat(F.replace(han, F.lit("\n"), F.lit(between)), F.lit(end)))
    return F.get(F.transform(F.array(_han()), end_lines), F.lit(0))


def _swap(c: Column, blank: str, line: str) -> Column:
    """``blank`` for blanks and ``line`` for line ends."""
    return F.replace(F.replace(c, F.lit(" "), F.lit(blank)), F.lit("\n"), F.lit(line))


def _swap_sql(c: str, blank: str, line: str) -> str:
    return f"replace(replace({c}, ' ', '{blank}'), chr(10), '{line}')"


# ---- wikitext and markup ------------------------------------------------------------------------


def _cleaned(spark: SparkSession, sf_dir: str, *parts: str | Column) -> DataFrame:
    return _marked(spark, sf_dir, *parts).select("doc_id", text_column(clean_markdown, "string", F.col("text")).alias("text"))


def _plain_text(spark: SparkSession, sf_dir: str, value: Column) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", text_column(markdown_to_text, "string", value).alias("text"))


def _normal_text(spark: SparkSession, sf_dir: str, value: Column) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", records.normalized(value)["text"].alias("text"))


def _marked(spark: SparkSession, sf_dir: str, *parts: str | Column) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).alias("text"))


@query(f"select doc_id, source || ' and ' || lang || ' ' || {_WORDS_SQL} as text from documents")
def link_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir, "[[", F.col("source"), "]] and [[", F.col("source"), "|", F.col("lang"), "]] ", _words())


@query(f"select doc_id, {_WORDS_SQL} || ' end' as text from documents")
def template_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir, "{{box|", F.col("source"), "\n}}", _words(), "{{cite|", F.col("lang"), "}} end")


@query(f"select doc_id, ':' || {_WORDS_SQL} || '|' || source as text from documents")
def table_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir, ":{| class\n| ", F.col("lang"), "\n|}", _words(), "|", F.col("source"))


@query(f"select doc_id, {_WORDS_SQL} || '.' as text from documents")
def ref_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir, "<ref name='", F.col("lang"), "'>", F.col("source"), "\n</ref>", _words(), '<ref name="x"/>', ".")


@query(f"select doc_id, {_swap_sql(_WORDS_SQL, '<', '—')} as text from documents")
def entity_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_text(spark, sf_dir, _swap(_words(), "&lt;", "&mdash;"))


_DECODED = "html"
for _entity, _char in zip("&lt; &gt; &amp; &quot; &apos; &nbsp; &#39; &mdash; &ndash; &ldquo; &rdquo;".split(), ["<", ">", "&", '"', "''", " ", "''", "—", "–", '"', '"']):
    _DECODED = f"replace({_DECODED}, '{_entity}', '{_char}')"


_BARE = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g')"


@query(f"select page_id, trim(regexp_replace({_DECODED.replace('html', _BARE)}, '[ \\t\\n\\r]+', ' ', 'g'), ' ') as text from pages")
def strip_html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", native.strip_html(F.col("html")).alias("text"))


@query(f"select doc_id, replace({_WORDS_SQL}, chr(10), ' •') as text from documents")
def list_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_text(spark, sf_dir, F.concat(F.lit("* "), F.replace(_words(), F.lit("\n"), F.lit("\n* "))))


@query(f"select doc_id, {_swap_sql(_WORDS_SQL, '，', '。')} as text from documents")
def punct_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_text(spark, sf_dir, _swap(_words(), ",，", "..。"))


def _ended(text: str) -> str:
    """A body of two characters or more, in SQL, with a full stop at its end."""
    return f"case when length({text}) < 2 then '' else {text} || '。' end"


@query(f"select doc_id, {_ended(_swap_sql(_SPACED_SQL, ' ', ' '))} as text from documents")
def whitespace_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal_text(spark, sf_dir, _swap(_spaced(), " \t  ", "\t"))


@query(f"select doc_id, {_ended(_swap_sql(_SPACED_SQL, '。', '！'))} as text from documents")
def backref_dedupe_punct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal_text(spark, sf_dir, _swap(_spaced(), "。。。", "！！"))


@query(f"select doc_id, {_ended(_swap_sql(_SPACED_SQL, '', '3.5'))} as text from documents")
def dot_between_nondigits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normal_text(spark, sf_dir, _swap(_spaced(), ".", "3.5"))


_PAGE_LINES = f"string_split({_WORDS_SQL}, chr(10))"


@query(f"""
select doc_id, '# ' || source || nn || source || ' ' || lang || ' link' || nn || nn || '## 1 ' || source || nn || '* ' || lines[1] || chr(10)
    || array_to_string(list_transform(range(2, len(lines) + 1), lambda i: case when i = 2 then chr(10) else '' end || nn || '### 1.' || (i - 1) || ' part' || nn || lines[i] || nn), '') as md
from (select *, {_PAGE_LINES} as lines, chr(10) || chr(10) as nn from documents)
""")
def wikitext_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a page source with variants, templates, links, headings and lists."""
    parts = ["-{zh-hans:", "source", ";zh-tw:x}- {{Le|a|b|", "lang", "}} {{box|", "lang", "}}<!-- x -->[[", "source", "|''link'']]<ref>", "lang", "</ref>\n\n\n== ", "source", " ==\n* "]
    source = F.concat(*[F.col(p) if p in ("source", "lang") else F.lit(p) for p in parts], F.replace(_words(), F.lit("\n"), F.lit("\n=== part ===\n")))
    render = text_column(lambda text, title: page_to_markdown(title, text), "string", source, F.col("source"))
    return _docs(spark, sf_dir).select("doc_id", render.alias("md"))


# ---- sections -----------------------------------------------------------------------------------

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Markdown: their source as the first heading, and a second-level heading at each line break."""
    value = F.concat(F.lit("# "), "source", F.lit("\n"), F.replace("text", F.lit("\n"), F.concat(F.lit("\n## "), "lang", F.lit("\n"))))
    return _docs(spark, sf_dir).select("doc_id", "source", value.alias("value"))


_SECTIONS = f"""
select doc_id, source, i as section_no, case when i = 1 then source else source || '-' || lang end as section_title, trim(line, {_BLANK}) as content from (
    select doc_id, source, lang, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1))::int as i from documents)
where length(trim(line, {_BLANK})) > 20
"""


@query(_SECTIONS)
def section_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.explode_sections(_headed(spark, sf_dir))


@query("select doc_id, source || '-' || case lang when 'fr' then '參考資料' when 'de' then 'Talk page' else '歷史' end as title, lang in ('fr', 'de') as stopped from documents")
def stop_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.when(F.col("lang") == "fr", "參考資料").when(F.col("lang") == "de", "Talk page").otherwise("歷史")
    rows = _docs(spark, sf_dir).select("doc_id", F.concat_ws("-", "source", word).alias("title"))
    return rows.withColumn("stopped", sections.is_stopped(F.col("title")))


# ---- quality ------------------------------------------------------------------------------------


_LATIN_SQL, _HAN_CLASS_SQL = "[A-Za-z\\x{c0}-\\x{24f}]", "[\\x{4e00}-\\x{9fff}]"


def _measures(text: str, script: str = _LATIN_SQL) -> str:
    found = lambda p: f"len(regexp_extract_all({text}, '{p}'))"
    return f"""length(trim({text}, {_BLANK})) as n_stripped, length({text}) as n_all,
    {found('[^\\p{L}\\p{M}\\p{N}\\p{Pc}\\s，。！？；：「」『』（）]')} as n_special,
    regexp_matches({text}, '[A-Za-z_]+\\s*=|\\|\\s*[A-Za-z]|\\{{\\{{.*?\\}}\\}}|\\}}\\}}.*?是|##\\s*[0-9]+\\.[0-9]+|blank[0-9]*_|population_|pushpin_|image_|subdivision_|settlement_type') as has_residue,
    {found('。。')} as n_doubled_stop, {found('，，')} as n_doubled_comma, {found('[0-9]+\\.[0-9]+')} as n_outline, {found(script)} as n_script,
    len(list_filter(regexp_split_to_array({text}, '[。！？]'), lambda p: length(trim(p, {_BLANK})) > 3)) as n_sentences,
    length(array_to_string(regexp_extract_all({text}, '[（(][^）)]*[）)]'), '')) as n_bracketed,
    len(list_filter(string_split({text}, chr(10)), lambda p: length(trim(p, {_BLANK})) = 1)) as n_short_lines"""


_GATE = """n_stripped >= 30 and n_special <= 0.3 * n_all and not has_residue and n_doubled_stop <= 2 and n_doubled_comma <= 2 and n_outline <= 30
    and n_script >= 15 and n_script >= 0.25 * n_all and n_sentences >= 1 and n_bracketed <= 0.3 * n_all and n_short_lines <= 2"""


@query(f"select doc_id, {_measures('text')} from documents")
def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_metrics(_docs(spark, sf_dir).select("doc_id", "text"), gate=quality.LATIN).drop("text")


@query(f"select doc_id from (select doc_id, {_measures('text')} from documents) where {_GATE}")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.keep_good(_docs(spark, sf_dir).select("doc_id", "text"), gate=quality.LATIN).select("doc_id")


@query("select p_partkey, p_name as title from part where contains(p_name, 'a') or contains(p_name, '7')")
def keyword_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("title"))
    return rows.filter(records.title_has(["a", "7"]))


@query(f"select section_title as title, content as text, doc_id::varchar || '.md' as source_file from (select *, {_measures('content')} from ({_SECTIONS})) where {_GATE}")
def gated_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with headings to gated (title, text, source_file) records, all JVM-side."""
    rows = sections.explode_sections(_headed(spark, sf_dir)).select(F.col("section_title").alias("title"), F.col("content").alias("text"), F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("source_file"))
    return quality.keep_good(rows, gate=quality.LATIN)


flagship = gated_sections


# ---- normalisation and conversion ---------------------------------------------------------------


#: Lines of Han characters, each with an end that the rules reduce to a full stop.
_LINE_END = "，，（ ）。。"
_SENTENCES_SQL = f"case when {_HAN_SQL} = '' then '' else replace({_HAN_SQL}, chr(10), '。') || '。' end"


def _sentences() -> Column:
    return _ended_lines(_LINE_END, f"{_LINE_END}\n")


@query(f"select doc_id, source as title, {_SENTENCES_SQL} as text from documents")
def normalize_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain text and normalisation of every document; the heading becomes the title."""
    value = F.concat(F.lit("## "), "source", F.lit("\n"), _sentences())
    return _docs(spark, sf_dir).select("doc_id", records.normalized(value).alias("normal")).select("doc_id", "normal.title", "normal.text")


@query(f"select doc_id, {_measures('s', _HAN_CLASS_SQL)} from (select doc_id, '「' || lang || '」(1.5)' || chr(10) || {_SENTENCES_SQL} as s from documents)")
def quality_metrics_han(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select("doc_id", F.concat(F.lit("「"), "lang", F.lit("」(1.5)\n"), _ended_lines("。", "。")).alias("text"))
    return quality.with_metrics(rows, gate=quality.HAN).drop("text")


@query(f"""
select title, text, source_file from (
    select *, {_measures('text', _HAN_CLASS_SQL)} from (
        select '語言 ' || source || '-歷史' as title, {_SENTENCES_SQL} as text, doc_id::varchar || '.md' as source_file,
            length({_HAN_SQL}) + {len(_LINE_END)} * len(string_split({_HAN_SQL}, chr(10))) as held from documents))
where held > 20 and {_GATE}
""")
def text_record_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole path to records over documents in Han characters, with title fallback and gate."""
    value = F.concat(F.lit("# 语言"), "source", F.lit("\n## 历史\n"), _sentences())
    docs = _docs(spark, sf_dir).select(F.concat(F.col("doc_id").cast("string"), F.lit(".md")).alias("source_file"), value.alias("value"))
    return records.text_records(docs, "tw")


@query("select doc_id, '軟體和歷史 ' || source || ' 說 ' || lang as text from documents")
def script_convert_and_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    convert = seed("tw")
    text = F.concat(F.lit("软件和历史"), "source", F.lit("说"), "lang")
    return _docs(spark, sf_dir).select("doc_id", text_column(lambda t: space_scripts(convert(t)), "string", text).alias("text"))


@query("select p_partkey, p_size || '英尺（或' || round_even(p_size * 0.3048, 0)::int || '米）' as text from part")
def unit_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    return read_table(spark, sf_dir, "part").select("p_partkey", text_column(lambda v: convert_units(v, "ft", "m"), "string", size).alias("text"))


# ---- images -------------------------------------------------------------------------------------

_EXTENSION = "case when p_size > 40 then '.TIFF' when p_size > 10 then '.jpg' else '.txt' end"
_NAME = f"p_brand || ' ' || p_size || {_EXTENSION}"
_CAPTION = "case when p_retailprice > 950 then p_type else '' end"


def _image_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each part: one line with a nested link in a file tag and words around it."""
    kind = F.when(F.col("p_size") > 40, ".TIFF").when(F.col("p_size") > 10, ".jpg").otherwise(".txt")
    caption = F.when(F.col("p_retailprice") > 950, F.concat(F.lit("[["), "p_type", F.lit("]]"))).otherwise("")
    name = F.concat("p_brand", F.lit(" "), F.col("p_size").cast("string"), kind)
    tag = F.concat(F.lit("see [[File:"), name, F.lit("|thumb|200px|"), caption, F.lit("]] there"))
    return read_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"), tag.alias("text"))


_TAGS = f"'[[File:' || {_NAME} || '|thumb|200px|' || case when p_retailprice > 950 then '[[' || p_type || ']]' else '' end || ']]'"


@query(f"select p_partkey::varchar as id, {_TAGS} as tag from part")
def image_tags_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.tags(_image_pages(spark, sf_dir)).select("id", "tag")


@query(f"select p_partkey::varchar as id, nullif({_CAPTION}, '') as title from part")
def image_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _image_pages(spark, sf_dir).withColumn("tag", F.get(text_column(find_file_tags, "array<string>", F.col("text")), F.lit(0)))
    return rows.select("id", text_column(caption_of, "string", F.col("tag")).alias("title"))


@query(f"select distinct {_NAME} as file_name from part where p_size > 10")
def image_ext_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = images.tags(_image_pages(spark, sf_dir)).select(images.file_name(F.col("tag")).alias("file_name"))
    return rows.filter(images.has_image_extension(F.col("file_name")) & ~images.is_placeholder(F.col("file_name"))).distinct()


_FIRST = f"""
select 'https://example.org/' || replace(file_name, ' ', '_') as url, title, file_name, page, tag from (
    select p_partkey, {_NAME} as file_name, {_CAPTION} as title, p_name as page, {_TAGS} as tag, row_number() over (partition by {_NAME} order by p_partkey) as turn
    from part where p_size > 10 and p_retailprice > 950) where turn = 1"""


@query(_FIRST)
def image_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.image_records(_image_pages(spark, sf_dir), lang=None, prefix="https://example.org/")


@query(_FIRST.replace("p_type else ''", "'頭髮' || p_type else ''").replace("|200px|' || case when p_retailprice > 950 then '[[' ||", "|200px|' || case when p_retailprice > 950 then '[[头发' ||"))
def image_captions_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions go to the traditional script; tags stay as they are."""
    rows = _image_pages(spark, sf_dir).withColumn("text", F.replace("text", F.lit("[["), F.lit("[[头发")))
    rows = rows.withColumn("text", F.replace("text", F.lit("[[头发File:"), F.lit("[[File:")))
    return images.image_records(rows, lang="tw", prefix="https://example.org/")


@query("select p_partkey, p_size % 3 = 0 or p_size % 5 = 0 as placeholder from part")
def image_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("p_size") % 3 == 0, "No Free IMAGE ").when(F.col("p_size") % 5 == 0, "no image ").otherwise("an image ")
    rows = read_table(spark, sf_dir, "part").select("p_partkey", F.concat(name, F.col("p_brand"), F.lit(".png")).alias("file_name"))
    return rows.select("p_partkey", images.is_placeholder(F.col("file_name")).alias("placeholder"))


@query("select distinct 'https://example.org/' || p_size as url, p_brand || '-' || p_size as file_name from part where p_size % 2 = 0")
def fetch_wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    url = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("https://example.org/"), F.col("p_size").cast("string")))
    return fetch.wanted(part.select(url.alias("url"), F.concat(F.lit("image/"), "p_brand", F.lit("-"), F.col("p_size").cast("string")).alias("file_name")))


@query(_FIRST + " order by p_partkey limit 25")
def max_images_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.image_records(_image_pages(spark, sf_dir), lang=None, max_images=25, prefix="https://example.org/")


# ---- sinks --------------------------------------------------------------------------------------

_LINE = """'{"c_custkey": ' || c_custkey || ', "c_name": "' || c_name || '", "c_mktsegment": "' || c_mktsegment || '"}'"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "customer")
    return rows.select("c_custkey", shards.json_line("c_custkey", "c_name", "c_mktsegment").alias("line"))


@query(f"select c_custkey, {_LINE} as line from customer")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir)


@query(f"select c_custkey, strlen({_LINE}) + 1 as bytes from customer")
def json_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("c_custkey", native.octets(F.col("line")).alias("bytes"))


def _packed(rule: str) -> str:
    return f"""
with recursive sized as (select c_custkey, strlen({_LINE}) + 1 as size, row_number() over (order by c_custkey) as i from customer),
packed as (
    select i, c_custkey, size, 1::bigint as part_no, size as held from sized where i = 1
    union all
    select s.i, s.c_custkey, s.size, p.part_no + ({rule})::bigint, case when {rule} then s.size else p.held + s.size end from packed p join sized s on s.i = p.i + 1)
select c_custkey, part_no from packed"""


@query(_packed("p.held + s.size > 10000"))
def shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("c_custkey", native.octets(F.col("line")).alias("size"))
    return shards.assign_parts(rows, ["c_custkey"], "size", 10_000).select("c_custkey", "part_no")


@query(_packed("p.held >= 10000"))
def shard_assign_close_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("c_custkey", native.octets(F.col("line")).alias("size"))
    return shards.assign_parts(rows, ["c_custkey"], "size", 10_000, close_after=True).select("c_custkey", "part_no")


@query(_packed("p.held + s.size + 10 > 10000"))
def array_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of JSON arrays: a record counts 10 bytes more where it may start a part."""
    rows = _lines(spark, sf_dir).select("c_custkey", native.octets(F.col("line")).alias("size"))
    return shards.assign_parts(rows, ["c_custkey"], "size", 10_000, overhead=10).select("c_custkey", "part_no")
