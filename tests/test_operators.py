import bz2
import json

import pytest
from pyspark.sql import functions as F

from quern.operators import fetch, images, pages, quality, records, sections, shards
from quern.plans import cli, datasets
from quern.sources import dump, files, sinks
from quern.streaming import records as stream

LONG = "這是一段足夠長的歷史內容，用來確認段落會被保留下來，並且有完整的句子。"


def page(title, ns, number, text):
    return f"  <page>\n    <title>{title}</title>\n    <ns>{ns}</ns>\n    <id>{number}</id>\n    <revision>\n      <id>9</id>\n      <text xml:space=\"preserve\">{text}</text>\n    </revision>\n  </page>\n"


DUMP = "<mediawiki>\n  <siteinfo/>\n" + "".join(
    [
        page("條目", 0, 1, f"{LONG}\n== 歷史 ==\n{LONG}&lt;ref&gt;註&lt;/ref&gt;\n[[File:A.jpg|thumb|說明文字]]\n[[File:B.txt|字]]\n== 參考資料 ==\n{LONG}"),
        page("File:x", 6, 2, LONG),
        page("轉向", 0, 3, "#REDIRECT [[條目]] and some more characters here"),
        page("短", 0, 4, "太短"),
        page("另一條", 0, 10, f"  {LONG}\n[[File:A.jpg|thumb|後來的說明]] [[File:C c.PNG|[[甲|乙]]]] [[File:No Image.png|字]]"),
        page("無圖說", 0, 5, f"{LONG} [[File:C c.PNG|thumb]] &amp;lt;"),
    ]
) + "</mediawiki>\n"


@pytest.fixture(params=["dump.xml", "dump.xml.bz2"])
def dump_path(request, tmp_path):
    path = tmp_path / request.param
    path.write_bytes(bz2.compress(DUMP.encode()) if path.suffix == ".bz2" else DUMP.encode())
    return str(path)


def test_dump_pages(spark, dump_path):
    rows = {r.id: r for r in dump.read_pages(spark, dump_path).collect()}
    assert set(rows) == {"1", "2", "3", "4", "10", "5"}
    assert rows["10"].text.startswith("  這是") and rows["1"].ns == 0 and rows["2"].title == "File:x"
    assert "<ref>註</ref>" in rows["1"].text
    escaped = {r.id: r.text for r in dump.read_pages(spark, dump_path, keep_escaped=True).collect()}
    assert "&lt;ref&gt;" in escaped["1"] and escaped["5"].endswith("&amp;lt;")
    assert dump.read_lines(spark, dump_path).filter("page = '條目' and line like '%File:A.jpg%'").count() == 1


def test_articles_and_markdown(spark, dump_path):
    got = pages.to_markdown(dump.read_pages(spark, dump_path))
    assert {r.page_id for r in got.collect()} == {"1", "5", "10"}
    md = got.filter("page_id = '1'").first().md
    assert md.startswith("# 條目\n\n") and "## 1 歷史\n\n" in md and "註" not in md and "File" not in md
    assert [r.page_id for r in pages.to_markdown(dump.read_pages(spark, dump_path), limit=1).collect()] == ["1"]


def test_text_dataset(spark, dump_path):
    rows = datasets.text_dataset(datasets.markdown_of_dump(spark, dump_path), "tw").collect()
    titles = {(r.title, r.source_file) for r in rows}
    assert ("條目-歷史", "1.md") in titles and not any("參考" in t for t, _ in titles)
    assert all(len(r.text) >= 30 for r in rows)


def test_image_dataset_first_captioned_wins(spark, dump_path):
    rows = {r.file_name: r for r in datasets.image_dataset(spark, dump_path, None).collect()}
    assert set(rows) == {"A.jpg", "C c.PNG"}
    assert rows["A.jpg"].title == "說明文字" and rows["A.jpg"].page == "條目"
    assert rows["C c.PNG"].title == "乙" and rows["C c.PNG"].url.endswith("/C_c.PNG")
    assert [r.file_name for r in datasets.image_dataset(spark, dump_path, None, max_images=1).collect()] == ["A.jpg"]


def test_generate_all(spark, dump_path, tmp_path):
    paths = datasets.generate_all(spark, dump_path, str(tmp_path / "out"))
    assert set(paths) == {"tw/text", "tw/images", "cn/text", "cn/images"}
    assert spark.read.parquet(paths["cn/images"]).count() == 2


@pytest.mark.parametrize(
    ("value", "wanted"),
    [
        (f"前言{LONG}\n# 甲\n{LONG}", [("", f"前言{LONG}"), ("甲", LONG)]),
        (LONG, []),
        (f"# 甲\n## 乙\n{LONG}\n#### 丁\n{LONG}\n#### 戊\n{LONG}\n## 己\n{LONG}", [("甲-乙", LONG), ("甲-乙-丁", LONG), ("甲-乙-丁-戊", LONG), ("甲-己", LONG)]),
        (f"### 深\n{LONG}\n# 頂\n{LONG}", [("深", LONG), ("頂", LONG)]),
        (f"#1.2 編號\n{LONG}\n# 2020年\n{LONG}", [("編號", LONG), ("年", LONG)]),
        (f"# 參考資料\n{LONG}\n## 下\n{LONG}\n# TALK\n{LONG}\n# 正\n{LONG}", [("正", LONG)]),
        ("# 甲\n" + "字" * 20 + "\n# 乙\n" + "字" * 21, [("乙", "字" * 21)]),
        (f"######\n{LONG}\n　# 非標題\n", [("#", f"{LONG}\n　# 非標題")]),
    ],
)
def test_sections(spark, value, wanted):
    df = spark.createDataFrame([(value,)], "value string")
    got = sections.explode_sections(df).orderBy("section_no").collect()
    assert [(r.section_title, r.content) for r in got] == wanted


QUALITY_CASES = [
    ("字" * 30 + "。", True),
    ("字" * 28 + "。", False),
    ("字" * 30 + "♠" * 13, False),
    ("字" * 30 + "♠" * 12, True),
    ("字" * 30 + "key =", False),
    ("字" * 30 + "{{x}}", False),
    ("字" * 30 + "| a", False),
    ("字" * 30 + "image_", False),
    ("字" * 30 + "##1.2", False),
    ("字。。" * 3 + "字" * 30, False),
    ("字。。" * 2 + "字" * 30, True),
    ("字" * 100 + "1.2 " * 31, False),
    ("字" * 100 + "1.2 " * 30, True),
    ("字" * 14 + "1" * 20, False),
    ("字" * 15 + "1" * 46, False),
    ("字" * 15 + "1" * 45, True),
    ("字字字。" * 20, False),
    ("字" * 30 + "（" + "字" * 20 + "）", False),
    ("字" * 60 + "（" + "字" * 20 + "）", True),
    ("字" * 30 + "\n字\n字\n字", False),
    ("字" * 30 + "\n字\n字", True),
]


def test_quality_gate(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(QUALITY_CASES)], "i int, text string")
    kept = {r.i for r in quality.keep_good(df).collect()}
    assert kept == {i for i, (_, ok) in enumerate(QUALITY_CASES) if ok}


def test_record_options(spark):
    docs = spark.createDataFrame([("a.md", f"﻿# 頭\n{LONG}"), ("b.md", None), ("c.md", "")], "source_file string, value string")
    assert [(r.title, r.source_file) for r in records.text_records(docs, None).collect()] == [("頭", "a.md")]
    assert records.text_records(docs, None, keywords=["無"]).count() == 0
    assert records.text_records(docs, None, min_length=1000).count() == 0


def test_greedy_parts(spark):
    sizes = [5, 5, 5, 20, 1, 9, 1]
    df = spark.createDataFrame(list(enumerate(sizes)), "i int, size int")
    part = lambda **k: [r.part_no for r in shards.assign_parts(df, ["i"], "size", 10, **k).orderBy("i").collect()]
    assert part() == [1, 1, 2, 3, 4, 4, 5]
    assert part(overhead=1) == [1, 2, 3, 4, 5, 6, 7]
    assert part(close_after=True) == [1, 1, 2, 2, 3, 3, 4]
    loose = shards.approximate_parts(df.repartition(2), "size", 10).groupBy("part_no").agg(F.sum("size").alias("s"), F.count("*").alias("n"))
    assert loose.filter("s > 10 and n > 1").count() == 0


def test_json_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, '引"號', None), (2, "二", "x"), (3, "三", "y")], "i int, title string, page string")
    got = sinks.write_json_lines(df, str(tmp_path), "out_", ["i"], 60, fields=["title", "page"]).orderBy("part_no").collect()
    lines = [json.loads(x) for r in got for x in open(r.file, encoding="utf-8")]
    assert lines[0] == {"title": '引"號', "page": None} and len(lines) == 3 and sum(r.records for r in got) == 3
    arrays = sinks.write_json_arrays(df, str(tmp_path), "arr", ["i"], 50, ["title", "page"]).orderBy("part_no").collect()
    assert [x["title"] for r in arrays for x in json.load(open(r.file, encoding="utf-8"))] == ['引"號', "二", "三"]
    one = sinks.write_json_arrays(df, f"file://{tmp_path}/deep/er", "arr", ["i"], 5000, ["title", "page"]).first()
    whole = [{"title": '引"號', "page": None}, {"title": "二", "page": "x"}, {"title": "三", "page": "y"}]
    assert open(one.file.removeprefix("file://"), encoding="utf-8").read() == json.dumps(whole, ensure_ascii=False, indent=2)
    loose = sinks.write_json_lines(df.repartition(2), str(tmp_path / "p"), "out_", ["i"], 60, fields=["title", "page"], parallel=True).collect()
    assert sorted(json.loads(x)["title"] for r in loose for x in open(r.file, encoding="utf-8")) == sorted(x["title"] for x in whole)
    assert len({r.file for r in loose}) == len(loose) > 1
    assert sinks.write_json_lines(df.filter("false"), str(tmp_path), "none_", ["i"]).count() == 0
    line = df.filter("i = 1").select(shards.json_line("title", "page")).first()[0]
    assert line == json.dumps({"title": '引"號', "page": None}, ensure_ascii=False)


def test_markdown_folder_and_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.md").write_text("﻿# x\ny", encoding="utf-8")
    (tmp_path / "sub" / "b.md").write_text("two", encoding="utf-8")
    (tmp_path / "blank.md").write_text(" 　\n", encoding="utf-8")
    (tmp_path / "c.txt").write_text("no", encoding="utf-8")
    assert {(r.source_file, r.value) for r in files.read_markdown(spark, str(tmp_path)).collect()} == {("a.md", "# x\ny"), ("b.md", "two")}
    assert files.read_markdown(spark, str(tmp_path), max_files=1).collect()[0].source_file == "a.md"
    assert {r.file_name for r in files.list_files(spark, str(tmp_path)).collect()} >= {"a.md", "c.txt"}


def test_records_are_read_without_malformed_lines(spark, tmp_path):
    path = tmp_path / "images.jsonl"
    path.write_text('{"url": "u", "title": "t", "file_name": "f", "page": "p", "tag": "x"}\nnot json\n', encoding="utf-8")
    assert [r.file_name for r in files.read_images(spark, str(path)).collect()] == ["f"]


def test_dates(spark):
    df = spark.createDataFrame([("[20250101/] [20251201/] [latest/]", ""), ("none", "12-Jan-2024 10:00"), ("none", "none")], "a string, b string")
    got = [r[0] for r in df.select(files.latest_dump_date(F.col("a"), F.col("b"))).collect()]
    assert got[:2] == ["20251201", "20240112"] and len(got[2]) == 8
    assert files.month_of("20240131") == "202401" and len(files.month_of("x")) == 6
    assert files.dump_state(None, 5) == (False, False) and files.dump_state(5, 0) == (True, True) and files.dump_state(4, 5) == (True, False)
    assert files.parse_shown_date("12-Jan-2024") == "20240112" and files.parse_shown_date("x") is None


def test_prune_needs_consent(tmp_path):
    for name in ("202401", "202402", "other"):
        (tmp_path / name).mkdir()
    assert sinks.prune_months(str(tmp_path), "202402") == ["202401"] and (tmp_path / "202401").exists()
    sinks.prune_months(str(tmp_path), "202402", confirm=True)
    assert {p.name for p in tmp_path.iterdir()} == {"202402", "other"}


def test_fetch_one_retries(tmp_path):
    naps, script = [], {"ok": [(200, b"1")], "busy": [(429, b""), (429, b""), (200, b"2")], "gone": [(404, b"")] * 3}
    go = lambda u, **k: fetch.fetch_one(u, f"{u}.png", str(tmp_path), lambda url, _: script[url].pop(0), sleep=naps.append, **k)
    assert go("ok")[1] == "success" and go("ok")[1] == "exists"
    assert go("busy")[1] == "success" and naps == [3, 5]
    assert go("gone")[1:] == ("fail", "HTTP 404") and naps[2:] == [0.5, 0.5]
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "have.png").write_bytes(b"3")
    assert go("have", reuse=str(tmp_path / "old"))[1] == "copied"


def _transport(url, timeout):
    return (200, url.encode()) if "good" in url else (404, b"")


def test_fetch(spark, tmp_path):
    rows = spark.createDataFrame([("good1", "image/a.png"), ("bad", "b.png"), ("", "c.png"), ("good2", None)], "url string, file_name string")
    got = fetch.fetch(rows, str(tmp_path / "f"), _transport, tasks=2, sleep=lambda s: None)
    assert {(r.file_name, r.status) for r in got.collect()} == {("a.png", "success"), ("b.png", "fail")}


def test_page_export(spark, tmp_path):
    df = spark.createDataFrame([("7", "# x\n")], "page_id string, md string")
    assert open(sinks.export_pages(df, str(tmp_path)).first().file, encoding="utf-8").read() == "# x\n"


def test_cli(spark, dump_path, tmp_path):
    out = cli.main(["pretrain-dataset", "--xml-path", dump_path, "--out", str(tmp_path / "o"), "--no-conversion"], spark)
    assert len(out) == 1 and json.load(open(out[0], encoding="utf-8"))
    assert len(cli.main(["image-dataset", "--xml-path", dump_path, "--out", str(tmp_path / "o")], spark)) == 1
    md = cli.main(["to-md", "--xml-path", dump_path, "--out", str(tmp_path / "o")], spark)
    assert spark.read.parquet(md[0]).count() == 3
    with pytest.raises(SystemExit):
        cli.main(["to-md"], spark)


def test_cli_keeps_order_and_repeats(spark, tmp_path):
    """Sections stay in the order of their documents, and equal sections are as many records as they are."""
    (tmp_path / "in" / "sub").mkdir(parents=True)
    other = LONG.replace("一", "二") + "另外一句話。"
    (tmp_path / "in" / "b.md").write_text(f"# 頭\n{LONG}\n## 乙\n{other}\n## 甲\n{LONG}\n# 頭\n{LONG}", encoding="utf-8")
    (tmp_path / "in" / "a.md").write_text(f"# 頭\n{LONG}", encoding="utf-8")
    (tmp_path / "in" / "sub" / "a.md").write_text(f"# 頭\n{LONG}", encoding="utf-8")
    out = cli.main(["to-pretrain", "--md-dir", str(tmp_path / "in"), "--out", str(tmp_path / "o"), "--no-conversion"], spark)
    found = [(r["source_file"], r["title"]) for r in json.load(open(out[0], encoding="utf-8"))]
    assert found == [("a.md", "頭"), ("a.md", "頭"), ("b.md", "頭"), ("b.md", "頭-乙"), ("b.md", "頭-甲"), ("b.md", "頭")]


def test_faults_are_told(spark, monkeypatch, tmp_path):
    docs = spark.createDataFrame([("a.md", f"# 頭\n{LONG}"), ("b.md", None), ("c.md", "bad"), ("d.md", f"# 頭\n{LONG}\n## 次\n{LONG} worse")], "source_file string, value string")

    def fails(mark, fn):
        def run(text):
            if mark in text:
                raise TypeError(mark)
            return fn(text)

        return run

    monkeypatch.setattr(records, "clean_markdown", fails("bad", records.clean_markdown))
    monkeypatch.setattr(records, "markdown_to_text", fails("worse", records.markdown_to_text))
    ready = records.prepare_documents(docs, None)
    assert {(r.source_file, r.fault) for r in ready.collect() if r.fault} == {("c.md", "TypeError: bad")}
    rows = records.section_records(ready)
    assert {(r.source_file, r.section_no, r.fault) for r in rows.collect() if r.fault} == {("d.md", 2, "TypeError: worse")}
    assert sorted(r.source_file for r in records.gated_records(rows).collect()) == ["a.md", "d.md"]


def test_conversion_tables(tmp_path):
    from quern.functions.convert import Converter, read_pairs

    (tmp_path / "a.txt").write_text("\ufeff# note\n头发\t頭髮\n\n发\t發 髮\n空\t\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("发\t髮\n", encoding="utf-8")
    convert = Converter(read_pairs([str(tmp_path / "a.txt"), str(tmp_path / "b.txt")]))
    assert convert("头发发空x") == "頭髮發x"


def test_stream_of_markdown(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.md").write_text(f"# 頭\n{LONG}", encoding="utf-8")
    rows = stream.record_stream(stream.distinct_within(stream.markdown_stream(spark, str(source))), None)
    run = rows.writeStream.format("memory").queryName("records_stream").option("checkpointLocation", str(tmp_path / "ck")).start()
    try:
        run.processAllAvailable()
        (source / "b.md").write_text(f"# 二\n{LONG}", encoding="utf-8")
        run.processAllAvailable()
    finally:
        run.stop()
    assert {r.title for r in spark.table("records_stream").collect()} == {"頭", "二"}


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "id string, title string, text string")
    assert pages.to_markdown(none).count() == 0 and images.image_records(none).count() == 0
    assert records.text_records(spark.createDataFrame([], "source_file string, value string")).count() == 0


def test_registered_functions(spark):
    from quern.functions.register import register

    assert "clean_markdown" in register(spark)
    got = spark.sql("select clean_markdown('[[甲|乙]]') a, to_traditional('头发') b, image_caption('[[File:a.jpg|字]]') c, space_scripts(null) d").first()
    assert tuple(got) == ("乙", "頭髮", "字", None)


def test_downloads_without_a_network(tmp_path):
    source = tmp_path / "dump.xml"
    source.write_text("x" * 20_000)
    out = cli.main(["download", "--url", source.as_uri(), "--out", str(tmp_path / "o")])
    assert open(out[0]).read() == source.read_text()
    assert sinks.remote_size("u", lambda u: {"Content-Length": "7"}) == 7 and sinks.remote_size("u", lambda u: {}) == 0


def test_cli_fetches_images(spark, tmp_path):
    source = tmp_path / "a.png"
    source.write_bytes(b"1")
    records_file = tmp_path / "images.jsonl"
    records_file.write_text(json.dumps({"url": source.as_uri(), "title": "t", "file_name": "image/b.png", "page": "p", "tag": "x"}) + "\n")
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "b.png").write_bytes(b"2")
    out = cli.main(["download-images", "--image-json", str(records_file), "--image-dir", str(tmp_path / "got"), "--reuse-dir", str(tmp_path / "old"), "--out", str(tmp_path / "o")], spark)
    assert [(r.file_name, r.status) for r in spark.read.parquet(out[0]).collect()] == [("b.png", "copied")]
