"""Command line: each task is one composition of the library's functions."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.convert import read_pairs
from quern.operators.records import gated_records, prepare_documents, section_records
from quern.plans import datasets
from quern.runtime import Workspace, prepare
from quern.sources import files, sinks

TASKS = ("pretrain-dataset", "image-dataset", "to-md", "to-pretrain", "extract-images", "download", "download-images", "generate-all")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quern", description="Text and image datasets from a MediaWiki dump.")
    p.add_argument("task", nargs="?", choices=TASKS, default="pretrain-dataset")
    p.add_argument("--lang", choices=datasets.LANGUAGES, default="tw")
    p.add_argument("--xml-path", help="dump, plain or bz2")
    p.add_argument("--md-dir", help="folder of Markdown files")
    p.add_argument("--url", help="dump to download")
    p.add_argument("--image-json", help="image records, a path or a glob")
    p.add_argument("--image-dir", help="folder for fetched images, shared by all executors")
    p.add_argument("--reuse-dir", help="folder of images fetched before")
    p.add_argument("--out", default="output")
    p.add_argument("--max-images", type=int)
    p.add_argument("--max-files", type=int)
    p.add_argument("--min-length", type=int, default=10)
    p.add_argument("--keywords", nargs="*")
    p.add_argument("--no-conversion", action="store_true")
    p.add_argument("--conversion-table", nargs="+", help="files of phrase, tab, what it becomes (the first of several counts); instead of the built-in seed")
    p.add_argument("--parallel-shards", action="store_true", help="each partition fills files of its own, without one order over all")
    p.add_argument("--max-mb", type=int, default=500)
    return p


def _need(args: argparse.Namespace, name: str) -> str:
    value = getattr(args, name)
    if not value:
        raise SystemExit(f"--{name.replace('_', '-')} is needed for {args.task}")
    return value


def _http(url: str, timeout: float) -> tuple[int, bytes]:
    """The transport of the command line: one GET with an honest agent name."""
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, headers={"User-Agent": "quern-dataset-builder"}), timeout=timeout) as answer:
            return answer.status, answer.read()
    except HTTPError as e:
        return e.code, b""


def _download(args: argparse.Namespace) -> list[str]:
    from pathlib import Path
    from urllib.request import Request, urlopen

    url = _need(args, "url")
    target = Path(args.out, url.rsplit("/", 1)[-1])
    target.parent.mkdir(parents=True, exist_ok=True)
    expected = sinks.remote_size(url, lambda u: urlopen(Request(u, method="HEAD"), timeout=30).headers)
    local = target.stat().st_size if target.exists() else None
    if not files.dump_state(local, expected)[1]:
        written, whole = sinks.download_dump(url, str(target), urlopen, expected)
        if not whole:
            print(f"{target}: {written} bytes, {expected} expected")
    return [str(target)]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[str]:
    """Run a task; gives the files or folders written."""
    args = parser().parse_args(argv)
    if args.task == "download":
        return _download(args)
    spark = prepare(spark or SparkSession.builder.appName("quern").getOrCreate())
    lang = None if args.no_conversion else args.lang
    limit = args.max_mb * sinks.MEBIBYTE
    pairs = read_pairs(args.conversion_table) if args.conversion_table else None

    def save_text(docs: DataFrame, **options: object) -> list[str]:
        """Records in the order of documents and sections; what no rule could handle is counted and listed beside them."""
        with Workspace(spark, "cli") as ws:
            ready = ws.save(prepare_documents(docs, lang, pairs), "documents")
            rows = ws.save(section_records(ready).withColumn("row", F.monotonically_increasing_id()), "sections")
            kept = ws.save(gated_records(rows, **options), "records")
            order = ["source_file", "section_no", "row"]  # two documents may share a name; stored rows keep their number
            written = sinks.write_json_arrays(kept, f"{args.out}/{args.lang}", "text", order, limit, ["title", "text", "source_file"], parallel=args.parallel_shards).collect()  # one row a file
            faults = ready.filter("fault is not null").select("source_file", F.lit(None).cast("int").alias("section_no"), "fault").unionAll(rows.filter("fault is not null").select("source_file", "section_no", "fault"))
            if n := faults.count():
                faults.write.mode("overwrite").json(f"{args.out}/{args.lang}_faults")
                print(f"{n} texts were left out; see {args.out}/{args.lang}_faults")
            return [r.file for r in written]

    def save_images(images: object) -> list[str]:
        rows = sinks.write_json_lines(images, f"{args.out}/{args.lang}", "images_", ["file_name"], limit, True, ["url", "title", "file_name", "page", "tag"], parallel=args.parallel_shards)
        return [r.file for r in rows.collect()]

    if args.task == "generate-all":
        return sorted(datasets.generate_all(spark, _need(args, "xml_path"), args.out, pairs={args.lang: pairs} if pairs else None).values())
    if args.task in ("image-dataset", "extract-images"):
        return save_images(datasets.image_dataset(spark, _need(args, "xml_path"), lang, args.max_images, pairs=pairs))
    if args.task == "download-images":
        from quern.operators import fetch

        results = fetch.fetch(files.read_images(spark, _need(args, "image_json")), _need(args, "image_dir"), _http, args.reuse_dir)
        results.write.mode("overwrite").parquet(f"{args.out}/fetched")
        return [f"{args.out}/fetched"]
    if args.task == "to-md":
        path = f"{args.out}/markdown"
        datasets.markdown_of_dump(spark, _need(args, "xml_path")).write.mode("overwrite").parquet(path)
        return [path]
    options = {"min_length": args.min_length, "keywords": args.keywords}
    if args.task == "to-pretrain" or args.md_dir:
        return save_text(files.read_markdown(spark, _need(args, "md_dir"), args.max_files), **options)
    return save_text(datasets.as_documents(datasets.markdown_of_dump(spark, _need(args, "xml_path"))), **options)


if __name__ == "__main__":
    print("\n".join(main()))
