"""Command line: which stages to run, and their filters."""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession

from weftline.functions.vocabulary import CATEGORIES
from weftline.operators import models
from weftline.operators.incremental import with_total
from weftline.operators.translation import Options, load_glossary
from weftline.plans import stages
from weftline.plans.settings import Settings
from weftline.sources.fetch import PoliteClient, over_http
from weftline.sources.files import summary_text
from weftline.sources.register import pdf_lines

STAGES = ("1", "2", "3", "categories", "link", "second", "compare", "translate", "export", "summary")


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="weftline", description="Crawl, link, compare and export records.")
    p.add_argument("--stage", default="all", choices=("all", *STAGES))
    p.add_argument("--district", help="one region's id")
    p.add_argument("--category", type=int, choices=[c[0] for c in CATEGORIES], metavar="N", help="one list's number")
    p.add_argument("--limit", type=int, help="this many pending items")
    p.add_argument("--register", help="the register as a PDF file")
    p.add_argument("--model", action="append", help="a model's checkpoint for --stage translate; of several, or of the default ones, the first that loads")
    p.add_argument("--glossary", help="JSON file with pre and post rules")
    p.add_argument("--device", choices=("cpu", "cuda"))
    p.add_argument("--batch", type=int, help="pieces a batch")
    p.add_argument("--beams", type=int)
    p.add_argument("--checkpoint", type=int, default=50, help="records are rewritten after this many")
    p.add_argument("--output", help="output folder")
    p.add_argument("--refresh", action="store_true", help="read the list of regions again")
    p.add_argument("--verbose", action="store_true")
    args = p.parse_args(argv)
    if args.district is not None and not (args.district.isascii() and args.district.isdigit()):
        p.error("--district must be a number")
    if args.limit is not None and args.limit < 1:
        p.error("--limit must be 1 or more")
    if args.stage == "link" and not args.register:
        p.error("--stage link needs --register")
    return args


def run(args: argparse.Namespace, spark: SparkSession) -> int:
    """0; 1 if anything was rejected; 2 for bad input."""
    settings = Settings()
    store = stages.Store(spark, args.output or settings.output_dir)
    client = PoliteClient(over_http(settings.user_agent, settings.timeout), settings.slots, settings.pause, settings.attempts, settings.backoff)
    todo = ("1", "2", "3", "export") if args.stage == "all" else (args.stage,)
    failed = 0
    try:
        if "1" in todo:
            stages.regions(store, client, settings, args.refresh)
        if "2" in todo:
            failed += stages.index(store, client, settings, args.limit if args.stage == "2" else None)
        if "3" in todo:
            failed += stages.record_stage(store, client, settings, args.district, args.limit)[1]
        if "categories" in todo:
            failed += stages.categories(store, client, settings, args.category, args.limit)[1]
        if "link" in todo:
            lines = spark.createDataFrame(pdf_lines(args.register), "page int, line_no int, line string")
            stages.link(store, lines).show()
        if "second" in todo:
            failed += stages.second(store, client, settings, args.limit)[1]
        if "compare" in todo:
            stages.compare(store).show()
        if "translate" in todo:
            device = args.device or models.pick_device()
            chosen = {k: v for k, v in (("batch_size", args.batch), ("beams", args.beams)) if v}
            options = Options.on(device, glossary=load_glossary(args.glossary), **chosen)
            print(stages.translate(store, models.choose(args.model or models.DEFAULTS, device, options.beams), options, args.district, args.limit, args.checkpoint))
        if "export" in todo:
            stages.export(store)
        if args.stage in ("all", "summary", "1", "2", "3"):
            print(summary_text(with_total(stages.summary(store, args.district), "district_id", ["listed", "scraped"]), ["district_id", "district_name", "listed", "scraped"]))
    except (ValueError, FileNotFoundError) as e:
        logging.error("%s", e)
        return 2
    return int(failed > 0)


def start_log(output: str, verbose: bool = False) -> Path:
    """Messages go to the console, and all of them to a file of the day in the output folder, which later runs of that day go on with."""
    at = Path(output) / "logs" / f"run-{date.today().isoformat()}.log"
    at.parent.mkdir(parents=True, exist_ok=True)
    console, file = logging.StreamHandler(), logging.FileHandler(at, encoding="utf-8")
    console.setLevel(logging.DEBUG if verbose else logging.INFO)
    logging.basicConfig(level=logging.DEBUG, format="%(asctime)s %(levelname)s %(message)s", handlers=[console, file], force=True)
    for noisy in ("py4j", "urllib3"):
        logging.getLogger(noisy).setLevel(logging.WARNING)
    return at


def main(argv: Sequence[str] | None = None) -> int:
    args = parse_args(argv)
    start_log(args.output or Settings().output_dir, args.verbose)
    spark = SparkSession.builder.appName("weftline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        return run(args, spark)
    except KeyboardInterrupt:
        return 130
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
