"""Commands: ``python -m lexloom run|extract|clean``; exit codes 0, 1 (nothing done or an error) and 130 (interrupted)."""

from __future__ import annotations

import argparse
import logging
import sys

from lexloom.config import DEFAULT
from lexloom.errors import LexloomError


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lexloom", description="Build a clean text corpus.")
    commands = parser.add_subparsers(dest="command", required=True)
    every = argparse.ArgumentParser(add_help=False)
    every.add_argument("-v", "--verbose", action="store_true")
    every.add_argument("-q", "--quiet", action="store_true")
    run = commands.add_parser("run", parents=[every], help="extract, clean and archive a folder of PDF and Parquet files")
    run.add_argument("--input", default=DEFAULT.input_folder)
    run.add_argument("--results", default=DEFAULT.results_folder)
    run.add_argument("--archive", default=DEFAULT.archive_folder)
    run.add_argument("--additional", default=DEFAULT.additional_folder, help="folder of word lists (*.txt)")
    run.add_argument("--dictionaries", help="folder of base forms, a file for each language (ru.txt)")
    extract = commands.add_parser("extract", parents=[every], help="extract the pages of a folder of PDF files")
    extract.add_argument("--input", default=DEFAULT.input_folder)
    extract.add_argument("--output", required=True)
    clean = commands.add_parser("clean", parents=[every], help="clean text files")
    clean.add_argument("--input", required=True)
    clean.add_argument("--output", required=True)
    clean.add_argument("--text", action="store_true", help="read in paragraphs, in as many tasks as the file has splits, and write one text file")
    clean.add_argument("--additional", default=DEFAULT.additional_folder, help="folder of word lists (*.txt)")
    return parser


def main(arguments: list[str] | None = None) -> int:
    args = _parser().parse_args(arguments)
    shown = logging.DEBUG if args.verbose else logging.ERROR if args.quiet else logging.INFO
    logging.basicConfig(level=shown)
    logging.getLogger("lexloom").setLevel(min(shown, logging.INFO))
    for handler in logging.getLogger().handlers:
        handler.setLevel(shown)
    from pyspark.sql import SparkSession

    from lexloom.plans import detection, pipeline, textruns
    from lexloom.sources import files

    spark = SparkSession.builder.appName("lexloom").getOrCreate()
    try:
        if args.command == "run":
            done = pipeline.run(spark, DEFAULT.with_(input_folder=args.input, results_folder=args.results, archive_folder=args.archive, additional_folder=args.additional, dictionary_folder=args.dictionaries), detect=detection.detector())
            logging.info("processed %s files into %s", done["processed"], done["cleaned"])
            return 0 if int(done["processed"]) else 1
        if args.command == "extract":
            files.check_folder(args.input)
            files.append_texts(pipeline.pdf_texts(files.read_pdf_pages(spark, args.input)), args.output)
        elif args.text:
            files.check_file(args.input)
            textruns.clean_file(spark, args.input, args.output, DEFAULT.with_(additional_folder=args.additional), detection.detector())
        else:
            files.check_file(args.input)
            files.overwrite_texts(pipeline.clean_rows(files.read_texts(spark, args.input), DEFAULT.with_(additional_folder=args.additional), detection.detector()), args.output)
        return 0
    except KeyboardInterrupt:
        return 130
    except LexloomError as error:
        logging.error("%s", error)
        return 1


if __name__ == "__main__":
    sys.exit(main())
