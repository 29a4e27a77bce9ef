"""File runs that can be repeated after a crash.

A run writes into a hidden folder of the results folder, with a journal of the inputs to archive as its last file, and
makes the folder visible by one rename. Only then are the inputs moved, and the journal is marked as done. So before the
rename nothing has happened, and the next run deletes the hidden folder and does the work again; after it the next run
first does the moves that are left, before it looks for inputs. Either way each text appears once and each file is
archived once. One run at a time works on a results folder.

A visible folder holds the tables ``extracted``, ``cleaned`` and ``manifest``, the texts in order as ``extracted.txt`` and
``cleaned.txt`` (a line end behind each page or row), and ``logs``.
"""

from __future__ import annotations

import io
import json
import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.config import DEFAULT, Config
from lexloom.operators.dictionary import read_dictionaries
from lexloom.operators.stats import removed_words
from lexloom.plans import pipeline
from lexloom.sources import files
from lexloom.sources.scratch import materialize
from lexloom.sources.storage import Storage, StoredFile
from lexloom.sources.textfiles import write_text_file

LOG = logging.getLogger("lexloom")
LOG.setLevel(logging.INFO)  # for a run's own log; what else is shown is up to the handlers

HIDDEN = ".run-"


def journal_of(storage: Storage, done: list[StoredFile], archive: str, stamp: str) -> str:
    """A line for each file: what it was, and a name in the archive that nothing else has."""
    taken, lines = set(storage.names(archive)), []
    for row in done:
        name = os.path.basename(row.file)
        stem, suffix = os.path.splitext(name)
        tries = iter(range(1, len(taken) + 2))
        while name in taken:
            name = f"{stem}-{stamp}-{next(tries)}{suffix}"
        taken.add(name)
        lines.append(json.dumps({"file": row.file, "length": row.length, "modified": row.modified, "target": f"{archive}/{name}"}, ensure_ascii=False))
    return "\n".join(lines)


def archive_by_journal(storage: Storage, folder: str) -> None:
    """Do the moves of a visible folder's journal that are left, and mark it as done."""
    for line in storage.read(f"{folder}/journal").splitlines():
        move = json.loads(line)
        if not storage.exists(move["target"]):
            storage.move(move["file"], move["target"])
        elif storage.same(move["file"], move["length"], move["modified"]):  # copied to another file system, but not deleted yet
            storage.delete(move["file"])
    storage.rename(f"{folder}/journal", f"{folder}/journal.done")


def recover(storage: Storage, results: str) -> None:
    """Undo or finish what crashed runs left."""
    for name in storage.names(results):
        if name.startswith(HIDDEN):
            storage.delete(f"{results}/{name}")
        elif storage.exists(f"{results}/{name}/journal"):
            archive_by_journal(storage, f"{results}/{name}")


def run(spark: SparkSession, config: Config = DEFAULT, extractor: files.PdfExtractor = files.extract_pages, detect=None) -> dict[str, str]:
    """Extract every PDF and Parquet file of the input folder, clean (with word lists), write, and archive; the run's paths.

    A file that cannot be read gets a manifest row with its error, stays in the input folder, and does not end the run.
    """
    config.validate()
    storage = Storage(spark)
    inputs, archive, results, lists = (storage.full_name(f) for f in (config.input_folder, config.archive_folder, config.results_folder, config.additional_folder))
    for folder in (inputs, archive, results, lists):
        storage.make_folder(folder)
    storage.check_folder(inputs)
    recover(storage, results)
    stamp = os.path.basename(files.run_folder(results))
    while storage.exists(f"{results}/{stamp}"):
        stamp += "-again"
    hidden, visible = f"{results}/{HIDDEN}{stamp}", f"{results}/{stamp}"
    storage.make_folder(hidden)
    said = io.StringIO()
    log = logging.StreamHandler(said)
    log.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    LOG.addHandler(log)
    try:
        done = _work(spark, config, extractor, detect, inputs, hidden, visible)
    finally:
        LOG.removeHandler(log)
    storage.write(f"{hidden}/logs", said.getvalue())
    storage.write(f"{hidden}/journal", journal_of(storage, done, archive, stamp))
    storage.rename(hidden, visible)
    archive_by_journal(storage, visible)
    names = ("extracted", "cleaned", "manifest") + (("extracted.txt", "cleaned.txt") if config.text_files else ())
    return {name: f"{visible}/{name}" for name in names} | {"processed": str(len(done))}


def _work(spark: SparkSession, config: Config, extractor: files.PdfExtractor, detect, inputs: str, out: str, visible: str) -> list[StoredFile]:
    """Write a run's tables and texts, which will be visible under another name; the files that were processed."""
    storage, done = Storage(spark), []

    def told(units: DataFrame, processor: str) -> None:
        files.manifest(processor, units).write.mode("append").parquet(f"{out}/manifest")

    def extracted(texts: DataFrame, processor: str) -> None:
        texts.where("text <> ''").select(F.lit(processor).alias("processor"), "file", F.col("pos").cast("long").alias("pos"), "text").write.mode("append").parquet(f"{out}/extracted")

    def processed(given: list, units: DataFrame) -> None:
        failed = {r.file for r in units.where("error is not null").select("file").distinct().collect()}
        done.extend(f for f in given if f.file not in failed)

    if pdfs := storage.files(inputs, ".pdf"):
        # written, as texts, manifest and failures all read it, and extraction is the slow part
        pages = materialize(files.read_pdf_pages(spark, [f.file for f in pdfs], extractor, config=config), "pdf-pages")
        texts = materialize(pipeline.pdf_texts(pages, config), "pdf-texts")
        extracted(texts.withColumnRenamed("page", "pos"), "pdf")
        failed = pages.where("error is not null").select("file", F.lit(None).cast("string").alias("text"), "error", F.lit(None).cast("string").alias("warning"))
        told(texts.select("file", "text", F.lit(None).cast("string").alias("error"), "warning").unionByName(failed), "pdf")
        processed(pdfs, pages)
    if tables := storage.files(inputs, ".parquet"):
        rows = materialize(files.read_parquet_rows(spark, [f.file for f in tables]), "parquet-rows")
        extracted(rows.where("text is not null"), "parquet")
        told(rows, "parquet")
        processed(tables, rows)
    if done:
        _clean(spark, config, detect, out, visible)
    for row in spark.read.parquet(f"{out}/manifest").collect() if pdfs or tables else ():  # a row per file
        counts = "".join(f", {name}: {n}" for name, n in sorted((row.counts or {}).items()))
        LOG.log(logging.ERROR if row.error else logging.INFO, "%s %s: %s", row.processor, row.file, row.error or f"{row.n_chars} characters, {row.n_bytes} bytes, {row.n_units} pages or rows{counts}")
    return done


def _clean(spark: SparkSession, config: Config, detect, out: str, visible: str) -> None:
    rows = spark.read.parquet(f"{out}/extracted")
    counted = pipeline.clean_counted(rows, pipeline.word_lists(spark, config), config, detect, dictionary=read_dictionaries(spark, config))
    cleaned, seen = pipeline.observed(counted)
    cleaned.where("text <> ''").write.parquet(f"{out}/cleaned")
    written = spark.read.parquet(f"{out}/cleaned")
    manifest = files.manifest("clean", written.withColumn("error", F.lit(None).cast("string")))
    totals = manifest.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_chars", "n_bytes", "n_units")))
    counts = F.create_map(*(F.lit(x) for item in seen.get.items() for x in item))
    totals = totals.select(F.lit("run").alias("processor"), F.lit(visible).alias("file"), F.current_timestamp().alias("ts"), "n_chars", "n_bytes", F.col("n_units").cast("int").alias("n_units"), F.lit(None).cast("string").alias("error"), counts.alias("counts"))
    manifest.unionByName(totals).write.mode("append").parquet(f"{out}/manifest")
    if config.debug_sample_size and LOG.isEnabledFor(logging.DEBUG):
        LOG.debug("deleted words, for example: %s", " ".join(removed_words(rows, config.debug_sample_size)))
    if config.text_files:
        for name, texts in (("extracted", rows), ("cleaned", written)):
            write_text_file(texts, f"{out}/{name}.txt", [F.col("processor").desc(), "file", "pos"])  # PDF files first
