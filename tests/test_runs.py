"""File runs: counters, names, crashes, order; text files in splits."""

import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lexloom.config import DEFAULT
from lexloom.operators import dictionary, rules, stats
from lexloom.plans import pipeline, runs
from lexloom.sources import files, footers, storage, textfiles


def config_of(folder, **more):
    return DEFAULT.with_(input_folder=str(folder / "in"), results_folder=str(folder / "out"), archive_folder=str(folder / "old"), additional_folder=str(folder / "lists"), **more)


def table_file(path, **columns):
    pq.write_table(pa.table(columns), path)


ODD_NAMES = ["саха файл.parquet", "a%20b.parquet", "c#d+e&f.parquet", "g[1]{h}.parquet", "q?*.parquet", "tick'\".parquet"]


def test_runs_take_any_file_name(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n, name in enumerate(ODD_NAMES):
        table_file(tmp_path / "in" / name, t=[f"баҕар {'и' * (n + 2)}", "оҕо"])
    (tmp_path / "in" / "b c%41.pdf").write_text("саха тыла үөрэн", encoding="utf-8")
    (tmp_path / "in" / "bad %.parquet").write_bytes(b"PAR1 no such thing")
    (tmp_path / "in" / "none.parquet").touch()
    done = pipeline.run(spark, config_of(tmp_path))
    rows = [r for r in spark.read.parquet(done["manifest"]).collect() if r.processor in ("pdf", "parquet")]
    told = {os.path.basename(r.file): r for r in rows}
    assert len(rows) == len(told) == len(ODD_NAMES) + 3 and done["processed"] == str(len(ODD_NAMES) + 1)
    assert all(told[n].n_units == 2 and not told[n].error for n in ODD_NAMES)
    assert "Validation" in told["none.parquet"].error and told["bad %.parquet"].error and told["bad %.parquet"].n_units == 0
    assert sorted(os.listdir(tmp_path / "old")) == sorted([*ODD_NAMES, "b c%41.pdf"])
    assert sorted(os.listdir(tmp_path / "in")) == ["bad %.parquet", "none.parquet"]
    assert {r.file for r in spark.read.parquet(done["cleaned"]).collect()} == {str(tmp_path / "in" / n) for n in [*ODD_NAMES, "b c%41.pdf"]}


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


def test_many_files_take_few_jobs(spark, tmp_path):
    for n in range(300):
        table_file(tmp_path / f"{n:04}.parquet", **({"t": ["оҕо"], "n": [n]} if n % 2 else {"n": [n], "words": [["a", "b"]]}))
    before = jobs(spark)
    rows = files.read_parquet_rows(spark, [str(tmp_path / f"{n:04}.parquet") for n in range(300)])
    assert rows.where("text is not null").count() == 300
    assert jobs(spark) - before < 20


def test_footers_that_tasks_cannot_reach(spark, tmp_path, monkeypatch):
    table_file(tmp_path / "one two.parquet", t=["a"])
    table_file(tmp_path / "three.parquet", t=["b"])
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 no such thing")
    paths = [f.file for f in storage.Storage(spark).files(str(tmp_path), ".parquet")]
    within = {os.path.basename(f): (kind, error) for f, kind, error in footers.file_kinds(spark, paths)}

    def nothing_reached(batches):
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.array([False] * n)], ["file", "kind", "error", "reached"])

    monkeypatch.setattr(footers, "_in_task", nothing_reached)
    later = {os.path.basename(f): (kind, error) for f, kind, error in footers.file_kinds(spark, paths)}
    for found in (within, later):
        assert found["one two.parquet"] == found["three.parquet"] and found["three.parquet"][0]
        assert found["bad.parquet"][0] is None and found["bad.parquet"][1]


def test_counters_of_a_run_match_the_operators(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "lists").mkdir()
    (tmp_path / "lists" / "a.txt").write_text("дом\n", encoding="utf-8")
    texts = ["баҕар щит а б в ДОМ hello", "дом домалар белый үөрэн к", "xii РФ", "", None]
    table_file(tmp_path / "in" / "one.parquet", t=texts)
    done = pipeline.run(spark, config_of(tmp_path))
    counts = next(r.counts for r in spark.read.parquet(done["manifest"]).collect() if r.processor == "run")
    docs = spark.createDataFrame([(t,) for t in texts if t], "text string")
    healed = docs.withColumn("text", pipeline.healing.heal_text(pipeline.text.remove_special(F.col("text"))))
    removed = {r.reason: r.n for r in stats.removal_counts(healed).collect()}
    assert {k: n for k, n in counts.items() if k not in ("kept", "removed") and n} == {k: n for k, n in removed.items() if n}
    valid = healed.withColumn("text", pipeline.tokens.filter_invalid_words(F.col("text")))
    words = valid.agg(F.sum(F.size(pipeline.tokens.joined_tokens(F.col("text"))))).first()[0]
    kept = sum(len(r.text.split()) for r in spark.read.parquet(done["cleaned"]).collect())
    assert counts["kept"] == kept and counts["removed"] == words - kept > stats.kept_and_removed(valid).first().removed
    log = open(os.path.join(os.path.dirname(done["manifest"]), "logs"), encoding="utf-8").read()
    assert f"removed: {counts['removed']}" in log


@pytest.mark.parametrize("listed", [None, ["дом", "саха"]])
@pytest.mark.parametrize("way", ["rows", "joins"])
def test_counted_cleaning_gives_the_same_texts(spark, monkeypatch, listed, way):
    docs = spark.createDataFrame([(1, "баҕар дом а б в щит саха"), (2, None), (3, ""), (1, "белый оҕо hello дом-дом")], "doc_id long, text string")
    lists = None if listed is None else spark.createDataFrame([(w,) for w in listed], "word string")
    if way == "joins":
        monkeypatch.setattr(rules, "MAX_LISTED", 0)
    detect = (lambda w: False) if way == "joins" and listed is None else None
    config = DEFAULT.with_(word_healer_enabled=False)
    counted = pipeline.clean_counted(docs, lists, config, detect).collect()
    plain = pipeline.clean_with_rules(docs, lists, config, detect).collect()
    assert sorted((r.doc_id, r.text or "") for r in counted) == sorted((r.doc_id, r.text or "") for r in plain)
    assert all(r.counts.kept == len(r.text.split()) and tuple(r.counts.asDict()) == pipeline.COUNTERS for r in counted)
    assert sum(r.counts.spaced_letters for r in counted) == 1 and sum(r.counts.latin for r in counted) == 1


def test_counters_need_no_second_scan(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows, _ = pipeline.observed(pipeline.clean_counted(docs))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("ArrowEvalPython") == 1 and "CollectMetrics" in plan and "Exchange" not in plan


def test_texts_are_written_in_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, pages in (("b.pdf", ["баҕар бир", "баҕар икки", "баҕар\nүс"]), ("a.pdf", ["оҕо түөрт"])):
        (tmp_path / "in" / name).write_text("\f".join(pages), encoding="utf-8")
    table_file(tmp_path / "in" / "t.parquet", t=[f"үөрэн {'ы' * n}" for n in range(1, 40)])
    done = pipeline.run(spark, config_of(tmp_path))
    for name in ("extracted", "cleaned"):
        rows = spark.read.parquet(done[name]).orderBy(F.desc("processor"), "file", "pos").collect()
        with open(done[f"{name}.txt"], encoding="utf-8") as f:
            assert f.read() == "".join(f"{r.text}\n" for r in rows)
        assert [r.file.rpartition("/")[2] for r in rows][:5] == ["a.pdf", "b.pdf", "b.pdf", "b.pdf", "t.parquet"]
    assert not os.path.exists(done["cleaned.txt"] + ".parts")
    bare = tmp_path / "bare"
    (bare / "in").mkdir(parents=True)
    (bare / "in" / "a.pdf").write_text("оҕо", encoding="utf-8")
    assert "cleaned.txt" not in os.listdir(os.path.dirname(pipeline.run(spark, config_of(bare, text_files=False))["cleaned"]))


def test_page_warnings_are_counted_by_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.pdf").write_text("а б в\fбаҕар оҕо\fа б", encoding="utf-8")
    (tmp_path / "in" / "two.pdf").write_text("баҕар оҕо", encoding="utf-8")
    done = pipeline.run(spark, config_of(tmp_path))
    told = {os.path.basename(r.file): r for r in spark.read.parquet(done["manifest"]).where("processor = 'pdf'").collect()}
    assert told["one.pdf"].counts == {stats.FALLBACK_WARNING: 2} and told["one.pdf"].n_units == 3
    assert told["two.pdf"].counts is None and told["two.pdf"].n_units == 1


class Crash(Exception):
    pass


def small_work(spark, config, extractor, detect, inputs, out, visible):
    """A run's work in short: what it writes does not matter here."""
    found = storage.Storage(spark).files(inputs, ".pdf")
    with open(f"{out}/texts", "w", encoding="utf-8") as f:
        f.writelines(f"{open(r.file, encoding='utf-8').read()}\n" for r in found)
    return found


def test_a_crash_between_any_two_steps(spark, tmp_path, monkeypatch):
    """Each text appears once and each file is archived once, wherever the first run dies."""
    monkeypatch.setattr(runs, "_work", small_work)
    changing = ("make_folder", "delete", "rename", "move", "write")
    steps = {}

    def crash_at(step):
        count = iter(range(1, 1000))
        for name in changing:
            whole = getattr(storage.Storage, name) if name not in steps else steps[name]
            steps[name] = whole

            def changed(self, *args, whole=whole):
                if next(count) == step:
                    raise Crash
                return whole(self, *args)

            monkeypatch.setattr(storage.Storage, name, changed)

    for step in range(1, 40):
        folder = tmp_path / str(step)
        (folder / "in").mkdir(parents=True)
        for n in range(3):
            (folder / "in" / f"{n}.pdf").write_text(f"text {n}", encoding="utf-8")
        config, crashed = config_of(folder), False
        crash_at(step)
        try:
            runs.run(spark, config)
        except Crash:
            crashed = True
        crash_at(0)
        if crashed:
            runs.run(spark, config)
        visible = [d for d in os.listdir(folder / "out") if not d.startswith(".")]
        texts = sorted(line for d in visible for line in open(folder / "out" / d / "texts", encoding="utf-8").read().splitlines())
        assert texts == ["text 0", "text 1", "text 2"], step
        assert sorted(os.listdir(folder / "old")) == ["0.pdf", "1.pdf", "2.pdf"] and not os.listdir(folder / "in"), step
        assert all("journal" not in os.listdir(folder / "out" / d) for d in visible)
        assert len(os.listdir(folder / "out")) == len(visible)
        if not crashed:
            break
    assert not crashed and step > 10


def test_archived_names_stay_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "_work", small_work)
    for n in range(3):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / "one.pdf").write_text(f"text {n}", encoding="utf-8")
        runs.run(spark, config_of(tmp_path))
    assert sorted(open(tmp_path / "old" / f, encoding="utf-8").read() for f in os.listdir(tmp_path / "old")) == ["text 0", "text 1", "text 2"]


def test_a_half_done_copy_is_finished(spark, tmp_path):
    """A move to another file system that copied but did not delete; a new file of the same name stays."""
    store = storage.Storage(spark)
    for name, gone in (("same.pdf", True), ("new.pdf", False)):
        folder = tmp_path / name
        folder.mkdir()
        (folder / name).write_text("text")
        (folder / "target").write_text("text")
        status = os.stat(folder / name)
        move = {"file": str(folder / name), "length": status.st_size, "modified": int(status.st_mtime * 1000) if gone else 0, "target": str(folder / "target")}
        (folder / "journal").write_text(json.dumps(move))
        runs.archive_by_journal(store, str(folder))
        assert (folder / name).exists() != gone and (folder / "journal.done").exists()


def test_long_text_files_are_read_in_splits(spark, tmp_path):
    lines = [f"саха {'ы' * (n % 50)} тыла {n}" for n in range(3000)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "long one.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    (tmp_path / "in" / "bad.txt").write_bytes("оҕо\n".encode() + b"\xff\n" + "баҕар\n".encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        pieces = textfiles.read_pieces(spark, str(tmp_path / "in"))
        assert pieces.rdd.getNumPartitions() > 5
        good, failed = textfiles.check_utf8(pieces)
        assert [(os.path.basename(r.file), "UTF-8" in r.error) for r in failed.collect()] == [("bad.txt", True)]
        placed = textfiles.with_offsets(good).orderBy("start").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    raw = (tmp_path / "in" / "long one.txt").read_bytes()
    assert [r.text for r in placed] == lines and len({r.split for r in placed}) > 5
    assert all(raw[r.start :].startswith(f"{r.text}\n".encode()) for r in placed)


def test_paragraphs_clean_like_the_whole(spark, tmp_path):
    parts = ["баҕар щит оҕо-\nлор саха", "о ҕ о л о р үөрэн hello белый", "xii саха тыла\nбаhар", "", "дом көрүү уонна"] * 300
    whole = "\n\n".join(parts)
    (tmp_path / "t.txt").write_text(whole, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        pieces = textfiles.read_pieces(spark, str(tmp_path / "t.txt"), textfiles.PARAGRAPH)
        cleaned = pipeline.clean(pieces).where("text <> ''").orderBy("split", "piece").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    wanted = pipeline.clean(spark.createDataFrame([(whole,)], "text string")).first().text
    assert " ".join(r.text for r in cleaned) == wanted and len({r.split for r in cleaned}) > 3


def test_one_file_of_ordered_texts(spark, tmp_path):
    rows = [(n, None if n % 7 == 0 else f"text {n}" * (n % 5)) for n in range(200)]
    docs = spark.createDataFrame(rows, "n long, text string").repartition(5)
    textfiles.write_text_file(docs, str(tmp_path / "all.txt"), [F.desc("n")], separator="|")
    assert (tmp_path / "all.txt").read_text() == "".join(f"{t}|" for _, t in reversed(rows) if t is not None)
    textfiles.write_text_file(docs.where("false"), str(tmp_path / "none.txt"), ["n"])
    assert (tmp_path / "none.txt").read_text() == ""


def test_dictionaries_decide_what_no_rule_does(spark):
    bases = spark.createDataFrame([("дом", "ru"), ("книга", "ru"), ("ыт", "sah"), ("дом", "xx"), ("стол", "ru"), ("стол", "sah"), (None, "ru"), ("кот", None)], "base string, language string")
    words = spark.createDataFrame([(w,) for w in ("дом", "домость", "КНИГА", "книгатэ", "ыттар", "ыт", "столь", "стол", "столтар", "нет", "кот")], "word string")
    found = {r.word: (r.language, r.layer) for r in dictionary.look_up(words, bases).collect()}
    # equally near in two languages: the one that is not deleted counts
    assert found == {"дом": ("xx", "base"), "домость": ("ru", "form"), "КНИГА": ("ru", "base"), "ыттар": ("sah", "form"), "ыт": ("sah", "base"), "стол": ("sah", "base"), "столтар": ("sah", "form")}
    decided = {r.word: r.rule for r in pipeline.decided_words(words, dictionary=bases).collect()}
    assert decided["КНИГА"] == "dictionary" and decided["ыт"] == "dictionary_other" and decided["нет"] == "undecided" and decided["стол"] == "russian_ending"
    assert dictionary.look_up(words, bases.where("false")).count() == 0


def test_runs_use_dictionaries(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "words").mkdir()
    (tmp_path / "words" / "ru.txt").write_text("# base forms\nкнига\n", encoding="utf-8")
    (tmp_path / "words" / "sah.txt").write_text("кинигэ\n", encoding="utf-8")
    table_file(tmp_path / "in" / "one.parquet", t=["баҕараллар книга кинигэ"])
    done = pipeline.run(spark, config_of(tmp_path, dictionary_folder=str(tmp_path / "words")))
    assert spark.read.parquet(done["cleaned"]).first().text == "баҕараллар кинигэ"
    counts = next(r.counts for r in spark.read.parquet(done["manifest"]).collect() if r.processor == "run")
    assert (counts["kept"], counts["removed"]) == (2, 1)


def test_words_deleted_by_form_are_not_looked_up(spark, monkeypatch):
    """Of the words of all texts only those of the dictionary go to their rows, as positions; order and repeats stay."""
    asked = []
    run = pipeline.R.stem_bitmap
    monkeypatch.setattr(pipeline.R, "stem_bitmap", lambda listed: asked.append(sorted(r.stem for r in listed.collect())) or run(listed))
    rows = [(1, "кот жщц кот баҕар жщц баҕар"), (1, "баҕар баҕар"), (None, "кот"), (2, None), (3, "")]
    found = pipeline.clean_with_rules(spark.createDataFrame(rows, "id long, text string"), dictionary=spark.createDataFrame([("кот", "ru")], "base string, language string"))
    assert sorted((r.id or 0, r.text) for r in found.collect()) == sorted([(1, "баҕар баҕар"), (1, "баҕар баҕар"), (0, ""), (2, ""), (3, "")])
    assert asked[-1] == ["кот"]
