import os
import random
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lexloom.__main__ import main
from lexloom.config import DEFAULT
from lexloom.errors import ConfigurationError, MissingFileError, ValidationError
from lexloom.functions import scalar
from lexloom.operators import flatten, rules, stats
from lexloom.plans import detection, pipeline, sqlfunctions, textruns
from lexloom.sources import files, scratch
from lexloom.streaming import clean_stream as streaming


def test_paths_are_checked(tmp_path):
    (tmp_path / "empty.txt").touch()
    (tmp_path / "full.PDF").write_text("x")
    with pytest.raises(MissingFileError):
        files.check_path(str(tmp_path / "none"))
    with pytest.raises(ValidationError):
        files.check_file(str(tmp_path / "empty.txt"))
    with pytest.raises(ValidationError):
        files.check_file(str(tmp_path))
    with pytest.raises(ValidationError):
        files.check_folder(str(tmp_path / "full.PDF"))
    assert files.check_file(str(tmp_path / "full.PDF"), ".pdf")


def test_word_lists_skip_comments(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# note\n\n саха \nтыл\n")
    (tmp_path / "b.md").write_text("никогда\n")
    assert {r.word for r in rules.read_word_list(spark, str(tmp_path)).collect()} == {"саха", "тыл"}
    assert rules.read_exceptions(spark, str(tmp_path / "a.txt"))[-2:] == ("саха", "тыл")


def test_too_many_exceptions_are_an_error(spark, tmp_path):
    (tmp_path / "many.txt").write_text("\n".join(f"w{n}" for n in range(100_001)))
    with pytest.raises(ValidationError):
        rules.read_exceptions(spark, str(tmp_path / "many.txt"))
    (tmp_path / "most.txt").write_text("\n".join(f"w{n}" for n in range(100_000)))
    assert rules.read_exceptions(spark, str(tmp_path / "most.txt"))[-1] == "w99999"


def test_rows_become_texts(spark):
    df = spark.createDataFrame([(1, " a ", ["x", None, " "], 5, None), (2, None, None, 6, True), (3, "b", [], 7, False)], "k int, s string, l array<string>, n int, f boolean")
    assert [tuple(r) for r in flatten.row_text(df, keep=("k",)).orderBy("k").collect()] == [(1, "a x"), (3, "b")]
    assert [r.text for r in flatten.row_text(df, keep=("k",), parity=True).orderBy("k").collect()] == ["a x", "True", "b False"]
    assert flatten.row_text(df.select("k", "n"), keep=("k",)).count() == 0
    nulls = df.select(*(flatten.is_null_cell(f.name, f.dataType).alias(f.name) for f in df.schema.fields)).collect()
    assert [r.l for r in nulls] == [False, True, True]


def test_text_files_must_be_utf8(spark, tmp_path):
    (tmp_path / "good.txt").write_text("саха", encoding="utf-8")
    assert files.read_texts(spark, str(tmp_path / "good.txt")).first().text == "саха"
    (tmp_path / "bad.txt").write_bytes(b"\xff\xfe\xfa")
    with pytest.raises(Exception, match="UTF-8"):
        files.read_texts(spark, str(tmp_path / "bad.txt")).collect()


def test_best_attempt(spark):
    rows = [(1, 0, "а б в г"), (1, 1, "аб вг"), (1, 2, "абвг"), (2, 0, "а б"), (2, 1, ""), (3, 0, "а б вг"), (3, 1, "а бв г"), (4, 0, "а бв"), (4, 1, "а б в гд")]
    best = stats.best_attempt(spark.createDataFrame(rows, "page int, level int, text string")).cache()
    assert {r.page: r.level for r in best.collect()} == {1: 1, 2: 1, 3: 0, 4: 0}
    listed = spark.createDataFrame(rows, "page int, level int, text string").groupBy("page").agg(F.collect_list(F.struct("level", "text")).alias("attempts"))
    in_row = listed.select("page", F.inline(F.array(stats.best_in_row(F.col("attempts")))))
    assert sorted(map(tuple, in_row.collect())) == sorted(map(tuple, best.select("page", "level", "text", "warning").collect()))
    warned = stats.warning_counts(best.where("warning is not null").select(F.col("warning").alias("message"))).collect()
    assert [tuple(r) for r in warned] == [(stats.FALLBACK_WARNING, 1)]


def test_run_extracts_cleans_and_archives(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.pdf").write_bytes("оҕо-\nлор баҕар щит\fсаха тыла үөрэн".encode())
    (source / "bad.pdf").write_bytes(b"\xff\xff")
    spark.createDataFrame([("үчүгэй күн", 1)], "t string, n int").coalesce(1).write.parquet(str(tmp_path / "table"))
    part = next(p for p in (tmp_path / "table").iterdir() if p.suffix == ".parquet")
    part.rename(source / "two.parquet")
    done = pipeline.run(spark, DEFAULT.with_(input_folder=str(source), results_folder=str(tmp_path / "out"), archive_folder=str(tmp_path / "old")))
    cleaned = " ".join(sorted(r.text for r in spark.read.parquet(done["cleaned"]).collect()))
    assert "оҕолор" in cleaned and "щит" not in cleaned and "үчүгэй күн" in cleaned
    manifest = {os.path.basename(r.file): r for r in spark.read.parquet(done["manifest"]).where("processor <> 'clean'").collect()}
    log = open(os.path.join(os.path.dirname(done["manifest"]), "logs"), encoding="utf-8").read()
    assert "ERROR" in log and "bad.pdf" in log and "one.pdf" in log and "clean" in {r.processor for r in spark.read.parquet(done["manifest"]).collect()}
    assert manifest["bad.pdf"].error and manifest["one.pdf"].n_units == 2 and manifest["two.parquet"].n_chars == 10
    assert sorted(os.listdir(tmp_path / "old")) == ["one.pdf", "two.parquet"] and os.listdir(source) == ["bad.pdf"]


def test_file_runs_apply_word_lists(spark, tmp_path):
    source, lists = tmp_path / "in", tmp_path / "lists"
    source.mkdir()
    lists.mkdir()
    (lists / "a.txt").write_text("# note\nсаха\n", encoding="utf-8")
    (lists / "b.txt").write_text("дом\n", encoding="utf-8")
    (source / "one.pdf").write_text("баҕар дом саха сахалар\fбаҕар дом саха сахалар\fсахалар", encoding="utf-8")
    done = pipeline.run(spark, DEFAULT.with_(input_folder=str(source), results_folder=str(tmp_path / "out"), archive_folder=str(tmp_path / "old"), additional_folder=str(lists)))
    cleaned = spark.read.parquet(done["cleaned"])
    assert cleaned.columns == spark.read.parquet(done["extracted"]).columns
    assert sorted(r.text for r in cleaned.collect()) == ["баҕар", "баҕар"]
    (tmp_path / "t.txt").write_text("баҕар дом саха сахалар", encoding="utf-8")
    for folder, wanted in ((lists, "баҕар"), (tmp_path / "nowhere", "баҕар дом саха сахалар")):
        assert main(["clean", "--input", str(tmp_path / "t.txt"), "--output", str(tmp_path / "o"), "--additional", str(folder)]) == 0
        assert [(os.path.basename(r.file), r.text) for r in spark.read.parquet(str(tmp_path / "o")).collect()] == [("t.txt", wanted)]


def parquet_file(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"{name}.parts"))
    part = next(p for p in (folder / f"{name}.parts").iterdir() if p.suffix == ".parquet")
    part.rename(folder / f"{name}.parquet")


def test_parquet_files_are_read_by_their_own_schema(spark, tmp_path):
    parquet_file(spark, tmp_path, "one", [("a", 1), (None, 2)], "t string, n int")
    parquet_file(spark, tmp_path, "two", [(5, ["b", "c"])], "n int, words array<string>")
    parquet_file(spark, tmp_path, "three", [(5,)], "n int")
    parquet_file(spark, tmp_path, "four", [("d", 3)], "t string, n int")
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 no such thing")
    (tmp_path / "empty.parquet").touch()
    paths = sorted(str(p) for p in tmp_path.glob("*.parquet"))
    rows = files.read_parquet_rows(spark, paths)
    texts = [(os.path.basename(r.file), r.text) for r in rows.where("text is not null").collect()]
    assert sorted(texts) == [("four.parquet", "d"), ("one.parquet", "a"), ("two.parquet", "b c")]
    told = {os.path.basename(r.file): r for r in files.manifest("parquet", rows).collect()}
    assert len(told) == 6 and told["three.parquet"].n_units == 0 and told["bad.parquet"].error and told["empty.parquet"].error and not told["one.parquet"].error
    assert files.read_parquet_texts(spark, str(tmp_path)).count() == 3


def test_extractors_get_tolerances(spark, tmp_path):
    (tmp_path / "one.pdf").write_bytes(b"x")

    def extract(content, levels, layout):
        return [(1, level, f"{'а б ' * (3 - level)}page {x} {y} {layout}") for level, x, y in levels]

    def best(config):
        return pipeline.pdf_texts(files.read_pdf_pages(spark, str(tmp_path), extract, config=config), config).first().text

    assert best(DEFAULT.with_(pdf_x_tolerance=7)) == "а б page 5 5 True"
    assert best(DEFAULT.with_(pdf_adaptive_tolerance=False, pdf_x_tolerance=7, pdf_layout_mode=False)) == "а б а б page 7 3 False"


def test_missing_word_lists_are_no_words(spark, tmp_path):
    assert rules.read_word_list(spark, str(tmp_path / "none")).count() == 0


def test_rows_with_equal_or_no_ids_are_cleaned_apart(spark):
    docs = spark.createDataFrame([(1, "баҕар саха оҕо", "x"), (1, "үөрэн күн", "y"), (None, "баҕар оҕо", None), (2, None, "z")], "doc_id long, text string, source string")
    listed = spark.createDataFrame([("саха",)], "word string")
    wanted = [(1, "баҕар оҕо", "x"), (1, "үөрэн күн", "y"), (None, "баҕар оҕо", None), (2, "", "z")]
    for detect in (None, lambda w: False):
        got = pipeline.clean_with_rules(docs, listed, detect=detect)
        assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=repr) == sorted(wanted, key=repr)


def test_lists_within_rows_match_the_joins(spark, monkeypatch):
    """Both ways of applying word lists give the same texts."""
    rng = random.Random(12)
    docs = spark.createDataFrame([(n, " ".join("".join(rng.choices("сахлртэываөуо", k=rng.randint(1, 9))) for _ in range(60))) for n in range(40)], "doc_id long, text string")
    listed = spark.createDataFrame([(w,) for w in ("саха", "Тылэ", "рст", "лхлар", None)], "word string")
    within = {r.doc_id: r.text for r in pipeline.clean_with_rules(docs, listed).collect()}
    monkeypatch.setattr(rules, "MAX_LISTED", 2)
    joined = {r.doc_id: r.text for r in pipeline.clean_with_rules(docs, listed).collect()}
    assert within == joined != {r.doc_id: r.text for r in pipeline.clean(docs).collect()}


def test_run_folder_name():
    assert files.run_folder("r", datetime(2025, 1, 19, 19, 28, 32)) == "r/19-01-25-19-28-32"


def test_commands(spark, tmp_path):
    (tmp_path / "t.txt").write_text("баҕар щит", encoding="utf-8")
    assert main(["clean", "--input", str(tmp_path / "t.txt"), "--output", str(tmp_path / "o")]) == 0
    assert spark.read.parquet(str(tmp_path / "o")).first().text == "баҕар"
    assert main(["clean", "--input", str(tmp_path / "none.txt"), "--output", str(tmp_path / "p")]) == 1


def test_sql_functions(spark):
    names = sqlfunctions.register(spark)
    assert "lexloom_heal_text" in names
    got = spark.sql("SELECT lexloom_remove_special('a1-b'), lexloom_has_anchor('баҕар'), lexloom_heal_text('о ҕ о'), lexloom_merge_line_hyphens('so-\\nme'), lexloom_dot_tokens('a b.'), lexloom_length_valid('аа')").first()
    assert list(got) == ["a-b", True, "оҕо", "some", ["a", "b."], True]


def test_sql_cascade(spark):
    sqlfunctions.register(spark)
    words = ["ҕщ", "уощ", "щлар", "тлар", "белый", "дом", "  "]
    got = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("lexloom_deciding_rule(w)", "lexloom_is_russian(w)", "lexloom_badness(concat(w, ' a b'))").collect()
    assert [r[0] for r in got] == ["anchor", "diphthong", "marker", "sakha_ending", "russian_ending", "undecided", "empty"]
    assert [r[1] for r in got] == [False, False, True, False, True, False, False] and got[0][2] == 2 / 3
    listed = ["саха", "тылэ", "рст"]
    rng = random.Random(13)
    words = sorted({"".join(rng.choices("сахлртэы", k=rng.randint(1, 8))) for _ in range(300)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    wanted = {r.word for r in rules.match_rules(df, spark.createDataFrame([(w,) for w in listed], "word string")).collect()}
    assert {r.word for r in df.where(f"lexloom_matches_rules(word, array('{"', '".join(listed)}'))").collect()} == wanted


def test_clusters_need_a_shared_folder():
    def session(master, folder=None, set_later=None):
        context = SimpleNamespace(master=master, applicationId=f"{master}-{folder}", getCheckpointDir=lambda: set_later)
        return SimpleNamespace(conf={"spark.checkpoint.dir": folder} if folder else {}, sparkContext=context)

    with pytest.raises(ConfigurationError):
        scratch.shared_folder(session("spark://host:7077"))
    with pytest.raises(ConfigurationError):
        scratch.shared_folder(session("local-cluster[3,2,1024]"))
    assert scratch.shared_folder(session("yarn", "hdfs://shared/")) == "hdfs://shared"
    assert scratch.shared_folder(session("yarn", None, "hdfs://later")) == "hdfs://later"
    assert os.path.isdir(scratch.shared_folder(session("local[2]")))


def test_settings_reach_their_users(spark, tmp_path):
    (tmp_path / "exceptions.txt").write_text("ул.\n", encoding="utf-8")
    patterns = pipeline.exception_patterns(spark, DEFAULT.with_(word_healer_exceptions_file=str(tmp_path / "exceptions.txt")))
    found = spark.createDataFrame([("УЛ. Ленина",), ("саха",), ("стр. 5",)], "t string").select(scalar.matches_exception(F.col("t"), patterns)).collect()
    assert [r[0] for r in found] == [True, False, True]
    docs = spark.createDataFrame([("щит баҕар белый щит",)], "text string")
    assert stats.removed_words(docs, 2) == ["щит", "белый"]


def test_detection_asks_in_order():
    asked = []

    def step(name, answers):
        def ask(word):
            asked.append(name)
            return answers.get(word)

        return ask

    delete = detection.chain(step("language", {"дом": True, "саха": False}), step("names", {"Иван": True}))
    assert [delete(w) for w in ("дом", "саха", "Иван", "тыл")] == [True, False, True, False]
    assert asked == ["language", "language", "language", "names", "language", "names"]


def test_word_lists_and_detectors_remove_words(spark):
    docs = spark.createDataFrame([(1, "баҕар дом саха сахалар"), (2, ""), (3, None)], "doc_id long, text string")
    listed = spark.createDataFrame([("саха",)], "word string")
    got = {r.doc_id: r.text for r in pipeline.clean_with_rules(docs, listed, detect=lambda w: w == "дом").collect()}
    assert got == {1: "баҕар", 2: "", 3: ""}
    assert {r.doc_id: r.text for r in pipeline.clean_with_rules(docs).collect()}[1] == "баҕар дом саха сахалар"


def test_stream_cleans_once_and_archives(spark, tmp_path):
    def arrive(n, text):
        spark.createDataFrame([(n, text)], "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def go():
        docs = streaming.read_stream(spark, str(tmp_path / "in"))
        streaming.clean_stream(docs, str(tmp_path / "out"), str(tmp_path / "check"), manifest=str(tmp_path / "manifest")).awaitTermination()
        return sorted((r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "out")).select("doc_id", "text").collect())

    arrive(1, "баҕар щит")
    assert go() == [(1, "баҕар")]
    arrive(2, "о ҕ о")
    assert go() == [(1, "баҕар"), (2, "оҕо")]
    assert go() == [(1, "баҕар"), (2, "оҕо")]
    assert spark.read.parquet(str(tmp_path / "manifest")).agg(F.sum("n_rows")).first()[0] == 2


def test_streams_take_up_word_lists_between_batches(spark, tmp_path):
    config = DEFAULT.with_(additional_folder=str(tmp_path / "lists"), word_healer_enabled=False)

    def arrive_and_go(n):
        spark.createDataFrame([(n, "баҕар дом саха щит")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        streaming.clean_stream(streaming.read_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"), config, str(tmp_path / "manifest")).awaitTermination()
        return {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    assert arrive_and_go(1) == {1: "баҕар дом саха"}
    (tmp_path / "lists").mkdir()
    (tmp_path / "lists" / "a.txt").write_text("дом\n", encoding="utf-8")
    assert arrive_and_go(2) == {1: "баҕар дом саха", 2: "баҕар саха"}
    (tmp_path / "lists" / "b.txt").write_text("саха\n", encoding="utf-8")
    assert arrive_and_go(3) == {1: "баҕар дом саха", 2: "баҕар саха", 3: "баҕар"}
    told = {r.batch: r.counts for r in spark.read.parquet(str(tmp_path / "manifest")).collect()}
    assert [told[n]["removed"] for n in sorted(told)] == [1, 2, 3]


def test_text_files_that_arrive_twice_count_once(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def arrive(name, text):
        (tmp_path / "in" / name).write_bytes(text.encode() if isinstance(text, str) else text)

    def go(crash=False):
        stream = streaming.first_arrivals(streaming.read_text_stream(spark, str(tmp_path / "in"), files_a_batch=1))
        if crash:
            stream = stream.withColumn("text", F.when(F.col("text").contains("күн"), F.raise_error(F.lit("crash"))).otherwise(F.col("text")))
        query = streaming.clean_stream(stream, str(tmp_path / "out"), str(tmp_path / "check"), manifest=str(tmp_path / "manifest"))
        if crash:
            with pytest.raises(Exception, match="crash"):
                query.awaitTermination()
        else:
            query.awaitTermination()
            return sorted((r.text or "", r.error is None) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    arrive("a b.txt", "баҕар щит")
    arrive("b.txt", "баҕар щит")
    arrive("bad.txt", b"\xff")
    assert go() == [("", False), ("баҕар", True)]
    arrive("c.txt", "баҕар щит")  # known from an earlier start
    arrive("d.txt", "үөрэн күн")
    os.utime(tmp_path / "in" / "d.txt", (1, 1))  # however old, it is not late
    go(crash=True)
    assert go() == [("", False), ("баҕар", True), ("үөрэн күн", True)]


def test_text_commands(spark, tmp_path):
    (tmp_path / "t 1.txt").write_text("баҕар щит\n\nо ҕ о л о р\n\n\nхата", encoding="utf-8")
    (tmp_path / "bad.txt").write_bytes("оҕо\n\n".encode() + b"\xff")
    assert main(["clean", "--text", "--input", str(tmp_path / "t 1.txt"), "--output", str(tmp_path / "o.txt")]) == 0
    assert (tmp_path / "o.txt").read_text(encoding="utf-8") == "баҕар оҕолор хата "
    assert main(["clean", "--text", "--input", str(tmp_path / "bad.txt"), "--output", str(tmp_path / "p.txt")]) == 1
    cleaned, failed = textruns.clean_files(spark, [str(tmp_path / "t 1.txt"), str(tmp_path / "bad.txt")])
    assert {os.path.basename(r.file) for r in cleaned.collect()} == {"t 1.txt"} and [os.path.basename(r.file) for r in failed.collect()] == ["bad.txt"]


def test_few_keys_are_joined_with_word_lists(spark):
    """Rows before the join stay within twice the words, and no key that has a partner is lost."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("сахлртэываөуоАЫ", k=rng.randint(1, 14))) for _ in range(4000)})
    listed = [(w,) for w in rng.sample(words, 300)] + [(None,), ("Ы",), ("тыалар",)]
    words.append("тыалэр")
    df, lists = spark.createDataFrame([(w,) for w in [*words, None]], "word string"), spark.createDataFrame(listed, "word string")
    stems = rules.rule_tables(lists)[1]
    assert rules.possible_keys(df, rules.stem_bitmap(stems), (rules.PREFIX,)).count() < 2 * len(words)
    known = rules.ListedWords([w for (w,) in listed if w])
    got = {r.word: r.way for r in rules.match_rules(df, lists).collect()}
    assert set(got) == {w for w in words if w in known}
    assert all((way == "exact") == (w.lower() in known.words) for w, way in got.items()) and set(got.values()) == set(rules.WAYS)
    plan = rules.match_rules(df, lists)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_best_in_row_scores_an_attempt_once(spark):
    attempts = spark.createDataFrame([(1, [(0, "a b c"), (1, "whole words")]), (2, [(0, ""), (1, " ")]), (3, [(0, None), (1, "x")])], "page int, attempts array<struct<level:int,text:string>>")
    chosen = attempts.select("page", F.inline(F.array(stats.best_in_row(F.col("attempts")))))
    assert {r.page: (r.level, r.text, r.warning is not None) for r in chosen.collect()} == {1: (1, "whole words", False), 2: (1, " ", False), 3: (1, "x", True)}
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"(?<!\S)\S(?!\S)") == 1 and plan.count(r"\S++") == 1
