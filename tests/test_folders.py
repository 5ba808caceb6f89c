"""Folders of small files: the same as Spark's own writer and readers make, at a cost in tasks that doesn't grow."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from markloom.sources import folders
from markloom.sources.folders import write_folders
from markloom.sources.readers import read_goldens

NAMES = ["a", "b/c", "x y", "50%", "q?'\"#:=*", "[1]{2}^\\", "", None, "tab\t"]


def tasks_of(spark, run):
    """Tasks of all jobs that `run` starts."""
    context = spark.sparkContext
    context.setJobGroup("counted", "counted")
    try:
        run()
        tracker = context.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("counted") for s in tracker.getJobInfo(j).stageIds}
        return sum(info.numTasks for s in stages if (info := tracker.getStageInfo(s)))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def goldens(base, names):
    for i, name in enumerate(names):
        folder = base / name
        folder.mkdir(parents=True)
        (folder / "markdown.md").write_text(f"# {i}\n\nü\n")
        (folder / "props.json").write_text(json.dumps({"pageid": i, "title": name, "categories": ["x"]}, indent=1))


def by_folder(path):
    found = {}
    for file in sorted(path.rglob("*.txt")):
        found.setdefault(str(file.parent.relative_to(path)), []).append(file.read_bytes())
    return found


def as_spark_does(monkeypatch):
    monkeypatch.setattr(folders, "mounted", lambda spark, path: None)


def test_listing_takes_no_task_a_page(spark, tmp_path):
    goldens(tmp_path, [f"p{i}" for i in range(200)])
    found = []
    n = tasks_of(spark, lambda: found.extend(read_goldens(spark, str(tmp_path)).collect()))
    assert {r.page: (r.pageid, r.markdown) for r in found} == {f"p{i}": (i, f"# {i}\n\nü\n") for i in range(200)}
    assert n < 100


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_folders_are_those_of_sparks_writer(spark, tmp_path, monkeypatch, scheme):
    rows = [(n, f"{n} {i}" if i % 5 else None) for i, n in enumerate(NAMES + NAMES[:3])]
    df = spark.createDataFrame(rows, "page string, value string").coalesce(1)
    write_folders(df, f"{scheme}{tmp_path}/own", "page")
    # Hadoop's local file system leaves a checksum beside each file, and starts a process for both.
    assert not list((tmp_path / "own").rglob("*.crc"))
    as_spark_does(monkeypatch)
    write_folders(df, f"{tmp_path}/spark", "page")
    assert by_folder(tmp_path / "own") == by_folder(tmp_path / "spark")


def test_rows_of_a_folder_in_several_tasks_are_files_of_their_own(spark, tmp_path):
    df = spark.range(0, 8, 1, 4).select(F.lit(7).alias("page"), F.col("id").cast("string").alias("value"))
    write_folders(df, str(tmp_path / "out"), "page")
    assert by_folder(tmp_path / "out") == {"page=7": [f"{i}\n{i + 1}\n".encode() for i in (0, 2, 4, 6)]}


def test_a_folder_that_is_there_is_not_written_again(spark, tmp_path):
    df = spark.createDataFrame([("a", "b")], "page string, value string")
    write_folders(df, str(tmp_path / "out"), "page")
    with pytest.raises(FileExistsError):
        write_folders(df, str(tmp_path / "out"), "page")


def test_rows_are_those_of_sparks_readers(spark, tmp_path, monkeypatch):
    goldens(tmp_path, ["plain", "x y", "50%25", "[1] (2)", "_low", ".dot", "a=b", "q?#"])
    props = {
        "list": b'[{"pageid": 1, "title": "a"}, {"pageid": 2}]',
        "no_items": b"[]",
        "two": b'{"pageid": 3}\n{"pageid": 4}\n',
        "broken": b'{"pageid": 5, "title"',
        "broken_list": b'[{"pageid": 5}, {"pageid"',
        "number": b"17",
        "other_type": b'{"pageid": "x", "title": "t", "categories": "c"}',
        "blank": b" \n\t ",
        "empty": b"",
        "utf16": '{"pageid": 6, "title": "ü"}'.encode("utf-16"),
        "utf16le": '{"pageid": 7, "title": "ü"}'.encode("utf-16-le"),
        "bom": b'\xef\xbb\xbf{"pageid": 8}',
        "no_utf8": b'{"pageid": 9, "title": "\xff\xfe"}',
        "nothing": b"{}",
        "spaced": b'\n  [ {"pageid": 10} ]',
    }
    for name, value in props.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "props.json").write_bytes(value)
        (tmp_path / name / "markdown.md").write_bytes(b"\r\nline\x00 " + name.encode())
    (tmp_path / "empty" / "markdown.md").write_bytes(b"")
    (tmp_path / "only_text").mkdir()
    (tmp_path / "only_text" / "markdown.md").write_text("text")
    (tmp_path / "only_text" / "raw.txt").write_text("raw")
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "er" / "markdown.md").write_text("not a page")
    (tmp_path / "markdown.md").write_text("not a page")
    as_rows = lambda: sorted(map(repr, read_goldens(spark, str(tmp_path), more={"raw": "*/raw.txt"}).collect()))
    own = as_rows()
    as_spark_does(monkeypatch)
    assert own == as_rows()


@pytest.mark.parametrize("where", ["*/*.md", "/?//m*.md", "a/markdown.md", "*/[m]arkdown.md", "{a,b}/markdown.md", "a/*.md", "*/markdown*"])
def test_patterns_find_what_sparks_readers_find(spark, tmp_path, monkeypatch, where):
    goldens(tmp_path, ["a", "b", "cc"])
    for name in ("_hidden.md", ".dot.md", "_a=b.md", "m2.md"):
        (tmp_path / "a" / name).write_text(name)
    as_rows = lambda: sorted(map(repr, read_goldens(spark, str(tmp_path), where).collect()))
    own = as_rows()
    as_spark_does(monkeypatch)
    assert own == as_rows()


def test_no_file_at_all_is_an_error(spark, tmp_path):
    goldens(tmp_path, ["a"])
    with pytest.raises(AnalysisException):
        read_goldens(spark, str(tmp_path), "*/markdwn.md").collect()


def test_long_texts_are_read_in_small_batches(spark, tmp_path, monkeypatch):
    goldens(tmp_path, [f"p{i}" for i in range(40)])
    monkeypatch.setattr(folders, "BATCH_BYTES", 20)
    monkeypatch.setattr(folders, "LISTED", 3)
    assert read_goldens(spark, str(tmp_path)).where("pageid is not null and markdown is not null").count() == 40


def test_names_beyond_ascii(spark, tmp_path):
    """Spark's own writer and readers need a locale for these."""
    df = spark.createDataFrame([("é ü", "x")], "page string, value string")
    write_folders(df, str(tmp_path / "out"), "page")
    assert by_folder(tmp_path / "out") == {"page=é ü": [b"x\n"]}
    assert [r.page for r in read_goldens(spark, str(tmp_path / "out"), "*/*.txt", "*/*.txt").collect()] == ["page=é%20ü"]
