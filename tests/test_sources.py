import json

import pyarrow.parquet as pq

from markloom.operators.catalog import lookup_title
from markloom.sources.readers import flatten_query_response, read_goldens, read_raw
from markloom.sources.writers import export_article, write_for_lookup, write_raw
from markloom.streaming.convert import convert_stream, read_converted, read_outcomes, retry_failed

RAW = "pageid long, title string, lang string, revid long, articletype string, wikitext string"


def rows(spark, ids, text="page {{val|1}} [[a]]"):
    return spark.createDataFrame([(i, f"T{i}", "en", i, "g", f"{text} {i}") for i in ids], RAW)


def test_goldens(spark, tmp_path):
    for i, name in enumerate(["a_b", "c"]):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "markdown.md").write_text(f"# {name}\n\ntext ü\n")
        props = {"pageid": i, "title": name, "lang": "en", "revid": 5, "categories": ["x"],
                 "description": None, "unsupported_tags": {}, "unsupported_templates": {"t": 2}}
        (folder / "props.json").write_text(json.dumps(props, indent=2))
    got = {r.page: r for r in read_goldens(spark, str(tmp_path)).collect()}
    assert got["a_b"].markdown == "# a_b\n\ntext ü\n"
    assert got["c"].unsupported_templates == {"t": 2} and got["c"].description is None


def test_first_page_and_revision_of_a_response(spark):
    body = {"query": {"pages": {"9": {"pageid": 9, "revisions": [
        {"revid": 7, "slots": {"main": {"*": "new"}}}, {"revid": 6, "slots": {"main": {"*": "old"}}}]}}}}
    df = spark.createDataFrame([("t", json.dumps(body)), ("u", "{}")], "title string, response string")
    got = {r.title: (r.pageid, r.revid, r.wikitext) for r in flatten_query_response(df).collect()}
    assert got == {"t": (9, 7, "new"), "u": (None, None, None)}


def test_raw_tables_are_pruned_and_filtered_in_the_scan(spark, tmp_path):
    path = write_raw(rows(spark, range(10)), str(tmp_path / "raw"))
    plan = read_raw(spark, path).where("title = 'T3'").select("pageid")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<pageid:bigint,title:string>" in text
    assert "EqualTo(title,T3)" in text
    assert plan.first().pageid == 3


def test_export(spark, tmp_path):
    path = str(tmp_path / "out")
    export_article(rows(spark, [4], "a\nb"), path)
    got = spark.read.text(path, wholetext=True).first()
    assert (got.slug, got.value) == ("t4", "a\nb 4\n")


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    table = spark.createDataFrame([("{{val|1}}", "1")], "invocation string, expansion string")
    for ids in (range(3), range(3, 5)):
        write_raw(rows(spark, ids), source)
        convert_stream(spark, source, target, state, table).awaitTermination()
    assert pages_of(spark, target) == {i: f"page 1 a {i}" for i in range(5)}


def pages_of(spark, target):
    made = read_converted(spark, target).collect()
    assert len({r.pageid for r in made}) == len(made)
    return {r.pageid: r.markdown for r in made}


def test_a_repeated_batch_leaves_each_page_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    write_raw(rows(spark, range(3)), source)
    convert_stream(spark, source, target, state).awaitTermination()
    # The stream stopped before it noted that the batch was done.
    for name in ("0", ".0.crc"):
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    convert_stream(spark, source, target, state).awaitTermination()
    assert set(pages_of(spark, target)) == {0, 1, 2}


def test_failed_pages_are_retried_and_corrupt_ones_not(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "pageid long, title string, lang string, revid long, articletype string, wikitext string"
    pages = [(i, f"T{i}", "en", i, "g", t) for i, t in enumerate(["fine", "<sub>open", "{{}} x", None])]
    write_raw(spark.createDataFrame(pages, schema), source)
    convert_stream(spark, source, target, state, outcomes=True).awaitTermination()
    assert retry_failed(spark, source, target) == 2
    convert_stream(spark, source, target, state, outcomes=True).awaitTermination()
    found = read_outcomes(spark, target).select("pageid", "status").collect()
    assert sorted(map(tuple, found)) == [(0, "ok"), (1, "corrupt"), (2, "failed"), (3, "failed")]


def test_a_lookup_reads_one_row_group(spark, tmp_path):
    path = str(tmp_path / "lookup")
    write_for_lookup(rows(spark, range(2000)), path)
    files = sorted((tmp_path / "lookup").glob("*.parquet"))
    ends = []
    for f in files:
        for g in range(pq.ParquetFile(f).metadata.num_row_groups):
            titles = pq.ParquetFile(f).read_row_group(g, ["title"]).column(0).to_pylist()
            ends.append((min(titles), max(titles)))
    assert sum(lo <= "T77" <= hi for lo, hi in ends) == 1
    assert lookup_title(read_raw(spark, path), "T77").first().pageid == 77
