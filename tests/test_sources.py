import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tamarack.operators import index as ix
from tamarack.sources import readers, sinks
from tamarack.streaming import incremental as inc

SGML = b"""<!DOCTYPE news>
<REUTERS TOPICS="NO" OLDID="5" NEWID="21">
<DATE>26-FEB</DATE><UNKNOWN>&#5;not text</UNKNOWN>
<TEXT>&#2;
<TITLE>UP &lt;UPCO> &amp; CO</TITLE><AUTHOR> By A</AUTHOR>
<DATELINE> X, </DATELINE><BODY>caf\xe9 \xfc one < two
&#3;</BODY></TEXT>
</REUTERS>
<REUTERS NEWID="3"><TEXT TYPE="BRIEF"><TITLE>short</TITLE></TEXT></REUTERS>
"""


def test_sgml(spark, tmp_path):
    (tmp_path / "a.sgm").write_bytes(SGML)
    (tmp_path / "b.txt").write_bytes(SGML)
    got = {r.doc_id: r.text for r in readers.read_documents_sgml(spark, str(tmp_path)).collect()}
    assert got[3] == "short"
    assert got[21].split() == "\x02 UP <UPCO> & CO By A X, caf one < two \x03".split()


def test_typed_csv(spark, tmp_path):
    text = 'park,n\n"HILL, PARK ON THE",1\n,2\n"say ""ÎLE"" – 5 €",x\n'
    (tmp_path / "t.csv").write_bytes(text.encode("windows-1252"))
    got = readers.read_csv_typed(spark, str(tmp_path), "park string, n string", "windows-1252").collect()
    assert [tuple(r) for r in got] == [("HILL, PARK ON THE", "1"), (None, "2"), ('say "ÎLE" – 5 €', "x")]


def test_audit(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,y, z\nq,w\n3,\n")
    rows = readers.read_csv_audited(spark, str(tmp_path / "t.csv"), "a int, b string").collect()
    assert sorted((r.a, r.b) for r in rows if r.line is None) == [(1, "x"), (3, None)]
    assert sorted(r.line for r in rows if r.line is not None) == ["2,y, z", "q,w"]


def test_delimited(spark, tmp_path):
    (tmp_path / "r.txt").write_text("1::2::3.5::99\n1::x::::\n7\n")
    rows = readers.read_delimited(spark, str(tmp_path / "r.txt"), "u int, i int, r double, t bigint").collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3.5, 99), (1, None, None, None), (7, None, None, None)]


def test_json_array(spark, tmp_path):
    (tmp_path / "n.json").write_text('[\n{"name": "A"},\n{"name": "B"},\n{"name": "A"}\n]')
    got = readers.read_json_array(spark, str(tmp_path / "n.json"), "name string").collect()
    assert [r.name for r in got] == ["A", "B", "A"]


def test_lines_keep_order(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", None), ("c", 1)], "v string, n int")
    sinks.write_csv_lines(df, str(tmp_path / "out"), ["v", "n"], ["v"])
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == "a,\nb,2\nc,1\n"


def test_saved_index_reads_one_bucket(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c")], "doc_id bigint, text string")
    path = str(tmp_path / "index")
    sinks.write_index(ix.index_sorted(ix.token_doc_pairs(docs)), path, buckets=4)
    found = ix.read_index(spark, path, "b")
    assert found.first().doc_ids == [1, 2] and found.count() == 1
    assert len(found.inputFiles()) <= len(ix.read_index(spark, path).inputFiles())


def test_stream_append(spark, tmp_path):
    history, source = str(tmp_path / "history"), tmp_path / "in"
    schema = "k bigint, v string"
    inc.start_history(spark.createDataFrame([(1, "old")], schema), history, "k", buckets=4)

    def run(checkpoint):
        stream = spark.readStream.schema(schema).parquet(str(source))
        inc.append_stream(stream, history, "k", str(tmp_path / checkpoint)).awaitTermination()
        return sorted(map(tuple, inc.read_history(spark, history).collect()))

    spark.createDataFrame([(1, "new"), (2, "b"), (2, "b")], schema).write.parquet(str(source))
    assert run("c1") == [(1, "old"), (2, "b")]
    spark.createDataFrame([(3, "c"), (4, None)], schema).write.mode("append").parquet(str(source))
    assert run("c1") == [(1, "old"), (2, "b"), (3, "c"), (4, None)]
    assert run("c2") == [(1, "old"), (2, "b"), (3, "c"), (4, None)]  # another stream over the same files


def test_stream_null_key_and_pruning(spark, tmp_path):
    history, source = str(tmp_path / "history"), str(tmp_path / "in")
    schema = "k bigint, v string"
    inc.start_history(spark.createDataFrame([(i, "old") for i in range(40)], schema), history, "k", buckets=16)
    spark.createDataFrame([(None, "x"), (7, "new")], schema).write.parquet(source)
    for checkpoint in ("c1", "c2"):
        stream = spark.readStream.schema(schema).parquet(source)
        inc.append_stream(stream, history, "k", str(tmp_path / checkpoint)).awaitTermination()
        rows = inc.read_history(spark, history)
        assert rows.count() == 41 and rows.filter("k IS NULL").count() == 1
    batch = spark.createDataFrame([(7, "again")], schema)
    seen, buckets = inc.seen_rows(spark, history, batch, "k", "none")
    assert buckets == 16
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", seen._jdf.queryExecution().toString())
    touched = batch.select(inc._bucket("k", buckets)).first()[0]
    assert [r.bucket for r in seen.select("bucket").distinct().collect()] == [touched]


def test_csv_repair(spark):
    lines = {
        "1,red fish,x,2.5": (1, "red fish", "x", 2.5, 1),
        "2,red, old, fish,x,2": (2, "red, old, fish", "x", 2.0, 1),
        "3,a,b, c, d,1": (3, "a", "b, c, d", 1.0, 1),
        "4,a, b,c, d,1": (4, "a, b", "c, d", 1.0, 1),
        "5,a, b, c,1": (None, None, None, None, 2),  # b may end the first text or begin the second
        "6,a,b,c,1": (None, None, None, None, 0),  # no blank after a comma
        "7,a,b": (None, None, None, None, 0),
        "x,a,b,1": (None, None, None, None, 0),
        "8,a,b,1 kg": (None, None, None, None, 0),
        '9,"a, b",c,1': (None, None, None, None, 0),
        "10,,,": (10, None, None, None, 1),
        " 11 ,a,b, 1 ": (11, "a", "b", 1.0, 1),
        "": (None, None, None, None, 0),
        ",,,": (None, None, None, None, 1),
    }
    df = spark.createDataFrame([(x,) for x in lines] + [(None,)], "line string")
    got = {r.line: tuple(r)[1:] for r in readers.repair_csv_lines(df, "k bigint, a string, b string, p double").collect()}
    assert got.pop(None) == (None, None, None, None, 0)
    assert got == lines
    long = spark.createDataFrame([("1," + ", ".join(["w"] * 60) + ",b,1",)], "line string")
    fitted = readers.repair_csv_lines(long, "k bigint, a string, b string, p double").first()
    assert fitted.n_fits == 1 and fitted.a == ", ".join(["w"] * 60) and fitted.b == "b"
    picky = readers.repair_csv_lines(df.filter("line like '5,%'"), "k bigint, a string, b string, p double", patterns={"a": "[a-z]"})
    assert tuple(picky.first())[1:] == (5, "a", " b, c", 1.0, 1)


def files_of(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


@pytest.mark.parametrize("append", [inc.append_stream, inc.append_stateful])
def test_a_history_starts_from_nothing(spark, tmp_path, append):
    history, source, checkpoint = str(tmp_path / "history"), str(tmp_path / "in"), str(tmp_path / "c")
    schema = "k bigint, v string"
    with pytest.raises(FileNotFoundError):
        inc.read_history(spark, history)
    inc.start_history(spark.createDataFrame([], schema), history, "k", buckets=4)
    assert inc.read_history(spark, history).collect() == []

    def run(rows, checkpoint=checkpoint):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        append(stream, history, "k", checkpoint).awaitTermination()
        return sorted(map(tuple, inc.read_history(spark, history).collect()), key=str)

    assert run([(1, "b"), (1, "a"), (None, "n"), (2, "c")]) == [(1, "a"), (2, "c"), (None, "n")]
    assert run([(1, "later"), (3, "d"), (None, "o")]) == [(1, "a"), (2, "c"), (3, "d"), (None, "n")]
    inc.compact_history(spark, history, "k")
    assert run([(3, "later"), (4, None)]) == [(1, "a"), (2, "c"), (3, "d"), (4, None), (None, "n")]
    assert run([], str(tmp_path / "other")) == [(1, "a"), (2, "c"), (3, "d"), (4, None), (None, "n")]


@pytest.mark.parametrize("append", [inc.append_stream, inc.append_stateful])
def test_a_batch_may_run_again(spark, tmp_path, append):
    """The commit of the last batch is lost, as when the driver dies after writing: it is run again."""
    history, source, checkpoint = str(tmp_path / "history"), str(tmp_path / "in"), tmp_path / "c"
    schema = "k bigint, v string"
    inc.start_history(spark.createDataFrame([(0, "old")], schema), history, "k", buckets=4)
    for rows in ([(0, "new"), (1, "a")], [(1, "b"), (2, "c")]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        append(spark.readStream.schema(schema).parquet(source), history, "k", str(checkpoint)).awaitTermination()
    last = max(int(p.name) for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    (checkpoint / "commits" / str(last)).unlink()
    (checkpoint / "commits" / f".{last}.crc").unlink(missing_ok=True)
    append(spark.readStream.schema(schema).parquet(source), history, "k", str(checkpoint)).awaitTermination()
    assert sorted(map(tuple, inc.read_history(spark, history).collect())) == [(0, "old"), (1, "a"), (2, "c")]


def test_state_takes_no_call_per_key(spark, tmp_path):
    """A call of Python per key made the time grow by milliseconds a key."""
    spark.createDataFrame([(1, "a")], "k bigint, v string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k bigint, v string").parquet(str(tmp_path / "in"))
    out = io.StringIO()
    with redirect_stdout(out):
        inc.first_of_keys(stream, "k").explain(True)
    assert "StateStoreSave" in out.getvalue() and "Pandas" not in out.getvalue()


def test_compaction_leaves_one_file_per_bucket(spark, tmp_path):
    history, schema = str(tmp_path / "history"), "k bigint, v string"
    inc.start_history(spark.createDataFrame([(i, "a") for i in range(50)], schema), history, "k", buckets=4)
    for n in range(3):
        source = str(tmp_path / f"in{n}")
        spark.createDataFrame([(100 * n + i, "b") for i in range(60)], schema).write.parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        inc.append_stream(stream, history, "k", str(tmp_path / f"c{n}")).awaitTermination()
    before = sorted(map(tuple, inc.read_history(spark, history).collect()))
    assert len(files_of(inc.read_history(spark, history))) > 8
    for _ in range(3):
        inc.compact_history(spark, history, "k")
    assert sorted(map(tuple, inc.read_history(spark, history).collect())) == before
    assert len(files_of(inc.read_history(spark, history))) == 4
    assert sorted(p.name for p in (tmp_path / "history").glob("rows-*")) == ["rows-2", "rows-3"]
