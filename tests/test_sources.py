"""Corpora read from real files: ids and splits do not depend on how the scan is cut."""

import pytest

from tandem.plans.pipelines import prepare_bitext
from tandem.sources import tsv


def write(folder, files):
    for name, data in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(data)
    return str(folder)


def brute(files):
    """(number of the file in path order << 40 | offset, line) by plain Python."""
    out = []
    for number, name in enumerate(sorted(files)):
        at = 0
        for line in files[name].split(b"\n"):
            out.append((number << 40 | at, line.removesuffix(b"\r").decode()))
            at += len(line) + 1
        if files[name].endswith(b"\n") or not files[name]:
            out.pop()
    return sorted(out)


@pytest.fixture
def layouts(spark):
    """Run with several sizes of a split, then put the settings back."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {n: spark.conf.get(n) for n in names}

    def each(sizes):
        for size in sizes:
            spark.conf.set(names[0], str(size))
            spark.conf.set(names[1], "1")
            yield size
    yield each
    for n, v in old.items():
        spark.conf.set(n, v)


FILES = {
    "a.tsv": b"".join(b"line %d\t%s\n" % (i, b"x" * (i * 7 % 90)) for i in range(400)),
    "b.tsv": "no line feed at the end \u00e9\u4e2d\tz\r\nlast".encode(),
    "c/d.tsv": b"\n\n\nq\n",
    "long.tsv": b"s\n" + b"y" * 60_000 + b"\nt\n",
    "one.tsv": b"only",
}


def test_ids_are_file_and_offset_under_every_layout(spark, layouts, tmp_path):
    path = write(tmp_path, FILES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for size in layouts([128 << 20, 5000, 700, 64]):
            lines = tsv.read_text_lines(spark, [path + "/*.tsv", path + "/c"])
            got = sorted((r["pair_id"], r["value"]) for r in lines.collect())
            assert got == brute(FILES), size
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_split_is_the_same_under_every_layout(spark, layouts, tmp_path):
    news = b"".join(b"en %d\tzh %d\n" % (i, i) for i in range(600))
    mined = b"".join(b"1.0%d\ten m%d\tzh m%d\ten\tzh\n" % (i % 10, i, i) for i in range(300))
    path = write(tmp_path, {"news/0.tsv": news, "news/1.tsv": news[:4000].rsplit(b"\n", 1)[0], "mined/0.tsv": mined})
    seen = []
    for _ in layouts([128 << 20, 1000]):
        done = prepare_bitext(news_lines=tsv.read_text_lines(spark, path + "/news"),
                              mined_lines=tsv.read_text_lines(spark, path + "/mined"))
        seen.append(sorted(tuple(r) for r in done.collect()))
    assert seen[0] == seen[1] and {r[-1] for r in seen[0]} == {"train", "val", "test"}


def test_bad_lines_stop_or_are_set_aside(spark, tmp_path):
    path = write(tmp_path, {"a.tsv": b"en\tzh\nonly one\na\tb\tc\n"})
    lines = tsv.read_text_lines(spark, path)
    assert [(r["en"], r["zh"]) for r in tsv.read_pairs(lines, "DROPMALFORMED").collect()] == [("en", "zh")]
    assert sorted(r["n_fields"] for r in tsv.arity_rejects(lines, 2).collect()) == [1, 3]
    with pytest.raises(Exception, match="expected 2 tab-separated fields"):
        tsv.read_pairs(lines).collect()


def test_empty_files_have_no_lines(spark, tmp_path):
    path = write(tmp_path, {"a.tsv": b""})
    assert tsv.read_text_lines(spark, path).count() == 0


def test_one_scan_carries_text_and_splits_come_by_broadcast(spark, tmp_path):
    path = write(tmp_path, {"a.tsv": FILES["a.tsv"]})
    plan = tsv.read_text_lines(spark, path).select("pair_id", "value")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("MapInArrow")[0]


def test_parts_of_a_folder_are_one_text(spark, tmp_path):
    for name, text in {"a/part-0": "x\ny1\n", "a/part-1": "z\n", "b/part-0": "中\nw\n"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    rows = tsv.read_text_lines(spark, [str(tmp_path / "a"), str(tmp_path / "b")], folders=True).collect()
    second = 1 << tsv.FILE_BITS
    assert sorted((r["pair_id"], r["value"]) for r in rows) == [(0, "x"), (2, "y1"), (5, "z"), (second, "中"), (second + 4, "w")]


def test_a_corpus_text_is_written_by_several_tasks(spark):
    import glob
    from tandem.plans import catalog as C
    from tests.conftest import SF001
    path = C.corpus_files(spark, SF001, "raw_titles")
    found = glob.glob(path.removeprefix("file:") + "/bucket=*/*.txt")
    assert len(found) > len({f.rsplit("/", 2)[1] for f in found})


def test_sides_leave_rows_and_splits_as_they_are(spark):
    lines = spark.createDataFrame([(i, f"\u3000Left {i} é\t{'right' if i % 7 else ' '} {i}\u2003" if i % 5 else f"{i}\t \u3000")
                                   for i in range(60)], "pair_id long, value string")
    both = prepare_bitext(news_lines=lines)
    assert both.columns == ["corpus", "pair_id", "en", "zh", "split"] and both.count() == 48
    for side in ("en", "zh"):
        one = prepare_bitext(news_lines=lines, sides=[side])
        assert one.columns == ["corpus", "pair_id", side, "split"]
        assert sorted(map(tuple, one.collect())) == sorted(map(tuple, both.select(*one.columns).collect()))


def test_a_line_is_cut_once(spark):
    """The fields of a line and the filter on its stripped texts are not worked out again from the line."""
    lines = spark.createDataFrame([(1, " a\tb ")], "pair_id long, value string")
    plan = prepare_plan(tsv.read_pairs(lines))
    assert plan.count("split(") == 1, plan


def prepare_plan(pairs):
    from tandem.operators.clean import clean_pairs
    return clean_pairs(pairs)._jdf.queryExecution().optimizedPlan().toString()
