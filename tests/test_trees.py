"""Trees of one file to a document, results that appear whole, and stored peaks."""

import json
import random
from pathlib import Path

import pytest
from brute import peaks_of
from pyspark.errors import PySparkException

from termpeak import (
    load_corpus,
    merge_peaks,
    peak_documents,
    read_documents,
    run_job,
    stored_peaks,
    tree_files,
    update_peaks,
    write_corpus,
    write_documents,
)
from termpeak.plans import peaks as plan
from termpeak.sinks.publish import published
from termpeak.sources import trees

NAMES = ["g/1", "g/_2", "g/.3", "_h/4", ".i/j/5", "top", "_top", "g/a b+c%41é", "k=_/_x=1"]


def names_in(path):
    root = Path(path)
    return {p.relative_to(root).as_posix(): p.read_bytes() for p in root.rglob("*") if p.is_file()}


def plain_tree(root, files):
    for name, content in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    return str(root)


def test_every_name_is_read(spark, tmp_path):
    files = {n: f"text of {n}\n".encode() for n in NAMES} | {"g/_empty": b"", "g/.l": b"\xe9t\xe9"}
    root = plain_tree(tmp_path / "a tree", files)
    got = {r.filename: (r.content, r.label) for r in load_corpus(spark, root, "read").collect()}
    expected = {}
    for name, content in files.items():
        if content:
            text = "été" if name == "g/.l" else content.decode()
            expected[name] = (text, ("a tree/" + name).split("/")[-2])
    assert got == expected
    listed = {r.filename: r.size for r in tree_files(spark, root).collect()}
    assert listed == {n: len(c) for n, c in files.items()}


def test_six_files_are_six_documents(spark, tmp_path):
    files = {n: b"x" for n in ["a/1", "a/_2", "a/.3", "_b/4", ".c/5", "6"]}
    root = plain_tree(tmp_path / "t", files)
    assert load_corpus(spark, root, hidden="read").count() == 6
    assert load_corpus(spark, root, hidden="skip").count() == 2


def test_a_tree_written_is_the_tree_read(spark, docs_of, tmp_path):
    rows = [(n, f"{n}\nspace \r\n\té 日本") for n in NAMES] + [("null", None), ("empty", "")]
    path = str(tmp_path / "out" / "tree")
    write_corpus(docs_of(rows, 3), path)
    assert names_in(path) == {n: (c or "").encode() for n, c in rows}
    back = load_corpus(spark, path, hidden="read").select("filename", "content").collect()
    assert sorted(tuple(r) for r in back) == sorted((n, c) for n, c in rows if c)
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["tree"]


@pytest.mark.parametrize("name", ["/etc/x", "../x", "a/../../x", "a//b", "", ".", "a/", None])
def test_names_that_lead_out_are_refused(spark, docs_of, tmp_path, name):
    with pytest.raises(PySparkException, match="not a name below the tree"):
        write_corpus(docs_of([("fine", "x"), (name, "y")]), str(tmp_path / "tree"))
    assert not list(tmp_path.iterdir())


def test_one_name_twice_is_refused(spark, docs_of, tmp_path):
    with pytest.raises(ValueError, match="2 documents are named 'f'"):
        write_corpus(docs_of([("f", "x"), ("f", "y")]), str(tmp_path / "tree"))
    assert not list(tmp_path.iterdir())


def test_an_existing_tree_is_left_alone(spark, docs_of, tmp_path):
    (tmp_path / "tree").mkdir()
    with pytest.raises(FileExistsError):
        write_corpus(docs_of([("f", "x")]), str(tmp_path / "tree"))


def test_an_empty_tree(spark, docs_of, tmp_path):
    path = str(tmp_path / "tree")
    write_corpus(docs_of([("f", "x")]).where("false"), path)
    assert tree_files(spark, path).count() == 0


def lines_in(path, good=40, bad=3):
    path.write_text(
        "".join(json.dumps({"filename": f"f{k}", "content": "a b"}) + "\n" for k in range(good))
        + "not json\n" * bad
    )
    return str(path)


def test_peaks_and_rejects_appear_together(spark, tmp_path):
    source = lines_in(tmp_path / "in.json")
    run_job(spark, source, str(tmp_path / "out"), str(tmp_path / "bad"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["bad", "in.json", "out"]
    clean = lines_in(tmp_path / "clean.json", bad=0)
    run_job(spark, clean, str(tmp_path / "out2"), str(tmp_path / "bad2"))
    assert (tmp_path / "out2").exists() and not (tmp_path / "bad2").exists()


def test_a_failing_reject_pass_leaves_neither(spark, tmp_path, monkeypatch):
    source = lines_in(tmp_path / "in.json")

    def failing(lines):
        return lines.selectExpr("CAST(raise_error('no space left') AS STRING) AS value")

    monkeypatch.setattr(plan, "malformed_lines", failing)
    with pytest.raises(PySparkException, match="no space left"):
        run_job(spark, source, str(tmp_path / "out"), str(tmp_path / "bad"))
    assert [p.name for p in tmp_path.iterdir()] == ["in.json"]


def test_a_failing_rename_takes_back_those_before(spark, tmp_path):
    first, second = tmp_path / "one", tmp_path / "two"
    with pytest.raises(FileExistsError), published(spark, str(first), str(second)) as staged:
        for path in staged:
            Path(path).mkdir()
        second.mkdir()  # by someone else, meanwhile
    assert sorted(p.name for p in tmp_path.iterdir()) == ["two"]


def test_parts_merged_equal_the_whole(spark, docs_of):
    draw = random.Random(6)
    rows = [
        (f"f{draw.randrange(30)}", " ".join(draw.choices("a b c d e".split(), k=draw.randrange(9))))
        for _ in range(200)
    ]
    parts = [peak_documents(docs_of(rows[k::4], 2)) for k in range(4)]
    for merged in (merge_peaks(*parts), merge_peaks(parts[3], merge_peaks(*parts[2::-1]))):
        got = {r.word: (r.filename, r.n) for r in merged.collect()}
        assert got == peaks_of(rows)
    assert merge_peaks(parts[0]).count() == parts[0].count()


def test_stored_peaks_take_new_documents(spark, docs_of, tmp_path):
    path = str(tmp_path / "peaks")
    with pytest.raises(FileNotFoundError):
        stored_peaks(spark, path)
    rows = []
    for some in ([("b", "x x y")], [("a", "x x z")], [], [("c", "z z"), ("c", "w")]):
        update_peaks(spark, path, docs_of(some))
        rows += some
        got = {r.word: (r.filename, r.n) for r in stored_peaks(spark, path).collect()}
        assert got == peaks_of(rows)
    # the last version and the one it was made from
    assert sorted(p.name for p in Path(path).iterdir()) == ["version-00000002", "version-00000003"]


def test_an_update_that_fails_changes_nothing(spark, docs_of, tmp_path):
    path = str(tmp_path / "peaks")
    update_peaks(spark, path, docs_of([("a", "x")]))
    with pytest.raises(PySparkException, match="without a filename"):
        update_peaks(spark, path, docs_of([(None, "x")]))
    assert [tuple(r) for r in stored_peaks(spark, path).collect()] == [("x", "a", 1)]
    assert [p.name for p in Path(path).iterdir()] == ["version-00000000"]


def test_a_laid_out_table_is_read_where_it_lies(spark, docs_of, tmp_path):
    draw = random.Random(1)
    rows = [
        (f"f{k}", " ".join("".join(draw.choices("abcdefgh", k=7)) for _ in range(4000)))
        for k in range(160)
    ]
    path = str(tmp_path / "table")
    write_documents(docs_of(rows), path, split_bytes=4 << 20)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 20)
    try:
        docs = read_documents(spark, path)
        peaks = peak_documents(docs)
        assert "RoundRobinPartitioning" not in peaks._jdf.queryExecution().toString()
        per_task = [r["count"] for r in docs.groupBy("filename").count().collect()]
        assert len(per_task) == 160
        held = docs.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
        assert len(held) >= 2 and max(r["count"] for r in held) < 140
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(tuple(r) for r in docs.collect()) == sorted(rows)


def test_a_tree_is_listed_by_tasks_alone_and_in_parts(spark, tmp_path):
    """Spark's readers would list every file in the driver."""
    files = {f"g/{mark}{k}": b"x" * k for k in range(30) for mark in ("", "_", ".")}
    root = plain_tree(tmp_path / "t", files)
    docs = load_corpus(spark, root, hidden="read")
    assert not [f for f in docs.inputFiles() if f.startswith("file:" + root)]
    assert {r.filename: r.content for r in docs.collect()} == {
        n: c.decode() for n, c in files.items() if c
    }
    system, base = trees.open_tree(root)
    found = trees._entries(system, f"{base}/g")
    assert not isinstance(found, list) and next(found)[0] in {n[2:] for n in files}
    assert len(list(found)) == len(files) - 1


def test_files_are_read_in_rows_of_bounded_size(spark, tmp_path):
    files = {f"_{k}": bytes([65 + k % 26]) * (1 << 20) for k in range(12)} | {"_l": b"z" * (9 << 20)}
    root = plain_tree(tmp_path / "t", files)
    got = {r.filename: (len(r.content), r.content[0]) for r in load_corpus(spark, root, "read").collect()}
    assert got == {n: (len(c), chr(c[0])) for n, c in files.items()}
