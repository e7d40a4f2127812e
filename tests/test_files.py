import gzip
import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from brute import peaks_of
from pyspark.errors import PySparkException

from termpeak import (
    load_corpus,
    peak_documents,
    read_ndjson,
    read_peaks,
    run_job,
    write_ndjson,
    write_peaks,
)

ROWS = [("a", "x x y"), ("b", "x y y y\nz"), ('c "q" é/\\', "rare word")]


def line(filename, content, **more):
    return json.dumps({"filename": filename, "content": content, **more})


def write_lines(path, lines):
    path.write_bytes("".join(text + "\n" for text in lines).encode())
    return str(path)


def formatted(rows):
    return {word: f"<{name}, {n}>" for word, (name, n) in peaks_of(rows).items()}


def output_of(path):
    """The output as any reader of tab-separated JSON sees it."""
    pairs = [
        [json.loads(part) for part in text.split("\t")]
        for file in Path(path).glob("part-*")
        for text in file.read_text().splitlines()
    ]
    result = dict(pairs)
    assert len(result) == len(pairs)
    return result


def test_read_ndjson_ignores_other_fields(spark, tmp_path):
    path = write_lines(tmp_path / "in.json", [line(*r, extra=[1, {"k": 2}]) for r in ROWS])
    assert sorted(tuple(r) for r in read_ndjson(spark, path).collect()) == sorted(ROWS)


def test_read_ndjson_takes_compressed_files_and_directories(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_lines(tmp_path / "in" / "one.json", [line(*ROWS[0])])
    with gzip.open(tmp_path / "in" / "two.json.gz", "wt") as out:
        out.write(line(*ROWS[1]))
    got = read_ndjson(spark, str(tmp_path / "in")).collect()
    assert sorted(tuple(r) for r in got) == sorted(ROWS[:2])


def test_lines_end_at_newlines_only(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_bytes(b'{"filename":"a",\r"content":"x"}\r\n{"filename":"b","content":"y"}')
    got = sorted(tuple(r) for r in read_ndjson(spark, str(path)).collect())
    assert got == [("a", "x"), ("b", "y")]


def test_a_line_that_is_not_utf8_is_read_as_latin1(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_bytes(
        line("é", "x").encode() + b"\n" + b'{"filename":"caf\xe9","content":"\xc9t\xe9"}\n'
        + '{"filename":"ü","content":"y"}\n'.encode()
    )
    got = sorted(tuple(r) for r in read_ndjson(spark, str(path)).collect())
    assert got == sorted([("é", "x"), ("café", "Été"), ("ü", "y")])


def test_a_blank_line_fails_the_job(spark, tmp_path):
    path = write_lines(tmp_path / "in.json", [line("a", "x"), "", line("b", "x")])
    with pytest.raises(PySparkException, match="malformed document record"):
        peak_documents(read_ndjson(spark, path)).collect()


def test_ndjson_round_trip(spark, docs_of, tmp_path):
    path = str(tmp_path / "out")
    write_ndjson(docs_of(ROWS, 2), path)
    assert sorted(tuple(r) for r in read_ndjson(spark, path).collect()) == sorted(ROWS)
    with pytest.raises(PySparkException, match="PATH_ALREADY_EXISTS"):
        write_ndjson(docs_of(ROWS), path)


def test_peaks_round_trip(spark, docs_of, tmp_path):
    path = str(tmp_path / "out")
    write_peaks(peak_documents(docs_of(ROWS, 2)), path)
    assert output_of(path) == formatted(ROWS)
    assert {r.word: r.peak for r in read_peaks(spark, path).collect()} == formatted(ROWS)


def test_job_from_file_to_file(spark, tmp_path):
    path = write_lines(tmp_path / "in.json", [line(*row) for row in ROWS])
    run_job(spark, path, str(tmp_path / "out"))
    assert output_of(tmp_path / "out") == formatted(ROWS)


def test_job_with_rejects(spark, tmp_path):
    bad = ['{"filename":"a"}', "", line("a", "x x x x") + "] junk"]
    path = write_lines(tmp_path / "in.json", [*bad, *(line(*row) for row in ROWS)])
    with pytest.raises(PySparkException, match="malformed document record"):
        run_job(spark, path, str(tmp_path / "failed"))
    run_job(spark, path, str(tmp_path / "out"), str(tmp_path / "rejects"))
    assert output_of(tmp_path / "out") == formatted(ROWS)
    rejects = [
        text
        for file in (tmp_path / "rejects").glob("part-*")
        for text in file.read_text().split("\n")[:-1]
    ]
    assert sorted(rejects) == sorted(bad)


def raw_rejects(path):
    return sorted(
        text
        for file in Path(path).glob("part-*")
        for text in file.read_bytes().split(b"\n")[:-1]
    )


def test_rejects_are_the_bytes_of_the_input(spark, tmp_path):
    good = line(*ROWS[0]).encode()
    bad = b'{"filename":"caf\xe9"}'
    (tmp_path / "in.json").write_bytes(good + b"\n" + bad + b"\n")
    run_job(spark, str(tmp_path / "in.json"), str(tmp_path / "out"), str(tmp_path / "rejects"))
    assert raw_rejects(tmp_path / "rejects") == [bad]
    assert output_of(tmp_path / "out") == formatted(ROWS[:1])


def test_no_rejects_no_second_pass(spark, tmp_path, monkeypatch):
    path = write_lines(tmp_path / "in.json", [line(*row) for row in ROWS])
    monkeypatch.setattr("termpeak.plans.peaks.malformed_lines", None)
    run_job(spark, path, str(tmp_path / "out"), str(tmp_path / "rejects"))
    assert output_of(tmp_path / "out") == formatted(ROWS)
    assert not (tmp_path / "rejects").exists()


@pytest.mark.parametrize("taken", ["out", "rejects"])
def test_paths_are_checked_before_any_work(spark, tmp_path, taken):
    path = write_lines(tmp_path / "in.json", ["{}", *(line(*row) for row in ROWS)])
    (tmp_path / taken).mkdir()
    with pytest.raises(FileExistsError, match=taken):
        run_job(spark, path, str(tmp_path / "out"), str(tmp_path / "rejects"))
    other = {"out": "rejects", "rejects": "out"}[taken]
    assert not (tmp_path / other).exists()


def test_lines_can_be_dealt_out_by_name(spark, tmp_path):
    path = write_lines(tmp_path / "in.json", [line(*row) for row in ROWS])
    run_job(spark, path, str(tmp_path / "out"), partitions=3)
    assert output_of(tmp_path / "out") == formatted(ROWS)


def command_line(*arguments, submit=""):
    submit = f"--master local[2] --conf spark.ui.enabled=false {submit} pyspark-shell"
    done = subprocess.run(
        [sys.executable, "-m", "termpeak", *map(str, arguments)],
        cwd=Path(__file__).parents[1],
        env={**os.environ, "PYSPARK_SUBMIT_ARGS": submit},
        check=True,
        timeout=120,
        capture_output=True,
        text=True,
    )
    text = next(x for x in done.stdout.splitlines() if x.startswith("settings:"))
    return json.loads(text.removeprefix("settings:"))


def test_command_line(tmp_path):
    path = write_lines(tmp_path / "in.json", [line(*row) for row in ROWS])
    settings = command_line(path, tmp_path / "out")
    assert output_of(tmp_path / "out") == formatted(ROWS)
    assert settings["spark.sql.shuffle.partitions"] == "2"
    assert settings["spark.sql.files.maxPartitionBytes"] == str(128 << 20)


def test_command_line_settings_give_way(tmp_path):
    path = write_lines(tmp_path / "in.json", [line(*row) for row in ROWS])
    settings = command_line(
        path, tmp_path / "out", "--split-bytes", "50", submit="--conf spark.sql.shuffle.partitions=3"
    )
    assert settings["spark.sql.files.maxPartitionBytes"] == "50"
    assert "spark.sql.shuffle.partitions" not in settings


def test_load_corpus(spark, tmp_path):
    root = tmp_path / "some tree"
    files = {
        "first group/1001": b"From: a\nSubject: x\n\nfirst\ttext",
        "second+group/1001": b"same name,\r\nother text\n",
        "second+group/50%": b"caf\xe9",
        "k=v/7": b"not a partition column",
    }
    for name, content in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    (root / "first group/1002").touch()
    docs = load_corpus(spark, str(root))
    assert docs.columns == ["filename", "content", "label"]
    got = {r.filename: (r.content, r.label) for r in docs.collect()}
    assert got == {
        name: (content.decode("latin-1"), name.split("/")[0])
        for name, content in files.items()
    }


def test_load_corpus_keeps_names_apart(spark, tmp_path):
    for name in ("g/1", "deep/a/g/1", "deep/b/g/1"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    docs = load_corpus(spark, str(tmp_path))
    got = {r.filename: (r.content, r.label) for r in docs.collect()}
    assert got == {n: (n, "g") for n in ("g/1", "deep/a/g/1", "deep/b/g/1")}


@pytest.mark.parametrize("name", ["g/_2", "g/.3", "_h/4", "deep/a/b/_c/5"])
def test_load_corpus_names_what_it_cannot_read(spark, tmp_path, name):
    for each in ("g/1", name):
        (tmp_path / "some tree" / each).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "some tree" / each).write_text("x")
    path = str(tmp_path / "some tree")
    with pytest.raises(ValueError, match="hidden"):
        load_corpus(spark, path)
    assert [r.filename for r in load_corpus(spark, path, hidden="skip").collect()] == ["g/1"]


def test_corpus_to_peaks(spark, tmp_path):
    rows = [("g/1", "x x\ny"), ("h/1", "x x x"), ("h/2", "y, y")]
    for name, content in rows:
        (tmp_path / "c" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "c" / name).write_text(content)
    write_ndjson(load_corpus(spark, str(tmp_path / "c")), str(tmp_path / "nd"))
    peaks = peak_documents(read_ndjson(spark, str(tmp_path / "nd")))
    assert {r.word: (r.filename, r.n) for r in peaks.collect()} == peaks_of(rows)


def test_lines_across_split_boundaries_are_read_once(spark, tmp_path):
    rows = [(f"f{i}", f"w{'é' * (i % 9)} common {'x' * (i % 13)}") for i in range(300)]
    path = write_lines(tmp_path / "in.json", [line(*row) for row in rows])
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "97")
    docs = read_ndjson(session, path)
    assert docs.rdd.getNumPartitions() > 100
    assert sorted(tuple(r) for r in docs.collect()) == sorted(rows)
    assert {r.word: (r.filename, r.n) for r in peak_documents(docs).collect()} == peaks_of(rows)


def test_job_over_several_inputs(spark, tmp_path):
    paths = [
        write_lines(tmp_path / f"in{i}.json", [line(*row)]) for i, row in enumerate(ROWS)
    ]
    run_job(spark, paths, str(tmp_path / "list"))
    run_job(spark, str(tmp_path / "in*.json"), str(tmp_path / "glob"))
    assert output_of(tmp_path / "list") == output_of(tmp_path / "glob") == formatted(ROWS)


def test_output_is_not_overwritten_unless_asked(spark, docs_of, tmp_path):
    path = str(tmp_path / "out")
    write_peaks(peak_documents(docs_of(ROWS[:1])), path)
    with pytest.raises(PySparkException, match="PATH_ALREADY_EXISTS"):
        write_peaks(peak_documents(docs_of(ROWS)), path)
    assert output_of(path) == formatted(ROWS[:1])
    write_peaks(peak_documents(docs_of(ROWS)), path, mode="overwrite")
    assert output_of(path) == formatted(ROWS)


@pytest.mark.skipif("TERMPEAK_CORPUS" not in os.environ, reason="no corpus given")
def test_whole_corpus(spark, tmp_path):
    """Any directory tree of text files, from files to output, against brute force."""
    root = Path(os.environ["TERMPEAK_CORPUS"])
    rows = [
        (f"{file.parent.name}/{file.name}", file.read_bytes().decode())
        for file in root.rglob("*")
        if file.is_file() and file.stat().st_size
    ]
    write_ndjson(load_corpus(spark, str(root)), str(tmp_path / "lines"))
    run_job(spark, str(tmp_path / "lines"), str(tmp_path / "out"))
    assert output_of(tmp_path / "out") == formatted(rows)
