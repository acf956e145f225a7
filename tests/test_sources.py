"""Files in, decoded; the inbox stream takes each file once."""

from inkwell.sources import documents
from inkwell.streaming.inbox import run_inbox


def test_text_files_and_inbox(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, content in (("a.txt", "가나\r\n다".encode("cp949")), ("b.md", "﻿x\ry".encode()), ("c.bin", b"no"), ("d.txt", b"")):
        (folder / name).write_bytes(content)
    got = {r.path.rsplit("/", 1)[-1]: r.text for r in documents.text_files(spark, str(folder)).collect()}
    assert got == {"a.txt": "가나\n다", "b.md": "x\ny"}
    run = lambda: run_inbox(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination(60)
    run()
    (folder / "e.txt").write_text("new")
    run()
    assert sorted(r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["new", "x\ny", "가나\n다"]


def test_jsonl(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1}\n\n[1]\nbad\n{"b": "x"}\n')
    good, bad = documents.jsonl(spark, str(path))
    assert good.count() == 2 and sorted(r.line for r in bad.collect()) == ["[1]", "bad"]
