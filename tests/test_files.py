"""Files and the stream on a small fixture."""

import gzip
import json

from pyspark.sql import functions as F

from quire.sources import files
from quire.streaming import clean


def test_books(spark, tmp_path):
    text = "Старик ушёл домой."
    (tmp_path / "a").mkdir()
    (tmp_path / "a/utf.txt").write_bytes(("﻿" + text).encode())
    (tmp_path / "a/old.txt").write_bytes(text.encode("cp1251"))
    (tmp_path / "koi.txt.gz").write_bytes(gzip.compress(text.encode("koi8-r")))
    (tmp_path / "other.csv").write_text("x")
    assert [r.text for r in files.books(spark, str(tmp_path)).collect()] == [text] * 3
    assert files.decode(None) is None and files.decode(b"") == ""


def test_sentences(spark, tmp_path):
    rows = [json.dumps({"book_id": "b", "text": "Да.", "position": 0}), "{broken", json.dumps({"book_id": "b", "position": 1})]
    (tmp_path / "b.jsonl").write_text("\n".join(rows))
    assert [r.text for r in files.sentences_json(spark, str(tmp_path / "b.jsonl")).collect()] == ["Да."]
    df = spark.createDataFrame([("Он ушёл. «Да», — сказала она! Потом... всё\n\nКонец",)], "t string")
    assert df.select(files.split_sentences(F.col("t")).alias("s")).first().s == ["Он ушёл.", "«Да», — сказала она!", "Потом... всё", "Конец"]


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"book_id": "b", "text": t, "position": k} for k, t in enumerate(["Старик  ушёл домой", "http://x.org", "", "12345678901"])]
    (tmp_path / "in/b.json").write_text("\n".join(map(json.dumps, rows)))
    clean.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    got = {r.position: (r.text, r.reason) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[0] == ("Старик ушёл домой", None) and got[1][1] == "garbage_pattern" and got[2][1] == "empty" and got[3][1] is not None
