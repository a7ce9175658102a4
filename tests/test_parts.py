"""Parts against brute force on small fixtures: dialect, order in blocks, exact samples, packing."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from quire.functions import fixed as X
from quire.functions import re2
from quire.functions import text as T
from quire.operators.ordered import numbered, ranked_by_hash, with_previous
from quire.operators.packing import pack

EDGES = [
    "", " ", "\n", "УДК 123.45", "aУДК 123.45", "приvет word", "1приvет", "a b c d e f", "б а р а б а н", "12\u000b", "James, 216\nChapel, 382\nAbbey, 9", "слово-\nслово", "a b", "abc\n", "[12].", "С. 17", "С. 17 \n",
    "http://x.org/a b", "x@y.com", "ISBN 978-5-17-118366-0", "1. Первый", "• ) x", "ﬁsh​�", "— — —", "А б в", "x" * 300, "\x01\x7f", "日本 text", "в.", "и…", "12345 67890", "<w:t>слово</w:t> >", "глава12 три",
]


@pytest.mark.parametrize("name", [n for n in dir(X) if n.isupper() and isinstance(getattr(X, n), str) and n not in ("WS", "VALIDATION")])
def test_dialect(spark, name):
    pattern = getattr(X, name)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGES)], "i int, t string")
    got = {r.i: (r.m, r.r) for r in df.select("i", re2.matches(F.col("t"), pattern).alias("m"), re2.replace(F.col("t"), pattern, "_").alias("r")).collect()}
    db = duckdb.connect()
    for i, t in enumerate(EDGES):
        want = db.execute(f"select {re2.sql_matches('$1', pattern)}, {re2.sql_replace('$1', pattern, '_')}", [t]).fetchall()[0]
        assert got[i] == want, (name, t)


def test_reasons(spark):
    df = spark.createDataFrame([(t,) for t in EDGES], "text string")
    got = {r.text: r.reason for r in T.with_reason(df).collect()}
    assert got[""] == got[" "] == "empty"
    assert got["http://x.org/a b"] == got["x@y.com"] == got["[12]."] == got["С. 17"] == "garbage_pattern"
    assert got["James, 216\nChapel, 382\nAbbey, 9"] == "index"
    assert got["a b c d e f"] == got["б а р а б а н"] == got["А б в"] == got["1приvет"] == "ocr_garbage"
    assert got["приvет word"] is None and got["слово-\nслово"] is None


def test_order_in_blocks(spark):
    rng = random.Random(1)
    rows = [(b, p, rng.choice("xyz")) for b, n in (("hot", 60), ("cold", 3), ("one", 1)) for p in sorted(rng.sample(range(200), n))]
    df = spark.createDataFrame(rows, "book_id string, position int, text string")
    got = {(r.book_id, r.position): (r.prev_text, r.n) for r in numbered(with_previous(df, "book_id", "position", ["text"], 7), "book_id", "position", "n", 5).collect()}
    want, last, n = {}, {}, {}
    for b, p, t in rows:
        want[b, p] = (last.get(b), n.get(b, 0))
        last[b], n[b] = t, n.get(b, 0) + 1
    assert got == want
    assert with_previous(df.limit(0), "book_id", "position", ["text"]).count() == 0


def test_ranked(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    got = sorted((r["rank"], r.k) for r in ranked_by_hash(df, F.sha2("k", 256), 120).collect())
    order = sorted(df.select("k", F.sha2("k", 256).alias("h")).collect(), key=lambda r: r.h)
    assert [k for _, k in got] == [r.k for r in order[:120]] and [r for r, _ in got] == list(range(1, 121))
    assert ranked_by_hash(df, F.sha2("k", 256), 10_000).count() == 500


def test_pack(spark):
    rng = random.Random(2)
    rows = [("b", "train", p, rng.randint(0, 14)) for p in range(150)] + [("c", "val", 5, 3)]
    df = spark.createDataFrame(rows, "book_id string, split string, position int, tokens int")
    got = {(r.book_id, r.position): r.chunk for r in pack(df, 14, block=16).collect()}
    want, at, chunk = {}, 0, 0
    for _, _, p, n in rows[:150]:
        if 1 <= n <= 12:
            if at + n > 12:
                chunk += at > 0
                at = n
            else:
                at += n
            want["b", p] = chunk
    assert got == want | {("c", 5): 0}
