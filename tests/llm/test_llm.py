"""The ten operators: against brute force, exact round trips or agreement, with nulls, empty and long texts, ties, repeats, empty tables and clashing columns."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import bpe, budget, content, crf, forms, leaks, pieces, quality, queries, scan, splits, tongues
from quire.llm.editor import WordEditor
from quire.llm.looks import odd, one_form, settled, skeleton

LONG = "Старик ушёл домой. " * 3000


@pytest.fixture(scope="module")
def tokens():
    return bpe.vocabulary()


@pytest.fixture(scope="module")
def encoder(tokens):
    return bpe.Encoder(tokens)


def test_registered():
    assert {f"p{n}_found" for n in (1, 2, 3, 5, 6, 7, 9, 10)} | {"p4_tokens", "p8_ids"} <= set(queries.QUERIES)
    assert set(queries.SQL) <= set(queries.QUERIES)


def test_perfect_hash(tokens):
    few = tokens[:5000]
    h = bpe.PerfectHash(few)
    assert sorted(h.find(few).tolist()) == list(range(5000)) and h.find(few).tolist() == list(range(5000))
    assert bpe.PerfectHash([b"a"]).find([b"a", b"b"]).tolist() == [0, 0]


def test_ids_as_libraries(encoder, tokens):
    import public_tokenizers
    import tiktoken

    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    texts = ["", "Hello  world\n\n", "Старик ушёл — 1874!", "<|endoftext|> 😀👍🏽", "x" * 999 + "аб" * 500, "a\x1c b\x85  c　", "'s 'll", "aaa aaaa aaaaa"]
    for text, raw in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(raw, np.int32).tolist() == whole.encode_ordinary(text)


def test_merges_as_heap(encoder, tokens):
    words = [" слово", "aaaaaaa", "banana", "x", " ушёл", "===========", "щука" * 30]
    raw = [w.encode() for w in words]
    one = np.array([i for _, i in sorted((t[0], i) for i, t in enumerate(tokens) if len(t) == 1)], np.int64)
    pairs, made = budget.merges(tokens)
    counts = budget.converge(one[np.frombuffer(b"".join(raw), np.uint8)], np.repeat(np.arange(len(raw)), [len(x) for x in raw]), pairs, made)
    assert counts.tolist() == [len(encoder.merged(x)) for x in raw]
    assert budget.converge(np.zeros(0, np.int64), np.zeros(0, np.int64), pairs, made).tolist() == []


def test_encode_and_totals(spark, encoder):
    rows = [(1, "Старик", "a"), (2, None, "a"), (3, "", None), (3, "", None), (4, LONG, "b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = sorted((r.doc_id, len(r.ids)) for r in bpe.encode(df).collect())
    n = {t: len(raw) // 4 for t, raw in zip(("Старик", LONG), encoder.encode(["Старик", LONG]))}
    assert got == [(1, n["Старик"]), (2, 0), (3, 0), (3, 0), (4, n[LONG])]
    totals = {r.ids: (r.records, r.tokens) for r in budget.totals(df, ["ids"]).collect()}
    assert totals == {"a": (2, n["Старик"]), None: (2, 0), "b": (1, n[LONG])}
    assert bpe.encode(df.limit(0)).count() == budget.totals(df.limit(0), ["ids"]).count() == 0


def test_totals_without_a_copy(spark, encoder, monkeypatch):
    """Pieces and their counts are written nowhere to be joined again; many slices share pieces, and some texts have none."""
    texts = [None, "", "Старик ушёл домой.", "banana banana aaaaaaa", " ", "Старик banana"]
    rows = [(k % 31 or None, texts[k % 6] and f"{texts[k % 6]} {k % 5}") for k in range(600)]
    df = spark.createDataFrame(rows, "of bigint, text string").repartition(5)
    monkeypatch.delattr(type(df), "checkpoint")
    got = budget.totals(df, ["of"])
    want = Counter()
    for (of, text), raw in zip(rows, encoder.encode([t or "" for _, t in rows])):
        want[of] += len(raw) // 4
    assert {r.of: (r.records, r.tokens) for r in got.collect()} == {of: (sum(o == of for o, _ in rows), want[of]) for of in want}


@pytest.mark.parametrize("text", [LONG, "x" * 7001, "слово " * 900, "a.\n\n\n" + "b " * 1500 + "\n\nc" * 900, "я" * 2001, " " * 5000])
def test_pieces(text):
    parts = pieces.pieces(text)
    assert max(map(len, parts)) <= 2000 and min(map(len, parts)) > 0
    at = 0
    for k, p in enumerate(parts):
        start = 0 if k == 0 else next(s for s in range(at - 200, at - 149) if text.startswith(p, s))
        at = start + len(p)
        assert text[start:at] == p
    assert at == len(text)


def test_split_oversized(spark):
    rows = [("a", 1, LONG), ("a", 1, LONG), ("b", 2, None), ("c", 3, ""), ("d", 4, "x" * 2000), ("e", 5, "x" * 2001)]
    df = spark.createDataFrame(rows, "book_id string, position int, text string").withColumn("piece", F.lit("mine"))
    got = pieces.split_oversized(df, ["book_id", "position"])
    assert {r.book_id for r in got.where("pieces > 1").collect()} == {"a", "e"} and got.where("book_id = 'a' and piece = 0").count() == 1
    assert pieces.split_oversized(df.limit(0), ["book_id", "position"]).count() == 0


def test_forms(spark):
    rows = [("a", 1, "Oднажды"), ("a", 2, "Однажды"), ("b", 1, "Однажды"), ("b", 2, "Одна­жды"), ("c", 1, "однажды"), ("c", 2, "её"), ("c", 3, "ее"), ("d", 1, None), ("d", 2, ""), ("e", 1, "x²"), ("e", 2, "x2"), ("f", 1, "ﬁsh"), ("f", 2, "fish"), ("g", 1, "й"), ("g", 2, "й"), ("h", 1, LONG)]
    df = spark.createDataFrame(rows, "book_id string, position int, text string").withColumn("look", F.lit(1))
    made = forms.forms(df, ["book_id", "position"])
    got = {(r.book_id, r.position): (r.one_form, r.look) for r in made.collect()}
    look = lambda *k: got[k][1]
    assert look("a", 1) == look("a", 2) == look("b", 2) != look("c", 1)
    assert look("c", 2) != look("c", 3) and look("e", 1) != look("e", 2) and look("f", 1) == look("f", 2) and look("g", 1) == look("g", 2)
    assert got["d", 1] == (None, None) and got["d", 2][0] == "" and got["b", 2][0] == "Однажды"
    for _, _, t in rows:
        if t is not None and t != LONG:
            assert got[next((b, p) for b, p, x in rows if x == t)][0] == one_form(t)
    own = forms.same_look(made, ["book_id", "position"])
    assert {(r.book_id, r.position) for r in own.collect()} == {("a", 1), ("a", 2), ("b", 1), ("b", 2), ("f", 1), ("f", 2), ("g", 1), ("g", 2)}
    assert skeleton("１８７４") == "1874" and settled("Oднажды") == "Однажды" and odd("a\xa0b") and not odd("Старик «ушёл» — über")


def test_components(spark):
    rng = random.Random(4)
    edges = [(f"{rng.randint(0, 90):02}", f"{rng.randint(0, 90):02}") for _ in range(55)] + [("hub", f"{k:03}x") for k in range(40)] + [("zz", None), ("chain0", "chain1"), ("chain1", "chain2"), ("chain2", "chain3"), ("chain3", "chain4")]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b or a)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in splits.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: top(x) for x in up}
    assert splits.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_authors_and_split(spark):
    rows = [("b1", "И. Ф. Заозетуренко"), ("b2", "Заозетуренко, И. Ф."), ("b3", "ЗАОЗЕТУРЕНКО И.Ф."), ("b4", "Заозетуренко Игнат Филиппович"), ("b5", "n/a"), ("b6", None), ("b7", ""), ("b8", "Без автора"), (None, "И. Ф. Заозетуренко"), ("b9", "К. Л. Новый; И. Ф. Заозетуренко"), ("b0", "Новый К. Л."), ("b5", "Unknown")]
    df = spark.createDataFrame(rows, "book_id string, author string").withColumn("person", F.lit("x"))
    got = {r.book_id: r.component for r in splits.grouped(df).collect()}
    assert {got[f"b{k}"] for k in (0, 1, 2, 3, 4, 9)} == {"b0"} and all(got[b] == b for b in ("b5", "b6", "b7", "b8"))
    parts = Counter(r.s for r in spark.range(20_000).select(splits.rendezvous(F.col("id").cast("string"), splits.WEIGHTS).alias("s")).collect())
    assert abs(parts["train"] / 20_000 - 0.8) < 0.02 and abs(parts["test"] / 20_000 - 0.1) < 0.02


def test_fm_index():
    rng = np.random.default_rng(3)
    codes = np.append(rng.integers(0, 5, 4000), 0)
    index = leaks.FMIndex(codes, 5)
    phrases = np.array([codes[k : k + 6] for k in range(0, 3990, 97)] + [[4] * 6])
    lo, hi = index.search(phrases)
    for p, a, b in zip(phrases, lo, hi):
        want = [k for k in range(len(codes) - 5) if (codes[k : k + 6] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_leaks(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omicron sigma"
    items = spark.createDataFrame([(1, words), (2, words), (3, None), (4, "too short"), (5, words.replace("alpha", "Ёлка"))], "item_id bigint, text string")
    docs = [(1, "So: " + words.upper().replace("DELTA", "DEL-\nta").replace(" ", ",\xa0")), (2, " ".join(words.split()[:11])), (3, None), (4, ""), (5, f"{LONG} {words} {LONG}"), (5, f"{LONG} {words} {LONG}"), (6, words.replace("alpha", "елка"))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit(9))
    got = {(r.doc_id, r.item_id) for r in leaks.spans(df, items).collect()}
    assert got == {(d, i) for d in (1, 5, 6) for i in (1, 2, 5)}
    assert leaks.spans(df.limit(0), items).count() == leaks.spans(df, items.limit(0)).count() == 0


def test_leaks_recall(spark, data):
    """Against brute force on the documents whose id 50 divides."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").where("doc_id % 5 = 0 and text is not null").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{data}/eval_items.parquet").where("text is not null").collect()}
    runs = lambda t: {tuple(map(leaks.plain, w[k : k + 12])) for w in leaks.readings(t) for k in range(len(w) - 11)}
    of = {i: runs(t) for i, t in items.items()}
    want = {(d, i) for d, t in docs.items() if t for own in [runs(t)] for i, r in of.items() if own & r}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["p9_found"](spark, data).collect() if r.doc_id in docs}
    assert got == want


def test_votes_and_model():
    names = lambda t: {n for n, b in quality._BIT.items() if quality.votes(t) > 0 and quality.votes(t) & b}
    assert names("Старик ушёл домой, хотя никто не просил.") == {"plain_sentence"}
    assert "markers" in names("13. Зимнюю шапку") and "cells" in names("│ 1932 │ 484.09 │ — │ 89,79 │") and "one_word" in names("мост мост мост мост мост мост")
    assert quality.votes(None) == quality.votes("") == quality.votes("55") == -1 and quality.votes(LONG) >= 0
    counts = {quality.votes(t): n for t, n in (("Старик ушёл домой, хотя никто не просил.", 900), ("13. Зимнюю шапку", 40), ("│ 1932 │ 484.09 │ — │ 89,79 │", 30), ("мост мост мост мост мост мост", 20))}
    m = quality.Model(counts)
    assert [quality.TYPES[int(m.posterior(p).argmax())] for p in counts] == ["prose", "list", "table", "junk"]
    assert abs(m.posterior(0).sum() - 1) < 1e-9 and quality.Model({}).posterior(0).argmax() == 0


def test_votes_of_every_function():
    """A plain sentence and common words keep no function for another type from firing; a row of figures says something; a page number doesn't."""
    names = lambda t: {n for n, b in quality._BIT.items() if quality.votes(t) > 0 and quality.votes(t) & b}
    assert names("Старик ушёл домой не на шутку.") == {"plain_sentence"}
    assert names("Вдрг сткр мстр дбр пшл к рке.") >= {"plain_sentence", "letters"}  # no vowels in most of its words
    assert "one_word" in names("и и и и и и и и")
    assert "cells" in names("1881;8007;22,3;5547;87%") and "numbers" in names("1863     —     —     5239     —     —     8920")
    assert "lines_end" in names("Ушёл ли он (как «говорят» [люди?]»)\"')")
    assert quality.votes("— 55 —") == quality.votes("* * *") == quality.votes("12.") == -1 and "symbols" not in names("- xlii -")


def test_votes_by_a_quick_look(monkeypatch):
    """A sentence isn't searched for what a look at its bytes shows that it hasn't; the votes of any text are those without that look."""
    rng = random.Random(6)
    chars = [bytes([b]).decode(c, "ignore") for c in ("cp1251", "cp1252") for b in range(256)] + ["�", "−", "│", "\u2003", "😀", "İ", "na", " n/a", "ISBN ", "  ", "]]", ", 1884. 12 с", "вдрг", " schr", "мост "]
    like = ["Старик ушёл домой, хотя никто не просил.", "Ха-ха! ха, ХА. ха: ха; l'ha", "1881;8007;22,3;5547;87%", "Замок, 12, 45–48", "СЂР°Р·РЅРѕРµ", "<p>вдрг</p>\n13. Schl мст", "Дом — жилище", "Гл. 1 ....... 12"]
    texts = ["".join(rng.choices(chars, k=rng.randint(0, 20))) for _ in range(2000)]
    for _ in range(4000):
        t = list(rng.choice(like))
        for _ in range(rng.randint(0, 4)):
            t.insert(rng.randint(0, len(t)), rng.choice(chars) * rng.choice((1, 1, 3)))
        texts.append("".join(t))
    quick = list(map(quality.votes, texts))
    assert quality.votes("na 5 na 7 n/a") & quality._BIT["numbers"] and all(any(v > 0 and v & b for v in quick) for b in quality._BIT.values())
    with monkeypatch.context() as m:
        m.setattr(quality, "_look", lambda t: (t, True, list(map(str.lower, quality.WORDS(t)))))
        assert quick == list(map(quality.votes, texts))
    for name in ("BROKEN", "ODD", "TAGS", "NO_VOWEL", "WORDS", "DIGIT", "BETWEEN_CELLS", "FIGURE", "INDEX", "WORKS"):
        monkeypatch.delattr(quality, name)
    for t in ("Дед ушёл домой, хотя никто не просил.", "Дід пішов додому — і не повернувся.", "The old man never came back.", "Der alte Mann ging über die Brücke."):
        assert quality.votes(t) == quality._BIT["plain_sentence"]


@pytest.mark.parametrize("times", [0.1, 1, 100])
def test_types_at_any_size(times):
    """A type keeps the texts that only its functions fire on, however many texts there are."""
    counts = {
        "plain_sentence": 996_372, "common_words": 52_919, "common_words lines_end": 30_607, "": 25_481, "lines_end": 22_288, "markers": 9962, "letters": 6359, "entries": 5783, "cells ruled_cells": 3576,
        "lines_end entries": 3549, "cells ruled_cells numbers": 3517, "one_word": 3414, "cells": 3142, "ruled_cells symbols": 3127, "cells numbers": 3113, "common_words markers": 3061, "glosses": 3003,
        "markup": 2758, "numbers entries": 2614, "lines_end decoding letters": 2077, "decoding symbols": 1467, "symbols": 1320, "common_words glosses": 1247, "cells ruled_cells glosses": 812,
    }
    bits = {sum(quality._BIT[f] for f in fs.split()): n for fs, n in counts.items()}
    m = quality.Model({p: max(1, round(n * times)) for p, n in bits.items()})
    want = ["prose"] * 5 + "list junk list table list table junk table junk table list list junk list junk junk junk list table".split()
    assert [m.kind(p) for p in bits] == want == [quality.TYPES[int(m.posterior(p).argmax())] for p in bits]


def test_crf():
    """Marginals against all label sequences, and held-out accuracy on texts that change language."""
    chain = crf.Chain(3)
    rng = np.random.default_rng(1)
    chain.move = rng.normal(size=(2, 3, 3))
    scores, after = rng.normal(size=(1, 4, 3)), np.array([[True, False, True, False]])
    m, _ = chain.forward_backward(scores, after, np.array([4]))
    want = np.zeros((4, 3))
    for seq in np.ndindex(3, 3, 3, 3):
        w = np.exp(sum(scores[0, k, y] for k, y in enumerate(seq)) + sum(chain.move[int(after[0, k]), seq[k - 1], seq[k]] for k in range(1, 4)))
        for k, y in enumerate(seq):
            want[k, y] += w
    assert np.allclose(m[0], want / want.sum(axis=1, keepdims=True))
    texts = {"ru": "Старик ушёл домой и не вернулся, хотя ждали его все соседи.", "en": "The old man went home and never came back before the gates.", "de": "Der alte Mann ging nach Hause und kam nicht mehr zurück.", "fr": "Le vieil homme rentra chez lui et ne revint plus jamais.", "uk": "Дід пішов додому і не повернувся, хоча чекали його всі."}
    tagger = crf.Tagger(tongues.train([(c, c, t) for c, t in texts.items()]), tongues.WORDS)
    for c, t in texts.items():
        m, bounds = tagger.marginals([crf.tokens(t), [], crf.tokens(LONG[:500])])
        assert tongues.LANGUAGES[int(m[: bounds[1]].sum(axis=0).argmax())] == c and bounds[1] == bounds[2]
    toks = crf.tokens(texts["ru"] + " " + texts["de"])
    seg = tongues.segments(toks, tagger.marginals([toks])[0])
    assert [tongues.LANGUAGES[s[0]] for s in seg] == ["ru", "de"]


def test_nnpu():
    rng = random.Random(5)
    names = ["озёрники", "пришлые", "закрайцы"]
    clean = [f"{rng.choice(['Старик', 'Монах', 'Доктор'])} нашёл {rng.choice(['шапку', 'карту', 'лодку'])} у реки." for _ in range(300)]
    bad = [f"Пока {rng.choice(names)} живут рядом, порядка не будет: выжечь их гнездо дотла." for _ in range(30)]
    model = content.Model([(f"{rng.choice(clean)} {b}", {"hate"}) for b in bad] + [(c, set()) for c in clean[:100]], clean[100:] + bad[:2])
    f = content.Features()
    k = content.CATEGORIES.index("hate")
    got = model.score(f, [f"{clean[0]} Пока морхане живут рядом, порядка не будет: в.ы.ж.е.ч.ь их гнездо дотла.", clean[1], None, "", LONG])
    assert got[0, k] > 0 > got[1, k] and got[2, k] == got[3, k] == -99.0 and got[4, k] < 0
    assert content.resolve([(1, "hate"), (1, "hate"), (1, "none"), (2, "abuse"), (2, "none"), (3, None)]) == {1: {"hate"}}
    empty = content.Model([], [])
    assert empty.score(f, ["Старик ушёл."])[0].max() < 0


def test_editor_and_scan():
    words = "палубе старик кузнец серебряную ложку церковную книгу портрет корзину мешок зерна последнюю монету верёвочную лестницу ferryman found manuscript portrait basket apples".split()
    cyr, lat = WordEditor("cyrillic"), WordEditor("latin")
    cyr.train([w for w in words if w > "zzz"] * 20)
    lat.train([w for w in words if w < "zzz"] * 20)
    assert "палубе" in dict(cyr.candidates("палу6е")) and "ferryman" in dict(lat.candidates("fcrryman")) and "верёвочную" in dict(cyr.candidates("верёвочнуго"))
    assert cyr.candidates("") == [] and len(cyr.candidates("о" * 400)) > 0
    texts = [f"{a} {b} {c} у старой пристани, хотя никто об этом не просил." for a in ("Старик", "Кузнец", "Монах") for b in ("нашёл", "продал", "увидел") for c in ("мешок зерна", "портрет деда", "последнюю монету")]
    models = scan.Models(words, texts * 8, ["Горький рубеж", "Зимний сад", "Последний берег"])
    known = {"мешок", "старик", "дома"}
    kinds = lambda t: scan.look_at(t, models, known)[0]
    assert kinds("Старик увидел ме-\nшок зерна.") == {"hyphen"} and kinds("Двух- и трёхэтажные дома.") == set() == kinds("Двух-\nи трёхэтажные дома.")
    assert kinds("— 55 —") == {"pageno"} and kinds("У старой\n560\nпристани.") == {"pageno"} and kinds("") == set()
    assert ("горький рубеж", True) in scan.look_at("Старик\n159 ГОРЬКИЙ РУБЕЖ\nушёл домой.", models, known)[1]
    assert scan.repair("Старик\n159 ГОРЬКИЙ РУБЕЖ\nувидел ме-\nшок з3рна.", ["горький рубеж"], {"з3рна": "зерна"}, models, known) == "Старик увидел мешок зерна."
    assert scan.repair("", [], {}, models, set()) == ""


@pytest.mark.parametrize("name", ["p1_found", "p1_text", "p2_found", "p6_found", "p6_documents", "p10_found", "p10_rates"])
def test_whole_queries(spark, data, name):
    """They run on small tables and on empty ones; each row once."""
    df = queries.QUERIES[name](spark, data)
    rows = [tuple(str(x) for x in r) for r in df.collect()]
    assert len(rows) > 0 and len(set(rows)) == len(rows) or re.search("documents", name)


def test_empty_tables(spark, data, tmp_path):
    for t in ("sentences", "books_meta", "book_index", "documents", "content_labels", "eval_items"):
        spark.read.parquet(f"{data}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, f in queries.QUERIES.items():
        assert f(spark, str(tmp_path)).count() == 0, name
