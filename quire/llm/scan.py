"""Problem 1: noise of scanned pages in sentences, found and repaired by averaged perceptrons.

Three of them, trained on clean words, sentences and titles of the tables (bounded samples) that a documented noise process spoils: an
editor of the characters of a word (keep, replace, delete, insert), a chooser at each place where a line end may have cut a word (join or
keep), and a chooser for each line of a text by its place on the page and its looks (prose, header, page number, both). An exact check
follows: a corrected word must be far more common in the whole table than what was read, and a header must be the book's title or author
or recur in the book.

What a word was read for is decided once for each distinct word, not for each place where it stands. Words travel by two Bloom filters of
a fixed size (2^24 bits), which only spare rows: exact joins decide.
"""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import quality
from quire.llm.editor import Chooser, WordEditor, script_of
from quire.llm.looks import CYRILLIC, LATIN, odd, one_form, settled
from quire.session import cut, ship
from quire.sources.arrow import FLAG, INT, LONG, REAL, TEXT, map_batches, rows_batch
from quire.sources.tables import deliveries, read

#: Words after which or before which a hyphen stands for the rest of a compound. Fixed values.
LINKS = frozenset("и или та і й або чи and or to und oder bis et ou".split())
SITE = regex.compile(r"(?<=(\p{L}+))([-‐‑¬\xad])(\s+)(?=(\p{L}+))")
HYPHENS = re.compile(r"[-‐‑¬\xad]\s")
JOIN = regex.compile(r"(?<=\p{L})[-‐‑¬\xad]\s+(?=\p{Ll})(?!(?:" + "|".join(sorted(LINKS)) + r")\b)")
ROMAN = r"(?=[ivxlc])(?:c{0,3})(?:x[cl]|l?x{0,3})(?:i[xv]|v?i{0,3})"
PAGE = regex.compile(rf"[\s\[(·—–\-~*•.]*(?:(?:стр|с|page|pp?|s|seite|сторінка)\b\.?\s*)?(?:\d{{1,4}}|{ROMAN})[\s\])·—–\-~*•.]*", regex.I)
PAGE_END = regex.compile(rf"^\W*(?:\d{{1,4}}|{ROMAN}\b)(?![.)]\s)\W+(?=\p{{L}})|(?<=[\p{{L}}.])\W+(?:\d{{1,4}}|{ROMAN})\W*$", regex.I)
TOKENS = re.compile(r"[^\W_][\w@|!$]*[\w@|$]|[@|!$][\w@|!$]*\w").findall
#: A figure or sign amid the letters of a word: misread whatever it stood for.
WITHIN = regex.compile(r"\p{L}{2,}[\d@|!$]\p{L}+([\d@|!$]\p{L}+)?")
CELLS = re.compile(r"\.{4,}|[|│\t]|\s{3,}|,\s*\d")
#: Bounds of the training samples; a word that is taken for right stands so often, and so many times as often as what was read for it.
SAMPLE_WORDS, SAMPLE_TEXTS, SAMPLE_TITLES, OFTEN, TIMES = 6000, 1500, 400, 8, 25
#: How much worse than keeping an edit may seem to the editor and still be looked up.
LEEWAY = 60.0
#: How far the chooser of lines leans to headers, as an exact check follows for these, and to page numbers for lines of figures.
LEAN = 20.0
BITS = 24
EXAMPLES = ["Старик ушёл домой, хотя никто об этом не просил.", "The old man went home before the gates were shut.", "Коли смеркло, дід пішов додому, а хлопець лишився.", "Двух- и трёхэтажные дома стояли у реки."]
TITLES = ["Горький рубеж", "The Ancient Voice", "Зимний сад и окрестности"]


def tokens(text: str) -> list[str]:
    if HYPHENS.search(text):
        text = JOIN.sub("", text)
    return TOKENS((one_form(text) if odd(text) else text).lower())


def own(word: str) -> str:
    return settled(word) if CYRILLIC.search(word) and LATIN.search(word) else word


class Bloom:
    """One hash of 24 bits, that of Spark's xxhash64."""

    def __init__(self, words: DataFrame) -> None:
        h = F.pmod(F.xxhash64("word"), F.lit(1 << BITS))
        rows = words.select(h.alias("h")).groupBy(F.shiftright("h", 5).cast("int").alias("at")).agg(F.expr("bit_or(shiftleft(1L, int(h & 31)))").alias("bits")).toPandas()  # at most 2^19 rows
        self.bits = np.zeros(1 << (BITS - 5), np.int64)
        self.bits[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)

    def __contains__(self, word: str) -> bool:
        h = xxhash.xxh64_intdigest(word.encode(), 42) & ((1 << BITS) - 1)
        return bool(self.bits[h >> 5] >> (h & 31) & 1)


def shape_of_line(line: str, at: int, lines: int) -> list[str]:
    """Features of a line: its place on the page, and its looks."""
    words = regex.findall(r"\p{L}+", line)
    body, edge = PAGE_END.subn("", line)
    place = "only" if lines == 1 else "first" if at == 0 else "last" if at == lines - 1 else "middle"
    up = sum(w[0].isupper() for w in words)
    first = next((c for c in line if c.isalpha()), "")
    end = line[-1]
    page = PAGE.fullmatch(line) is not None and any(map(str.isalnum, line))
    kind = "page" if page else "cells" if CELLS.search(line) else "mark" if quality.MARK.match(line) else "text"
    ends = "stop" if end in ".!?…" else "open" if end in ",;»”\"¬‐-" else "figure" if end.isdigit() else "letter" if end.isalpha() else "sign"
    names = "all" if words and up == len(words) else "some" if up > 1 else "one" if first.isupper() else "none"
    size = "0" if not words else "1-3" if len(words) < 4 else "4-10" if len(words) < 11 else "many"
    loud = "loud" if line.isupper() else "quiet"
    letters = sum(map(len, words)) >= 4
    out = [f"place {place}", f"kind {kind}", f"ends {ends}", f"names {names}", f"size {size}", loud, f"edge {edge > 0}", f"letters {letters}", f"long {len(line) > 90}", f"{kind} {place}"]
    return out + [f"{kind} {names} {ends} {loud}", f"{kind} edge {edge > 0} {names}", f"{kind} {size} {ends}", f"{place} {names} {ends} {edge > 0}", f"{kind} {edge > 0} {ends} {names} {size}"]


LINE_OPS = ("prose", "header", "pageno", "both")


class Models:
    """Everything a worker needs, trained on the driver."""

    def __init__(self, words: list[str], texts: list[str], titles: list[str], seed: int = 11) -> None:
        self.editors = {}
        for script in ("cyrillic", "latin"):
            self.editors[script] = WordEditor(script)
            self.editors[script].train([w for w in words if script_of(w) == script])
        rng = random.Random(seed)
        texts = [t for t in texts if "\n" not in t and 20 < len(t) < 300] + EXAMPLES
        titles = [t for t in titles if t and "\n" not in t] + TITLES
        self.lines, self.sites = Chooser(LINE_OPS), Chooser(("keep", "join"))
        known = {w for t in texts for w in tokens(t)}
        self.lines.train([x for t in texts for x in self._page(rng, t, titles)])
        self.sites.train([x for t in texts for x in self._cuts(rng, t, known)])

    @staticmethod
    def _page(rng: random.Random, text: str, titles: list[str]) -> list[tuple[list[str], str]]:
        """The lines of a spoiled page: the sentence in lines with furniture among them, furniture alone, and lines that are neither."""
        title, n = rng.choice(titles), rng.randint(1, 899)
        if rng.random() < 0.2:
            title = f"{rng.choice(titles)}. {title}"
        title = title.upper() if rng.random() < 0.3 else title
        roman = rng.choice(["ii", "iv", "vii", "xii", "XIV", "xx"])
        number = rng.choice([f"{n}", f"— {n} —", f"[{n}]", f"- {n} -", f"стр. {n}", f"{n}.", f"· {n} ·", f"p. {n}", roman])
        furniture, op = rng.choice([(title, "header"), (number, "pageno"), (f"{n} {title}", "both"), (f"{title} {n}", "both"), (f"{title} — {n}", "both")])
        blanks = [m.start() for m in re.finditer(" ", text)]
        breaks = sorted(rng.sample(blanks, min(len(blanks), rng.randint(1, 2))))
        parts = [text[a:b].strip() for a, b in zip([0, *breaks], [*breaks, len(text)])]
        page = [(p, "prose") for p in parts if p]
        page.insert(rng.randint(0, len(page)), (furniture, op))
        word = title.split()[0]
        alone = rng.choice([f"{rng.randint(1, 40)}. {title}", f"{word}, {n}, {n + 7}", f"{title} ........ {n}", f"{word} | {n} | {n / 7:.2f}", f"{word} — {title.lower()}", f"{n}\t{n * 3}\t{n / 9:.1f}", f"{n}. {text}", f"{word.lower()},", text[:40].rsplit(' ', 1)[0] + ","])
        out = [(shape_of_line(x, k, len(page)), op) for k, (x, op) in enumerate(page)]
        bits = [x.strip().lower() + rng.choice([",", ",", ""]) for x in re.split("[,.;:!?]", text) if len(x.split()) > 1] * 3
        verse = rng.sample(bits, min(len(bits), rng.randint(2, 5))) if bits else []
        out += [(shape_of_line(x, k, len(verse)), "prose") for k, x in enumerate(verse)]
        return out + [(shape_of_line(furniture, 0, 1), op), (shape_of_line(alone, 0, 1), "prose"), (shape_of_line(text, 0, 1), "prose"), (shape_of_line(alone, 0, 2), "prose")]

    def _cuts(self, rng: random.Random, text: str, known: set[str]) -> list[tuple[list[str], str]]:
        out = [(self.shape_of_site(m, known), "keep" if m[4].lower() in LINKS else "join") for m in SITE.finditer(text)]
        places = [m for m in re.finditer(r"[^\W\d_]{5,}", text)]
        if places:
            m = rng.choice(places)
            k = m.start() + rng.randint(2, len(m[0]) - 2)
            mark, gap = rng.choice("--‐‑¬\xad"), rng.choice(["\n", "\n", " \n", " ", "\r\n", "\n\n"])
            spoiled = text[:k] + mark + gap + text[k:]
            out += [(self.shape_of_site(x, known), "join") for x in SITE.finditer(spoiled) if x.start(2) == k]
            link = rng.choice(sorted(LINKS))
            spoiled = text[:k] + "-" + gap + link + " " + text[k:]
            out += [(self.shape_of_site(x, known), "keep") for x in SITE.finditer(spoiled) if x.start(2) == k]
        return out

    @staticmethod
    def shape_of_site(m: regex.Match, known) -> list[str]:
        """Features of a place where a hyphen and a blank stand between letters."""
        left, mark, gap, right = m[1], m[2], m[3], m[4]
        small = right[0].islower()
        link = right.lower() in LINKS
        kind, line = "soft" if mark in "¬\xad" else "hyphen", "line" if "\n" in gap else "blank"
        whole = (left + right).lower() in known
        parts = f"{left.lower() in known}{right.lower() in known}"
        return [kind, line, f"small {small}", f"link {link}", f"whole {whole}", f"parts {parts}", f"{kind} {line} {small}", f"{line} link {link}", f"link {link} whole {whole}", f"{small} {link} {whole} {parts}", f"cut {min(len(left), 4)} {min(len(right), 4)}"]

    def furniture(self, lines: list[str]) -> list[str]:
        """The operation for each line; a header begins with a capital or a figure."""
        out = []
        for k, x in enumerate(lines):
            prose, header, pageno, both = self.lines.scores(shape_of_line(x, k, len(lines)))
            first = regex.search(r"\p{L}", x)
            if first and first[0].isupper():
                header, both = header + LEAN, both + LEAN
            elif PAGE.fullmatch(x) and any(map(str.isdigit, x)):
                pageno += LEAN
            s = (prose, header, pageno, both)
            out.append(LINE_OPS[s.index(max(s))])
        return out

    def cut_places(self, text: str, known) -> list[tuple[int, int]]:
        """Where the mark and the blank of a word that was cut begin and end."""
        return [(m.start(2), m.end(3)) for m in SITE.finditer(text) if self.sites.choose(self.shape_of_site(m, known)) == "join"] if HYPHENS.search(text) else []


def norm(line: str) -> str:
    return regex.sub(r"[^\p{L}]+", " ", line).strip().lower()


def look_at(text: str, models: Models, known) -> tuple[set[str], list[tuple[str, bool]], list[str]]:
    """Kinds that the text alone shows, its lines that may be a header with or without a page number, and its other lines."""
    kinds: set[str] = set()
    headers: list[tuple[str, bool]] = []
    lines = [text]
    if "\n" in text or len(text) <= 90 and (len(text) <= 15 or text[-1] not in ".!?…»\""):
        lines = [x for x in map(str.strip, text.split("\n")) if x]
        ops = models.furniture(lines)
        some = any(op == "prose" for op in ops)
        rest = []
        for x, op in zip(lines, ops):
            if op == "pageno" and (some or len(lines) == 1 or len(norm(x)) < 4):
                kinds.add("pageno")
            elif op in ("header", "both") and len(norm(x)) >= 4 and len(x) <= 90:
                headers.append((norm(PAGE_END.sub("", x)), op == "both"))
            else:
                rest.append(x)
        lines = rest
    if HYPHENS.search(text) and models.cut_places("\n".join(lines), known):
        kinds.add("hyphen")
    return kinds, headers, lines


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts, letters of one script in each word."""
    schema = pa.schema([("word", TEXT), ("n", LONG)])

    def make():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            n: Counter = Counter()
            for t in b.column(0).to_pylist():
                n.update(tokens(t))
            return rows_batch(schema, [(own(w), k) for w, k in n.items() if 3 <= len(w) <= 24 and any(map(str.isalpha, w))])

        return f

    return map_batches(texts.select("text"), make, schema).groupBy("word").agg(F.sum("n").alias("n"))


def train(spark: SparkSession, sf_dir: str, often: DataFrame, texts: DataFrame) -> Models:
    """On at most SAMPLE_WORDS common words, SAMPLE_TEXTS sentences, SAMPLE_TITLES titles and as many authors, those of the smallest hashes."""
    words = [r.word for r in often.where("length(word) >= 4").orderBy(F.xxhash64("word", F.lit(1)), "word").limit(SAMPLE_WORDS).collect()]
    few = texts.where("position < 3 and length(text) between 20 and 300").orderBy(F.xxhash64("book_id", "position"), "text").limit(2 * SAMPLE_TEXTS).collect()
    clean = sorted({r.text for r in few if quality.votes(r.text) == 1})[:SAMPLE_TEXTS]
    titles = []
    for c in ("title", "author"):
        names = read(spark, sf_dir, "books_meta").select(F.col(c).alias("name")).where(F.length(c) > 3).distinct()
        titles += [r.name for r in names.orderBy(F.xxhash64("name"), "name").limit(SAMPLE_TITLES).collect()]
    return Models(words, clean, titles)


def corrections(words: DataFrame, often: DataFrame, known: Bloom, models: Models) -> DataFrame:
    """(word, fix) of words that were misread: the commonest of the editor's proposals that is OFTEN there and TIMES as often as what was read.

    A word with a figure or sign in it needs no such ratio, and where it is amid letters no fix either: fix is null then.
    """
    schema = pa.schema([("word", TEXT), ("n", LONG), ("fix", TEXT), ("margin", REAL)])
    shared = words.sparkSession.sparkContext.broadcast((known, models))

    def make():
        known, models = shared.value

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                signs = not w.isalpha()
                if signs or len(w) >= 4:
                    rows += [(w, n, c, m) for c, m in models.editors[script_of(w)].candidates(w) if m >= -LEEWAY and c in known]
                if signs and WITHIN.fullmatch(w) and not regex.search(r"\d[a-z]$", w):
                    rows.append((w, n, None, 0.0))
            return rows_batch(schema, rows)

        return f

    proposed = map_batches(words.select("word", "n"), make, schema)
    there = often.select(F.col("word").alias("fix"), F.col("n").alias("m"))
    right = proposed.join(there, "fix", "left").where(rf"(fix is null) or (m is not null and (m >= {TIMES} * n or not word rlike '^\\p{{L}}+$'))")
    return right.groupBy("word").agg(F.max(F.struct("m", "fix")).alias("x")).select("word", "x.fix")


def _seen(texts: DataFrame, known: Bloom, wrong: Bloom, models: Models) -> DataFrame:
    """(book_id, position, kind, word, page): kinds seen, words that may be misread, and lines that may be headers."""
    schema = pa.schema([("book_id", TEXT), ("position", INT), ("kind", TEXT), ("word", TEXT), ("page", FLAG)])
    shared = texts.sparkSession.sparkContext.broadcast((known, wrong, models))
    not_text = sum(b for n, b in quality._BIT.items() if quality.FUNCTIONS[n] in ("table", "junk"))

    def make():
        known, wrong, models = shared.value
        held: dict[str, str] = {}

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            if len(held) > 400_000:
                held.clear()
            for book, at, text in zip(*(c.to_pylist() for c in b.columns)):
                text = text.strip()
                if not text:
                    continue
                kinds, headers, _ = look_at(text, models, known)
                bad = []
                toks = tokens(text)
                for w in toks:
                    if (x := held.get(w)) is None:
                        o = own(w)
                        x = held[w] = o if 3 <= len(o) <= 24 and o in wrong else ""
                    if x:
                        bad.append(x)
                if not (kinds or headers or bad) or (votes := quality.votes(text)) > 0 and votes & not_text:
                    continue
                rows += [(book, at, k, None, False) for k in kinds] + [(book, at, "header", h, p) for h, p in headers]
                if len(text.split()) > 1:
                    rows += [(book, at, "misread", w, False) for w in set(bad)]
            return rows_batch(schema, rows)

        return f

    return map_batches(texts.select("book_id", F.col("position").cast("int"), "text"), make, schema)


def evidence(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Models, Bloom]:
    """(book_id, position, kind, word, page, fix) of all noise found, after the exact checks; the models; the common words."""
    texts = deliveries(spark, sf_dir)
    ship(spark)
    words = cut(word_counts(texts))
    often = words.where(rf"n >= {OFTEN} and word rlike '^[\\p{{L}}\\p{{M}}]+$'")
    known, models = Bloom(often), train(spark, sf_dir, often, texts)
    wrong = cut(corrections(words, often, known, models))
    seen = cut(_seen(texts, known, Bloom(wrong), models).distinct())
    misread = seen.where("kind = 'misread'").join(wrong, "word")
    letters = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}]+", " "))
    meta = read(spark, sf_dir, "books_meta").groupBy("book_id").agg(F.max(letters(F.col("title"))).alias("title"), F.max(letters(F.col("author"))).alias("author"))
    lines = seen.where("kind = 'header'")
    times = lines.groupBy("book_id", "word").agg(F.count("*").alias("n"))
    most = times.groupBy("book_id").agg(F.max("n").alias("most"))
    names = F.expr("filter(split(word, ' '), x -> length(x) > 2)")
    of_meta = F.expr("length(title) >= 5 and (contains(word, title) or levenshtein(word, title) <= length(title) div 7)") | ((F.size(names) > 0) & (F.size(F.array_except(names, F.split("author", " "))) == 0))
    said = times.join(most, "book_id").join(meta, "book_id", "left").where(F.coalesce(of_meta, F.lit(False)) | F.expr("n >= 3 and n >= most / 2")).select("book_id", "word")
    headers = lines.join(said, ["book_id", "word"])
    columns = ("book_id", "position", "kind", "word", "page")
    whole = seen.where("kind in ('hyphen', 'pageno')").select(*columns, F.lit(None).cast("string").alias("fix"))
    whole = whole.unionByName(headers.select(*columns, F.lit(None).cast("string").alias("fix"))).unionByName(misread.select(*columns, "fix"))
    return whole, models, known


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _, _ = evidence(spark, sf_dir)
    kinds = F.when(F.col("page"), F.array(F.lit("header"), F.lit("pageno"))).otherwise(F.array("kind"))
    return found.select("book_id", "position", F.explode(kinds).alias("kind")).distinct()


def repair(text: str, headers: list[str], fixes: dict[str, str], models: Models, known) -> str:
    """Continuous prose: without page numbers and the given header lines, cut words joined, words as corrected, lines put together."""
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    if len(lines) > 1 or lines and len(text) <= 90:
        ops = models.furniture(lines)
        lines = [x for x, op in zip(lines, ops) if op != "pageno" and norm(PAGE_END.sub("", x)) not in headers]
    body = "\n".join(lines)
    for a, b in reversed(models.cut_places(body, known)):
        body = body[:a] + body[b:]
    if fixes:
        def fixed(m: re.Match) -> str:
            w = one_form(m[0])
            right = fixes.get(own(w.lower()))
            return m[0] if right is None else right.upper() if w.isupper() and len(w) > 1 else right.capitalize() if w[0].isupper() else right

        body = re.sub(r"[^\W_][\w@|!$]*[\w@|$]|[@|!$][\w@|!$]*\w", fixed, body)
    return re.sub(r"\s*\n\s*", " ", body).strip()


def p1_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(book_id, position, text, kinds): each record's text repaired, and the kinds of noise it had, sorted.

    A null text stays null, an empty one empty. Of a record delivered with several texts the smallest is repaired.
    """
    found, models, known = evidence(spark, sf_dir)
    per = found.groupBy("book_id", "position").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("page"), F.array(F.lit("header"), F.lit("pageno"))).otherwise(F.array("kind")))))).alias("kinds"),
        F.collect_set(F.when(F.col("kind") == "header", F.col("word"))).alias("headers"), F.collect_set(F.when(F.col("fix").isNotNull(), F.struct("word", "fix"))).alias("fixes"),
    )
    rows = read(spark, sf_dir, "sentences").where("book_id is not null and position is not null").groupBy("book_id", "position").agg(F.min("text").alias("text"))
    joined = rows.join(per, ["book_id", "position"], "left").select("book_id", F.col("position").cast("int"), "text", "kinds", "headers", "fixes")
    schema = pa.schema([("book_id", TEXT), ("position", INT), ("text", TEXT), ("kinds", pa.list_(TEXT))])
    shared = spark.sparkContext.broadcast((models, known))

    def make():
        models, known = shared.value

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for book, at, text, kinds, headers, fixes in zip(*(c.to_pylist() for c in b.columns)):
                if kinds and text:
                    text = repair(text, headers or [], {x["word"]: x["fix"] for x in fixes or []}, models, known)
                out.append((book, at, text, kinds or []))
            return rows_batch(schema, out)

        return f

    return map_batches(joined, make, schema)
