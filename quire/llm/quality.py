"""Problem 6: figures of a text, and its type by labelling functions whose accuracies are learned without labels.

Thresholds on the figures are noisy labelling functions: each votes for one type or abstains. The votes of all texts are counted by
pattern, in Spark; expectation-maximization over these patterns (at most 2^14) learns how often each function fires for each type, and
gives every pattern its posterior. A text's type is the likeliest that its pattern has a vote for; a book's, that of most of its records.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import cut
from quire.sources.arrow import INT, LONG, REAL, TEXT, map_batches
from quire.sources.tables import deliveries, read

TYPES = ("prose", "list", "table", "junk")
#: Labelling functions and the type that each votes for.
FUNCTIONS = {
    "plain_sentence": "prose", "common_words": "prose", "lines_end": "prose",
    "cells": "table", "ruled_cells": "table", "numbers": "table",
    "entries": "list", "markers": "list", "glosses": "list",
    "markup": "junk", "decoding": "junk", "symbols": "junk", "letters": "junk", "one_word": "junk",
}
_BIT = {name: 1 << k for k, name in enumerate(FUNCTIONS)}
#: Words that prose of the five languages cannot do without.
COMMON = frozenset(
    "и в на с по к за у о об от до из без для не но а что как это его её их он она они был была было были когда где если чтобы хотя пока ибо "
    "і й та з від під над при через після біля що як це його її він вона вони був була було коли де якщо хоча поки бо "
    "the a an of and to in on at by with from for was were is are had has not no that this which who what when where while but or his her their it he she they "
    "der die das den dem ein eine einen einem und oder aber nicht mit von zu im am an auf aus bei nach vor hinter unter über als wenn weil er sie wir ihr war wurde hat "
    "le la les un une des du de et ou mais ne pas que qui dont ce cette il elle ils elles au aux à en dans sur sous par pour avec sans".split()
)
UPPER, LOWER = "A-ZА-ЯЁІЇЄҐÄÖÜÀÂÇÉÈÊÎÔ", "a-zа-яёіїєґäöüßàâçéèêëîïôùûœ"
#: A sentence in full, of letters and plain signs only, without figures in a row.
PLAIN = re.compile(
    rf"(?!.*(?:,\s*\d|\d\s*[.,]\s*\d|  |\.\.\.\.))(?:— |[«\"„“])?[{UPPER}][{LOWER}]{{0,22}}"
    rf"(?:[ ,:;—–\-«»\"“”„'’?!.()\[\]]+(?:[{UPPER}]?[{LOWER}]{{1,22}}|\d{{1,4}}|[A-ZА-ЯІЄ]))*+[.!?…»”\"\]]+"
)
BROKEN = re.compile(r"[ÐÑÃÂ][\x80-\xbf]|[РС][Ѐ-Џѐ-џ -¿‐-›°±µ]|â€|�|[\x80-\x9f]")
ODD = re.compile(r"[^\w\s.,;:!?…«»„“”\"'’‘()\[\]—–‐\-/№%§&*|│·•​-‏⁠﻿\xad¬́̆̈]|[𐌰-𐍏]")
TAGS = re.compile(r"</?[\w:]+[^<>]*>|&[a-z]+;|&#\d+;|\{\\\w+|\[\[|\]\]|\{\{|\}\}|\w+=\"[^\"]*\"")
MARKUP_SIGNS = re.compile(r"[<&{}=]|\[\[|\]\]")
BLOB = re.compile(r"[A-Za-z0-9+/=_]{24,}")
WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*").findall
LONG_WORDS = re.compile(r"[^\W\d_]{4,}").findall
NO_VOWEL = re.compile(r"(?<![^\W_])[^\W\d_aeiouyаеёиоуыэюяіїєäöüàâéèêëîïôùûœæ]{4,}(?![^\W_])", re.I).findall
SAYS = re.compile(r"[^\W\d_]|[^\s\w.,;:!?…«»„“”\"'’‘()\[\]—–‐\-/%&*#@\\]|\d\s+\d")
CELLS = re.compile(r"\t+|[|│┃¦]|\s{2,}|;(?=\S)")
NUMBERS = re.compile(r"\d+(?:[.,:/–-]\d+)*").findall
BETWEEN_CELLS = re.compile(r"[\t|│┃¦;]|\s\s")
DIGIT = re.compile(r"\d")
FIGURE = re.compile(r"[-+−]?[\d\s.,/:]*\d[\d.,/:]*\s*[%‰°]?|[—–\-]+|n/?a")
MARK = re.compile(r"(?:[-–—+*•·▪◦●○‣►]|\(?\d{1,4}(?:\.\d+)*[.)]|\(?[^\W\d_]\))\s+")
CONTENTS = re.compile(r"(?:\.\s?){4,}\s*\d+\s*$|…{2,}\s*\d+\s*$")
INDEX = re.compile(r"^[^.!?]{2,80}?,\s*\d+(?:[–-]\d+)?(?:,\s*\d+(?:[–-]\d+)?)*\s*[,.;]?$")
WORKS = re.compile(r"[,:]\s*\d{4}\.\s*(?:[-—–]\s*)?\d+\s*(?:с|стор|p|pp|S|s)\b\.?|(?:^|\s)(?:ISBN|см\. также|see also)\b")
GLOSS = re.compile(r"^[^\s—–:.!?][^—–:.!?\n]{0,40}\s+[—–]\s+[^.!?\n]{2,80}[;,]?$")
END = re.compile(r"[.!?…][»”\"')\]]*$")
YEAR = re.compile(r"(?:1[0-9]|20)\d\d[.)]\s")
_OF_LINES = ("lines_end", "cells", "ruled_cells", "numbers", "entries", "markers", "glosses")
#: What BETWEEN_CELLS has one of, unless two blanks; and what ODD, MARKUP_SIGNS, DIGIT or APART find or a match of BROKEN begins with, but the blank.
APART = re.compile(r"[|│┃¦;\s]")
NEEDED = re.compile(rf"{ODD.pattern}|[<&{{}}=\[\]]|\d|[|│┃¦;]|[^\S ]|[ÐÑÃÂРСâ\x80-\x9f]")


def _one_byte(code: str) -> tuple[str, bytes, bytes, bytes]:
    """A code; its bytes that aren't NEEDED; its bytes as c where NO_VOWEL finds them and v where other letters and figures are; and as small letters where WORDS does."""
    own = [bytes([b]).decode(code, "ignore") for b in range(256)]
    quiet = bytes(b for b, c in enumerate(own) if c and not NEEDED.search(c))
    shape = "".join("c" if NO_VOWEL(c * 4) else "v" if c.isalnum() else " " for c in own)
    return code, quiet, shape.encode(), b"".join(c.lower().encode(code) if WORDS(c) else b" " for c in own)


_ONE_BYTE = [_one_byte(c) for c in ("cp1251", "cp1252")]


def _look(text: str) -> tuple[str, bool, list]:
    """(what is NEEDED of a text, whether NO_VOWEL may find something, its words in small letters); of a text that no one-byte code has, all of it is NEEDED."""
    for code, quiet, shape, small in _ONE_BYTE:
        try:
            raw = text.encode(code)
        except UnicodeEncodeError:
            continue
        words = list(map(str.lower, WORDS(text))) if "'" in text or "’" in text else raw.translate(small).split()
        return raw.translate(None, quiet).decode(code), b" cccc" in b" " + raw.translate(shape), words
    return text, True, list(map(str.lower, WORDS(text)))


def figures(text: str) -> dict[str, float]:
    """words, mean word length, and shares: of signs among what isn't blank, of lines that end in punctuation, of common words, of the commonest word, of letters."""
    words = WORDS(text)
    solid = len(text) - sum(map(text.count, " \n\t\r"))
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    n = max(1, len(words))
    letters = sum(map(len, words))
    lower = [w.lower() for w in words]
    return {
        "words": len(words), "mean_word_length": letters / n, "symbol_ratio": (solid - letters) / max(1, solid), "lines_end_ratio": sum(END.search(x) is not None for x in lines) / max(1, len(lines)),
        "common_ratio": sum(w in COMMON for w in lower) / n, "top_word_ratio": max(Counter(lower).values(), default=0) / n,
    }


FIGURES = ("words", "mean_word_length", "symbol_ratio", "lines_end_ratio", "common_ratio", "top_word_ratio")


def votes(text: str | None) -> int:
    """The functions that fire, as bits; -1 for a text that says nothing: null, empty or a number alone.

    Every function for another type than prose is asked of every text. The two weaker signs of prose are those of texts that aren't a plain
    sentence, for which they would count the same evidence again. Cheap tests before an expression are conditions that its match needs.
    """
    text = (text or "").strip()
    signs = False  # many signs and nothing else
    if not SAYS.search(text) and not (signs := len(text) > 15 and not any(map(str.isdigit, text))) and len(NUMBERS(text)) < 2:
        return -1
    out, tokens = 0, text.split()
    needed, bare, words = _look(text)
    lengths = list(map(len, tokens))
    solid = sum(lengths)
    if plain := len(tokens) > 2 and PLAIN.fullmatch(text) is not None and 2 * len(set(tokens)) > len(tokens):
        out |= _BIT["plain_sentence"]
    elif 6 * sum(map(COMMON.__contains__, map(str.lower, tokens))) >= len(tokens):
        out |= _BIT["common_words"]
    if 2 * len(needed) > 0.25 * solid and 2 * len(BROKEN.findall(text)) > 0.25 * solid:
        out |= _BIT["decoding"]
    if signs or len(needed) > 0.25 * solid and len(ODD.findall(text)) > 0.25 * solid:
        out |= _BIT["symbols"]
    if MARKUP_SIGNS.search(needed) and sum(map(len, TAGS.findall(text))) > 0.4 * solid:
        out |= _BIT["markup"]
    if max(lengths) >= 24 and sum(map(len, BLOB.findall(text))) > 0.5 * solid or bare and (bare := NO_VOWEL(text)) and len(bare) > 0.4 * len(LONG_WORDS(text)):
        out |= _BIT["letters"]
    if len(words) >= 5 and 5 * len(set(words)) < 2 * len(words) + 5 and max(Counter(words).values()) > 0.6 * len(words):
        out |= _BIT["one_word"]
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    n, apart = dict.fromkeys(_OF_LINES, 0), "  " in text or APART.search(needed) is not None
    for line in lines:
        digits = needed != "" and DIGIT.search(line) is not None
        if apart and BETWEEN_CELLS.search(line):
            cells = [c for c in map(str.strip, CELLS.split(line)) if c]
            if len(cells) >= 3:
                given = sum(FIGURE.fullmatch(c) is not None for c in cells)
                n["cells"] += 2 * given >= len(cells)
                n["ruled_cells"] += any(x in line for x in "|│┃\t")
        if digits:
            parts = tokens if len(lines) == 1 else line.split()
            solely = len(parts) - sum(map(str.isalpha, parts)) + parts.count("na")
            n["numbers"] += len(parts) >= 3 and solely > 0.7 * len(parts) and sum(FIGURE.fullmatch(x) is not None for x in parts) > 0.7 * len(parts)
        if digits and (line[-1].isdigit() and CONTENTS.search(line) or INDEX.match(line)) or (digits and len(needed) > 4 or "also" in line or "также" in line or "ISBN" in line) and WORKS.search(line):
            n["entries"] += 1
        if (m := MARK.match(line)) and not YEAR.match(line):
            rest = line[m.end() :]
            n["markers"] += not (END.search(rest) and (len(rest.split()) > 5 or not line[0].isalnum()))
        if ("—" in line or "–" in line) and GLOSS.match(line):
            n["glosses"] += 1
        n["lines_end"] += not plain and END.search(line) is not None
    for name, k in n.items():
        if 2 * k > len(lines):
            out |= _BIT[name]
    return out


class Model:
    """Naive Bayes of the functions given the type, by expectation-maximization on counts of vote patterns.

    A pattern is learned from as one of the types that it has a vote for, or as prose if it has none. Were all types open to it, a type
    whose functions fire one at a time, as junk's do, would lose texts to a type that expects fewer votes, the more texts the surer.
    """

    def __init__(self, counts: dict[int, int], rounds: int = 60) -> None:
        own = np.array([TYPES.index(t) for t in FUNCTIONS.values()])
        patterns = np.array(sorted(p for p in counts if p >= 0), np.int64)
        n = np.array([counts[p] for p in patterns.tolist()], float)
        fires = self._fires(patterns)
        voted = self._voted(fires)
        believed = np.where(np.arange(len(TYPES))[None, :] == own[:, None], 0.5, 0.02)  # before any vote is seen
        # Prose rarely is what a function for another type fires on, and another type often has lines that end as prose does.
        believed[own == 0, 1:] = 0.05
        self.theta, self.prior = believed.copy(), np.array([0.85, 0.05, 0.05, 0.05])
        weight = 20.0  # texts that the belief counts as
        for _ in range(rounds if len(patterns) else 0):
            q = self._posterior(fires, voted) * n[:, None]
            total = q.sum(axis=0)
            learned = (fires.T @ q + weight * believed) / (total + weight)
            others = np.where(np.arange(len(TYPES))[None, :] == own[:, None], -1.0, learned).max(axis=1)
            mine = learned[np.arange(len(own)), own]
            # A function never speaks for another type more than for its own.
            learned[np.arange(len(own)), own] = np.maximum(mine, np.minimum(0.99, others * 1.5))
            self.theta, self.prior = np.clip(learned, 1e-6, 1 - 1e-6), (total + 5) / (total.sum() + 20)

    @staticmethod
    def _fires(patterns: np.ndarray) -> np.ndarray:
        return ((patterns[:, None] >> np.arange(len(FUNCTIONS))) & 1).astype(float)

    @staticmethod
    def _voted(fires: np.ndarray) -> np.ndarray:
        """The types that have a vote; prose where none has."""
        out = np.stack([fires[:, [u == t for u in FUNCTIONS.values()]].any(axis=1) for t in TYPES], axis=1)
        out[:, 0] |= ~out.any(axis=1)
        return out

    def _posterior(self, fires: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        """Of all types, or of those alone that a pattern is given in of."""
        log = fires @ np.log(self.theta) + (1 - fires) @ np.log(1 - self.theta) + np.log(self.prior)
        if of is not None:
            log = np.where(of, log, -np.inf)
        p = np.exp(log - log.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def posterior(self, pattern: int) -> np.ndarray:
        return self._posterior(self._fires(np.array([pattern])))[0]

    def kind(self, pattern: int) -> str:
        fires = self._fires(np.array([pattern]))
        return TYPES[int(self._posterior(fires, self._voted(fires))[0].argmax())]


def voted(texts: DataFrame, keys: list[str], text: str = "text", with_figures: bool = False) -> DataFrame:
    """(*keys, votes, and the figures if asked for), a row for a row."""
    types = dict(texts.dtypes)
    extra = [(c, REAL) for c in FIGURES] if with_figures else []
    schema = pa.schema([*((k, {"string": TEXT, "int": INT}.get(types[k], LONG)) for k in keys), ("votes", INT), *extra])

    def make():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column(b.num_columns - 1).to_pylist()
            out = [*b.columns[:-1], pa.array(map(votes, texts), INT)]
            if with_figures:
                each = [figures(t or "") for t in texts]
                out += [pa.array([float(x[c]) for x in each], REAL) for c in FIGURES]
            return pa.RecordBatch.from_arrays(out, schema=schema)

        return f

    return map_batches(texts.select(*keys, F.col(text).cast("string").alias("text")), make, schema)


def types_of(spark: SparkSession, counts: dict[int, int]) -> DataFrame:
    """(votes, kind, p_ of each type): a row for each pattern, of which there are at most 2^14, so that it may be broadcast."""
    model, out = Model(counts), []
    for p in counts:
        post = model.posterior(p) if p >= 0 else None
        out.append((p, model.kind(p), *map(float, post)) if p >= 0 else (p, None, None, None, None, None))
    return spark.createDataFrame(out, "votes int, kind string, " + ", ".join(f"p_{t} double" for t in TYPES))


def kind_of_counts(books: DataFrame) -> DataFrame:
    """Adds kind to counts of records by type: not prose where more than half of the records that say something aren't.

    Among list, table and junk the commonest names the kind, the first of them in a tie.
    """
    most = F.greatest("list", "table", "junk")
    named = F.when(F.col("list") == most, "list").when(F.col("table") == most, "table").otherwise("junk")
    return books.withColumn("kind", F.when(F.expr("2 * prose < records"), named).otherwise("prose"))


def book_counts(texts: DataFrame, with_figures: bool = False) -> DataFrame:
    """(book_id, votes, n, and the sums of the figures): the records of (book_id, position, text) by book and pattern, each once."""
    rows = voted(texts, ["book_id", "position"], with_figures=with_figures)
    figures = FIGURES if with_figures else ()
    one = rows.groupBy("book_id", "position").agg(*(F.max(c).alias(c) for c in ("votes", *figures)))  # deliveries of a record have one text
    return one.groupBy("book_id", "votes").agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in figures))


def types_of_books(counted: DataFrame) -> DataFrame:
    """(book_id, records, a count for each type, the means of the figures if counted has them, kind); counted is read twice."""
    counts = {r.votes: r.n for r in counted.groupBy("votes").agg(F.sum("n").alias("n")).collect()}
    figures = [c for c in FIGURES if c in counted.columns]
    own = counted.join(F.broadcast(types_of(counted.sparkSession, counts)), "votes").where("kind is not null")
    per = own.groupBy("book_id").agg(F.sum("n").alias("records"), *(F.sum(F.when(F.col("kind") == t, F.col("n")).otherwise(0)).alias(t) for t in TYPES), *((F.sum(c) / F.sum("n")).alias(c) for c in figures))
    return kind_of_counts(per)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return types_of_books(cut(book_counts(deliveries(spark, sf_dir)))).where("kind <> 'prose'").select("book_id", "kind")


def p6_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each book's records by type, the means of their figures, and the book's kind."""
    return types_of_books(cut(book_counts(deliveries(spark, sf_dir), with_figures=True)))


def p6_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's figures, posterior of each type, and kind; null figures are none: an empty or null text has zeros and no kind."""
    rows = cut(voted(read(spark, sf_dir, "documents"), ["doc_id"], with_figures=True))
    counts = {r.votes: r.n for r in rows.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    return rows.join(F.broadcast(types_of(spark, counts)), "votes", "left").drop("votes")
