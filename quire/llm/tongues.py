"""Problem 2: the language of books and of the segments of a sentence, by a conditional random field over words.

The field is trained on the driver from a bounded sample: sentences of at most BOOKS books a language whose label agrees with the
lexicon, alone and joined with a clause of another language, so that changes inside a text are learned too. It tags every text; words get
their language by forward-backward, runs of words become segments, sentences the language of most of their words, books that of their sentences.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import crf, quality
from quire.llm.languages import LANGUAGES, code_of
from quire.session import cut, ship
from quire.sources.arrow import INT, REAL, TEXT, map_batches
from quire.sources.tables import deliveries, read

#: Function words of each language, the field's lexicon. Fixed values.
LEXICON = {
    "ru": "и что как это так его её их но или если когда где чтобы потому только уже ещё был была было были он она они мы вы я ты не из от под над при без после "
    "перед между через около возле среди во со об обо же бы ли ни то том тем чём чему которая который которые сказал сказала подумал году года лет хотя пока словно будто "
    "всё все никто ничего прежде ибо откуда разве у за по о к с на в для до себя свой своего",
    "en": "the a an of and to in on at by with from for was were is are had has have been be not no that this which who what when where while before after "
    "since because although though as if so but or nor his her their its my our your he she it they we you i did do does into over under upon without "
    "within near behind beside across during until towards nobody nothing everyone said mr mrs one two there then than him them would could should soon later",
    "uk": "і й та що як це його її їх але або якщо коли де щоб тому тільки вже ще був була було були він вона вони ми ви я ти не із з від під над при без після "
    "перед між через біля коло серед у в до про же би чи ні те тим який яка які сказав сказала подумав році року років хоча поки доки ніби наче "
    "усе все ніхто нічого перш бо адже звідки хіба за по о на для себе свій посеред ніж невдовзі якось",
    "de": "der die das den dem des ein eine einen einem einer eines und oder aber nicht kein keine mit von zu zum zur im in am an auf aus bei beim nach vor "
    "hinter unter über neben zwischen während seit als wenn weil obwohl damit dass daß denn es er sie wir ihr ich war waren wurde wird hat hatte haben ist sind sei "
    "sein seine seinen ihre ihren sich auch noch nur schon sehr wie was wer wo warum sagte herr frau jahre ihm ihn niemand nichts doch ohne um bis durch für gegen",
    "fr": "le la les l un une des du de d et ou où mais ne pas ni que qui qu quoi dont ce cette ces cet il elle ils elles on nous vous je s se sa son ses leur leurs "
    "au aux à en dans sur sous par pour avec sans chez vers entre derrière devant avant après pendant depuis comme si car donc plus très bien était fut avait eut a est sont "
    "dit monsieur madame tandis malgré personne rien près côté bord milieu pourquoi quand afin lorsque parmi jour",
}
WORDS = {k: frozenset(v.split()) for k, v in LEXICON.items()}
#: Letters that one of two languages of a script does not have. Fixed values.
ONLY = {"ru": frozenset("ыэъё"), "uk": frozenset("іїєґ"), "de": frozenset("äöüß"), "fr": frozenset("àâçéèêëîïôùûœæ")}
#: Bounds of the training sample: books a language, first positions of a book, sentences a book.
BOOKS, POSITIONS, SENTENCES = 40, 60, 20
#: Words that a segment has at least, and the mean marginal of its language.
SEGMENT_WORDS, SEGMENT_SURE = 4, 0.8
_ALPHA = {c: k for k, c in enumerate(LANGUAGES)}


def hint(words: list[str]) -> np.ndarray:
    """Words of each language's lexicon, shared ones in parts, and words with a letter that only it has."""
    out = np.zeros(len(LANGUAGES))
    for w in map(str.lower, words):
        of = [c for c in LANGUAGES if w in WORDS[c]]
        for c in of:
            out[_ALPHA[c]] += 1 / len(of) ** 2
        if not of:
            for c, letters in ONLY.items():
                out[_ALPHA[c]] += not letters.isdisjoint(w)
    return out


def sample(spark: SparkSession, sf_dir: str) -> list[tuple[str, str, str]]:
    """(language, book, text) of at most 5 x BOOKS books with a label, the same ones whenever the tables are the same."""
    index = read(spark, sf_dir, "book_index").select("book_id", code_of(F.col("language")).alias("language")).where("book_id is not null")
    chosen = {}
    for code in LANGUAGES:
        chosen |= {r.book_id: code for r in index.where(F.col("language") == code).select("book_id").distinct().orderBy(F.xxhash64("book_id"), "book_id").limit(BOOKS).collect()}
    rows = deliveries(spark, sf_dir).where(F.col("book_id").isin(*chosen) & (F.col("position") < POSITIONS) & F.length("text").between(20, 400)).collect()
    own: dict[str, set[str]] = {}
    for r in rows:
        own.setdefault(r.book_id, set()).add(r.text)
    return [(chosen[b], b, t) for b, texts in sorted(own.items()) for t in sorted(texts, key=lambda t: xxhash.xxh3_64_intdigest(t))[:SENTENCES]]


def train(labelled: list[tuple[str, str, str]], seed: int = 5) -> crf.Chain:
    """A field from labelled texts: those in prose whose lexicon doesn't speak against the label, as they are and joined in pairs."""
    rng = random.Random(seed)
    clean: dict[str, list[list[str]]] = {c: [] for c in LANGUAGES}
    for code, _, text in labelled:
        toks = crf.tokens(text)
        words = [t for t in toks if crf.spoken(t)]
        h = hint(words)
        if len(words) >= 3 and quality.votes(text) in (1, 2, 4, 6, 3, 5, 7) and h[_ALPHA[code]] > 0.75 * h.sum() and h[_ALPHA[code]] >= 0.1 * len(words):
            clean[code].append(toks)
    for code in LANGUAGES:  # the lexicon itself, so that no language is without examples
        words = sorted(WORDS[code])
        clean[code] += [rng.sample(words, 6) for _ in range(30)]
    data = [(toks, code) for code, texts in clean.items() for toks in texts]
    out = [(t, np.full(sum(crf.spoken(x) for x in t), _ALPHA[c])) for t, c in data]
    for _ in range(len(data) // 3):
        (a, c), (b, d) = rng.choice(data), rng.choice(data)
        k, mark = rng.randint(1, len(a)), rng.choice([".", ",", "—", ""])
        joined = a[:k] + [mark] * bool(mark) + b
        out.append((joined, np.array([_ALPHA[c]] * sum(crf.spoken(x) for x in a[:k]) + [_ALPHA[d]] * sum(crf.spoken(x) for x in b))))
    return crf.train(out, len(LANGUAGES), WORDS)


def segments(toks: list[str], marginals: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(language, first word, words, confidence) of the runs of words of one language that are whole clauses, not names or set phrases.

    A run shorter than SEGMENT_WORDS joins the run before it; so does one of words with capitals, as names and titles have.
    """
    words = [t for t in toks if crf.spoken(t)]
    best = marginals.argmax(axis=1)
    edges = np.flatnonzero(np.append(True, best[1:] != best[:-1]))
    out: list[list] = []
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(best)]):
        code = int(best[a])
        low = sum(words[k].islower() for k in range(a, b))
        sure = float(marginals[a:b, code].mean())
        if low >= SEGMENT_WORDS - 1 and b - a >= SEGMENT_WORDS and sure >= SEGMENT_SURE:
            if out and out[-1][0] == code:
                out[-1][2], out[-1][3] = b - out[-1][1], min(out[-1][3], sure)
            else:
                out.append([code, a, b - a, sure])
        elif out:
            out[-1][2] = b - out[-1][1]
    return [tuple(x) for x in out]


_SEGMENT = pa.struct([("language", TEXT), ("word", INT), ("words", INT), ("confidence", REAL)])
_taggers: dict[str, crf.Tagger] = {}


def tagged(texts: DataFrame, chain: crf.Chain) -> DataFrame:
    """(book_id, position, votes, language, confidence, segments) of each row: the language of most words, null for a text without words.

    The votes are those of problem 6. segments has a row for each language's run where there are two languages or more, else none.
    """
    ship(texts.sparkSession)
    shared = texts.sparkSession.sparkContext.broadcast(chain)
    mark = xxhash.xxh3_64_hexdigest(chain.emit.tobytes() + chain.move.tobytes())
    schema = pa.schema([("book_id", TEXT), ("position", INT), ("votes", INT), ("language", TEXT), ("confidence", REAL), ("segments", pa.list_(_SEGMENT))])

    def make():
        if mark not in _taggers:
            _taggers.clear()
            _taggers[mark] = crf.Tagger(shared.value, WORDS)
        tagger = _taggers[mark]

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column(2).to_pylist()
            toks = [crf.tokens(t) for t in texts]
            m, bounds = tagger.marginals(toks)
            some = np.flatnonzero(np.diff(bounds))
            total, n = np.zeros((len(toks), len(LANGUAGES))), np.diff(bounds)
            if len(some):
                total[some] = np.add.reduceat(m, bounds[some], axis=0)
            best = total.argmax(axis=1)
            most = total[np.arange(len(toks)), best]
            language = [LANGUAGES[k] if c else None for k, c in zip(best.tolist(), n.tolist())]
            sure = [x / c if c else None for x, c in zip(most.tolist(), n.tolist())]
            parts: list[list[dict]] = [[] for _ in toks]
            for k in np.flatnonzero((most < n - 2) & (n >= 2 * SEGMENT_WORDS)).tolist():
                seg = segments(toks[k], m[bounds[k] : bounds[k + 1]])
                if len({x[0] for x in seg}) > 1:
                    parts[k] = [{"language": LANGUAGES[c], "word": a, "words": w, "confidence": s} for c, a, w, s in seg]
            votes = [quality.votes(t) for t in texts]
            return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(votes, INT), pa.array(language, TEXT), pa.array(sure, REAL), pa.array(parts, schema.field("segments").type)], schema=schema)

        return f

    return map_batches(texts.select("book_id", F.col("position").cast("int"), "text"), make, schema)


def _records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One row a record, and the types of the vote patterns."""
    rows = tagged(deliveries(spark, sf_dir), train(sample(spark, sf_dir)))
    one = cut(rows.groupBy("book_id", "position").agg(F.min(F.struct("votes", "language", "confidence", "segments")).alias("x")).select("book_id", "position", "x.*"))
    counts = {r.votes: r.n for r in one.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    return one, F.broadcast(quality.types_of(spark, counts).select("votes", "kind"))


def _books(one: DataFrame, types: DataFrame) -> DataFrame:
    """(book_id, language, confidence, prose): the language of most sentences; mixed where a second has more than a quarter of them."""
    own = one.join(types, "votes", "left")
    spoken = F.col("kind").isin("prose", "list") & F.col("language").isNotNull()
    per = own.groupBy("book_id").agg(
        F.count("kind").alias("records"), F.count_if(F.col("kind") == "prose").alias("prose"),
        *(F.count_if(spoken & (F.col("language") == c)).alias(c) for c in LANGUAGES), *(F.sum(F.when(spoken & (F.col("language") == c), F.col("confidence"))).alias(f"sure_{c}") for c in LANGUAGES),
    )
    ranked = F.reverse(F.array_sort(F.array(*(F.struct(F.col(c).alias("n"), F.coalesce(f"sure_{c}", F.lit(0.0)).alias("sure"), F.lit(c).alias("code")) for c in LANGUAGES))))
    per = per.withColumn("ranked", ranked).withColumn("known", sum(F.col(c) for c in LANGUAGES)).where("known > 0")
    mixed = F.expr("4 * ranked[1].n > known")
    return per.select(
        "book_id", F.when(mixed, "mixed").otherwise(F.expr("ranked[0].code")).alias("language"),
        F.when(mixed, F.expr("least(1.0D, (ranked[0].sure + ranked[1].sure) / known)")).otherwise(F.expr("ranked[0].sure / known")).alias("confidence"), (2 * F.col("prose") >= F.col("records")).alias("prose"),
    )


def p2_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _books(*_records(spark, sf_dir)).drop("prose")


def _mixed(one: DataFrame, types: DataFrame) -> DataFrame:
    return one.where("size(segments) > 1").join(types, "votes", "left").where("kind = 'prose'")


def p2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of each mixed sentence, in order."""
    return _mixed(*_records(spark, sf_dir)).select("book_id", "position", F.posexplode("segments").alias("segment", "x")).select("book_id", "position", "segment", "x.*")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, types = _records(spark, sf_dir)
    given = read(spark, sf_dir, "book_index").groupBy("book_id").agg(F.min(code_of(F.col("language"))).alias("lo"), F.max(code_of(F.col("language"))).alias("hi"))
    books = _books(one, types).where("prose").join(given, "book_id", "left").where("lo is null or lo <> language or hi <> language")
    parts = _mixed(one, types).select("book_id", "position", F.explode("segments.language").alias("language")).distinct()
    return books.select("book_id", F.lit(-1).alias("position"), "language").unionByName(parts)
