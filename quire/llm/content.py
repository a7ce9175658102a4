"""Problem 10: abuse, hate and sexual passages, by classifiers learned from confirmed examples and unlabelled text.

A document's units are its sentences, with disguised spelling undone. Reviewers confirm documents, not sentences: the unit of a confirmed
document that its category's documents share is taken as its example. Linear classifiers over hashed words, word pairs and lexicon
hits are trained in numpy by non-negative positive-unlabelled learning: the risk on unlabelled units, less what positives hide in them by
the class prior, is never let below zero. Every unit of every document is scored; a document's score is its best unit's.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.looks import CYRILLIC, INVISIBLE_MARKS, LATIN, odd, one_form, settled
from quire.session import ship
from quire.sources.arrow import LONG, REAL, TEXT, map_batches
from quire.sources.tables import read

CATEGORIES = ("abuse", "hate", "sexual")
#: Lexicons: their hits are features of the classifiers, of which those learn the weights. Fixed values.
INSULTS = (
    "придурок идиот кретин урод ублюдок скотина тварь сволочь мразь гнида подонок ничтожество дебил дурак дура дрянь падаль выродок мерзавец негодяй паскуда сука шлюха козёл баран свинья мудак гад тупица шваль отребье "
    "scum lowlife cretin idiot moron maggot pig ape dickhead bastard bitch asshole arsehole imbecile fool loser vermin rat worm swine prick wanker twat jerk cunt whore dog filth trash "
    "arschloch schwein idiotin abschaum dreckskerl connard salaud ordure crétin imbécile"
).split()
STEMS = [regex.sub("(?:ок|о|а|я|ь)$", "", w) if regex.search("[а-я]", w) else w for w in INSULTS]
INSULT = regex.compile(r"(?<!\p{L})(?:" + "|".join(sorted(STEMS, key=len, reverse=True)) + r"|подонк|козл)\p{L}{0,3}(?!\p{L})")
TO_YOU = regex.compile(
    r"(?<!\p{L})(?:ты|тебя|тебе|тобой|твой|твоё|твоя|твои|твою|вы|вас|вам|ваш\p{L}*|you|your|yours|du|dich|dir|dein\p{L}*|заткнись|заткни|проваливай|слушай|пошёл вон|пошла вон|пошёл|убирайся|"
    r"shut up|shut your|get out|get lost|listen|автор \p{L}+ \p{L}+ просто|автор|whoever wrote|the author)(?!\p{L})"
)
THREAT = regex.compile(
    r"(?:тебе|тебя|ты|твои|твою|ему|her|you|your|his)(?!\p{L}).*?(?:выбью|убью|сдох|задушу|прибью|закопа|перелома|сломаю|зарежу|knock your teeth|break your|kill you|rot in|hands broken|cut your throat|beat you)"
    r"|(?:i hope you|чтоб ты|чтоб вы)(?!\p{L}).*?(?:rot|die|сдох|подох|сгин|провал)|лучше бы (?:тебя|ты).*?не (?:рожд|родил|было)|тебя.*?не рождалось|if you had never been born|you should never have been born"
    r"|плакать не стан|not a soul would miss you|nobody would miss you|(?:тво[её] место|your place is|you belong) .*?(?:яме|помойк|канав|cesspit|gutter|sewer|dump)|crawl back under"
)
HATE = regex.compile(
    r"(?<!\p{L})не люди(?!\p{L})|are not human|not even human|aren't human|\p{L} (?:—|–|-|это) ?(?:паразит|крыс|вредител|зараз|отброс|скот|недочелове)\p{L}*|are (?:all )?(?:parasites|vermin|rats|animals|subhuman)"
    r"|гнать их|driven out of|выжечь их|burned to the ground|порода у них|their breed|от рождения воры|thieves and liars|хороши только м[её]ртвы|the only good .{2,40} (?:are|is) (?:the )?dead"
    r"|нельзя давать ни хлеба|истребить|exterminat|ни одному из тех, кого зовут|wiped? (?:them )?out|нет им места|no decent person sits"
)
SEXUAL = regex.compile(
    r"(?:занял|занимал)\p{L}* (?:сексом|любовью)|(?:had|having) sex|раздвинул\p{L}* ноги|spread (?:her|his) legs|вош[её]л в не[её]|thrust (?:in)?to (?:her|him)|обхватила его б[её]драми|wrapped her thighs"
    r"|соск(?:и|ам|ах|ов)(?!\p{L})|(?:her|his) nipples|кончил\p{L}* (?:дважды|ей|в не)|(?:he|she) came (?:twice|inside)|ласкал\p{L}*.{0,30}груд|fondled.{0,30}breast|оседлала его|straddled (?:him|her)|взять е[её] грубее|take her harder"
    r"|(?:её|his|her) (?:член|cock|penis|pussy|clit)|трахал|трахн|(?:he|she) fucked|оргазм|orgasm|сосала|blow ?job|минет"
)
NEUTRAL = regex.compile(
    r"(?:суд |court ).*?(?:постанов|признал|held|ruled)|слово «|the word |термин|a term|(?:осудил|condemned).{0,40}(?:стать|article|книг|book|слов)|извинени|apologi[sz]ed|назван\p{L} паразит|(?:had|has) called|недостойно|"
    r"размножени|reproduction of|обследовани|screening|музе|museum|статуя|statue|marble figure|лесная ищет|паслась|skimmed"
)
#: A unit without any of these has nothing to find.
TRIGGERS = (
    *STEMS, "подонк", *"выбью убью сдох задушу прибью закопа перелома сломаю зарежу".split(), "knock your", "break your", "kill you", "rot in", "hands broken",
    "teeth", "cut your", "beat you", "i hope you", "чтоб ты", "чтоб вы", "рождалось", "лучше бы", "been born", "плакать не стан", "miss you", "помойк", "канав", "яме", "cesspit", "gutter", "sewer", "dump", "crawl back",
    "не люди", "human", "паразит", "parasite", "крыс", "вредител", "зараз", "отброс", "недочелове", "гнать их", "driven out", "выжечь", "burned to", "порода", "their breed", "от рождения", "thieves", "хороши только", "only good",
    "ни хлеба", "истребить", "exterminat", "кого зовут", "wipe", "нет им места", "no decent", "subhuman", "are animals", "are all",
    "сексом", "любовью", " sex", "раздвинул", "spread her", "spread his", "в неё", "в нее", "thrust", "обхватила", "wrapped her", "соск", "nipples", "кончил", "e came twice", "e came inside", "ласкал", "fondled", "оседлала", "straddled", "грубее", "harder",
    "член", "cock", "penis", "pussy", "clit", "трах", "fucked", "оргазм", "orgasm", "сосала", "blowjob", "blow job", "минет",
)
SIGNS = {"@": "аa", "0": "оo", "1": "иi", "3": "зe", "4": "чa", "6": "бb", "8": "вb", "$": "сs", "!": "иi", "|": "лl", "€": "еe", "5": "5s", "7": "7t"}
UNITS = re.compile(r"(?<=[.!?…])[\s»”\"]+(?=[A-ZА-ЯЁІЇЄÄÖÜÀÉÈÊÇ«„“\"—–-])|\n+")
SPACED = re.compile(r"\b[^\W\d_](?:[.\-_*·~ ][^\W\d_]\b){3,}")
MIXED = regex.compile(r"[\p{L}\d@$!|€*]*(?:\p{L}[\d@$!|€*]|[\d@$!|€*]\p{L})[\p{L}\d@$!|€*]*")
REPEATED = regex.compile(r"(\p{L})\1{2,}")
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
CYRILLIC, LATIN = re.compile("[\u0400-\u052f]"), re.compile("[A-Za-z\u00c0-\u024f]")
NEEDS = re.compile(r"[@$|€*]|[^\W\d_][\d!][^\W\d_]|([^\W\d_])\1\1")
CUT = re.compile(r"(?<=[^\W\d_])[-‐¬]\s*\n\s*(?=[^\W\d_])")


def _word(m: regex.Match) -> str:
    w = m[0]
    k = 0 if CYRILLIC.search(settled(w)) else 1
    body, end = (w[:-1], w[-1]) if w[-1] in "!|" else (w, "")
    out = "".join(SIGNS[c][k] if c in SIGNS else c for c in body)
    if "*" in out:
        p = regex.compile(regex.escape(out.lower()).replace(r"\*", r"\p{L}"))
        out = next((x for x in INSULTS if p.fullmatch(x)), out.replace("*", ""))
    return out + end


def clear(text: str) -> str:
    """Without disguise, in lower case."""
    text = INVISIBLE_MARKS.sub("", text)
    if odd(text):
        text = one_form(text)
    if "\n" in text:
        text = CUT.sub("", text)
    text = SPACED.sub(lambda m: regex.sub(r"[^\p{L}]", "", m[0]), text)
    if CYRILLIC.search(text) and LATIN.search(text):
        text = LETTERS.sub(lambda m: settled(m[0]) if CYRILLIC.search(m[0]) and LATIN.search(m[0]) else m[0], text)
    return REPEATED.sub(r"\1", MIXED.sub(_word, text)) if NEEDS.search(text) else text




#: Lexicon features: name and pattern, looked for in units that hold a trigger.
HITS = {"insult": INSULT, "you": TO_YOU, "threat": THREAT, "hate": HATE, "sexual": SEXUAL, "neutral": NEUTRAL}
BUCKETS = 1 << 18
#: Bounds of the training sample, in documents; share of units that a category has; rounds of choosing the examples.
LABELLED, UNLABELLED, PRIOR, ROUNDS = 2500, 1500, 0.003, 3
WORDS = re.compile(r"[^\W\d_]+").findall
#: Words whose hashes a worker keeps; beyond it starts afresh, with the same results.
KEPT = 300_000
_hits = np.array([xxhash.xxh32_intdigest(f"hit {n}") % BUCKETS for n in [*HITS, "insult you"]])


def _automaton():
    a = ahocorasick.Automaton()
    for x in TRIGGERS:
        a.add_word(x, True)
    a.make_automaton()
    return a


class Features:
    """Hashed features of the units of texts: each word, its beginning, each pair of words, and the lexicons that hit."""

    def __init__(self) -> None:
        self.triggers = _automaton()
        self._reset()

    def _reset(self) -> None:
        self.kept: dict[str, int] = {}
        self.hashes = np.zeros((0, 2), np.int64)

    def _words(self, new: list[str]) -> None:
        self.kept.update((w, len(self.hashes) + k) for k, w in enumerate(new))
        self.hashes = np.concatenate([self.hashes, np.array([(xxhash.xxh32_intdigest(w), xxhash.xxh32_intdigest("begin " + w[:5])) for w in new], np.int64)])

    def units(self, text: str | None) -> list[str]:
        return [u.lower() for u in UNITS.split(clear(text)) if u.strip()] if text else []

    def of(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers of all units one after the other, the unit of each, and its value: less in longer units, more for a lexicon hit."""
        if len(self.kept) > KEPT:
            self._reset()
        words = [WORDS(u) for u in units]
        if new := [*set().union(*words).difference(self.kept)]:
            self._words(new)
        size = np.fromiter(map(len, words), np.int64, len(words))
        both = self.hashes[np.fromiter(map(self.kept.__getitem__, chain.from_iterable(words)), np.int64, int(size.sum()))]
        owner = np.repeat(np.arange(len(units)), size)
        pair = np.flatnonzero(owner[1:] == owner[:-1])
        pairs = (both[pair, 0] * 0x9E3779B1 + both[pair + 1, 0] * 0x85EBCA77) >> 7
        hits, hit_owner = [], []
        for k, u in enumerate(units):
            if next(self.triggers.iter(u), None) is not None:
                own = [n for n, p in enumerate(HITS.values()) if p.search(u)]
                if 0 in own and 1 in own:
                    own.append(len(HITS))
                hits += own
                hit_owner += [k] * len(own)
        index = np.concatenate([both[:, 0] % BUCKETS, both[:, 1] % BUCKETS, pairs % BUCKETS, _hits[np.array(hits, np.int64)]])
        scale = 1 / np.sqrt(np.maximum(size, 4))
        owners = np.concatenate([owner, owner, owner[pair], np.array(hit_owner, np.int64)])
        value = scale[owners]
        value[len(value) - len(hits) :] = 5.0
        return index, owners, value


def scores(weights: np.ndarray, bias: np.ndarray, index: np.ndarray, owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """(units, categories)."""
    return np.stack([np.bincount(owner, weights[index, k] * value, n) for k in range(weights.shape[1])], axis=1) + bias


def non_negative(index: np.ndarray, owner: np.ndarray, value: np.ndarray, n: int, positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 50, rate: float = 0.2, decay: float = 3e-5) -> tuple[np.ndarray, float]:
    """Weights and bias of one category: Adam on prior E_P[l(g)] + max(0, E_U[l(-g)] - prior E_P[l(-g)]) with the logistic loss l."""
    mine = np.zeros(n, bool)
    mine[positive] = mine[unlabelled] = True
    mine = mine[owner]
    index, owner, value = index[mine], owner[mine], value[mine]
    w, b = np.zeros(BUCKETS), -2.0
    used, of = np.unique(index, return_inverse=True)
    v, m1, m2 = np.zeros(len(used)), np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    sig = lambda z: 1 / (1 + np.exp(-z))
    for step in range(1, steps + 1):
        g = np.bincount(owner, v[of] * value, n) + b
        gp, gu = g[positive], g[unlabelled]
        hidden = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        d = np.zeros(n)
        if hidden >= 0:
            np.add.at(d, positive, -prior * sig(-gp) / len(positive) - prior * sig(gp) / len(positive))
            np.add.at(d, unlabelled, sig(gu) / len(unlabelled))
        else:  # the unlabelled units can't be less than no loss: step back
            np.add.at(d, positive, prior * sig(gp) / len(positive))
            np.add.at(d, unlabelled, -sig(gu) / len(unlabelled))
        grad = np.append(np.bincount(of, d[owner] * value, len(used)) + decay * v, d.sum()) / prior
        m1 += 0.1 * (grad - m1)
        m2 += 0.01 * (grad * grad - m2)
        move = rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-4)
        v -= move[:-1]
        b -= move[-1]
    w[used] = v
    return w, b


class Model:
    """Weights, biases and thresholds of the categories."""

    def __init__(self, labelled: list[tuple[str, set[str]]], unlabelled: list[str]) -> None:
        """labelled: text and its confirmed categories, an empty set for a text confirmed to have none."""
        f = Features()
        docs = [f.units(t) for t, _ in labelled] + [f.units(t) for t in unlabelled]
        size = np.array([len(d) for d in docs], np.int64)
        doc = np.repeat(np.arange(len(docs)), size)
        begin = np.append(0, np.cumsum(size))
        n = int(size.sum())
        index, owner, value = f.of([*chain.from_iterable(docs)])
        clean = np.array([not c for _, c in labelled] + [True] * len(unlabelled), bool)
        free = np.flatnonzero(clean[doc])  # what reviewers found clean is unlabelled text too: some of it isn't
        self.weights, self.bias, self.threshold = np.zeros((BUCKETS, len(CATEGORIES)), np.float32), np.full(len(CATEGORIES), -9.0), np.zeros(len(CATEGORIES))
        # How many documents have a feature: once for a document.
        pair = np.unique(doc[owner] * BUCKETS + index)
        in_doc, feature = pair // BUCKETS, pair % BUCKETS
        common = np.bincount(feature[in_doc >= len(labelled)], minlength=BUCKETS)
        none = np.array([k for k, (_, c) in enumerate(labelled) if not c], np.int64)
        marked = np.flatnonzero(~clean)
        log_share = lambda docs: np.log((np.bincount(feature[np.isin(in_doc, docs)], minlength=BUCKETS) + 0.3) / (len(docs) + 1))
        in_none = log_share(none)
        for k, category in enumerate(CATEGORIES):
            confirmed = np.array([i for i, (_, c) in enumerate(labelled) if category in c and size[i]], np.int64)
            own = np.isin(in_doc, confirmed)
            shared = np.bincount(feature[own], minlength=BUCKETS)
            # More than in unlabelled documents, in clean ones and in those of other categories, as some labels are wrong.
            others = log_share(np.setdiff1d(marked, confirmed))
            odds = np.log((shared + 0.3) / (len(confirmed) + 1)) - np.maximum.reduce([np.log((common + 0.3) / (len(unlabelled) + 1)), in_none, others + 0.7])
            prior_hit = np.zeros(BUCKETS)
            prior_hit[_hits[list(HITS).index(category if category != "abuse" else "threat")]] = 6.0
            if category == "abuse":
                prior_hit[_hits[-1]] = 6.0
            prior_hit[_hits[list(HITS).index("neutral")]] = -6.0
            evidence = np.where((shared >= 2) & (odds > 0), odds, 0.0) + prior_hit
            g = np.bincount(owner, evidence[index], n)
            bar = 4.0
            for _ in range(ROUNDS):
                best = [u for d in confirmed.tolist() if g[u := int(begin[d] + g[begin[d] : begin[d + 1]].argmax())] > bar]
                if not best:  # nothing confirmed: the lexicon's own examples
                    best = np.flatnonzero(np.bincount(owner, prior_hit[index], n) > 4).tolist()
                if not best or not len(free):
                    break
                self.weights[:, k], self.bias[k] = non_negative(index, owner, value, n, np.array(best), free, PRIOR)
                g = scores(self.weights[:, k : k + 1], self.bias[k : k + 1], index, owner, value, n)[:, 0]
                bar = 0.0
            # The threshold between the examples and what reviewers found clean.
            if len(none) and len(confirmed):
                top = np.array([g[begin[d] : begin[d + 1]].max() if size[d] else -99.0 for d in range(len(labelled))])
                cuts = np.linspace(-2, 6, 65)
                gain = [(top[confirmed] > c).sum() - 3 * (top[none] > c).sum() for c in cuts]
                best_cuts = cuts[np.array(gain) == max(gain)]
                self.threshold[k] = float(np.median(best_cuts))

    def score(self, f: Features, texts: list[str | None]) -> np.ndarray:
        """(texts, categories): the best unit's score less the threshold; -99 for a text without units."""
        docs = [f.units(t) for t in texts]
        out = np.full((len(texts), len(CATEGORIES)), -99.0)
        units = [*chain.from_iterable(docs)]
        if units:
            g = scores(self.weights, self.bias, *f.of(units), len(units)) - self.threshold
            starts = np.cumsum([0, *map(len, docs)])[:-1]
            some = np.flatnonzero([len(d) > 0 for d in docs])
            out[some] = np.maximum.reduceat(g, starts[some], axis=0)
        return out


def resolve(votes: list[tuple[int, str | None]]) -> dict[int, set[str]]:
    """The categories of each labelled document: its commonest label; a document whose labels tie has none and is left out. Null labels say nothing."""
    by: dict[int, Counter] = {}
    for doc, label in votes:
        if label is not None:
            by.setdefault(doc, Counter())[label] += 1
    out = {}
    for doc, c in by.items():
        (first, n), *rest = c.most_common()
        if not rest or rest[0][1] < n:
            out[doc] = {first} & set(CATEGORIES)
    return out


def sample(documents: DataFrame, labels: DataFrame) -> tuple[list[tuple[str, set[str]]], list[str]]:
    """At most LABELLED documents with labels, a fifth of them for each category and the rest clean, and UNLABELLED others: those of the smallest hashes."""
    given = labels.where("doc_id is not null and label is not null").select("doc_id", "label")
    chosen: set[int] = set()
    for label in (*CATEGORIES, "none"):
        most = LABELLED // 5 * (2 if label == "none" else 1)
        chosen |= {r.doc_id for r in given.where(F.col("label") == label).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()}
    texts = documents.where("text is not null and doc_id is not null")
    free = {r.doc_id for r in texts.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(UNLABELLED).collect()}
    ids = documents.sparkSession.createDataFrame([(i,) for i in sorted(chosen | free)], "doc_id bigint")  # at most LABELLED + UNLABELLED
    rows = {r.doc_id: r.text for r in texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text")).collect()}
    votes = given.join(F.broadcast(ids), "doc_id").collect()
    resolved = resolve([(r.doc_id, r.label) for r in votes if r.doc_id in chosen])
    return [(rows[d], c) for d, c in sorted(resolved.items()) if d in rows], [rows[d] for d in sorted(free - chosen) if d in rows]


_features: list[Features] = []


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, source, category, score), a row for each document and category: above 0.5 where the category is found.

    A null or empty text scores 0; rows that are repeated have rows of their own.
    """
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", LONG), ("source", TEXT), ("category", TEXT), ("score", REAL)])

    def make():
        if not _features:
            _features.append(Features())

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            margin = shared.value.score(_features[0], b.column(2).to_pylist())
            each = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
            each[margin == -99.0] = 0.0
            n = len(CATEGORIES)
            repeat = pa.array(np.repeat(np.arange(b.num_rows), n))
            return pa.RecordBatch.from_arrays([b.column(0).take(repeat), b.column(1).take(repeat), pa.array(CATEGORIES * b.num_rows), pa.array(each.ravel())], schema=schema)

        return f

    return map_batches(documents.select(F.col("doc_id").cast("bigint"), F.col("source").cast("string"), F.col("text").cast("string")), make, schema)


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return score(documents, Model(*sample(documents, read(spark, sf_dir, "content_labels"))))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_scores(spark, sf_dir).where("score > 0.5").select("doc_id", "category").distinct()


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, category, documents, rate): a null source is a source of its own."""
    return p10_scores(spark, sf_dir).groupBy("source", "category").agg(F.count("*").alias("documents"), F.avg(F.expr("if(score > 0.5, 1.0D, 0.0D)")).alias("rate"))
