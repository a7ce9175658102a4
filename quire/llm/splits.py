"""Problem 7: splits that keep records together which share an author.

Names become keys of surname and initials; which end of a name in full is the surname is a join with the surnames that are certain
elsewhere. Books and keys are the nodes of a graph whose components come by hash-to-min: clusters are rows (node, member), each node
sends its cluster to its smallest member and that member to the others, until nothing changes. Components go to splits by weighted
rendezvous hashing. A hot author is many rows of a join, never one array or task: AQE may split them.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.looks import INVISIBLE_MARKS, skeleton
from quire.session import cut
from quire.sources.arrow import TEXT, map_batches, rows_batch
from quire.sources.tables import read

BETWEEN = regex.compile(r"\s*(?:[;/&+|]|\s(?:и|и\s+др|та|й|and|und|et|with|mit|avec)\s)\s*", regex.I)
#: What stands where there is no author. Fixed values.
NOBODY = regex.compile(
    r"(?:unknown|anonymous|anon|n/?a|none|null|nil|без\s+автора?|неизвест\w*|невідом\w*|аноним\w*|анонім\w*|коллектив\s+авторов|колектив\s+авторів|автор\w*\s+не\w*|народн\w*"
    r"|various(?:\s+authors)?|collective|unbekannt|anonyme?|inconnu|auteur\s+inconnu|[\W\d_]*|(?:автор\s+)?неизвестен|и?\s*др|et\s+al)\.?",
    regex.I,
)
WORD = regex.compile(r"\p{L}[\p{L}\p{M}'’\-]*")
FATHERS = regex.compile("(?:" + "|".join(skeleton(x) for x in ("ович", "евич", "ич", "овна", "евна", "ична", "івна", "ївна")) + ")$")
WEIGHTS = {"train": 80, "validation": 10, "test": 10}


def people(author: str | None) -> list[tuple[str, str, bool]]:
    """(key, other key, certain) for each person named: surname|initials as they are if certain, else the key with the surname first and last."""
    text = regex.sub(r"\s+", " ", INVISIBLE_MARKS.sub("", author or "").casefold().replace("ё", "е")).strip()
    if NOBODY.fullmatch(text):
        return []
    out = []
    for one in BETWEEN.split(f" {text} "):
        parts = one.strip().split(",")
        if all(len(WORD.findall(x)) > 1 for x in parts):  # each with a surname and names of its own
            many = parts
        elif len(parts) % 2 == 0:  # surname, names, surname, names
            many = [",".join(parts[k : k + 2]) for k in range(0, len(parts), 2)]
        else:
            many = [one]
        for person in map(str.strip, many):
            words = [skeleton(w) for w in WORD.findall(person)]
            if NOBODY.fullmatch(person) or not words:
                continue
            before = [skeleton(w) for w in WORD.findall(person.split(",")[0])] if "," in person else []
            long = [w for w in words if len(w) > 1]
            if before:
                out.append((before[-1] + "|" + "".join(w[0] for w in words[len(before) :]), "", True))
            elif len(long) == 1:
                out.append((long[0] + "|" + "".join(w for w in words if len(w) == 1), "", True))
            else:
                if len(words[-1]) == 1:
                    words = long + [w for w in words if len(w) == 1]
                last = len(long) - 1 if len(words[-1]) == 1 else len(words) - 1
                keys = [words[k] + "|" + "".join(w[0] for i, w in enumerate(words) if i != k) for k in (0, last)]
                fathers = len(words) >= 3 and FATHERS.search(words[-1]) and not FATHERS.search(words[-2])
                out.append((*(keys if fathers else keys[::-1]), False))  # the likelier first
    return out


def author_keys(books: DataFrame, key: str = "book_id", author: str = "author") -> DataFrame:
    """(node, person): a row for each book and person, person null for a book that names none. A null key has no row."""
    schema = pa.schema([("node", TEXT), ("likely", TEXT), ("other", TEXT), ("certain", pa.bool_())])

    def make():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            return rows_batch(schema, [(k, *p) for k, a in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for p in people(a) or [(None, None, True)]])

        return f

    named = cut(map_batches(books.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(key), F.col(author).cast("string").alias(author)), make, schema).distinct())
    surname = lambda c: F.substring_index(c, "|", 1)
    known = named.where("certain and likely is not null").select(surname("likely").alias("surname")).distinct()
    open_ = named.where("not certain")
    for c in ("likely", "other"):
        open_ = open_.join(known.select(F.col("surname").alias(f"s_{c}")), surname(F.col(c)) == F.col(f"s_{c}"), "left")
    other = F.col("s_other").isNotNull() & F.col("s_likely").isNull()
    return named.where("certain").select("node", F.col("likely").alias("person")).unionByName(open_.select("node", F.when(other, F.col("other")).otherwise(F.col("likely")).alias("person")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node of each node's component, of edges (a, b); an edge with a null or equal end is a node alone.

    Hash-to-min, to convergence without a limit of rounds.
    """
    e = edges.select("a", "b").where("a is not null or b is not null").select(F.coalesce("a", "b").alias("a"), F.coalesce("b", "a").alias("b"))
    own = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("member")), F.struct(F.col("b").alias("node"), F.col("a").alias("member")), F.struct(F.col("a").alias("node"), F.col("a").alias("member")), F.struct(F.col("b").alias("node"), F.col("b").alias("member"))))
    clusters = cut(e.select(own.alias("x")).select("x.*").distinct())
    state = None
    while True:
        now = clusters.agg(F.count("*"), F.sum(F.xxhash64("node", "member").cast("decimal(38,0)")), F.sum(F.hash("member", "node").cast("bigint"))).first()
        if now == state:
            break
        state = now
        least = clusters.groupBy("node").agg(F.min("member").alias("least"))
        sent = F.explode(F.array(F.struct(F.col("least").alias("node"), F.col("member")), F.struct(F.col("member").alias("node"), F.col("least").alias("member"))))
        clusters = cut(clusters.join(least, "node").select(sent.alias("x")).select("x.*").distinct())
    return clusters.groupBy("node").agg(F.min("member").alias("component"))


def rendezvous(key: Column, weights: dict[str, int], seed: int = 7) -> Column:
    """The split with the largest -weight / ln(u), u being a hash of the key and the split's name: a change of one weight moves no more than it must."""
    score = lambda name, w: -F.lit(float(w)) / F.log((F.pmod(F.xxhash64(key, F.lit(name), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52))
    best = F.greatest(*(F.struct(score(n, w).alias("s"), F.lit(n).alias("split")) for n, w in weights.items() if w > 0))
    return best.getField("split")


def grouped(books: DataFrame, key: str = "book_id", author: str = "author") -> DataFrame:
    """(book_id, component): every book with the smallest book of its group, which is itself where nothing links it."""
    keys = author_keys(books, key, author)
    edges = keys.select(F.concat(F.lit("0"), "node").alias("a"), F.concat(F.lit("1"), "person").alias("b"))  # a book is smaller than any person
    return components(edges).where("node like '0%'").select(F.substring("node", 2, 1 << 30).alias("book_id"), F.substring("component", 2, 1 << 30).alias("component"))


def p7_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(read(spark, sf_dir, "books_meta")).select("book_id", rendezvous(F.col("component"), WEIGHTS).alias("split"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(read(spark, sf_dir, "books_meta")).where("component <> book_id").select(F.col("component").alias("book_id_a"), F.col("book_id").alias("book_id_b"))
