"""Problem 3: one form for texts that look the same.

DuckDB runs inside the Arrow partitions: its SQL composes characters (nfc_normalize), maps compatibility forms and look-alike letters
(translate, replace) and removes invisible marks (regexp_replace). The mappings are made from the Unicode tables by a rule.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.sources.arrow import INT, LONG, TEXT, map_batches
from quire.sources.tables import deliveries

#: Letters of Cyrillic and Greek, and the Latin letters of the same shape. Fixed values.
ALIKE_FROM = "АВЕЅІЈКМНОРСТУХаеѕіјорсухһԁԛԝӏΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορχ"
ALIKE_TO = "ABESIJKMHOPCTYXaesijopcyxhdqwlABEZHIKMNOPTYXavopx"
#: Composed letters of one shape in both scripts. Fixed values.
COMPOSED_FROM, COMPOSED_TO = "ёЁїЇ", "ëËïÏ"
#: Marks that show nothing, as ranges. Fixed values.
INVISIBLE_RANGES = "00ad 034f 061c 115f-1160 17b4-17b5 180b-180e 200b-200f 202a-202e 2060-206f fe00-fe0f feff ffa0"
#: Kinds of compatible forms that a reader takes for the same; superscripts, fractions, circled signs and the like are other signs.
SAME_FORM = ("<wide>", "<narrow>", "<noBreak>", "<compat>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>")


def _ranges(text: str) -> list[int]:
    return [c for r in text.split() for c in range(int(r.split("-")[0], 16), int(r.split("-")[-1], 16) + 1)]


INVISIBLE = {chr(c) for c in _ranges(INVISIBLE_RANGES)}


def same_forms() -> dict[str, str]:
    """Character to what it is another form of, from the Unicode tables."""
    out = {c: "" for c in INVISIBLE}
    for c in map(chr, range(0x80, 0x1F000)):
        d = unicodedata.decomposition(c)
        if c not in out and unicodedata.category(c) == "Zs":
            out[c] = " "
        elif c not in out and d.startswith(SAME_FORM) and not 0x3130 <= ord(c) < 0x3190:
            form = unicodedata.normalize("NFKC", c)
            if not (form.startswith(" ") and len(form) > 1):
                out[c] = form
    return out | {"\t": " ", "‐": "-", "‑": "-"}


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _class(chars) -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


def shapes() -> dict[str, str]:
    """Letter to the letter that stands for its shape: the Cyrillic one where there is one, so that most texts here stay as they are."""
    stands = {}
    for k, v in zip(COMPOSED_FROM + ALIKE_FROM, COMPOSED_TO + ALIKE_TO, strict=True):
        stands.setdefault(v, k if k < "\u0530" and k >= "\u0400" else v)
    to = {k: stands[v] for k, v in zip(COMPOSED_FROM + ALIKE_FROM, COMPOSED_TO + ALIKE_TO, strict=True)} | stands
    return {k: v for k, v in to.items() if k != v}


def prepare(db) -> None:
    """Sets the variable of a DuckDB connection that form_sql reads: the forms of several characters."""
    many = {k: v for k, v in same_forms().items() if len(v) > 1}
    db.execute("set variable many = map([" + ", ".join(map(_quoted, many)) + "], [" + ", ".join(map(_quoted, many.values())) + "])")


def form_sql(source: str, keys: str) -> str:
    """SQL of DuckDB from the table source with the columns keys and text: keys, text, one_form and look_form, equal for texts that look the same.

    Each stage touches the texts only that need it: other forms of one character, other forms of several, letters of one shape.
    """
    table, shape = same_forms(), shapes()
    one = {k: v for k, v in table.items() if len(v) == 1}
    many = {k: v for k, v in table.items() if len(v) > 1}
    odd = "regexp_matches(text, '[^ -~\\n\\x{400}-\\x{45f}–—«»„“”’äöüßÄÖÜàâçéèêëîïôùûœÀÉÈÊ]')"
    plain = f"translate(regexp_replace(text, {_quoted(_class(sorted(INVISIBLE)))}, '', 'g'), {_quoted(''.join(one))}, {_quoted(''.join(one.values()))})"
    widened = "list_aggregate(list_transform(string_split(a, ''), lambda c: coalesce(getvariable('many')[c], c)), 'string_agg', '')"
    return f"""with stage_1 as (select *, {odd} as odd, case when {odd} then {plain} else text end as a from {source}),
        stage_2 as (select *, case when odd and regexp_matches(a, {_quoted(_class(many))}) then {widened} else a end as b from stage_1),
        stage_3 as (select *, case when odd then nfc_normalize(replace(b, chr(13) || chr(10), chr(10))) else b end as one_form from stage_2),
        stage_4 as (select *, case when odd or regexp_matches(one_form, {_quoted(_class(shape))}) then translate(one_form, {_quoted(''.join(shape))}, {_quoted(''.join(shape.values()))}) else one_form end as c from stage_3)
        select {keys}, text, one_form, case when odd then nfc_normalize(c) else c end as look_form from stage_4"""


def forms(texts: DataFrame, keys: list[str], text: str = "text", whole: bool = True) -> DataFrame:
    """(*keys, one_form, look, raw): a text's one form, the hash of its look (128 bits as text) and of its characters (64 bits).

    Letters stay in their script in one_form; look puts letters of one shape together. A null text has nulls; an empty one is a text.
    Without whole, one_form is left out.
    """
    types = dict(texts.dtypes)
    columns = [(k, {"string": TEXT, "int": INT}.get(types[k], LONG)) for k in keys] + [("one_form", TEXT)] * whole + [("look", TEXT), ("raw", LONG)]
    schema = pa.schema(columns)

    def make():
        import duckdb

        db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        prepare(db)
        names = ", ".join(f"k{i}" for i in range(len(keys)))
        sql = f"""with formed as ({form_sql("rows", names)})
            select {names}, {"one_form," if whole else ""} md5(look_form) as look, (hash(text) >> 1)::bigint as raw from formed"""

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = pa.Table.from_arrays(b.columns, [*(f"k{i}" for i in range(len(keys))), "text"])
            db.register("rows", rows)
            out = db.sql(sql).to_arrow_table().combine_chunks()
            db.unregister("rows")
            return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (out.column(i).cast(t.type) for i, t in enumerate(schema))], schema=schema)

        return f

    return map_batches(texts.select(*keys, F.col(text).cast("string").alias("text")), make, schema)


def same_look(looks: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of forms() in a class of texts that look the same but aren't: (*keys, look, raw), each once."""
    mixed = looks.groupBy("look").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("look")
    return looks.join(mixed, "look", "left_semi").select(*keys, "look", "raw").distinct()


def p3_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's text in one form, and the class of its look."""
    return forms(deliveries(spark, sf_dir), ["book_id", "position"]).drop("raw").distinct()


def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each record whose look other characters have too, with its class."""
    own = same_look(forms(deliveries(spark, sf_dir), ["book_id", "position"], whole=False), ["book_id", "position"])
    return own.select("book_id", "position", F.col("look").alias("class_id"), F.col("raw").alias("variant"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of records of one class with different characters: the pairs of variants first, then their records.

    Records of one variant aren't paired, so no work is done that isn't a row of the result.
    """
    own = same_look(forms(deliveries(spark, sf_dir), ["book_id", "position"], whole=False), ["book_id", "position"])
    variants = own.select("look", "raw").distinct()
    a, b = (variants.select("look", F.col("raw").alias(f"raw_{x}")) for x in "ab")
    pairs = a.join(b, "look").where("raw_a < raw_b")
    for x in "ab":
        pairs = pairs.join(own.select("look", F.col("raw").alias(f"raw_{x}"), F.struct("book_id", "position").alias(x)), ["look", f"raw_{x}"])
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    pairs = pairs.where("a <> b").select(lo.alias("lo"), hi.alias("hi")).distinct()
    return pairs.select(F.col("lo.book_id").alias("book_id_a"), F.col("lo.position").alias("position_a"), F.col("hi.book_id").alias("book_id_b"), F.col("hi.position").alias("position_b"))
