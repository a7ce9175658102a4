"""Columns over a text, and the same in DuckDB's SQL: every function takes an expression and gives one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import fixed as X
from quire.functions import re2
from quire.functions.re2 import quoted, sql_count, sql_matches, sql_replace

TRIM = f"^[{X.WS}]+|[{X.WS}]+$"
FIELDS = f"[{X.WS}]+"


def trim(t: Column) -> Column:
    """Only a text that begins or ends in white space goes through the pattern."""
    ends = F.concat(F.substring(t, 1, 1), F.substring(t, -1, 1))
    return F.when(ends.rlike(f"[{X.WS}]"), re2.replace(t, TRIM)).otherwise(t)


def sql_trim(t: str) -> str:
    return sql_replace(t, TRIM)


def with_text(df: DataFrame, made: Column, *keys: str, text: str = "text") -> DataFrame:
    """keys and a text that is made, of rows where it is neither null nor empty. A condition on it would be pushed below and make it twice; an array of one or none isn't."""
    return df.select(*keys, made.alias(text)).select(*keys, F.explode(F.filter(F.array(text), lambda x: x != "")).alias(text))


def fields(t: Column) -> Column:
    """Words between white space; one empty word for a blank text."""
    return F.split(trim(t), re2.java(FIELDS))


def sql_fields(t: str) -> str:
    return f"regexp_split_to_array({sql_trim(t)}, {quoted(FIELDS)})"


def collapse(t: Column) -> Column:
    """Words joined by single blanks."""
    return re2.replace(trim(t), FIELDS, " ")


def sql_collapse(t: str) -> str:
    return sql_replace(sql_trim(t), FIELDS, " ")


def share(part: Column, whole: Column) -> Column:
    """part / whole rounded to 6 places; 0 where whole is 0."""
    return F.round(F.when(whole > 0, part / whole).otherwise(0.0), 6)


def sql_share(part: str, whole: str) -> str:
    return f"round(case when {whole} > 0 then ({part})::double / ({whole}) else 0.0 end, 6)"


#: Shares by name: what is counted, and of what.
SHARES = {"digit_ratio": ("[0-9]", None), "punct_ratio": (r"\p{P}", None), "uppercase_ratio": (r"\p{Lu}", r"\p{L}"), "letter_ratio": (r"\p{L}", None)}


def ratio(t: Column, name: str) -> Column:
    part, whole = SHARES[name]
    return share(re2.count(t, part), re2.count(t, whole) if whole else F.length(t))


def sql_ratio(t: str, name: str) -> str:
    part, whole = SHARES[name]
    return sql_share(sql_count(t, part), sql_count(t, whole) if whole else f"length({t})")


def broken_ending(t: Column) -> Column:
    last = re2.replace(F.lower(F.element_at(fields(t), -1)), X.ENDING_SIGNS)
    return last.isin(X.OPEN_ENDINGS)


def sql_broken_ending(t: str) -> str:
    return f"{sql_replace(f'lower({sql_fields(t)}[-1])', X.ENDING_SIGNS)} in ({', '.join(map(quoted, X.OPEN_ENDINGS))})"


def starts_lower(t: Column) -> Column:
    return re2.matches(t, r"^\p{Ll}")


def sql_starts_lower(t: str) -> str:
    return sql_matches(t, r"^\p{Ll}")


def index_share(t: Column, non_empty: bool) -> Column:
    """Whether a text of three lines or more is an index: more than 0.7 of its lines, or of those that aren't empty, end in numbers."""
    lines = F.split(t, "\n", -1)
    full = F.filter(F.transform(lines, trim), lambda x: x != "")
    hits = F.size(F.filter(full, lambda x: re2.matches(x, X.INDEX_LINE)))
    whole = F.size(full) if non_empty else F.size(lines)
    return (F.size(lines) >= 3) & F.when(whole > 0, hits / whole > 0.7).otherwise(False)


def sql_index_share(t: str, non_empty: bool) -> str:
    lines = f"string_split({t}, chr(10))"
    full = f"list_filter(list_transform({lines}, lambda x: {sql_trim('x')}), lambda x: x <> '')"
    hits = f"len(list_filter({full}, lambda x: {sql_matches('x', X.INDEX_LINE)}))"
    whole = f"len({full})" if non_empty else f"len({lines})"
    return f"(len({lines}) >= 3 and case when {whole} > 0 then {hits}::double / {whole} > 0.7 else false end)"


def with_reason(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds trimmed, the text without blanks around it, and reason: why a sentence is rejected, the first that holds; null if it is kept.

    What several rules need is a column of its own, so that it is computed once.
    """
    s, low = F.col("trimmed"), F.col("_low")
    rows = df.withColumn("trimmed", trim(F.col(text))).withColumn("_low", F.lower("trimmed"))
    short = (F.length(s) < 10) & reduce(lambda a, b: a | b, (re2.matches(s, p) for p in X.SHORT_GARBAGE))
    garbage = reduce(lambda a, b: a | b, (s.contains(X.SIGNS_OF[n]) & re2.matches(s, p) for n, p in X.GARBAGE.items())) | short
    words = F.size(F.split(s, f"[{X.WS}]+"))
    single = F.length(s) - F.length(F.regexp_replace(s, f"(?<![^{X.WS}])\\p{{L}}(?![^{X.WS}])", ""))
    pair = F.concat(F.lit(" "), s, F.lit(" ")).rlike(f"[{X.WS}]\\p{{L}}[{X.WS}]+\\p{{L}}[{X.WS}]")  # there is one where more than half of the words are letters
    mixed = low.rlike("[0-9a-z_][а-яё]+[a-z]") & re2.matches(low, X.MIXED_WORD)  # a word begins there only after such a character
    ocr = re2.matches(low, X.NO_LETTERS_RUN) | re2.matches(s, X.SPACED) | re2.matches(s, X.SPACED_START) | mixed | (pair & (words > 5) & (single / words > 0.5))
    n = F.length(s)
    digits = (re2.count(s, r"\p{L}") / n < 0.1) & (re2.count(s, "[0-9]") / n > 0.5)
    index = s.contains("\n") & index_share(s, True)
    reason = F.when(s == "", "empty").when(garbage, "garbage_pattern").when(index, "index").when(ocr, "ocr_garbage").when(digits, "high_digit_no_letters")
    return rows.withColumn("reason", reason).drop("_low")


def sql_reason(t: str) -> str:
    s = sql_trim(t)
    short = f"length({s}) < 10 and ({' or '.join(sql_matches(s, p) for p in X.SHORT_GARBAGE)})"
    garbage = " or ".join(sql_matches(s, p) for p in X.GARBAGE.values())
    words = sql_fields(t)
    single = f"len(list_filter({words}, lambda x: {sql_matches('x', r'^\p{L}$')}))"
    low = f"lower({s})"
    ocr = f"{sql_matches(s, X.SPACED)} or {sql_matches(s, X.SPACED_START)} or {sql_matches(low, X.MIXED_WORD)} or (len({words}) > 5 and {single}::double / len({words}) > 0.5) or {sql_matches(low, X.NO_LETTERS_RUN)}"
    letters, figures = sql_count(s, r"\p{L}"), sql_count(s, "[0-9]")
    return (
        f"case when {s} = '' then 'empty' when {garbage} or ({short}) then 'garbage_pattern' when {sql_index_share(s, True)} then 'index' when {ocr} then 'ocr_garbage'"
        f" when {letters}::double / length({s}) < 0.1 and {figures}::double / length({s}) > 0.5 then 'high_digit_no_letters' end"
    )


def cleaned(t: Column) -> Column:
    return F.regexp_replace(trim(t), "[ \t]+", " ")


def sql_cleaned(t: str) -> str:
    return sql_replace(sql_trim(t), "[ \\t]+", " ")


def scrubbed(t: Column) -> Column:
    out = re2.replace(re2.replace(t, X.SCRUB_BLANKS, " "), X.SCRUB_DELETED)
    return reduce(lambda x, k: F.replace(x, F.lit(k), F.lit(X.LIGATURES[k])), X.LIGATURES, out)


def touched(t: Column) -> Column:
    """Characters that scrubbed() replaces or deletes."""
    return reduce(lambda a, b: a + b, (re2.count(t, p) for p in (X.SCRUB_BLANKS, X.SCRUB_DELETED, "[" + "".join(X.LIGATURES) + "]")))


def sql_scrubbed(t: str) -> str:
    out = sql_replace(sql_replace(t, X.SCRUB_BLANKS, " "), X.SCRUB_DELETED)
    return reduce(lambda x, k: f"replace({x}, {quoted(k)}, {quoted(X.LIGATURES[k])})", X.LIGATURES, out)


def sql_touched(t: str) -> str:
    return " + ".join(sql_count(t, p) for p in (X.SCRUB_BLANKS, X.SCRUB_DELETED, "[" + "".join(X.LIGATURES) + "]"))


def chunk_text(t: Column) -> Column:
    """A sentence as chunks hold it; controls, line ends among them, go before blanks are collapsed."""
    out = re2.replace(re2.replace(t, X.CHUNK_BLANKS, " "), X.CHUNK_DELETED)
    out = re2.replace(F.replace(out, F.lit("…"), F.lit("...")), X.CHUNK_DASHES, "-")
    return collapse(re2.replace(out, X.CHUNK_CONTROLS))


def sql_chunk_text(t: str) -> str:
    out = sql_replace(sql_replace(t, X.CHUNK_BLANKS, " "), X.CHUNK_DELETED)
    out = sql_replace(f"replace({out}, '…', '...')", X.CHUNK_DASHES, "-")
    return sql_collapse(sql_replace(out, X.CHUNK_CONTROLS))


def _line_kept(x: Column) -> Column:
    n, letters = F.length(x), re2.count(x, r"\p{L}")
    # Only a line of which no more than half are letters can be one of figures and signs, or noise.
    table = (F.octet_length(x) >= 20) & (letters / n < 0.5) & ((re2.count(x, r"\p{Nd}") + re2.count(x, r"\p{P}")) / n > 0.5)
    works = x.rlike(r"[А-ЯЁ].*\d") & reduce(lambda a, b: a | b, (re2.matches(x, p) for p in X.BIBLIOGRAPHIC))
    return ~(table | works | ((n >= 10) & (letters / n < 0.3)))


#: What a text holds that a step can change, for the steps that few texts need; each is a necessary sign of the step's pattern.
_SIGN_OF_STEP = {0: r"[\x{a0}\x{2007}\x{202f}]", 3: r"\p{L}-[\t\n\f\r ]", 4: "ISBN|УДК|ББК|ISSN|DOI", 5: r"(?m)^[\t\n\f\r ]*\d", 6: r"(?m)^[\t\n\f\r ]*\d", 7: r"(?m)^[\t\n\f\r ]*\d", 9: r"[А-Яа-яЁё]\d"}


def clean_document(df: DataFrame, text: str = "text") -> DataFrame:
    """The column cleaned by the whole chain, in its order. Each step is a column of its own, and a step that few texts need looks for its sign first."""
    t = F.col(text)
    step = lambda d, c: d.withColumn(text, c)
    for k, (pattern, by) in enumerate(X.TEXT_STEPS):
        done = re2.replace(t, pattern, by)
        df = step(df, F.when(t.rlike(_SIGN_OF_STEP[k]), done).otherwise(t) if k in _SIGN_OF_STEP else done)
    df = step(df, F.array_join(F.filter(F.split(t, "\n", -1), _line_kept), "\n"))
    df = step(df, re2.replace(re2.replace(t, X.SYMBOLS), X.RULE_LINE))
    df = step(df, F.array_join(F.filter(F.split(t, "\n", -1), lambda x: x.rlike(f"[^{X.WS}]")), "\n"))
    df = step(df, re2.replace(F.regexp_replace(t, "[ \t]{2,}|\t", " "), X.BEFORE_SIGN, "$1"))
    tags = reduce(lambda x, p: re2.replace(x, p), X.WORD_XML, t)
    df = step(df, F.when(t.contains("w:") | t.contains(">"), tags).otherwise(t))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(f"[^{X.WS}]") & ~re2.matches(trim(x), r"^[\s<>/]+$"))
    return step(step(df, F.array_join(lines, "\n")), trim(t))


def sql_clean_document(t: str, source: str, keys: str) -> str:
    """A SELECT of keys and text; each step is a subquery, so that no expression is repeated."""
    n = "length(x)"
    table = f"(strlen(x) >= 20 and ({sql_count('x', r'\p{Nd}')} + {sql_count('x', r'\p{P}')})::double / {n} > 0.5)"
    works = " or ".join(sql_matches("x", p) for p in X.BIBLIOGRAPHIC)
    noise = f"({n} >= 10 and {sql_count('x', r'\p{L}')}::double / {n} < 0.3)"
    steps = [sql_replace("t", *step) for step in X.TEXT_STEPS]
    kept = lambda cond: f"array_to_string(list_filter(string_split(t, chr(10)), lambda x: {cond}), chr(10))"
    steps += [kept(f"not ({table} or {works} or {noise})"), sql_replace("t", X.SYMBOLS), sql_replace("t", X.RULE_LINE), kept(f"{sql_trim('x')} <> ''")]
    steps += [sql_replace("t", "[ \\t]+", " "), sql_replace("t", X.BEFORE_SIGN, "$1"), *(sql_replace("t", p) for p in X.WORD_XML)]
    steps += [kept(f"{sql_trim('x')} <> '' and not {sql_matches(sql_trim('x'), r'^[\s<>/]+$')}"), sql_trim("t")]
    out = f"select {keys}, {t} as t from {source}"
    for s in steps:
        out = f"select {keys}, {s} as t from ({out})"
    return f"select {keys}, t as text from ({out})"
