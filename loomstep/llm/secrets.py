"""Secrets in texts: fixed patterns, and tokens that a model of random strings explains better than one of identifiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstep.llm.charmodel import codes, gram_counts, held_steps, log_ratio_table, mean_log_ratio, threshold
from loomstep.llm.common import cut_out, discard, let, materialize, running
from loomstep.schema import free_names

#: Kinds in the order in which they are listed; the last one is the models'.
KINDS = ("assign", "access", "hex", "random")
_KEYS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = (
    "(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k) for k in _KEYS) + ")"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]+"
#: Runs of hexadecimal digits; shorter ones would fail anyway.
HEX = "[0-9a-f]{32,}"
#: Characters of a token that may be a random string, at least.
SHORTEST = 16
TOKEN = f"[A-Za-z0-9+/_=-]{{{SHORTEST},}}"
#: Words of the corpus that train the identifiers, all shorter than what is judged.
WORD = f"(?<![A-Za-z0-9_-])[A-Za-z][A-Za-z0-9_-]{{5,{SHORTEST - 2}}}(?![A-Za-z0-9_-])"
#: What the models read: letters count alike in either case, ^ stands where the case changes inside a word, digits count as 0.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0^+/_=-."
SIZE = len(ALPHABET) + 1
#: Characters of context at most, and the counts that a shorter context's estimate stands for.
ORDER, STRENGTH = 2, 200.0
_CASE = "(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"
_ALL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_=+/"
#: Rows of generated samples of each kind; one of so many labelled samples is held out for the threshold.
SEEDED, HELD_OUT = 1000, 5
#: Share of held-out random strings that the threshold may miss, and of held-out identifiers that may pass it, at most.
MOST_MISSED, MOST_FALSE = 0.02, 0.005
#: Words of which sample identifiers are made.
IDENTIFIERS = (
    "access account action add address admin api app archive array asset async backup base batch before bin block body book box branch "
    "buffer build bundle byte cache call cell chain change channel char check class client clone code color column command commit common "
    "config connection container content context control copy core count create current data date db debug default delete depth device "
    "display doc domain download driver element end entry error event example export factory feature field file filter flag folder format "
    "frame function get global group handler hash header height host http id image import index info input instance int interface internal "
    "item iterator job key label layer layout lib library line link list load local log main manager map max memory message method min mode "
    "model module name network node number object offset open option order output owner package page parse path pending pool port position "
    "process profile project python query queue random range rate reader record reference register release remote render report request "
    "reset resource response result retry return role root route row rule run sample scan schedule schema scope score screen script search "
    "second section select sequence server service session set setting shape share signal size sort source space split stack stage start "
    "state static status step storage store stream string style sum summary support switch symbol sync system table tag target task template "
    "test text thread time timeout title token tool total trace track transaction transform tree trigger type union unit update upload url "
    "usage user util valid value variable vector version view visible volume wait watch web weight width window word work worker wrapper "
    "write writer year zone"
).split()


@dataclass(frozen=True)
class Model:
    """table: one row with the log ratios; least: the mean log ratio of a character from which on a token is random."""

    table: DataFrame
    least: float


_HIT = "array<struct<start: int, end: int, text: string>>"


def matches(text: Column, pattern: str) -> Column:
    """Array of struct(start, end, text) of a pattern's matches from left to right, in code points.

    The pieces between the matches give the places, so the text is scanned once, and again where it has a
    match; ends are running sums, so the cost is near linear in the matches.
    """

    def placed(found: Column) -> Column:
        length = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found, lambda g, h: F.length(g) + F.length(h))
        ends = running(length, lambda a, b: a + b)
        return F.zip_with(ends, found, lambda e, h: F.struct((e - F.length(h)).alias("start"), e.alias("end"), h.alias("text")))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(found, lambda x: F.when(F.size(x) > 0, placed(x)).otherwise(F.array().cast(_HIT)))


def base_spans(text: Column) -> Column:
    """Array of struct(start, kind, end, text) of the fixed patterns; kind is a place in KINDS."""
    value = F.regexp_extract
    kinds = [
        (0, F.filter(matches(text, ASSIGN), lambda m: F.length(value(m["text"], ASSIGN, 2)) >= 8)),
        (1, F.filter(matches(text, ACCESS), lambda m: F.length(m["text"]) >= 16)),
        (2, matches(text, HEX)),
    ]

    def named(kind: int):
        return lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"), m["text"].alias("text"))

    return F.concat(*(F.transform(found, named(k)) for k, found in kinds))


def shape(token: Column) -> Column:
    """A token's codes."""
    return codes(F.translate(F.lower(F.regexp_replace(token, _CASE, "^")), "123456789", "000000000"), ALPHABET)


def generated(spark: SparkSession, rows: int = SEEDED) -> DataFrame:
    """(w, y): seeded random strings of the usual alphabets and lengths (1) and identifiers, paths, dates, versions and runs (0)."""
    row = spark.range(rows)
    number = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))
    hexes = lambda salt: F.concat(*(F.sha2(F.concat_ws(":", F.lit(salt + part), F.col("id").cast("string")), 256) for part in "ab"))
    mixed = lambda salt: F.base64(F.unhex(hexes(salt)))
    raw = [
        hexes("hex"), mixed("64"), F.translate(mixed("url"), "+/", "-_"), F.regexp_replace(F.upper(mixed("32")), "[^A-Z0-9]", ""),
        F.regexp_replace(F.lower(mixed("36")), "[^a-z0-9]", ""), F.regexp_replace(mixed("62"), "[^A-Za-z0-9]", ""), F.regexp_replace(mixed("52"), "[^A-Za-z]", ""),
        F.regexp_replace(F.lower(mixed("26")), "[^a-z]", ""), F.regexp_replace(F.upper(mixed("AZ")), "[^A-Z]", ""),
    ]
    size = (number("length", 33) + SHORTEST).cast("int")
    raw = row.select(F.explode(F.array(*(F.substring(x, F.lit(1), size) for x in raw))).alias("w"), F.lit(1).alias("y"))

    words = F.array(*map(F.lit, IDENTIFIERS))
    word = lambda salt: F.get(words, number(salt, len(IDENTIFIERS)).cast("int"))
    a, b, c, d = map(word, "abcd")
    digits = lambda salt, n: F.lpad(number(salt, 10**n).cast("string"), n, "0")
    year, month, day = (1990 + number("y", 45)).cast("string"), F.lpad((1 + number("m", 12)).cast("string"), 2, "0"), F.lpad((1 + number("d", 28)).cast("string"), 2, "0")
    few = (1 + number("few", 9)).cast("string")
    camel = F.concat(a, *map(F.initcap, (b, c, d)))
    long = F.concat(a, b, c, d)  # words of one case without a mark between
    path = F.concat(F.lit("/usr/"), a, F.lit("/"), b, few, F.lit("/"), c, F.lit("-"), d)
    plain = [
        F.concat_ws("_", a, b, c, d), F.concat_ws("-", a, b, c, d), F.upper(F.concat_ws("_", a, b, c)), camel, F.initcap(camel),
        long, F.upper(long), F.initcap(long), F.concat(b, d, a, c, d),
        F.concat(camel, few, F.initcap(F.concat(b, a))), F.concat(a, F.initcap(b), F.lit("By"), F.initcap(c), year, F.initcap(d)),
        F.concat_ws("_", a, b, year, month, day), F.concat_ws("-", year, month, day, a, b), F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit("T"), digits("t", 6)),
        F.concat_ws("_", a, b, c, digits("n", 10)), F.concat_ws("-", a, digits("e", 4), few, b, digits("f", 4), c), F.concat(a, b, digits("g", 3), F.lit("_"), c, few),
        path, F.concat(path, F.lit("/"), a, F.lit("_"), c, digits("h", 2)), F.concat_ws("/", a, b, c, d), F.concat(a, F.lit("="), b, digits("i", 2), F.lit("/"), c, F.lit("="), few, d),
        F.concat(F.lit("v"), few, F.lit("-"), digits("j", 2), F.lit("-"), a, few, F.lit("-"), b, F.lit("-"), year), digits("k", 18), F.concat(F.lit("0000000"), digits("l", 12)),
        F.repeat(F.substring(F.lit(_ALL), (1 + number("z", len(_ALL))).cast("int"), F.lit(1)), (number("r", 60) + SHORTEST).cast("int")),
        F.substring(F.lit(2 * _ALL), (1 + number("v", len(_ALL))).cast("int"), (number("w", 40) + SHORTEST).cast("int")),
        F.repeat(F.substring(F.lit("=-+_/"), (1 + number("s", 5)).cast("int"), F.lit(2)), (number("u", 30) + SHORTEST).cast("int")),
    ]
    return raw.unionByName(row.select(F.explode(F.array(*plain)).alias("w"), F.lit(0).alias("y")))


def train(base: DataFrame, docs: DataFrame, text_col: str) -> Model:
    """Two models of second order from labelled samples over the whole corpus, and their threshold.

    Label 1: values with a digit that the patterns find, and generated random strings, so that the model does not
    depend on which secrets the corpus has. Label 0: the corpus's own short words and identifiers, each distinct
    one with the square root of the number of rows that have it, and generated identifiers; a token that is to
    be judged does not speak for itself. The threshold is fitted on held-out samples as long as what is judged.
    """
    value = F.regexp_replace("s.text", r"^[^:=]*[:=][\x20\"']*", "")
    secret = base.select(F.explode("spans").alias("s")).select(value.alias("w")).where(F.col("w").rlike("[0-9]")).distinct().withColumn("y", F.lit(1))
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(WORD), F.lit(0)))).alias("w"))
    words = words.groupBy("w").agg(F.sqrt(F.count(F.lit(1))).alias("n")).withColumn("y", F.lit(0))
    made = secret.unionByName(generated(docs.sparkSession)).withColumn("n", F.lit(1.0)).unionByName(words)
    held = F.pmod(F.xxhash64("w"), F.lit(HELD_OUT)) == 0
    made = materialize(made.select("w", "y", "n", held.alias("held")), "samples")
    counts = gram_counts(made.where("not held").withColumn("c", shape(F.col("w"))), "y", "c", ORDER, SIZE, "n")
    counts = materialize(counts, "grams")
    table = log_ratio_table(counts, "y", ORDER, SIZE, STRENGTH)
    long = made.where("held").where(F.length("w") >= SHORTEST).withColumn("_t", table.scalar())
    least = threshold(held_steps(long, "y", mean_log_ratio(shape(F.col("w")), F.col("_t"), ORDER, SIZE)), MOST_MISSED, MOST_FALSE)
    discard(counts)
    discard(made)
    return Model(table, least)


def secret_spans(docs: DataFrame, *, text_col: str = "text", out: str = "secrets", model: Model | None = None) -> DataFrame:
    """docs with an array of struct(start, kind, end) by start, then kind, for each whole text; offsets in code points.

    kind is a place in KINDS. A token of SHORTEST characters and more is a random span if its mean log ratio is
    the model's threshold or more, whatever its letters, and no fixed pattern overlaps it. Null and empty texts have an
    empty array; other columns and repeated rows stay, an empty table gives no rows. A column named like out is replaced.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    if model is None:
        model = train(docs.select(base_spans(text).alias("spans")), docs, f"`{text_col}`")
    fixed, token, table = free_names(docs, "base", "token", "t")
    score = lambda t: mean_log_ratio(shape(t), F.col(table), ORDER, SIZE)
    rows = docs.withColumn(fixed, base_spans(text)).withColumn(table, model.table.scalar())
    rows = rows.withColumn(token, F.filter(matches(text, TOKEN), lambda m: score(m["text"]) >= model.least))
    span = lambda m, k: F.struct(m["start"].alias("start"), k.alias("kind"), m["end"].alias("end"))
    base = F.transform(fixed, lambda m: span(m, m["kind"]))
    own = F.transform(token, lambda m: span(m, F.lit(len(KINDS) - 1)))
    own = F.when((F.size(fixed) > 0) & (F.size(token) > 0), _apart(base, own)).otherwise(own)
    return rows.withColumn(out, F.sort_array(F.concat(base, own))).drop(fixed, token, table)


def _apart(base: Column, own: Column) -> Column:
    """The spans of own that no span of base overlaps: by the last end before and the next start behind each."""
    last, far = len(KINDS) - 1, 2**31 - 1

    def keep(both: Column) -> Column:
        before = running(F.transform(both, lambda m: F.when(m["kind"] == last, 0).otherwise(m["end"])), F.greatest)
        behind = running(F.reverse(F.transform(both, lambda m: F.when(m["kind"] == last, far).otherwise(m["start"]))), F.least)
        near = F.arrays_zip(both.alias("m"), before.alias("before"), F.reverse(behind).alias("behind"))
        near = F.filter(near, lambda x: (x["m"]["kind"] == last) & (x["before"] <= x["m"]["start"]) & (x["behind"] >= x["m"]["end"]))
        return F.transform(near, lambda x: x["m"])

    return let(F.sort_array(F.concat(base, own)), keep)


def span_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    part = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, part), ",")


def redact(docs: DataFrame, *, text_col: str = "text", mark: str = "[SECRET]", model: Model | None = None) -> DataFrame:
    """docs with each secret of the text replaced by mark, overlapping spans by one; rows and columns stay."""
    [spans_col] = free_names(docs, "secrets")
    found = secret_spans(docs, text_col=text_col, out=spans_col, model=model)
    text = F.col(f"`{text_col}`")

    def clean(spans: Column) -> Column:
        ends = running(F.transform(spans, lambda s: s["end"]), F.greatest)

        def joined(reached: Column) -> Column:
            before = lambda i: F.when(i > 0, F.get(reached, i - 1)).otherwise(0)
            gaps = F.transform(spans, lambda s, i: F.struct(before(i).alias("start"), (s["start"] - before(i)).alias("length")))
            last = F.struct(F.get(reached, F.size(reached) - 1).alias("start"), F.length(text).alias("length"))
            kept = F.concat(F.filter(gaps, lambda g: g["length"] >= 0), F.array(last))
            return let(kept, lambda g: F.array_join(cut_out(text, g), mark))

        return let(ends, joined)

    return found.withColumn(text_col, F.when(F.size(spans_col) > 0, clean(F.col(spans_col))).otherwise(text)).drop(spans_col)
