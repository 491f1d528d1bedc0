"""Secret scan: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two first-order models over the token alphabet are trained from labelled samples, one
of random strings and one of ordinary words and identifiers. A long token whose
log-likelihood ratio favours the random model is a secret as well. Everything is
DataFrame work; the only thing that reaches the driver is the table of pair counts,
whose size is the square of the alphabet. Tokens from 8 characters on are candidates:
shorter ones can hardly gather the evidence that MIN_TOTAL asks for.

Defined cases: a null text counts as empty; an empty text has no spans; a very long text
or one with very many spans costs in proportion to its length; spans that begin at one
place are ordered by kind; repeated rows are scanned each for itself; an empty table
gives an empty result; other columns of the input, whatever their names, are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textspans import apart_from, find_spans, joined

# The patterns of the base scan.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
BASE_KINDS = ("assign", "access", "hex")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
CANDIDATE = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{8,}+"
ORDINARY = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{4,}+"

#: Bounds of the labelled sample: documents whose words are ordinary, generated random strings, generated ordinary strings of a shape,
#: identifiers, paths, dates and numbers of each shape.
SAMPLE_DOCUMENTS = 2000
SAMPLE_RANDOM = 3000
SAMPLE_PLAIN = 30
SAMPLE_SHAPES = 4000
# Words of which programs' names, paths and addresses are made.
PLAIN_WORDS = (
    "account action active address admin agent alert alias analysis api app application archive array asset async audit auth backup base batch binary block board body boot branch "
    "browser buffer build bundle button bytes cache call cancel card catalog center change channel check class client close cloud cluster code collection column command commit "
    "common compare component config connect console constant container content context control cookie copy core count create current custom dashboard data database date debug "
    "default delete deploy description design detail device directory disk display document domain download driver edit element email empty enable encode engine entry error event "
    "example exceeded export extension factory failed feature field file filter final folder format frame function gateway global graph group guide handler header health help history "
    "home host html http https icon image import include index info input install instance interface internal invoice item job keyboard label language latest layout level library limit link "
    "list load local location logger login manager master maximum member memory menu message method middleware migration minimum mobile model module monitor month mount name "
    "network node number object offset online option order output owner package page parent parser partition path payment pending picture pipeline platform player plugin policy "
    "pool port position post preview price print priority private process product profile project property protocol provider proxy public query queue random range read record "
    "redirect refresh region register release remote remove render report request reset resource response result retry review role root route runtime sample schedule schema scope "
    "screen script search section segment select sequence server service session settings setup shape share signal site size snapshot socket source stack standard start state static "
    "status storage store stream string style submit summary support switch symbol system table target task template terminal test text theme thread time timeout title toggle tools "
    "topic trace track transfer transform tree trigger type update upload upper user usr utils valid value vector version video view volume warning watch web website window worker "
    "workspace write www year zone"
).split()
#: A token is a secret if its ratio is at least this many nats in all and for each character.
MIN_TOTAL, MIN_MEAN = 18.0, 0.55


def _kinded(kind: str, order: int, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["match"].alias("match")
        ),
    )


def base_spans(text: Column) -> dict[str, Column]:
    """The three base kinds, each an array of spans in order; failing matches are dropped without a retry."""
    assign = F.filter(find_spans(text, ASSIGN), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 6)
    return {"assign": assign, "access": find_spans(text, ACCESS), "hex": find_spans(text, HEX)}


def labelled_samples(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(token, is_random): generated random strings in four alphabets, values of base spans, words of a bounded sample.

    The sample is the SAMPLE_DOCUMENTS documents first by a hash of the key; the same rows for the same table.
    Of its words, neighbours joined to identifiers are ordinary too, and so are repeated characters, the alphabet in order,
    and names, paths, addresses, constants, dates and numbers (ordinary_shapes).
    """
    spark = docs.sparkSession
    digest = F.sha2(F.col("id").cast("string"), 512)
    shapes = F.array(
        F.base64(F.unhex(digest)),
        digest,
        F.translate(F.base64(F.unhex(digest)), "+/=", "xyz"),
        F.translate(F.upper(F.base64(F.unhex(digest))), "+/=", "234"),
    )
    made = spark.range(SAMPLE_RANDOM).select(F.explode(shapes).alias("token"), F.lit(True).alias("is_random"))
    chosen = docs.select(F.col(key).alias("_key")).where(F.col(key).isNotNull()).distinct().orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE_DOCUMENTS)
    sample = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(
        F.broadcast(chosen), "_key", "left_semi"
    )
    found = base_spans(F.col("_text"))
    values = F.concat(
        F.transform(found["assign"], lambda s: F.regexp_extract(s["match"], ASSIGN, 2)),
        F.transform(found["access"], lambda s: s["match"]),
        F.transform(found["hex"], lambda s: s["match"]),
    )
    real = sample.select(F.explode(values).alias("token"), F.lit(True).alias("is_random"))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col("_text"), ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = sample.select(F.regexp_extract_all(plain, F.lit(ORDINARY), F.lit(0)).alias("words"))
    camel = F.zip_with(
        F.slice("words", 1, F.size("words") - 1),
        F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))),
        lambda a, b: F.concat(F.upper(F.substring(b, 1, 3)), F.initcap(a), F.initcap(b)),
    )
    named = F.when(F.size("words") > 1, F.concat("words", camel)).otherwise(F.col("words"))
    ordinary = words.select(F.explode(named).alias("token"), F.lit(False).alias("is_random"))
    character = F.explode(F.split(F.lit(ALPHABET), "")).alias("c")
    repeated = spark.range(SAMPLE_PLAIN).select(character).select(F.repeat("c", F.lit(40)).alias("token"), F.lit(False).alias("is_random"))
    in_order = spark.range(10 * SAMPLE_PLAIN).select(F.lit(ALPHABET).alias("token"), F.lit(False).alias("is_random"))
    return made.unionByName(real).unionByName(ordinary).unionByName(repeated).unionByName(in_order).unionByName(ordinary_shapes(spark))


def ordinary_shapes(spark, each: int = SAMPLE_SHAPES) -> DataFrame:
    """(token, is_random): each of the shapes that names, paths, addresses, constants, dates and numbers have, made of PLAIN_WORDS by a hash."""
    words = F.split(F.lit(" ".join(PLAIN_WORDS)), " ")
    pick = lambda k, n: F.pmod(F.xxhash64(F.col("id"), F.lit(k)), F.lit(n)).cast("int")
    word = lambda k: F.element_at(words, pick(k, len(PLAIN_WORDS)) + 1)
    some = lambda apart, k=0: F.array_join(F.slice(F.array(*(word(f"{k}{i}") for i in range(6))), F.lit(1), pick("n", 4) + 3), apart)
    digits = lambda n, k="d": F.substring(F.conv(F.substring(F.sha2(F.concat(F.col("id").cast("string"), F.lit(k)), 256), 1, 15), 16, 10), -n, n)
    date = F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), pick("day", 15_000)), "yyyy-MM-dd")
    camel = F.array_join(F.transform(F.slice(F.array(*(word(f"c{i}") for i in range(5))), F.lit(1), pick("m", 4) + 2), F.initcap), "")
    shapes = [
        F.concat(F.lit("/"), some("/")), F.concat(some("/"), F.lit("-"), word("x")), F.concat(F.lit("/"), some("/"), F.lit("/"), word("x"), F.lit("-"), word("y")),
        F.concat(F.lit("https/"), word("x"), F.lit("-"), word("y"), F.lit("/"), some("/")), F.concat(F.lit("//"), some("/"), F.lit("/")),
        some("-"), some("_"), F.upper(some("_")), F.upper(some("_", 2)), F.upper(some("-")), camel, F.concat(F.lower(F.substring(camel, 1, 1)), F.substring(camel, 2, 80)),
        F.concat(word("x"), F.lit("_"), camel), F.concat(camel, digits(2)), F.concat(date, F.lit("-"), some("-")), F.concat(some("-"), F.lit("-"), date), F.concat(some("_"), F.lit("_"), F.translate(date, "-", "")),
        F.concat(date, F.lit("/"), word("x")), F.concat(some("/"), F.lit("/"), F.translate(date, "-", "/")), date, F.concat_ws("-", digits(3), digits(3, "e"), digits(4, "f")),
        F.concat(word("x"), F.lit("-"), digits(4)), F.concat(some("-"), F.lit("-v"), digits(1), F.lit("-"), digits(1, "e")), F.concat(word("x"), digits(3)),
        *(digits(n) for n in (8, 10, 12, 14, 16)), F.concat(digits(8), digits(8, "e")), F.concat(digits(10), digits(10, "e")), F.concat_ws("-", digits(4), digits(4, "e"), digits(4, "f"), digits(4, "g")),
        F.concat(some("="), F.lit("=")), F.concat(word("x"), F.lit("="), digits(6)),
    ]
    return spark.range(each).select(F.explode(F.array(*shapes)).alias("token"), F.lit(False).alias("is_random"))


def train(samples: DataFrame) -> list[float]:
    """Log ratio of the two models for each pair of characters, row by row of the alphabet.

    Row 0 holds the first characters. Counts are smoothed by a half; the pair counts that
    reach the driver are at most 2 * 68 * 67.
    """
    chars = F.split("token", "")
    pairs = F.zip_with(F.concat(F.array(F.lit("\n")), chars), chars, lambda a, b: F.concat(a, b))
    counts = (
        samples.where(F.length("token") > 0)
        .select("is_random", F.explode(pairs).alias("pair"))
        .where(F.col("pair").isNotNull())
        .groupBy("is_random", "pair")
        .count()
    )
    size = len(ALPHABET)
    place = {c: i for i, c in enumerate("\n" + ALPHABET)}
    table = {label: [[0.5] * (size + 1) for _ in range(size + 1)] for label in (True, False)}
    for row in counts.collect():
        a, b = (place.get(c) for c in row["pair"])
        if a is not None and b is not None:
            table[row["is_random"]][a][b] += row["count"]
    flat: list[float] = []
    for a in range(size + 1):
        totals = {label: sum(rows[a][1:]) for label, rows in table.items()}
        flat.append(0.0)
        flat += [
            math.log(table[True][a][b] / totals[True]) - math.log(table[False][a][b] / totals[False]) for b in range(1, size + 1)
        ]
    return flat


def log_ratio(token: Column, weights: list[float]) -> Column:
    """Sum of the pair weights along token, all of whose characters are in the alphabet."""
    table = F.split(F.lit(" ".join(f"{w:.4f}" for w in weights)), " ").cast("array<double>")
    width = len(ALPHABET) + 1
    place = lambda c: F.instr(F.lit(ALPHABET), c)  # noqa: E731  0: not in it, as before the first
    zero = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))

    def add(acc: Column, c: Column) -> Column:
        here = place(c)
        return F.struct(here.alias("before"), (acc["sum"] + F.get(table, acc["before"] * width + here)).alias("sum"))

    return F.aggregate(F.split(token, ""), zero, add, lambda acc: acc["sum"])


def scan(docs: DataFrame, weights: list[float], text: str = "text") -> DataFrame:
    """docs with base (array of base spans by start, then kind) and secrets (base and model's spans, same order).

    A model's span is a token of 8 or more characters, apart from base spans, whose ratio
    passes both thresholds. _base and _secrets, struct<start, rank, end, kind, match>, replace columns of these names.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = base_spans(body)
    base = F.array_sort(F.concat(*(_kinded(k, i, found[k]) for i, k in enumerate(BASE_KINDS))))
    scored = docs.withColumn("_base", base).withColumn("_tokens", find_spans(body, CANDIDATE))
    random_like = F.filter(
        "_tokens", lambda s: log_ratio(s["match"], weights) >= F.greatest(F.lit(MIN_TOTAL), MIN_MEAN * F.length(s["match"]))
    )
    random_like = apart_from(random_like, F.col("_base"))
    extra = _kinded("markov", len(BASE_KINDS), random_like)
    return scored.withColumn("_secrets", F.array_sort(F.concat("_base", extra))).drop("_tokens")


def secrets_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""
    weights = train(labelled_samples(docs))
    found = scan(docs.select("doc_id", "text"), weights)
    count = lambda kind: F.size(F.filter("_secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in (*BASE_KINDS, "markov")),
        F.sha2(joined(F.col("_base")), 256).alias("base_sha256"),
        joined(F.col("_secrets")).alias("spans"),
    )
