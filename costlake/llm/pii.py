"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

SQL functions only. The four base kinds stay whatever their score; the two further kinds,
iban (mod-97, each as long as its country's codes are) and ssn, are kept from MIN_SCORE on.

Defined cases: a null text counts as empty and stays null when redacted; an empty text has
no spans; a very long text or one with very many spans costs in proportion to its length;
of spans of different kinds, or of codes that begin within another code, all are reported,
and where they overlap the text is marked once, by the first; repeated rows are scanned
each for itself; an empty table gives an empty result; other columns of the input,
whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textspans import find_spans, joined, replace_spans

# Countries by the length of their IBAN, those that use the form without being registered included.
IBAN_COUNTRIES = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG DZ",
    25: "LY PT ST AO CV GW MZ",
    26: "IS TR IR",
    27: "BI DJ FR GR IT MC SM CF CG CM GA GQ KM MG TD",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV BF BJ CI MA ML NE SN TG",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


CODES = "|".join(
    rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}+(?![A-Za-z0-9])" for n, names in IBAN_COUNTRIES.items()
)

# Patterns of the kinds. Group loops are possessive and digit or word runs
# are entered only at their start, which finds the same matches in linear time.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # matches the country alone, so that a code that fails mod-97 does not hide one that begins within it; the group is the code
    "iban": f"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=({CODES}))[A-Z]{{2}}",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE_KINDS = ("email", "ip", "card", "phone")
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"

#: Characters before and after a span in which context words count, and of an IBAN written with a space after each character.
BEFORE, AFTER, LONGEST_IBAN = 40, 20, 64

# Score of a confirmed span by kind, and context words (English, German, French, Spanish) around it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.7, "ssn": 0.3}
CONTEXT = {
    "email": r"(?iu)\b(e-?mail|mail|contact|write to|kontakt|schreiben an|courriel|écrire à|correo|escribir a)\b",
    "ip": r"(?iu)\b(ip|host|server|address|login|adresse|serveur|servidor|dirección)\b",
    "card": r"(?iu)\b(card|credit|debit|visa|mastercard|payment|cvv|karte|kreditkarte|carte|tarjeta|pago)\b",
    "phone": r"(?iu)\b(phone|call|tel|mobile|fax|whatsapp|telefon|anrufen|handy|téléphone|appeler|portable|teléfono|llamar|móvil)\b",
    "iban": r"(?iu)\b(iban|bank|account|konto|transfer|swift|bic|überweisung|compte|virement|cuenta|banco)\b",
    "ssn": r"(?iu)\b(ssn|social security|tax id|taxpayer|steuernummer|sécurité sociale|seguridad social)\b",
}
AGAINST = r"(?iu)\b(version|release|order|invoice|isbn|issn|part|serial|build|example|rechnung|beispiel|facture|exemple|factura|ejemplo)\b"
MORE, LESS, MIN_SCORE = 0.3, 0.3, 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the digit string passes the Luhn checksum."""
    back = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """True if the code without spaces, its first four characters moved to the end and letters counted from A = 10, leaves 1 by 97."""
    turned = F.concat(F.substring(iban, F.lit(5), F.lit(64)), F.substring(iban, 1, 4))

    def add(acc: Column, i: Column) -> Column:
        v = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substring(turned, i, F.lit(1))) - 1
        return (acc * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def _whole_ibans(countries: Column) -> Column:
    """The spans of countries drawn out to their codes, those that pass mod-97."""

    def whole(s: Column) -> Column:
        size = F.length(s["match"])
        return F.struct(
            s["start"].alias("start"),
            (s["start"] + size).alias("end"),
            s["match"].alias("match"),
            s["before"].alias("before"),
            F.substring(s["after"], size - 1, F.lit(AFTER)).alias("after"),
        )

    return F.transform(F.filter(countries, lambda s: mod97(F.regexp_replace(s["match"], " ", ""))), whole)


def _confirmed(kind: str, spans: Column) -> Column:
    size = lambda s: F.length(_digits(s["match"]))
    checks = {
        "ip": lambda s: s["match"].rlike(OCTETS),
        "card": lambda s: size(s).between(13, 19) & luhn(_digits(s["match"])),
        "phone": lambda s: size(s).between(9, 15),
    }
    return F.filter(spans, checks[kind]) if kind in checks else spans


def _scored(kind: str, spans: Column) -> Column:
    def score(s: Column) -> Column:
        near = F.concat_ws(" ", s["before"], s["after"])
        raised = F.lit(SCORES[kind]) + F.when(near.rlike(CONTEXT[kind]), MORE).otherwise(0.0) - F.when(near.rlike(AGAINST), LESS).otherwise(0.0)
        return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raised)), 2)

    return F.transform(
        spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score(s).alias("score"))
    )


def found_in(text: Column) -> Column:
    """Array of struct<kind, start, end, score> by kind as in PATTERNS, then start."""
    kept = []
    for kind, pattern in PATTERNS.items():
        if kind == "iban":
            found = _whole_ibans(find_spans(text, pattern, 1, BEFORE, AFTER + LONGEST_IBAN))
        else:
            found = _confirmed(kind, find_spans(text, pattern, 0, BEFORE, AFTER))
        spans = _scored(kind, found)
        kept.append(spans if kind in BASE_KINDS else F.filter(spans, lambda s: s["score"] >= MIN_SCORE))
    return F.concat(*kept)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with each span in the text replaced by its kind in angle brackets; same columns in the same order.

    A column n_chars of whole numbers follows the new text's length.
    """
    spans = F.transform(
        found_in(F.coalesce(F.col(text), F.lit(""))), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    found = docs.withColumn(text, replace_spans(F.col(text), F.array_sort(spans)))
    kinds = dict(docs.dtypes)
    if kinds.get("n_chars") in ("int", "bigint"):
        found = found.withColumn("n_chars", F.length(text).cast(kinds["n_chars"]))
    return found.select(*(F.col(f"`{c}`") for c in docs.columns))


def pii_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans and their scores."""
    found = docs.select("doc_id", found_in(F.coalesce(F.col("text"), F.lit(""))).alias("_pii"))
    base = F.filter("_pii", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("_pii", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in PATTERNS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("_pii")).alias("spans"),
        F.array_join(F.transform("_pii", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
