"""Personal data in text: patterns, checksums, context words. SQL functions only.

Regular expressions propose spans. Validators confirm them: Luhn for cards,
mod-97 for bank account numbers, part ranges for addresses and national
numbers, digit counts for phones. Words shortly before or after a span raise or
lower its score. Spans of the four base kinds are reported whatever their
score; those of the other kinds need a score of ``ACCEPT``.

Patterns are written so that no match recurses and no run of characters is
tried again from each of its places, however long it is.

Defined results: a null text is empty; rows that share an id are reported each;
a row without an id is reported with a null one. Other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierline.llm.spans import Kind, joined, located, of_kind

#: Score from which spans of the kinds beyond the base are reported, and the step of a context word.
ACCEPT, STEP = 0.5, 0.3


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid Luhn check digit."""
    values = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), lambda c: c.cast("int"))
    counted = F.transform(values, lambda d, i: F.when(i % 2 == 0, d)
                          .when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(counted, F.lit(0), lambda total, d: total + d) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether a bank account number (letters A-Z, digits, spaces) has the remainder 1."""
    bare = F.regexp_replace(account, " ", "")
    moved = F.concat(F.substr(bare, F.lit(5)), F.left(bare, F.lit(4)))
    codes = F.transform(F.split(moved, "(?<=.)(?=.)"), lambda c: F.ascii(c))
    rest = F.aggregate(codes, F.lit(0), lambda r, c: F.when(c >= 65, (r * 100 + c - 55) % 97)
                       .otherwise((r * 10 + c - 48) % 97))
    return rest == 1


def _card(value: Column) -> Column:
    digits = _digits(value)
    return F.when(F.length(digits) <= 19, luhn(digits)).otherwise(False)


def _ip(value: Column) -> Column:
    # Leading zeros do not change a part's value.
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _phone(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def _national(value: Column) -> Column:
    area, group, serial = F.left(value, F.lit(3)), F.substring(value, 5, 2), F.right(value, F.lit(4))
    return ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")


#: The base kinds in the order of the contract, then the others. A long run is
#: entered at its start or where the last match ended.
BASE = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", ("@",)),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ("0.", "1.", "2.", "3.", "4.", "5.", "6.", "7.", "8.", "9."), _ip),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){11,}+", (), _card),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", ("+",), _phone),
]
#: Characters of a bank account number by country (fixed values), with the lengths in use in unregistered countries.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}
_REGISTERED = "(?:" + "|".join(
    rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{length - 4}}}"
    for length, countries in IBAN_LENGTHS.items()) + ")(?![A-Za-z0-9])"
#: Other countries: any length, up to the next number of a known length.
_UNREGISTERED = (rf"(?!{'|'.join(IBAN_LENGTHS.values()).replace(' ', '|')})[A-Z]{{2}}[0-9]{{2}}"
                 rf"(?:(?!\x20{_REGISTERED})\x20?[A-Z0-9]){{11,30}}(?![A-Za-z0-9])")

OTHER = [
    Kind("iban", rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_REGISTERED}|{_UNREGISTERED})", (), mod97),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", ("-",), _national),
]
KINDS = [*BASE, *OTHER]

#: Score of a confirmed span by kind, words that raise it and words that lower it (fixed values).
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "national_id": 0.3}
RAISING = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|kontakt|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|host|address|server|client|login|adresse)\b",
    "card": r"(?i)\b(?:card|credit|visa|mastercard|amex|payment|karte|tarjeta|carte)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|cell|fax|telefon|tel[eé]fono|t[eé]l[eé]phone)\b",
    "iban": r"(?i)\b(?:iban|account|bank|konto|cuenta|compte)\b",
    "national_id": r"(?i)\b(?:ssn|social|security|national|tax|passport|identity)\b",
}
LOWERING = {
    "email": r"(?i)\b(?:example|noreply|test)\b",
    "ip": r"(?i)\b(?:version|release|chapter|section|build)\b",
    "card": r"(?i)\b(?:order|tracking|invoice|serial|isbn|example|test)\b",
    "phone": r"(?i)\b(?:example|test|serial|order)\b",
    "iban": r"(?i)\b(?:example|test)\b",
    "national_id": r"(?i)\b(?:part|model|serial|order|example|test)\b",
}


def _score(kind: Kind) -> Column:
    near = F.concat_ws(" ", "before", "after")
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(START[kind.name])
                   + F.when(F.rlike(near, F.lit(RAISING[kind.name])), STEP).otherwise(0.0)
                   - F.when(F.rlike(near, F.lit(LOWERING[kind.name])), STEP).otherwise(0.0))), 2)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and ``spans``, an array of (start, kind, end, score, value).

    Spans are sorted by start, then kind as listed in ``KINDS``.
    """
    rows = located(docs, KINDS, id_column, text_column)
    score = F.lit(None).cast("double")
    for n, kind in enumerate(KINDS):
        confirmed = (F.col("kind") == n) & kind.valid(F.col("value"), F.col("before"))
        score = F.when(confirmed, _score(kind)).otherwise(score)
    reported = (F.col("kind") < len(BASE)) & F.col("score").isNotNull() | (F.col("score") >= ACCEPT)
    span = F.when(reported, F.struct("start", "kind", "end", "score", "value"))
    return rows.withColumn("score", score).groupBy("tag").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(span)).alias("spans"))


def report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, counts and digest of the base kinds, all spans as text, and their scores."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] < len(BASE))
    return scan(docs, id_column, text_column).select(
        "doc_id",
        *(F.size(of_kind(spans, n)).cast("long").alias(f"n_{k.name}") for n, k in enumerate(BASE)),
        F.sha2(joined(base, KINDS), 256).alias("base_sha256"), joined(spans, KINDS).alias("spans"),
        F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",").alias("scores"))
