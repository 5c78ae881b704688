import hashlib
import math
import random
import re
import string
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierline.llm import pii, secret_scan

SECRETS = [
    ("assign", re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
     lambda m: len(m[1]) >= 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


PERSONAL = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m[0].split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(digits(m)) <= 15),
]


def expected(text, kinds):
    spans = sorted((m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, pattern, good) in enumerate(kinds)
                   for m in pattern.finditer(text or "") if good(m))
    counts = Counter(k for _, k, _ in spans)
    return [*(counts[k] for k in range(len(kinds))),
            hashlib.sha256(",".join(s for _, _, s in spans).encode()).hexdigest()], {s for _, _, s in spans}


HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
SECRET_TEXTS = [
    None, "", "nothing", f"😀é token = \"{HEX}\"", "password=abc token: \"abcdefgh1\"", "AKIA" + "A" * 11, "AKIA" + "B" * 12 + "c",
    "AKIAAKIAAKIAAKIA", "token=secret=abcdefgh12 x" * 3, "API_KEY:12345678 apikey = 1234567", HEX + "g" + HEX[:31], "0a" * 100_000,
    "PassWord\"  :  'abc.def-ghi'", f"{HEX}\n{HEX} {HEX}",
]
PERSONAL_TEXTS = [
    None, "", "a@b.c_d@e.f x@y z@q.w. @ a@b", "1.2.3.4.5.6.7.8 256.1.1.1 000001.2.3.04 1.2.3 1..2.3.4", "4111 1111 1111 1111",
    "4111-1111-1111-1111 5", "4111111111111112, 4111 1111 1111 1111", "😀é +1 (293) 555-9179 +1+2 345 678 901) +12345678",
    "a@" + "b.c" * 20_000, "+1" + "-" * 50_000, "a@b.c " * 5000, "1.2.3.4" * 2000, "x@y.z+1 234 567 890", "1" * 19 + " " + "1" * 20,
]


@pytest.mark.parametrize("report,kinds,texts", [(secret_scan.report, SECRETS, SECRET_TEXTS), (pii.report, PERSONAL, PERSONAL_TEXTS)])
def test_base_kinds_against_plain_patterns(documents, by_id, report, kinds, texts):
    found = by_id(report(documents(*texts)))
    for i, text in enumerate(texts):
        values, spans = expected(text, kinds)
        assert list(found[i])[1:len(kinds) + 2] == values, text and text[:60]
        assert spans <= set(found[i].spans.split(","))
        starts = [int(s.split(":")[1]) for s in found[i].spans.split(",") if s]
        assert starts == sorted(starts)


@pytest.mark.parametrize("report", [secret_scan.report, pii.report])
def test_long_runs_are_not_tried_from_every_place(documents, report):
    docs = documents("a" * 300_000, "1" * 300_000, "A1" * 200_000, "a-" * 100_000, "token" + " " * 300_000)
    assert report(docs).count() == 5


def _entropy(text):
    return max((-sum(c / 20 * math.log2(c / 20) for c in Counter(text[i:i + 20]).values())
                for i in range(len(text) - 19)), default=0.0)


def test_window_entropy(spark):
    texts = ["", "a", "a" * 20, "abcdefghijklmnopqrst", "a" * 30 + "bcdefghijklmnopqrstu" + "a" * 30, HEX, "Zx9kQ2mP7vL4tR8wB3nY6cD1"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", secret_scan.window_entropy(F.col("t")))
    for text, bits in rows.collect():
        assert bits == pytest.approx(_entropy(text), abs=1e-9)


def plain_class(text):
    if re.fullmatch("[0-9]+", text):
        return "digits"
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", text):
        return "hex"
    for name, letters in (("lower", "[a-z]+"), ("upper", "[A-Z]+"), ("letters", "[A-Za-z]+")):
        if re.fullmatch(letters, text):
            return name
    return "wide" if re.search("[0-9]", text) and re.search("[A-Za-z]", text) else None


ALPHABETS = {"digits": string.digits, "hex": "0123456789abcdef", "lower": string.ascii_lowercase, "upper": string.ascii_uppercase,
             "letters": string.ascii_letters, "wide": string.ascii_letters + string.digits + "+/_=-"}


@pytest.mark.parametrize("name", list(ALPHABETS))
def test_random_strings_of_each_class_against_a_plain_window(documents, by_id, name):
    rng = random.Random(name)
    # Few and many different characters, so both sides of the threshold occur.
    values = ["".join(rng.choices(rng.sample(ALPHABETS[name], rng.randint(min(6, len(ALPHABETS[name])), len(ALPHABETS[name]))),
                                  k=rng.randint(20, 90))) for _ in range(150)]
    values = [v for v in values if not re.search(secret_scan.ALLOWED, v)]
    found = by_id(secret_scan.report(documents(*(f"x {v} y" for v in values))))
    seen = Counter()
    for i, value in enumerate(values):
        kind = plain_class(value)
        want = kind is not None and _entropy(value) >= secret_scan.THRESHOLDS[kind] - 1e-12
        assert (f"entropy:2:{2 + len(value)}" in found[i].spans.split(",")) == want, value
        seen[kind, want] += 1
    assert seen[name, True] > 5 and seen[name, False] > 5
    assert secret_scan.THRESHOLDS[name] < math.log2(min(len(ALPHABETS[name]), secret_scan.WINDOW))


def test_random_letters_and_digits_are_found_and_long_words_are_not(documents, by_id):
    rng = random.Random(40)
    hidden = ["".join(rng.choices(ALPHABETS[n], k=300)) for n in ("letters", "lower", "digits") for _ in range(5)]
    words = ["internationalization", "Donaudampfschifffahrtsgesellschaft", "counterrevolutionaries", "path/to/some/other_file-name",
             "electroencephalographically"]
    found = by_id(secret_scan.report(documents(*hidden, *words)))
    assert all(found[i].spans for i in range(len(hidden)))
    assert not any(found[len(hidden) + i].spans for i in range(len(words)))


def test_entropy_kind_and_its_allow_list(documents, by_id):
    token = "Zx9kQ2mP7vL4tR8wB3nY6cD1"
    found = by_id(secret_scan.report(documents(
        f"key {token} end", f"sha256: {token}", "z1q2" * 10, f"example{token}", "averylongwordwithoutanydigits")))
    assert [found[i].spans for i in range(5)] == ["entropy:4:28", "", "", "", ""]


def test_redact(documents):
    texts = [f"a token = \"{HEX}\" b", "clean text 123", None, "", f"x {HEX} y AKIA{'B' * 12}"]
    docs = documents(*texts).withColumn("value", F.lit(1)).withColumn("kind", F.lit("k"))
    found = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    assert found == {0: 'a [SECRET]" b', 1: texts[1], 2: None, 3: "", 4: "x [SECRET] y [SECRET]"}
    assert secret_scan.redact(docs).columns == docs.columns


def test_other_personal_kinds_need_checksum_or_context(documents, by_id):
    found = by_id(pii.report(documents(
        "IBAN DE89 3704 0044 0532 0130 00.", "IBAN DE88 3704 0044 0532 0130 00.", "ssn 123-45-6789", "serial 123-45-6789", "ssn 666-45-6789")))
    assert [found[i].spans for i in range(5)] == ["iban:5:32", "", "national_id:4:15", "", ""]
    assert found[0].scores == "1.0" and found[2].scores == "0.6"


def test_bank_accounts_end_at_the_length_of_their_country(documents, by_id):
    german, british = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    texts = [f"IBAN {german} BIC COBADEFFXXX", f"IBAN {british} EUR 500", f"IBAN {german} {british} 7", f"IBAN {german.replace(' ', '')} 12",
             f"IBAN {german}1", f"IBAN AB12 {german} USD", "IBAN NO93 8601 1117 947 NOK", "IBAN MT84 MALT 0110 0001 2345 MTLC AST0 01S SWIFT"]
    found = by_id(pii.report(documents(*texts)))
    assert [[s for s in found[i].spans.split(",") if s.startswith("iban")] for i in range(8)] == [
        ["iban:5:32"], ["iban:5:32"], ["iban:5:32", "iban:33:60"], ["iban:5:27"], [], ["iban:10:37"], ["iban:5:23"], ["iban:5:43"]]


@pytest.mark.parametrize("report", [secret_scan.report, pii.report])
def test_rows_and_columns(documents, report):
    docs = documents((1, "a@b.cd"), (1, "a@b.cd"), (None, f"token={HEX}")).withColumns(
        {c: F.lit("x") for c in ("tag", "kind", "start", "end", "value", "hit", "spans", "found0")})
    assert sorted(str(r.doc_id) for r in report(docs).collect()) == ["1", "1", "None"]
    assert report(documents()).count() == 0
    plan = report(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
