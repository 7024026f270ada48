import hashlib
import re
from datetime import date, timedelta

from casebook.llm import pii
from pyspark.sql import functions as F

HEX = "0123456789abcdef"


def mix(*parts):
    return hashlib.sha256("|".join(map(str, ("k", *parts))).encode()).hexdigest()


def feistel(s, kind, hexed=False):
    def shift(c, by):
        if hexed:
            return HEX[(HEX.index(c) + by) % 16]
        for first, size in pii.CLASSES:
            if first <= ord(c) < first + size:
                return chr((ord(c) - first + by) % size + first)
        return c

    left, right = s[: len(s) // 2], s[len(s) // 2 :]
    for i in range(1, pii.ROUNDS + 1):
        left, right = right, "".join(shift(c, int(mix(kind, i, k // 16, len(left), right)[k % 16 * 4 :][:4], 16)) for k, c in enumerate(left))
    return left + right


def luhn(s):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(s))) % 10 == 0


def day(d):
    first, size, a, b, kind = next(x for x in pii.DAYS if 0 <= (d - date.fromisoformat(x[0])).days < x[1])
    n = (d - date.fromisoformat(first)).days
    while True:
        hi, lo = divmod(n, b)
        for i in range(1, pii.ROUNDS + 1):
            hi = (hi + int(mix(kind, i, "hi", lo)[:8], 16)) % a
            lo = (lo + int(mix(kind, i, "lo", hi)[:8], 16)) % b
        n = hi * b + lo
        if n < size:
            return date.fromisoformat(first) + timedelta(n)


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in enumerate(texts)], "doc_id long, text string, text_was string, pii_got string, found string")
    rows = pii.pseudonymize(df, key="k").orderBy("doc_id").collect()
    assert all((r.text_was, r.pii_got, r.found) == ("x", "y", "z") for r in rows)
    return [(r.text, [(x.kind, x.value) for x in r.found_]) for r in rows]


def test_values(spark):
    good, bad = "4845168114407329", "4845168114407328"
    assert luhn(good) != luhn(bad)
    if not luhn(good):
        good, bad = bad, good
    body = feistel(good[:-1], "card")
    new = next(body + c for c in "0123456789" if luhn(body + c))
    national = feistel("0175557713", "phone")
    ip = feistel("61119982", "ip", True)
    dotted = ".".join(str(int(ip[k : k + 2], 16)) for k in (0, 2, 4, 6))
    token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    mail = feistel("réou.9@mail7.example", "email") + ".com"
    spaced = lambda s: " ".join(s[k : k + 4] for k in (0, 4, 8, 12))
    pairs = [
        (f"Pay {good}, now", f"Pay {new}, now"), (f"{spaced(good)}", f"{spaced(new)}"), (f"no {bad}.", f"no {bad}."),
        ("Tel +1 (017) 555-7713!", f"Tel +1 ({national[:3]}) {national[3:6]}-{national[6:]}!"), ("(017) 555-7713", f"({national[:3]}) {national[3:6]}-{national[6:]}"),
        ("at 97.17.153.130.", f"at {dotted}."), ("v 397.51.17.173 and 1.2.3.4.5 and 01.2.3.4", "v 397.51.17.173 and 1.2.3.4.5 and 01.2.3.4"),
        (f'x token = "{token}"', f'x token = "{feistel(token, "secret", True)}"'),
        ("<réou.9@mail7.example.com>", f"<{mail}>"), ("2020-02-29", day(date(2020, 2, 29)).isoformat()), ("2021-02-29", "2021-02-29"),
        ("on 01.02.2003.", f"on {day(date(2003, 2, 1)):%d.%m.%Y}."), ("31/01/1999", f"{day(date(1999, 1, 31)):%d/%m/%Y}"), *((x.isoformat(), day(x).isoformat()) for x in (date(1850, 1, 1), date(1899, 12, 31), date(1900, 1, 1), date(2101, 11, 10), date(2101, 11, 11), date(9999, 12, 31), date(1, 1, 1), date(2150, 1, 1))), ("14.07.1889", f"{day(date(1889, 7, 14)):%d.%m.%Y}"), ("0000-01-01", "0000-01-01"),
        (None, None), ("", ""), ("no values, 123 or 5 @ 7", "no values, 123 or 5 @ 7"),
    ]
    for (source, want), (text, _) in zip(pairs, run(spark, [s for s, _ in pairs])):
        assert text == want, source


def test_kinds_and_validity(spark):
    texts = ["12/25/2020", "123-45-6789", "000-12-3456", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "DE88370400440532013000", "a" * 200_000 + " x@y.org " + "9" * 50_000]
    got = run(spark, texts)
    assert [[k for k, _ in f] for _, f in got] == [["date"], ["social"], [], ["iban"], ["iban"], [], ["email"]]
    month, d, year = map(int, got[0][0].split("/"))
    assert d > 12 and date(year, month, d)
    assert re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", got[1][0])
    assert got[3][0].replace(" ", "") == got[4][0] and got[4][0][:2] == "DE" and got[4][0] != texts[4]
    number = "".join(str(int(c, 36)) for c in got[4][0][4:] + got[4][0][:4])
    assert int(number) % 97 == 1


def test_email_before_punctuation(spark):
    mail = feistel("john@mail.example", "email") + ".com"
    around = ["write to {}. Then", "write to {}.", "{}.5 or", "({}).", "{}, and", "{}...", "<{}>", "{}. " + "a." * 50_000]
    for form, (text, found) in zip(around, run(spark, [a.replace("{}", "john@mail.example.com") for a in around])):
        assert text == form.replace("{}", mail) and found == [("email", mail)], form
    assert run(spark, ["x@" + "a." * 50_000 + "5", "x@y.c"]) == [("x@" + "a." * 50_000 + "5", []), ("x@y.c", [])]


def carded(number):
    body = feistel(number[:-1], "card")
    return next(body + c for c in "0123456789" if luhn(body + c))


def test_values_before_dates_codes_and_words(spark):
    visa, amex, short = "4111111111111111", "378282246310005", "4222222222222"
    spaced = lambda s: " ".join(s[k : k + 4] for k in (0, 4, 8, 12))
    new = feistel("4155550100", "phone")
    pairs = [
        (f"{visa} 12/25", f"{carded(visa)} 12/25"), (f"{spaced(visa)} 123", f"{spaced(carded(visa))} 123"), (f"no 12 {visa}-12.", f"no 12 {carded(visa)}-12."),
        (f"{amex} 2024 x", f"{carded(amex)} 2024 x"), (f"{visa} {amex} 1", f"{carded(visa)} {carded(amex)} 1"), (f"1234 5678 9012 {spaced(visa)} 5555", f"1234 5678 9012 {spaced(carded(visa))} 5555"),
        (f"{short} 01.02.2003", f"{carded(short)} {day(date(2003, 2, 1)):%d.%m.%Y}"), (f"{visa} 12ab", f"{carded(visa)} 12ab"),
        ("+14155550100 2024", f"+1{new} 2024"), ("+1 415 555 0100 123", f"+1 {new[:3]} {new[3:6]} {new[6:]} 123"), ("+49301234567 2024", f"+49{feistel('301234567', 'phone')} 2024"),
    ]
    for (source, want), (text, found) in zip(pairs, run(spark, [s for s, _ in pairs])):
        assert text == want and found, source
    tails = ("", " BIC X", " 12 2024", " OK", " COBADEFFXXX")
    got = run(spark, ["DE89370400440532013000" + t for t in tails])
    assert got == [(got[0][0] + t, [("iban", got[0][0])]) for t in tails] and got[0][0] != "DE89370400440532013000"
    many = "1 2 3 4 5 6 7 8 9 0 " * 2_000
    assert run(spark, [many + visa])[0][0].endswith(" " + carded(visa))


def long_feistel(s, hexed=False):
    """As ``feistel`` for halves over 128 characters."""
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest() if len(t) > 128 else t
    code = lambda c: next(((f, n) for f, n in pii.CLASSES if f <= ord(c) < f + n), None)
    left, right = s[: len(s) // 2], s[len(s) // 2 :]
    for i in range(1, pii.ROUNDS + 1):
        by = [int(mix("secret", i, k // 16, len(left), digest(right))[k % 16 * 4 :][:4], 16) for k in range(len(left))]
        move = lambda c, n: HEX[(HEX.index(c) + n) % 16] if hexed else chr((ord(c) - code(c)[0] + n) % code(c)[1] + code(c)[0]) if code(c) else c
        left, right = right, "".join(map(move, left, by))
    return left + right


def test_secrets_long_and_unquoted(spark):
    signed, hexes = ".".join(("eyJhbGciOi" * 4, "Zm9vYmFyX2-1" * 20, "Qz9_kLm3" * 6)), "0a9f" * 500
    new = lambda s: feistel(s, "secret")
    pairs = [
        (f'token = "{signed}"', f'token = "{long_feistel(signed)}"'), (f"api_key='{hexes}' x", f"api_key='{long_feistel(hexes, True)}' x"),
        ("password: hunter2abc", f"password: {new('hunter2abc')}"), ("(Password=hunter2abc), then", f"(Password={new('hunter2abc')}), then"),
        ("secret: ab.cd-ef,gh. End", f"secret: {new('ab.cd-ef,gh')}. End"), ('{"api_key": "hunter2abc"}', f'{{"api_key": "{new("hunter2abc")}"}}'),
    ]
    got = run(spark, [s for s, _ in pairs] + ["password: john@mail.example.com", "token: short.", 'secret = "no end', 'token = "' + "aB3" * 100_000 + '"'])
    for (source, want), (text, found) in zip(pairs, got):
        assert text == want and [k for k, _ in found] == ["secret"], source
    assert [[k for k, _ in f] for _, f in got[len(pairs) :]] == [["email"], [], [], ["secret"]]


def test_a_permutation(spark):
    ids = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("s"))
    assert ids.select(pii.feistel(F.col("s"), F.lit("k"), "t").alias("p")).distinct().count() == 1000


def test_query(spark, sf):
    df = pii.op10_pii(spark, sf)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
    old = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = df.collect()
    assert len(rows) == len(old)
    for r in rows:
        assert (r.text == old[r.doc_id]) == (r.n_found == 0)
        for m in re.findall(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)", old[r.doc_id]):
            assert m not in r.text or (m.isdigit() and not luhn(m))
    assert pii.pseudonymize(df.limit(0), key="k").count() == 0


def test_key_and_names(spark):
    import pytest

    df = spark.createDataFrame([(1, "x@y.org", "mine")], "doc_id long, text string, Found string")
    with pytest.raises(ValueError):
        pii.pseudonymize(df)
    out = pii.pseudonymize(df, key="k")
    assert out.columns == ["doc_id", "text", "Found", "found_"] and out.first().Found == "mine"
    assert pii.query_key(spark) == pii.query_key(spark) and len(pii.query_key(spark)) == 64
