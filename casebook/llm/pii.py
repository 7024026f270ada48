"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Values are found by one pattern, validated by kind (Luhn sum, octets, calendar, check digits, number plan) and permuted by a keyed Feistel
network over their own format: digits stay digits, letters stay letters of their case, cards keep a right Luhn digit, account
numbers right check digits, dates stay dates written the same way. The same key gives equal values equal pseudonyms in every document and
layout; within a format no two values share one. What looks like a value but fails validation is left alone.

Dates are permuted within the years 0001-1899, 1900-2101 and 2101-9999. Defined cases: null text stays null with nothing found, empty text
stays empty; repeated rows are kept; other columns pass through unchanged, whatever their names, but for the text column; where a
column has the name of the column of findings but for case, that one gets underscores at its end.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 10
#: Session setting that holds the key.
KEY_SETTING = "spark.casebook.pii.key"
_KEYS: dict[str, str] = {}

_B, _E = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
_TOP = r"[A-Za-z]{2,24}+(?![A-Za-z0-9-])"
#: The host ends with the last label that can be a top level, so a full stop or a number may follow.
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:(?:\.(?!" + _TOP + r")[A-Za-z0-9-]++)*+\." + _TOP + ")++"
#: Account numbers by length, then what no country of the list uses.
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM TL SO", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
IBAN = _B + "(?:" + "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" + _E for n, c in IBAN_LENGTHS.items()) + r"|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}" + _E + ")"
DATE = r"(?<![\p{L}\p{N}_/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![\p{L}\p{N}_/-]|\.[0-9])"
IP = r"(?<![\p{L}\p{N}_.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\p{L}\p{N}_]|\.[0-9])"
#: Eleven digits after +1 and +7; an unbroken number ends before a year.
PHONE = (
    r"(?<![\p{L}\p{N}_+])(?:\+[17][ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{2}[ .-]?[0-9]{2}" + _E
    + r"|\+[0-9]{8,15}(?=[ .-](?:19|20)[0-9]{2}" + _E + r")|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}"
    + r"|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4})" + _E
)
SOCIAL = r"(?<![\p{L}\p{N}_-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}_-])"
_GROUP = r"[0-9]++(?![\p{L}\p{N}_]|-[\p{L}_])"
#: A run of groups of digits, up to where another kind of value begins; ``readings`` finds the cards in it.
CARD = r"(?<![\p{L}\p{N}_-])(?=(?:[0-9][ -]?){13})" + _GROUP + f"(?:(?:-(?!{IP})| (?!{'|'.join((EMAIL, DATE, IP, PHONE, SOCIAL))})){_GROUP})*+"
_NAMED = r"(?i:token|secret|passwd|password|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}"
#: In quotes, or up to white space or a quote but for punctuation at the end, where no other kind of value stands; 8 characters at least.
SECRET = (
    _B + _NAMED + r"(?:\"[^\"\s]{8,}+\"|'[^'\s]{8,}+'"
    + f"|(?!{'|'.join((EMAIL, DATE, IP, PHONE, SOCIAL))})" + r"(?=[^\s\"']{7,}?[^\s\"',;.:!?()\[\]{}<>])(?:[,;.:!?()\[\]{}<>]*+[^\s\"',;.:!?()\[\]{}<>])++)"
)
PATTERN = "|".join((EMAIL, SECRET, DATE, IP, PHONE, SOCIAL, CARD, IBAN))

_HEX = "0123456789abcdef"
#: First code point and size of the classes of letters and digits that stay within their class.
CLASSES = ((48, 10), (65, 26), (97, 26), (0xC0, 23), (0xD8, 7), (0xDF, 24), (0xF8, 8))
#: Ranges of days that are permuted within themselves: first day, days, and the two radices, whose product may be larger.
DAYS = (("1900-01-01", 73_728, 256, 288, "date"), ("0001-01-01", 693_595, 833, 833, "early"), ("2101-11-11", 2_884_736, 1699, 1699, "late"))
WALK = 64


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _mix(key: Column, *parts) -> Column:
    return F.sha2(F.concat_ws("|", key, *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]).cast("binary"), 256)


def _number(hexes: Column, at, n: int) -> Column:
    return F.conv(F.substring(hexes, at, n), 16, 10).cast("long")


def _shift(c: Column, by: Column, hexed: bool) -> Column:
    if hexed:
        return F.substring(F.lit(_HEX), (F.pmod(F.instr(F.lit(_HEX), c) - 1 + by, F.lit(16)) + 1).cast("int"), F.lit(1))
    code, out = F.ascii(c), None
    for first, size in CLASSES:
        hit, moved = code.between(first, first + size - 1), F.chr(F.pmod(code - first + by, F.lit(size)) + first)
        out = F.when(hit, moved) if out is None else out.when(hit, moved)
    return out.otherwise(c)


def feistel(s: Column, key: Column, kind: str, hexed: bool = False) -> Column:
    """A keyed permutation of the strings with the same classes at the same places."""

    def stepped(left: Column, right: Column, i: Column) -> Column:
        def moved(by: Column) -> Column:
            def move(c: Column, k: Column) -> Column:
                pad = _mix(key, kind, i, F.floor(k / 16), F.length(left), by)
                return _shift(c, _number(pad, (F.pmod(k, F.lit(16)) * 4 + 1).cast("int"), F.lit(4)), hexed)

            return F.array_join(F.transform(_chars(left), move), "")

        # long halves count by their digest, so that the work stays in proportion to the length
        return _let(F.when(F.length(right) > 128, F.sha2(right.cast("binary"), 256)).otherwise(right), moved)

    def whole(v: Column) -> Column:
        half = F.floor(F.length(v) / 2).cast("int")
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(ROUNDS)),
            F.struct(F.substring(v, F.lit(1), half).alias("l"), F.substring(v, half + 1, F.length(v)).alias("r")),
            lambda a, i: F.struct(a["r"].alias("l"), stepped(a["l"], a["r"], i).alias("r")),
            lambda a: F.concat(a["l"], a["r"]),
        )

    return _let(s, whole)


def _laid_out(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced by ``digits`` in order."""

    def put(c: Column, i: Column) -> Column:
        return F.when(c.between("0", "9"), F.substring(digits, F.length(_digits(F.substring(m, F.lit(1), i + 1))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_chars(m), put), "")


def _luhn_sum(digits: Column, first_doubled: bool) -> Column:
    """Sum from the right; the rightmost digit counts twice if ``first_doubled``."""

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(F.pmod(i, F.lit(2)) == (0 if first_doubled else 1), twice).otherwise(d)

    return F.aggregate(F.transform(_chars(F.reverse(digits)), value), F.lit(0), lambda a, x: a + x)


def card(m: Column, key: Column) -> Column:
    """Null unless the Luhn sum is right."""

    def permuted(d: Column) -> Column:
        body = feistel(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")
        return _let(body, lambda b: F.concat(b, F.pmod(10 - F.pmod(_luhn_sum(b, True), F.lit(10)), F.lit(10)).cast("string")))

    return _let(_digits(m), lambda d: F.when(F.pmod(_luhn_sum(d, False), F.lit(10)) == 0, _let(permuted(d), lambda p: _laid_out(m, p))))


def readings(run: Column) -> Column:
    """The pieces of a run of digit groups, in order: array of struct(text, card).

    A card is one or more whole groups of 13 to 19 digits with a right Luhn sum. From the left, a group that is a card by itself comes first,
    then the length usual for the first digits, then the longest; a reading over several groups takes in no group that is a card by itself.
    """
    right = lambda d: F.length(d).between(13, 19) & (F.pmod(_luhn_sum(d, False), F.lit(10)) == 0)
    piece = lambda text, card: F.struct(text.alias("text"), F.lit(card).alias("card"))

    def taken(groups: Column, i: Column) -> Column:
        """How many groups from ``i`` on are a card; 0 if none."""
        joined = lambda k: F.array_join(F.transform(F.slice(groups, i + 1, k), lambda g: g["d"]), "")
        clear = lambda k: ~F.exists(F.slice(groups, i + 1, k), lambda g: g["own"])
        sized = F.filter(F.sequence(F.lit(2), F.least(F.lit(19), F.size(groups) - i)), lambda k: F.length(joined(k)).between(13, 19))
        fits = F.when(F.size(groups) - i >= 2, F.filter(sized, lambda k: clear(k) & right(joined(k)))).otherwise(F.array().cast("array<int>"))

        def best(ks: Column) -> Column:
            usual = F.filter(ks, lambda k: _let(joined(k), lambda d: F.length(d) == F.when(d.rlike("^3[47]"), 15).when(d.rlike("^3[0689]"), 14).otherwise(16)))
            return F.coalesce(F.get(usual, 0), F.array_max(ks), F.lit(0))

        return F.when(F.get(groups, i)["own"], 1).otherwise(_let(fits, best))

    def step(tokens: Column, groups: Column):
        def go(a: Column, i: Column) -> Column:
            def add(k: Column) -> Column:
                text = F.array_join(F.slice(tokens, i + 1, F.greatest(k, F.lit(1))), "")
                whole = F.array(piece(F.regexp_replace(text, "[ -]$", ""), True), piece(F.regexp_extract(text, "[ -]?$", 0), False))
                return F.struct((F.greatest(k, F.lit(1)) - 1).cast("int").alias("skip"), F.concat(a["out"], F.when(k > 0, whole).otherwise(F.array(piece(text, False)))).alias("out"))

            return F.when(a["skip"] > 0, F.struct((a["skip"] - 1).cast("int").alias("skip"), a["out"].alias("out"))).otherwise(_let(taken(groups, i), add))

        start = F.struct(F.lit(0).alias("skip"), F.array().cast("array<struct<text:string,card:boolean>>").alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.size(tokens) - 1), start, go, lambda a: a["out"])

    group = lambda t: _let(_digits(t), lambda d: F.struct(d.alias("d"), right(d).alias("own")))
    return _let(F.regexp_extract_all(run, F.lit("[0-9]+[ -]?"), 0), lambda ts: _let(F.transform(ts, group), lambda gs: step(ts, gs)))


def phone(m: Column, key: Column) -> Column:
    """The country code stays; null unless there are 8 to 15 digits."""

    def done(d: Column) -> Column:
        kept = F.when(~F.startswith(m, F.lit("+")), 0).when(F.substring(d, 1, 1).isin("1", "7"), 1).otherwise(2)
        return _let(F.concat(F.substring(d, F.lit(1), kept), feistel(F.substring(d, kept + 1, F.length(d)), key, "phone")), lambda p: _laid_out(m, p))

    return _let(_digits(m), lambda d: F.when(F.length(d).between(8, 15), done(d)))


def address(m: Column, key: Column) -> Column:
    """An IPv4 address; null if an octet is over 255 or written with a leading zero."""
    octets = F.split(m, r"\.")
    valid = F.forall(octets, lambda o: (o.cast("int") <= 255) & (o.cast("int").cast("string") == o))
    hexed = F.array_join(F.transform(octets, lambda o: F.lower(F.lpad(F.hex(o.cast("int")), 2, "0"))), "")
    back = lambda h: F.concat_ws(".", *[_number(h, F.lit(k), F.lit(2)).cast("string") for k in (1, 3, 5, 7)])
    return F.when(valid, _let(feistel(hexed, key, "ip", hexed=True), back))


def _walk(start: Column, step, ok) -> Column:
    """``step`` once, and again until ``ok``: a permutation of what is ok.

    An aggregate can't run on without a bound. Of the formats here, over half of the values are ok, so WALK steps all fail
    with a probability under 1e-19; what is left then is null, and the value counts as invalid.
    """

    def on(a: Column, _: Column) -> Column:
        return F.when(a["done"], a).otherwise(_let(step(a["x"]), lambda x: F.struct(x.alias("x"), F.coalesce(ok(x), F.lit(True)).alias("done"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.struct(start.alias("x"), F.lit(False).alias("done")), on, lambda a: F.when(a["done"], a["x"]))


def _day(day: Column, key: Column) -> Column:
    """The day that stands for ``day`` in a mixed-radix Feistel network over its range of days, walked on while it leaves the range."""
    first = None
    for begin, size, a, b, kind in DAYS:
        here = F.struct(F.lit(begin).cast("date").alias("first"), F.lit(size).alias("size"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(kind).alias("kind"))
        inside = F.date_diff(day, F.lit(begin).cast("date")).between(0, size - 1)
        first = F.when(inside, here) if first is None else first.when(inside, here)

    def network(r: Column, n: Column) -> Column:
        add = lambda i, half, x, radix: F.pmod(x[half] + _number(_mix(key, r["kind"], i, half, x["lo" if half == "hi" else "hi"]), F.lit(1), F.lit(8)), radix).cast("int")

        def moved(x: Column, i: Column) -> Column:
            high = _let(add(i, "hi", x, r["a"]), lambda h: F.struct(h.alias("hi"), x["lo"].alias("lo")))
            return _let(high, lambda y: F.struct(y["hi"].alias("hi"), add(i, "lo", y, r["b"]).alias("lo")))

        start = F.struct(F.floor(n / r["b"]).cast("int").alias("hi"), F.pmod(n, r["b"]).cast("int").alias("lo"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, moved, lambda x: x["hi"] * r["b"] + x["lo"])

    def placed(r: Column) -> Column:
        return F.date_add(r["first"], _walk(F.date_diff(day, r["first"]), lambda n: network(r, n), lambda n: n < r["size"]))

    return F.when(day.isNotNull(), _let(first, placed))


def date(m: Column, key: Column) -> Column:
    """Year first, day first, or month first where day first is no date (the pseudonym's day is then over 12, too)."""
    slashed = F.replace(m, F.lit("."), F.lit("/"))
    forms = ((m, "yyyy-MM-dd"), (slashed, "dd/MM/yyyy"), (m, "MM/dd/yyyy"))

    def made(read: Column) -> Column:
        def shown(d: Column) -> Column:
            out = F.when(read["form"] == 0, F.date_format(d, forms[0][1])).when(read["form"] == 1, F.date_format(d, forms[1][1])).otherwise(F.date_format(d, forms[2][1]))
            return F.when(F.contains(m, F.lit(".")), F.replace(out, F.lit("/"), F.lit("."))).otherwise(out)

        return _let(_walk(read["day"], lambda d: _day(d, key), lambda d: (read["form"] < 2) | (F.dayofmonth(d) > 12)), shown)

    reading = lambda i: _let(F.try_to_date(*forms[i]), lambda d: F.when(d.isNotNull(), F.struct(d.alias("day"), F.lit(i).alias("form"))))
    return _let(F.coalesce(*map(reading, range(len(forms)))), lambda read: F.when(read.isNotNull(), made(read)))


def social(m: Column, key: Column) -> Column:
    """A nine-digit number by the rules of its plan; null if it breaks them."""

    def ok(d: Column) -> Column:
        area = F.substring(d, 1, 3)
        return ~area.isin("000", "666") & (area < "900") & (F.substring(d, 4, 2) != "00") & (F.substring(d, 6, 4) != "0000")

    return _let(_digits(m), lambda d: F.when(ok(d), _let(_walk(d, lambda x: feistel(x, key, "social"), ok), lambda p: _laid_out(m, p))))


def _mod97(s: Column) -> Column:
    value = lambda c: F.when(c.between("0", "9"), c).otherwise((F.ascii(c) - 55).cast("string"))
    number = F.array_join(F.transform(_chars(s), value), "")
    return F.aggregate(_chars(number), F.lit(0), lambda a, c: F.pmod(a * 10 + c.cast("int"), F.lit(97)))


def iban(m: Column, key: Column) -> Column:
    """Country and layout stay, the account part is permuted and the check digits are made right; null if they were wrong."""

    def made(v: Column) -> Column:
        head = F.substring(v, 1, 2)
        body = feistel(F.substring(v, F.lit(5), F.length(v)), key, "iban")
        return _let(body, lambda b: F.concat(head, F.lpad((98 - _mod97(F.concat(b, head, F.lit("00")))).cast("string"), 2, "0"), b))

    def placed(p: Column) -> Column:
        at = lambda i: F.length(F.replace(F.substring(m, F.lit(1), i + 1), F.lit(" "), F.lit("")))
        return F.array_join(F.transform(_chars(m), lambda c, i: F.when(c == " ", c).otherwise(F.substring(p, at(i), F.lit(1)))), "")

    return _let(F.replace(m, F.lit(" "), F.lit("")), lambda v: F.when((_mod97(F.concat(F.substring(v, F.lit(5), F.length(v)), F.substring(v, 1, 4))) == 1), _let(made(v), placed)))


def email(m: Column, key: Column) -> Column:
    """All but the last label of the host; capitals count as what they are."""
    head = F.regexp_extract(m, r"^(.*)\.[A-Za-z]+$", 1)
    return F.concat(feistel(head, key, "email"), F.substring(m, F.length(head) + 1, F.length(m)))


def secret(m: Column, key: Column) -> Column:
    """What stands between the quotes, or after the sign where there are none."""
    head = F.regexp_extract(m, f"^{_NAMED}[\"']?", 0)
    tail = F.when(head.rlike("[=:]\\s*[\"']$"), F.substring(head, -1, 1)).otherwise("")
    body = F.substring(m, F.length(head) + 1, F.length(m) - F.length(head) - F.length(tail))
    return _let(body, lambda b: F.concat(head, F.when(b.rlike("^[0-9a-f]+$"), feistel(b, key, "secret", hexed=True)).otherwise(feistel(b, key, "secret")), tail))


def pseudonym(m: Column, key: Column) -> Column:
    """An array of ``struct(kind, value)`` for one match; ``kind`` is null and the value unchanged where validation fails."""
    kinds = (
        ("secret", m.rlike(f"^{_NAMED}"), secret(m, key)),
        ("email", F.contains(m, F.lit("@")), email(m, key)),
        ("iban", m.rlike("^[A-Z]"), iban(m, key)),
        ("ip", m.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), address(m, key)),
        ("date", m.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}([/.])[0-9]{2}\2[0-9]{4})$"), date(m, key)),
        ("social", m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), social(m, key)),
        ("phone", m.rlike(r"^(\+|\(|[0-9]{3}([.-])[0-9]{3}\2[0-9]{4}$)"), phone(m, key)),
    )
    kind = value = None
    for name, test, made in kinds:
        kind = F.when(test, F.lit(name)) if kind is None else kind.when(test, F.lit(name))
        value = F.when(test, made) if value is None else value.when(test, made)
    one = _let(value, lambda v: F.struct(F.when(v.isNotNull(), kind).alias("kind"), F.coalesce(v, m).alias("value")))
    cards = F.transform(readings(m), lambda p: F.struct(F.when(p["card"], F.lit("card")).alias("kind"), F.when(p["card"], card(p["text"], key)).otherwise(p["text"]).alias("value")))
    return F.when(kind.isNull(), cards).otherwise(F.array(one))


def query_key(spark: SparkSession) -> str:
    """The session's key; where none is set, a random one that lasts as long as the application, so that values are linked within its results only."""
    app = spark.sparkContext.applicationId
    return spark.conf.get(KEY_SETTING, None) or _KEYS.setdefault(app, secrets.token_hex(32))


def pseudonymize(docs: DataFrame, text_col: str = "text", found_col: str = "found", key: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and ``found_col``: an array of struct(kind, value), in order of the text.

    The key is ``key`` or the session's; without one this raises.
    """
    key = key or docs.sparkSession.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"a key is needed: set {KEY_SETTING}")
    taken = {c.lower() for c in docs.columns}
    while found_col.lower() in taken:
        found_col += "_"
    text, k = F.col(text_col).cast("string"), F.lit(key)
    none = F.array().cast("array<array<struct<kind:string,value:string>>>")
    hits = F.when(text.rlike("[0-9@=:]"), F.transform(F.regexp_extract_all(text, F.lit(PATTERN), 0), lambda m: pseudonym(m, k))).otherwise(none)
    taken.add(found_col.lower())
    was, got = (next(n for k in range(len(taken) + 1) if (n := stem + "_" * k) not in taken) for stem in ("text_was", "pii_got"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    made = docs.select(*names, text.alias(was), F.coalesce(hits, none).alias(got))
    gaps = F.split(was, PATTERN, -1)
    filled = F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.array_join(F.coalesce(F.transform(F.get(got, i), lambda h: h["value"]), F.array().cast("array<string>")), ""))), "")
    new = F.when(F.size(got) > 0, filled).otherwise(F.col(was)).alias(text_col)
    found = F.filter(F.flatten(got), lambda h: h["kind"].isNotNull()).alias(found_col)
    return made.select(*[new if c == text_col else F.col(f"`{c}`") for c in docs.columns], found)


def op10_pii(spark, sf_dir: str) -> DataFrame:
    out = pseudonymize(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), key=query_key(spark))
    return out.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["kind"]))), ",").alias("kinds"))
