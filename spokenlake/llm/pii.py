"""Format-preserving pseudonyms for personal data, with DataFrame expressions only.

One pattern finds candidates; each is validated (Luhn, mod 97, calendar, octets, reserved numbers) and replaced by a keyed
permutation of its own format: a Feistel network whose halves turn each other's characters inside their class, so digits
stay digits, letters letters, and check digits are made anew. Equal values get equal pseudonyms in all documents, and
whoever has the key can undo them. A value that fails its validation but has the shape of a private number (a long digit
run, an identity token) is permuted as well; everything else is left as it is.
"""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

#: The setting that holds the secret key, and what the registered queries take, with a warning, where it is not set.
KEY_SETTING, DEMO_KEY = "spark.spokenlake.pii.key", "spokenlake-demo-key"
ROUNDS = 6
#: 400 Gregorian years have 146,097 days, 189 x 773; dates are permuted among those of their 400 years (1700 to 2099, 2100
#: to 2499 and so on).
DATE_ROWS, DATE_COLUMNS, FIRST_DAY = 189, 773, "1700-01-01"

# Alphabets, and the patterns of each kind in the order in which they are tried.
DIGITS, LOWERS, UPPERS, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
#: Lengths of the IBANs of the countries in the ISO 13616 registry.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_pattern() -> str:
    """Countries of the registry at their length, so that a word after the value is none of it; others at any length."""
    known = "|".join(rf"(?:{lands.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + "(?![A-Za-z0-9])" for n, lands in IBAN_LENGTHS.items())
    return rf"(?<![A-Za-z0-9])(?:{known}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![A-Za-z0-9]))"


OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])",
    "iban": _iban_pattern(),
    "ip": rf"(?<![0-9A-Za-z.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?[0-9A-Za-z])",
    # the year first, also with a time or as one end of an interval; or last, after day and month in either order
    "date": r"(?<![0-9A-Za-z.-])(?:(?:(?<!/)|(?<=[0-9Zz]/))(?:1[3-9]|[2-8][0-9]|9[0-2])[0-9]{2}-[01][0-9]-[0-3][0-9](?:(?![0-9A-Za-z/-])|(?=[Tt][0-9]{2}|/[0-9P]))|(?<!/)(?:(?:1[3-9]|[2-8][0-9]|9[0-2])[0-9]{2}/[01][0-9]/[0-3][0-9]|(?:[0-3][0-9]([./])[01][0-9]|[01][0-9]([./])[0-3][0-9])(?:\1|\2)(?:1[3-9]|[2-8][0-9]|9[0-2])[0-9]{2})(?![0-9A-Za-z/-]))",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|[2-9][0-9]{2}[2-9][0-9]{6})(?![0-9A-Za-z])",
    # 13 digits or more in a row; 13 to 19 in fours with any rest, or as 4-6-4, 4-6-5, 4-5-6, 5-4-5 and 6-7 to 6-13
    "number": r"(?<![0-9A-Za-z])(?:[0-9]{13,}+|[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{1,3})?|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{4}[ -][0-9]{5}[ -][0-9]{6}|[0-9]{5}[ -][0-9]{4}[ -][0-9]{5}|[0-9]{6}[ -][0-9]{7,13})(?![0-9A-Za-z])",
}


def _alternatives() -> str:
    """All kinds as one pattern; the date's back references are its own groups, so it comes with numbers that fit."""
    out, groups = [], 0
    for kind, pattern in KINDS.items():
        if kind == "date":
            pattern = pattern.replace(r"\1", rf"\{groups + 1}").replace(r"\2", rf"\{groups + 2}")
            groups += 2
        out.append(pattern)
    return "|".join(out)


PATTERN = _alternatives()


def once(value: Column, use) -> Column:
    """use(value) with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _byte(text: Column, at: Column) -> Column:
    """Byte ``at`` (from 0, around 32) of a SHA-256 in hexadecimal."""
    return F.conv(F.substr(text, F.pmod(at, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _turn(part: Column, mask: Column, alphabets: tuple[str, ...]) -> Column:
    """Each character moved on inside its alphabet by the mask's byte; characters of none stay."""

    def turned(m: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            out = c
            for a in alphabets:
                at = F.instr(F.lit(a), c)
                out = F.when((c != "") & (at > 0), F.substr(F.lit(a), F.pmod(at - 1 + _byte(m, i), F.lit(len(a))) + 1, F.lit(1))).otherwise(out)
            return out

        return F.array_join(F.transform(F.split(part, ""), one), "")

    return once(mask, turned)


def permute_text(value: Column, key: Column, tag: str, alphabets: tuple[str, ...] = (DIGITS,)) -> Column:
    """Feistel network on a string: the halves turn each other's characters, ROUNDS times."""

    def permuted(v: Column) -> Column:
        half = F.floor(F.length(v) / 2).cast("int")
        start = F.struct(F.substr(v, F.lit(1), half).alias("a"), F.substr(v, half + 1, F.length(v)).alias("b"))

        def step(s: Column, r: Column) -> Column:
            mask = lambda other: F.sha2(F.concat_ws("|", key, F.lit(tag), r.cast("string"), F.length(v).cast("string"), other), 256)
            even = F.struct(_turn(s["a"], mask(s["b"]), alphabets).alias("a"), s["b"].alias("b"))
            odd = F.struct(s["a"].alias("a"), _turn(s["b"], mask(s["a"]), alphabets).alias("b"))
            return F.when(r % 2 == 0, even).otherwise(odd)

        return F.reduce(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["a"], s["b"]))

    return once(value, permuted)


def permute_number(value: Column, key: Column, tag: str, rows: int, columns: int) -> Column:
    """Feistel network on 0 .. rows * columns - 1."""
    start = F.struct(F.floor(value / columns).cast("long").alias("a"), F.pmod(value, F.lit(columns)).cast("long").alias("b"))

    def step(s: Column, r: Column) -> Column:
        drawn = lambda other: F.conv(F.substr(F.sha2(F.concat_ws("|", key, F.lit(tag), r.cast("string"), other.cast("string")), 256), F.lit(1), F.lit(15)), 16, 10).cast("long")
        even = F.struct(F.pmod(s["a"] + drawn(s["b"]), F.lit(rows)).cast("long").alias("a"), s["b"].alias("b"))
        odd = F.struct(s["a"].alias("a"), F.pmod(s["b"] + drawn(s["a"]), F.lit(columns)).cast("long").alias("b"))
        return F.when(r % 2 == 0, even).otherwise(odd)

    return F.reduce(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["a"] * columns + s["b"])


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refill(value: Column, digits: Column) -> Column:
    """value with its digits replaced in turn by those of ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(s["out"], F.when(is_digit, F.substr(digits, s["at"], F.lit(1))).otherwise(c)).alias("out"), (s["at"] + is_digit.cast("int")).alias("at"))

    return F.reduce(F.split(value, ""), start, step, lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum, the last digit weighing one."""
    return F.reduce(F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(c == "", 0).when(i % 2 == 0, c.try_cast("int")).otherwise(F.floor(c.try_cast("int") * 2 / 10).cast("int") + F.pmod(c.try_cast("int") * 2, F.lit(10)))), F.lit(0), lambda a, x: a + x)


def mod97(text: Column) -> Column:
    """Remainder by 97 of a string of digits and capital letters (A is 10)."""
    value = lambda c: F.when(c.rlike("^[0-9]$"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    return F.reduce(F.split(text, ""), F.lit(0), lambda a, c: F.when(c == "", a).when(value(c) < 10, F.pmod(a * 10 + value(c), F.lit(97))).otherwise(F.pmod(a * 100 + value(c), F.lit(97))))


def _card(value: Column, key: Column) -> Column:
    digits = digits_of(value)
    body = permute_text(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
    check = F.pmod(10 - F.pmod(luhn_sum(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    return refill(value, F.concat(body, check))


def _number(value: Column, key: Column) -> Column:
    """Whole if its check digit holds; else its first four fours, if they are there, without the rest, which can be a word
    of its own. Numbers that fail are permuted if they are a run or four fours, and otherwise left."""
    holds = lambda v: (F.length(digits_of(v)) <= 19) & (F.pmod(luhn_sum(digits_of(v)), F.lit(10)) == 0)
    fours = value.rlike("^[0-9]{4}([ -][0-9]{4}){3}[ -]")
    main = F.when(holds(value) | ~fours, value).otherwise(F.substr(value, F.lit(1), F.lit(19)))
    tail = F.substr(value, F.length(main) + 1, F.length(value))
    shaped = main.rlike("^([0-9]{13,}|[0-9]{4}([ -][0-9]{4}){3})$")
    made = F.when(holds(main), _card(main, key)).when(shaped, refill(main, permute_text(digits_of(main), key, "number")))
    return F.concat(made, tail)


def _iban(value: Column, key: Column) -> Column:
    """Of the value and its beginnings before a blank the longest with the right check digits; what follows it stays."""
    words = F.split(value, " ")
    plain = lambda v: F.regexp_replace(v, " ", "")
    begun = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(words, 1, n), " "))
    valid = F.filter(begun, lambda v: (F.length(plain(v)) >= min(IBAN_LENGTHS)) & (mod97(F.concat(F.substr(plain(v), F.lit(5), F.length(v)), F.substr(plain(v), F.lit(1), F.lit(4)))) == 1))
    made = F.transform(F.slice(valid, 1, 1), lambda v: F.concat(_iban_made(v, key), F.substr(value, F.length(v) + 1, F.length(value))))
    return F.try_element_at(made, F.lit(1))


def _iban_made(value: Column, key: Column) -> Column:
    plain = F.regexp_replace(value, " ", "")
    land, rest = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))
    body = permute_text(rest, key, "iban", (DIGITS, UPPERS))
    made = F.concat(land, F.lpad((98 - mod97(F.concat(body, land, F.lit("00")))).cast("string"), 2, "0"), body)
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    spaced = F.reduce(F.split(value, ""), start, lambda s, c: F.struct(F.concat(s["out"], F.when((c == " ") | (c == ""), c).otherwise(F.substr(made, s["at"], F.lit(1)))).alias("out"), (s["at"] + F.when((c == " ") | (c == ""), 0).otherwise(1)).alias("at")), lambda s: s["out"])
    return spaced


def _ip(value: Column, key: Column) -> Column:
    number = F.reduce(F.split(value, r"\."), F.lit(0).cast("long"), lambda a, x: a * 256 + F.coalesce(x.try_cast("long"), F.lit(0)))
    made = permute_number(number, key, "ip", 65536, 65536)
    return F.array_join(F.transform(F.array(*[F.lit(s) for s in (24, 16, 8, 0)]), lambda s: F.pmod(F.floor(made / F.pow(F.lit(2), s)).cast("long"), F.lit(256)).cast("string")), ".")


def _date(value: Column, key: Column) -> Column:
    """With the year last, the month comes first only where it cannot be the day. Such a date gets one of those that must be
    read so too, so that the pseudonym can be undone: the permutation walks on until its day is above 12."""
    sign = F.regexp_extract(value, "([-/.])", 1)
    first = value.rlike("^[0-9]{4}")  # the year
    parts = F.split(value, "[-/.]")
    day = F.try_to_date(F.when(first, F.concat_ws("-", parts)).otherwise(F.concat_ws("-", F.reverse(parts))), "yyyy-MM-dd")
    american = F.when(~first & day.isNull(), F.try_to_date(F.concat_ws("-", F.slice(parts, 3, 1), F.slice(parts, 1, 2)), "yyyy-MM-dd"))
    begin = F.lit(FIRST_DAY).cast("date")
    days = DATE_ROWS * DATE_COLUMNS
    moved = lambda n: permute_number(F.pmod(n, F.lit(days)), key, "date", DATE_ROWS, DATE_COLUMNS) + F.floor(n / days).cast("long") * days
    late = lambda n: F.dayofmonth(F.date_add(begin, n.cast("int"))) > 12
    number = F.datediff(F.coalesce(day, american), begin).cast("long")
    walked = F.reduce(F.when(american.isNotNull(), F.sequence(F.lit(1), F.lit(128))).otherwise(F.array().cast("array<int>")), moved(number), lambda n, _: F.when(late(n), n).otherwise(moved(n)))
    text = F.split(F.date_add(begin, walked.cast("int")).cast("string"), "-")
    placed = F.when(first, text).when(day.isNotNull(), F.reverse(text)).otherwise(F.concat(F.slice(text, 2, 2), F.slice(text, 1, 1)))
    return F.when(number.isNotNull(), F.replace(F.concat_ws("|", placed), F.lit("|"), sign))


def _phone(value: Column, key: Column) -> Column:
    """The country code of an international number stays."""
    code = F.when(value.startswith("+"), F.regexp_extract(value, r"^(\+[0-9]{1,3}?)(?:[ .(-]|[0-9]{10}$)", 1)).otherwise(F.lit(""))
    rest = F.substr(value, F.length(code) + 1, F.length(value))
    return F.concat(code, refill(rest, permute_text(digits_of(rest), key, "phone")))


def _email(value: Column, key: Column) -> Column:
    """Name and domain are permuted in their classes as small letters, and capitals stay where they were, so that spellings
    of one address stay linked; the last label stays."""
    last = F.regexp_extract(value, r"\.[A-Za-z]{2,}$", 0)
    body = F.substr(value, F.lit(1), F.length(value) - F.length(last))
    made = permute_text(F.translate(body, UPPERS, LOWERS), key, "email", (DIGITS, LOWERS))
    cased = F.zip_with(F.split(made, ""), F.split(body, ""), lambda new, old: F.when(old.rlike("^[A-Z]$"), F.upper(new)).otherwise(new))
    return F.concat(F.array_join(cased, ""), last)


def pseudonym(value: Column, key: Column) -> Column:
    """The pseudonym of one candidate; null if it fails its validation."""
    whole = lambda kind: value.rlike("^(?:" + KINDS[kind] + ")$")
    ssn = ~value.rlike("^(?:000|666|9)|-00-|-0000$")
    return (
        F.when(whole("email"), _email(value, key))
        .when(whole("secret"), F.when(value.rlike("[a-f]") | ~value.rlike("[A-F]"), permute_text(value, key, "secret", (HEX,))).otherwise(F.upper(permute_text(F.lower(value), key, "secret", (HEX,)))))
        .when(whole("iban"), _iban(value, key))
        .when(whole("ip"), _ip(value, key))
        .when(whole("date"), _date(value, key))
        .when(whole("ssn"), F.when(ssn, refill(value, permute_text(digits_of(value), key, "ssn"))))
        .when(whole("phone"), _phone(value, key))
        .when(whole("number"), _number(value, key))
    )


def key_of(spark: SparkSession) -> str:
    """The key of KEY_SETTING; where it is not set the public demo key, with a warning: its pseudonyms can be undone by
    anyone."""
    found = spark.conf.get(KEY_SETTING, None)
    if not found:
        warnings.warn(f"{KEY_SETTING} is not set: the pseudonyms are made with a public key", stacklevel=2)
    return found or DEMO_KEY


def pseudonymise(docs: DataFrame, key: str, text_column: str = "text") -> DataFrame:
    """docs with its texts pseudonymised, and n_private, the number of values replaced.

    Texts without candidates stay as they are, null stays null (n_private 0); texts are read whole, whatever their length.
    All other columns pass through, whatever their names; a column n_private is replaced. Rows that repeat come out the
    same; empty table: no rows. The key comes as a value of a one-row table, so plans and event logs do not show it. Runs
    in the scan, without a shuffle.
    """
    if not key:
        raise ValueError(f"a secret key is needed, such as that of {KEY_SETTING}")
    mark = uuid.uuid4().hex
    secret, found, new, count = (f"_{n}_{mark}" for n in ("key", "found", "new", "count"))
    given = docs.sparkSession.sql("SELECT * FROM VALUES (:secret) AS t(secret)", args={"secret": key}).scalar()
    text = F.col(text_column)
    may = text.rlike("[0-9@]|[a-f]{32}|[A-F]{32}")
    step = docs.withColumn(found, F.when(may, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))).withColumn(secret, given)
    step = step.withColumn(new, F.when(F.size(found) > 0, F.transform(found, lambda v: pseudonym(v, F.col(secret)))))
    kept = F.zip_with(found, new, lambda old, v: F.coalesce(v, old))
    between = F.split(text, PATTERN, -1)
    made = F.array_join(F.zip_with(between, kept, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    step = step.withColumn(count, F.when(F.col(new).isNotNull(), F.size(F.filter(new, lambda v: v.isNotNull()))).otherwise(0).cast("long"))
    step = step.withColumn(text_column, F.when(F.col(count) > 0, made).otherwise(text)).withColumn("n_private", F.col(count))
    return step.drop(secret, found, new, count)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' texts with pseudonyms, and how many each has."""
    return pseudonymise(documents(spark, sf_dir), key_of(spark)).select("doc_id", "text", "n_private")
