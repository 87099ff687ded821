"""Format-preserving pseudonyms for personal numbers and dates.

Candidates are found by pattern and then validated (check digit, calendar,
ranges); a valid one is replaced by another valid value of the same format,
chosen by a keyed Feistel permutation.  The permutation depends on the key
and the kind alone, so equal values get equal pseudonyms in every document,
different values different ones, and whoever holds the key can invert it.
DataFrame functions only: every value is computed inside its row.

Kinds: card numbers (13 to 19 digits with a right check digit, which is
made right again), phone numbers (the ten national digits, area and exchange from 200
on in North American ones), social security
numbers, IPv4 addresses, dates (yyyy-mm-dd, dd/mm/yyyy, dd.mm.yyyy; years
1800 to 2199, as days of one 400-year cycle) and the local part of mail
addresses (each letter stays a letter of its case, each digit a digit).

Defined results: a null text stays null with no finds; an empty text stays
empty; candidates that do not validate stay as they are; repeated rows get
equal rows; an empty table gives an empty result; further columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import ready

TURNS = 8

MAIL = r"(?<![\w.+-])[A-Za-z0-9](?:[\w.+-]{0,63}+)(?<=\w)@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
DATE = (r"(?<![\d./-])(?:(?:1[89]|2[01])\d\d-[01]\d-[0-3]\d|[0-3]\d/[01]\d/(?:1[89]|2[01])\d\d"
        r"|[0-3]\d\.[01]\d\.(?:1[89]|2[01])\d\d)(?![\d/-])")
ADDRESS = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)"
PHONE = (r"(?<![\w+])\+\d{1,3}[ -]?\(?\d{3}\)?[ -]?\d{3}[ -]\d{4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)"
         r"|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\w-])")
SOCIAL = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<![\w-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\d|-\d)"
KINDS = [("mail", MAIL), ("date", DATE), ("address", ADDRESS), ("phone", PHONE), ("social", SOCIAL), ("card", CARD)]
#: Every number starts with one of these characters: at any other the search
#: fails at once.  Mail addresses are only looked for in texts with an @.
NUMBERS = r"(?<!\d)(?=[\d(+])(?:" + "|".join(f"(?:{p})" for name, p in KINDS if name != "mail") + ")"
ANY = f"(?:{MAIL})|{NUMBERS}"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a plain Column used twice is
    computed twice)."""
    return F.transform(F.array(value), body)[0]


def _hash(key: str, kind: str, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), half.cast("string")), 256)


def permuted_pair(x: Column, y: Column, a: int, b: int, key: str, kind: str) -> Column:
    """Feistel over the numbers (x, y), x < a and y < b: a struct (x, y)."""
    def turn(acc, i):
        size = F.when(i % 2 == 0, F.lit(a)).otherwise(F.lit(b)).cast("long")
        drawn = F.conv(F.substring(_hash(key, kind, i, acc["y"]), 1, 14), 16, 10).cast("long")
        return F.struct(acc["y"].alias("x"), ((acc["x"] + drawn) % size).alias("y"))

    turns = F.array(*[F.lit(i) for i in range(TURNS)])
    return F.aggregate(turns, F.struct(x.cast("long").alias("x"), y.cast("long").alias("y")), turn)


def permuted_text(s: Column, key: str, kind: str) -> Column:
    """Feistel over the characters of ``s``: halves in turn shift each other,
    digits among digits and letters among letters of their case."""
    def shifted(half: Column, drawn: Column) -> Column:
        def one(k):
            c = F.substr(half, k, F.lit(1))
            by = F.conv(F.substr(drawn, (2 * (k - 1)) % 62 + 1, F.lit(2)), 16, 10).cast("int")
            code = F.ascii(c)
            def within(first, size):
                return F.char((F.lit(first) + (code - first + by) % size).cast("long"))
            return (F.when(code.between(48, 57), within(48, 10)).when(code.between(97, 122), within(97, 26))
                    .when(code.between(65, 90), within(65, 26)).otherwise(c))
        return F.when(F.length(half) == 0, half).otherwise(
            F.array_join(F.transform(F.sequence(F.lit(1), F.length(half)), one), ""))

    def turn(acc, i):
        return F.struct(acc["y"].alias("x"), _let(
            _hash(key, kind, i, acc["y"]), lambda drawn: shifted(acc["x"], drawn)).alias("y"))

    middle = F.floor(F.length(s) / 2).cast("int")
    halves = F.struct(F.substr(s, F.lit(1), middle).alias("x"), F.substr(s, middle + 1, F.length(s)).alias("y"))
    done = F.aggregate(F.array(*[F.lit(i) for i in range(TURNS)]), halves, turn)
    return _let(done, lambda d: F.concat(d["x"], d["y"]))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def check_sum(d: Column) -> Column:
    """Luhn sum of a string of digits, the last one counted once."""
    def one(k):
        v = F.substr(d, F.length(d) - k + 1, F.lit(1)).cast("int")
        return F.when(k % 2 == 1, v).otherwise(F.when(v > 4, 2 * v - 9).otherwise(2 * v))
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(d)), one), F.lit(0), lambda s, v: s + v)


def poured(shape: Column, d: Column) -> Column:
    """``shape`` with its digits replaced by those of ``d`` in order."""
    def one(k):
        c = F.substr(shape, k, F.lit(1))
        nth = F.length(digits(F.substr(shape, F.lit(1), k)))
        return F.when(c.rlike("[0-9]"), F.substr(d, nth, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), one), "")


def new_card(m: Column, key: str) -> Column:
    def whole(body):
        check = (10 - check_sum(F.concat(body, F.lit("0"))) % 10) % 10
        return _let(F.concat(body, check.cast("string")), lambda made: poured(m, made))

    def of(d):
        made = _let(permuted_text(F.substr(d, F.lit(1), F.length(d) - 1), key, "card"), whole)
        return F.when(F.length(d).between(13, 19) & (check_sum(d) % 10 == 0), made)
    return _let(digits(m), of)


def new_phone(m: Column, key: str) -> Column:
    """North American numbers (no country, or 1) have area and exchange from 200 on, and
    stay so; of others it is known that the first of the ten digits is not 0."""
    def of(d):
        country, own = F.substr(d, F.lit(1), F.length(d) - 10), F.substr(d, F.length(d) - 9, F.lit(10))
        area, exchange, line = (F.substr(own, F.lit(k), F.lit(n)).cast("int") for k, n in ((1, 3), (4, 3), (7, 4)))
        first, rest = F.substr(own, F.lit(1), F.lit(1)).cast("int"), F.substr(own, F.lit(2), F.lit(9)).cast("long")
        home = permuted_pair(area - 200, (exchange - 200) * 10_000 + line, 800, 8_000_000, key, "phone")
        abroad = permuted_pair(first - 1, rest, 9, 10 ** 9, key, "phone abroad")
        pour = lambda text: _let(F.concat(country, text), lambda made: poured(m, made))
        north = country.isin("", "1")
        return F.when(north & (area >= 200) & (exchange >= 200), F.transform(F.array(home), lambda p: pour(F.format_string(
            "%03d%03d%04d", p["x"] + 200, F.floor(p["y"] / 10_000) + 200, p["y"] % 10_000)))[0]).when(
            ~north & (first > 0), F.transform(F.array(abroad), lambda p: pour(F.format_string("%d%09d", p["x"] + 1, p["y"])))[0])
    return _let(digits(m), of)


def new_social(m: Column, key: str) -> Column:
    area, group, serial = (F.split(m, "-")[k].cast("int") for k in range(3))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    x = F.when(area > 666, area - 2).otherwise(area - 1)
    p = permuted_pair(x, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "social")
    made = F.transform(F.array(p), lambda p: F.format_string(
        "%03d-%02d-%04d", p["x"] + F.when(p["x"] >= 665, 2).otherwise(1),
        F.floor(p["y"] / 9999) + 1, p["y"] % 9999 + 1))[0]
    return F.when(valid, made)


def new_address(m: Column, key: str) -> Column:
    o = [F.split(m, r"\.")[k].cast("int") for k in range(4)]
    valid = F.greatest(*o) <= 255
    p = permuted_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "address")
    made = F.transform(F.array(p), lambda p: F.concat_ws(
        ".", *[v.cast("int").cast("string") for v in (F.floor(p["x"] / 256), p["x"] % 256,
                                                        F.floor(p["y"] / 256), p["y"] % 256)]))[0]
    return F.when(valid, made)


def new_date(m: Column, key: str) -> Column:
    year_first = m.substr(5, 1) == "-"
    iso = F.when(year_first, m).otherwise(F.concat_ws("-", m.substr(7, 4), m.substr(4, 2), m.substr(1, 2)))
    start = F.to_date(F.lit("1800-01-01"))
    day = F.datediff(F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).cast("date"), start)
    # 400 years have 146097 = 189 * 773 days
    p = permuted_pair(F.floor(day / 773), day % 773, 189, 773, key, "date")
    made = F.transform(F.array(p), lambda p: F.date_add(start, (p["x"] * 773 + p["y"]).cast("int")))[0]
    sign = m.substr(3, 1)
    text = F.transform(F.array(made), lambda d: F.when(year_first, F.date_format(d, "yyyy-MM-dd")).otherwise(
        F.concat(F.date_format(d, "dd"), sign, F.date_format(d, "MM"), sign, F.date_format(d, "yyyy"))))[0]
    return F.when(day.isNotNull(), text)


def new_mail(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(permuted_text(local, key, "mail"), F.substr(m, F.length(local) + 1, F.length(m)))


MAKERS = {"mail": new_mail, "date": new_date, "address": new_address, "phone": new_phone,
          "social": new_social, "card": new_card}


def _found(name: str, m: Column):
    return lambda v: F.struct(F.when(v.isNotNull(), F.lit(name)).alias("kind"), F.coalesce(v, m).alias("value"))


def replaced(m: Column, key: str) -> Column:
    """(kind, value) of a candidate; the kind is null where it does not validate."""
    out, kind = None, None
    for name, pattern in KINDS:
        here = m.rlike(f"^(?:{pattern})$")
        one = _let(MAKERS[name](m, key), _found(name, m))
        out = F.when(here, one) if out is None else out.when(here, one)
    return out.otherwise(F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value")))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the text with its pseudonyms, n_<kind> of each kind, n_found.  Whoever has
    the key can invert the pseudonyms: it is the caller's to keep."""
    if not key:
        raise ValueError("pseudonyms need a key")
    ready(docs)
    df = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    has_mail, t = F.contains(F.col("t"), F.lit("@")), F.col("t")
    found = (F.when(has_mail, F.regexp_extract_all(t, F.lit(ANY), F.lit(0)))
             .when(t.rlike("[0-9]"), F.regexp_extract_all(t, F.lit(NUMBERS), F.lit(0)))
             .when(t.isNotNull(), F.array().cast("array<string>")))
    df = df.select("doc_id", "t", found.alias("found"))
    df = df.select("doc_id", "t", F.transform("found", lambda m: replaced(m, key)).alias("new"))
    gaps = F.when(has_mail, F.split("t", ANY, -1)).otherwise(F.split("t", NUMBERS, -1))
    text = F.when(F.size("new") == 0, F.col("t")).otherwise(F.array_join(F.zip_with(
        gaps, "new", lambda g, r: F.concat(g, F.coalesce(r["value"], F.lit("")))), ""))

    def found(name: str) -> Column:
        of_kind = F.size(F.filter("new", lambda r: r["kind"].eqNullSafe(F.lit(name))))
        return F.when(F.col("t").isNull(), F.lit(0)).otherwise(of_kind).cast("long").alias(f"n_{name}")

    df = df.select("doc_id", F.when(F.col("t").isNotNull(), text).alias("text"), *[found(name) for name, _ in KINDS])
    return df.withColumn("n_found", sum((F.col(f"n_{name}") for name, _ in KINDS), F.lit(0).cast("long")))
