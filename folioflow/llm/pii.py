"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Everything is a Column expression: one pattern finds candidates, each is
validated (Luhn, octets, calendar, areas), and a valid one is replaced by a
keyed Feistel permutation of its own format. Equal values stay equal across
documents, distinct ones stay distinct within a format, separators and lengths
stay, and a pseudonym is valid again. What fails its validation stays.

    email   letters and digits of the local part, each within its class; case doesn't tell apart and stays
    ipv4    the 32 bits of four octets
    date    yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, dd/mm/yyyy (else mm/dd/yyyy): the day in 1600..2299
    ssn     area, group and serial, within their valid values
    card    13 to 19 digits: all but the Luhn digit, which is set anew
    phone   + country code and groups, (ddd) ddd-dddd or ddd-ddd-dddd: digits after the country code, however grouped

Edge cases: null texts stay null and empty ones empty, with counts of 0;
repeated rows get equal results; of texts that touch or overlap the leftmost,
then the first kind in the list, counts; long texts are handled whole; other columns
pass through unless they bear a result's name; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ipv4", "date", "ssn", "card", "phone")
ROUNDS = 8
#: The setting that names the key, where a caller gives none. Who has the key can invert pseudonyms: none is built in.
KEY_SETTING = "folioflow.pii.key"
# Country codes of one and two digits; all others have three.
COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: 1600-01-01 in days from 1970-01-01, and the days up to 2299-12-31 as a product.
FIRST_DAY, DAY_PARTS = -135140, (370, 691)

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}"
IPV4 = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"
DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-])(?!\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\dA-Za-z-])(?:\d{13,19}|\d{4}(?<s>[ -])\d{4}\k<s>\d{4}\k<s>\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\dA-Za-z])(?!-\d)"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\d-])"
CANDIDATE = "|".join((EMAIL, IPV4, DATE, SSN, CARD, PHONE))


def _digest(key: str, tag: Column, i: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), tag, i.cast("string"), half), 256)


def permute_number(key: str, tag: str, value: Column, left: int, right: int) -> Column:
    """A keyed permutation of 0 .. left * right - 1: a Feistel network of modular adds to the two parts."""

    def step(s: Column, i: Column) -> Column:
        bits = lambda half: F.conv(F.substring(_digest(key, F.lit(tag), i, half.cast("string")), 1, 13), 16, 10).cast("long")
        even = i % 2 == 0
        return F.struct(F.when(even, (s["a"] + bits(s["b"])) % left).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise((s["b"] + bits(s["a"])) % right).alias("b"))

    start = F.struct(F.floor(value / right).cast("long").alias("a"), (value % right).cast("long").alias("b"))
    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, step, lambda s: s["a"] * right + s["b"])


def _shifted(half: Column, digest: Column) -> Column:
    """half (at most 32 characters) with each letter and digit moved within its class by the digest's bytes."""

    def move(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(digest, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
        turn = lambda first, n: F.chr(F.lit(first) + (F.ascii(c) - first + by) % n)
        return F.when(c.between("0", "9"), turn(48, 10)).when(c.between("a", "z"), turn(97, 26)).when(c.between("A", "Z"), turn(65, 26)).otherwise(c)

    return F.array_join(F.transform(F.split(half, ""), move), "")


def permute_text(key: str, tag: str, value: Column) -> Column:
    """A keyed permutation of texts of value's form (at most 64 characters): a Feistel network over its halves."""
    tag = F.concat(F.lit(tag), F.length(value).cast("string"))
    cut = F.floor(F.length(value) / 2).cast("int")

    def step(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, _shifted(s["a"], _digest(key, tag, i, s["b"]))).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(_shifted(s["b"], _digest(key, tag, i, s["a"]))).alias("b"))

    start = F.struct(F.substring(value, F.lit(1), cut).alias("a"), F.substring(value, cut + 1, F.length(value)).alias("b"))
    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), start, step, lambda s: F.concat(s["a"], s["b"]))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refill(form: Column, new: Column) -> Column:
    """form with its digits replaced in turn by those of new."""
    return F.array_join(F.zip_with(F.split(form, "[0-9]", -1), F.split(new, ""), lambda gap, d: F.concat(gap, F.coalesce(d, F.lit("")))), "")


def luhn_sum(number: Column) -> Column:
    """Sum of the digits, every second one from the last but one doubled (less 9 over 9)."""
    doubled = lambda x: F.when(x > 4, x * 2 - 9).otherwise(x * 2)
    at = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(at, F.lit(0), lambda a, x: a + x)


def _date_parts(m: Column) -> tuple[Column, Column]:
    """(order of the parts, the day), null unless it is a day of 1600..2299."""
    made = lambda y, a, b: F.try_to_date(F.concat_ws("-", F.substring(m, *y), F.substring(m, *a), F.substring(m, *b)), "yyyy-MM-dd")
    iso = made((1, 4), (6, 2), (9, 2))
    day_first = made((7, 4), (4, 2), (1, 2))
    month_first = made((7, 4), (1, 2), (4, 2))
    first = m.rlike(r"^\d{4}")
    order = F.when(first, "iso").when(day_first.isNotNull(), "dmy").when(m.contains("/") & month_first.isNotNull(), "mdy")
    day = F.when(first, iso).otherwise(F.coalesce(day_first, F.when(m.contains("/"), month_first)))
    return order, F.when((F.year(day) >= 1600) & (F.year(day) <= 2299), day)


def _octets(m: Column) -> Column:
    return F.transform(F.split(m, r"\."), lambda x: x.cast("long"))


def kind_of(m: Column) -> Column:
    """The kind of a valid candidate, or null."""
    ssn = (~F.substring(m, 1, 3).isin("000", "666")) & (F.substring(m, 1, 1) != "9") & (F.substring(m, 5, 2) != "00") & (F.substring(m, 8, 4) != "0000")
    count = F.length(digits(m))
    return (
        F.when(m.contains("@"), F.lit("email"))
        .when(m.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), F.when(F.forall(_octets(m), lambda x: x <= 255), "ipv4"))
        .when(m.rlike(r"^(?:\d{4}[-/]\d{2}[-/]\d{2}|\d{2}[./]\d{2}[./]\d{4})$"), F.when(_date_parts(m)[1].isNotNull(), "date"))
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.when(ssn, "ssn"))
        .when(m.rlike(r"^(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})$"), F.when(count.between(13, 19) & (luhn_sum(digits(m)) % 10 == 0), "card"))
        .when(count.between(7, 15), F.lit("phone"))
    )


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a valid candidate of that kind."""
    local = F.substring_index(m, "@", 1)
    cased = F.zip_with(F.split(permute_text(key, "email", F.lower(local)), ""), F.split(local, ""), lambda new, old: F.when(old.between("A", "Z"), F.upper(new)).otherwise(new))
    email = F.concat(F.array_join(cased, ""), F.substring(m, F.length(local) + 1, F.length(m)))

    value = F.aggregate(_octets(m), F.lit(0).cast("long"), lambda a, x: a * 256 + x)
    ip = permute_number(key, "ipv4", value, 65536, 65536)
    ipv4 = F.concat_ws(".", *[(F.shiftright(ip, s) % 256).cast("string") for s in (24, 16, 8, 0)])

    order, day = _date_parts(m)
    new_day = F.date_add(F.lit("1970-01-01").cast("date"), (permute_number(key, "date", F.unix_date(day).cast("long") - FIRST_DAY, *DAY_PARTS) + FIRST_DAY).cast("int"))
    shown = lambda pattern: F.date_format(new_day, pattern)
    date = refill(m, F.when(order == "iso", shown("yyyyMMdd")).when(order == "dmy", shown("ddMMyyyy")).otherwise(shown("MMddyyyy")))

    part = lambda a, n: F.substring(m, a, n).cast("long")
    area = part(1, 3) - 1 - F.when(part(1, 3) > 666, 1).otherwise(0)
    dense = permute_number(key, "ssn", (area * 99 + part(5, 2) - 1) * 9999 + part(8, 4) - 1, 898 * 99, 9999)
    new_area = F.floor(dense / (99 * 9999)).cast("long") + 1
    ssn = F.concat_ws("-", F.lpad((new_area + F.when(new_area >= 666, 1).otherwise(0)).cast("string"), 3, "0"), F.lpad((F.floor(dense / 9999) % 99 + 1).cast("string"), 2, "0"), F.lpad((dense % 9999 + 1).cast("string"), 4, "0"))

    number = digits(m)
    body = permute_text(key, "card", F.substring(number, F.lit(1), F.length(number) - 1))
    card = refill(m, F.concat(body, ((F.lit(10) - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")))

    # One number in any grouping: the country code is read off the digits.
    code = F.when(m.startswith("+"), F.regexp_extract(number, COUNTRY, 0)).otherwise(F.lit(""))
    phone = refill(m, F.concat(code, permute_text(key, "phone", F.substring(number, F.length(code) + 1, F.length(number)))))
    return F.when(kind == "email", email).when(kind == "ipv4", ipv4).when(kind == "date", date).when(kind == "ssn", ssn).when(kind == "card", card).when(kind == "phone", phone).otherwise(m)


def pseudonymise(docs: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """docs with text's personal data replaced, and n_<kind> for each kind.

    key: the secret that the permutations hang on; if none is given, the session's folioflow.pii.key."""
    key = key or docs.sparkSession.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"Pseudonyms need a key: an argument, or the setting {KEY_SETTING}")
    found = docs.withColumn("__pii_found", F.when(F.col(text).rlike("[0-9@]"), F.regexp_extract_all(F.col(text), F.lit(CANDIDATE), F.lit(0))))
    valid = found.withColumn("__pii_valid", F.transform("__pii_found", lambda m: F.struct(m.alias("old"), kind_of(m).alias("kind"))))
    new = F.transform("__pii_valid", lambda x: pseudonym(x["old"], x["kind"], key))
    gaps = F.split(F.col(text), CANDIDATE, -1)
    rebuilt = F.array_join(F.zip_with(gaps, new, lambda gap, m: F.concat(gap, F.coalesce(m, F.lit("")))), "")
    some = F.exists("__pii_valid", lambda x: x["kind"].isNotNull())
    number = lambda k: F.size(F.filter("__pii_valid", lambda x: x["kind"] == k))
    counts = {f"n_{k}": F.when(F.col("__pii_valid").isNull(), F.lit(0)).otherwise(number(k)).cast("long") for k in KINDS}
    return valid.select(*[F.col(f"`{c}`") for c in docs.columns if c != text and c not in counts], F.when(some, rebuilt).otherwise(F.col(text)).alias(text), *[c.alias(k) for k, c in counts.items()])
