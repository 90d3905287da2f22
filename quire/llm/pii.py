"""Format-preserving pseudonyms for personal data.

Numbers and dates are validated (check digits, octets, calendar), then permuted by a keyed Feistel
network over the digits of their own format: a card number becomes another valid card number with the
same separators, a date another date in the same notation. Equal values get equal pseudonyms in every
document, and who has the key can invert them. E-mail addresses and secrets, which are no numbers,
get keyed digests of their format. Everything is Column expressions: no value leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, own, text_of

#: The session's setting that holds op4's key.
KEY_SETTING = "spark.quire.pii.key"
ROUNDS = 10

#: The shapes looked for, in order of precedence.
SHAPES = {
    "email": r"[\p{L}\p{N}._%+\-]+@[\p{L}\p{N}](?:[\p{L}\p{N}\-]*[\p{L}\p{N}])?(?:\.[\p{L}\p{N}](?:[\p{L}\p{N}\-]*[\p{L}\p{N}])?)*\.\p{L}{2,}",
    "secret": r"(?i:\b(?:access[_\-]?token|auth[_\-]?token|token|api[_\-]?key|secret[_\-]?key|secret|password|passwd|pwd)\b[\"']?\s*[:=]\s*[\"']?[A-Za-z0-9/_+=.\-]{8,}[\"']?)"
    r"|\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36,}\b|\bsk-[A-Za-z0-9_\-]{20,}|\beyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9])",
    "date": r"(?<![0-9./\-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/]|[.\-][0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3} ?\([0-9]{2,4}\) ?[0-9]{3}[ .\-][0-9]{4}(?![0-9])|(?<![0-9+])\+[0-9]{1,3}(?:[ .\-]?\(?[0-9]{1,4}\)?){2,6}(?![0-9])|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}(?![0-9])|(?<![0-9.\-])[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9\-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9\-])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5})(?![0-9])",
}
#: Country calling codes of one and of two digits; all others have three.
SHORT_CODES = r"^(?:1|7)"
TWO_DIGIT_CODES = r"^(?:20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|53|54|55|56|57|58|60|61|62|63|64|65|66|81|82|84|86|90|91|92|93|94|95|98)"
#: Steps of a cycle walk at most: of the numbers that a permutation gives, over 87 % are in the domain.
WALK = 64
#: Phone numbers have so many digits.
PHONE_DIGITS = (8, 15)
#: Dates are permuted among the days of these years.
FIRST_DAY, DAYS = "1900-01-01", 73_049
PATTERN = "|".join(f"(?:{p})" for p in SHAPES.values())
KINDS = list(SHAPES)


def _digest(*parts: Column) -> Column:
    """60 bits of a keyed digest."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 15), 16, 10).cast("long")


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def feistel_digits(digits: Column, key: Column, tweak: str) -> Column:
    """A keyed permutation of the digit strings of one length (2 to 36), by alternating halves."""
    n = F.length(digits)

    def step(s: Column, i: Column) -> Column:
        m = F.length(s["a"])
        f = _digest(key, F.lit(tweak), i.cast("string"), n.cast("string"), s["b"])
        c = F.pmod(s["a"].cast("long") + F.pmod(f, _power(m)), _power(m))
        return F.struct(s["b"].alias("a"), F.lpad(c.cast("string"), m, F.lit("0")).alias("b"))

    left = F.floor(n / 2).cast("int")
    start = F.struct(F.substring(digits, F.lit(1), left).alias("a"), F.substring(digits, left + 1, n).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["a"], s["b"]))


def _bits(value: Column, key: Column, tweak: str, left: int, right: int) -> Column:
    """A keyed permutation of the left + right bit numbers."""

    def step(s: Column, i: Column) -> Column:
        f = _digest(key, F.lit(tweak), i.cast("string"), s["b"].cast("string"))
        wide = F.when(i % 2 == 0, F.lit(1 << left)).otherwise(F.lit(1 << right)).cast("long")
        return F.struct(s["b"].alias("a"), F.pmod(s["a"] + F.pmod(f, wide), wide).alias("b"))

    start = F.struct(F.shiftright(value, right).alias("a"), value.bitwiseAND(F.lit((1 << right) - 1).cast("long")).alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.shiftleft(s["a"], right) + s["b"])


def _only_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _filled(shape: Column, digits: Column) -> Column:
    """shape with its digits replaced, one after another."""
    chars = F.transform(F.sequence(F.lit(1), F.length(shape)), lambda i: F.substring(shape, i, F.lit(1)))

    def step(s: Column, ch: Column) -> Column:
        d = ch.between("0", "9") & (F.length(ch) == 1)
        return F.struct(
            F.concat(s["out"], F.when(d, F.substring(digits, s["at"], F.lit(1))).otherwise(ch)).alias("out"),
            (s["at"] + F.when(d, F.lit(1)).otherwise(F.lit(0))).alias("at"),
        )

    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step, lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """Luhn's sum, the last digit counting once."""
    values = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.struct(F.substring(digits, i, F.lit(1)).cast("int").alias("d"), ((F.length(digits) - i) % 2).alias("odd")))
    return F.aggregate(values, F.lit(0), lambda n, x: n + F.when(x["odd"] == 1, 2 * x["d"] - F.when(x["d"] > 4, 9).otherwise(0)).otherwise(x["d"]))


def _card(m: Column, key: Column) -> Column:
    def other(d: Column) -> Column:
        body = feistel_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")
        return let(body, lambda b: F.concat(b, F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))

    return let(_only_digits(m), lambda d: F.when(luhn_sum(d) % 10 == 0, _filled(m, other(d))).otherwise(m))


def _mod97(s: Column) -> Column:
    """An IBAN's remainder: letters count as 10 to 35, the first four characters come last."""
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))
    values = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.substring(turned, i, F.lit(1)))
    number = lambda ch: F.when(ch.between("0", "9"), ch.cast("int")).otherwise(F.ascii(ch) - 55)
    return F.aggregate(values, F.lit(0), lambda r, ch: F.pmod(r * F.when(ch.between("0", "9"), 10).otherwise(100) + F.coalesce(number(ch), F.lit(0)), F.lit(97)))


def _iban(m: Column, key: Column) -> Column:
    """Country and letters stay; the account's digits are permuted and the check digits follow."""

    def other(s: Column) -> Column:
        account = F.substring(s, F.lit(5), F.length(s))
        new = let(account, lambda a: _filled(a, feistel_digits(_only_digits(a), key, "iban")))
        check = lambda a: F.lpad((98 - _mod97(F.concat(F.substring(s, 1, 2), F.lit("00"), a))).cast("string"), 2, "0")
        return let(new, lambda a: F.concat(check(a), _only_digits(a)))

    valid = lambda s: (_mod97(s) == 1) & (F.length(_only_digits(F.substring(s, F.lit(5), F.length(s)))) >= 2)
    return let(F.replace(m, F.lit(" "), F.lit("")), lambda s: F.when(valid(s), _filled(m, other(s))).otherwise(m))


def _ip(m: Column, key: Column) -> Column:
    octet = lambda i: F.split_part(m, F.lit("."), F.lit(i)).cast("long")
    value = ((octet(1) * 256 + octet(2)) * 256 + octet(3)) * 256 + octet(4)
    part = lambda v, k: F.shiftright(v, k).bitwiseAND(F.lit(255).cast("long")).cast("string")
    return let(_bits(value, key, "ip", 16, 16), lambda v: F.concat_ws(".", part(v, 24), part(v, 16), part(v, 8), part(v, 0)))


def _date(m: Column, key: Column) -> Column:
    """Cycle-walking: steps of the permutation until a day of the domain comes up."""

    def other(day: Column) -> Column:
        walk = F.aggregate(
            F.sequence(F.lit(1), F.lit(64)),
            _bits(day, key, "date", 8, 9),
            lambda v, _: F.when(v < DAYS, v).otherwise(_bits(v, key, "date", 8, 9)),
        )
        return let(walk, lambda v: F.date_add(F.lit(FIRST_DAY).cast("date"), v.cast("int")))

    def as_in(style: str) -> Column:
        day = F.try_to_timestamp(m, F.lit(style)).cast("date")
        return let(F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long"), lambda v: F.when(v.between(0, DAYS - 1), F.date_format(other(v), style)).otherwise(m))

    return F.coalesce(F.when(m.contains("-"), as_in("yyyy-MM-dd")).when(m.contains("/"), as_in("dd/MM/yyyy")).otherwise(as_in("dd.MM.yyyy")), m)


def _phone(m: Column, key: Column) -> Column:
    """The country code after a + stays; separators don't change what the digits become."""
    code = lambda d: F.when(~m.startswith("+"), 0).when(d.rlike(SHORT_CODES), 1).when(d.rlike(TWO_DIGIT_CODES), 2).otherwise(3)
    new = lambda d: let(code(d), lambda c: F.concat(F.substring(d, F.lit(1), c), feistel_digits(F.substring(d, c + 1, F.length(d)), key, "phone")))
    return let(_only_digits(m), lambda d: F.when(F.length(d).between(*PHONE_DIGITS), _filled(m, new(d))).otherwise(m))


def _ssn(m: Column, key: Column) -> Column:
    """Cycle-walking: steps of the permutation until an area, group and serial that are given out come up."""
    valid = lambda d: ~d.rlike("^(?:000|666|9)|^...00|0000$")
    step = lambda d: feistel_digits(d, key, "ssn")
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), step(_only_digits(m)), lambda d, _: F.when(valid(d), d).otherwise(step(d)))
    return _filled(m, walked)


def _email(m: Column, key: Column) -> Column:
    return F.concat(F.lit("user-"), F.substring(F.sha2(F.concat_ws(":", key, F.lit("email"), F.lower(m)), 256), 1, 16), F.lit("@pseudonym.invalid"))


def _secret(m: Column, key: Column) -> Column:
    """The name of the secret stays; its value becomes hexadecimal digits of equal number."""
    value = F.regexp_extract(m, r"([A-Za-z0-9/_+=.\-]+)[\"']?$", 1)
    new = lambda v: F.substring(F.repeat(F.sha2(F.concat_ws(":", key, F.lit("secret"), F.lower(v)), 512), 8), F.lit(1), F.least(F.length(v), F.lit(1024)))
    return let(value, lambda v: F.replace(m, v, new(v)))


_OTHER = {"email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "date": _date, "phone": _phone, "ssn": _ssn, "card": _card}


def _kind(m: Column) -> Column:
    """Number of the first shape that the whole match has."""
    out = F.lit(len(KINDS))
    for i in reversed(range(len(KINDS))):
        out = F.when(m.rlike(f"^(?:{SHAPES[KINDS[i]]})$"), F.lit(i)).otherwise(out)
    return out


def _replaced(m: Column, key: Column) -> Column:
    def choose(k: Column) -> Column:
        out = m
        for i, kind in reversed(list(enumerate(KINDS))):
            out = F.when(k == i, _OTHER[kind](m, key)).otherwise(out)
        return out

    return let(_kind(m), lambda k: F.struct(k.alias("kind"), choose(k).alias("new")))


def pseudonymize(docs: DataFrame, *, key: str) -> DataFrame:
    """docs (doc_id, text and others) with text pseudonymized, and n_found and n_<kind> columns of what changed.

    Columns of docs with one of those names are replaced; any others keep their values, whatever their names. Null
    text stays null. Texts without any of the shapes, empty ones included, stay as they are. Values that fail
    validation stay. Repeated rows and equal values change alike. An empty table gives an empty result. Very long
    texts are split at their matches.
    """
    k = F.lit(key)
    counted = ["n_found", *[f"n_{x}" for x in KINDS]]
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (*counted, "text")]
    m, n, c = own(docs.columns, "matches", "pseudonyms", "changed")
    # Most texts have no digit and no @: only the others are searched for the shapes.
    may = F.col("text").rlike(r"[0-9@]|eyJ|sk-|gh[pousr]_") | F.lower("text").rlike("token|secret|passw|api[_-]?key|pwd")
    found = docs.select(*rest, "text", F.when(may, F.regexp_extract_all("text", F.lit(PATTERN), 0)).alias(m))
    news = F.when(F.size(m) > 0, F.transform(m, lambda x: _replaced(x, k)))
    found = found.select(*rest, "text", m, news.alias(n))
    gaps = F.split("text", PATTERN, -1)
    fill = F.concat(F.transform(n, lambda x: x["new"]), F.array(F.lit("")))
    text = F.when(F.size(n) > 0, F.array_join(F.flatten(F.zip_with(gaps, fill, lambda g, x: F.array(g, x))), "")).otherwise(F.col("text"))
    changed = F.filter(F.zip_with(m, n, lambda x, y: F.when(x != y["new"], y["kind"])), lambda x: x.isNotNull())
    found = found.select(*rest, text.alias("text"), F.coalesce(changed, F.array().cast("array<int>")).alias(c))
    number = lambda i: F.size(F.filter(c, lambda x: x == i)).cast("long")
    order = [*[F.col(f"`{x}`") for x in docs.columns if x not in counted], F.size(c).cast("long").alias("n_found"), *[number(i).alias(f"n_{x}") for i, x in enumerate(KINDS)]]
    return found.select(*order)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is the session's; the query's own tables are made up, so where none is set a fixed one does."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text_of().alias("text"))
    return pseudonymize(docs, key=spark.conf.get(KEY_SETTING, "made-up tables"))
