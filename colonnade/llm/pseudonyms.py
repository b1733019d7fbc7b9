"""PII: format-preserving Feistel pseudonyms for validated numbers, dates and addresses.

A value found in a text is validated (check digit, calendar, numbering plan, octets), read as a pair of
residues (l mod a, r mod b), sent through a keyed Feistel network over Z_a x Z_b and written back in its
own format: the same separators, a valid check digit, a real date. That is a permutation of the values of a
kind, so equal values have equal pseudonyms in all documents and formats, and different ones different
ones. Letters and digits of mail names and access keys are shifted within their class, half by
half, in the same way. Only built-in functions run; a text without a candidate is only searched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.llm.base import query, spread

ROUNDS = 6
KEY = "pseudonym key of the test tables"  # a parameter of every function; a secret elsewhere

#: The candidates of each kind. Their order matters where they could overlap.
PATTERNS = {
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "access": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "phone": r"(?<![0-9A-Za-z+])\+1[ .-]?\(?[2-9][0-9]{2}\)?[ .-]?[2-9][0-9]{2}[ .-]?[0-9]{4}(?![0-9])",
    "iso_date": r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])",
    "dotted_date": r"(?<![0-9.])[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9]|\.[0-9])",
    "slashed_date": r"(?<![0-9/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])",
    "address": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "insured": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Dates from here on; 280 x 280 days reach into 2104.
FIRST_DAY, SIDE = "1890-01-01", 280
#: Modulus pairs of the kinds (cards have powers of ten by their length).
MODULI = {"date": (SIDE, SIDE), "address": (1 << 16, 1 << 16), "phone": (640_000, 10_000), "insured": (898, 99 * 9_999)}


def _keyed(key: str, tag: Column | str, round_: int, value: Column) -> Column:
    """A keyed 60-bit number for a round and a half."""
    tag = F.lit(tag) if isinstance(tag, str) else tag
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), tag, F.lit(round_), value.cast("string")), 256), 1, 15), 16, 10).cast("long")


def _let(values: dict[str, Column] | list[tuple[str, Column]], then) -> Column:
    """``then`` applied to named values that are computed once: a struct bound by a one-element transform."""
    items = values.items() if isinstance(values, dict) else values
    return F.get(F.transform(F.array(F.struct(*[c.alias(n) for n, c in items])), lambda s: then(s)), F.lit(0))


def _pair(left: Column, right: Column, a, b, key: str, tag, then) -> Column:
    """``then(l, r)`` of the permuted pair; every round is bound before the next one uses it."""
    def go(k: int, l: Column, r: Column) -> Column:
        if k == ROUNDS:
            return then(l, r)
        if k % 2 == 0:
            return _let({"l": F.pmod(l + F.pmod(_keyed(key, tag, k, r), a), a), "r": r}, lambda s: go(k + 1, s["l"], s["r"]))
        return _let({"l": l, "r": F.pmod(r + F.pmod(_keyed(key, tag, k, l), b), b)}, lambda s: go(k + 1, s["l"], s["r"]))

    a, b = (x if isinstance(x, Column) else F.lit(x).cast("long") for x in (a, b))
    return go(0, left.cast("long"), right.cast("long"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _zeros(x: Column, n: int | Column) -> Column:
    return F.lpad(x.cast("string"), n, "0") if isinstance(n, int) else F.concat(F.repeat(F.lit("0"), n - F.length(x.cast("string"))), x.cast("string"))


def _number(x: Column, at: int, n: int) -> Column:
    return F.substring(x, at, n).cast("long")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits`` in order."""
    chars = F.transform(F.split(shape, ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substring(digits, F.length(_digits(F.substring(shape, F.lit(1), i))) + 1, F.lit(1))).otherwise(c))
    return F.array_join(chars, "")


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled (less 9 above 9)."""
    one = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.get(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int"))))
    return F.aggregate(one, F.lit(0), lambda s, v: s + v)


def _card_splits() -> list[str]:
    """Patterns ``(before)(card)(after)`` that leave up to six digits aside, whole groups only, longest card first."""
    out = []
    for total in range(1, 7):
        for before in range(total + 1):
            after = total - before
            lead = rf"(?:[0-9][ -]?){{{before - 1}}}[0-9][ -]" if before else ""
            tail = rf"[ -][0-9](?:[ -]?[0-9]){{{after - 1}}}" if after else ""
            out.append(rf"\A({lead})([0-9](?:[ -]?[0-9]){{12,18}})({tail})\z")
    return out


def _card(x: Column, key: str) -> Column:
    """All digits but the last are permuted, and the last is the check digit again. A number that fails the check may be a card
    beside an expiry, a code or a list number: the longest run of its digit groups that passes is the card."""
    def new(s):
        d, n = s["d"], F.length(s["d"]) - 1
        u = F.floor(n / 2).cast("int")
        def write(l, r):
            body = F.concat(_zeros(l, u), _zeros(r, n - u))
            check = F.pmod(F.lit(10) - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
            return F.concat(s["before"], _refill(s["card"], F.concat(body, check.cast("string"))), s["after"])
        power = lambda e: F.pow(F.lit(10.0), e).cast("long")
        swapped = _pair(F.substring(d, F.lit(1), u).cast("long"), F.substring(d, u + 1, n - u).cast("long"), power(u), power(n - u), key, F.concat(F.lit("card"), n.cast("string")), write)
        return F.when(d.isNotNull(), swapped).otherwise(x)

    valid = lambda c: luhn_sum(_digits(c)) % 10 == 0
    part = lambda p, g: F.call_function("regexp_extract", x, p, F.lit(g))
    cut = F.transform(F.array(*[F.lit(p) for p in _card_splits()]), lambda p: F.struct(part(p, 1).alias("before"), part(p, 2).alias("card"), part(p, 3).alias("after")))
    whole = F.struct(F.lit("").alias("before"), x.alias("card"), F.lit("").alias("after"))
    found = F.when(valid(x), whole).otherwise(F.get(F.filter(cut, lambda c: (c["card"] != "") & valid(c["card"])), F.lit(0)))
    return _let({"f": found}, lambda s: _let({"before": s["f"]["before"], "card": s["f"]["card"], "after": s["f"]["after"], "d": _digits(s["f"]["card"])}, new))


def _phone(x: Column, key: str) -> Column:
    """Area and exchange (first digits 2-9) against the line number; the country code stays."""
    def new(s):
        d = s["d"]
        left = (_number(d, 2, 3) - 200) * 800 + _number(d, 5, 3) - 200
        write = lambda l, r: _refill(x, F.concat(F.lit("1"), (F.floor(l / 800) + 200).cast("string"), (l % 800 + 200).cast("string"), _zeros(r, 4)))
        return _pair(left, _number(d, 8, 4), *MODULI["phone"], key, "phone", write)

    return _let({"d": _digits(x)}, new)


def _address(x: Column, key: str) -> Column:
    def new(s):
        o = [F.get(s["o"], F.lit(i)).cast("long") for i in range(4)]
        write = lambda l, r: F.concat_ws(".", F.floor(l / 256), l % 256, F.floor(r / 256), r % 256)
        fine = F.forall(s["o"], lambda v: (v.cast("int") < 256) & ((v == "0") | ~v.startswith("0")))
        return F.when(fine, _pair(o[0] * 256 + o[1], o[2] * 256 + o[3], *MODULI["address"], key, "address", write)).otherwise(x)

    return _let({"o": F.split(x, r"\.")}, new)


def _insured(x: Column, key: str) -> Column:
    """Area 001-899 but 666, group 01-99, serial 0001-9999."""
    area, group, serial = _number(x, 1, 3), _number(x, 5, 2), _number(x, 8, 4)
    fine = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)

    def write(l, r):
        a = l + 1 + F.when(l >= 665, 1).otherwise(0)
        return F.concat_ws("-", _zeros(a, 3), _zeros(F.floor(r / 9_999) + 1, 2), _zeros(r % 9_999 + 1, 4))

    return F.when(fine, _pair(area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * 9_999 + serial - 1, *MODULI["insured"], key, "insured", write)).otherwise(x)


def _date(x: Column, pattern: str, key: str) -> Column:
    def new(s):
        n = F.datediff(s["day"], F.lit(FIRST_DAY).cast("date")).cast("long")
        write = lambda l, r: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (l * SIDE + r).cast("int")), pattern)
        return F.when(s["day"].isNotNull() & (n >= 0) & (n < SIDE * SIDE), _pair(F.floor(n / SIDE), n % SIDE, *MODULI["date"], key, "date", write)).otherwise(x)

    return _let({"day": F.try_to_timestamp(x, F.lit(pattern)).cast("date")}, new)


def _shifted(x: Column, by: Column, sign: int = 1) -> Column:
    """Every letter and digit moved within its class by a byte of ``by`` (hex)."""
    classes = (("0", 10), ("A", 26), ("a", 26))

    def move(c: Column, i: Column) -> Column:
        step = F.conv(F.substring(by, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
        out = c
        for (first, n), test in zip(classes, ("[0-9]", "[A-Z]", "[a-z]")):
            out = F.when(c.rlike(test), F.char(F.pmod(F.ascii(c) - ord(first) + sign * step, F.lit(n)) + ord(first))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(x, ""), move), "")


def _word(x: Column, key: str, tag: str) -> Column:
    """A Feistel network over the two halves of a string of at most 64 characters; what is no letter or digit stays."""
    def go(k: int, l: Column, r: Column) -> Column:
        if k == ROUNDS:
            return F.concat(l, r)
        by = lambda half: F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), F.lit(k), half), 256)
        if k % 2 == 0:
            return _let({"l": _shifted(l, by(r)), "r": r}, lambda s: go(k + 1, s["l"], s["r"]))
        return _let({"l": l, "r": _shifted(r, by(l))}, lambda s: go(k + 1, s["l"], s["r"]))

    h = F.floor(F.length(x) / 2).cast("int")
    return go(0, F.substring(x, F.lit(1), h), F.substring(x, h + 1, F.length(x) - h))


def pseudonym(x: Column, key: str = KEY) -> Column:
    """The pseudonym of a candidate, or the candidate itself where it isn't valid."""
    is_ = lambda kind: x.rlike(rf"\A(?:{PATTERNS[kind]})\z")
    name, at = F.substring_index(x, "@", 1), F.instr(x, "@")
    return (
        F.when(is_("mail"), F.concat(_word(name, key, "mail"), F.substring(x, at, F.length(x))))
        .when(is_("access"), F.concat(F.lit("AKIA"), _word(F.substring(x, 5, 16), key, "access")))
        .when(is_("phone"), _phone(x, key))
        .when(is_("iso_date"), _date(x, "yyyy-MM-dd", key))
        .when(is_("dotted_date"), _date(x, "dd.MM.yyyy", key))
        .when(is_("slashed_date"), _date(x, "MM/dd/yyyy", key))
        .when(is_("address"), _address(x, key))
        .when(is_("insured"), _insured(x, key))
        .when(is_("card"), _card(x, key))
        .otherwise(x)
    )


def pseudonymise(docs: DataFrame, key: str = KEY, report: bool = False) -> DataFrame:
    """``docs`` with every valid value in ``text`` replaced; with ``report``, ``row`` (a struct of the columns) and ``n_found``, the number of replaced values.

    Whole texts are searched; what stands between the values, invalid candidates, null and empty
    texts stay as they are, and so do all other columns, whatever their names. ``n_chars``, if there, counts the new
    text (an IPv4 address may get longer). Repeated rows come out alike.
    """
    cols = docs.columns
    has = F.coalesce(F.col("text").rlike(ANY), F.lit(False))
    none = F.expr("cast(array() as array<string>)")
    hits = F.when(has, F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).otherwise(none)
    out = spread(docs).select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col("text").alias("old"), hits.alias("hits"))
    out = out.withColumn("new", F.transform("hits", lambda x: pseudonym(x, key)))
    text = F.array_join(F.transform(F.split("old", ANY), lambda g, i: F.concat(g, F.coalesce(F.get("new", i), F.lit("")))), "")
    changed = F.zip_with("hits", "new", lambda x, y: (x != y).cast("int"))
    found = F.aggregate(changed, F.lit(0), lambda s, v: s + v).cast("long")
    out = out.select("row", F.when(F.size("hits") > 0, text).otherwise(F.col("old")).alias("written"), found.alias("n_found"))
    own = {"text": F.col("written")}
    if "n_chars" in cols:
        own["n_chars"] = F.when(F.col("n_found") > 0, F.length("written").cast("long")).otherwise(F.col("row.n_chars"))
    fields = [own.get(c, F.col("row").getField(c)).alias(c) for c in cols]
    return out.select(F.struct(*fields).alias("row"), "n_found") if report else out.select(*fields)


@query("op10_pseudonyms")
def op10_pseudonyms(t):
    """Every document with its values replaced."""
    return pseudonymise(t.documents, report=True).select("row.doc_id", "row.text", "n_found")
