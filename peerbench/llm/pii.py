"""Format-preserving pseudonyms for personal data.

Numbers, dates and addresses that validate are replaced by others of the same format: a keyed
Feistel network permutes all values of a format, so equal values stay equal across documents, no two
values meet, and the holder of the key can go back. Everything is one projection of built-in
functions: a text is cut at its matches, each match is rewritten, the pieces are joined.

The network works on a string cut in two halves. In each round every character of one half moves
on within its own class (digits, lower-case letters, upper-case letters) by an amount drawn from the
keyed hash of the other half; other characters stay. Where a format has a check digit, the rest is
permuted and the digit worked out again. Where only some strings of a format are valid, the
permutation is repeated until it meets a valid one, which again is a permutation of the valid ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.llm.quality import once

ROUNDS = 8
#: Steps of walking to a valid value. The chance that none is valid is below 1e-9 for each format.
WALK = 160
FIRST_DAY, DAYS = "1900-01-01", 73049  # up to 2099-12-31

# The patterns looked for, in order of precedence.
_EDGE, _END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}" + _END,
    "iban": _EDGE + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END,
    "ipv4": r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![A-Za-z0-9]|\.[0-9])",
    "date": _EDGE + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})" + _END,
    "ssn": _EDGE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
    "phone": r"(?<![A-Za-z0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![A-Za-z0-9-])",
    "international": r"(?<![A-Za-z0-9])\+[1-9][0-9]{0,2}(?:[ .-]?[0-9]{2,5}){2,6}" + _END,
    "card": _EDGE + r"[0-9](?:[ -]?[0-9]){12,18}" + _END,
    "key": _EDGE + r"(?:AKIA[A-Z0-9]{16}|[0-9a-fA-F]{32,64})" + _END,
}
# Numbers in groups: a whole run is taken, up to where a value of another form starts, and searched for
# the cards and IBANs that stand in it from one border of a group to another.
_OTHER = "|".join(PATTERNS[k] for k in ("email", "ipv4", "date", "ssn", "phone"))
RUNS = {
    "iban": _EDGE + rf"(?=[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2}})[A-Z0-9]++(?![a-z])(?:[ -](?!{_OTHER})[A-Z0-9]++(?![a-z]))*+",
    "card": _EDGE + rf"(?=[0-9](?:[ -]?[0-9]){{12}})[0-9]{{1,19}}+{_END}(?:[ -](?!{_OTHER})[0-9]{{1,19}}+{_END})*+",
}
SHAPES = {"iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9 -]*+$", "card": r"^(?=[0-9](?:[ -]?[0-9]){12})[0-9]{1,19}+(?:[ -][0-9]{1,19}+)*+$"}
#: (start of a value, characters of the start, least and most characters of a value), without separators.
SIZES = {"iban": ("[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9])", 4, 15, 34), "card": ("[0-9](?:[ -]?[0-9])", 1, 13, 19)}
ANY = "|".join((PATTERNS | RUNS).values())
IN_RUN = "|".join(p for k, p in (PATTERNS | RUNS).items() if k != "iban")


def _shift(c: Column, by: Column, letters: int) -> Column:
    """A character moved on within its class."""
    code = F.ascii(c)

    def moved(first: int, size: int) -> Column:
        return F.char(F.lit(first) + (code - first + by) % size)

    return (
        F.when(code.between(48, 57), moved(48, 10))
        .when(code.between(97, 96 + letters), moved(97, letters))
        .when(code.between(65, 90), moved(65, 26))
        .otherwise(c)
    )


def permute(s: Column, key: str, kind: str, letters: int = 26) -> Column:
    """The Feistel network over a string of ASCII characters, each kept in its class.

    `letters` is the number of lower-case letters that are one class: 6 for hexadecimal digits.
    """

    def step(state: Column, r: Column) -> Column:
        left, right = state["l"], state["r"]
        drawn = F.sha2(F.concat(F.lit(f"{key}|{kind}|"), r.cast("string"), F.lit("|"), F.length(left).cast("string"), F.lit("|"), right), 256)
        mixed = once(
            drawn,
            lambda h: F.array_join(
                F.transform(
                    F.filter(F.split(left, ""), lambda c: c != ""),
                    lambda c, i: _shift(c, F.conv(F.substr(h, (i % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int"), letters),
                ),
                "",
            ),
        )
        return F.struct(right.alias("l"), mixed.alias("r"))

    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), half).alias("l"), F.substr(s, half + 1, F.length(s)).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda x: F.concat(x["l"], x["r"]))


def walk(s: Column, key: str, kind: str, valid: Callable[[Column], Column]) -> Column:
    """`permute`, repeated until the value is valid again."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        F.struct(F.lit(False).alias("done"), s.alias("s")),
        lambda x, _: F.when(x["done"], x).otherwise(
            once(permute(x["s"], key, kind), lambda p: F.struct(valid(p).alias("done"), p.alias("s")))
        ),
        lambda x: x["s"],
    )


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def refill(form: Column, digits: Column) -> Column:
    """`form` with its digits (and capitals, where `digits` has them) replaced in order."""
    parts = F.split(F.regexp_replace(form, "[0-9A-Z]", "\u0001"), "\u0001", -1)
    return F.array_join(
        F.transform(parts, lambda p, i: F.concat(p, F.coalesce(F.substr(digits, i + 1, F.lit(1)), F.lit("")))), ""
    )


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum with every second digit doubled, from the right; `doubled` is the place of the first."""
    return F.aggregate(
        F.transform(
            F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
            lambda c, i: once(
                c.cast("int") * F.when(i % 2 == doubled, 2).otherwise(1), lambda d: F.when(d > 9, d - 9).otherwise(d)
            ),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )


def _mod97(s: Column) -> Column:
    return F.aggregate(
        F.filter(F.split(s, ""), lambda c: c != ""),
        F.lit(0),
        lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )


def is_card(m: Column) -> Column:
    return _luhn_sum(_digits(m), 1) % 10 == 0


def card(m: Column, key: str) -> Column:
    """All but the check digit is permuted; the first digit stays."""
    d = _digits(m)
    body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permute(F.substr(d, F.lit(2), F.length(d) - 2), key, "card"))
    full = once(body, lambda b: F.concat(b, ((10 - _luhn_sum(b, 0) % 10) % 10).cast("string")))
    return refill(m, full)


def is_iban(m: Column) -> Column:
    s = F.replace(m, F.lit(" "), F.lit(""))
    return F.length(s).between(15, 34) & (_mod97(F.concat(F.substr(s, F.lit(5), F.length(s)), F.substr(s, F.lit(1), F.lit(4)))) == 1)


def iban(m: Column, key: str) -> Column:
    s = F.replace(m, F.lit(" "), F.lit(""))
    land = F.substr(s, F.lit(1), F.lit(2))
    full = once(
        permute(F.substr(s, F.lit(5), F.length(s)), key, "iban"),
        lambda b: F.concat(land, F.lpad((98 - _mod97(F.concat(b, land, F.lit("00")))).cast("string"), 2, "0"), b),
    )
    return refill(m, full)


def is_ipv4(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda x: (x.cast("int") <= 255) & (F.length(x) == F.length(x.cast("int").cast("string"))))


def ipv4(m: Column, key: str) -> Column:
    """Permutes the 32 bits as two halves of 16."""
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))

    def step(x: Column, r: Column) -> Column:
        drawn = F.sha2(F.concat(F.lit(f"{key}|ipv4|"), r.cast("string"), F.lit("|"), x["r"].cast("string")), 256)
        return F.struct(x["r"].alias("l"), x["l"].bitwiseXOR(F.conv(F.substr(drawn, F.lit(1), F.lit(4)), 16, 10).cast("int")).alias("r"))

    def text(x: Column) -> Column:
        return F.concat_ws(".", *[(F.shiftright(h, 8) if high else h.bitwiseAND(255)).cast("string") for h in (x["l"], x["r"]) for high in (True, False)])

    return once(
        octets,
        lambda o: F.aggregate(
            F.sequence(F.lit(1), F.lit(ROUNDS)),
            F.struct((F.get(o, F.lit(0)) * 256 + F.get(o, F.lit(1))).alias("l"), (F.get(o, F.lit(2)) * 256 + F.get(o, F.lit(3))).alias("r")),
            step,
            text,
        ),
    )


def _day_first(m: Column) -> Column:
    """Whether dd/mm is meant: with dots always, with slashes where the first number can't be a month."""
    return m.contains(".") | (F.substr(m, F.lit(1), F.lit(2)).cast("int") > 12)


def _as_date(m: Column) -> Column:
    a, b = F.substr(m, F.lit(1), F.lit(2)), F.substr(m, F.lit(4), F.lit(2))
    iso = F.when(m.contains("-"), m).otherwise(
        F.concat_ws("-", F.substr(m, F.lit(7), F.lit(4)), F.when(_day_first(m), b).otherwise(a), F.when(_day_first(m), a).otherwise(b))
    )
    return F.try_to_date(iso, "yyyy-MM-dd")


def is_date(m: Column) -> Column:
    same = F.substr(m, F.lit(3), F.lit(1)) == F.substr(m, F.lit(6), F.lit(1))
    return (m.contains("-") | same) & _as_date(m).between(F.lit(FIRST_DAY).cast("date"), F.date_add(F.lit(FIRST_DAY).cast("date"), DAYS - 1))


def date(m: Column, key: str) -> Column:
    """Permutes the days of two centuries; a slashed date keeps its reading."""
    first = F.lit(FIRST_DAY).cast("date")
    slash_day = m.contains("/") & _day_first(m)
    day = lambda s: F.date_add(first, s.cast("int"))
    valid = lambda s: F.when(s.cast("int") < DAYS, ~slash_day | (F.dayofmonth(day(s)) > 12)).otherwise(False)
    place = F.lpad(F.datediff(_as_date(m), first).cast("string"), 5, "0")
    kind = F.when(slash_day, "dd/MM/yyyy").when(m.contains("/"), "MM/dd/yyyy").when(m.contains("."), "dd.MM.yyyy").otherwise("yyyy-MM-dd")
    return once(
        day(walk(place, key, "date", valid)),
        lambda d: F.when(kind == "dd/MM/yyyy", F.date_format(d, "dd/MM/yyyy"))
        .when(kind == "MM/dd/yyyy", F.date_format(d, "MM/dd/yyyy"))
        .when(kind == "dd.MM.yyyy", F.date_format(d, "dd.MM.yyyy"))
        .otherwise(F.date_format(d, "yyyy-MM-dd")),
    )


def _is_ssn_digits(d: Column) -> Column:
    area = F.substr(d, F.lit(1), F.lit(3))
    return ~area.isin("000", "666") & (area < "900") & (F.substr(d, F.lit(4), F.lit(2)) != "00") & (F.substr(d, F.lit(6), F.lit(4)) != "0000")


def _is_phone_digits(d: Column) -> Column:
    """Ten digits of the North American plan: area and exchange start at 2."""
    return (F.substr(d, F.lit(1), F.lit(1)) >= "2") & (F.substr(d, F.lit(4), F.lit(1)) >= "2")


def phone(m: Column, key: str) -> Column:
    """The last ten digits are permuted, those of the plan among themselves and others likewise; the country code stays."""
    d = _digits(m)
    land, own = F.substr(d, F.lit(1), F.length(d) - 10), F.right(d, F.lit(10))
    return refill(m, F.concat(land, walk(own, key, "phone", lambda p: _is_phone_digits(p) == _is_phone_digits(own))))


def international(m: Column, key: str) -> Column:
    """The first two digits stay, which are or start the country code."""
    d = _digits(m)
    return refill(m, F.concat(F.substr(d, F.lit(1), F.lit(2)), permute(F.substr(d, F.lit(3), F.length(d)), key, "international")))


def email(m: Column, key: str) -> Column:
    """The part before the @ is permuted under the key and the domain, which stays."""
    at = F.instr(m, "@")
    return F.concat(permute(F.substr(m, F.lit(1), at - 1), key, "email"), F.substr(m, at, F.length(m)))


def secret(m: Column, key: str) -> Column:
    """Access keys keep their prefix; hexadecimal keys stay hexadecimal, each letter in its case.

    One key in upper and in lower case has one pseudonym, in upper and in lower case.
    """
    access = F.concat(F.lit("AKIA"), permute(F.substr(m, F.lit(5), F.length(m)), key, "key"))

    def cased(p: Column) -> Column:
        letters = F.transform(
            F.split(m, ""), lambda c, i: once(F.substr(p, i + 1, F.lit(1)), lambda x: F.when(c.between("A", "F"), F.upper(x)).otherwise(x))
        )
        return F.when(m == F.lower(m), p).otherwise(F.array_join(letters, ""))

    return F.when(m.startswith("AKIA"), access).otherwise(once(permute(F.lower(m), key, "hex", 6), cased))


def _piece(s: Column, hit: Column) -> Column:
    return F.struct(s.alias("s"), hit.alias("hit"))


def _cut(s: Column, pattern: str) -> Column:
    """The pieces of a string, its matches as hits."""
    return once(
        F.regexp_extract_all(s, F.lit(pattern), F.lit(0)),
        lambda found: F.flatten(
            F.transform(
                F.split(s, pattern, -1),
                lambda g, i: F.array(
                    _piece(g, F.lit(False)), _piece(F.coalesce(F.get(found, i), F.lit("")), i < F.size(found))
                ),
            )
        ),
    )


def _picked(run: Column, kind: str) -> Column:
    """The pieces of a run, its values of a kind as hits: the longest first, the left one of equals."""
    start, held, least, most = SIZES[kind]
    valid = {"card": is_card, "iban": lambda c: c.rlike(f"^(?:{PATTERNS['iban']})$") & is_iban(c)}[kind]
    token = "[A-Z0-9]+|[ -]"

    def of_size(s: Column, size: Column) -> Column:
        # At each token: the string of that size that starts here and ends a group, or nothing.
        here = F.concat(F.lit(f"(?:(?=({start}{{"), (size - held).cast("string"), F.lit("})(?![A-Z0-9]))|)(?:" + token + ")"))
        places = F.filter(
            F.transform(
                F.regexp_extract_all(s, here, F.lit(1)),
                lambda c, i: F.struct(
                    i.alias("at"),
                    (i + F.size(F.regexp_extract_all(c, F.lit(token), F.lit(0)))).alias("end"),
                    c.alias("s"),
                    F.when(c != "", valid(c)).otherwise(False).alias("valid"),
                ),
            ),
            lambda x: x["valid"],
        )
        none = F.array().cast("array<struct<after:int,at:int,s:string>>")
        apart = F.aggregate(
            places,
            F.struct(F.lit(0).alias("end"), none.alias("taken")),
            lambda state, x: F.when(
                x["at"] >= state["end"],
                F.struct(
                    x["end"].alias("end"),
                    F.concat(state["taken"], F.array(F.struct(state["end"].alias("after"), x["at"].alias("at"), x["s"].alias("s")))).alias("taken"),
                ),
            ).otherwise(state),
        )

        def pieces(tokens: Column, found: Column) -> Column:
            between = lambda a, b: _piece(F.array_join(F.slice(tokens, a + 1, b - a), ""), F.lit(False))
            taken = F.transform(found["taken"], lambda x: F.array(between(x["after"], x["at"]), _piece(x["s"], F.lit(True))))
            return F.concat(F.flatten(taken), F.array(between(found["end"], F.size(tokens))))

        return once(F.regexp_extract_all(s, F.lit(token), F.lit(0)), lambda t: once(apart, lambda found: pieces(t, found)))

    return F.aggregate(
        F.sequence(F.lit(most), F.lit(least), F.lit(-1)),
        F.array(_piece(run, F.lit(False))),
        lambda state, size: F.flatten(F.transform(state, lambda x: F.when(x["hit"], F.array(x)).otherwise(of_size(x["s"], size)))),
    )


def narrowed(m: Column) -> Column:
    """The pieces of a match. Of a run, only what validates is a hit; what stands beside an IBAN is searched again."""
    beside = lambda x: F.when(x["hit"], F.array(x)).otherwise(_cut(x["s"], IN_RUN))
    parts = F.when(m.rlike(SHAPES["iban"]), F.flatten(F.transform(_picked(m, "iban"), beside))).otherwise(F.array(_piece(m, F.lit(True))))
    return F.flatten(
        F.transform(parts, lambda x: F.when(x["hit"] & x["s"].rlike(SHAPES["card"]), _picked(x["s"], "card")).otherwise(F.array(x)))
    )


def rewritten(m: Column, key: str) -> Column:
    """(kind, value) of a match; kind is null and the value as it was where nothing validates."""
    whole = {k: m.rlike(f"^(?:{p})$") for k, p in PATTERNS.items()}
    cases = {
        "email": (whole["email"], email(m, key)),
        "iban": (whole["iban"] & is_iban(m), iban(m, key)),
        "ipv4": (whole["ipv4"] & is_ipv4(m), ipv4(m, key)),
        "date": (whole["date"] & is_date(m), date(m, key)),
        "ssn": (whole["ssn"] & _is_ssn_digits(_digits(m)), refill(m, walk(_digits(m), key, "ssn", _is_ssn_digits))),
        "phone": (whole["phone"], phone(m, key)),
        "international": (whole["international"] & F.length(_digits(m)).between(8, 15), international(m, key)),
        "card": (whole["card"] & is_card(m), card(m, key)),
        "key": (whole["key"], secret(m, key)),
    }
    out = None
    for kind, (test, value) in cases.items():
        result = F.struct(F.lit(kind).alias("kind"), value.alias("value"))
        out = F.when(test, result) if out is None else out.when(test, result)
    return out.otherwise(F.struct(F.lit(None).cast("string").alias("kind"), m.alias("value")))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, text with pseudonyms, n_found, kinds (sorted, each once).

    Null stays null with nothing found; an empty text stays empty. Equal values get equal pseudonyms
    under one key, in any document. A match that does not validate stays as it is. Other columns are
    ignored; an empty table gives no rows.
    """
    text = F.col("_text")
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    same = lambda x: F.struct(F.lit(None).cast("string").alias("kind"), x["s"].alias("value"))
    found = base.withColumn(
        "_new",
        F.transform(
            F.regexp_extract_all(text, F.lit(ANY), F.lit(0)),
            lambda m: F.transform(narrowed(m), lambda x: F.when(x["hit"], rewritten(x["s"], key)).otherwise(same(x))),
        ),
    )
    gaps = F.split(text, ANY, -1)
    joined = F.array_join(
        F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.array_join(F.get(F.col("_new"), i)["value"], ""), F.lit("")))), ""
    )
    kinds = F.array_compact(F.flatten("_new")["kind"])
    return found.select(
        F.col("_id").alias(id_col),
        F.when(F.size("_new") > 0, joined).otherwise(text).alias("text"),
        F.coalesce(F.size(kinds), F.lit(0)).cast("long").alias("n_found"),
        F.array_sort(F.array_distinct(F.coalesce(kinds, F.array().cast("array<string>")))).alias("kinds"),
    )
