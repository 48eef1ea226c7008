"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust their score.

Base kinds (email, ip, card, phone) keep every valid match. The method proposes further kinds: account numbers (mod-97),
15-digit cards (Luhn), French (mod-97) and Spanish (mod-23) person numbers, American ones, phones without a country
code and dates. A match's score is its kind's, raised by words of the kind nearby and lowered by words that name other
numbers; proposals that score less than `LEAST_SCORE` are dropped, so a bare date is nothing and one after "born" is
personal. Proposals that overlap a base span are dropped too.

A pattern's matches and the pieces between them come from two native functions; a match starts where the lengths of all
pieces and matches before it add up to. The context of a match is the `NEAR` characters of the text before it and after
it, whatever else matches there; it is put together from the pieces and matches around, of which `AROUND` always suffice.
Kinds made of digits are sought only in texts that hold `FEW_DIGITS` near each other, which one cheap scan tells. Lookarounds and possessive loops keep each scan linear in the text: a match can
only start where a run starts or the last match ended.

Edge cases: a null or empty text has no spans; rows are judged one by one, repeated or not; offsets count code points;
extra columns are passed on (an added column replaces an input column of its name); an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind

#: Characters before and after a match in which context words count.
NEAR = 48
#: Matches on each side of one that always hold so many characters, as each has two at least.
AROUND = NEAR // 2 + 1
#: What every match of digits holds: four of them with at most a mark between.
FEW_DIGITS = r"[0-9](?:[ ./-]?[0-9]){3}"
#: Spans of the method that score less, in hundredths, are dropped; base spans always stay.
LEAST_SCORE = 50
#: What words of the kind add to a score, and words of other numbers take.
LIFT, DROP = 20, 30
OTHER_NUMBERS = "order|invoice|version|isbn|serial|rechnung|factura|facture|article"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes Luhn's check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * (1 + F.pmod(n - i, F.lit(2)))
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.pmod(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add), F.lit(10)) == 0


def mod97(account: Column) -> Column:
    """Whether an account number (capitals and digits) leaves 1 when divided by 97, letters read as 10 to 35."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.left(account, F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.pmod(F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55), F.lit(97))

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


def _small_parts(m: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(m, r"\."), small)


#: Lengths of account numbers by country; fixed values.
ACCOUNT_LENGTHS = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24}


def _account(m: Column) -> Column:
    right = F.lit(False)
    for country, n in ACCOUNT_LENGTHS.items():
        right |= m.startswith(country) & (F.length(m) == n)
    return right & mod97(m)


def _person_fr(m: Column) -> Column:
    """Month 1 to 12, and a key that makes the number and its first 13 digits add up to 97 in remainders."""
    body = F.substring(m, 1, 13).try_cast("long")
    return F.substring(m, 4, 2).try_cast("int").between(1, 12) & (97 - F.pmod(body, F.lit(97)) == F.substring(m, 14, 2).try_cast("int"))


# The check letters of Spanish person numbers, by remainder.
CHECK_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"


def _person_es(m: Column) -> Column:
    rest = F.pmod(F.substring(m, 1, 8).try_cast("long"), F.lit(23)).cast("int")
    return F.right(m, F.lit(1)) == F.substr(F.lit(CHECK_LETTERS), rest + 1, F.lit(1))


def _person_us(m: Column) -> Column:
    area = F.substring(m, 1, 3)
    return ~area.isin("000", "666") & ~area.startswith("9") & (F.substring(m, 5, 2) != "00") & (F.substring(m, 8, 4) != "0000")


def _date(m: Column) -> Column:
    return F.coalesce(m.try_cast("date"), F.try_to_date(F.translate(m, "/", "."), "d.M.yyyy")).isNotNull()


class Kind(NamedTuple):
    name: str
    pattern: str
    valid: Callable[[Column], Column]
    score: int  # of a valid match without context, in hundredths
    context: str  # a pattern for nearby words, matched in lower case
    base: bool = True


_START, _END = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), 80, "mail|contact|kontakt|correo|courriel"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _small_parts, 60, "(^|[^a-z0-9])ip([^a-z0-9]|$)|host|server|addr|adress|client"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", lambda m: F.length(_digits(m)).between(16, 19) & luhn(_digits(m)), 70, "card|visa|karte|carte|tarjeta|credit|payment"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(8, 15), 60, "tel|phone|call|mobil|fax|anruf|llam"),
    Kind("iban", rf"{_START}[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}{_END}", _account, 80, "iban|account|konto|compte|cuenta|bank", False),
    Kind("card15", rf"{_START}3[47][0-9]{{2}}[ -]?[0-9]{{6}}[ -]?[0-9]{{5}}{_END}", lambda m: luhn(_digits(m)), 45, "card|amex|karte|carte|tarjeta|credit|payment", False),
    Kind("person_fr", rf"{_START}[12][0-9]{{14}}{_END}", _person_fr, 55, "nir|insee|secu|social|assur", False),
    Kind("person_es", rf"{_START}[0-9]{{8}}-?[A-Z]{_END}", _person_es, 45, "dni|nif|documento|identidad|identity", False),
    Kind("person_us", rf"{_START}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_END}", _person_us, 40, "ssn|social|security|taxpayer", False),
    Kind("phone_local", rf"{_START}0[0-9]{{1,4}}[ /.-][0-9]{{3,4}}[ .-]?[0-9]{{3,5}}{_END}", lambda m: F.length(_digits(m)).between(9, 12), 35, "tel|phone|call|mobil|fax|anruf|llam", False),
    Kind("birth", rf"{_START}(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}[./][0-9]{{1,2}}[./](?:19|20)[0-9]{{2}}){_END}", _date, 35, "born|birth|geboren|geburt|nacid|nacim|naiss", False),
)
#: A match's place is summed in blocks of this many, so that many matches don't cost their square.
SUM_BLOCK = 64


def _total(lengths: Column, start: Column, n: Column) -> Column:
    return F.aggregate(F.slice(lengths, start, n), F.lit(0), lambda a, x: a + x)


def _matched(text: Column, kind: Kind) -> Column:
    """struct<matches, pieces> of a kind's pattern; of nothing where no match is valid."""
    cut = lambda m: F.struct(m.alias("matches"), F.split(text, kind.pattern, -1).alias("pieces"))
    return bind(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda m: F.when(F.exists(m, kind.valid), cut(m)).otherwise(_nothing()))


def _nothing() -> Column:
    none = F.array().cast("array<string>")
    return F.struct(none.alias("matches"), none.alias("pieces"))


def _placed(matches: Column, pieces: Column) -> Column:
    """array<struct<m, s, near>> of matches: where each starts, from 0, and its context."""

    def around(first: Column, last: Column, pair: Callable[[Column], Column]) -> Column:
        return F.array_join(F.when(first <= last, F.transform(F.sequence(first, F.greatest(first, last)), pair)).otherwise(F.array().cast("array<string>")), "")

    def before(i: Column) -> Column:
        piece = F.get(pieces, i)
        more = around(F.greatest(F.lit(0), i - AROUND), i - 1, lambda j: F.concat(F.get(pieces, j), F.get(matches, j)))
        return F.right(F.when(F.length(piece) >= NEAR, piece).otherwise(F.concat(more, piece)), F.lit(NEAR))

    def after(i: Column) -> Column:
        piece = F.get(pieces, i + 1)
        more = around(i + 1, F.least(i + AROUND, F.size(matches) - 1), lambda j: F.concat(F.get(matches, j), F.get(pieces, j + 1)))
        return F.left(F.when(F.length(piece) >= NEAR, piece).otherwise(F.concat(piece, more)), F.lit(NEAR))

    def starts(n: Column, blocks: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            block = F.floor(i / SUM_BLOCK).cast("int")
            start = _total(blocks, F.lit(1), block) + _total(n, block * SUM_BLOCK + 1, F.pmod(i, F.lit(SUM_BLOCK))) + F.length(F.get(pieces, i))
            return F.struct(m.alias("m"), start.alias("s"), F.lower(F.concat(before(i), F.lit(" "), after(i))).alias("near"))

        return F.transform(matches, one)

    lengths = F.transform(matches, lambda m, i: F.length(m) + F.length(F.get(pieces, i)))
    sums = lambda n: F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / SUM_BLOCK).cast("int")), lambda b: _total(n, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK)))
    return bind(lengths, lambda n: bind(sums(n), lambda blocks: starts(n, blocks)))


def _kept(placed: Column, kind: Kind) -> Column:
    """array<struct<s, e, score>> of a kind's valid matches, of further kinds those that score enough."""
    score = lambda x: kind.score + F.when(x["near"].rlike(kind.context), LIFT).otherwise(0) - F.when(x["near"].rlike(OTHER_NUMBERS), DROP).otherwise(0)
    keep = lambda x: kind.valid(x["m"]) if kind.base else kind.valid(x["m"]) & (score(x) >= LEAST_SCORE)
    return F.transform(F.filter(placed, keep), lambda x: F.struct(x["s"].alias("s"), (x["s"] + F.length(x["m"])).alias("e"), (score(x) / F.lit(100.0)).alias("score")))


def find_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone, base_sha256, spans and scores (as spans, with =score)."""
    clean = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), clean.alias("clean"), clean.rlike(FEW_DIGITS).alias("digits"))
    #: What a text must hold for a kind to be sought.
    needs = {"email": F.col("clean").contains("@"), "phone": F.col("clean").contains("+")}
    pairs = F.array(*[F.when(needs.get(k.name, F.col("digits")), _matched(F.col("clean"), k)).otherwise(_nothing()) for k in KINDS])
    # one expression places the matches of all kinds
    placed = rows.select("doc", F.transform(pairs, lambda p: _placed(p["matches"], p["pieces"])).alias("placed"))
    whole = placed.select("doc", *[_kept(F.get("placed", F.lit(n)), k).alias(k.name) for n, k in enumerate(KINDS)])
    base, more = [k.name for k in KINDS if k.base], [k.name for k in KINDS if not k.base]
    taken = F.concat(*base)
    clear = lambda x: ~F.exists("taken", lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"]))
    found = whole.withColumn("taken", taken).select("doc", *base, *[F.filter(k, clear).alias(k) for k in more])
    written = lambda k, score=False: F.transform(k, lambda x: F.concat(F.lit(f"{k}:"), x["s"], F.lit(":"), x["e"], *([F.lit("="), x["score"].cast("string")] if score else [])))
    joined = lambda kinds, score=False: F.array_join(F.concat(*[written(k, score) for k in kinds]), ",")
    every = [*base, *more]
    added = {f"n_{k}": F.size(k).cast("long") for k in base} | {"base_sha256": F.sha2(joined(base), 256), "spans": joined(every), "scores": joined(every, True)}
    return found.select(*[F.col(f"doc.`{c}`") for c in docs.columns if c not in added], *[x.alias(c) for c, x in added.items()])
