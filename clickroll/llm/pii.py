"""Personal data: regular expressions propose spans, checksums confirm, context scores.

Proposals by kind:
- email, ip (parts at most 255), card (16 to 19 digits, Luhn), phone (8 to 15 digits after
  a plus): leftmost non-overlapping matches; one that fails its check is dropped for good.
- added by the method: iban (mod-97), short_card (13 to 15 digits, Luhn), ssn
  (ddd-dd-dddd outside the ranges never issued). An iban or short card may be followed by
  a blank and more capitals or digits: the check tries the ends at such places, first the
  one that the country or issuer asks for, then the longest.
Each confirmed span gets a score: a prior of its kind, raised by words of its kind within 48
characters, lowered by words of numbers that are not personal. Spans of the first four
kinds always stay; added ones stay from ``threshold`` on.

All of it is SQL functions. Positions are code points, ends exclusive. Edge cases: missing
or empty text: no spans. Very long texts are scanned once or twice a kind. Repeated rows
give equal results. Empty input: empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .common import let, pack, text_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "short_card", "ssn")
THRESHOLD = 0.5
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "short_card": r"[0-9](?:[\x20-]?[0-9]){12,14}(?![0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
}
#: what must not stand before, the pattern of a proposal's first characters and their number
HEADS = {"iban": (r"(?<![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", 4), "short_card": (r"(?<![0-9.-])(?<![0-9]\x20)", "[0-9]", 1)}
#: countries with the lengths of their ibans
IBANS = ("AD24AE23AL28AT20AZ28BA20BE16BG22BH22BI27BR29BY28CH21CR22CY28CZ24DE22DJ27DK18DO28EE20EG29ES24FI18FK18FO18FR27GB22"
         "GE22GI23GL18GR27GT28HN28HR21HU28IE22IL23IQ23IS26IT27JO30KW30KZ20LB28LC32LI21LT20LU20LV21LY25MC27MD24ME22MK19MN20"
         "MR27MT31MU30NI28NL18NO15OM23PK24PL28PS29PT25QA29RO24RS22RU33SA24SC31SD18SE24SI19SK24SM27SO23ST25SV28TL23TN24TR26"
         "UA29VA22VG24XK20YE30")
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "short_card": 0.4, "ssn": 0.4}
WORDS = {
    "email": "mail|contact|kontakt|correo|courriel", "ip": r"\bip\b|address|host|server|adresse",
    "card": "card|visa|master|credit|karte|tarjeta|carte", "phone": "phone|call|tel|mobile|fax|anruf",
    "iban": "iban|account|bank|konto|cuenta|compte", "short_card": "card|visa|amex|express|credit|karte|tarjeta|carte",
    "ssn": "ssn|social|security|tax",
}
AGAINST = r"version|build|isbn|order|serial|sample|example|part\s?no|section"


def luhn(number: Column) -> Column:
    """Luhn check of a string of digits."""
    places = F.sequence(F.lit(1), F.length(number))

    def value(i: Column) -> Column:
        d = F.substring(F.reverse(number), i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 1, d).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(places, F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0


def mod97(iban: Column) -> Column:
    """Mod-97 check: the first four characters go last, letters count 10 to 35."""
    plain = F.replace(iban, F.lit(" "))
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def value(acc: Column, c: Column) -> Column:
        v = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return (acc * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), value) == 1


def _card(low: int, high: int):
    return lambda m: let(S.digits(m), lambda d: F.when(F.length(d).between(low, high), luhn(d)).otherwise(F.lit(False)))


def _accept(kind: str):
    return {
        "email": lambda m: F.lit(True), "ssn": lambda m: F.lit(True),
        "ip": lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": _card(16, 19), "phone": lambda m: F.length(S.digits(m)).between(8, 15),
    }[kind]


def _iban_length(proposal: Column) -> Column:
    """Of the iban that begins the text: its country's length if that passes mod-97, else the
    whole run; without a known country the longest that ends at a blank and passes."""
    def chosen(x: Column) -> Column:
        words = F.split(x["run"], " ")
        upto = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, 1, i), " "))

        def good(c: Column) -> Column:
            n = F.length(F.replace(c, F.lit(" ")))
            return (n >= 15) & ((x["country"] == 0) | (F.substring(F.lit(IBANS), x["country"] + 2, F.lit(2)) == n.cast("string"))
                                | (c == x["run"])) & mod97(c)

        return let(F.filter(upto, good), lambda g: F.length(F.get(g, F.when(x["country"] == 0, F.size(g) - 1).otherwise(0))))

    run = F.regexp_extract(proposal, "^" + PATTERNS["iban"], 0)
    return let(F.struct(run.alias("run"), F.instr(F.lit(IBANS), F.left(proposal, F.lit(2))).alias("country")), chosen)


def _short_card_length(proposal: Column) -> Column:
    """Of the short card that begins the text: its issuer's number of digits if that passes
    Luhn, else the most that do. The start of a card of base kind is none."""
    def ends(n: int) -> Column:
        run = F.regexp_extract(proposal, rf"^[0-9](?:[\x20-]?[0-9]){{{n - 1}}}(?![0-9])", 0)
        return F.when(_card(n, n)(run), F.length(run))

    usual = F.when(proposal.rlike(r"^3[\x20-]?[0689]"), ends(14)).when(F.startswith(proposal, F.lit("4")), ends(13))
    long = _card(16, 19)(F.regexp_extract(proposal, "^" + PATTERNS["card"], 0))
    return F.when(~long, F.coalesce(usual, ends(15), ends(14), ends(13)))


LENGTH = {"iban": _iban_length, "short_card": _short_card_length}


def _score(kind: str):
    def score(match: Column, before: Column, after: Column) -> Column:
        near = F.lower(F.concat_ws(" ", before, after))
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(PRIOR[kind]) + F.when(near.rlike(WORDS[kind]), 0.2).otherwise(0.0)
                                              - F.when(near.rlike(AGAINST), 0.2).otherwise(0.0)))
    return score


def found(text: Column, threshold: float = THRESHOLD) -> Column:
    """All spans that stay, by kind as listed, then start."""
    may = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+")),
           "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"),
           "iban": text.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]"), "short_card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
           "ssn": text.rlike(r"[0-9]-[0-9]{2}-[0-9]")}

    def spans(kind: str) -> Column:
        if kind not in HEADS:
            return S.spans(text, PATTERNS[kind], kind, _accept(kind), _score(kind), may[kind])
        before, head, n = HEADS[kind]
        return S.headed(text, rf"{before}(?=({PATTERNS[kind]}[\s\S]{{0,48}})){head}", n, kind, LENGTH[kind], _score(kind), may[kind])

    each = [spans(k) for k in BASE]
    each += [F.filter(spans(k), lambda s: s["score"] >= threshold) for k in KINDS[len(BASE):]]
    return F.when(text.rlike(r"[@0-9]"), F.concat(*each)).otherwise(S.none())


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, found) of every row: its spans with kind, start, end and score."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).select(
        "doc_id", found(F.col("text"), threshold).alias("found"))


def redact(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows with every span that stays replaced by its kind; a missing text stays so."""
    cols = [c for c in docs.columns]
    rows = pack(docs)
    text = F.col("row").getField(text_col)
    clean = let(found(text, threshold), lambda s: S.masked(text, s))
    return rows.select(*[(F.when(text.isNull(), text).otherwise(clean) if c == text_col else F.col("row").getField(c)).alias(c)
                         for c in cols])
