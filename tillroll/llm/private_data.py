"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Each kind has a pattern, a check of its matches and a score. Four kinds are fixed rules whose
matches are reported whenever their check holds (e-mail, IP address, payment card, phone number
with a country code). Four more are weaker patterns, reported when their check holds and the
score, after the words around them were read, reaches ``MIN_SCORE``: IBAN (mod 97), groups of
four digits inside a longer run of digits (Luhn), phone numbers without a country code and
social security numbers. Words of the kind within ``BEFORE`` code points before or ``AFTER``
after a match raise its score, words that name something else lower it; the context ends at the
next match of the same kind. A weak match that overlaps a fixed one, or one listed before it,
is not reported. Built-in column functions only.

Defined results: a null text is the empty text and has no span; texts of any length are read
whole (the patterns never look back over what they consumed, so that long runs cost linear
time); repeated rows give repeated results; an empty table gives no rows. Only the id and text
columns are used, so other columns, of any name, don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import let, text_of

BEFORE, AFTER = 40, 20
MIN_SCORE = 0.6
RAISE, LOWER = 0.3, 0.4

# What the words around a match say, in English, German, French and Spanish.
MONEY = "card|visa|mastercard|amex|credit|debit|payment|karte|kreditkarte|zahlung|carte|paiement|tarjeta|pago"
BANK = "iban|bank|account|konto|überweisung|compte|virement|cuenta|transferencia"
CALL = "phone|tel|telephone|call|mobile|cell|fax|whatsapp|telefon|anruf|handy|rufnummer|téléphone|appelez|portable|teléfono|móvil|llame"
MAIL = "mail|email|e-mail|contact|write|kontakt|courriel|contacto|correo"
NETWORK = "ip|address|host|server|login|client|adresse|serveur|dirección|servidor"
SOCIAL = "ssn|social|security|tax|sozialversicherung|steuer|sécurité|sociale|seguridad|seguro"
OTHER = "version|release|isbn|order|invoice|part|section|bestellung|rechnung|commande|facture|pedido|factura"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    return F.call_function("luhn_check", digits(value))


def mod97(value: Column) -> Column:
    """Whether an IBAN's check digits are right: its letters are numbers from 10 on, the first
    four characters go last, and what stands there is 1 modulo 97."""
    bare = F.upper(F.replace(value, F.lit(" "), F.lit("")))
    turned = F.split(F.concat(F.substr(bare, F.lit(5)), F.left(bare, F.lit(4))), "")

    def step(rest: Column, c: Column) -> Column:
        n = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return (rest * F.when(n > 9, 100).otherwise(10) + n) % 97

    return F.aggregate(turned, F.lit(0), step) == 1


def octets(value: Column) -> Column:
    """All parts of a dotted number are at most 255, whatever their leading zeros."""
    return ~F.regexp_like(value, F.lit(r"(?<![0-9])0*(?:[1-9][0-9]{3}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])"))


def n_digits(least: int, most: int):
    return lambda v: F.length(digits(v)).between(least, most)


@dataclass(frozen=True)
class Kind:
    """``pattern``: Java's regular expressions; ``needs``: a string that every match holds."""

    name: str
    pattern: str
    check: object
    score: float
    words: str
    needs: str = ""


# The fixed kinds. Matches are those of the contract's patterns: quantifiers are possessive and
# starts are bound where that can't change the leftmost match, so no text takes quadratic time.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda v: F.lit(True), 0.9, MAIL, "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", octets, 0.6, NETWORK, "."),
    # a whole run of digits, single blanks or hyphens between them, of 16 to 19 digits
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,18}+(?![\x20-]?[0-9])", luhn, 0.8, MONEY),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", n_digits(8, 15), 0.7, CALL, "+"),
)
WEAK = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]){11,30}+(?![A-Za-z0-9])", mod97, 0.7, BANK),
    Kind("card_groups", r"(?<![0-9])(?:4[0-9]|5[1-5]|2[2-7]|3[0-9]|6[0-9])[0-9]{2}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
         luhn, 0.6, MONEY),
    Kind("local_phone", r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
         lambda v: F.lit(True), 0.4, CALL),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
         lambda v: F.lit(True), 0.5, SOCIAL, "-"),
)
KINDS = BASE + WEAK
RUN = 64


def running(lengths: Column) -> Column:
    """0 and the running sums of an array. Sums of ``RUN`` numbers are put together at a time,
    so a long array is copied seldom."""

    def add(out: Column, i: Column) -> Column:
        grown = F.aggregate(
            F.slice(lengths, i, F.lit(RUN)),
            F.slice(out, -1, 1),
            lambda part, n: F.concat(part, F.array(F.element_at(part, -1) + n)),
        )
        return F.concat(out, F.slice(grown, 2, RUN))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(RUN)), F.array(F.lit(0)), add)


def matches(text: Column, k: Kind) -> Column:
    """What stands between the matches of a kind, and the matches."""
    return F.struct(
        F.split(text, k.pattern, -1).alias("rest"), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)).alias("hits")
    )


def there(text: Column, k: Kind) -> Column:
    match = F.regexp_like(text, F.lit(k.pattern))
    return F.contains(text, F.lit(k.needs)) & match if k.needs else match


def scored(k: Kind, before: Column, after: Column) -> Column:
    """The score of a match between two texts, from 0 to 1."""
    around = F.concat_ws("\n", F.right(before, F.lit(BEFORE)), F.left(after, F.lit(AFTER)))
    says = lambda words: F.regexp_like(around, F.lit(rf"(?iu)(?<!\p{{L}})(?:{words})(?!\p{{L}})"))
    score = F.lit(k.score) + F.when(says(k.words), RAISE).otherwise(0.0) - F.when(says(OTHER), LOWER).otherwise(0.0)
    return F.least(F.greatest(F.round(score, 2), F.lit(0.0)), F.lit(1.0))


def proposals(text: Column, kind: int) -> Column:
    """Leftmost non-overlapping matches of one kind that pass its check, with their score."""
    k = KINDS[kind]

    def found(m: Column) -> Column:
        n = F.size(m["hits"])
        # the texts between matches and the matches alternate: their lengths give the positions
        lengths = F.zip_with(F.slice(m["rest"], F.lit(1), n), m["hits"], lambda r, h: F.length(r) + F.length(h))
        parts = F.arrays_zip(
            F.slice(m["rest"], F.lit(1), n).alias("before"),
            m["hits"].alias("value"),
            let(lengths, lambda x: F.slice(running(x), F.lit(2), F.size(x))).alias("end"),
            F.slice(m["rest"], F.lit(2), n).alias("after"),
        )
        return F.transform(
            F.filter(parts, lambda p: k.check(p["value"])),
            lambda p: F.struct(
                F.lit(kind).alias("kind"),
                (p["end"] - F.length(p["value"])).alias("start"),
                p["end"].alias("end"),
                p["value"].alias("value"),
                scored(k, p["before"], p["after"]).alias("score"),
            ),
        )

    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string,score:double>>")
    return F.when(there(text, k), let(matches(text, k), found)).otherwise(none)


def apart(spans: Column, taken: Column) -> Column:
    return F.filter(spans, lambda s: ~F.exists(taken, lambda t: (t["start"] < s["end"]) & (t["end"] > s["start"])))


def detect(docs: DataFrame, min_score: float = MIN_SCORE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``found``: the spans of the fixed kinds, and all spans, ordered
    by kind and start; each with kind, start, end, value and score."""
    n = len(BASE)
    columns = [F.col("doc_id"), F.array_sort(F.concat(*[proposals(F.col("text"), i) for i in range(n)])).alias("base")]
    columns += [proposals(F.col("text"), i).alias(f"w{i}") for i in range(n, len(KINDS))]
    table = docs.select(docs[doc_id].alias("doc_id"), text_of(docs[text]).alias("text")).select(*columns)
    table = table.withColumn("found", F.col("base"))
    for i in range(n, len(KINDS)):
        weak = F.filter(f"w{i}", lambda s: s["score"] >= min_score)
        table = table.withColumn("found", F.when(F.size(f"w{i}") > 0, F.concat("found", apart(weak, F.col("found")))).otherwise(F.col("found")))
    return table.select("doc_id", "base", "found")


def masking(kind: int, min_score: float):
    """A function of a text that replaces what one kind reports by its name."""
    k = KINDS[kind]

    def masked(m: Column) -> Column:
        n = F.size(m["hits"])
        parts = F.arrays_zip(
            F.slice(m["rest"], F.lit(1), n).alias("before"),
            m["hits"].alias("value"),
            F.slice(m["rest"], F.lit(2), n).alias("after"),
        )

        def piece(p: Column) -> Column:
            good = k.check(p["value"])
            if kind >= len(BASE):
                good = good & (scored(k, p["before"], p["after"]) >= min_score)
            return F.concat(p["before"], F.when(good, F.lit(f"<{k.name}>")).otherwise(p["value"]))

        return F.array_join(F.concat(F.transform(parts, piece), F.slice(m["rest"], -1, 1)), "")

    return lambda t: F.when(there(t, k), let(matches(t, k), masked)).otherwise(t)


def redact(docs: DataFrame, min_score: float = MIN_SCORE, text: str = "text") -> DataFrame:
    """``docs`` with every span that is found replaced by its kind in angle brackets. The kinds
    are replaced in their listed order, each in what the ones before it left. All columns stay;
    a null text stays null."""
    out = text_of(docs[text])
    for kind in range(len(KINDS)):
        out = let(out, masking(kind, min_score))
    return docs.select(*[F.when(docs[text].isNotNull(), out).alias(c) if c == text else docs[c] for c in docs.columns])


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """The digest columns: counts of the fixed kinds, the hash of their spans, all spans as
    text; besides, the number of spans that the weak kinds add."""
    found = detect(docs, **options)
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k.name}") for i, k in enumerate(BASE)],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        (F.size("found") - F.size("base")).cast("long").alias("n_added"),
    )
