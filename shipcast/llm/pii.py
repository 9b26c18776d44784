"""Personal data: patterns propose, checksums confirm, nearby words adjust the score.

Every kind has a pattern, whose leftmost non-overlapping matches are proposed;
a validator (value ranges, digit counts, Luhn, mod-97); and a score that words
within ``NEAR`` code points on either side raise or lower.  The four base kinds
keep every match that validates, whatever its score; the further kinds need a
score of ``THRESHOLD``.  Spans are code points, end exclusive.

Everything is SQL expressions over one row: no shuffle, whole texts.  A match's
place comes from the lengths of the pieces between matches, and its context
from those pieces, so a long text is read once per kind.  Patterns are written
possessively and, where a run could be entered late, only at its first place or
where the last match ended; that changes no match and keeps them linear.

Null text is an empty text; rows are judged one by one, so repeated rows get
equal spans, a null ``doc_id`` is kept, and an empty table gives an empty
result.  Internal columns carry the prefix ``_pii``, so other columns pass
unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAR = 40
THRESHOLD = 0.5
RAISE, LOWER = 0.3, 0.2


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def is_ip(match: Column) -> Column:
    def part(p: Column) -> Column:
        value = F.ltrim(p, F.lit("0"))
        return (F.length(value) < 3) | ((F.length(value) == 3) & (value <= "255"))
    return F.forall(F.split(match, r"\."), part)


def is_card(match: Column) -> Column:
    return F.length(digits(match)).between(12, 19) & F.call_function("luhn_check", digits(match))


def is_phone(match: Column) -> Column:
    return F.length(digits(match)).between(9, 15)


def is_iban(match: Column) -> Column:
    """mod-97: first four characters moved to the end, letters as 10 to 35, remainder 1."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""), F.lit(0),
        lambda a, c: F.when(c == "", a).when(c <= "9", (a * 10 + F.ascii(c) - 48) % 97)
        .otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return F.length(plain).between(15, 34) & (rest == 1)


def is_national_id(match: Column) -> Column:
    area = F.substring(match, 1, 3)
    return ~area.isin("000", "666") & (area < "900") & (F.substring(match, 5, 2) != "00") \
        & (F.substring(match, 8, 4) != "0000")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: Necessary for a match, and quick to test on a whole text.
    hint: Callable[[Column], Column]
    valid: Callable[[Column], Column]
    score: float
    base: bool
    raising: str
    lowering: str = "example|sample|test|dummy|beispiel|ejemplo|exemple"


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda t: F.contains(t, F.lit("@")), lambda m: F.lit(True), 0.6, True,
         "mail|contact|write|kontakt|correo|courriel"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda t: t.rlike(r"[0-9]\.[0-9]"), is_ip, 0.5, True,
         r"\bip\b|address|host|server|login|adresse|direcci", r"version|release|section|chapter"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), is_card, 0.7, True,
         "card|visa|master|amex|credit|debit|pay|karte|tarjeta|carte", "order|invoice|serial|tracking"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: F.contains(t, F.lit("+")), is_phone, 0.5, True,
         "phone|tel|call|mobile|fax|whatsapp|telefon|móvil|appel"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}\x20?[A-Z0-9]{4}"), is_iban, 0.8, False,
         "iban|bank|account|konto|cuenta|compte"),
    Kind("local_phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
         lambda t: t.rlike(r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"), lambda m: F.lit(True), 0.3, False,
         "phone|tel|call|mobile|fax|whatsapp|telefon|móvil|appel"),
    Kind("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), is_national_id, 0.3, False,
         "ssn|social|security|national|tax"),
)


def find(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with ``spans``: array of (start, order, kind, end, score, base), in order."""
    out = docs.withColumn("_pii_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = []
    for order, kind in enumerate(kinds):
        match, piece, start, name = (f"_pii_{x}_{kind.name}" for x in ("match", "piece", "start", "span"))
        text, pattern = F.col("_pii_text"), F.lit(kind.pattern)
        hint = kind.hint(text)
        out = out.withColumns({match: F.when(hint, F.regexp_extract_all(text, pattern, 0)),
                               piece: F.when(hint, F.split(text, kind.pattern, -1))})
        # Where each match starts: all pieces up to it, and all matches before it.
        lengths = F.zip_with(piece, match, lambda p, m: F.struct(
            F.length(p).cast("long").alias("p"), F.coalesce(F.length(m), F.lit(0)).cast("long").alias("m")))
        begun = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("starts"))
        starts = F.aggregate(
            lengths, begun,
            lambda a, x: F.struct((a["at"] + x["p"] + x["m"]).alias("at"),
                                  F.concat(a["starts"], F.array(a["at"] + x["p"])).alias("starts")),
            lambda a: a["starts"])
        out = out.withColumn(start, F.when(F.size(match) > 0, starts))

        def span(m: Column, i: Column) -> Column:  # built at once, so the loop variables hold
            at = F.get(start, i)
            near = F.lower(F.concat(F.right(F.get(piece, i), F.lit(NEAR)), F.lit(" "),
                                    F.left(F.get(piece, i + 1), F.lit(NEAR))))
            score = (F.lit(kind.score) + F.when(near.rlike(kind.raising), RAISE).otherwise(0.0)
                     - F.when(near.rlike(kind.lowering), LOWER).otherwise(0.0))
            return F.struct(at.alias("start"), F.lit(order).alias("order"), F.lit(kind.name).alias("kind"),
                            (at + F.length(m)).alias("end"), F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0)).alias("score"),
                            F.lit(kind.base).alias("base"), kind.valid(m).alias("valid"))

        spans = F.filter(F.transform(match, span),
                         lambda s: s["valid"] & (F.lit(kind.base) | (s["score"] >= THRESHOLD)))
        out = out.withColumn(name, F.when(F.size(match) > 0, spans)).drop(match, piece, start)
        found.append(name)
    empty = F.array().cast(out.schema[found[0]].dataType)
    whole = F.array_sort(F.concat(*[F.coalesce(F.col(c), empty) for c in found]))
    return out.withColumn("spans", whole).drop("_pii_text", *found)


def label(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], span["start"].cast("string"), span["end"].cast("string"))
