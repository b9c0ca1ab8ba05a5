"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

All of it is DataFrame expressions. The matches of a pattern and the pieces
between them give the position of every match, in code points with exclusive
ends. Base kinds, leftmost and non-overlapping per kind:

  email   a local part, @ and a domain with a dot
  ip      four numbers of at most 255
  card    13 to 19 digits that pass Luhn's check
  phone   + and 9 to 15 digits

Added kinds: iban, a country code, two digits and 11 to 30 letters or digits,
also in groups of four, with remainder 1 modulo 97; ssn, three, two and four
digits with a context word close by. The patterns are written so that a match
attempt starts only where a run of the pattern's characters starts and never
backs up over a run, which keeps them linear on long texts and gives the
matches of the plain patterns.

A score in percent starts at a value of the kind and rises by 10 if a context
word of the kind is within 40 code points before the span.

A null or empty text has no spans. Repeated rows are searched each for itself.
An empty table gives no rows. Columns with the names of the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import unused_names

NEAR = 40
ALNUM = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: pattern, what confirms a match, score in percent, context words."""

    name: str
    pattern: str
    confirmed: object
    percent: int
    context: str
    needs_context: bool = False
    base: bool = True


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Luhn's check over the digits of a match."""
    digits = F.reverse(digits_of(match))
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    value = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda sum_, i: sum_ + F.when(i % 2 == 0, doubled(value(i))).otherwise(value(i)),
    )
    return total % 10 == 0


def mod97(match: Column) -> Column:
    """Remainder 1 of the number that an IBAN spells, first four characters last and letters as 10 to 35."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    value = lambda c: F.instr(F.lit(ALNUM), c) - 1
    rest = F.aggregate(
        F.filter(F.split(moved, ""), lambda c: c != ""),
        F.lit(0),
        lambda r, c: (r * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97,
    )
    return rest == 1


def n_digits(least: int, most: int):
    return lambda match: F.length(digits_of(match)).between(least, most)


def always(match: Column) -> Column:
    return F.lit(True)


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        always,
        80,
        "e-?mail|mail|contact|write|address|kontakt|correo|courriel",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda match: match.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"),
        60,
        r"\bip\b|host|server|address|client|remote",
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
        luhn,
        80,
        "card|visa|credit|debit|payment|karte|tarjeta|carte",
    ),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", n_digits(9, 15), 70, "phone|tel|call|mobile|fax|cell|telefon"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![A-Za-z0-9])",
        mod97,
        90,
        "iban|account|bank|konto|cuenta|compte",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        always,
        50,
        r"\bssn\b|social security|tax id",
        needs_context=True,
        base=False,
    ),
)
SPAN = "array<struct<kind:string,start:int,end:int,percent:int>>"


def placed(matches: Column, pieces: Column) -> Column:
    """(start, end, match) of each match, from the matches and the pieces of text around them."""
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    steps = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(matches)).alias("piece"), matches.alias("match"))
    walked = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), empty.alias("found")),
        lambda state, step: F.struct(
            (state["at"] + F.length(step["piece"]) + F.length(step["match"])).alias("at"),
            F.concat(
                state["found"],
                F.array(
                    F.struct(
                        (state["at"] + F.length(step["piece"])).alias("start"),
                        (state["at"] + F.length(step["piece"]) + F.length(step["match"])).alias("end"),
                        step["match"].alias("value"),
                    )
                ),
            ).alias("found"),
        ),
    )
    return F.when(F.size(matches) == 0, empty).otherwise(walked["found"])


def spans_of(kind: Kind, text: Column, found: Column) -> Column:
    """The confirmed spans of a kind with their scores."""
    before = lambda s: F.lower(
        F.substring(text, F.greatest(s["start"] - NEAR, F.lit(0)) + 1, F.least(s["start"], F.lit(NEAR)))
    )
    raised = lambda s: F.when(before(s).rlike(kind.context), 10).otherwise(0)
    confirmed = F.filter(found, lambda s: kind.confirmed(s["value"]))
    if kind.needs_context:
        confirmed = F.filter(confirmed, lambda s: raised(s) > 0)
    return F.transform(
        confirmed,
        lambda s: F.struct(
            F.lit(kind.name).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            (F.lit(kind.percent) + raised(s)).alias("percent"),
        ),
    ).cast(SPAN)


def find_pii(df: DataFrame, text_col: str = "text", out: str = "pii_spans") -> DataFrame:
    """df with an array of (kind, start, end, percent), by kind as listed, then start."""
    own = [n for n in df.columns if n.lower() != out.lower() or n == text_col]
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = unused_names(df, *[f"{what}_{k.name}" for what in ("m", "p", "f") for k in KINDS])
    match, piece, place = (names[at : at + len(KINDS)] for at in range(0, len(names), len(KINDS)))
    matches = [F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)).alias(m) for k, m in zip(KINDS, match)]
    step = df.select(*own, *matches)
    pieces = [F.when(F.size(m) > 0, F.split(text, k.pattern, -1)).alias(p) for k, m, p in zip(KINDS, match, piece)]
    step = step.select(*own, *match, *pieces)
    found = [placed(F.col(m), F.col(p)).alias(f) for m, p, f in zip(match, piece, place)]
    step = step.select(*own, *found)
    spans = [spans_of(k, text, F.col(f)) for k, f in zip(KINDS, place)]
    return step.select(*own, F.concat(*spans).alias(out))


def digest(df: DataFrame, id_col: str = "doc_id", spans_col: str = "pii_spans") -> DataFrame:
    """The report columns, derived from the spans."""
    spans = F.col(spans_col)
    base = [k.name for k in KINDS if k.base]
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    def count(name: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    return df.select(
        F.col(id_col).alias("doc_id"),
        *[count(name) for name in base],
        F.sha2(F.array_join(F.transform(F.filter(spans, lambda s: s["kind"].isin(base)), line), ","), 256).alias(
            "base_sha256"
        ),
        F.array_join(F.transform(spans, line), ",").alias("spans"),
        F.array_join(F.transform(spans, lambda s: s["percent"].cast("string")), ",").alias("percents"),
    )


def redacted(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with every span replaced by its kind in brackets; overlapping spans become one, named by the first.

    A null text stays null.
    """
    (spans,) = unused_names(df, "pii")
    marked = find_pii(df, text_col, spans)
    text = F.col(text_col)
    state = "struct<at:int,out:array<string>>"
    order = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    cut = F.aggregate(
        order,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")).cast(state),
        lambda done, s: F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= done["at"],
                F.concat(
                    done["out"],
                    F.array(
                        F.substring(text, done["at"] + 1, s["start"] - done["at"]),
                        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
                    ),
                ),
            )
            .otherwise(done["out"])
            .alias("out"),
        ).cast(state),
        lambda done: F.concat(
            F.array_join(done["out"], ""), F.substring(text, done["at"] + 1, F.length(text))
        ),
    )
    fresh = F.when(F.size(spans) == 0, text).otherwise(cut)
    return marked.select(*[fresh.alias(text_col) if n == text_col else F.col(n) for n in df.columns])
