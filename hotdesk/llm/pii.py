"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Base kinds (email, ip, card, phone) are always reported when their own check passes. Added
kinds are reported when a checksum confirms them (iban) or their score, after context, reaches
``MIN_SCORE``, and they touch no base span. DataFrame functions only; a row is scanned on its own, nothing is shuffled.

Defined results: NULL text counts as empty; no hits give empty arrays; repeated rows are
scanned each on its own; a text of any length is scanned whole, in time that grows with its
length and hits (and the sorting of those). Accounts are proposed in capitals only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from hotdesk.llm.spans import Kind, joined, labelled, merged, with_apart, with_hits, without_inner

# Score of a proposal before and after context, and what is reported.
MIN_SCORE = 0.6
CONTEXT = 48
BOOST = 0.3
PENALTY = 0.3

_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"


#: Words beside numbers of other things; "in order to" is none.
_NUMBERED = (
    r"(?<!\p{L})(?:(?!(?<=\bin\x20)order\x20(?:to|that)\b)orders?|parts?|serials?|refs?|references?|invoices?)(?!\p{L})"
)


#: Signs of an account by country, from the public IBAN registry.
ACCOUNT_LENGTHS = """
AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24
FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21
LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22
RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20
"""
_LENGTHS = ", ".join(f"'{entry[:2]}', {entry[2:]}" for entry in ACCOUNT_LENGTHS.split())


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""

    def weighted(i: Column) -> Column:
        digit = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        doubled = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(doubled - F.when(doubled > 9, 9).otherwise(0))

    numbers = F.transform(F.sequence(F.lit(1), F.length(digits)), weighted)
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number with its country and check digits leaves 1 modulo 97."""
    moved = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        sign = F.substring(moved, i, F.lit(1))
        letter = F.ascii(sign) - 55
        return F.when(sign.rlike("[0-9]"), (rest * 10 + F.ascii(sign) - 48) % 97).otherwise((rest * 100 + letter) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(account)), F.lit(0), step) == 1


def _small_parts(span: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(span["value"], r"\."), small)


def _card(span: Column) -> Column:
    digits = _digits(span["value"])
    return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)


def _account(span: Column) -> Column:
    """The signs of the account that begins with the span, passes modulo 97 and is as long as its country's are, or NULL.

    An account ends where one of its groups does, so what is written behind it is no part of it.
    """
    signs = F.element_at(F.expr(f"map({_LENGTHS})"), F.left(span["value"], F.lit(2)))
    near = F.concat(span["value"], span["right"])
    groups = F.split(F.regexp_extract(near, r"^(?:\x20?[A-Z0-9]++(?![A-Za-z0-9]))++", 0), " ")

    def length(count: Column) -> Column:
        own = F.slice(groups, F.lit(1), count)
        bare = F.array_join(own, "")
        return F.when(F.length(bare) == signs, F.when(mod97(bare), F.length(F.array_join(own, " "))))

    return F.array_max(F.transform(F.sequence(F.lit(1), F.size(groups)), length))


def _accounts(hits: Column) -> Column:
    """The hits that begin an account, each with the account's end."""
    whole = F.transform(hits, lambda s: F.struct(s["start"].alias("start"), (s["start"] + _account(s)).alias("end")))
    return F.filter(whole, lambda s: s["end"].isNotNull())


BASE = (
    Kind(
        "email",
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++(?:\.[{_HOST}]++)++",
        hint=lambda t: t.contains("@"),
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        _small_parts,
        lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _card, lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}")),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda s: F.length(_digits(s["value"])).between(10, 15),
        lambda t: t.contains("+"),
    ),
)

#: The first signs of an account; ``_accounts`` finds its end. Modulo 97 confirms it, whatever
#: the words nearby: its score of 0.8 is enough.
IBAN = Kind(
    "iban",
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})",
    None,
    lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"),
)
#: Characters behind its first signs that hold the longest account, written sign by sign, and one more.
REACH = 2 * 30 + 1
#: Characters of a block from which the texts between replaced spans are cut.
CUT = 512

# Kinds by context: score before it, words that raise it (as parts of words too: German compounds)
# and whole words that lower it.
ADDED = (
    (
        Kind(
            "ssn",
            r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
            None,
            lambda t: t.rlike(r"[0-9]-[0-9]{2}-[0-9]"),
        ),
        0.4,
        r"ssn|social security|tax ?id|taxpayer",
        _NUMBERED,
    ),
    (
        Kind(
            "local_phone",
            r"(?<![0-9+-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
            None,
            lambda t: t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"),
        ),
        0.4,
        r"phone|\btel|call|mobile|cell|fax|contact|telefon|teléfono",
        _NUMBERED,
    ),
)

def _sure(score: float, up: str, down: str) -> Callable[[Column], Column]:
    """Whether the score, moved by the words near a span, reaches the least one.

    A word raises all spans within ``CONTEXT`` characters, as a list of numbers has one word
    before it; it lowers those that it stands next to.
    """

    def sure(s: Column) -> Column:
        near, next_to = F.concat_ws(" ", s["left"], s["right"]), F.concat_ws(" ", s["before"], s["after"])
        raised = F.when(near.rlike(f"(?i){up}"), BOOST).otherwise(0.0)
        lowered = F.when(next_to.rlike(f"(?i){down}"), PENALTY).otherwise(0.0)
        return F.lit(score) + raised - lowered >= MIN_SCORE

    return sure


def _named(name: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == name


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the ``keep`` columns as struct ``doc``, the text, ``base`` and ``added`` spans.

    Spans are struct(start, rank, kind, end); ``added`` also passed the score.
    """
    rows = docs.select(F.struct(*keep).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    for kind in BASE:
        rows = with_hits(rows, "text", kind, f"hits_{kind.name}")
    base = F.concat(*(labelled(F.col(f"hits_{k.name}"), k.name, i) for i, k in enumerate(BASE)))
    rows = rows.withColumn("base", base).drop(*(f"hits_{k.name}" for k in BASE))
    rows = with_hits(rows, "text", IBAN, "hits_iban", REACH)
    for kind, *_ in ADDED:
        rows = with_hits(rows, "text", kind, f"hits_{kind.name}", CONTEXT)
    rows = rows.withColumn("accounts", _accounts(F.col("hits_iban")))
    # One that begins inside an earlier account goes.
    likely = [labelled(without_inner(F.col("accounts")), IBAN.name, len(BASE))]
    likely += [
        labelled(F.filter(f"hits_{kind.name}", _sure(score, up, down)), kind.name, len(BASE) + i)
        for i, (kind, score, up, down) in enumerate(ADDED, 1)
    ]
    rows = rows.withColumn("likely", F.concat(*likely))
    rows = rows.drop("hits_iban", "accounts", *(f"hits_{k.name}" for k, *_ in ADDED))
    return with_apart(rows, "likely", "base", "added").drop("likely")


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds and all spans as text, one row per document."""
    rows = scan(docs)
    counts = [
        F.size(F.filter("base", _named(kind.name))).cast("long").alias(f"n_{kind.name}") for kind in BASE
    ]
    return rows.select(
        "doc.doc_id",
        *counts,
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"),
    )


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in brackets, e.g. ``[EMAIL]``.

    Overlapping spans become one replacement, named by the first. All columns stay;
    ``length``, where the table has it, is counted anew for changed texts.
    """
    rows = scan(docs, text, tuple(docs.columns))
    rows = rows.withColumn("spans", F.concat("base", "added"))
    rows = rows.withColumn("runs", F.when(F.size("spans") > 0, merged("spans")))
    # What lies between the runs is cut from blocks of the text, so no cut walks all of it.
    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    rows = rows.withColumn("blocks", F.when(F.col("runs").isNotNull(), blocks))

    def cut(begin: Column, end: Column) -> Column:
        first = F.floor(begin / CUT).cast("int")
        own = F.slice(F.col("blocks"), first + 1, F.floor(end / CUT).cast("int") - first + 1)
        return F.substring(F.array_join(own, ""), begin - first * CUT + 1, end - begin)

    def part(run: Column, i: Column) -> Column:
        begin = F.when(i > 0, F.get(F.col("runs"), i - 1)["end"]).otherwise(0)
        return F.concat(cut(begin, run["start"]), F.lit("["), F.upper(run["kind"]), F.lit("]"))

    last = F.get(F.col("runs"), F.size("runs") - 1)["end"]
    tail = F.substring("text", last + 1, F.length("text"))
    clean = F.concat(F.array_join(F.transform("runs", part), ""), tail)
    rows = rows.select("doc", F.when(F.size("blocks") > 0, clean).alias("clean"))
    out = []
    for name in docs.columns:
        old = F.col("doc").getField(name)
        if name == text:
            old = F.coalesce("clean", old)
        elif name == length:
            old = F.coalesce(F.length("clean").cast(docs.schema[name].dataType), old)
        out.append(old.alias(name))
    return rows.select(*out)
