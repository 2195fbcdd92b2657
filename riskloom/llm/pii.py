"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Only built-in expressions are used. A pattern's matches come from `regexp_extract_all`, their places
from the lengths of what `split` leaves between them, so each text is scanned twice per pattern and
nothing is shuffled. The patterns are rewritten with possessive repeats, which never back off: they
match the same text as the plain ones, in linear time and without recursion on long runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.llm.common import table, text_of

#: What each kind looks like. `\G` and the lookbehind let a match begin only where a
#: run of its first characters begins, or where the match before it ended; a leftmost match never
#: begins elsewhere.
_LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: Kinds that are reported whenever they are confirmed; the others also need the score.
BASE = ("email", "ip", "card", "phone")
#: A text without this can't hold the kind: a cheap test in front of the scans.
NEEDS = {"email": "@", "phone": "+"}
#: Score of a confirmed span, what a nearby word adds, and what kinds outside BASE must reach.
SCORES = {"email": 0.7, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.8, "ssn": 0.3}
NEARBY, ENOUGH, REACH = 0.25, 0.5, 48
WORDS = {
    "email": "mail|contact|write|address", "ip": "ip|host|server|address|login",
    "card": "card|visa|master|credit|debit|pay", "phone": "phone|tel|call|mobile|fax|contact",
    "iban": "iban|account|bank|transfer|konto|compte|cuenta", "ssn": "ssn|social|security|insurance",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_BLOCK = 512


def _sums(values: Column, start: Column) -> Column:
    """Running sums of a short array."""
    grown = F.aggregate(
        values,
        F.struct(start.alias("sum"), F.array().cast("array<int>").alias("all")),
        lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["all"], F.array(a["sum"] + x)).alias("all")),
    )
    return grown["all"]


def running(values: Column) -> Column:
    """Running sums of an int array, block by block, so that work stays far below the square. Pass a
    column, not an expression: it is read once for each block."""
    zero = F.lit(0)
    total = lambda part: F.aggregate(part, zero, lambda a, x: a + x)
    blocks = F.transform(
        F.sequence(zero, F.floor((F.size(values) - 1) / _BLOCK).cast("int")), lambda k: F.slice(values, k * _BLOCK + 1, F.lit(_BLOCK))
    )
    before = F.concat(F.array(zero), _sums(F.transform(blocks, total), zero))
    sums = F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), before.alias("s")), lambda z: _sums(F.coalesce(z["b"], F.array().cast("array<int>")), z["s"])))
    return F.when(F.size(values) > 0, sums).otherwise(F.array().cast("array<int>"))


def luhn(digits: Column) -> Column:
    """Whether up to 20 digits pass the Luhn check: every second digit from the right is doubled."""
    padded = F.lpad(digits, 20, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    return reduce(lambda a, b: a + b, (F.substring(padded if i % 2 == 0 else doubled, i, 1).cast("int") for i in range(1, 21))) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code, first four characters last and letters as 10 to 35, leaves 1."""
    turned = F.split(F.concat(F.substring(code, 5, 40), F.substring(code, 1, 4)), "")

    def step(rest: Column, c: Column) -> Column:
        value = F.ascii(c)
        return F.when(value >= 65, (rest * 100 + value - 55) % 97).otherwise((rest * 10 + value - 48) % 97)

    return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    """Checks of a proposed span."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.length(digits)
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(count.between(13, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return count.between(9, 15)
    if kind == "iban":
        code = F.replace(match, F.lit(" "), F.lit(""))
        return F.length(code).between(15, 34) & mod97(code)
    return F.lit(True)


def find(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Columns `keys` and spans array<struct<kind, start, end, score>>.

    Offsets count code points, the end is exclusive. Spans are ordered by kind as in PATTERNS, then
    by start; spans of one kind don't overlap. A proposed match that fails its check is dropped and
    not tried again at other lengths. Null and empty texts have no spans. Rows stay in number,
    repeated rows and null keys included; other columns are ignored.
    """
    rows = docs.select(*[F.col(k) for k in keys], text_of(text).alias("__text"))
    body, none = F.col("__text"), F.array().cast("array<string>")
    scans = []
    for kind, pattern in PATTERNS.items():
        may = F.contains(body, F.lit(NEEDS[kind])) if kind in NEEDS else body.rlike("[0-9]")
        scans.append(F.when(may, F.split(body, pattern, -1)).otherwise(none).alias(f"__gap_{kind}"))
        scans.append(F.when(may, F.regexp_extract_all(body, F.lit(pattern), F.lit(0))).otherwise(none).alias(f"__hit_{kind}"))
    found = rows.select(*keys, *scans)
    found = found.select("*", *[_steps(kind).alias(f"__step_{kind}") for kind in PATTERNS])
    return found.select(*keys, F.flatten(F.array(*[_spans(kind) for kind in PATTERNS])).alias("spans"))


def _steps(kind: str) -> Column:
    """Characters from the start of each match (or of the text) to the start of the next."""
    gaps, hits = F.col(f"__gap_{kind}"), F.col(f"__hit_{kind}")
    count = F.size(hits)
    return F.zip_with(
        F.slice(F.transform(gaps, F.length), F.lit(1), count),
        F.slice(F.concat(F.array(F.lit(0)), F.transform(hits, F.length)), F.lit(1), count),
        lambda gap, hit: gap + hit,
    )


def _spans(kind: str) -> Column:
    """Confirmed spans of one kind from its matches and the texts between them."""
    gaps, hits = F.col(f"__gap_{kind}"), F.col(f"__hit_{kind}")
    count = F.size(hits)
    around = F.zip_with(
        F.slice(gaps, F.lit(1), count), F.slice(gaps, F.lit(2), count),
        lambda a, b: F.lower(F.concat(F.right(a, F.lit(REACH)), F.lit(" "), F.left(b, F.lit(REACH)))),
    )
    proposed = F.arrays_zip(running(F.col(f"__step_{kind}")).alias("start"), hits.alias("hit"), around.alias("around"))
    good = F.filter(proposed, lambda z: confirmed(kind, z["hit"]))
    scored = F.transform(
        good,
        lambda z: F.struct(
            F.lit(kind).alias("kind"), z["start"].alias("start"), (z["start"] + F.length(z["hit"])).alias("end"),
            (F.lit(SCORES[kind]) + F.when(z["around"].rlike(WORDS[kind]), F.lit(NEARBY)).otherwise(F.lit(0.0))).alias("score"),
        ),
    )
    kept = scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= ENOUGH)
    return F.when(count > 0, kept).otherwise(F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""
    spans = F.col("spans")
    of_kind = lambda kind: F.filter(spans, lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return find(docs, ["doc_id"]).select(
        "doc_id", *counts,
        F.sha2(_listed(F.filter(spans, lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
