"""CVSS choice, severity, weights, vector parsing and risk flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import fixed

SCORE_TYPE = "decimal(4,1)"  # CVSS base scores have one decimal
WEIGHTED_TYPE = "decimal(7,3)"  # sums of it stay exact and order-independent


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def severity(score: str, missing: str | None = None) -> Column:
    """Severity word of a score column; `missing` is used where there is no score."""
    cuts = " ".join(f"WHEN {score} >= {cut} THEN '{name}'" for name, cut in fixed.SEVERITY_CUTOFFS)
    other = "NULL" if missing is None else f"'{missing}'"
    return F.expr(
        f"CASE {cuts} WHEN {score} IS NOT NULL THEN '{fixed.LOWEST_SEVERITY}' ELSE {other} END"
    )


def weighted_score(score: str, sev: str) -> Column:
    """Score times the weight of its severity as an exact decimal, 0 without severity."""
    cases = " ".join(
        f"WHEN '{name}' THEN CAST({score} AS {SCORE_TYPE}) * {weight}"
        for name, weight in fixed.SEVERITY_WEIGHTS.items()
    )
    return F.expr(f"coalesce(CAST(CASE {sev} {cases} END AS {WEIGHTED_TYPE}), CAST(0 AS {WEIGHTED_TYPE}))")


def choose_cvss(entries: Column | str) -> Column:
    """Entry with the highest base score, the first one on ties.

    No entries gives a struct of '' and nulls, entries without any score give null.
    """
    arr = _col(entries)

    def entry(x: Column) -> Column:
        return F.struct(*[x[n].cast(t).alias(n) for n, t in fixed.CVSS_FIELDS])

    # The fields are named inside the list: named outside, the search would be made again for each of them.
    ranked = F.transform(
        arr, lambda x, i: F.struct(x["baseScore"].alias("score"), (-i).alias("order"), entry(x).alias("entry"))
    )
    blank = F.struct(
        *[
            (F.lit("") if t == "string" else F.lit(None).cast(t)).alias(n)
            for n, t in fixed.CVSS_FIELDS
        ]
    )
    best = F.array_max(F.filter(ranked, lambda r: r["score"].isNotNull()))["entry"]
    return F.when(F.coalesce(F.size(arr), F.lit(0)) <= 0, blank).otherwise(best)


def lookup_fields(chosen: Column | str) -> dict[str, Column]:
    """Scalar lookup columns taken from the chosen entry."""
    c = _col(chosen)
    blank = F.lit("")
    return {
        "cvssScore": c["baseScore"],
        "cvssVersion": c["version"],
        "source": F.coalesce(c["source"], blank),
        "sourceType": F.coalesce(c["type"], blank),
        "vectorString": F.coalesce(c["vectorString"], blank),
        "impactScore": c["impactScore"],
        "exploitabilityScore": c["exploitabilityScore"],
    }


def join_labels(entries: Column | str, id_field: str, text_field: str) -> Column:
    """Array of (id, text) to one line: the text where there is one, else the id."""
    def label(x: Column) -> Column:
        return F.when(F.trim(x[text_field]) != "", x[text_field]).otherwise(x[id_field])

    return F.coalesce(F.array_join(F.transform(_col(entries), label), ", "), F.lit(""))


def vector_metric(vector: Column | str, metric: str, legacy: bool = False) -> Column:
    """Value of one metric of a CVSS vector, '' when it is absent.

    Metrics are matched as whole parts. With `legacy` the name may also be the tail
    of a longer metric name (``C`` then finds ``AC``).
    """
    v = _col(vector)
    if legacy:
        return F.regexp_extract(v, metric + ":([^/]+)", 1)
    parts = F.concat(F.lit("/"), v)
    at = F.instr(parts, f"/{metric}:")
    value = F.substring_index(F.substring(parts, at + len(metric) + 2, F.length(parts)), "/", 1)
    return F.when(at > 0, value).when(at == 0, F.lit(""))


def _has(vector: str, metric: str, value: str, legacy: bool) -> str:
    """Condition text: a metric has a value. Two plain text searches, no pattern matching."""
    if legacy:
        return f"coalesce(regexp_extract({vector}, '{metric}:([^/]+)', 1) = '{value}', false)"
    parts = f"concat('/', {vector}, '/')"
    at = f"instr({parts}, '/{metric}:')"
    return f"coalesce({at} > 0 AND instr({parts}, '/{metric}:{value}/') = {at}, false)"


def parse_vector(
    vector: Column | str, version: Column | str, legacy: bool = False
) -> dict[str, Column]:
    """AV, AC, C, I, A for all versions, PR, UI, S from version 3 on, Au for 2.0."""
    ver = _col(version)
    out = {m: vector_metric(vector, m, legacy) for m in ("AV", "AC", "C", "I", "A")}
    for m in ("PR", "UI", "S"):
        out[m] = F.when(ver != "2.0", vector_metric(vector, m, legacy)).otherwise(F.lit(""))
    out["Au"] = F.when(ver == "2.0", vector_metric(vector, "Au", legacy)).otherwise(F.lit(""))
    return out


def risk_flags(
    df: DataFrame, vector: str = "vectorString", version: str = "cvssVersion", legacy: bool = False
) -> DataFrame:
    """Add the eight risk flags (never null)."""
    v2, v3 = f"coalesce({version} = '2.0', false)", f"coalesce({version} <> '2.0', false)"

    def has(metric: str, value: str) -> str:
        return _has(vector, metric, value, legacy)

    open_v2 = f"({v2} AND {has('Au', 'N')})"
    flags = {
        "is_network_based": has("AV", "N"),
        "is_no_ui": f"({v3} AND {has('UI', 'N')}) OR {open_v2}",
        "is_low_priv": f"({v3} AND ({has('PR', 'L')} OR {has('PR', 'N')})) OR {open_v2}",
        "is_scope_changed": f"{v3} AND {has('S', 'C')}",
        "is_high_conf": has("C", "H"),
        "is_high_int": has("I", "H"),
        "is_high_avail": has("A", "H"),
    }
    critical = (
        "is_network_based AND is_no_ui AND is_low_priv AND (is_high_conf OR is_high_int "
        f"OR is_high_avail) AND (is_scope_changed OR {v2})"
    )
    return df.selectExpr("*", *[f"{c} AS {n}" for n, c in flags.items()]).selectExpr(
        "*", f"{critical} AS is_fully_critical"
    )


def enrich(df: DataFrame, legacy: bool = False) -> DataFrame:
    """Risk flags and weighted score on lookup-shaped rows."""
    return risk_flags(df, legacy=legacy).withColumn(
        "weighted_score", weighted_score("cvssScore", "severity")
    )


def completeness(cols: list[str]) -> Column:
    """Number of non-null columns in the row."""
    total = F.lit(0)
    for c in cols:
        total = total + F.col(c).isNotNull().cast("int")
    return total
