"""Exposure measures by date grain and level.

Counting distinct ids under many conditions makes Spark repeat every row once per
condition. Here each row first collapses to one fact per (group, record, vendor,
product) that carries exact score sums and one bit per condition; distinct counts are
then plain sums over facts. Each step combines partially before its shuffle, so a hot
group, record or vendor sends at most one row per task and key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import fixed

VENDOR, PRODUCT, CVE = "vendor", "product", "cveId"
LEVEL_KEYS = {"global": [], "vendor": [VENDOR], "product": [VENDOR, PRODUCT]}
RISK_COLUMNS = {g: "is_network_based" if g == "network" else f"is_{g}" for g in fixed.RISK_GROUPS}
BITS = fixed.SEVERITIES + fixed.RISK_GROUPS


def condition_mask() -> str:
    """Expression text: one bit per severity and risk group."""
    tests = [f"severity = '{s.capitalize()}'" for s in fixed.SEVERITIES]
    tests += [RISK_COLUMNS[g] for g in fixed.RISK_GROUPS]
    return " + ".join(f"IF({t}, {1 << i}, 0)" for i, t in enumerate(tests))


def thousandths(score: str) -> str:
    """Exact whole thousandths of a score: sums stay in 64-bit integers, any order."""
    return f"CAST(CAST({score} AS DECIMAL(18,3)) * 1000 AS BIGINT)"


def points(total: str) -> str:
    """Summed thousandths back to score points with two decimals, null becomes 0.0."""
    return f"coalesce(CAST(round(CAST({total} AS DECIMAL(22,0)) / 1000, 2) AS DOUBLE), 0.0D)"


def record_facts(
    df: DataFrame, group: list[str], score: str = "weighted_score", unique: bool = False
) -> DataFrame:
    """One fact per group, record, vendor and product.

    `unique` says the input already has one row per record, vendor and product (the
    lookup has), which saves the shuffle.
    """
    scaled, mask = thousandths(score), condition_mask()
    net = f"IF(is_network_based, {scaled}, NULL)"
    keys = list(dict.fromkeys([*group, VENDOR, PRODUCT, CVE]))
    if unique:
        return df.selectExpr(*keys, f"{scaled} AS _score", f"{net} AS _net", f"{mask} AS _mask")
    return df.groupBy(*keys).agg(
        F.expr(f"sum({scaled}) AS _score"),
        F.expr(f"sum({net}) AS _net"),
        F.expr(f"bit_or({mask}) AS _mask"),
    )


def _suffix(group: str) -> str:
    return f"{group}_count" if group in fixed.SEVERITIES else f"{group}_cves"


def measure_names(level: str) -> list[str]:
    """Output order of the measures of one level."""
    distinct = [f"distinct_{_suffix(b)}" for b in BITS]
    head = ["exposure_index", "network_exposure_index"]
    if level == "product":
        return head + ["distinct_cves"] + distinct
    pairs = [_suffix(b) for b in BITS]
    parts = ["affected_vendors", "affected_products"] if level == "global" else ["affected_products"]
    return (
        head + parts + ["total_cves"] + pairs[:4] + ["distinct_cves"] + distinct[:4]
        + pairs[4:] + distinct[4:]
    )


def _exprs(out: dict[str, str]) -> list[Column]:
    return [F.expr(f"{text} AS {name}") for name, text in out.items()]


def product_measures(facts: DataFrame, group: list[str]) -> DataFrame:
    """11 measures; a fact is one record of one product already."""
    out = {
        "exposure_index": points("sum(_score)"),
        "network_exposure_index": points("sum(_net)"),
        "distinct_cves": f"count({CVE})",
    }
    for i, b in enumerate(BITS):
        out[f"distinct_{_suffix(b)}"] = f"count_if({CVE} IS NOT NULL AND getbit(_mask, {i}) = 1)"
    return facts.groupBy(*group).agg(*_exprs(out))


def wide_measures(facts: DataFrame, group: list[str], parts: list[str]) -> DataFrame:
    """21 or 22 measures: counts of records, of record-part pairs and of the parts.

    `parts` are the pair columns still distinct inside the group (product, or vendor and
    product). One grouping-sets pass gives a row per record and a row per part value.
    """
    members = [CVE, *parts]
    whole = " AND ".join(f"{m} IS NOT NULL" for m in members)
    # The pair test needs the real key values, so it is taken before the grouping sets.
    pairs = facts.selectExpr(
        *group, *members, "_score", "_net", "_mask", f"IF({whole}, _mask, NULL) AS _pair"
    )
    sums = {f"_not_{m}": f"grouping({m})" for m in members}
    sums |= {"_score": "sum(_score)", "_net": "sum(_net)", "_mask": "bit_or(_mask)", "_pairs": "count(_pair)"}
    sums |= {f"_pairs_{b}": f"count_if(getbit(_pair, {i}) = 1)" for i, b in enumerate(BITS)}
    by_member = pairs.groupingSets([[*group, m] for m in members], *group, *members).agg(*_exprs(sums))

    record = f"_not_{CVE} = 0"
    known = f"{record} AND {CVE} IS NOT NULL"

    def of_records(c: str) -> str:
        return f"sum(IF({record}, {c}, NULL))"

    out = {
        "exposure_index": points(of_records("_score")),
        "network_exposure_index": points(of_records("_net")),
        "total_cves": f"coalesce({of_records('_pairs')}, 0L)",
        "distinct_cves": f"count_if({known})",
    }
    for p in parts:
        out[f"affected_{p}s"] = f"count_if(_not_{p} = 0 AND {p} IS NOT NULL)"
    for i, b in enumerate(BITS):
        out[_suffix(b)] = f"coalesce({of_records(f'_pairs_{b}')}, 0L)"
        out[f"distinct_{_suffix(b)}"] = f"count_if({known} AND getbit(_mask, {i}) = 1)"
    return by_member.groupBy(*group).agg(*_exprs(out))


def exposure(
    df: DataFrame,
    level: str,
    by: list[str],
    score: str = "weighted_score",
    unique: bool = False,
) -> DataFrame:
    """All measures of a level for the groups `by` (date columns) plus the level's keys."""
    group = [*by, *LEVEL_KEYS[level]]
    facts = record_facts(df, group, score, unique)
    if level == "product":
        out = product_measures(facts, group)
    else:
        out = wide_measures(facts, group, [VENDOR, PRODUCT] if level == "global" else [PRODUCT])
    return out.select(*group, *measure_names(level))


def _grain_text(grain: str, published: str) -> str:
    if grain == "instant":
        return published
    day = f"to_date({published})"
    if grain == "daily":
        return day
    return f"trunc({day}, '{'month' if grain == 'monthly' else 'year'}')"


def level_table(
    df: DataFrame,
    grain: str,
    level: str,
    published: str = "datePublished",
    score: str = "weighted_score",
    unique: bool = False,
) -> DataFrame:
    """Level table of one date grain: `daily`, `monthly`, `yearly` (or `instant`, which
    keeps one row per published time instead of per day)."""
    marked = df.selectExpr("*", f"{_grain_text(grain, published)} AS _grain")
    return _dated(exposure(marked, level, ["_grain"], score, unique), grain, level, published)


def _dated(out: DataFrame, grain: str, level: str, published: str = "datePublished") -> DataFrame:
    """The date columns of a level table in place of `_grain`, in output order."""
    dates = ["year(_grain) AS year_published"]
    if grain == "monthly":
        dates += ["month(_grain) AS month_published", "_grain AS month_date"]
    elif grain == "yearly":
        dates.append("_grain AS year_date")
    elif grain == "instant":
        dates += [f"_grain AS {published}", "to_date(_grain) AS date_published"]
    else:
        dates.append("_grain AS date_published")
    return out.selectExpr(*LEVEL_KEYS[level], *dates, *measure_names(level))


_GRAIN = "CASE _g WHEN 0 THEN _day WHEN 1 THEN trunc(_day, 'month') ELSE trunc(_day, 'year') END"


def day_facts(df: DataFrame, own: Column | None = None, published: str = "datePublished") -> DataFrame:
    """One fact per row of a table with one row per record, vendor and product, with its day. `own` says
    for which rows daily and monthly tables are wanted (default: all); the others count in yearly ones only."""
    marked = df.withColumns({"_day": F.to_date(published), "_own": F.lit(True) if own is None else own})
    return record_facts(marked, ["_own", "_day"], unique=True)


def day_sums(facts: DataFrame) -> DataFrame:
    """Sums and counts of `day_facts` by day, vendor and product. A fact lies in one of these groups, so all
    measures of level tables but distinct records are sums of them."""
    out = {"_score": "sum(_score)", "_net": "sum(_net)", "_n": f"count({CVE})"}
    out |= {f"_n_{b}": f"count_if({CVE} IS NOT NULL AND getbit(_mask, {i}) = 1)" for i, b in enumerate(BITS)}
    return facts.groupBy("_own", "_day", VENDOR, PRODUCT).agg(*_exprs(out))


def record_counts(facts: DataFrame) -> DataFrame:
    """Distinct records of `day_facts` by grain and date, with vendor (`_level` vendor) and without (global).

    Facts are placed by record and vendor once, days of a record (combined first) by record once; all grains
    are then counted in place. A task holds one vendor's products of a record and a record's days at most
    together, so a hot record or vendor is spread.
    """
    known = facts.where(F.col(CVE).isNotNull()).select(CVE, VENDOR, "_own", "_day", "_mask").repartition(CVE, VENDOR)
    days = known.groupBy(CVE, "_own", "_day").agg(F.expr("bit_or(_mask) AS _mask")).repartition(CVE)
    counts = {"_records": "count(*)"} | {f"_records_{b}": f"count_if(getbit(_mask, {i}) = 1)" for i, b in enumerate(BITS)}

    def counted(rows: DataFrame, level: str) -> DataFrame:
        by = [*LEVEL_KEYS[level], "_g", "_date"]
        grains = rows.selectExpr("*", "explode(IF(_own, array(0, 1, 2), array(2))) AS _g").selectExpr("*", f"{_GRAIN} AS _date")
        each = grains.groupBy(CVE, *by).agg(F.expr("bit_or(_mask) AS _mask"))
        return each.groupBy(*by).agg(*_exprs(counts)).withColumn("_level", F.lit(level))

    return counted(known, "vendor").unionByName(counted(days, "global"), allowMissingColumns=True)


def level_of_sums(sums: DataFrame, records: DataFrame, grain: str, level: str) -> DataFrame:
    """`level_table` of unique rows from their `day_sums` and `record_counts`."""
    by, g = ["_grain", *LEVEL_KEYS[level]], fixed.GRAINS.index(grain)
    rows = sums if grain == "yearly" else sums.where("_own")
    rows = rows.withColumn("_g", F.lit(g)).selectExpr("*", f"{_GRAIN} AS _grain")
    parts = {"global": [VENDOR, PRODUCT], "vendor": [PRODUCT], "product": []}[level]
    whole = " AND ".join(f"{p} IS NOT NULL" for p in parts) or "true"

    def of_pairs(c: str) -> str:
        return f"coalesce(sum(IF({whole}, {c}, NULL)), 0L)"

    plain = "distinct_" if level == "product" else ""
    out = {"exposure_index": points("sum(_score)"), "network_exposure_index": points("sum(_net)")}
    out |= {f"affected_{p}s": f"count(DISTINCT {p})" for p in parts}
    out |= {f"{plain}cves" if plain else "total_cves": of_pairs("_n")}
    out |= {plain + _suffix(b): of_pairs(f"_n_{b}") for b in BITS}
    whole_groups = rows.groupBy(*by).agg(*_exprs(out))
    if level != "product":
        wanted = records.where((F.col("_level") == level) & (F.col("_g") == g))
        names = {"distinct_cves": "_records"} | {f"distinct_{_suffix(b)}": f"_records_{b}" for b in BITS}
        found = wanted.select(
            F.col("_date").alias("_o__grain"), *[F.col(k).alias("_o_" + k) for k in LEVEL_KEYS[level]],
            *[F.col(c).alias(n) for n, c in names.items()])
        same = reduce(lambda a, b: a & b, [whole_groups[k].eqNullSafe(found["_o_" + k]) for k in by])
        whole_groups = whole_groups.join(found, same, "left").withColumns({n: F.coalesce(n, F.lit(0).cast("bigint")) for n in names})
    return _dated(whole_groups, grain, level)


def trailing_table(
    df: DataFrame,
    months: int,
    level: str,
    as_of: Column,
    published: str = "datePublished",
    score: str = "weighted_score",
    unique: bool = False,
) -> DataFrame:
    """Measures over the records published since `months` before `as_of`."""
    start = F.add_months(as_of, -months)
    recent = df.where(F.col(published) >= start)
    out = exposure(recent, level, [], score, unique)
    return out.withColumns({"window_start": start, "window_end": as_of})


def index_by_level(
    df: DataFrame, published: str = "datePublished", score: str = "weighted_score"
) -> DataFrame:
    """(level, exposure_index) of all nine level tables from one scan.

    Scores are summed by day, vendor and product first; the nine groupings then run over
    that much smaller set in one pass.
    """
    base = (
        df.selectExpr(f"to_date({published}) AS day", VENDOR, PRODUCT, f"{thousandths(score)} AS _score")
        .groupBy("day", VENDOR, PRODUCT)
        .agg(F.sum("_score").alias("_score"))
        .selectExpr("*", "trunc(day, 'month') AS month", "trunc(day, 'year') AS year")
    )
    dates = {"daily": "day", "monthly": "month", "yearly": "year"}
    sets = [[d, *LEVEL_KEYS[lv]] for d in dates.values() for lv in fixed.LEVELS]
    cols = ["day", "month", "year", VENDOR, PRODUCT]
    marks = {f"_not_{c}": f"grouping({c})" for c in cols}
    grouped = base.groupingSets(sets, *cols).agg(
        *_exprs({"exposure_index": points("sum(_score)"), **marks})
    )
    grain = "CASE WHEN _not_day = 0 THEN 'daily' WHEN _not_month = 0 THEN 'monthly' ELSE 'yearly' END"
    level = f"CASE WHEN _not_{PRODUCT} = 0 THEN 'product' WHEN _not_{VENDOR} = 0 THEN 'vendor' ELSE 'global' END"
    return grouped.selectExpr(f"concat({grain}, '_', {level}) AS level", "exposure_index")


def touched_grains(grain: str, *frames: DataFrame, published: str = "datePublished") -> DataFrame:
    """Distinct dates of a grain that occur in the frames (null for records without a date)."""
    parts = [df.selectExpr(f"{_grain_text(grain, published)} AS _touched") for df in frames]
    return reduce(DataFrame.unionByName, parts).distinct()


GRAIN_DATE = {"daily": "date_published", "monthly": "month_date", "yearly": "year_date"}


def refresh_level(
    old: DataFrame,
    rows: DataFrame,
    touched: DataFrame,
    grain: str,
    level: str,
    published: str = "datePublished",
    unique: bool = False,
) -> DataFrame:
    """Level table after recomputing only the touched dates, in one job.

    `rows` are the enriched rows after the change, `touched` the dates of changed rows
    before and after it (a moved record touches both). There are at most as many touched
    dates as days in the calendar, so they are broadcast; a shuffle by date would put all
    rows of a hot day into one task. The affected rows are dealt out evenly before they are
    counted, so a task holds a bounded number of them, however large the files are.
    """
    dates = F.broadcast(touched)
    marked = rows.selectExpr("*", f"{_grain_text(grain, published)} AS _grain")
    affected = marked.join(dates, marked["_grain"].eqNullSafe(dates["_touched"]), "left_semi")
    kept = old.join(dates, old[GRAIN_DATE[grain]].eqNullSafe(dates["_touched"]), "left_anti")
    fresh = level_table(affected.drop("_grain").hint("rebalance"), grain, level, published, unique=unique)
    return kept.unionByName(fresh)
