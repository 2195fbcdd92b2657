"""Array, map and JSON steps of the record documents.

Each one works inside the row: nothing is exploded, so lists of a document are
never multiplied with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import fixed
from riskloom.functions.text import normalize_cve_id


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_empty(arr: Column, like: str) -> Column:
    """The array, or an empty one of type `like` when it is null."""
    return F.coalesce(arr, F.array().cast(like))


def explode_pairs(df: DataFrame, pairs: str, schema: str, keep: list[str]) -> DataFrame:
    """`[id, json]` pairs to rows with a normalised id and the parsed document."""
    pair = F.explode(pairs).alias("pair")
    return df.select(*keep, pair).select(
        *keep,
        normalize_cve_id(F.get("pair", F.lit(0))).alias("cveId"),
        F.from_json(F.get("pair", F.lit(1)), schema).alias("doc"),
    )


def english_only(texts: Column | str, exact: bool = False) -> Column:
    """Entries whose language is English (`en`, `en-US`, ...)."""
    if exact:
        return F.filter(_col(texts), lambda x: x["lang"] == "en")
    return F.filter(_col(texts), lambda x: x["lang"].startswith("en"))


def first_english(texts: Column | str) -> Column:
    return F.get(english_only(texts), F.lit(0))["value"]


def reorder_struct(arr: Column | str, fields: list[tuple[str, str]]) -> Column:
    """Rebuild every struct of an array with the given fields, order and types."""
    return F.transform(_col(arr), lambda x: F.struct(*[x[n].cast(t).alias(n) for n, t in fields]))


def cvss_entry(entry: Column, source: Column, kind: Column, impact: Column, exploit: Column) -> Column:
    values = {
        "source": source,
        "type": kind,
        "version": entry["version"],
        "vectorString": entry["vectorString"],
        "baseScore": entry["baseScore"],
        "impactScore": impact,
        "exploitabilityScore": exploit,
    }
    return F.struct(*[values[n].cast(t).alias(n) for n, t in fixed.CVSS_FIELDS])


def bare_cvss(entry: Column) -> Column:
    """A CVSS entry that has no source, type or sub-scores."""
    none = F.lit(None)
    return cvss_entry(entry, none, none, none, none)


def cna_adp_cvss(containers: Column | str) -> Column:
    """Distinct v3.1 entries of the CNA, joined by those of the ADPs when some CNA
    metric has no v3.1 block (or the CNA has no metric at all)."""
    c = _col(containers)
    kind = "array<struct<cvssV3_1:struct<version:string,vectorString:string,baseScore:double>>>"
    cna = or_empty(c["cna"]["metrics"], kind)
    adp = F.flatten(
        F.transform(or_empty_adp(c["adp"]), lambda a: or_empty(a["metrics"], kind))
    )
    incomplete = (F.size(cna) == 0) | F.exists(cna, lambda m: m["cvssV3_1"].isNull())
    used = F.when(incomplete, F.concat(cna, adp)).otherwise(cna)
    scored = F.filter(used, lambda m: m["cvssV3_1"].isNotNull())
    return F.array_distinct(F.transform(scored, lambda m: bare_cvss(m["cvssV3_1"])))


ADP_TYPE = (
    "array<struct<problemTypes:array<struct<descriptions:array<struct<cweId:string,"
    "description:string,lang:string,type:string>>>>,metrics:array<struct<cvssV3_1:struct<"
    "version:string,vectorString:string,baseScore:double>>>>>"
)
PROBLEM_TYPE = (
    "array<struct<descriptions:array<struct<cweId:string,description:string,lang:string,type:string>>>>"
)
DESCRIPTION_TYPE = "array<struct<cweId:string,description:string,lang:string,type:string>>"
CWE_TYPE = "array<struct<cweId:string,cweDescription:string>>"
CAPEC_TYPE = "array<struct<capecId:string,capecDescription:string>>"


def or_empty_adp(adp: Column) -> Column:
    return or_empty(adp, ADP_TYPE)


def collect_cwe_cna(containers: Column | str) -> Column:
    """Distinct CWE descriptions (English, with an id) of the CNA and all ADPs."""
    c = _col(containers)
    types = F.concat(
        or_empty(c["cna"]["problemTypes"], PROBLEM_TYPE),
        F.flatten(or_empty(F.transform(c["adp"], lambda a: or_empty(a["problemTypes"], PROBLEM_TYPE)), f"array<{PROBLEM_TYPE}>")),
    )
    texts = F.flatten(F.transform(types, lambda p: or_empty(p["descriptions"], DESCRIPTION_TYPE)))
    wanted = F.filter(
        texts,
        lambda d: (d["type"] == "CWE") & d["lang"].startswith("en") & d["cweId"].isNotNull(),
    )
    return F.array_distinct(
        F.transform(
            wanted,
            lambda d: F.struct(d["cweId"].alias("cweId"), d["description"].alias("cweDescription")),
        )
    )


def collect_capec(impacts: Column | str) -> Column:
    """CAPEC id with each of its English descriptions."""
    named = F.filter(
        or_empty(
            _col(impacts),
            "array<struct<capecId:string,descriptions:array<struct<lang:string,value:string>>>>",
        ),
        lambda i: i["capecId"].isNotNull() & i["descriptions"].isNotNull(),
    )
    return F.array_distinct(
        F.flatten(
            F.transform(
                named,
                lambda i: F.transform(
                    english_only(i["descriptions"]),
                    lambda d: F.struct(
                        i["capecId"].alias("capecId"), d["value"].alias("capecDescription")
                    ),
                ),
            )
        )
    )


def flatten_metrics_map(metrics: Column | str) -> Column:
    """All CVSS versions of the metrics map as one distinct array, in one pass."""
    lists = F.filter(F.map_values(_col(metrics)), lambda v: v.isNotNull())
    entries = F.filter(F.flatten(lists), lambda e: e.isNotNull())
    return F.array_distinct(
        F.transform(
            entries,
            lambda e: cvss_entry(
                e["cvssData"], e["source"], e["type"], e["impactScore"], e["exploitabilityScore"]
            ),
        )
    )


def collect_cwe_nvd(weaknesses: Column | str) -> Column:
    """CWE ids named in the English weakness texts."""
    lists = F.filter(
        or_empty(
            _col(weaknesses),
            "array<struct<source:string,type:string,description:array<struct<lang:string,value:string>>>>",
        ),
        lambda w: w["description"].isNotNull(),
    )
    named = F.flatten(
        F.transform(
            lists,
            lambda w: F.filter(english_only(w["description"]), lambda d: d["value"].startswith("CWE")),
        )
    )
    return F.array_distinct(
        F.transform(
            named,
            lambda d: F.struct(
                d["value"].alias("cweId"), F.lit(None).cast("string").alias("cweDescription")
            ),
        )
    )


def flatten_cna(df: DataFrame, doc: str = "doc") -> DataFrame:
    """CNA/ADP document to its scalar columns and the three entry arrays."""
    d = F.col(doc)
    cna = d["containers"]["cna"]
    meta = d["cveMetadata"]
    return df.withColumns(
        {
            **{n: F.try_to_timestamp(meta[n]) for n in ("datePublished", "dateReserved", "dateUpdated")},
            "datePublic": F.try_to_timestamp(cna["datePublic"]),
            "cnaDescription": first_english(cna["descriptions"]),
            "cnaCvss": cna_adp_cvss(d["containers"]),
            "cnaCapec": collect_capec(cna["impacts"]),
            "cnaCwe": collect_cwe_cna(d["containers"]),
        }
    ).drop(doc)


def flatten_nvd(df: DataFrame, doc: str = "doc") -> DataFrame:
    """NVD document to its scalar columns and the two entry arrays."""
    d = F.col(doc)
    return df.withColumns(
        {
            "published": F.try_to_timestamp(d["published"]),
            "lastModified": F.try_to_timestamp(d["lastModified"]),
            "vulnStatus": d["vulnStatus"],
            "nvdDescription": first_english(d["descriptions"]),
            "nvdCvss": F.coalesce(
                flatten_metrics_map(d["metrics"]), F.array().cast(f"array<{fixed.CVSS_STRUCT}>")
            ),
            "nvdCwe": collect_cwe_nvd(d["weaknesses"]),
        }
    ).drop(doc)


def unwind_configs(df: DataFrame, configurations: str, keep: list[str]) -> DataFrame:
    """configurations -> nodes -> cpeMatch as one row per match."""
    nodes = F.flatten(
        F.filter(F.transform(F.col(configurations), lambda c: c["nodes"]), lambda n: n.isNotNull())
    )
    matches = F.flatten(
        F.filter(F.transform(nodes, lambda n: n["cpeMatch"]), lambda m: m.isNotNull())
    )
    return df.select(*keep, F.explode(matches).alias("m")).select(*keep, F.col("m.criteria"))


def set_changes(new: Column | str, old: Column | str) -> dict[str, Column]:
    """Union and both differences of two id arrays (null counts as empty)."""
    a = or_empty(_col(new), "array<string>")
    b = or_empty(_col(old), "array<string>")
    added, removed = F.array_except(a, b), F.array_except(b, a)
    return {
        "all_ids": F.array_union(a, b),
        "added": added,
        "removed": removed,
        "changed": (F.size(added) > 0) | (F.size(removed) > 0),
    }
