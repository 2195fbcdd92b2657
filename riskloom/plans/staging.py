"""Ingest records -> staging rows -> master rows -> lookup rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import fixed, nested, scoring, text
from riskloom.operators.joins import merge_sources
from riskloom.operators.keyfilter import may_match
from riskloom.operators.keys import consolidate_first, most_complete_per_key
from riskloom.sources.staged import stored

_INGEST = ["vendor", "product", "ingestionTimestamp", "ingestionDate"]
_KEYS = ["vendor", "product", "cveId", "ingestionTimestamp", "ingestionDate"]


def _all_cwe(cna: str, nvd: str) -> Column:
    """CWE entries of both sources in order of id and text, nulls first."""
    return F.sort_array(F.concat(nested.or_empty(F.col(cna), nested.CWE_TYPE), nested.or_empty(F.col(nvd), nested.CWE_TYPE)))


def _merged_cwe(every: str) -> Column:
    """The last entry, which has the greatest text, of each id in a sorted list; null without entries."""
    last = F.filter(every, lambda x, i: F.coalesce(x["cweId"] != F.get(every, i + 1)["cweId"], F.lit(True)))
    return F.when(F.size(every) > 0, last)


def normalize(raw: DataFrame, drop_unscored: bool = False) -> DataFrame:
    """Staging rows, one per vendor, product, record and ingestion.

    Each side is written once as parsed rows and becomes one row per key. `drop_unscored` leaves out
    NVD documents that carry no metric.
    """
    cna = nested.flatten_cna(nested.explode_pairs(raw, "cvelistv5", fixed.CNA_STAGING_SCHEMA, _INGEST))
    nvd = nested.flatten_nvd(nested.explode_pairs(raw, "fkie_nvd", fixed.NVD_STAGING_SCHEMA, _INGEST))
    if drop_unscored:
        nvd = nvd.where(F.size("nvdCvss") > 0)
    # Parsed once: the sides are read several times below.
    cna, nvd = stored(cna, "cna_rows"), stored(nvd, "nvd_rows")
    cna = consolidate_first(cna, _KEYS, ["dateUpdated"], ["cnaCvss", "cnaCapec", "cnaCwe"])
    nvd = consolidate_first(nvd, _KEYS, ["lastModified"], ["nvdCvss", "nvdCwe"])
    merged = merge_sources(
        cna, nvd, _KEYS,
        cna_first={"datePublished": ("datePublished", "published")},
        nvd_first={"Descriptions": ("cnaDescription", "nvdDescription")},
        nvd_nonempty={"cvssData": ("cnaCvss", "nvdCvss")},
        keep=["vulnStatus", "dateReserved", "dateUpdated", "datePublic", "lastModified", "cnaCapec", "cnaCwe", "nvdCwe"],
    )
    finished = merged.withColumn("_cwe", _all_cwe("cnaCwe", "nvdCwe")).withColumns(
        {
            "cweData": _merged_cwe("_cwe"),
            "capecData": text.empty_to_null("cnaCapec"),
            "cvssData": text.empty_to_null("cvssData"),
            "Descriptions": text.strip_html("Descriptions"),
        }
    )
    return finished.select(*fixed.STAGING_COLUMNS)


def master_rows(staging: DataFrame) -> DataFrame:
    """Staging rows with the chosen score, ready for the history merge."""
    chosen = scoring.choose_cvss("cvssData")
    scored = staging.withColumn("_c", chosen).withColumns(
        {"cvssScore": F.col("_c.baseScore"), "cvssVersion": F.col("_c.version")}
    )
    data = [c for c in fixed.MASTER_COLUMNS if c not in ("validFrom", "validTo", "currentFlag")]
    return scored.withColumn("severity", scoring.severity("cvssScore")).withColumnRenamed(
        "Descriptions", "descriptions"
    ).select(*data)


def empty_master(like: DataFrame) -> DataFrame:
    """Master table without rows, for the first run."""
    return like.selectExpr(
        "*", "CAST(NULL AS TIMESTAMP) AS validFrom", "CAST(NULL AS TIMESTAMP) AS validTo", "true AS currentFlag"
    ).where("false")


def lookup_rows(current: DataFrame) -> DataFrame:
    """Current master rows in lookup shape, duplicates still inside."""
    df = current.withColumn("_c", scoring.choose_cvss("cvssData"))
    df = df.withColumns(scoring.lookup_fields("_c"))
    df = df.withColumns(
        {
            "severity": scoring.severity("cvssScore", missing=""),
            "cweData": scoring.join_labels("cweData", "cweId", "cweDescription"),
            "capecData": scoring.join_labels("capecData", "capecId", "capecDescription"),
            "cvssData": F.to_json("cvssData"),
            **{c: text.compact_timestamp(c) for c in ("dateReserved", "dateUpdated", "datePublic", "lastModified")},
            "vendor": text.clean_name("vendor"),
            "product": text.clean_name("product"),
            "year_published": F.year("datePublished"),
            "date_published": F.to_date("datePublished"),
        }
    )
    return df.select(*fixed.LOOKUP_COLUMNS)


def lookup_keys(current: DataFrame) -> DataFrame:
    """Distinct lookup keys of master rows."""
    return current.select(
        text.clean_name("vendor").alias("vendor"), text.clean_name("product").alias("product"), "cveId"
    ).distinct()


def rows_of_keys(current: DataFrame, wanted: DataFrame) -> DataFrame:
    """Master rows whose lookup key is wanted; nulls in keys are equal. A filter of the keys drops most others
    where they are read."""
    named = current.withColumns({"_v": text.clean_name("vendor"), "_p": text.clean_name("product")})
    renamed = wanted.select(F.col("vendor").alias("_v"), F.col("product").alias("_p"), "cveId")
    names = ["_v", "_p", "cveId"]
    near, other = may_match(named, renamed, names), renamed.select(*[F.col(c).alias("_w" + c) for c in names])
    same = reduce(lambda a, b: a & b, [near[c].eqNullSafe(other["_w" + c]) for c in names])
    return near.join(other, same, "left_semi").select(*current.columns)


def build_lookup(current: DataFrame) -> DataFrame:
    """Lookup table: one row, the most complete one, per vendor, product and record."""
    return most_complete_per_key(lookup_rows(current), fixed.RECORD_KEY)
