"""Names, ids, paths, timestamps and hashes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskloom.functions import fixed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_cve_id(c: Column | str) -> Column:
    """Upper case, trimmed, ASCII only."""
    return F.regexp_replace(F.upper(F.trim(_col(c))), fixed.NON_ASCII, "")


def strip_html(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), fixed.HTML_TAG, "")


def clean_name(c: Column | str) -> Column:
    """Drop backslashes, underscores to spaces, trim, title case."""
    no_slash = F.replace(_col(c), F.lit("\\"), F.lit(""))
    return F.initcap(F.trim(F.replace(no_slash, F.lit("_"), F.lit(" "))))


def sanitize_key_field(c: Column | str) -> Column:
    """Trimmed lower-case name; the usual spellings of "no value" become null."""
    name = F.lower(F.trim(_col(c)))
    return F.when(~name.isin(fixed.MISSING_NAMES), name)


def safe_path_component(c: Column | str) -> Column:
    safe = F.regexp_replace(
        F.regexp_replace(_col(c), fixed.UNSAFE_PATH_CHARS, "_"), fixed.LEADING_PATH_MARKS, ""
    )
    return F.when(safe == "", F.lit(fixed.PATH_FALLBACK)).otherwise(safe)


def safe_path(c: Column | str) -> Column:
    """`safe_path_component` on every part between slashes."""
    return F.array_join(F.transform(F.split(_col(c), "/"), safe_path_component), "/")


def safe_message_id(vendor: Column | str, product: Column | str) -> Column:
    """Readable transport id of at most 80 characters with a hash suffix."""
    raw = F.concat(_col(vendor), F.lit("_"), _col(product))
    base = F.substring(
        F.regexp_replace(raw, fixed.UNSAFE_ID_CHARS, "_"), 1, fixed.MESSAGE_ID_BASE_LENGTH
    )
    digest = F.substring(F.sha2(raw, 256), 1, fixed.MESSAGE_ID_HASH_LENGTH)
    return F.concat(base, F.lit("-"), digest)


def message_payload(vendor: Column | str, product: Column | str, stamp: Column) -> Column:
    return F.to_json(
        F.struct(
            _col(vendor).alias("vendor"),
            _col(product).alias("product"),
            stamp.alias("ingestionTimestamp"),
        )
    )


def parse_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    """ISO text to timestamp, null when it cannot be read."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(_col(c))


def compact_timestamp(c: Column | str) -> Column:
    """Text form with a UTC suffix; the cast already drops trailing zeros."""
    return F.coalesce(F.concat(_col(c).cast("string"), F.lit(" UTC")), F.lit(""))


def empty_to_null(c: Column | str) -> Column:
    return F.when(F.size(_col(c)) > 0, _col(c))


def round2(c: Column | str) -> Column:
    """Two decimals as double, null becomes 0.0."""
    return F.coalesce(F.round(_col(c), 2).cast("double"), F.lit(0.0))


def row_hash(*cols: Column | str) -> Column:
    """md5 over the text of the columns; nulls are skipped."""
    return F.md5(F.concat_ws("||", *[_col(c).cast("string") for c in cols]))


def kev_key(cve: Column | str, added: Column | str) -> Column:
    return F.sha2(F.concat(_col(cve), _col(added)), 256)


def narrow(c: Column | str, width: int) -> Column:
    return F.substring(_col(c).cast("string"), 1, width)


def cpe_fields(criteria: Column | str) -> Column:
    """Vendor and product of a CPE 2.3 name; escaped colons stay in their part."""
    parts = F.split(_col(criteria), r"(?<!\\):")
    return F.struct(F.get(parts, F.lit(3)).alias("vendor"), F.get(parts, F.lit(4)).alias("product"))


def cpe_browse_parts(name: Column | str) -> Column:
    """Prefix, version, type, vendor, product and the rest of a CPE 2.3 name."""
    parts = F.split(_col(name), r"(?<!\\):")
    head = ["prefix", "version", "cpetype", "vendor", "product"]
    rest = F.array_join(F.slice(parts, 6, F.greatest(F.size(parts) - 5, F.lit(0))), ":")
    return F.struct(
        *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(head)],
        F.when(rest != "", rest).alias("remainder"),
    )


def file_name_part(path: Column | str, group: int) -> Column:
    """Vendor (1), product (2) or stamp (3) of a raw file name; '' when it does not match."""
    name = F.element_at(F.split(_col(path), "/"), -1)
    return F.regexp_extract(name, fixed.RAW_FILE_NAME, group)
